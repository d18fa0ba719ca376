"""Alignment of two tokenizers over whole texts by an associative monoid of fragments.

Two token streams over the same bytes are cut into groups wherever a token of either ends at the same byte. A
byte range of a text gives a ``Fragment``: an open prefix before its first sure cut, closed
groups, and an open suffix after its last one. Joining two fragments closes the suffix of the one with the
prefix of the other, and the order of joining does not matter, so the ranges of a very long text are
encoded by different tasks and composed by a tree. A sure cut is a single space between two
characters that are no white space: there neither tokenizer can have a token on both sides.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierforge.llm.common import ROW_KEY, keyed, stored, table

_BLANK = "▁"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_CUT = re.compile(rb"(?<=[!-~]) (?=[!-~])")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
# Fragments joined at a time, and texts aligned at a time.
_FAN, _ROWS = 16, 256


class Closed(NamedTuple):
    """Whole groups, as the ids of both tokenizers (little-endian, unsigned, 32 bits), and whether the bytes agree."""

    a: bytes = b""
    b: bytes = b""
    whole: bool = True


class Fragment(NamedTuple):
    """``closed`` is ``None`` where the range has no sure cut; ``prefix`` is all of it then."""

    prefix: bytes
    closed: Closed | None
    suffix: bytes


#: Both ends of a text are sure cuts.
EDGE = Fragment(b"", Closed(), b"")


def together(parts: list[Closed]) -> Closed:
    return Closed(b"".join([p.a for p in parts]), b"".join([p.b for p in parts]), all([p.whole for p in parts]))


def _digits(numbers: int) -> np.ndarray:
    """A row of bytes for each number: room for a sign before it, then its decimal digits; zero where there is none."""
    size = len(str(numbers - 1))
    text = "".join(f"\0{n}".ljust(size + 1, "\0") for n in range(numbers))
    return np.frombuffer(text.encode(), dtype=np.uint8).reshape(numbers, size + 1)


class Aligner:
    """Ids of units, that is, of texts between two sure cuts, by both tokenizers.

    ``ranks`` and ``pattern`` are a byte-level BPE vocabulary, ``model`` a BPE model of pieces that stands a blank
    before the text. Units are remembered without their leading space, until they are ``remembered`` many; long ones count more.
    """

    def __init__(self, ranks: str, pattern: str, model: str, remembered: int = 200_000):
        import sentencepiece
        import tiktoken

        self.remembered, self.held = remembered, 0
        # Ids of a unit; None where it cannot stand between single spaces. Those in ``bad`` lose bytes.
        self.a: dict[str, bytes | None] = {}
        self.b: dict[str, bytes] = {}
        self.bad: set[str] = set()
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.first = fast.encode_ordinary
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for piece, rank in known.items():
            self.a_bytes[rank] = piece
        pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        self.second = lambda text: pieces.encode(text, num_threads=1)
        texts = [pieces.id_to_piece(i) for i in range(pieces.vocab_size())]
        if any(_BLANK in text.lstrip(_BLANK) for text in texts):
            raise ValueError("a piece has a blank after another character, so a space is no sure cut")
        self.b_bytes = [
            bytes([int(found[1], 16)]) if (found := _BYTE_PIECE.fullmatch(text)) else text.replace(_BLANK, " ").encode()
            for text in texts
        ]
        self.a_size, self.b_size = (np.array([len(t) for t in tokens], dtype=np.int64) for tokens in (self.a_bytes, self.b_bytes))
        self.width = len(self.b_bytes)
        self.digits = _digits(max(len(self.a_bytes), self.width))

    def _same(self, a: list[int], b: list[int], raw: bytes) -> bool:
        return b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b])

    def unit(self, text: str) -> Closed:
        """``text`` starts with a space."""
        a, b = self.first(text), self.second(text[1:])
        if not self._same(a, b, text.encode()):
            return Closed(whole=False)
        return Closed(array("I", a).tobytes(), array("I", b).tobytes())

    def _learn(self, units: set[str]) -> None:
        """Units that can stand between single spaces are encoded together, and told apart by their bytes."""
        whole = [u for u in units if u and not u[0].isspace() and not u[-1].isspace()]
        self.a.update(dict.fromkeys(units))
        sizes = [len(u.encode()) + 1 for u in whole]
        text = " " + " ".join(whole)
        a, b = (self.first(text), self.second(text[1:])) if whole else ([], [])
        if whole and self._same(a, b, text.encode()):
            ends = np.cumsum(sizes)
            for ids, size, known in ((a, self.a_size, self.a), (b, self.b_size, self.b)):
                after = 4 * (np.searchsorted(np.cumsum(size[ids]), ends) + 1)
                data, at = array("I", ids).tobytes(), 0
                for u, stop in zip(whole, after.tolist(), strict=True):
                    known[u] = data[at:stop]
                    at = stop
        else:
            for u in whole:
                self.a[u], self.b[u], same = self.unit(" " + u)
                if not same:
                    self.bad.add(u)
        self.held += len(units) + sum(sizes) // 64

    def _joined(self, units: list[str]) -> Closed:
        whole = not self.bad or self.bad.isdisjoint(units)
        return Closed(b"".join([self.a[u] for u in units]), b"".join([self.b[u] for u in units]), whole)

    def document(self, text: str) -> Closed:
        """A whole text, with a space before it."""
        if not text:
            return Closed(whole=False)
        if self.held > self.remembered:
            self.a, self.b, self.bad, self.held = {}, {}, set(), 0
        words = text.split(" ")
        if missing := {w for w in words if w not in self.a}:
            self._learn(missing)
        try:
            return self._joined(words)
        except TypeError:
            # White space other than single spaces between words.
            units = _CUT.split(text)
        self._learn({u for u in units if u not in self.a})
        return together([self.unit(" " + u) if self.a[u] is None else self._joined([u]) for u in units])

    def fragment(self, data: bytes) -> Fragment:
        """A byte range of a text with a space before it; it may begin and end within a character."""
        cuts = [m.start() for m in _BYTE_CUT.finditer(data)]
        if not cuts:
            return Fragment(data, None, b"")
        words = data[cuts[0] + 1 : cuts[-1]].decode()
        closed = self.document(words) if words else Closed()
        return Fragment(data[: cuts[0]], closed, data[cuts[-1] :])

    def join(self, x: Fragment, y: Fragment) -> Fragment:
        if x.closed is None:
            return Fragment(x.prefix + y.prefix, y.closed, y.suffix)
        if y.closed is None:
            return Fragment(x.prefix, x.closed, x.suffix + y.prefix)
        seam = x.suffix + y.prefix
        middle = [self.unit(seam.decode())] if seam else []
        return Fragment(x.prefix, together([x.closed, *middle, y.closed]), y.suffix)


    def aligned(self, found: list[Closed]) -> list[pa.Array]:
        """The columns ``_ALIGNED`` of whole texts; ``pairs`` are distinct and come with how often each is linked.

        The texts lie one after the other. A link ends where a token of either ends.
        """
        found = [c if c.whole else Closed() for c in found]
        a, b = (np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int64) for ids in ([c.a for c in found], [c.b for c in found]))
        n_a, n_b = (np.array(list(map(len, ids)), dtype=np.int64) // 4 for ids in ([c.a for c in found], [c.b for c in found]))
        number = np.arange(len(found))
        text_a, text_b = np.repeat(number, n_a), np.repeat(number, n_b)
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        over_a, over_b = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)
        closes_a, closes_b = end_b[over_a] == end_a, end_a[over_b] == end_b

        space = len(self.a_bytes) * self.width
        ends = [text_a * space + a * self.width + b[over_a], (text_b * space + a[over_b] * self.width + b)[~closes_b]]
        distinct, times = np.unique(np.concatenate(ends), return_counts=True)
        pairs = distinct - (of := distinct // space) * space
        offsets = pa.array(np.searchsorted(of, np.arange(len(found) + 1)).astype(np.int32))
        n_groups = np.bincount(text_a[closes_a], minlength=len(found))

        # Group by group, first the ids of the one tokenizer and then those of the other, each behind its sign.
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        place_a = np.arange(len(a)) + np.concatenate([[0], np.flatnonzero(closes_b) + 1])[group_a]
        place_b = np.arange(len(b)) + (np.flatnonzero(closes_a) + 1)[group_b]
        opens_a, opens_b = (np.concatenate([[True], closes[:-1]])[: len(closes)] for closes in (closes_a, closes_b))
        signs = np.empty((len(a) + len(b), self.digits.shape[1]), dtype=np.uint8)
        signs[place_a], signs[place_b] = self.digits[a], self.digits[b]
        signs[place_a, 0], signs[place_b, 0] = np.where(opens_a, ord(";"), ord(",")), np.where(opens_b, ord("|"), ord(","))
        starts = np.concatenate([[0], np.cumsum(n_a + n_b)])
        signs[starts[:-1][n_a > 0], 0] = 0
        there = signs != 0
        byte = np.concatenate([[0], np.cumsum(there.sum(axis=1))])[starts].tolist()
        data = signs[there].tobytes()
        digests = [hashlib.sha256(data[x:y]).hexdigest() if x < y else "" for x, y in zip(byte[:-1], byte[1:], strict=True)]
        return [
            *map(pa.array, (n_a, n_b, n_groups, n_a + n_b - n_groups, digests)),
            pa.ListArray.from_arrays(offsets, pa.array(pairs)),
            pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
        ]


@functools.cache
def public_aligner() -> Aligner:
    """One for each Python process, with the units it remembers."""
    import public_tokenizers as files

    return Aligner(files.path("byte_bpe_50k.tiktoken"), files.PATTERN, files.path("piece_bpe_32k.model"))


_ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
_FRAGMENT = "prefix binary, closed boolean, suffix binary, a binary, b binary, whole boolean"


def _lists(columns: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in columns])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*columns, []]).astype(kind.to_pandas_dtype()), kind))


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _long_texts(rows: DataFrame, kind: str, aligner: Callable[[], Aligner], chunk_bytes: int) -> DataFrame:
    """``doc_id`` and ``_ALIGNED`` of texts that several tasks share: cut by bytes, dealt out, composed by a tree."""
    number = [*ROW_KEY, "doc_id", "no"]
    keys = f"{ROW_KEY[0]} bigint, {ROW_KEY[1]} bigint, doc_id {kind}, no bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for at in range(batch.num_rows):
                data = b" " + texts[at].as_py()
                starts = range(0, len(data), chunk_bytes)
                for first in range(0, len(starts), 64):
                    some = starts[first : first + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[pa.array([batch.column(k)[at].as_py()] * len(some), batch.column(k).type) for k in number[:3]],
                            pa.array([s // chunk_bytes for s in some], pa.int64()),
                            pa.array([data[s : s + chunk_bytes] for s in some], pa.binary()),
                        ],
                        names=[*number, "data"],
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner()
        for batch in batches:
            found = [own.fragment(data) for data in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in number], *[pa.array(c) for c in _columns(found)]],
                names=[*number, *_names(_FRAGMENT)],
            )

    def compose(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        own = aligner()
        part = part.sort_values("no")
        whole = None
        for row in part.itertuples(index=False):
            closed = Closed(row.a, row.b, row.whole) if row.closed else None
            one = Fragment(row.prefix, closed, row.suffix)
            whole = one if whole is None else own.join(whole, one)
        fields = dict(zip(_names(_FRAGMENT), _columns([whole]), strict=True))
        return pd.DataFrame({**{k: [part[k].iloc[0]] for k in number[:3]}, "no": [part["no"].iloc[0] // _FAN], **fields})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner()
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                closed = Closed(row["a"], row["b"], row["whole"]) if row["closed"] else None
                inner = Fragment(row["prefix"], closed, row["suffix"])
                found.append(own.join(own.join(EDGE, inner), EDGE).closed)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *own.aligned(found)], names=["doc_id", *_names(_ALIGNED)])

    chunks = rows.mapInArrow(cut, f"{keys}, data binary").repartition(*number)
    fragments = stored(chunks.mapInArrow(encode, f"{keys}, {_FRAGMENT}"), "fragments")
    last = fragments.agg(F.max("no")).first()[0] or 0
    while last:
        level = F.expr(f"no div {_FAN}")
        fragments = fragments.groupBy(*ROW_KEY, level.alias("level")).applyInPandas(compose, f"{keys}, {_FRAGMENT}")
        last //= _FAN
    return fragments.mapInArrow(finish, f"doc_id {kind}, {_ALIGNED}")


def _columns(found: list[Fragment]) -> list[list]:
    """The columns ``_FRAGMENT``."""
    closed = [f.closed or Closed() for f in found]
    return [
        [f.prefix for f in found],
        [f.closed is not None for f in found],
        [f.suffix for f in found],
        [c.a for c in closed],
        [c.b for c in closed],
        [c.whole for c in closed],
    ]


def aligned_texts(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    aligner: Callable[[], Aligner] = public_aligner,
    chunk_bytes: int = 1 << 16,
) -> DataFrame:
    """One row per text: ``doc_id`` and ``_ALIGNED``; texts of more than ``chunk_bytes`` are shared by several tasks."""
    rows = keyed(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner()
        for batch in (part.slice(at, _ROWS) for part in batches for at in range(0, part.num_rows, _ROWS)):
            found = [own.document(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *own.aligned(found)], names=["doc_id", *_names(_ALIGNED)])

    is_long = F.coalesce(F.octet_length("text") > chunk_bytes, F.lit(False))
    short = rows.where(~is_long).select("doc_id", "text").mapInArrow(align, f"doc_id {kind}, {_ALIGNED}")
    return short.unionByName(_long_texts(rows.where(is_long), kind, aligner, chunk_bytes))


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair``, ``n``: in how many texts it is linked, ``best``: whether no other pair of its first id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    most = F.max("n").over(Window.partitionBy(F.expr(f"pair div {width}")))
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


RESULT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def align_tokenizers(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    aligner: Callable[[], Aligner] = public_aligner,
    chunk_bytes: int = 1 << 16,
    frequent: int = 1 << 16,
) -> DataFrame:
    """One row per text: ``RESULT``; see ``Aligner`` for the two tokenizers.

    Texts that are null, empty, or that one of the tokenizers does not give back byte by byte, have no tokens:
    zeros, and an empty ``groups_sha256``. Null and repeated ids are texts of their own; an empty table
    gives no row. ``n_best`` counts the links whose pair is the one, or one of those, that the most texts link for its
    first id; ``count_sum`` adds the number of texts over the links.

    The numbers of the ``frequent`` pairs that most texts have, a bounded table, are looked up where the texts are; those of the
    other pairs come by a join on the pair. So no pair, however common, is a hot key. Texts are encoded
    once; what is passed on are distinct pairs.
    """
    spark = docs.sparkSession
    width = aligner().width
    found = stored(aligned_texts(docs, id_col=id_col, text_col=text_col, aligner=aligner, chunk_bytes=chunk_bytes), "aligned")
    counts = stored(pair_counts(found, width), "pair_counts")
    common = counts.orderBy(F.desc("n"), "pair").limit(frequent).toPandas().sort_values("pair")
    known = spark.sparkContext.broadcast([common[c].to_numpy() for c in ("pair", "n", "best")])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            sums, rest = [], []
            for pairs, times in zip(batch.column("pairs"), batch.column("times"), strict=True):
                pairs, times = pairs.values.to_numpy(), times.values.to_numpy()
                at = np.minimum(np.searchsorted(pair, pairs), max(0, len(pair) - 1))
                hit = pair[at] == pairs if len(pair) else np.zeros(len(pairs), dtype=bool)
                here, often = at[hit], times[hit].astype(np.int64)
                sums.append((int((often * best[here]).sum()), int((often * n[here]).sum())))
                rest.append((pairs[~hit], times[~hit]))
            hits = np.array(sums, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in kept],
                    pa.array(hits[:, 0]),
                    pa.array(hits[:, 1]),
                    _lists([r[0] for r in rest], pa.int64()),
                    _lists([r[1] for r in rest], pa.int32()),
                ],
                names=[*kept, "n_best", "count_sum", "pairs", "times"],
            )

    rows = keyed(found, *found.columns)
    kept = [*ROW_KEY, "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in kept) + ", n_best bigint, count_sum bigint, pairs array<bigint>, times array<int>"
    looked = stored(rows.select(*kept, "pairs", "times").mapInArrow(look_up, schema), "looked_up")

    other = looked.select(*ROW_KEY, F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    other = other.join(counts, "pair").groupBy(*ROW_KEY)
    other = other.agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("__best"),
        F.sum(F.col("times") * F.col("n")).alias("__sum"),
    )
    joined = looked.drop("pairs", "times").join(other, list(ROW_KEY), "left")
    joined = joined.withColumns(
        {
            "n_best": F.col("n_best") + F.coalesce("__best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("__sum", F.lit(0)),
        }
    )
    return joined.select(*RESULT)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"))
