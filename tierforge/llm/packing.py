"""Packing of tokenised examples into sequences as vector bin packing.

An example takes tokens, one segment and loss-bearing tokens of a sequence, each of which is limited. Among the
waiting examples that fit, the one whose demand has the greatest dot product with what is left of
the sequence goes in next. When nothing fits, one example is cut to fill the rest.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import table


class Limits(NamedTuple):
    tokens: int = 1024
    segments: int = 128
    loss_tokens: int = 1024


class Tokenizer(dict):
    """Ids of whole texts as bytes, little-endian unsigned 32-bit, by a byte-level BPE vocabulary.

    ``vocabulary`` is the file of the ``tokenizers`` library, ``ranks`` the same vocabulary as ranks, which
    is faster to apply. In this vocabulary no piece goes on beyond a
    space that stands between two other characters than white space, so texts are looked up word
    by word; words are remembered, as many as ``remembered``. Texts with
    runs of white space, or with the name of a special token, are encoded as a whole.
    """

    _RUNS = re.compile(r" \s|\s ")

    def __init__(self, vocabulary: str, ranks: str, pattern: str, remembered: int = 500_000):
        import tiktoken
        from tokenizers import Tokenizer as Whole

        self.remembered = remembered
        with open(ranks, "rb") as lines:
            table_ = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table_, special_tokens={})
        self.ordinary = fast.encode_ordinary
        self.whole = Whole.from_file(vocabulary)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()) or r"(?!)")

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.remembered:
            self.clear()
        if word[-1] in ",.;:!?" and word[-2:-1].isascii() and word[-2:-1].isalpha():
            # Letters and the mark after them are never one piece.
            ids = self[word[:-1]] + np.array(self.ordinary(word[-1]), dtype="<u4").tobytes()
        else:
            ids = np.array(self.ordinary(word), dtype="<u4").tobytes()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.special.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if self._RUNS.search(text):
            return np.array(self.ordinary(text), dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        head = np.array(self.ordinary(first), dtype="<u4").tobytes()
        return head + b"".join([self[" " + word] for word in rest])


def public_tokenizer() -> Tokenizer:
    import public_tokenizers as files

    return Tokenizer(files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN)


@dataclass
class Piece:
    doc: object
    start: int
    ids: bytes
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return replace(self, ids=self.ids[: 4 * at]), replace(self, start=self.start + at, ids=self.ids[4 * at :])


class Packer:
    """Packs a stream of pieces; ``waiting`` of them are kept to choose from."""

    def __init__(self, limits: Limits, waiting: int = 256):
        self.limits, self.waiting = limits, waiting
        self.cap = np.array(limits, dtype=float)
        self.pool: list[Piece] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        full = min(self.limits.tokens, self.limits.loss_tokens + 1)
        full = full if full == self.limits.tokens else 1 << full.bit_length() - 1
        while len(piece) >= full:
            head, piece = piece.cut(full)
            yield [head]
        if len(piece):
            self.pool.append(piece)
        if len(self.pool) >= self.waiting:
            yield from self.flush(self.waiting // 2)

    def flush(self, left: int = 0) -> Iterator[list[Piece]]:
        """Sequences until ``left`` pieces wait."""
        while len(self.pool) > left:
            yield self._sequence()

    def _sequence(self) -> list[Piece]:
        lengths = np.array([len(p) for p in self.pool], dtype=float)
        # The first token of a segment is predicted from nothing, so it bears no loss.
        demand = np.stack([lengths, np.ones_like(lengths), lengths - 1], axis=1)
        share = demand / self.cap
        free, taken = self.cap.copy(), []
        alive = np.ones(len(self.pool), dtype=bool)
        while True:
            fits = alive & (demand <= free).all(axis=1)
            if not fits.any():
                break
            best = int(np.where(fits, share @ (free / self.cap), -1.0).argmax())
            taken.append(best)
            alive[best] = False
            free -= demand[best]
        sequence = [self.pool[i] for i in taken]
        rest = [p for p, keep in zip(self.pool, alive, strict=True) if keep]
        room = int(min(free[0], free[2] + 1)) if free[1] >= 1 else 0
        if room and rest:
            # Nothing fits, so every waiting piece is longer than the room: cut the longest.
            longest = max(range(len(rest)), key=lambda i: len(rest[i]))
            head, rest[longest] = rest[longest].cut(room)
            sequence.append(head)
        used = sum(map(len, sequence))
        if used < self.limits.tokens:
            # A length that is a power of two needs no padding; what is beyond it waits on.
            excess = used - (1 << used.bit_length() - 1)
            while excess:
                last = sequence.pop()
                if len(last) > excess:
                    head, last = last.cut(len(last) - excess)
                    sequence.append(head)
                rest.append(last)
                excess -= len(last)
        self.pool = rest
        return sequence


SCHEMA = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: Callable[[], Tokenizer] = public_tokenizer,
    end_id: int = 0,
    limits: Limits = Limits(),  # noqa: B008
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Each text is encoded as a whole and ends with ``end_id``; null is the empty text, which is that id alone. Pieces
    of a document cover its ids once. No sequence exceeds a limit; those
    not filled are as long as a power of two. Every input split is packed by itself while
    it is read: nothing is shuffled, a task keeps a few hundred waiting pieces, and a repeated
    task gives the same rows. ``sequence_id`` is unique, with the split's number in its upper bits. Null
    or repeated ids are documents of their own. An empty table gives no row.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokenizer().encode, np.array([end_id], dtype="<u4").tobytes()
        packer = Packer(limits)
        number = TaskContext.get().partitionId() << 40
        kind = None

        def rows(sequences: Iterator[list[Piece]]) -> list[tuple]:
            nonlocal number
            out = []
            for sequence in sequences:
                offset = 0
                for p in sequence:
                    out.append((p.doc, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, number, offset))
                    offset += len(p)
                number += 1
            return out

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 7
            arrays = [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *[c.split()[0] for c in SCHEMA.split(", ")]])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("__text").to_pylist(), strict=True):
                ids = encode(text or "") + end
                out += rows(packer.add(Piece(doc, 0, ids, len(ids) // 4)))
            yield batch_of(out)
        if kind is not None:
            yield batch_of(rows(packer.flush()))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    return rows.mapInArrow(pack, f"doc_id {dict(rows.dtypes)['doc_id']}, {SCHEMA}")


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
