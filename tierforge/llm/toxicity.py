"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters by an embedding of its own, if it was learned, and by the sum of the embeddings of its
character grams. The network reads windows of words in both directions, pools its states by attention and
gives a logit; a text is as toxic as the worst of all its overlapping windows. Labels are known for
texts only, so training alternates with choosing the worst window of every text.
"""

from __future__ import annotations

import pickle
import string
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import hash_share, hashed, remainder, table

_LONGEST_WORD = 24
_MARK = 1
# Lengths of the grams, in bytes.
_SIZES = (3, 4, 5, 6)


class Shape(NamedTuple):
    window: int = 32
    stride: int = 16
    word: int = 16
    char: int = 16
    buckets: int = 32768
    hidden: int = 16
    attention: int = 16


def words_of(text: str | None) -> list[str]:
    """Lower-case words without outer marks; longer ones than ``_LONGEST_WORD`` count as several."""
    out = []
    for word in (text or "").lower().split():
        word = word.strip(string.punctuation) or word
        if len(word) <= _LONGEST_WORD:
            out.append(word)
        else:
            out += [word[at : at + _LONGEST_WORD] for at in range(0, len(word), _LONGEST_WORD)]
    return out


def windows_of(count: int, shape: Shape) -> np.ndarray:
    """Starts of the overlapping windows over ``count`` words; the last one ends with the text."""
    last = max(0, count - shape.window)
    starts = np.arange(0, last + shape.stride, shape.stride)
    return np.unique(np.minimum(starts, last)) if count else starts[:0]


def char_grams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte grams that start at each place of the marked words, a column for each of ``_SIZES``, and the
    places that each word has. ``buckets`` itself stands where a gram would reach into the next word."""
    data = [w.encode("utf-8", "replace") for w in words]
    sizes = np.array(list(map(len, data)), dtype=np.int64) + 1
    mark = bytes([_MARK])
    codes = np.frombuffer(mark + mark.join(data) + mark, dtype=np.uint8).astype(np.uint64)
    count = len(codes) - 1
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(count) + 1
    codes = np.concatenate([codes, np.zeros(max(_SIZES), np.uint64)])
    out = np.empty((count, len(_SIZES)), dtype=np.int64)
    rolled = np.zeros(count, dtype=np.uint64)
    for size in range(1, max(_SIZES) + 1):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + codes[size - 1 : size - 1 + count] + np.uint64(1)
        if size in _SIZES:
            mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)
            found = (mixed * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            out[:, _SIZES.index(size)] = np.where(left >= size, found, buckets)
    return out, sizes


class Features(NamedTuple):
    """Distinct words of a batch: their rows in the table of words, their grams by place, and how many places each has."""

    rows: np.ndarray
    grams: np.ndarray
    sizes: np.ndarray


class Network:
    """``weights`` by name; word 0 stands for all words that were not learned."""

    def __init__(self, shape: Shape, vocabulary: dict[str, int], seed: int = 7):
        self.shape, self.vocabulary = shape, vocabulary
        self.scale, self.shift = np.array([1.0, 0.0, 0.0]), 0.0
        rng = np.random.default_rng(seed)
        s, h = shape, shape.hidden
        inputs = s.word + s.char
        sizes = {
            "words": (len(vocabulary) + 1, s.word), "grams": (s.buckets + 1, s.char), "x": (inputs, 6 * h), "x0": (6 * h,),
            "forth": (h, 3 * h), "back": (h, 3 * h), "a": (2 * h, s.attention), "a0": (s.attention,), "av": (s.attention,),
            "out": (2 * h,), "out0": (1,),
        }
        spread = {"words": 0.1, "grams": 0.1, "x": inputs**-0.5, "forth": h**-0.5, "back": h**-0.5, "a": (2 * h) ** -0.5, "av": 0.3, "out": 0.3}
        self.weights = {k: (rng.normal(size=v) * spread.get(k, 0.0)).astype(np.float32) for k, v in sizes.items()}
        # The row of what is no gram stays zero.
        self.weights["grams"][-1] = 0

    def features(self, words: list[str]) -> Features:
        grams, sizes = char_grams(words, self.shape.buckets)
        return Features(np.array([self.vocabulary.get(w, 0) for w in words], dtype=np.int64), grams, sizes)

    def inputs(self, f: Features) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of the distinct words, and their part in all gates of both directions."""
        w = self.weights
        if not len(f.rows):
            return np.zeros((0, len(w["x"])), np.float32), np.zeros((0, len(w["x0"])), np.float32)
        starts = np.cumsum(f.sizes) - f.sizes
        placed = w["grams"][f.grams[:, 0]]
        for column in f.grams.T[1:]:
            placed += w["grams"][column]
        sums = np.add.reduceat(placed, starts, axis=0) / np.sqrt(f.sizes, dtype=np.float32)[:, None]
        x = np.hstack([w["words"][f.rows], np.tanh(sums)])
        return x, x @ w["x"] + w["x0"]

    @staticmethod
    def _run(gates: np.ndarray, there: np.ndarray | None, u: np.ndarray, keep: list | None = None) -> list[np.ndarray]:
        """States after each step over ``gates`` (steps, windows, 3 x hidden); steps that are not ``there`` change nothing."""
        hidden = len(u)
        state = np.zeros((gates.shape[1], hidden), np.float32)
        out = []
        for t, g in enumerate(gates):
            s = state @ u
            zr = 1 / (1 + np.exp(-(g[:, : 2 * hidden] + s[:, : 2 * hidden])))
            z, r = zr[:, :hidden], zr[:, hidden:]
            n = np.tanh(g[:, 2 * hidden :] + r * s[:, 2 * hidden :])
            new = n + z * (state - n)
            if there is not None:
                new = np.where(there[t, :, None], new, state)
            if keep is not None:
                keep.append((state, z, r, n, s[:, 2 * hidden :]))
            state = new
            out.append(state)
        return out

    def logits(self, gates: np.ndarray, there: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        """Of windows, from ``gates`` (steps, windows, 6 x hidden)."""
        w, h = self.weights, self.shape.hidden
        kept_f, kept_b = ([], []) if keep is not None else (None, None)
        forth = self._run(gates[:, :, : 3 * h], there, w["forth"], kept_f)
        back = self._run(gates[::-1, :, 3 * h :], None if there is None else there[::-1], w["back"], kept_b)[::-1]
        states = np.concatenate([np.stack(forth), np.stack(back)], axis=2)
        u = np.tanh(states @ w["a"] + w["a0"])
        e = u @ w["av"]
        if there is not None:
            e = np.where(there, e, -np.inf)
        share = np.exp(e - e.max(axis=0))
        share /= share.sum(axis=0)
        pooled = (share[:, :, None] * states).sum(axis=0)
        if keep is not None:
            keep.update(forth=kept_f, back=kept_b, states=states, u=u, share=share, pooled=pooled)
        return pooled @ w["out"] + w["out0"][0]

    def gradients(self, f: Features, index: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over windows; ``index`` (windows, steps) names distinct words, -1 where there is none."""
        w, h, keep = self.weights, self.shape.hidden, {}
        x, own = self.inputs(f)
        there = index.T >= 0
        gates = own[np.where(there, index.T, 0)]
        logit = self.logits(gates, there, keep)
        out = {}
        d = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        out["out"], out["out0"] = keep["pooled"].T @ d, d.sum(keepdims=True)
        d_pooled = d[:, None] * w["out"]
        states, share, u = keep["states"], keep["share"], keep["u"]
        d_share = (states * d_pooled).sum(axis=2)
        d_e = share * (d_share - (share * d_share).sum(axis=0))
        d_u = d_e[:, :, None] * w["av"] * (1 - u * u)
        out["av"] = (u * d_e[:, :, None]).sum(axis=(0, 1))
        out["a"], out["a0"] = np.tensordot(states, d_u, ((0, 1), (0, 1))), d_u.sum(axis=(0, 1))
        d_states = share[:, :, None] * d_pooled + d_u @ w["a"].T
        d_gates = np.zeros_like(gates)
        for name, part, kept, order in (
            ("forth", slice(0, h), keep["forth"], range(len(gates))),
            ("back", slice(h, 2 * h), keep["back"], range(len(gates) - 1, -1, -1)),
        ):
            u_, d_u_ = w[name], np.zeros_like(w[name])
            d_state = np.zeros((len(y), h), np.float32)
            for (before, z, r, n, s), t in zip(kept[::-1], list(order)[::-1], strict=True):
                d_state = d_state + d_states[t, :, part]
                here = there[t][:, None]
                d_new = d_state * here
                d_n = d_new * (1 - z) * (1 - n * n)
                d_z = d_new * (before - n) * z * (1 - z)
                d_r = d_n * s * r * (1 - r)
                d_gates[t, :, 3 * part.start : 3 * part.stop] = np.hstack([d_z, d_r, d_n])
                d_s = np.hstack([d_z, d_r, d_n * r])
                d_u_ += before.T @ d_s
                d_state = d_state * ~here + d_new * z + d_s @ u_.T
            out[name] = d_u_
        d_own = np.zeros_like(own)
        np.add.at(d_own, index.T[there], d_gates[there])
        out["x"], out["x0"] = x.T @ d_own, d_own.sum(axis=0)
        d_x = d_own @ w["x"].T
        out["words"], out["grams"] = np.zeros_like(w["words"]), np.zeros_like(w["grams"])
        np.add.at(out["words"], f.rows, d_x[:, : self.shape.word])
        char = x[:, self.shape.word :]
        d_sums = d_x[:, self.shape.word :] * (1 - char * char) / np.sqrt(f.sizes, dtype=np.float32)[:, None]
        d_placed = np.repeat(d_sums, f.sizes, axis=0)
        for column in f.grams.T:
            np.add.at(out["grams"], column, d_placed)
        out["grams"][-1] = 0
        return out

    def windows(self, texts: list[list[str]], own: Projections, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """A row for every text: the greatest logit of its windows, their mean, and the logarithm of their number; and the
        start of the first window with the greatest. Texts without words have minus infinity."""
        size = self.shape.window
        index = own.index(texts)
        of, first, logit = [], [], []
        whole = [n for n, words in enumerate(index) if len(words) >= size]
        starts = [windows_of(len(index[n]), self.shape) for n in whole]
        if whole:
            flat, count = np.concatenate([index[n] for n in whole]), [len(x) for x in starts]
            base = np.cumsum([0, *[len(index[n]) for n in whole]])[:-1]
            of, first = np.repeat(whole, count), np.concatenate(starts)
            at = first + np.repeat(base, count)
            for low in range(0, len(at), block):
                rows = flat[at[low : low + block, None] + np.arange(size)]
                logit.append(self.logits(own.gates[rows.T], None))
        # Texts shorter than a window, those of like length together.
        short = sorted((n for n, words in enumerate(index) if 0 < len(words) < size), key=lambda n: len(index[n]))
        for low in range(0, len(short), block):
            part = short[low : low + block]
            rows = np.full((len(index[part[-1]]), len(part)), -1)
            for column, n in enumerate(part):
                rows[: len(index[n]), column] = index[n]
            logit.append(self.logits(own.gates[np.maximum(rows, 0)], rows >= 0))
        of = np.concatenate([of, short]).astype(np.int64)
        first = np.concatenate([first, np.zeros(len(short))]).astype(np.int64)
        logit = np.concatenate([*logit, []])
        count = np.bincount(of, minlength=len(texts))
        best, start = np.full(len(texts), -np.inf), np.zeros(len(texts), dtype=np.int64)
        order = np.lexsort((first, -logit, of))
        leads = order[np.concatenate([[True], of[order][1:] != of[order][:-1]])[: len(order)]]
        best[of[leads]], start[of[leads]] = logit[leads], first[leads]
        mean = np.bincount(of, logit, len(texts)) / np.maximum(1, count)
        return np.stack([best, mean, np.log(np.maximum(1, count))], axis=1), start

    def probability(self, facts: np.ndarray) -> np.ndarray:
        """Of label 1, by the rows of ``windows``; texts without words have zero."""
        filled = np.isfinite(facts[:, 0])
        raw = np.where(filled[:, None], facts, 0.0) @ self.scale + self.shift
        return np.where(filled, 1 / (1 + np.exp(-np.clip(raw, -50, 50))), 0.0)


class Projections:
    """The gates' inputs of the words met so far, forgotten when they are more than ``remembered``."""

    def __init__(self, network: Network, remembered: int = 100_000):
        self.network, self.remembered = network, remembered
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.gates = np.zeros((0, 6 * self.network.shape.hidden), np.float32)

    def index(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of ``gates`` for each word."""
        if len(self.places) > self.remembered:
            self._forget()
        places = self.places
        new = list(dict.fromkeys(w for words in texts for w in words if w not in places))
        if new:
            for at, word in enumerate(new, len(places)):
                places[word] = at
            if len(places) > len(self.gates):
                grown = np.zeros((2 * len(places), self.gates.shape[1]), np.float32)
                grown[: len(self.gates)] = self.gates
                self.gates = grown
            self.gates[len(places) - len(new) : len(places)] = self.network.inputs(self.network.features(new))[1]
        return [np.array([places[w] for w in words], dtype=np.int64) for words in texts]


def _hint(texts: list[list[str]], y: np.ndarray, shape: Shape) -> list[int]:
    """A first guess of each text's worst window: that with the words whose grams speak most for label 1."""
    words = list(dict.fromkeys(w for own in texts for w in own))
    place = {w: i for i, w in enumerate(words)}
    grams, sizes = char_grams(words, shape.buckets)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    index = [np.array([place[w] for w in own], dtype=np.int64) for own in texts]
    seen = np.zeros((2, shape.buckets + 1))
    for own, label in zip(index, y, strict=True):
        distinct = np.unique(own)
        held = [grams[starts[w] : starts[w + 1]].ravel() for w in distinct.tolist()]
        if held:
            seen[int(label), np.unique(np.concatenate(held))] += 1
    total = [max(1, int((y == k).sum())) for k in (0, 1)]
    odds = np.log((seen[1] + 0.5) / (total[1] + 1)) - np.log((seen[0] + 2) / (total[0] + 4))
    odds[-1] = 0
    speaks = np.maximum.reduceat(odds[grams].max(axis=1), starts[:-1]) if words else np.zeros(0)
    out = []
    for own in index:
        first = windows_of(len(own), shape)
        sums = np.concatenate([[0.0], np.cumsum(np.maximum(0, speaks[own] - 1) ** 2)])
        out.append(int(first[(sums[np.minimum(first + shape.window, len(own))] - sums[first]).argmax()]) if len(first) else 0)
    return out


def fit_network(
    texts: list[list[str]],
    y: np.ndarray,
    shape: Shape = Shape(),  # noqa: B008
    *,
    rounds: int = 8,
    passes: int = 1,
    batch: int = 64,
    rate: float = 0.02,
    least: int = 3,
    most: int = 20_000,
    seed: int = 7,
) -> Network:
    """Adam over the worst window of every text of label 1, and over windows of three times as many texts of label 0.

    Each of the ``rounds`` begins by choosing the worst windows anew. Words are learned that ``least`` texts have, ``most`` at most. With one label only, or none, the score is its smoothed share for every text.
    """
    rng = np.random.default_rng(seed)
    held = Counter(w for words in texts for w in set(words))
    chosen = sorted((w for w, n in held.items() if n >= least), key=lambda w: (-held[w], w))[:most]
    network = Network(shape, {w: i for i, w in enumerate(chosen, 1)}, seed)
    filled = np.array([len(words) > 0 for words in texts], dtype=bool)
    if not filled.any() or y[filled].min() == y[filled].max():
        share = (y.sum() + 1) / (len(y) + 2)
        network.scale, network.shift = np.zeros(3), float(np.log(share / (1 - share)))
        return network
    starts = np.array(_hint(texts, y, shape))
    # A tenth of the texts only settles how logits become probabilities.
    kept = filled & (np.arange(len(texts)) % 10 == 0)
    if y[kept].min(initial=1) == y[kept].max(initial=0):
        kept = filled
    learned = filled if kept is filled else filled & ~kept
    bad, good = np.flatnonzero(learned & (y == 1)), np.flatnonzero(learned & (y == 0))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in network.weights.items()}
    step = 0
    for epoch in range(rounds * passes):
        if epoch == 0:
            logit = rng.normal(size=len(texts))
        elif epoch % passes == 0:
            facts, starts = network.windows(texts, Projections(network))
            logit = facts[:, 0]
        # As many good texts as three times the bad ones: the worst third, and others at random windows.
        hard = good[np.argsort(-logit[good], kind="stable")][: len(bad)]
        other = rng.choice(good, min(len(good), 2 * len(bad)), replace=False)
        drawn = [(n, starts[n], 1.0) for n in np.repeat(bad, max(1, 400 // len(bad)))] + [(n, starts[n], 0.0) for n in hard]
        drawn += [(n, int(rng.integers(0, max(1, len(texts[n]) - shape.window + 1))), 0.0) for n in other]
        order = rng.permutation(len(drawn))
        for low in range(0, len(order), batch):
            part = [drawn[i] for i in order[low : low + batch]]
            parts = [texts[n][a : a + shape.window] for n, a, _ in part]
            # One word in ten is read as one that was not learned.
            words = list(dict.fromkeys(w for p in parts for w in p))
            place = {w: i for i, w in enumerate(words)}
            index = np.full((len(part), max(map(len, parts))), -1)
            for row, p in enumerate(parts):
                index[row, : len(p)] = [place[w] for w in p]
            f = network.features(words)
            f = f._replace(rows=np.where(rng.random(len(words)) < 0.1, 0, f.rows))
            step += 1
            for k, d in network.gradients(f, index, np.array([label for *_, label in part], np.float32)).items():
                m, v = moments[k]
                m += 0.1 * (d - m)
                v += 0.01 * (d * d - v)
                now = rate * (1 - epoch / (rounds * passes))
                network.weights[k] -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    facts, _ = network.windows(texts, Projections(network))
    network.scale, network.shift = _calibrated(facts[kept], y[kept])
    return network


def _calibrated(facts: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Logistic regression of the labels on ``windows`` by Newton's method, slightly held back towards the greatest logit."""
    x = np.hstack([facts, np.ones((len(facts), 1))])
    start = np.array([1.0, 0.0, 0.0, 0.0])
    w = start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + (w - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(4), slope)
        w -= step * min(1.0, 0.2 / max(1e-9, float(np.abs(step).max())))
    return w[:3], float(w[3])


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = 5000,
    max_chars: int = 20_000,
    shape: Shape = Shape(),  # noqa: B008
) -> Network:
    """Fits on at most ``max_rows`` labelled texts of at most ``max_chars`` characters, those with the smallest hash of the id.

    Rows with a null id, label or text are not used; an id with several labels or texts counts once for each pair. The
    sample is fitted in one task, and only the network reaches the driver.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        labels = np.array([float(row["__label"] > 0) for row in rows])
        network = fit_network([words_of(row["__text"]) for row in rows], labels, shape)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], names=["network"])

    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("__label"))
    known = known.where("doc_id IS NOT NULL AND __label IS NOT NULL").withColumn("__hash", hashed("doc_id"))
    # About twice as many rows as wanted go on, from however many tasks.
    known = known.where(F.col("__hash") < hash_share(2 * max_rows / max(1, known.count())))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    rows = rows.where(F.col("__text").isNotNull() & (F.length("__text") <= max_chars)).join(known, "doc_id")
    rows = rows.orderBy("__hash", "doc_id", "__label", "__text").limit(max_rows).select("__label", "__text")
    found = rows.coalesce(1).mapInArrow(fit, "network binary").collect()
    return pickle.loads(found[0].network) if found else fit_network([], np.zeros(0), shape)


def with_toxicity(docs: DataFrame, network: Network, *, id_col: str = "doc_id", text_col: str = "text", rows: int = 256) -> DataFrame:
    """``doc_id`` and ``score`` of every row, from all windows of its whole text. Null counts as the empty text, whose score is 0.

    The network, a few megabytes whatever the input, is broadcast. Nothing is shuffled; a task scores
    ``rows`` texts at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Projections(shared.value)
        for batch in (part.slice(at, rows) for part in batches for at in range(0, part.num_rows, rows)):
            texts = [words_of(t) for t in batch.column("__text").to_pylist()]
            found = shared.value.probability(shared.value.windows(texts, own)[0])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    rows_ = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    return rows_.mapInArrow(score, f"doc_id {dict(rows_.dtypes)['doc_id']}, score double")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 4) == 2
    network = train_toxicity(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = with_toxicity(docs, network)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
