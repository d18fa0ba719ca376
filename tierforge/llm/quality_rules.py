"""Quality classifier: a sparse ensemble of rules over text statistics.

Small trees are grown on labelled rows; the path to each of their nodes is a conjunctive
rule. A lasso-penalised logistic regression weighs the rules, and those with a weight are compiled into
one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import hash_share, hashed, remainder, stored, table

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "punctuation", "exclamations", "symbols", "bars",
    "line_breaks", "blanks", "high_bytes", "distinct_words", "distinct_lines", "words_per_stop", "shouted_words", "line_length",
)
_BLOCK = 1 << 22
_CLASS = {
    "upper": range(65, 91),
    "digits": range(48, 58),
    "punctuation": [c for c in range(33, 127) if not chr(c).isalnum()],
    "exclamations": [33],
    "symbols": [ord(c) for c in "#$%&*@^~<>{}[]\\="],
    "bars": [124],
    "line_breaks": [10],
    "blanks": [32, 9, 10, 11, 12, 13],
    "high_bytes": range(128, 256),
}


def _pieces(data: bytes) -> Iterator[bytes]:
    """The text in blocks that end at a space."""
    at = 0
    while at < len(data):
        stop = len(data) if len(data) - at <= _BLOCK else data.rfind(b" ", at, at + _BLOCK) + 1
        stop = stop if stop > at else at + _BLOCK
        yield data[at:stop]
        at = stop


def statistics(data: bytes) -> list[float]:
    """``STATISTICS`` of a whole text; all zero for the empty one."""
    if not data:
        return [0.0] * len(STATISTICS)
    counts, words, letters, shouted = np.zeros(256), 0, 0, 0
    distinct: set[int] = set()
    for piece in _pieces(data):
        counts += np.bincount(np.frombuffer(piece, dtype=np.uint8), minlength=256)
        parts = piece.split()
        words += len(parts)
        letters += sum(map(len, parts))
        shouted += sum(map(bytes.isupper, parts))
        distinct.update(map(hash, parts))
    lines = data.split(b"\n")
    share = {name: float(counts[list(codes)].sum()) / len(data) for name, codes in _CLASS.items()}
    known = {
        **share,
        "log_bytes": np.log1p(len(data)),
        "log_words": np.log1p(words),
        "word_length": letters / max(1, words),
        "distinct_words": len(distinct) / max(1, words),
        "distinct_lines": len(set(lines)) / len(lines),
        "words_per_stop": words / (1.0 + counts[46]),
        "shouted_words": shouted / max(1, words),
        "line_length": np.log1p(len(data) / len(lines)),
    }
    return [float(known[name]) for name in STATISTICS]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``STATISTICS`` of every row; null counts as the empty text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text").cast(pa.binary()).to_pylist()
            rows = np.array([statistics(t or b"") for t in texts], dtype=float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(column) for column in rows.T]], names=["doc_id", *STATISTICS]
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(measure, f"doc_id {kind}, " + ", ".join(f"{name} double" for name in STATISTICS))


class Condition(NamedTuple):
    statistic: int
    above: bool
    threshold: float


class RuleModel(NamedTuple):
    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]]

    def column(self) -> Column:
        """Probability of label 1 as an expression over the columns ``STATISTICS``."""

        def holds(rule: tuple[Condition, ...]) -> Column:
            tests = [
                F.col(STATISTICS[c.statistic]) > c.threshold if c.above else F.col(STATISTICS[c.statistic]) <= c.threshold
                for c in rule
            ]
            return reduce(lambda a, b: a & b, tests)

        terms = [F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.intercept))))


def _holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= (x[:, c.statistic] > c.threshold) == c.above
    return out


def _paths(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, path=()) -> Iterator[tuple[Condition, ...]]:
    """Rules of a tree grown by squared error on a third of the statistics at each node."""
    if path:
        yield path
    if len(path) == depth or len(y) < 20 or y.min() == y.max():
        return
    best = (1e-9, None)
    total = y.sum()
    for s in rng.choice(x.shape[1], max(3, x.shape[1] // 3), replace=False):
        cuts = np.unique(np.quantile(x[:, s], np.linspace(0.02, 0.98, 33)))
        order = np.sort(x[:, s])
        sums = np.concatenate([[0], np.cumsum(y[np.argsort(x[:, s], kind="stable")])])
        left = np.searchsorted(order, cuts, side="right")
        ok = (left >= 5) & (left <= len(y) - 5)
        if not ok.any():
            continue
        n, t = left[ok], sums[left[ok]]
        gain = t**2 / n + (total - t) ** 2 / (len(y) - n) - total**2 / len(y)
        if gain.max() > best[0]:
            best = (gain.max(), Condition(int(s), False, float(cuts[ok][gain.argmax()])))
    if best[1] is None:
        return
    for above in (False, True):
        step = best[1]._replace(above=above)
        inside = _holds((step,), x)
        yield from _paths(x[inside], y[inside], rng, depth, (*path, step))


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 300) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient; the intercept is free."""
    n, k = z.shape
    full = np.hstack([np.ones((n, 1)), z])
    step = 4 * n / max(np.linalg.norm(full.T @ full, 2), 1e-9)
    w = np.zeros(k + 1)
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ ahead, -30, 30)))
        new = ahead - step * (full.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_next * (new - w)
        w, t = new, t_next
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, *, trees: int = 24, depth: int = 3, penalty: float = 0.001, seed: int = 7) -> RuleModel:
    """Without rows the score is one half; with one class only, its smoothed share."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))), [])
    rng = np.random.default_rng(seed)
    rules: dict[bytes, tuple[Condition, ...]] = {}
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        for rule in _paths(x[rows], y[rows], rng, depth):
            held = _holds(rule, x)
            if 0 < held.sum() < len(y):
                rules.setdefault(np.packbits(held).tobytes(), rule)
    chosen = list(rules.values())
    z = np.array([_holds(rule, x) for rule in chosen], dtype=float).T.reshape(len(y), len(chosen))
    spread = z.std(axis=0)
    intercept, weights = _lasso((z - z.mean(axis=0)) / spread, y, penalty)
    weights = weights / spread
    intercept -= float(weights @ z.mean(axis=0))
    return RuleModel(intercept, [(rule, float(w)) for rule, w in zip(chosen, weights, strict=True) if w])


def train_quality(
    measured: DataFrame, labels: DataFrame, *, label_col: str = "quality", max_rows: int = 8000
) -> RuleModel:
    """Fits on at most ``max_rows`` labelled rows, those with the smallest hash of the id.

    ``measured`` has ``doc_id`` and ``STATISTICS``. Rows with a null id or label are not used;
    an id that has several labels or several texts counts once for each pair.
    """
    known = labels.select("doc_id", F.col(label_col).cast("double").alias("__label"))
    known = known.where("doc_id IS NOT NULL AND __label IS NOT NULL").withColumn("__hash", hashed("doc_id"))
    # About twice as many rows as wanted go on, from however many tasks.
    known = known.where(F.col("__hash") < hash_share(2 * max_rows / max(1, known.count())))
    rows = measured.join(known, "doc_id").orderBy("__hash", "doc_id", "__label", *STATISTICS).limit(max_rows)
    found = np.array([tuple(r) for r in rows.select("__label", *STATISTICS).collect()], dtype=float)
    found = found.reshape(-1, len(STATISTICS) + 1)
    return fit_rules(found[:, 1:], found[:, 0])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 5) == 0
    measured = stored(with_statistics(table(spark, sf_dir, "documents")), "statistics")
    labels = table(spark, sf_dir, "labels").where(~held_out)
    score = train_quality(measured, labels).column()
    scored = measured.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
