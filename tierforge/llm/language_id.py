"""Language identification by nearest centroid.

A text becomes a normalised TF-IDF vector over hashed byte bigrams and trigrams of its lower-cased
words. Each language has several centroids, found by spherical k-means. The nearest by
cosine gives the language; what is too far from it is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierforge.llm.common import ROW_KEY, hash_share, hashed, keyed, remainder, table

DIMENSIONS = 1 << 13
_BLOCK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
# ASCII other than letters counts as space.
_WORDS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(128)) + bytes(range(128, 256))
UNKNOWN = "und"


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed grams of the whole text, in blocks."""
    data = b" ".join(text.lower().encode("utf-8", "replace").translate(_WORDS).split())
    data = np.frombuffer(b" " + data + b" ", dtype=np.uint8)
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    for at in range(0, len(data) - 1, _BLOCK):
        part = data[at : at + _BLOCK + 2].astype(np.uint32)
        two = (part[:-1] << 8) | part[1:]
        three = (two[:-1] << 8) | part[2:]
        two = two[:_BLOCK]
        for grams, factor in ((two, 0x9E3779B1), (three[:_BLOCK], 0x85EBCA6B)):
            counts += np.bincount((grams * np.uint32(factor)) >> np.uint32(19), minlength=DIMENSIONS)
    return counts


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(norms == 0, 1, norms)


class CentroidModel(NamedTuple):
    languages: list[str]
    of_centroid: np.ndarray
    centroids: np.ndarray
    least: np.ndarray
    idf: np.ndarray

    def vector(self, text: str) -> np.ndarray:
        return _unit(np.log1p(gram_counts(text)) * self.idf).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine with the nearest centroid, and whether it is too small."""
        if text is None or not self.languages or _LETTER.search(text) is None:
            return UNKNOWN, 0.0, True
        cosines = self.centroids @ self.vector(text)
        best = int(cosines.argmax())
        cosine = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[self.of_centroid[best]], cosine, bool(cosine < self.least[best])


def _clusters(rows: np.ndarray, number: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from rows far from each other."""
    chosen = [_unit(rows.mean(axis=0))]
    nearest = rows @ chosen[0]
    while len(chosen) < min(number, len(rows)):
        chosen.append(rows[int(nearest.argmin())])
        nearest = np.maximum(nearest, rows @ chosen[-1])
    centroids = np.array(chosen)
    for _ in range(rounds):
        own = (rows @ centroids.T).argmax(axis=1)
        sums = np.array([rows[own == k].sum(axis=0) if (own == k).any() else centroids[k] for k in range(len(centroids))])
        centroids = _unit(sums)
    return centroids


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [gram_counts(t).astype(np.float32) for t in batch.column("__text").to_pylist()]
        sparse = [np.flatnonzero(c).astype(np.uint16).tobytes() for c in packed]
        values = [c[c > 0].tobytes() for c in packed]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(sparse, pa.binary()), pa.array(values, pa.binary())],
            names=["lang", "places", "counts"],
        )


def fit_language_model(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = 400,
    centroids_per_language: int = 4,
    slack: float = 0.1,
) -> CentroidModel:
    """Fits on at most ``rows_per_language`` labelled rows of each language.

    The rows are those with the smallest hash of the id, so the sample depends on nothing else. Rows without language or
    letters are not used. Only their sparse gram counts reach the driver. A
    text is rejected below ``slack`` times the cosine that all but one in a hundred of the
    centroid's own rows reach. Without labelled rows the model knows no language.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.col(text_col) != ""))
    rows = keyed(
        labelled,
        F.col(id_col).alias("id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("__text"),
    )
    names = rows.select(hashed("id").alias("hash"), "id", "lang", *ROW_KEY)
    # About twice as many rows as wanted are ranked, from however many tasks. One row for each language is broadcast.
    share = rows.groupBy("lang").agg(hash_share(2.0 * rows_per_language / F.count(F.lit(1))).alias("bound"))
    names = names.join(F.broadcast(share), "lang").where("hash <= bound")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "id", *ROW_KEY))
    chosen = names.withColumn("rank", rank).where(F.col("rank") <= rows_per_language).select(*ROW_KEY)
    # Bounded by the number of languages times rows_per_language, at 16 bytes a row.
    sample = rows.join(F.broadcast(chosen), list(ROW_KEY)).select("lang", "__text")
    counted = sample.mapInArrow(_counted, "lang string, places binary, counts binary").collect()
    counted = sorted((r.lang, bytes(r.places), bytes(r.counts)) for r in counted)
    rows = [(lang, np.frombuffer(p, np.uint16), np.frombuffer(c, np.float32)) for lang, p, c in counted]

    seen = np.zeros(DIMENSIONS)
    for _, places, _ in rows:
        seen[places] += 1
    idf = (np.log((1 + len(rows)) / (1 + seen)) + 1).astype(np.float32)
    languages = sorted({lang for lang, _, _ in rows})
    of_centroid, centroids, least = [], [], []
    for number, language in enumerate(languages):
        own = [(p, c) for lang, p, c in rows if lang == language]
        vectors = np.zeros((len(own), DIMENSIONS), dtype=np.float32)
        for i, (places, counts) in enumerate(own):
            vectors[i, places] = np.log1p(counts) * idf[places]
        vectors = _unit(vectors)
        found = _clusters(vectors, centroids_per_language)
        cosines = vectors @ found.T
        nearest = cosines.argmax(axis=1)
        for k in range(len(found)):
            mine = cosines[nearest == k, k]
            of_centroid.append(number)
            centroids.append(found[k])
            least.append(slack * float(np.quantile(mine, 0.01)) if len(mine) else 0.0)
    return CentroidModel(
        languages,
        np.array(of_centroid, dtype=int),
        np.array(centroids, dtype=np.float32).reshape(-1, DIMENSIONS),
        np.array(least),
        idf,
    )


def language_of(spark: SparkSession, model: CentroidModel, text: str | Column) -> Column:
    """Struct ``lang``, ``score``, ``rejected`` of each whole text.

    Null and texts without a letter are ``und``, score zero, rejected. The model is a few hundred kilobytes per
    language, whatever the input.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(t) for t in texts]
        return pd.DataFrame(found, columns=["lang", "score", "rejected"])

    return predicted(text)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = fit_language_model(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language_of(spark, model, "text").alias("found"))
    return found.select(
        "doc_id",
        "held_out",
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.rejected").alias("rejected"),
    )
