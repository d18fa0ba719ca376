"""Exact de-duplication by a persistent digest index.

The index is a Parquet table, bucketed and sorted by the SHA-256 digest of the normalised
text. New data are reduced to one row per digest, matched with the index by a sort-merge
anti-join that leaves the index unshuffled, and what is new is appended.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import ROW_KEY, keyed, stored, table, text_or_empty
from tierforge.session import scratch_path

BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


class DigestIndex:
    """Digests seen so far, the id of the row that was kept for each and the batch it came with.

    ``buckets`` is fixed when the table is made: about index bytes / 256 MB. Adding the
    same data twice changes nothing. A failed run can be repeated under the name of its batch:
    digests of that batch count as new again, so its rows are kept again. Runs that
    add must not overlap.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    def _append(self, df: DataFrame) -> None:
        # As many shuffle partitions as buckets, dealt by the same hash: one file a bucket.
        (
            df.select("digest", "keep_id", "batch")
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def rows(self, id_type: str = "bigint") -> DataFrame:
        if not self.spark.catalog.tableExists(self.name):
            self._append(self.spark.createDataFrame([], f"digest binary, keep_id {id_type}, batch string"))
        elif "batch" not in self.spark.table(self.name).columns:  # made before batches had names
            self.spark.sql(f"ALTER TABLE `{self.name}` ADD COLUMNS (batch string)")
        return self.spark.table(self.name)

    def add(self, groups: DataFrame, batch: str) -> DataFrame:
        """Appends the unseen digests of ``groups`` (``digest``, ``keep_id``; one row each).

        Returns ``groups`` with the index's ``keep_id`` and whether the digest ``is_new``:
        unseen, or added by this ``batch`` before.
        """
        known = self.rows(dict(groups.dtypes)["keep_id"])
        fresh = stored(groups.join(known.hint("merge"), "digest", "left_anti"), "fresh")
        old = groups.drop("keep_id").join(known.hint("merge"), "digest")
        old = old.withColumn("is_new", F.coalesce(F.col("batch") == batch, F.lit(False))).drop("batch")
        resolved = stored(
            fresh.withColumn("is_new", F.lit(True)).unionByName(old), "resolved"
        )
        self._append(fresh.withColumn("batch", F.lit(batch)))
        return resolved

    def drop_entry(self) -> None:
        """Removes the catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")


def _shares(digests: DataFrame, parts: int) -> list[DataFrame]:
    """``digests`` by rising ``doc_id``, rows of one id together, null ids last."""
    if parts == 1:
        return [digests]
    bounds = sorted(set(digests.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.01)))
    number = sum((F.coalesce(F.col("doc_id").cast("double") > b, F.lit(True)).cast("int") for b in bounds), F.lit(0))
    return [digests.where(number == i) for i in range(len(bounds) + 1)]


def exact_dedup(
    docs: DataFrame,
    index: DigestIndex,
    *,
    batch: str | None = None,
    parts: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_key: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when equal after every run of ASCII white space became one space; null
    is the empty text. Of equal texts the smallest id stays, a null id last; of rows
    that repeat an id, the one that comes first in its file. A text the index already holds keeps the index's
    ``keep_id``, and none of its new rows stays. ``group_size`` counts rows of ``docs``.
    Other columns are ignored. An empty table gives no row. ``keep_key`` adds ``ROW_KEY``.

    ``batch`` names the run, so that it can be repeated if it fails before its result is written;
    without it every call is a batch of its own. With ``parts`` above 1 (numeric ids) the rows are
    added to the index in about as many equal shares, smaller ids first; the result is the same.

    Groups are counted map side first, so a text that a third of all rows share costs
    no more than others; the last join lies directly on two shuffles, which AQE can split, and broadcasts nothing.
    """
    digests = stored(
        keyed(
            docs,
            F.col(id_col).alias("doc_id"),
            F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"),
        ),
        "digests",
    )
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", *ROW_KEY)
    batch = uuid.uuid4().hex if batch is None else batch
    added = []
    for share in _shares(digests, parts):
        groups = share.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
        added.append(index.add(stored(groups.withColumn("keep_id", F.col("first.doc_id")), "groups"), batch))
    resolved = reduce(DataFrame.unionByName, added)
    if len(added) > 1:
        # All shares have the index's keep_id; the smallest first row is of the share that brought the digest.
        # Stored, so that the last join lies directly on two shuffles here too.
        whole = resolved.groupBy("digest").agg(
            F.min("first").alias("first"),
            F.sum("group_size").alias("group_size"),
            F.min("keep_id").alias("keep_id"),
            F.max("is_new").alias("is_new"),
        )
        resolved = stored(whole, "whole")
    out = digests.join(resolved.hint("merge"), "digest")
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("is_new") & (order == F.col("first"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *(ROW_KEY if keep_key else ()),
    )


def fresh_index(spark: SparkSession, buckets: int = 64) -> DigestIndex:
    name = f"digest_index_{uuid.uuid4().hex}"
    return DigestIndex(spark, name, scratch_path(spark, name), buckets)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = fresh_index(spark)
    result = exact_dedup(table(spark, sf_dir, "documents"), index, parts=2)
    index.drop_entry()
    return result


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
