"""Raw documents to packed sequences: language, copies, near copies, benchmark leaks, packing.

Every stage takes a stored table of documents and works on all of it. All but the last
return the columns of ``documents``, whatever further columns they find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import ROW_KEY, keyed, remainder, stored
from tierforge.llm.decontamination import contained_items
from tierforge.llm.exact_dedup import exact_dedup, fresh_index
from tierforge.llm.language_id import fit_language_model, language_of
from tierforge.llm.packing import pack_documents
from tierforge.llm.simhash import near_duplicates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _stay(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (with ``ROW_KEY`` and ``kept``) keeps."""
    kept = decided.where("kept").select(*ROW_KEY)
    return keyed(docs, *COLUMNS).join(kept, list(ROW_KEY), "left_semi").select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language is rejected: no letter, or like none that was learned."""
    model = fit_language_model(docs.where(remainder("doc_id", 4) != 2))
    found = docs.select(*COLUMNS, language_of(spark, model, "text").alias("__found"))
    return found.where("NOT __found.rejected").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text, that with the smallest id."""
    docs = docs.select(*COLUMNS)
    index = fresh_index(spark)
    decided = exact_dedup(docs, index, keep_key=True)
    index.drop_entry()
    return _stay(docs, decided)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints, that with the smallest id."""
    docs = docs.select(*COLUMNS)
    return _stay(docs, near_duplicates(docs, keep_key=True))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = docs.select(*COLUMNS)
    for number, hits in enumerate(contained_items(spark, benchmark, F.col("text"))):
        name = f"__hits_{number}"
        out = out.withColumn(name, hits).where(F.size(name) == 0).drop(name)
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; see ``pack_documents``."""
    return pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("leaks", drop_leaks),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``STAGES`` one after the other, from the table ``documents``, each on what the last one stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
