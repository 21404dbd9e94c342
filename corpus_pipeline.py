"""A training corpus from raw documents, in five stages that each call one operator.

A stage takes (spark, docs, sf_dir) and gives the rows that the next one works
on; all but the last give the columns of ``documents``, whatever other columns there
are. Rows without doc_id, rows that share one, and null or empty texts are documents like any others: they
pass through every stage that does not reject their text. An empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import jaccard, lines, packing, substrings, toxicity
from sigloom.llm.shared import bounded, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(docs: DataFrame, changed, text) -> DataFrame:
    """``docs`` with another text, and its length, where ``changed``."""
    return docs.withColumn("text", F.when(changed, text).otherwise(F.col("text"))).withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own (row) for each row, written so that it stays the same."""
    bounded(docs.sparkSession)
    return written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity classifier rejects; texts alone decide, so copies go or stay together."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the multi-line chunks that stand in the corpus before.

    Rows that repeat doc_id and text are one occurrence; the next stage takes them for copies.
    """
    out = lines.remove_repeated_chunks(docs, keep=("text", "lang", "source", "n_chars"))
    return _with_text(out, F.col("n_removed") > 0, F.col("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word similarity of 0.8 or more.

    That of the smallest doc_id stays; of several such, or of rows without doc_id alone, the first row. Texts without words are linked with nothing.
    """
    rows = _numbered(docs)
    found = jaccard.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), size=5, num=80, den=100)
    found = written(found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component")), "components")
    # only components of several rows lose some
    several = found.where("row <> component").select("component").distinct()
    inside = written(found.join(several, "component").join(rows.select("row", "doc_id"), "row"), "inside")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    stays = inside.groupBy("component").agg(F.min(order)["row"].alias("row"))
    gone = inside.select("row").join(stays.select("row"), "row", "left_anti")
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages of fifty words or more that stand elsewhere too."""
    rows = _numbered(docs)
    out = substrings.remove_repeats(rows.select(F.col("row").alias("doc_id"), "text"), span=50, keep_text=True)
    changed = out.where("n_removed > 0").select(F.col("doc_id").alias("row"), "kept")
    return _with_text(rows.join(changed, "row", "left"), F.col("kept").isNotNull(), F.col("kept"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 1024: one row per piece; repeated rows are packed each, a null text as an empty one."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("best-fit packing", pack),
]

#: Learning, chunk boundaries and merging tokens can't be said in SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
