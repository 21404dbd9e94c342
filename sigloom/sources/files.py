"""Files as relations: listings, contents, lines, CSV parts and JSON items."""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigloom.functions import scalars as S
from sigloom.operators.order import head, with_ordinal

ITEM = T.StructType([T.StructField("part_id", T.StringType()), T.StructField("group", T.StringType()), T.StructField("weight", T.DoubleType()), T.StructField("category", T.StringType()), T.StructField("description", T.StringType())])
PREFIX = 300_000


def normalised_suffixes(suffixes: Sequence[str], ignore_case: bool = True) -> list[str]:
    """Stripped, with a dot, each once, longest first."""
    found = [s.strip() for s in suffixes]
    found = [s if s.startswith(".") else "." + s for s in found if s]
    found = [s.lower() if ignore_case else s for s in found]
    return sorted(dict.fromkeys(found), key=lambda s: (-len(s), s))


def scan(spark: SparkSession, root: str, suffixes: Sequence[str] = S.CAD_SUFFIXES) -> DataFrame:
    """rel, path, length, modified of the files below ``root`` with one of the suffixes. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    base = root.split("://")[-1].rstrip("/")
    rel = F.substring_index(F.regexp_replace("path", "^[a-z]+:/+", "/"), base + "/", -1)
    return files.where(S.has_suffix(F.col("path"), suffixes)).select(rel.alias("rel"), "path", "length", "modified")


def preorder() -> list:
    """Sort keys of a walk that takes a directory's own files before its sub-directories."""
    return [S.directories(F.col("rel")), S.file_name(F.col("rel"))]


def discover(spark: SparkSession, root: str, subset_n: int | None = None, subset_frac: float | None = None, suffixes: Sequence[str] = S.CAD_SUFFIXES) -> DataFrame:
    """The scan's head in walking order; an empty folder gives no rows whatever the limit."""
    files = scan(spark, root, suffixes)
    if subset_n is None and subset_frac is None:
        return files
    return head(files, preorder(), subset_n, subset_frac)


def items(files: DataFrame) -> DataFrame:
    """Planner rows: payload_ref, weight, metadata, index."""
    rows = with_ordinal(files, preorder(), "index")
    rel = F.col("rel")
    return rows.select(rel.alias("payload_ref"), S.size_weight(F.col("length")).alias("weight"), F.create_map(F.lit("rel_path"), rel, F.lit("source_dataset"), S.dataset(rel), F.lit("size"), F.col("length").cast("string")).alias("metadata"), "index")


def describe(spark: SparkSession, root: str, suffixes: Sequence[str] = S.CAD_SUFFIXES, timestamp_source: str = "header", compat: bool = False) -> DataFrame:
    """Per file rel, content_hash and the columns of its metadata, from one read of its content.

    ``timestamp_source`` is header, mtime or none and says where created_at is from.
    Undecodable bytes of the header become replacement characters.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).where(S.has_suffix(F.col("path"), suffixes))
    base = root.split("://")[-1].rstrip("/")
    rel = F.substring_index(F.regexp_replace("path", "^[a-z]+:/+", "/"), base + "/", -1)
    rows = files.select(rel.alias("rel"), "path", "length", "modificationTime", "content").withColumn("file_ext", S.extension(F.col("rel")))
    rows = rows.withColumn("format", S.format_class(F.col("file_ext")))
    text = F.when((F.col("format") == "STEP") & (F.col("file_ext") != ".stpz"), F.decode(F.substring("content", 1, PREFIX), "UTF-8"))
    rows = rows.select("*", *(c.alias(k) for k, c in S.header_fields(text, compat).items()))
    mtime = F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    created = {"header": F.col("created_at_header"), "mtime": mtime, "none": F.lit(None).cast("string")}[timestamp_source]
    return rows.select(
        "rel", S.dataset(F.col("rel")).alias("source_dataset"), S.repository(F.col("rel")).alias("repo"), F.sha2("content", 256).alias("content_hash"), "file_ext", "format",
        F.col("length").alias("file_size_bytes"), mtime.alias("file_mtime_utc"), "step_schema", "originating_system", "author", "created_at_header",
        S.kernel(F.col("format"), F.col("originating_system")).alias("kernel"), created.alias("created_at"), F.lit(timestamp_source).alias("timestamp_source"), F.col("path").alias("abs_path"),
    )


def read_items(spark: SparkSession, path: str, schema: T.StructType = ITEM) -> DataFrame:
    """A JSON array of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_csv_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All CSV files of a folder as text columns of ``schema``: empty and vanished ones give no rows, broken lines nulls."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("ignoreMissingFiles", True).option("enforceSchema", False).option("pathGlobFilter", "*.csv").csv(path)


@F.pandas_udf(T.StringType())
def _decoded(content: pd.Series) -> pd.Series:
    def text(raw):
        if raw is None:
            return None
        try:
            return raw.decode("gb18030")
        except UnicodeDecodeError:
            return raw.decode("latin-1")

    return content.map(text)


def lines(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """rel, line (from 1) and text of all matching files: as UTF-8 where that is valid, else GB18030 where that is, else Latin-1.

    Every line comes once. A file is one value here; split larger ones beforehand.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    base = root.split("://")[-1].rstrip("/")
    rel = F.substring_index(F.regexp_replace("path", "^[a-z]+:/+", "/"), base + "/", -1)
    utf8 = F.expr("try_validate_utf8(cast(content as string))")
    # the JVM side knows few encodings; only files that are no UTF-8 go through Python
    text = F.when(utf8.isNotNull(), utf8).otherwise(_decoded(F.when(utf8.isNull(), F.col("content"))))
    text = F.regexp_replace(text, "^﻿", "")
    return files.select(rel.alias("rel"), F.posexplode(F.split(text, "\r?\n")).alias("line", "text")).withColumn("line", F.col("line") + 1)


def grep(rows: DataFrame, needle: str, text: str = "text", ignore_case: bool = False) -> DataFrame:
    column, needle = (F.lower(F.col(text)), needle.lower()) if ignore_case else (F.col(text), needle)
    return rows.where(column.contains(needle))


def parsed(rows: DataFrame, text: str, schema: str, required: str) -> DataFrame:
    """``rows`` with task, the struct that ``text`` holds as JSON, and poison: whether it holds none, or one without ``required``.

    Poisoned rows are kept and told apart, so that nothing is lost in silence.
    """
    out = rows.withColumn("task", F.from_json(text, schema))
    return out.withColumn("poison", F.col("task").isNull() | F.col(f"task.{required}").isNull())


def targets(rows: DataFrame, rel: str, folders: Sequence[str], folder_suffixes: Sequence[str], globs: Sequence[str], skip: Sequence[str]) -> DataFrame:
    """target and is_dir: the topmost folders named in ``folders`` or by suffix, and files elsewhere whose name fits a glob.

    Nothing in a folder of ``skip`` counts, and nothing below a folder that is a target itself.
    """
    parts = S.directories(F.col(rel))
    ends = [lambda d, s=s: d.endswith(s) for s in folder_suffixes]
    chosen = lambda d: functools.reduce(lambda a, f: a | f(d), ends, d.isin(*folders or [""]))
    first = lambda test: F.array_position(F.transform(parts, test), F.lit(True))
    hit, out = first(chosen), first(lambda d: d.isin(*skip or [""]))
    pattern = "|".join(re.escape(g).replace(r"\*", ".*").replace(r"\?", ".") for g in globs)
    alive = (out == 0) | ((hit > 0) & (hit < out))
    folder = F.array_join(F.slice(parts, 1, hit.cast("int")), "/")
    target = F.when(hit > 0, folder).when(S.file_name(F.col(rel)).rlike(f"^({pattern})$"), F.col(rel))
    return rows.where(alive).select(target.alias("target"), (hit > 0).alias("is_dir")).where("target is not null").distinct()


def count_by_suffix(rows: DataFrame, name: str, suffixes: Sequence[str], ignore_case: bool = True) -> DataFrame:
    """Rows by the longest suffix that fits, and TOTAL; suffixes without rows do not appear."""
    column = F.lower(F.col(name)) if ignore_case else F.col(name)
    kind = F.lit(None).cast("string")
    for s in reversed(normalised_suffixes(suffixes, ignore_case)):
        kind = F.when(column.endswith(s), s).otherwise(kind)
    found = rows.select(kind.alias("suffix")).where("suffix is not null")
    return found.rollup("suffix").agg(F.count("*").alias("n")).select(F.coalesce("suffix", F.lit("TOTAL")).alias("suffix"), "n")


def exploded(rows: DataFrame, id_: str, vector: str) -> DataFrame:
    """A row per component with its number from 0."""
    return rows.select(id_, F.posexplode(vector).alias("pt_idx", "x")).withColumn("x", F.col("x").cast("double"))
