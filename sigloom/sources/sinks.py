"""Writing results: CSV parts, final outputs, and where they go."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(df: DataFrame) -> DataFrame:
    """Columns in the order of their names, as text: arrays, maps and structs as JSON, nulls as empty."""

    def text(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        return F.coalesce(c.cast("string"), F.lit("")).alias(f.name)

    return df.select(*(text(df.schema[c]) for c in sorted(df.columns)))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None) -> None:
    """CSV with a header; with ``by`` one folder per value, of which a rerun replaces only those it writes again."""
    writer = flat(df).write.mode(mode).option("header", True).option("emptyValue", "")
    if by is not None:
        writer = writer.partitionBy(by).option("partitionOverwriteMode", "dynamic")
    writer.csv(path)


def write_final(df: DataFrame, path: str, kind: str = "json", mode: str = "overwrite") -> None:
    """JSON lines, or text of the first column."""
    if kind == "json":
        df.write.mode(mode).json(path)
    elif kind == "text":
        df.select(F.col(df.columns[0]).cast("string")).write.mode(mode).text(path)
    else:
        raise ValueError(kind)


def route(df: DataFrame, folder: str, name: str | None, final: bool) -> str:
    """Write to ``<folder>/<name>`` if final, else as a CSV part to ``<folder>/cache/<name>``; gives the path."""
    if not folder or not name:
        raise ValueError("a result needs a folder and a name")
    if name.startswith("/") or "://" in name or ".." in name.split("/"):
        raise ValueError(f"not a name within the folder: {name}")
    path = f"{folder}/{name}" if final else f"{folder}/cache/{name}"
    if final:
        write_final(df, path)
    else:
        write_csv(df, path)
    return path


def stamped(folder: str, stem: str, now: datetime.datetime | None = None) -> str:
    """A path for one run, by its start in UTC."""
    now = now or datetime.datetime.now(datetime.UTC)
    return f"{folder}/{stem}_{now:%Y%m%d-%H%M%S}.csv"


def union(parts: list[DataFrame]) -> DataFrame:
    """All rows, columns matched by name; what a part lacks is null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
