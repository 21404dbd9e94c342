"""Expressions for paths, headers, dates, numbers, maps and text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the file formats and result relation define.
CAD_SUFFIXES = (".step", ".stp", ".stpz", ".brep", ".brp")
STEP_SUFFIXES = (".step", ".stp", ".stpz")
BREP_SUFFIXES = (".brep", ".brp")
SURFACE_TYPES = ("plane", "cylinder", "cone", "sphere", "torus", "free")
KERNELS = (
    ("Parasolid", ("parasolid", "nx", "solidworks")),
    ("ACIS", ("acis", "autocad", "inventor")),
    ("CGM", ("catia", "cgm", "3dexperience", "solidedge")),
)
DATE_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd")
STANDARD = ("trace_id", "span_id", "corr_id", "job_id", "attempt", "latency_ms", "msg")
DROPPED = ("task_id", "stage")
LEVELS = {"debug": 10, "info": 20, "warning": 30, "error": 40, "critical": 50}


def relative(path: Column, root: str) -> Column:
    """``path`` below ``root``; elsewhere the path itself."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(path)


def directories(rel: Column) -> Column:
    """The directory components of a relative path."""
    parts = F.split(rel, "/")
    return F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))


def file_name(rel: Column) -> Column:
    return F.element_at(F.split(rel, "/"), -1)


def dataset(rel: Column) -> Column:
    """First path component, or ``unknown`` for a file in the root."""
    parts = F.split(rel, "/")
    return F.when(F.size(parts) > 1, F.element_at(parts, 1)).otherwise("unknown")


def repository(rel: Column) -> Column:
    parts = F.split(rel, "/")
    return F.when(F.size(parts) > 1, F.element_at(parts, 2))


def extension(path: Column) -> Column:
    """The lower-cased suffix with its dot; empty for none, and for names that begin with their only dot."""
    return F.regexp_extract(F.lower(file_name(path)), r"^.+(\.[^.]*)$", 1)


def format_class(ext: Column) -> Column:
    return F.when(ext.isin(*STEP_SUFFIXES), "STEP").when(ext.isin(*BREP_SUFFIXES), "BREP").otherwise("UNKNOWN")


def has_suffix(path: Column, suffixes: Sequence[str] = CAD_SUFFIXES) -> Column:
    return F.lower(path).rlike("(" + "|".join(s.lower().replace(".", "[.]") for s in suffixes) + ")$")


def size_weight(size: Column) -> Column:
    """Mebibytes, one at least."""
    return F.greatest(F.lit(1.0), F.coalesce(size, F.lit(0)) / F.lit(1048576.0))


def kernel(fmt: Column, system: Column) -> Column:
    """The modelling kernel that a header's system text names, in the order of KERNELS."""
    text = F.lower(F.coalesce(system, F.lit("")))
    out = F.when(fmt == "BREP", "OpenCascade")
    for name, words in KERNELS:
        for word in words:
            out = out.when((fmt == "STEP") & text.contains(word), name)
    return out.when(fmt == "STEP", "STEP")


_QUOTED = r"'((?:[^']|'')*)'"
_LIST = r"\(([^)]*)\)"
HEADER_NAME = r"(?is)FILE_NAME\s*\(\s*" + r"\s*,\s*".join((_QUOTED, _QUOTED, _LIST, _LIST, _QUOTED, _QUOTED, _QUOTED)) + r"\s*\)"
HEADER_SCHEMA = r"(?is)FILE_SCHEMA\s*\(\s*\(\s*'([^']*)'"


def header_fields(text: Column, compat: bool = False) -> dict[str, Column]:
    """Schema, originating system, author and creation date of an exchange file's header; null where it has none.

    The originating system is the sixth entry of FILE_NAME; ``compat`` takes the fifth, the
    preprocessor. The author is the first of the list, empty for an empty list.
    """
    found = text.rlike(HEADER_NAME)
    entry = lambda i: F.when(found, F.regexp_extract(text, HEADER_NAME, i))
    return {
        "step_schema": F.when(text.rlike(HEADER_SCHEMA), F.regexp_extract(text, HEADER_SCHEMA, 1)),
        "originating_system": entry(5 if compat else 6),
        "author": F.when(found, F.regexp_extract(F.regexp_extract(text, HEADER_NAME, 3), "'([^']*)'", 1)),
        "created_at_header": utc_text(entry(2)),
    }


def utc_text(text: Column) -> Column:
    """Date text in one of DATE_FORMATS as ISO text in UTC; null for anything else, fractions and offsets too."""
    stamp = F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS))
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def array_text(values: Column) -> Column:
    return F.coalesce(F.to_json(values), F.lit(""))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def bin_of(x: Column, low: float, high: float, bins: int) -> Column:
    """Number of the equal-width bin; the last is closed on the right."""
    return F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")


def norm(*components: Column) -> Column:
    return F.sqrt(sum((c * c for c in components[1:]), components[0] * components[0]))


def edge_key(a: Sequence[Column], b: Sequence[Column], digits: int = 6) -> Column:
    """Both end points rounded half to even, the smaller first."""
    p, q = (F.struct(*(F.bround(c, digits).alias(f"c{i}") for i, c in enumerate(e))) for e in (a, b))
    return F.struct(F.least(p, q).alias("low"), F.greatest(p, q).alias("high"))


def cast_default(x: Column, kind: str, default) -> Column:
    return F.coalesce(x.try_cast(kind), F.lit(default).cast(kind))


def percent(done: Column, total: Column) -> Column:
    """Percent of a total, floored to hundredths and at most 100."""
    return F.when(total > 0, F.least(F.lit(100.0), F.floor(done * 10000 / total) / 100)).otherwise(0.0)


def backoff(attempt: Column, base: float) -> Column:
    return F.lit(base) * F.pow(F.lit(2.0), attempt - 1)


def redacted(fields: Column, deny: Sequence[str], allow: Sequence[str] = (), mask: str = "***") -> Column:
    """A map with values masked whose lower-cased key holds a denied word, unless the key itself is allowed."""
    pattern = "|".join(deny)
    return F.transform_values(fields, lambda k, v: F.when(F.lower(k).rlike(pattern) & ~k.isin(*allow or [""]), mask).otherwise(v))


def truncated(text: Column, most: int = 16384, suffix: str = "...") -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(suffix))).otherwise(text)


def summarised(values: Column, most: int = 16, sample: int = 3) -> Column:
    """Size and first elements of a long array; the whole of a short one."""
    return F.struct(F.size(values).alias("size"), F.when(F.size(values) > most, F.slice(values, 1, sample)).otherwise(values).alias("sample"))


def line_text(parts: Sequence[Column], fields: Mapping[str, Column]) -> Column:
    """``a|b|k=v``, without parts and fields that are null or empty."""
    some = lambda c: F.when(c != "", c)
    return F.concat_ws("|", *(some(p.cast("string")) for p in parts), *(F.concat(F.lit(f"{k}="), some(v.cast("string"))) for k, v in fields.items()))


def record_fields(fields: Column, standard: Sequence[str] = STANDARD, dropped: Sequence[str] = DROPPED) -> dict[str, Column]:
    """A log record's standard fields as columns, and extras, a map of the others but for those that are dropped; null for none."""
    rest = F.map_filter(fields, lambda k, v: ~k.isin(*standard, *dropped))
    return {**{k: F.element_at(fields, k) for k in standard}, "extras": F.when(F.size(rest) > 0, rest)}


def level_at_least(level: Column, least: str) -> Column:
    numbers = F.create_map(*(F.lit(x) for pair in LEVELS.items() for x in pair))
    return F.coalesce(F.element_at(numbers, F.lower(level)), F.lit(0)) >= LEVELS[least]


def zoned_text(stamp: Column, zone: str = "Asia/Shanghai") -> Column:
    return F.date_format(F.from_utc_timestamp(stamp, zone), "yyyy-MM-dd'T'HH:mm:ss")


def padding(length: Column, to: int = 8) -> Column:
    return F.pmod(-length, F.lit(to))


def canonical_map(m: Column) -> Column:
    """A map as text that does not depend on the order of its entries."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))
