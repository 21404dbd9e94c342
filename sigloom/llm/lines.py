"""Operator 2: line dedup by content-defined chunks, in DataFrame functions only.

Each line has a hash; a rolling hash over the last WINDOW line hashes ends a chunk
where it is smaller than before and not larger than after. Such boundaries depend on the lines around them and
not on line numbers, so they stand still when lines are put in elsewhere. No two of them
are neighbours, and none is next to the text's beginning or end, so that every
chunk of a text of two lines or more has two at least, and three on average. Chunks of two lines or more that
occur before anywhere, compared byte by byte, are
removed: the first (by doc_id, then by place) stays.

Texts move only where they must: of fixed-size bitmaps, made of the hashes of repeated
chunks and of texts that lose some, one tells which chunks and texts take part in a
join; all others stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.shared import dropped, written

WINDOW, FACTOR, MODULUS = 2, 31, 65521
#: A bitmap has 16 bits for each hash, these at least and these at most: 8 KB to 16 MB.
SIEVE = 1 << 16, 1 << 27


def _hash(line: Column) -> Column:
    """28 bits of the line's MD5, which SQL engines agree on."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def with_chunks(docs: DataFrame, window: int = WINDOW, modulus: int = MODULUS) -> DataFrame:
    """``docs`` (doc_id, text) with lines (array) and ends, the number of lines up to each chunk's end."""

    def rolled(h: Column, i: Column) -> Column:
        out = F.lit(0).cast("long")
        for back in reversed(range(window)):
            out = out * FACTOR + F.coalesce(F.get(h, i - back), F.lit(0))
        return F.pmod(out, F.lit(modulus))

    def ends(r: Column, n: Column) -> Column:
        lowest = lambda i: (F.get(r, i - 1) < F.get(r, i - 2)) & (F.get(r, i - 1) <= F.get(r, i))
        return F.filter(F.sequence(F.lit(1), n), lambda i: ((i >= 2) & (i <= n - 2) & lowest(i)) | (i == n))

    split = docs.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    hashed = split.withColumn("hashes", F.transform("lines", _hash))
    hashed = hashed.withColumn("rolled", F.transform("hashes", lambda _, i: rolled(F.col("hashes"), i)))
    return hashed.withColumn("ends", ends(F.col("rolled"), F.size("lines"))).drop("hashes", "rolled")


def _exploded(chunked: DataFrame) -> DataFrame:
    """One row per chunk of two lines or more: doc_id, th (hash of its text), k, key, size, chunk."""
    ends = F.col("ends")
    pieces = F.transform(ends, lambda e, i: F.struct(i.alias("k"), F.coalesce(F.get(ends, i - 1), F.lit(0)).alias("begin"), e.alias("end")))
    many = F.filter(pieces, lambda p: p["end"] - p["begin"] >= 2)
    rows = chunked.select("doc_id", F.xxhash64("text").alias("th"), "lines", F.explode(many).alias("p"))
    chunk = F.array_join(F.slice("lines", F.col("p.begin") + 1, F.col("p.end") - F.col("p.begin")), "\n")
    rows = rows.select("doc_id", "th", F.col("p.k").alias("k"), chunk.alias("chunk"))
    return rows.withColumn("key", F.xxhash64("chunk")).withColumn("size", F.octet_length("chunk"))


def sieve(hashes: DataFrame, name: str) -> tuple[Callable[[Column], Column], DataFrame]:
    """A test that every hash (column h) passes and few other ones do, and the written bitmap that it reads.

    The bitmap is one array of bounded size, whatever the number of hashes; with very many it lets all pass, which costs time alone.
    """
    bits = SIEVE[0]
    n = hashes.count()
    while bits < min(SIEVE[1], 16 * n):
        bits *= 2
    place = lambda h: F.pmod(h, F.lit(bits).cast("long"))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), place(h).bitwiseAND(F.lit(63).cast("long")).cast("int"))
    found = hashes.select(F.shiftright(place(F.col("h")), 6).alias("word"), bit(F.col("h")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = hashes.sparkSession.range(bits >> 6).join(found, F.col("id") == F.col("word"), "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    row = written(every.agg(F.array_sort(F.collect_list(F.struct("id", "bits"))).alias("x")).select(F.col("x.bits").alias("bits")), name)
    return lambda h: F.get(row.scalar(), F.shiftright(place(h), 6).cast("int")).bitwiseAND(bit(h)) != 0, row


def remove_repeated_chunks(docs: DataFrame, window: int = WINDOW, modulus: int = MODULUS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row doc_id, columns ``keep``, n_lines, n_removed (lines) and kept, the lines that stay joined by line feeds.

    A chunk's occurrences are told apart by doc_id (nulls first), text and place; rows that repeat
    both doc_id and text are one occurrence and keep the same. A null text is empty, and an empty text is
    one empty line. Only chunks of equal bytes are removed; of two different chunks
    with one 64-bit hash and length, the first alone can be matched. An empty
    table gives an empty one; other columns are ignored.
    """
    docs = docs.select("doc_id", "text", *(F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)))
    chunks = _exploded(with_chunks(docs.select("doc_id", "text"), window, modulus))
    place = F.struct("doc_id", "th", "k")
    keys = chunks.groupBy("key", "size").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last"))).drop("last")
    # tables written here leave each join below alone in its stage, where a key with very many rows can be split
    keys = written(keys, "keys")
    at_first, first_bits = sieve(keys.select(F.xxhash64("first").alias("h")), "bits")
    firsts = chunks.where(at_first(F.xxhash64(place))).join(keys, ["key", "size"]).where(place.eqNullSafe(F.col("first")))
    firsts = written(firsts.groupBy("key", "size").agg(F.first("chunk").alias("bytes"), F.first("first").alias("first")), "firsts")
    of_key, key_bits = sieve(keys.select(F.col("key").alias("h")), "bits")
    again = chunks.where(of_key(F.col("key"))).join(firsts, ["key", "size"]).where(~place.eqNullSafe(F.col("first")) & (F.col("chunk") == F.col("bytes")))
    again = written(again.select("doc_id", "th", "k"), "again")
    dropped(keys, first_bits, firsts, key_bits)
    removed = again.groupBy("doc_id", "th").agg(F.collect_set("k").alias("gone"))
    removed = written(removed.select(F.col("doc_id").alias("id"), F.col("th").alias("of"), F.array_sort("gone").alias("gone")), "removed")
    dropped(again)
    changed, _ = sieve(removed.select(F.xxhash64("id", "of").alias("h")), "bits")
    th = F.xxhash64("text")
    lies = changed(F.xxhash64("doc_id", th))
    still = docs.where(~lies).select("doc_id", *(f"keep{i}" for i in range(len(keep))), F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("n_lines"), F.lit(0).alias("n_removed"), F.coalesce("text", F.lit("")).alias("kept"))
    found = docs.where(lies).join(removed, F.col("doc_id").eqNullSafe(F.col("id")) & (th == F.col("of")), "left")
    found = with_chunks(found, window, modulus)
    ends = F.col("ends")
    spans = F.transform("gone", lambda k: F.struct(F.coalesce(F.get(ends, k - 1), F.lit(0)).alias("begin"), F.get(ends, k).alias("end")))
    found = found.withColumn("spans", F.coalesce(spans, F.array().cast("array<struct<begin:int,end:int>>")))
    # the lines between removed spans, taken span by span so that the work follows the number of lines
    count, spans = F.size("spans"), F.col("spans")
    begin = lambda i: F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"])
    end = lambda i: F.when(i == count, F.size("lines")).otherwise(F.get(spans, i)["begin"])
    kept = F.flatten(F.transform(F.sequence(F.lit(0), count), lambda i: F.slice("lines", begin(i) + 1, end(i) - begin(i))))
    gone = F.aggregate(spans, F.lit(0), lambda a, s: a + s["end"] - s["begin"])
    text = F.when(gone > 0, F.array_join(kept, "\n")).otherwise(F.coalesce("text", F.lit("")))
    out = found.select("doc_id", *(f"keep{i}" for i in range(len(keep))), F.size("lines").alias("n_lines"), gone.alias("n_removed"), text.alias("kept"))
    return out.unionByName(still).toDF("doc_id", *keep, "n_lines", "n_removed", "kept")


ORACLE = f"""
WITH l AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), h AS (
  SELECT *, list_transform(lines, lambda x: ('0x' || substr(md5(x), 1, 7))::BIGINT) AS hs FROM l
), q AS (
  SELECT doc_id, text, lines, list_transform(range(1, len(lines) + 1), lambda i: (CASE WHEN i > 1 THEN hs[i - 1] ELSE 0 END * {FACTOR} + hs[i]) % {MODULUS}) AS rs FROM h
), e AS (
  SELECT doc_id, text, lines, list_filter(range(1, len(lines) + 1), lambda i:
    (i >= 2 AND i <= len(lines) - 2 AND rs[i] < rs[i - 1] AND rs[i] <= rs[i + 1]) OR i = len(lines)) AS ends FROM q
), c AS (
  SELECT doc_id, text, unnest(list_transform(range(1, len(ends) + 1), lambda k: {{
    'k': k, 'b': CASE WHEN k > 1 THEN ends[k - 1] ELSE 0 END, 'e': ends[k],
    'chunk': array_to_string(lines[CASE WHEN k > 1 THEN ends[k - 1] ELSE 0 END + 1 : ends[k]], chr(10))}})) AS c FROM e
), r AS (
  SELECT doc_id, text, c.k AS k, c.chunk AS chunk, c.e - c.b AS n,
    c.e - c.b >= 2 AND row_number() OVER (PARTITION BY c.chunk, c.e - c.b >= 2 ORDER BY doc_id, c.k) > 1 AS gone FROM c
), d AS (
  SELECT doc_id, sum(n) AS n_lines, coalesce(sum(n) FILTER (gone), 0) AS n_removed,
    coalesce(string_agg(chunk, chr(10) ORDER BY k) FILTER (NOT gone), '') AS kept FROM r GROUP BY doc_id
)
SELECT doc_id, n_lines::INTEGER AS n_lines, n_removed::INTEGER AS n_removed, sha256(kept) AS kept_sha256 FROM d
"""
