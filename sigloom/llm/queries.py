"""The queries of this subpackage, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import bpe, egojoin, jaccard, lines, lmscore, packing, quality, substrings, topk, toxicity
from sigloom.llm.labelled import held_out
from sigloom.llm.shared import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, threshold=0.3).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, threshold=0.5).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), size=4, num=85, den=100)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), span=35)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return egojoin.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target are documents labelled as of good quality, the background is the corpus."""
    docs = table(spark, sf_dir, "documents")
    target = table(spark, sf_dir, "labels").where("quality = 1")
    return lmscore.score_corpus(docs, target)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_line_dedup, op3_packing, op4_topk, op5_quality, op6_toxicity, op7_jaccard_join, op8_substring_dedup, op9_embedding_dedup, op10_lm_scoring)}


_GOOD = "embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

TOP_K = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE {_GOOD}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s QUALIFY rank <= 10
"""

#: What components of links e (a, b), in both directions, add to a list of tables.
_COMPONENTS = "c AS (SELECT a AS id, least(a, b) AS r FROM e UNION SELECT e.b, c.r FROM c JOIN e ON c.id = e.a), m AS (SELECT id, min(r) AS r FROM c GROUP BY id)"

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS l FROM embeddings WHERE {_GOOD}),
e AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND x.l > 0 AND y.l > 0 AND list_inner_product(x.v, y.v) / (x.l * y.l) >= 0.95), {_COMPONENTS},
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(least(r, vec_id), vec_id) AS component_id, coalesce(least(r, vec_id), vec_id) = vec_id AS kept FROM embeddings LEFT JOIN m ON m.id = vec_id LEFT JOIN n ON n.a = vec_id
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
l AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS l FROM w),
t AS (SELECT doc_id, len(l) AS n, unnest(l) AS s FROM l),
p AS (SELECT x.doc_id AS a, y.doc_id AS b FROM t x JOIN t y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p), {_COMPONENTS}
SELECT doc_id, len(l)::BIGINT AS n_shingles, coalesce(r, doc_id) AS component_id FROM l LEFT JOIN m ON m.id = doc_id
"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w)),
r AS (SELECT h FROM x GROUP BY h HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM x WHERE h IN (SELECT h FROM r)),
a AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM w),
k AS (SELECT a.doc_id, count(g.j) AS n_removed, string_agg(word, ' ' ORDER BY a.j) FILTER (g.j IS NULL) AS kept FROM a LEFT JOIN g ON g.doc_id = a.doc_id AND g.j = a.j GROUP BY a.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON k.doc_id = w.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": lines.ORACLE, "op4_topk": TOP_K, "op7_jaccard_join": JACCARD, "op8_substring_dedup": SUBSTRINGS, "op9_embedding_dedup": NEAR_VECTORS}
