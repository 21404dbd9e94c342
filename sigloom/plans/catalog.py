"""Every query of the library over the driver's tables, beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.functions import scalars as S
from sigloom.operators import duplicates, fingerprints, geometry, joins, logs, order, packing, queue
from sigloom.plans import jobs
from sigloom.sources import files, sinks
from sigloom.streaming import stateful
from sigloom.tables import shared_dir, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ---- shapes: a supplier's lines are the points of a part ----


def _points(spark, d, idx=False):
    lines = table(spark, d, "lineitem")
    points = lines.select(F.col("l_suppkey").alias("part"), F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 100).alias("z"))
    return points


POINTS = "p AS (SELECT l_suppkey AS part, l_orderkey AS ok, l_linenumber AS ln, l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 100 AS z FROM lineitem)"
BOXES = "b AS (SELECT part, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz, max(z) AS hz FROM p GROUP BY part)"
UNIT = "u AS (SELECT p.part, ok, ln, n, (x - mx) / dg AS x, (y - my) / dg AS y, (z - mz) / dg AS z FROM p JOIN (SELECT *, sqrt((hx - lx) * (hx - lx) + (hy - ly) * (hy - ly) + (hz - lz) * (hz - lz)) + 1e-9::DOUBLE AS dg FROM b) b ON p.part = b.part)"
DRAWN = """k AS MATERIALIZED (SELECT part, n, k FROM (SELECT DISTINCT part, n FROM i), range(20000) d(k)),
g AS (SELECT a.part, least(floor(least(greatest(sqrt((a.x - c.x) * (a.x - c.x) + (a.y - c.y) * (a.y - c.y) + (a.z - c.z) * (a.z - c.z)) / (sqrt(3::DOUBLE) + 1e-9::DOUBLE), 0), 1) * 64), 63)::INTEGER AS bin
FROM k JOIN i a ON a.part = k.part AND a.idx = k * 7919 % k.n JOIN i c ON c.part = k.part AND c.idx = (k * 104729 + k // k.n + 13) % k.n)"""
RATIOS = "r AS (SELECT part, n, s[1] / (s[3] + 1e-12::DOUBLE) AS r1, s[2] / (s[3] + 1e-12::DOUBLE) AS r2 FROM (SELECT part, n, list_sort([hx - lx, hy - ly, hz - lz]) AS s FROM b))"


@query("SELECT vec_id, unnest(range(len(embedding)))::INTEGER AS pt_idx, unnest(embedding)::DOUBLE AS x FROM embeddings")
def explode_points(spark, d):
    return files.exploded(table(spark, d, "embeddings"), "vec_id", "embedding")


@query(f"WITH {POINTS}, {BOXES}, {UNIT} SELECT part, ok, ln, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM u")
def normalize_points(spark, d):
    out = geometry.normalised(_points(spark, d))
    return out.select("part", "ok", "ln", *(F.round(c, 6).alias(c) for c in "xyz"))


@query(f"WITH {POINTS}, {BOXES}, {RATIOS} SELECT part, n, round(r1, 9) AS r1, round(r2, 9) AS r2 FROM r")
def bbox_ratios(spark, d):
    return geometry.box_ratios(_points(spark, d)).select("part", "n", F.round("r1", 9).alias("r1"), F.round("r2", 9).alias("r2"))


@query(f"""WITH {POINTS.replace("FROM lineitem", "FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY (l_orderkey * 7 + l_linenumber) * 2654435761 % 1000003, l_orderkey, l_linenumber, l_quantity, l_extendedprice) <= 4096")}, {BOXES}, {UNIT},
i AS MATERIALIZED (SELECT part, n, x, y, z, row_number() OVER (PARTITION BY part ORDER BY ok, ln, x, y) - 1 AS idx FROM u WHERE n >= 4),
{DRAWN} SELECT part, bin, count(*) AS cnt FROM g GROUP BY ALL""")
def d2_pairs_hist(spark, d):
    hashed = F.pmod((F.col("ok") * 7 + F.col("ln")) * F.lit(2654435761), F.lit(1000003))
    some = order.first_k(_points(spark, d), ["part"], [hashed, "ok", "ln", "x", "y"], 4096).drop("rank")
    # 4096 points of a part at most are left
    from pyspark.sql import Window

    numbered = some.withColumn("idx", F.row_number().over(Window.partitionBy("part").orderBy("ok", "ln", "x", "y")) - 1)
    return geometry.drawn_histogram(numbered, pairs=20_000)


@query("""SELECT p_brand, count(*) FILTER (p_size % 6 = 0) / count(*) AS plane, count(*) FILTER (p_size % 6 = 1) / count(*) AS cylinder, count(*) FILTER (p_size % 6 = 2) / count(*) AS cone,
count(*) FILTER (p_size % 6 = 3) / count(*) AS sphere, count(*) FILTER (p_size % 6 = 4) / count(*) AS torus, count(*) FILTER (p_size % 6 = 5) / count(*) AS free FROM part GROUP BY p_brand""")
def surface_type_hist(spark, d):
    kinds = F.array(*map(F.lit, S.SURFACE_TYPES))
    faces = table(spark, d, "part").select("p_brand", F.get(kinds, F.pmod("p_size", F.lit(6))).alias("surface_type"))
    return geometry.surface_histogram(faces, "p_brand")


def _edges(spark, d):
    return table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.col("l_quantity").alias("nx"), (F.col("l_discount") * 100).alias("ny"), (F.col("l_tax") * 100).alias("nz"))


EDGES = """e AS (SELECT l_partkey, l_orderkey, l_quantity AS nx, l_discount * 100 AS ny, l_tax * 100 AS nz, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem),
f AS (SELECT l_partkey, max(l_orderkey) FILTER (rn = 1) AS l_orderkey_a, max(l_orderkey) FILTER (rn = 2) AS l_orderkey_b, max(nx) FILTER (rn = 1) AS ax, max(ny) FILTER (rn = 1) AS ay, max(nz) FILTER (rn = 1) AS az,
max(nx) FILTER (rn = 2) AS bx, max(ny) FILTER (rn = 2) AS by_, max(nz) FILTER (rn = 2) AS bz FROM e WHERE rn <= 2 GROUP BY l_partkey HAVING count(*) = 2)"""


@query(f"WITH {EDGES} SELECT l_partkey, l_orderkey_a, l_orderkey_b FROM f")
def edge_face_pairs(spark, d):
    return geometry.edge_pairs(_edges(spark, d), ["l_partkey"], ["l_orderkey", "l_linenumber"], ["l_orderkey"])


@query(f"""WITH {EDGES}, g AS (SELECT l_partkey % 10 AS part, sqrt(ax * ax + ay * ay + az * az) + 1e-12::DOUBLE AS la, sqrt(bx * bx + by_ * by_ + bz * bz) + 1e-12::DOUBLE AS lb, * FROM f),
h AS (SELECT part, acos(greatest(-1, least(1, (ax / la) * (bx / lb) + (ay / la) * (by_ / lb) + (az / la) * (bz / lb)))) AS v FROM g)
SELECT part, least(floor(v / pi() * 36), 35)::INTEGER AS bin, count(*) AS cnt FROM h GROUP BY ALL""")
def dihedral_hist(spark, d):
    # the SQL leaves open which of several lines of one number comes first; by their normals it is always the same one
    pairs = geometry.edge_pairs(_edges(spark, d), ["l_partkey"], ["l_orderkey", "l_linenumber", "nx", "ny", "nz"], ["nx", "ny", "nz"])
    return geometry.dihedral_histogram(pairs.withColumn("part", F.pmod("l_partkey", F.lit(10))))


HASHED = "sha256(concat_ws(',', round(r1 * 1000)::BIGINT::VARCHAR, round(r2 * 1000)::BIGINT::VARCHAR))"


@query(f"WITH {POINTS}, {BOXES}, {RATIOS} SELECT part, {HASHED} AS geom_hash FROM r")
def geom_hash(spark, d):
    return geometry.box_ratios(_points(spark, d)).select("part", geometry.value_hash(F.col("r1"), F.col("r2")).alias("geom_hash"))


def _dense(name, table, bins):
    """SQL for the shares of a histogram (part, bin, cnt), zeros filled in."""
    return f"""{name} AS (SELECT part, list(v ORDER BY bin) AS l FROM (SELECT o.part, b.bin, coalesce(cnt, 0) / (total + 1e-12::DOUBLE) AS v FROM (SELECT part, sum(cnt) AS total FROM {table} GROUP BY part) o
CROSS JOIN range({bins}) b(bin) LEFT JOIN {table} h ON h.part = o.part AND h.bin = b.bin) GROUP BY part)"""


#: A supplier's lines are its points, faces and edges; an edge's ends are told apart by their coordinates, not by their order.
FULL = f"""q AS (SELECT l_suppkey AS part, concat_ws('-', l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * 100)::BIGINT) AS id, l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 100 AS z, l_partkey, l_quantity, l_linenumber, l_returnflag, l_tax FROM lineitem),
p AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY part ORDER BY ('0x' || substr(md5(concat_ws('|', '0', part::VARCHAR, id::VARCHAR)), 1, 8))::BIGINT, id) <= 4096), {BOXES},
u AS (SELECT p.part, id, n, (x - mx) / dg AS x, (y - my) / dg AS y, (z - mz) / dg AS z FROM p JOIN (SELECT *, sqrt((hx - lx) * (hx - lx) + (hy - ly) * (hy - ly) + (hz - lz) * (hz - lz)) + 1e-9::DOUBLE AS dg FROM b) b ON p.part = b.part),
i AS MATERIALIZED (SELECT part, n, x, y, z, row_number() OVER (PARTITION BY part ORDER BY id) - 1 AS idx FROM u WHERE n >= 4), {DRAWN}, gh AS (SELECT part, bin, count(*) AS cnt FROM g GROUP BY ALL), {_dense("d2", "gh", 64)}, {RATIOS},
sf AS (SELECT part, [count(*) FILTER (l_partkey % 6 = 0) / count(*), count(*) FILTER (l_partkey % 6 = 1) / count(*), count(*) FILTER (l_partkey % 6 = 2) / count(*), count(*) FILTER (l_partkey % 6 = 3) / count(*), count(*) FILTER (l_partkey % 6 = 4) / count(*), count(*) FILTER (l_partkey % 6 = 5) / count(*)] AS l FROM q GROUP BY part),
ed AS (SELECT part, l_linenumber AS ka, (l_quantity::BIGINT % 10) AS kb, CASE WHEN l_returnflag = 'R' THEN -1.0 ELSE 1.0 END::DOUBLE AS s, x, z, l_tax * 100 AS t, row_number() OVER (PARTITION BY part, l_linenumber, l_quantity::BIGINT % 10 ORDER BY id) AS rn FROM q),
ep AS (SELECT part, max(s * x) FILTER (rn = 1) AS ax, max(s * z) FILTER (rn = 1) AS ay, max(s * t) FILTER (rn = 1) AS az, max(s * x) FILTER (rn = 2) AS bx, max(s * z) FILTER (rn = 2) AS by_, max(s * t) FILTER (rn = 2) AS bz FROM ed WHERE rn <= 2 GROUP BY part, ka, kb HAVING count(*) = 2),
el AS (SELECT *, sqrt(ax * ax + ay * ay + az * az) + 1e-12::DOUBLE AS la, sqrt(bx * bx + by_ * by_ + bz * bz) + 1e-12::DOUBLE AS lb FROM ep),
eh AS (SELECT part, least(floor(acos(greatest(-1, least(1, (ax / la) * (bx / lb) + (ay / la) * (by_ / lb) + (az / la) * (bz / lb)))) / pi() * 36), 35)::INTEGER AS bin, count(*) AS cnt FROM el GROUP BY ALL), {_dense("dh", "eh", 36)},
sg AS (SELECT r.part::VARCHAR AS part_id, (n >= 4)::INTEGER AS has_points, CASE WHEN n >= 4 THEN array_to_string(list_transform(list_concat(list_concat(d2.l, [round(r1, 6), round(r2, 6)]), list_concat(sf.l, coalesce(dh.l, list_transform(range(36), lambda x: 0::DOUBLE)))), lambda v: round_even(v * 1000, 0)::BIGINT::VARCHAR), ',') ELSE '' END AS "values",
CASE WHEN n >= 4 THEN '' ELSE 'too_few_points' END AS error FROM r LEFT JOIN d2 ON d2.part = r.part LEFT JOIN sf ON sf.part = r.part LEFT JOIN dh ON dh.part = r.part)"""


@query(f"""WITH {FULL} SELECT *, CASE WHEN has_points = 1 THEN sha256("values") ELSE '' END AS geom_hash FROM sg""")
def signature_rows(spark, d):
    lines = table(spark, d, "lineitem")
    part, id_ = F.col("l_suppkey").alias("part"), F.concat_ws("-", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")), F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"))
    points = lines.select(part, id_.alias("idx"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 100).alias("z"))
    faces = lines.select(part, F.get(F.array(*map(F.lit, S.SURFACE_TYPES)), F.pmod("l_partkey", F.lit(6)).cast("int")).alias("surface_type"))
    one, two = [F.col("l_linenumber") / 3, F.lit(0.0), F.lit(0.0)], [F.col("l_quantity").cast("long") % 10 / 7, F.lit(1.0), F.lit(0.0)]
    edge = F.when(F.col("l_partkey") % 2 == 0, S.edge_key(one, two)).otherwise(S.edge_key(two, one))
    normal = [F.col("l_quantity").alias("nx"), (F.col("l_discount") * 100).alias("ny"), (F.col("l_tax") * 100).alias("nz")]
    edges = lines.select(part, edge.alias("edge"), id_.alias("seq"), *normal, (F.col("l_returnflag") == "R").alias("reversed"))
    return jobs.descriptors(points, faces, edges).select("part_id", "has_points", "values", "geom_hash", "error")


@query(f"WITH {FULL} SELECT count(*) AS rows, sha256(string_agg(part_id, ';' ORDER BY part_id)) AS fingerprint FROM sg")
def aggregate_outputs(spark, d):
    return fingerprints.aggregate_outputs(signature_rows(spark, d))


@query("SELECT vec_id, CASE WHEN label % 5 = 0 THEN 0 ELSE 1 END AS has_points, CASE WHEN label % 5 = 0 THEN 0 ELSE len(embedding) END::INTEGER AS size, label % 5 = 0 AS blank FROM embeddings")
def build_row(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.when(F.col("label") % 5 != 0, F.col("embedding")).alias("v"))
    text = S.array_text(F.col("v"))
    back = F.from_json(F.when(text != "", text), "array<float>")
    return rows.select("vec_id", F.col("v").isNotNull().cast("int").alias("has_points"), F.coalesce(F.size(back), F.lit(0)).alias("size"), (text == "").alias("blank")).withColumn("size", F.greatest("size", F.lit(0)))


@query("""WITH h AS (SELECT l_suppkey AS part, (l_orderkey * 7 + l_linenumber) * 2654435761 % 1000003 AS k, l_orderkey AS ok, l_linenumber AS ln FROM lineitem)
SELECT part, ok, ln FROM h QUALIFY row_number() OVER (PARTITION BY part ORDER BY k, ok, ln) <= 50""")
def sample_k_per_group(spark, d):
    key = F.struct(F.pmod((F.col("ok") * 7 + F.col("ln")) * F.lit(2654435761), F.lit(1000003)).alias("k"), "ok", "ln")
    return order.sample_k(_points(spark, d), ["part"], key, 50).select("part", "ok", "ln")


# ---- fingerprints and content ----


@query("SELECT sha256(string_agg(p_partkey::VARCHAR, ';' ORDER BY p_partkey::VARCHAR)) AS fingerprint FROM part")
def fingerprint_ids(spark, d):
    return table(spark, d, "part").agg(fingerprints.of_ids("p_partkey").alias("fingerprint"))


@query("SELECT sha256(unhex(string_agg(t, '' ORDER BY t))) AS fingerprint, count(*) AS n FROM (SELECT substr(sha256(concat(p_partkey::VARCHAR, p_name, p_size::VARCHAR)), 1, 32) AS t FROM part)")
def fingerprint_rows(spark, d):
    return table(spark, d, "part").agg(fingerprints.of_rows([F.col("p_partkey"), F.col("p_name"), F.col("p_size")]).alias("fingerprint"), F.count("*").alias("n"))


_PIECES = ", ".join(f"sum(('0x' || substr(h, {1 + 7 * i}, 7))::BIGINT)::BIGINT::VARCHAR" for i in range(9))


@query(f"SELECT count(*) AS rows, sha256(concat_ws(',', count(*)::VARCHAR, {_PIECES})) AS digest FROM (SELECT sha256(concat_ws(chr(31), o_orderkey::VARCHAR, o_orderstatus)) AS h FROM orders)")
def fingerprint_scalable(spark, d):
    return fingerprints.scalable(table(spark, d, "orders"), [F.col("o_orderkey"), F.col("o_orderstatus")])


@query("SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))


@query("SELECT sha256(text) AS content_hash, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    return duplicates.exact_groups(table(spark, d, "documents"), "text", "doc_id")


@query("SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1")
def distinct_keep_first(spark, d):
    return duplicates.keep_first(table(spark, d, "documents"), "text", "doc_id").select("doc_id", "lang", "source")


PAIRS = """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings), s AS (SELECT *, sqrt(list_inner_product(v, v)) AS l FROM v),
p AS (SELECT x.vec_id AS a, y.vec_id AS b, list_inner_product(x.v, y.v) / (x.l * y.l) AS similarity FROM s x JOIN s y ON x.vec_id < y.vec_id AND abs(x.a - y.a) <= 0.1 AND abs(x.b - y.b) <= 0.1)"""


def _near(spark, d, found):
    return found(table(spark, d, "embeddings"), "vec_id", "embedding", [F.get("embedding", F.lit(0)), F.get("embedding", F.lit(1))], 0.1, 0.3)


@query(PAIRS + " SELECT a, b, round(similarity, 6) AS similarity FROM p WHERE similarity >= 0.3")
def near_dup_pairs(spark, d):
    return _near(spark, d, duplicates.near_pairs).withColumn("similarity", F.round("similarity", 6))


@query(PAIRS.replace("WITH v", "WITH RECURSIVE v") + """, e AS (SELECT a, b FROM p WHERE similarity >= 0.3 UNION SELECT b, a FROM p WHERE similarity >= 0.3), c AS (SELECT a AS id, a AS r FROM e UNION SELECT e.b, c.r FROM c JOIN e ON c.id = e.a)
SELECT id, min(r) AS cluster FROM c GROUP BY id""")
def near_dup_clusters(spark, d):
    return _near(spark, d, duplicates.near_clusters)


# ---- files: pages' addresses and documents as paths ----

SUFFIXES = (".html", ".htm", ".php", ".tar.gz", ".gz", ".com")


@query("SELECT page_id, url FROM pages WHERE regexp_matches(lower(url), '[.](html|htm|php)$')")
def filter_suffix(spark, d):
    return table(spark, d, "pages").where(S.has_suffix(F.col("url"), (".html", ".htm", ".php"))).select("page_id", "url")


@query("""WITH s AS (SELECT CASE WHEN u LIKE '%.tar.gz' THEN '.tar.gz' WHEN u LIKE '%.html' THEN '.html' WHEN u LIKE '%.com' THEN '.com' WHEN u LIKE '%.htm' THEN '.htm' WHEN u LIKE '%.php' THEN '.php' WHEN u LIKE '%.gz' THEN '.gz' END AS suffix
FROM (SELECT lower(url) AS u FROM pages)) SELECT coalesce(suffix, 'TOTAL') AS suffix, count(*) AS n FROM s WHERE suffix IS NOT NULL GROUP BY ROLLUP (suffix)""")
def count_by_suffix(spark, d):
    return files.count_by_suffix(table(spark, d, "pages"), "url", SUFFIXES)


@query("SELECT doc_id, l.line AS line, sha256(l.text) AS text_hash FROM (SELECT doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {'line': i, 'text': x})) AS l FROM documents) WHERE contains(lower(l.text), 'clown')")
def grep_lines(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "text")).withColumn("line", (F.col("line") + 1).cast("long"))
    return files.grep(rows, "Clown", ignore_case=True).select("doc_id", "line", F.sha2("text", 256).alias("text_hash"))


PATHS = "f AS (SELECT doc_id, n_chars, CASE WHEN doc_id % 10 = 0 THEN doc_id || '.STEP' ELSE lang || '/' || source || '/' || doc_id || '.stp' END AS rel FROM documents)"
WALK = "list_slice(string_split(rel, '/'), 1, len(string_split(rel, '/')) - 1), list_last(string_split(rel, '/'))"


def _paths(spark, d):
    rel = F.when(F.col("doc_id") % 10 == 0, F.concat(F.col("doc_id"), F.lit(".STEP"))).otherwise(F.concat("lang", F.lit("/"), "source", F.lit("/"), "doc_id", F.lit(".stp")))
    return table(spark, d, "documents").select("doc_id", "n_chars", rel.alias("rel"))


@query(f"WITH {PATHS} SELECT rel, row_number() OVER (ORDER BY {WALK}) - 1 AS ordinal FROM f")
def scan_order(spark, d):
    return order.with_ordinal(_paths(spark, d).select("rel"), files.preorder())


@query(f"WITH {PATHS} SELECT rel FROM f ORDER BY {WALK} LIMIT 25")
def head_n(spark, d):
    return order.head(_paths(spark, d).select("rel"), files.preorder(), n=25)


@query(f"WITH {PATHS} SELECT rel FROM f ORDER BY {WALK} LIMIT (SELECT ceil(0.03 * count(*))::BIGINT FROM f)")
def head_frac(spark, d):
    return order.head(_paths(spark, d).select("rel"), files.preorder(), frac=0.03)


@query(f"WITH {PATHS} SELECT rel, CASE WHEN contains(rel, '/') THEN string_split(rel, '/')[1] ELSE 'unknown' END AS dataset, CASE WHEN contains(rel, '/') THEN string_split(rel, '/')[2] END AS repo, regexp_extract(lower(rel), '([.][^./]+)$', 1) AS ext, 'STEP' AS format, greatest(1.0::DOUBLE, n_chars * 1000 / 1048576.0::DOUBLE) AS weight FROM f")
def item_projection(spark, d):
    rel = F.col("rel")
    return _paths(spark, d).select(rel, S.dataset(rel).alias("dataset"), S.repository(rel).alias("repo"), S.extension(rel).alias("ext"), S.format_class(S.extension(rel)).alias("format"), S.size_weight(F.col("n_chars") * 1000).alias("weight"))


@query("""WITH i AS (SELECT coalesce(CASE WHEN doc_id % 3 = 0 THEN source END, CASE WHEN doc_id % 3 = 1 THEN lang END, doc_id::VARCHAR) AS payload_ref, CASE WHEN doc_id % 7 = 0 THEN 1.0 ELSE n_chars END::DOUBLE AS weight, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
SELECT *, substr(sha256(concat_ws('|', payload_ref, round(weight * 1000)::BIGINT::VARCHAR, idx::VARCHAR)), 1, 32) AS checksum FROM i""")
def normalise_items(spark, d):
    id_ = F.col("doc_id")
    rows = table(spark, d, "documents")
    out = packing.normalised_items(rows, [F.when(id_ % 3 == 0, F.col("source")), F.when(id_ % 3 == 1, F.col("lang")), id_], F.when(id_ % 7 != 0, F.col("n_chars").cast("double")), ["doc_id"], keep=["doc_id"])
    return out.drop("doc_id")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ordinal FROM orders")
def ordinal(spark, d):
    return order.with_ordinal(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "ordinal")


# ---- packing ----

FIXED = "x AS (SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) AS ordinal FROM orders), t AS (SELECT *, ordinal // 128 AS task_idx FROM x)"
WEIGHTED = """i AS (SELECT p_brand AS job, p_partkey, greatest(1.0::DOUBLE, p_size / 8.0::DOUBLE) AS weight, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part),
r AS (SELECT job, p_partkey, weight, rn, 0 AS task_idx, 1 AS n, weight AS w FROM i WHERE rn = 1 UNION ALL
SELECT i.job, i.p_partkey, i.weight, i.rn, CASE WHEN r.n >= 16 OR r.w >= 40 - 1e-9 THEN r.task_idx + 1 ELSE r.task_idx END, CASE WHEN r.n >= 16 OR r.w >= 40 - 1e-9 THEN 1 ELSE r.n + 1 END, CASE WHEN r.n >= 16 OR r.w >= 40 - 1e-9 THEN i.weight ELSE r.w + i.weight END FROM r JOIN i ON i.job = r.job AND i.rn = r.rn + 1)"""
TASKS = f"""WITH RECURSIVE {WEIGHTED}, b AS (SELECT job, task_idx, count(*) AS n_items, sum(weight) AS weight, string_agg(concat_ws(':', p_partkey::VARCHAR, round(weight * 1000)::BIGINT::VARCHAR, p_partkey::VARCHAR), ';' ORDER BY p_partkey) AS refs FROM r GROUP BY ALL)"""


@query(f"WITH {FIXED} SELECT task_idx, count(*) AS items, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM t GROUP BY task_idx")
def pack_fixed(spark, d):
    out = packing.fixed(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 128)
    return out.groupBy("task_idx").agg(F.count("*").alias("items"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


def _packed(spark, d):
    items = table(spark, d, "part").select(F.col("p_brand").alias("job"), "p_partkey", F.greatest(F.lit(1.0), F.col("p_size") / 8).alias("weight"))
    return packing.weighted(items, "job", ["p_partkey"], "weight", 16, 40.0)


@query(f"WITH RECURSIVE {WEIGHTED} SELECT job, p_partkey, task_idx, weight FROM r")
def pack_weighted(spark, d):
    return _packed(spark, d).select("job", "p_partkey", "task_idx", "weight")


def _tasks(spark, d):
    return packing.tasks(_packed(spark, d), ["job", "task_idx"], "p_partkey", "p_partkey", "weight")


@query(TASKS + " SELECT job, task_idx, n_items, weight, substr(sha256(concat_ws('|', refs, '0')), 1, 32) AS checksum, substr(sha256(concat_ws('|', job, task_idx::VARCHAR, 'stream', '0', substr(sha256(concat_ws('|', refs, '0')), 1, 32))), 1, 32) AS task_id FROM b")
def task_build(spark, d):
    return _tasks(spark, d).drop("items")


@query(f"""WITH RECURSIVE {WEIGHTED}, h AS (SELECT *, ('0x' || substr(md5(concat_ws('|', '7', job, task_idx::VARCHAR, p_partkey::VARCHAR)), 1, 8))::BIGINT AS h FROM r) SELECT job, task_idx, p_partkey, row_number() OVER (PARTITION BY job, task_idx ORDER BY h, p_partkey) - 1 AS place FROM h""")
def task_shuffle(spark, d):
    return packing.shuffled(_packed(spark, d), ["job", "task_idx"], "p_partkey", seed=7).select("job", "task_idx", "p_partkey", F.col("place").cast("long").alias("place"))


@query("""WITH i AS (SELECT p_brand AS job, p_partkey, count(*) OVER (PARTITION BY p_brand) AS n, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS rn FROM part)
SELECT 'Chunk' AS strategy, job, p_partkey, rn // 16 AS task_idx FROM i UNION ALL SELECT 'modulo', job, p_partkey, ('0x' || substr(md5(p_partkey::VARCHAR), 1, 8))::BIGINT % ceil(n / 16)::BIGINT FROM i""")
def pack_by_name(spark, d):
    items = table(spark, d, "part").select(F.col("p_brand").alias("job"), "p_partkey", F.lit(1.0).alias("weight"))
    some = [packing.assigned(items, name, "job", ["p_partkey"], "weight", 16, 40.0).select(F.lit(name).alias("strategy"), "job", "p_partkey", F.col("task_idx").cast("long").alias("task_idx")) for name in ("Chunk", "modulo")]
    return some[0].unionByName(some[1])


@query(TASKS + " SELECT count(*) AS tasks, sum(n_items)::BIGINT AS items, sum(weight) AS weight FROM b")
def plan_totals(spark, d):
    return packing.totals(_tasks(spark, d))


@query(TASKS + " SELECT job, task_idx, n_items AS row_count, weight FROM b")
def task_summary(spark, d):
    return _packed(spark, d).groupBy("job", "task_idx").agg(F.count("*").alias("row_count"), F.sum("weight").alias("weight"))


@query(f"WITH RECURSIVE {WEIGHTED} SELECT job, task_idx, count(*) AS row_count, sum(weight) AS weight FROM r GROUP BY ROLLUP (job, task_idx)")
def task_rollup(spark, d):
    return packing.rollup(_packed(spark, d), ["job", "task_idx"], "weight")


@query("""WITH r AS (SELECT r_regionkey, r_name, row_number() OVER (ORDER BY r_regionkey) - 1 AS o FROM region), c AS (SELECT * FROM r, range(3) AS g(copy) WHERE copy * 5 + o < 12)
SELECT CASE WHEN copy > 0 THEN r_regionkey || '_dup' || copy ELSE r_regionkey::VARCHAR END AS r_regionkey, r_name, copy::INTEGER AS copy, CASE WHEN copy > 0 THEN r_regionkey::VARCHAR END AS duplicate_of FROM c""")
def cyclic_expand(spark, d):
    return order.cyclic(table(spark, d, "region").select("r_regionkey", "r_name"), ["r_regionkey"], 12, "r_regionkey").select("r_regionkey", "r_name", "copy", "duplicate_of")


# ---- joins and unions ----


@query("SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def items_left_join(spark, d):
    return joins.items_left(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


@query("SELECT l.doc_id, lang, quality, toxic FROM labels l JOIN documents d ON d.doc_id = l.doc_id")
def items_inner_join(spark, d):
    return joins.items_inner(table(spark, d, "labels"), table(spark, d, "documents").select("doc_id", "lang"), "doc_id", must_match=True).select("doc_id", "lang", "quality", "toxic")


@query("SELECT c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment, NULL::BIGINT AS suppkey FROM customer UNION ALL SELECT s_name, s_nationkey, NULL, s_suppkey FROM supplier")
def union_by_name(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return sinks.union([customers, suppliers])


@query("SELECT s_suppkey, s_nationkey, (s_suppkey % 4)::INTEGER AS device FROM supplier")
def round_robin_assign(spark, d):
    return joins.round_robin(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey", 4)


@query("SELECT n_nationkey, n_name, CASE n_nationkey WHEN 7 THEN 0 WHEN 3 THEN 1 ELSE 2 END AS rank FROM nation WHERE n_nationkey IN (7, 3, 11)")
def preferred_semi_join(spark, d):
    return joins.preferred(table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey", [7, 3, 99, 11])


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, event_type AS kind, CASE WHEN event_id % 2 = 0 THEN 'right' ELSE 'left' END AS side FROM events")
def map_merge(spark, d):
    left = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("kind"), F.col("event_type"), F.lit("side"), F.lit("left"))
    right = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("side"), F.lit("right"))).otherwise(F.create_map().cast("map<string,string>"))
    m = joins.map_merged(left, right)
    return table(spark, d, "events").select("event_id", m["k"].cast("long").alias("k"), m["kind"].alias("kind"), m["side"].alias("side"))


# ---- scalars ----

_HEADERS = [
    (1, "ISO-10303-21; HEADER; FILE_NAME('a.stp','2020-01-02T03:04:05',('Ann','Bob'),('Org'),'pre 1','SolidWorks 2020','ok'); FILE_SCHEMA(('AP214'));"),
    (2, "file_name ( 'b.stp' , '2020/01/02 03:04:05' , () , () ,\n 'pre 2' , 'CATIA V5' , '' ); file_schema (('AP203'));"),
    (3, "FILE_NAME('c','2020-01-02 03:04:05',('X'),('Y'),'p','Autodesk Inventor','z');"),
    (4, "FILE_NAME('d','2020-01-02',('X'),('Y'),'p','Other','z');FILE_SCHEMA(('S'));"),
    (5, "FILE_NAME('e','2020-01-02T03:04:05.5',(''),(''),'','','');"),
    (6, "no header here"),
]
_VALUES = ", ".join("({}, '{}')".format(i, t.replace("'", "''").replace("\n", "' || chr(10) || '")) for i, t in _HEADERS)
_RE = S.HEADER_NAME.replace("'", "''")
_DATES = "coalesce(try_strptime(t, '%Y-%m-%dT%H:%M:%S'), try_strptime(t, '%Y-%m-%d %H:%M:%S'), try_strptime(t, '%Y/%m/%d %H:%M:%S'), try_strptime(t, '%Y-%m-%d'))"


@query(f"""WITH h(id, txt) AS (VALUES {_VALUES}), g AS (SELECT *, regexp_matches(txt, '{_RE}') AS f, regexp_extract(txt, '{_RE}', 2) AS t FROM h)
SELECT id, CASE WHEN regexp_matches(txt, '{S.HEADER_SCHEMA.replace("'", "''")}') THEN regexp_extract(txt, '{S.HEADER_SCHEMA.replace("'", "''")}', 1) END AS step_schema, CASE WHEN f THEN regexp_extract(txt, '{_RE}', 6) END AS originating_system,
CASE WHEN f THEN regexp_extract(regexp_extract(txt, '{_RE}', 3), '''([^'']*)''', 1) END AS author, CASE WHEN f THEN strftime({_DATES}, '%Y-%m-%dT%H:%M:%S+00:00') END AS created_at_header FROM g""")
def parse_header(spark, d):
    rows = spark.createDataFrame(_HEADERS, "id int, txt string")
    return rows.select("id", *(c.alias(k) for k, c in S.header_fields(F.col("txt")).items()))


_TEXTS = ["2020-01-02T03:04:05", "2020-01-02 03:04:05", "2020/01/02 03:04:05", "2020-01-02", "2020-01-02T03:04:05.25", "2020-01-02T03:04:05+01:00", "soon", ""]


@query(f"SELECT t, strftime({_DATES}, '%Y-%m-%dT%H:%M:%S+00:00') AS utc FROM (VALUES {', '.join(f'({t!r})' for t in _TEXTS)}) v(t)")
def normalize_datetime(spark, d):
    return spark.createDataFrame([(t,) for t in _TEXTS], "t string").select("t", S.utc_text(F.col("t")).alias("utc"))


_SYSTEMS = [("STEP", "SolidWorks 2019"), ("STEP", "Unigraphics NX 12"), ("STEP", "AutoCAD"), ("STEP", "CATIA V5"), ("STEP", "3DEXPERIENCE"), ("STEP", "hand"), ("STEP", None), ("BREP", None), ("UNKNOWN", "NX")]


@query("""WITH v(fmt, system) AS (VALUES ('STEP', 'SolidWorks 2019'), ('STEP', 'Unigraphics NX 12'), ('STEP', 'AutoCAD'), ('STEP', 'CATIA V5'), ('STEP', '3DEXPERIENCE'), ('STEP', 'hand'), ('STEP', NULL), ('BREP', NULL), ('UNKNOWN', 'NX')), l AS (SELECT *, lower(coalesce(system, '')) AS s FROM v)
SELECT fmt, system, CASE WHEN fmt = 'BREP' THEN 'OpenCascade' WHEN fmt <> 'STEP' THEN NULL WHEN regexp_matches(s, 'parasolid|nx|solidworks') THEN 'Parasolid' WHEN regexp_matches(s, 'acis|autocad|inventor') THEN 'ACIS' WHEN regexp_matches(s, 'catia|cgm|3dexperience|solidedge') THEN 'CGM' ELSE 'STEP' END AS kernel FROM l""")
def classify_keywords(spark, d):
    return spark.createDataFrame(_SYSTEMS, "fmt string, system string").select("fmt", "system", S.kernel(F.col("fmt"), F.col("system")).alias("kernel"))


def _events(spark, d):
    return table(spark, d, "events")


@query("SELECT event_id, '***' AS api_token, event_type AS kind, user_id::VARCHAR AS secret_public FROM events")
def redact_map(spark, d):
    fields = F.create_map(F.lit("API_Token"), F.get_json_object("props", "$.k"), F.lit("kind"), F.col("event_type"), F.lit("secret_public"), F.col("user_id").cast("string"))
    m = S.redacted(fields, ("token", "secret"), ("secret_public",))
    return _events(spark, d).select("event_id", m["API_Token"].alias("api_token"), m["kind"].alias("kind"), m["secret_public"].alias("secret_public"))


@query("SELECT event_id, concat_ws('|', event_type, CASE WHEN user_id % 3 > 0 THEN 'user=' || user_id END, 'k=' || (props->>'$.k')) AS line FROM events")
def serialize_line(spark, d):
    return _events(spark, d).select("event_id", S.line_text([F.col("event_type"), F.lit("")], {"user": F.when(F.col("user_id") % 3 > 0, F.col("user_id")), "k": F.get_json_object("props", "$.k")}).alias("line"))


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'purchase')")
def level_filter(spark, d):
    level = F.when(F.col("event_type") == "purchase", "warning").when(F.col("event_type") == "error", "ERROR").otherwise("info")
    return _events(spark, d).where(S.level_at_least(level, "warning")).select("event_id", "event_type")


@query("SELECT vec_id, len(embedding)::INTEGER AS size, 3::INTEGER AS sampled, repeat('x', 10) || '...' AS text FROM embeddings")
def summarise_values(spark, d):
    s = S.summarised(F.col("embedding"))
    return table(spark, d, "embeddings").select("vec_id", s["size"].alias("size"), F.size(s["sample"]).alias("sampled"), S.truncated(F.repeat(F.lit("x"), 20), 10).alias("text"))


@query("""SELECT event_id, user_id::VARCHAR AS job_id, (event_id % 3)::VARCHAR AS attempt, event_type AS msg, NULL::VARCHAR AS trace_id, '{"k":"' || (props->>'$.k') || '","side":"x"}' AS extras FROM events""")
def record_projection(spark, d):
    text = lambda c: F.col(c).cast("string")
    fields = F.create_map(F.lit("job_id"), text("user_id"), F.lit("attempt"), (F.col("event_id") % 3).cast("string"), F.lit("msg"), F.col("event_type"), F.lit("task_id"), text("event_id"), F.lit("stage"), F.lit("s"), F.lit("side"), F.lit("x"), F.lit("k"), F.get_json_object("props", "$.k"))
    found = S.record_fields(fields)
    return _events(spark, d).select("event_id", *(found[c].alias(c) for c in ("job_id", "attempt", "msg", "trace_id")), F.to_json(F.map_from_entries(F.array_sort(F.map_entries(found["extras"])))).alias("extras"))


@query("SELECT event_id, event_id % 5 = 0 OR event_id % 7 = 0 AS poison, CASE WHEN event_id % 5 > 0 AND event_id % 7 > 0 THEN (props->>'$.k')::BIGINT END AS k FROM events")
def poison_quarantine(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    text = F.when(F.col("event_id") % 5 == 0, "{broken").when(F.col("event_id") % 7 == 0, '{"k": 1}').otherwise(F.to_json(F.struct("event_id", k.alias("k"))))
    rows = files.parsed(_events(spark, d).select("event_id", text.alias("text")), "text", "event_id long, k long", "event_id")
    return rows.select("event_id", "poison", F.when(~F.col("poison"), F.col("task.k")).alias("k"))


@query("""WITH t AS (SELECT doc_id, doc_id % 6 AS m, lang FROM documents)
SELECT DISTINCT CASE m WHEN 1 THEN lang || '/__pycache__' WHEN 2 THEN lang || '/' || doc_id || '.tmp' ELSE lang || '/lib.egg-info' END AS target, m <> 2 AS is_dir FROM t WHERE m IN (1, 2, 5)""")
def cleanup_targets(spark, d):
    m, lang, id_ = F.col("doc_id") % 6, F.col("lang"), F.col("doc_id").cast("string")
    below = lambda *parts: F.concat_ws("/", lang, *(p if not isinstance(p, str) else F.lit(p) for p in parts))
    rel = F.when(m == 0, below(".git", "__pycache__", "x.tmp")).when(m == 1, below("__pycache__", "build", id_)).when(m == 2, below(F.concat(id_, F.lit(".tmp")))).when(m == 3, below("venv", "z.tmp")).when(m == 4, below("keep.py")).otherwise(below("lib.egg-info", id_))
    rows = table(spark, d, "documents").select(rel.alias("rel"))
    return files.targets(rows, "rel", ["__pycache__", "build"], [".egg-info"], ["*.tmp", "*~"], [".git", "venv"])


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_extract(spark, d):
    return _events(spark, d).select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT event_id, event_type, (props->>'$.k')::BIGINT AS k FROM events")
def json_roundtrip(spark, d):
    task = F.to_json(F.struct("event_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k")))
    back = F.from_json(task, "event_id long, event_type string, k long")
    return _events(spark, d).select(back.alias("t")).where("t.event_id is not null").select("t.event_id", "t.event_type", "t.k")


@query("SELECT event_id, coalesce(try_cast(CASE WHEN event_id % 4 = 0 THEN event_type ELSE props->>'$.k' END AS BIGINT), -1) AS k FROM events")
def cast_default(spark, d):
    raw = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(F.get_json_object("props", "$.k"))
    return _events(spark, d).select("event_id", S.cast_default(raw, "bigint", -1).alias("k"))


@query("SELECT o_orderkey, 0.2::DOUBLE * pow(2.0::DOUBLE, o_orderkey % 5) AS delay FROM orders")
def backoff(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.backoff(F.col("o_orderkey") % 5 + 1, 0.2).alias("delay"))


@query("""WITH n AS (SELECT o_orderdate, count(*) AS c FROM orders GROUP BY 1), r AS (SELECT o_orderdate, sum(c) OVER (ORDER BY o_orderdate) AS done, sum(c) OVER () AS total FROM n)
SELECT o_orderdate, done::BIGINT AS done, least(100.0::DOUBLE, floor((done * 10000)::DOUBLE / total::DOUBLE) / 100) AS percent FROM r""")
def progress_percent(spark, d):
    from pyspark.sql import Window

    days = table(spark, d, "orders").groupBy("o_orderdate").agg(F.count("*").alias("c"))
    # one row a day is left; its running total is over those few
    done = days.withColumn("done", F.sum("c").over(Window.orderBy("o_orderdate"))).withColumn("total", F.sum("c").over(Window.partitionBy()))
    return done.select("o_orderdate", "done", S.percent(F.col("done"), F.col("total")).alias("percent"))


@query(f"WITH {FIXED}, k AS (SELECT *, row_number() OVER (PARTITION BY task_idx ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY task_idx) AS n FROM t) SELECT task_idx, o_orderkey FROM k WHERE i IN (1, n // 2 + 1, n)")
def first_mid_last(spark, d):
    from pyspark.sql import Window

    out = packing.fixed(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 128)
    w = Window.partitionBy("task_idx")  # 128 rows at most
    out = out.withColumn("i", F.row_number().over(w.orderBy("o_orderkey"))).withColumn("n", F.count("*").over(w))
    return out.where((F.col("i") == 1) | (F.col("i") == F.floor(F.col("n") / 2) + 1) | (F.col("i") == F.col("n"))).select("task_idx", "o_orderkey")


@query("SELECT o_orderkey, ordinal FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS ordinal FROM orders) WHERE ordinal % 100 = 0")
def every_100th(spark, d):
    return order.every_nth(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 100)


@query(f"WITH {FIXED} SELECT task_idx, count(*) AS errors, string_agg('signature_failed:' || o_orderkey, ';' ORDER BY 'signature_failed:' || o_orderkey) AS messages FROM t WHERE o_orderkey % 17 = 0 GROUP BY task_idx")
def errors_per_task(spark, d):
    out = packing.fixed(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 128)
    error = F.when(F.col("o_orderkey") % 17 == 0, F.concat(F.lit("signature_failed:"), "o_orderkey")).otherwise("")
    found = out.withColumn("error", error).where("error <> ''")
    return found.groupBy("task_idx").agg(F.count("*").alias("errors"), F.array_join(F.array_sort(F.collect_list("error")), ";").alias("messages"))


# ---- logs ----

_BURST = """i AS (SELECT event_type, event_id, epoch_us(ts) / 1000000.0::DOUBLE AS t, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT event_type, event_id, rn, true AS admitted, [t] AS q FROM i WHERE rn = 1 UNION ALL
SELECT i.event_type, i.event_id, i.rn, len(list_filter(r.q, lambda x: x > i.t - 3600)) < 2, CASE WHEN len(list_filter(r.q, lambda x: x > i.t - 3600)) < 2 THEN list_append(list_filter(r.q, lambda x: x > i.t - 3600), i.t) ELSE list_filter(r.q, lambda x: x > i.t - 3600) END
FROM r JOIN i ON i.event_type = r.event_type AND i.rn = r.rn + 1)"""


@query(f"WITH RECURSIVE {_BURST} SELECT event_type, event_id, admitted FROM r")
def burst_limit(spark, d):
    return logs.burst_limit(_events(spark, d), ["event_type"], "ts", "event_id", 2, 3600.0)


@query("SELECT event_id, event_type FROM events WHERE ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT % 1000 < 100")
def rate_sample_hash(spark, d):
    return order.hash_sample(_events(spark, d), F.col("event_id"), 0.1).select("event_id", "event_type")


@query(f"WITH RECURSIVE {_BURST} SELECT event_type, event_id, admitted FROM r")
def burst_limit_stream(spark, d):
    events = stateful.parquet_stream(spark, f"{d}/events.parquet", ["event_id", "event_type", "ts"])
    return _drained(spark, stateful.burst_limited(events, "event_type", "ts", "event_id", 2, 3600.0), "append")


# ---- the queue: events as its log, a user's to a record; a lease or a delay is half a day ----

LEASE, ATTEMPTS = 43200.0, 14
_OP = "CASE event_type WHEN 'signup' THEN 'put' WHEN 'view' THEN 'lease' WHEN 'error' THEN 'nack' WHEN 'click' THEN 'extend' ELSE CASE WHEN event_id % 16 = 0 THEN 'ack' ELSE 'lease' END END"
LOG = f"o AS (SELECT user_id AS rec_id, event_id AS seq, epoch_us(ts) / 1000000.0::DOUBLE AS t, {_OP} AS op FROM events)"
#: The fold, one operation of every record at a time, and its states at the time of the last operation of all.
FOLD = f"""{LOG}, i AS (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY t, seq) AS rn FROM o),
r AS (SELECT DISTINCT rec_id, 0::BIGINT AS rn, false AS known, false AS acked, false AS dead, 0 AS attempts, 0::DOUBLE AS lu, 0::DOUBLE AS va, 0::DOUBLE AS t FROM o UNION ALL
SELECT rec_id, rn, known OR op = 'put', acked OR (live AND (op = 'ack' OR (due AND attempts >= {ATTEMPTS}))), dead OR (live AND due AND attempts >= {ATTEMPTS}), CASE WHEN live AND due AND attempts < {ATTEMPTS} THEN attempts + 1 ELSE attempts END,
CASE WHEN live AND ((due AND attempts < {ATTEMPTS}) OR (op = 'extend' AND lu > 0)) THEN t + {LEASE} WHEN live AND op IN ('ack', 'nack') THEN 0 ELSE lu END, CASE WHEN live AND op = 'nack' THEN t + {LEASE} ELSE va END, t
FROM (SELECT *, known AND NOT acked AND op <> 'put' AS live, op = 'lease' AND lu = 0 AND va <= t AS due FROM (SELECT i.rec_id, i.rn, i.op, i.t, known, acked, dead, attempts, CASE WHEN lu > 0 AND lu <= i.t THEN 0 ELSE lu END AS lu, CASE WHEN lu > 0 AND lu <= i.t THEN lu ELSE va END AS va FROM r JOIN i ON i.rec_id = r.rec_id AND i.rn = r.rn + 1))),
e AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY rn DESC) = 1), c AS (SELECT max(t) AS now FROM o),
n AS (SELECT rec_id, known, acked, dead, attempts, CASE WHEN lu > 0 AND lu <= now THEN 0 ELSE lu END AS lu, CASE WHEN lu > 0 AND lu <= now THEN lu ELSE va END AS va, now FROM e, c),
s AS (SELECT *, CASE WHEN NOT known THEN 'unknown' WHEN dead THEN 'dead' WHEN acked THEN 'acked' WHEN lu > now THEN 'leased' WHEN va <= now THEN 'visible' ELSE 'delayed' END AS status FROM n)"""


def _log(spark, d, events=None):
    kind = F.col("event_type")
    op = F.when(kind == "signup", "put").when(kind == "view", "lease").when(kind == "error", "nack").when(kind == "click", "extend").otherwise(F.when(F.col("event_id") % 16 == 0, "ack").otherwise("lease"))
    rows = _events(spark, d) if events is None else events
    return rows.select(F.col("user_id").alias("rec_id"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").cast("double").alias("ts"), op.alias("op"), F.lit(LEASE).alias("arg"))


def _states(spark, d):
    log = _log(spark, d)
    return queue.fold(log, log.agg(F.max("ts")).first()[0] or 0.0, max_attempts=ATTEMPTS)


@query(f"WITH RECURSIVE {FOLD} SELECT rec_id, status, attempts, lu AS lease_until, va AS visible_at, dead FROM s")
def queue_fold(spark, d):
    return _states(spark, d)


@query(f"WITH RECURSIVE {FOLD} SELECT rec_id, attempts FROM s WHERE status = 'visible' AND attempts < {ATTEMPTS}")
def queue_visible(spark, d):
    return queue.visible(_states(spark, d), ATTEMPTS).select("rec_id", "attempts")


@query(f"WITH RECURSIVE {FOLD} SELECT rec_id FROM s WHERE status = 'visible' ORDER BY rec_id LIMIT 20")
def queue_lease_fifo(spark, d):
    return queue.lease(_states(spark, d), 20).select("rec_id")


@query(f"WITH RECURSIVE {FOLD} SELECT count(*) FILTER (status = 'visible') AS visible, count(*) FILTER (status = 'leased') AS leased, count(*) FILTER (status = 'acked') AS acked, count(*) FILTER (status = 'dead') AS dead, count(*) FILTER (known) AS total FROM s")
def queue_stats(spark, d):
    return queue.stats(_states(spark, d))


@query(f"WITH RECURSIVE {FOLD} SELECT coalesce(min(rec_id // 16) FILTER (NOT acked), max(rec_id // 16)) AS head_segment FROM s")
def queue_head(spark, d):
    return queue.head_segment(_states(spark, d), 16)


@query(f"WITH {LOG} SELECT rec_id, seq, row_number() OVER (PARTITION BY rec_id ORDER BY t, seq)::INTEGER AS attempt FROM o WHERE op = 'lease'")
def attempt_number(spark, d):
    from pyspark.sql import Window

    leases = _log(spark, d).where("op = 'lease'")
    return leases.select("rec_id", "seq", F.row_number().over(Window.partitionBy("rec_id").orderBy("ts", "seq")).alias("attempt"))


@query(f"WITH {LOG} SELECT rec_id, seq FROM o WHERE op = 'ack' AND rec_id IN (SELECT rec_id FROM o WHERE op = 'lease')")
def ack_semi_join(spark, d):
    log = _log(spark, d)
    return log.where("op = 'ack'").join(log.where("op = 'lease'").select("rec_id").distinct(), "rec_id", "left_semi").select("rec_id", "seq")


@query(f"WITH {LOG} SELECT DISTINCT rec_id FROM o WHERE rec_id NOT IN (SELECT rec_id FROM o WHERE op = 'ack')")
def unacked_anti_join(spark, d):
    log = _log(spark, d)
    return log.select("rec_id").distinct().join(log.where("op = 'ack'"), "rec_id", "left_anti")


@query(f"WITH RECURSIVE {FOLD} SELECT count(*) FILTER (known) = count(*) FILTER (acked) AS drained FROM s")
def is_drained(spark, d):
    return queue.drained(_states(spark, d))


@query(f"WITH {LOG}, a AS (SELECT DISTINCT rec_id FROM o WHERE op = 'ack') SELECT rec_id // 32 AS segment, bit_or(1::BIGINT << (rec_id % 32)::INTEGER) AS bits, count(*) AS acked FROM a GROUP BY 1")
def ack_bitmap(spark, d):
    return queue.ack_bitmap(_log(spark, d).where("op = 'ack'"))


@query(f"WITH RECURSIVE {FOLD}, f AS (SELECT rec_id FROM s WHERE status = 'visible' ORDER BY rec_id LIMIT 20) SELECT (rec_id % 4)::INTEGER AS queue, count(*) AS n, string_agg(rec_id::VARCHAR, ';' ORDER BY rec_id) AS rec_ids FROM f GROUP BY 1")
def group_by_queue(spark, d):
    return queue.by_queue(queue.lease(_states(spark, d), 20), F.pmod("rec_id", F.lit(4)).cast("int"))


@query(f"""WITH RECURSIVE {FOLD} SELECT rec_id, CASE WHEN NOT known THEN 'unknown' WHEN dead THEN 'dead' WHEN acked THEN 'acked' WHEN lu > t THEN 'leased' WHEN va <= t THEN 'visible' ELSE 'delayed' END AS status, attempts, lu AS lease_until, va AS visible_at, dead FROM e""")
def queue_fold_stream(spark, d):
    events = stateful.parquet_stream(spark, f"{d}/events.parquet", ["event_id", "user_id", "event_type", "ts"])
    return _drained(spark, stateful.queue_states(_log(spark, d, events), max_attempts=ATTEMPTS), "update")


def _drained(spark, stream, mode):
    import uuid

    return stateful.drain(stream, mode, f"{shared_dir(spark)}/sigloom/stream-{uuid.uuid4().hex}")


# ---- extras, common on such tables but not of the surveyed inventory ----


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def extra_pricing_summary(spark, d):
    rows = table(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))
