"""Derived cases: analytic shapes, queue scenarios on a logical clock, packing, files and sinks."""

import datetime
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from sigloom.functions import scalars as S
from sigloom.operators import duplicates, fingerprints, geometry, joins, logs, order, packing, queue
from sigloom.plans import catalog
from sigloom.sources import files, sinks
from sigloom.streaming import stateful


def cube(spark, side=10.0, shift=0.0, part="box"):
    return spark.createDataFrame([(part, i, shift + side * (i & 1), shift + side * (i >> 1 & 1), shift + side * (i >> 2)) for i in range(8)], "part string, idx int, x double, y double, z double")


def test_descriptors_do_not_change_under_shift_and_scale(spark):
    points = cube(spark).union(cube(spark, 13.0, 5.0, "scaled"))
    ratios = {r["part"]: (r["r1"], r["r2"]) for r in geometry.box_ratios(points).collect()}
    assert all(math.isclose(v, 1, abs_tol=1e-9) for r in ratios.values() for v in r)
    hist = geometry.distance_histogram(points, F.pmod(F.col("idx") * 3 + 1, F.col("n")))
    rows = {}
    for r in hist.collect():
        rows.setdefault(r["part"], set()).add((r["bin"], r["cnt"]))
    assert rows["box"] == rows["scaled"]
    dense = geometry.dense(hist, "part", 64).collect()
    assert all(len(r["hist"]) == 64 and abs(sum(r["hist"]) - 1) < 1e-9 for r in dense)


def test_few_points_give_no_descriptors(spark):
    rows = geometry.signature_rows(cube(spark).where("idx < 3")).collect()
    assert [(r["has_points"], r["r1"], r["r2"]) for r in rows] == [(0, None, None)]
    assert geometry.drawn_histogram(cube(spark).where("idx < 3"), pairs=50).count() == 0


def test_drawn_pairs_are_counted(spark):
    rows = geometry.drawn_histogram(cube(spark), pairs=500, seed=3).collect()
    corner = [(i & 1, i >> 1 & 1, i >> 2) for i in range(8)]
    want = {}
    for k in range(500):
        a, b = corner[(k * 7919 + 3) % 8], corner[(k * 104729 + k // 8 + 13) % 8]
        v = math.dist(a, b) / math.sqrt(3) / math.sqrt(3)
        want[min(63, int(v * 64))] = want.get(min(63, int(v * 64)), 0) + 1
    assert {r["bin"]: r["cnt"] for r in rows} == want


def test_surfaces_and_dihedral_angles(spark):
    faces = spark.createDataFrame([("c", i, "plane") for i in range(6)] + [("y", 0, "plane"), ("y", 1, "plane"), ("y", 2, "cylinder"), ("o", 0, "odd")], "part string, face int, surface_type string")
    found = {r["part"]: r for r in geometry.surface_histogram(faces).collect()}
    assert found["c"]["plane"] == 1 and math.isclose(found["y"]["plane"], 2 / 3) and found["o"]["free"] == 1
    edges = spark.createDataFrame([("c", "e1", 0, 0.0, 0.0, 1.0), ("c", "e1", 1, 1.0, 0.0, 0.0), ("c", "e1", 2, 0.0, 0.0, 1.0), ("c", "e2", 0, 0.0, 1.0, 0.0)], "part string, edge string, seq int, nx double, ny double, nz double")
    pairs = geometry.edge_pairs(edges, ["part", "edge"], ["seq"], ["nx", "ny", "nz"])
    assert [(r["bin"] in (17, 18), r["cnt"]) for r in geometry.dihedral_histogram(pairs).collect()] == [(True, 1)]
    turned = spark.createDataFrame([("c", 0.0, 0.0, 1.0, False, 0.0, 0.1, 1.0, True)], "part string, nx_a double, ny_a double, nz_a double, r_a boolean, nx_b double, ny_b double, nz_b double, r_b boolean")
    assert [geometry.dihedral_histogram(turned, flipped=f).first()["bin"] for f in (None, "r")] == [1, 34]


def test_fingerprints_ignore_order_but_not_multiplicity(spark):
    ids = [f"p{i}" for i in range(50)]
    a = spark.createDataFrame([(i,) for i in ids], "id string")
    b = spark.createDataFrame([(i,) for i in random.Random(2).sample(ids, 50)], "id string").repartition(3)
    for f in (fingerprints.of_ids("id"), fingerprints.of_rows([F.col("id")])):
        assert a.agg(f).first()[0] == b.agg(f).first()[0] != a.union(a.limit(1)).agg(f).first()[0]
    s = [fingerprints.scalable(x, [F.col("id")]).first()["digest"] for x in (a, b, a.union(a.limit(1)))]
    assert s[0] == s[1] != s[2]
    assert fingerprints.aggregate_outputs(a.limit(0), "id").first().asDict() == {"rows": 0, "fingerprint": None}


@pytest.mark.parametrize("n", [1, 300, 1000])
def test_next_fit_in_sequence(spark, n):
    rng = random.Random(n)
    weights = [rng.randint(1, 40) / 8 for _ in range(n)]
    want, task, count, weight = [], 0, 0, 0.0
    for w in weights:
        if count >= 7 or weight >= 12 - 1e-9:
            task, count, weight = task + 1, 0, 0.0
        count, weight = count + 1, weight + w
        want.append(task)
    items = spark.createDataFrame([("j", i, w) for i, w in enumerate(weights)], "job string, i int, weight double")
    got = packing.weighted(items.repartition(3), "job", ["i"], "weight", 7, 12.0).orderBy("i").collect()
    assert [r["task_idx"] for r in got] == want


def test_derived_packing_of_cycling_weights(spark):
    items = spark.createDataFrame([("j", i, i % 4 + 1.0) for i in range(12)], "job string, i int, weight double")
    rows = packing.weighted(items, "job", ["i"], "weight", 100, 5.0).groupBy("task_idx").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).orderBy("task_idx").collect()
    assert [(r["n"], r["w"]) for r in rows] == [(3, 6), (2, 5), (2, 5), (2, 5), (2, 5), (1, 4)]
    with pytest.raises(Exception, match="exceeds"):
        packing.weighted(items, "job", ["i"], "weight", 100, 3.5, strict=True).collect()
    with pytest.raises(ValueError):
        packing.fixed(items, ["i"], 0)


def ops(spark, rows):
    return spark.createDataFrame([(r, i, t, o, a) for i, (r, t, o, a) in enumerate(rows)], "rec_id long, seq long, ts double, op string, arg double")


def test_queue_scenarios(spark):
    log = [(1, 0.0, "put", 0.0), (2, 0.0, "put", 0.0), (1, 1.0, "lease", 5.0), (1, 2.0, "ack", 0.0), (2, 2.0, "lease", 1.0), (2, 2.5, "nack", 0.0), (2, 3.0, "lease", 0.1), (2, 3.05, "extend", 0.5)]
    state = lambda rows, now, **k: {r["rec_id"]: (r["status"], r["attempts"]) for r in queue.fold(ops(spark, rows), now, **k).collect()}
    assert state(log, 3.2) == {1: ("acked", 1), 2: ("leased", 2)}
    assert state(log, 4.0) == {1: ("acked", 1), 2: ("visible", 2)}
    assert state(log + [(2, 4.0, "lease", 1.0)], 4.5)[2] == ("leased", 3)
    assert state(log + [(2, 4.0, "lease", 1.0)], 4.5, max_attempts=2)[2] == ("dead", 2)
    assert state([(3, 0.0, "ack", 0.0)], 1.0) == {3: ("unknown", 0)}


def test_queue_sampling_fills_from_drawn_queues(spark):
    records = lambda ids: spark.createDataFrame([(i, "visible", 0) for i in ids], "rec_id long, status string, attempts int")
    got = queue.sample_queues([records([1]), records([2])], 2, 2, seed=1).collect()
    assert {r["rec_id"] for r in got} == {1, 2}


def test_visibility_follows_the_clock(spark):
    rows = [(1, 0.0, "put", 0.0), (2, 0.0, "put", 0.0), (3, 0.0, "put", 0.0), (1, 1.0, "lease", 5.0), (2, 1.0, "lease", 5.0), (2, 2.0, "nack", 10.0), (3, 1.0, "lease", 1.0), (3, 1.5, "ack", 0.0), (4, 1.0, "lease", 1.0)]
    at = lambda now: queue.fold(ops(spark, rows), now)
    assert [[r["rec_id"] for r in queue.visible(at(t)).orderBy("rec_id").collect()] for t in (3.0, 6.0, 12.0)] == [[], [1], [1, 2]]
    assert queue.stats(at(3.0)).first().asDict() == {"visible": 0, "leased": 1, "acked": 1, "dead": 0, "total": 3}
    assert queue.visible(at(12.0), 1).count() == 0 and not queue.drained(at(12.0)).first()["drained"]
    done = [(1, 0.0, "put", 0.0), (1, 1.0, "lease", 1.0), (1, 1.5, "ack", 0.0)]
    assert queue.drained(queue.fold(ops(spark, done), 9.0)).first()["drained"]


def test_streams_go_on_after_a_restart(spark, tmp_path):
    """Recovery: what a first run folded is the state from which the next one goes on, leases and attempts included."""
    source, folder = tmp_path / "in", str(tmp_path / "out")
    schema = "rec_id long, seq long, ts double, op string, arg double"
    put = lambda rows: ops(spark, rows).coalesce(1).write.mode("append").parquet(str(source))
    run = lambda: stateful.drain(stateful.queue_states(spark.readStream.schema(schema).parquet(str(source)), max_attempts=2), "update", folder)
    put([(1, 0.0, "put", 0.0), (1, 1.0, "lease", 5.0), (2, 0.0, "put", 0.0)])
    assert {(r["rec_id"], r["status"], r["attempts"]) for r in run().collect()} == {(1, "leased", 1), (2, "visible", 0)}
    assert run().count() == 2  # nothing new: nothing is done again
    put([(1, 7.0, "lease", 5.0), (2, 7.0, "ack", 0.0)])
    assert {(r["rec_id"], r["status"], r["attempts"]) for r in run().collect()} >= {(1, "leased", 2), (2, "acked", 0)}
    put([(1, 20.0, "lease", 5.0)])
    assert {(r["rec_id"], r["status"], r["attempts"], r["dead"]) for r in run().collect()} >= {(1, "dead", 2, True)}


def test_strategies_by_name_and_shuffles(spark):
    assert [packing.strategy(n) for n in (" Chunk", "LPT", "stable", "hash", "weighted")] == ["fixed", "weighted", "hash", "hash", "weighted"]
    with pytest.raises(ValueError, match="no such strategy"):
        packing.strategy("random")
    items = spark.createDataFrame([(j, i, 1.0) for j in "ab" for i in range(10)], "job string, i int, weight double")
    sizes = lambda how: sorted(r["count"] for r in packing.assigned(items, how, "job", ["i"], "weight", 4, 100.0).groupBy("job", "task_idx").count().collect())
    assert sizes("chunk") == [2, 2, 4, 4, 4, 4] == sizes("greedy") and sum(sizes("mod")) == 20
    some = packing.assigned(items, "chunk", "job", ["i"], "weight", 5, 100.0)
    one, again, other = ([(r["job"], r["i"], r["place"]) for r in packing.shuffled(some, ["job", "task_idx"], "i", s).orderBy("job", "i").collect()] for s in (1, 1, 2))
    assert one == again != other and sorted(p for _, _, p in one) == sorted([0, 1, 2, 3, 4] * 4)


def test_records_and_targets(spark):
    df = spark.createDataFrame([(1, {"msg": "m", "task_id": "t", "a": "b"}), (2, {"stage": "s"})], "i int, f map<string,string>")
    found = S.record_fields(F.col("f"))
    assert [(r["msg"], r["extras"]) for r in df.select("i", found["msg"].alias("msg"), found["extras"].alias("extras")).orderBy("i").collect()] == [("m", {"a": "b"}), (None, None)]
    rows = spark.createDataFrame([(p,) for p in ("a/build/x/y", "a/build/z", ".git/build/x", "a/x.tmp", "a/x.py", "q~", "build", "a/b.egg-info/PKG")], "rel string")
    got = {(r["target"], r["is_dir"]) for r in files.targets(rows, "rel", ["build"], [".egg-info"], ["*.tmp", "*~"], [".git"]).collect()}
    assert got == {("a/build", True), ("a/x.tmp", False), ("q~", False), ("a/b.egg-info", True)}
    texts = spark.createDataFrame([(1, '{"k": 1}'), (2, "{broken"), (3, None), (4, '{"j": 1}')], "i int, t string")
    assert [r["poison"] for r in files.parsed(texts, "t", "k int", "k").orderBy("i").collect()] == [False, True, True, True]


def test_burst_limit_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), float(rng.randint(0, 400))) for i in range(300)]
    want = {}
    for key in "ab":
        window = []
        for i, _, t in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
            window = [w for w in window if w > t - 20]
            want[i] = len(window) < 3
            window += [t] * want[i]
    events = spark.createDataFrame(rows, "id long, key string, ts double").repartition(4)
    assert {r["id"]: r["admitted"] for r in logs.burst_limit(events, ["key"], "ts", "id", 3, 20.0).collect()} == want


def test_ordinals_heads_and_samples(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    assert all(r["k"] == r["ordinal"] for r in order.with_ordinal(df, ["k"]).collect())
    assert [r["k"] for r in order.head(df, ["k"], frac=0.0025).collect()] == [0, 1, 2]
    assert order.head(df, ["k"], n=0).count() == 0 and order.head(df, ["k"], n=5000).count() == 1000
    hot = df.withColumn("g", F.when(F.col("id") < 900, 0).otherwise(1))
    firsts = order.first_k(hot, ["g"], ["k"], 3).orderBy("g", "rank").collect()
    want = {g: sorted(i * 7919 % 1000 for i in range(1000) if (i >= 900) == bool(g))[:3] for g in (0, 1)}
    assert [r["k"] for r in firsts] == want[0] + want[1]
    assert order.cyclic(df.limit(0), ["k"], 5, "id").count() == 0


def test_joins_and_maps(spark):
    refs, items = spark.createDataFrame([(1,), (2,)], "r int"), spark.createDataFrame([(1, "a")], "r int, v string")
    assert joins.items_left(refs, items, "r").count() == 2
    with pytest.raises(Exception, match="no item for 2"):
        joins.items_inner(refs, items, "r", must_match=True).collect()
    devices = spark.createDataFrame([(0,), (1,), (2,)], "d int")
    assert [r["d"] for r in joins.preferred(devices, "d", [2, 0]).orderBy("rank").collect()] == [2, 0]
    assert [r["d"] for r in joins.preferred(devices, "d", [9]).orderBy("rank").collect()] == [0, 1, 2]
    m = spark.range(1).select(joins.map_merged(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3))).alias("m")).first()["m"]
    assert m == {"a": 1, "b": 3}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "raw"
    header = "FILE_NAME('n','2020-01-02T03:04:05',('Ann'),('O'),'pre','SolidWorks','a');FILE_SCHEMA(('AP214'));"
    for name in ("z.STEP", "a/y.stp", "a/b/x.brep", "a-b/w.brp", "a/n.txt", ".step"):
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(header if name.endswith(("STEP", "stp")) else name)
    return str(root)


def test_file_tree(spark, tree):
    found = [r["payload_ref"] for r in files.items(files.scan(spark, tree)).orderBy("index").collect()]
    # names that begin with a dot are hidden from Spark's listing
    assert found == ["z.STEP", "a/y.stp", "a/b/x.brep", "a-b/w.brp"]
    for n, many in ((0, 0), (2, 2), (99, 4)):
        assert files.discover(spark, tree, subset_n=n).count() == many
    for frac, many in ((0, 0), (0.5, 2), (1, 4)):
        assert files.discover(spark, tree, subset_frac=frac).count() == many
    rows = {r["rel"]: r for r in files.describe(spark, tree).collect()}
    assert rows["z.STEP"]["kernel"] == "Parasolid" and rows["z.STEP"]["source_dataset"] == "unknown" and rows["z.STEP"]["created_at"] == "2020-01-02T03:04:05+00:00"
    assert rows["a/b/x.brep"]["kernel"] == "OpenCascade" and rows["a/b/x.brep"]["repo"] == "b" and rows["a/b/x.brep"]["author"] is None
    assert {r["rel"]: r["originating_system"] for r in files.describe(spark, tree, compat=True).collect()}["z.STEP"] == "pre"


def test_lines_in_several_encodings(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes("﻿één\nzwei\n".encode())
    (tmp_path / "g.csv").write_bytes("中文".encode("gb18030"))
    rows = {(r["rel"], r["line"]): r["text"] for r in files.lines(spark, str(tmp_path)).collect()}
    assert rows["u.csv", 1] == "één" and rows["u.csv", 2] == "zwei" and rows["g.csv", 1] == "中文"


def test_csv_parts_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", [1.0, 2.0], None, 1), ("a", None, "x", 2)], "part string, hist array<double>, error string, task int")
    assert sinks.flat(rows).columns == ["error", "hist", "part", "task"]
    path = sinks.route(rows, str(tmp_path), "t1", final=False)
    back = files.read_csv_parts(spark, path, sinks.flat(rows).schema).collect()
    assert sorted((r["part"], r["hist"] or "", r["error"] or "") for r in back) == [("a", "", "x"), ("b", "[1.0,2.0]", "")]
    sinks.write_csv(rows, str(tmp_path / "by"), by="task")
    sinks.write_csv(rows.where("task = 1"), str(tmp_path / "by"), by="task")
    assert {p.name for p in (tmp_path / "by").iterdir() if p.is_dir()} == {"task=1", "task=2"}
    final = sinks.route(rows.select("part"), str(tmp_path), "summary", final=True)
    assert spark.read.json(final).count() == 2
    for bad in ("/abs", "../up", None):
        with pytest.raises(ValueError):
            sinks.route(rows, str(tmp_path), bad, final=True)
    assert sinks.stamped("d", "s", datetime.datetime(2020, 1, 2, 3, 4, 5)) == "d/s_20200102-030405.csv"
    union = sinks.union([rows.select("part"), rows.select("error")])
    assert union.columns == ["part", "error"] and union.count() == 4


def test_example_items(spark, tmp_path):
    weights = [1.2, 0.8, 0.4, 0.5, 2.6, 1.9]
    (tmp_path / "items.json").write_text(json.dumps([{"part_id": f"part-{i + 1:03}", "group": "g", "weight": w, "category": "c", "description": "d"} for i, w in enumerate(weights)]))
    items = files.read_items(spark, str(tmp_path / "items.json"))
    more = order.cyclic(items, ["part_id"], 12, "part_id")
    assert {r["part_id"] for r in more.where("copy = 1").collect()} == {f"part-00{i}_dup1" for i in range(1, 7)}
    tasks = packing.tasks(packing.fixed(more, ["copy", "part_id"], 1), ["task_idx"], "part_id", "copy", "weight")
    total = packing.totals(tasks).first()
    assert (total["tasks"], total["items"]) == (12, 12) and math.isclose(total["weight"], 14.8, abs_tol=1e-9)


def test_suffixes_and_scalars(spark):
    assert files.normalised_suffixes([" GZ", "tar.gz", "", ".gz"]) == [".tar.gz", ".gz"]
    row = spark.createDataFrame([(" x ", 0.0125, [1, 2])], "s string, v double, a array<int>").select(
        S.extension(F.lit("a.b/c")).alias("none"), S.extension(F.lit("x/Y.StP")).alias("ext"), F.bround("v", 3).alias("even"), S.padding(F.lit(13)).alias("pad"),
        S.edge_key([F.lit(2.0), F.lit(0.0)], [F.lit(1.0), F.lit(5.0)])["low"]["c0"].alias("low"), S.canonical_map(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2))).alias("map"),
        S.zoned_text(F.lit("2020-01-01 00:00:00").cast("timestamp")).alias("zone"), S.relative(F.lit("/r/a/b"), "/r").alias("rel"), S.relative(F.lit("/q/a"), "/r").alias("abs"),
    ).first()
    assert row["none"] == "" and row["ext"] == ".stp" and row["even"] == 0.012 and row["pad"] == 3 and row["low"] == 1.0
    assert row["map"] == '{"a":2,"b":1}' and row["zone"] == "2020-01-01T08:00:00" and row["rel"] == "a/b" and row["abs"] == "/q/a"


def test_burst_state_is_bounded():
    b = logs.Burst(2, 10.0)
    assert [b.admit(t) for t in (0.0, 1.0, 2.0, 10.0, 10.5, 11.0)] == [True, True, False, True, False, True]
    assert len(b.admitted) == 2 and stateful.Record is queue.Record


def near_rows(spark):
    """Vectors in two dimensions of ``near`` and groups of near copies; some repeat an id, are zero, shorter, not finite or lack something."""
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 0.12) for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, [0.3, 0.3, *(draw.gauss(0, 1e-3) for _ in range(5)), 0.5]) for i in range(60)]
    rows += [(7, [0.01, 0.02, 0.5]), (8, [0.02, 0.01, 0.5]), (3, rows[4][1]), (3, rows[4][1]), (300, [0.0] * 8), (301, [0.1, 0.0, math.nan, *[0.1] * 5]), (302, [math.nan, *[0.1] * 7]), (303, [0.1, None, *[0.1] * 6]), (304, None), (None, [0.1] * 8)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)


def near_values():
    return [F.get("embedding", F.lit(0)), F.get("embedding", F.lit(1))]


def near_by_force(rows):
    good = [(i, v) for i, v in rows if i is not None and v is not None and None not in v]
    out = []
    for i, v in good:
        for j, w in good:
            if i < j and len(v) == len(w) and abs(v[0] - w[0]) <= 0.1 and abs(v[1] - w[1]) <= 0.1:
                lengths = math.sqrt(sum(x * x for x in v)) * math.sqrt(sum(x * x for x in w))
                cosine = sum(x * y for x, y in zip(v, w)) / lengths if lengths else math.nan
                if not cosine < 0.3:
                    out.append((i, j, "nan" if cosine != cosine else round(cosine, 9)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [16, 8192])
def test_near_clusters_are_the_components_of_all_near_pairs_and_need_a_forest_only(spark, monkeypatch, block):
    rows, df = near_rows(spark)
    pairs, seen = near_by_force(rows), []
    monkeypatch.setattr(duplicates, "clusters", lambda links, f=duplicates.clusters: seen.append(links.count()) or f(links))
    got = {r["id"]: r["cluster"] for r in duplicates.near_clusters(df, "vec_id", "embedding", near_values(), 0.1, 0.3, block=block).collect()}
    want = {i: i for a, b, _ in pairs for i in (a, b)}
    for _ in want:
        for a, b, _ in pairs:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert seen[0] < len(rows) if block > len(rows) else seen[0] < len(pairs)


@pytest.mark.parametrize("block", [16, 8192])
def test_near_pairs_are_all_pairs_found_by_force(spark, block):
    rows, df = near_rows(spark)
    found = duplicates.near_pairs(df, "vec_id", "embedding", near_values(), 0.1, 0.3, block=block).collect()
    assert sorted(((r["a"], r["b"], "nan" if math.isnan(r["similarity"]) else round(r["similarity"], 9)) for r in found), key=str) == near_by_force(rows)
    assert duplicates.near_pairs(df.limit(0), "vec_id", "embedding", near_values(), 0.1, 0.3).count() == 0


def test_dihedral_query_takes_the_same_lines_of_one_number_whatever_order_they_come_in(spark, tmp_path):
    lines = [(1, 1, 1, 10.0, 0.0, 0.0), *((1, 2, 1, *v) for v in ((0.0, 0.1, 0.0), (5.0, 0.05, 0.0), (50.0, 0.0, 0.01)))]
    found = []
    for k, some in enumerate((lines, lines[::-1])):
        spark.createDataFrame(some, "l_partkey long, l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double").coalesce(1).write.parquet(f"{tmp_path}/{k}/lineitem.parquet")
        found.append(catalog.QUERIES["dihedral_hist"](spark, f"{tmp_path}/{k}").collect())
    assert found[0] == found[1] and [(r["part"], r["bin"], r["cnt"]) for r in found[0]] == [(1, 18, 1)]
