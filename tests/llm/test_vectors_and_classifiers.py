"""Searches and joins of vectors against brute force; classifiers by held-out accuracy; the pipeline stage by stage."""

import ctypes
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from sigloom.llm import egojoin, quality, topk, toxicity
from sigloom.llm.labelled import held_out
from sigloom.llm.shared import released, table, written
from tests.llm.test_text_operators import shingles, union_find

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], VECTORS).withColumns({c: F.lit(1) for c in ("key", "v", "block", "side", "size", "rep")})


ODD = [(900, None), (901, []), (902, [0.0] * 12), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11), (905, [None] + [1.0] * 11), (906, [1.0] * 5), (None, [1.0] * 12)]


@pytest.mark.parametrize("blocks", [8192, 30])
def test_top_k_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "ROWS", blocks)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(blocks)
    x = np.round(rng.normal(size=(250, 12)), 1).astype(np.float32)  # rounded: many ties
    x[40:60] = x[3]
    rows = [(i * 7 % 1000, x[i]) for i in range(250)] + ODD + [(100, x[5])]
    got = sorted(map(tuple, topk.top_k(vectors(spark, rows)).select("query_id", "rank", "vec_id", "score").collect()))
    good = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and len(v) == 12 and all(c is not None and np.isfinite(c) for c in v)]
    want = []
    for i, q in good:
        if i % 100 == 0:
            best = sorted((-int(q @ v), j) for j, v in good if j != i)[:10]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert got == sorted(want)
    few = topk.top_k(vectors(spark, [(0, [1.0]), (1, [2.0])])).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in few] == [(0, 1, 1, 2048 * 1024)]
    assert topk.top_k(vectors(spark, ODD[:4])).count() in (0, 0) and topk.top_k(vectors(spark, ODD).limit(0)).count() == 0


def test_reading_stops_early():
    rng = np.random.default_rng(3)
    values = np.floor(1024 * rng.normal(size=(5000, 4)))
    lists = topk.Lists(np.arange(5000), values)
    q = np.array([3000.0, 10.0, -5.0, 1.0])
    ids, scores = lists.search(q, -1, 10)
    assert lists.scored < 0.2 * 5000  # one weight outdoes the others, so its list alone tells the bound
    order = np.lexsort((np.arange(5000), -(values @ q)))[:10]
    assert ids.tolist() == order.tolist() and scores.tolist() == (values @ q)[order].astype(int).tolist()


@pytest.mark.parametrize("block", [4096, 25])
def test_near_vectors_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(egojoin, "BLOCK", block)
    monkeypatch.setattr(egojoin, "INTERVAL", 3)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(20, 12))
    x = np.array([centres[i % 20] * rng.uniform(0.5, 3) + rng.normal(scale=0.2, size=12) for i in range(240)], np.float32)
    x[200:215] = x[0]
    rows = [(i * 3 + 1, x[i]) for i in range(240)] + ODD
    out = egojoin.near_duplicates(vectors(spark, rows)).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    links = [(i, j) for i, j in zip(*np.nonzero(near)) if i < j]
    root = union_find(range(240), links)
    want = {(i * 3 + 1, int(near[i].sum()) - 1, root[i] * 3 + 1, root[i] == i) for i in range(240)} | {(i, 0, i, i is not None) for i, _ in ODD}
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out} == want and len(out) == 248
    assert links and egojoin.near_duplicates(vectors(spark, ODD).limit(0)).count() == 0 and egojoin.near_duplicates(vectors(spark, ODD)).count() == len(ODD)


def test_near_vectors_of_repeated_ids(spark):
    rows = [(1, [1, 0, 0]), (1, [0, 1, 0]), (2, [1, 0.01, 0]), (0, [0, 0.02, 1]), (3, [0, 0, 1]), (3, [0, 0, 1])]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in egojoin.near_duplicates(vectors(spark, rows)).collect())
    assert got == sorted([(1, 1, 1), (1, 0, 1), (2, 1, 1), (0, 2, 0), (3, 2, 0), (3, 2, 0)])


def test_boxes_are_joined_by_halving(monkeypatch):
    rng = np.random.default_rng(6)
    low = np.sort(rng.normal(size=(300, 3)), axis=0)
    boxes = np.stack([low, low + 0.1], axis=1)
    gap = np.maximum(0, np.maximum(low[:, None] - low[None] - 0.1, low[None] - low[:, None] - 0.1))
    want = {(i, j) for i, j in zip(*np.nonzero((gap**2).sum(axis=-1) <= 0.01)) if i <= j}
    for size in (64, 4):
        monkeypatch.setattr(egojoin, "BOXES", size)
        assert set(map(tuple, egojoin.near_boxes(boxes, boxes, 0.01, True))) == want
        parts = {(i, j + 100) for i, j in map(tuple, egojoin.near_boxes(boxes[:100], boxes[100:], 0.01, False))}
        assert parts == {(i, j) for i, j in want if i < 100 <= j}


def accuracy(scored, labels, column):
    rows = scored.join(labels.select("doc_id", F.col(column).alias("label")), "doc_id").where("held_out").collect()
    return np.mean([r["predicted"] == r["label"] for r in rows]), {k: np.mean([r["predicted"] for r in rows if r["label"] == k]) for k in (0, 1)}


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    network = quality.train(docs, labels)
    scored = quality.score(docs, network).withColumn("held_out", held_out())
    right, rates = accuracy(scored, labels, "quality")
    assert right > 0.9 and rates[1] > 0.9
    long = "The quick brown fox jumps over it. " * 3000
    junk = "zum*** be&&& %%% on### " * 4000
    odd = spark.createDataFrame([(1, None), (2, ""), (3, long), (4, long + junk), (4, long + junk), (None, "a")], "doc_id long, text string").withColumn("predictions", F.lit(1))
    got = quality.score(odd, network).collect()
    s = [r["score"] for r in got]
    assert len(s) == 6 and all(0 <= x <= 1 for x in s) and abs(s[0] - s[1]) < 1e-9 and abs(s[3] - s[4]) < 1e-9 and s[2] - s[3] > 0.01
    assert quality.score(odd.limit(0), network).count() == 0
    clash = spark.createDataFrame([(1, "x", "old", 7)], "doc_id long, text string, score string, predicted int")
    for r in (quality.score(clash, network).first(), toxicity.score(clash, toxicity.Linear(np.zeros(0, np.uint64), np.zeros(0), -4.0)).first()):
        assert r.asDict().keys() == {"doc_id", "text", "score", "predicted"} and 0 <= r["score"] <= 1 and r["predicted"] in (0, 1)
    none = quality.train(docs.limit(0), labels.limit(0))
    assert quality.score(odd, none).count() == 6


def test_a_score_does_not_depend_on_the_batch():
    network = quality.Network()
    texts = [b"one two three " * k for k in (0, 1, 40, 300)]
    join = lambda ts: (np.frombuffer(b"".join(ts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in ts])]))
    whole = network.probability(*join(texts))
    assert np.allclose(whole, [network.probability(*join([t]))[0] for t in texts], atol=1e-6)


def test_network_slopes(monkeypatch):
    # one step of fitting moves every parameter against its slope, as differences of the loss show it
    network, texts, label = quality.Network(), [b"abc abc xyz" * 20, b"!!" * 300, b"", b"mixed !! abc"], np.array([1.0, 0.0, 1.0, 0.0])
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    loss = lambda: -np.mean(np.log(np.where(label, network.probability(data, at), 1 - network.probability(data, at))))
    slopes = network.slopes(texts, label)
    rng = np.random.default_rng(0)
    for name, slope in slopes.items():
        where = np.argsort(-np.abs(slope.ravel()))[:12] if name == "table" else rng.permutation(slope.size)[:12]
        for i in where:
            value = network.p[name].ravel()
            old, moved = value[i], []
            for step in (1e-4, -1e-4):
                value[i] = old + step
                moved.append(loss())
            value[i] = old
            assert abs((moved[0] - moved[1]) / 2e-4 - slope.ravel()[i]) < 2e-2 * np.abs(slope).max() + 1e-6, name


def test_network_learns():
    network = quality.Network()
    texts, label = [b"abc abc xyz" * 20, b"!!" * 300], np.array([1.0, 0.0])
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.array([0, len(texts[0]), len(texts[0]) + len(texts[1])])
    loss = lambda: -np.mean(np.log(np.where(label, network.probability(data, at), 1 - network.probability(data, at))))
    before = loss()
    network.fit(texts, label, epochs=30)
    assert loss() < 0.5 * before


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model).withColumn("held_out", held_out())
    right, rates = accuracy(scored, labels, "toxic")
    assert right > 0.85 and rates[1] > 0.5 and rates[0] < 0.1
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 50000), (3, "word " * 50000), (None, "a")], "doc_id long, text string").withColumn("score_", F.lit(1))
    s = [r["score"] for r in toxicity.score(odd, model).collect()]
    assert len(s) == 5 and s[0] == s[1] < 0.5 and s[2] == s[3]
    assert toxicity.score(odd.limit(0), model).count() == 0 and toxicity.score(odd, toxicity.train(docs.limit(0), labels.limit(0))).count() == 5


def test_non_negative_risk_separates():
    rng = np.random.default_rng(5)
    word = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    make = lambda bad: np.unique(np.concatenate([word[20:][rng.integers(0, 380, 30)], word[rng.integers(0, 20, 3)] if bad else word[:0]]))
    model = toxicity.fit([make(True) for _ in range(200)], [make(rng.random() < 0.1) for _ in range(1000)], 0.1)
    logit = lambda x: model.bias + sum(model.weight[np.searchsorted(model.feature, f)] for f in x if f in set(model.feature.tolist()))
    assert np.mean([logit(make(True)) > 0 for _ in range(100)]) > 0.85 and np.mean([logit(make(False)) > 0 for _ in range(100)]) < 0.05


def test_non_negative_risk_climbs_back(monkeypatch):
    # few unlabelled texts and a large prior: without the correction the negative risk would fall far below zero
    rng = np.random.default_rng(2)
    bad = [np.unique(rng.integers(1, 40, 12)).astype(np.uint64) for _ in range(60)]
    mixed = [*bad[:2], *(np.unique(rng.integers(1000, 9000, 12)).astype(np.uint64) for _ in range(28))]
    risks = []
    plain = toxicity.risk
    monkeypatch.setattr(toxicity, "risk", lambda *a: risks.append(plain(*a)) or risks[-1])
    model = toxicity.fit(bad, mixed, 0.5)
    assert min(risks) < 0, "the corrected branch was never reached"
    assert risks[-1] > -0.1 and np.isfinite(model.weight).all()


def test_toxicity_fit_copies_its_texts_once():
    rng = np.random.default_rng(8)
    make = lambda bad: np.unique(np.concatenate([rng.integers(1000, 9000, 2000), np.arange(20) if bad else np.arange(0)])).astype(np.uint64)
    bad, mixed = [make(True) for _ in range(100)], [make(k % 20 == 0) for k in range(2000)]
    tracemalloc.start()
    model = toxicity.fit(bad, mixed, 0.05, steps=5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.feature.tolist() == list(range(20)) and most < 1.7 * sum(x.nbytes for x in mixed)


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="another C library")
def test_released_gives_freed_native_memory_back(spark):
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    resident = lambda pid: int(re.search(r"Rss:\s+(\d+)", open(f"/proc/{pid}/smaps_rollup").read())[1]) / 1024  # noqa: E731, SIM115

    # freed blocks below one that stays are not given back by themselves
    libc = ctypes.CDLL(None)
    libc.malloc.restype, libc.free.argtypes = ctypes.c_void_p, [ctypes.c_void_p]
    released(spark)
    blocks = [libc.malloc(60_000) for _ in range(2000)]
    for b in blocks:
        ctypes.memset(b, 1, 60_000)
    for b in blocks[:-1]:
        libc.free(b)
    before = resident("self")
    released(spark)
    assert before - resident("self") > 90, "the driver's Python kept what it had freed"
    libc.free(blocks[-1])

    pid = jvm.java.lang.ProcessHandle.current().pid()
    plain, packed = gateway.new_array(jvm.byte, 60_000), gateway.new_array(jvm.byte, 100_000)
    packers = [jvm.java.util.zip.Deflater() for _ in range(400)]
    for p in packers:
        p.setInput(plain)
        p.finish()
        p.deflate(packed)
    for p in packers[:-1]:
        p.end()
    jvm.System.gc()
    before = resident(pid)
    released(spark)
    assert before - resident(pid) > 50, "the driver's JVM kept what it had freed"
    packers[-1].end()


def test_pipeline_stage_by_stage(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and "pipeline" in __spark_entry__.queries()
    docs = table(spark, SF, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], SF), re.sub(r"\W", "-", name)))
        assert name == names[-1] or kept[-1].columns == docs.columns
    count = [k.count() for k in kept]
    clean = {r["doc_id"] for r in table(spark, SF, "labels").where("toxic = 0").collect()}
    after = {r["doc_id"] for r in kept[1].collect()}
    assert count[1] < count[0] and len(clean & after) > 0.93 * len(clean)
    assert count[2] == count[1] and kept[2].join(kept[1].withColumnRenamed("text", "old"), "doc_id").where("text <> old").count() > 0
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in kept[2].collect()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = union_find(sets, links)
    assert {r["doc_id"] for r in kept[3].collect()} == {i for i, r in root.items() if i == r}
    span, texts = 50, {r["doc_id"]: r["text"] for r in kept[3].collect()}
    seen = {}
    for t in texts.values():
        ws = (t or "").encode().split()
        for k in range(len(ws) - span + 1):
            seen[tuple(ws[k : k + span])] = seen.get(tuple(ws[k : k + span]), 0) + 1
    for r in kept[4].collect():
        ws, gone = (texts[r["doc_id"]] or "").encode().split(), set()
        for k in range(len(ws) - span + 1):
            if seen[tuple(ws[k : k + span])] > 1:
                gone |= set(range(k, k + span))
        assert (r["text"] or "").encode().split() == [x for k, x in enumerate(ws) if k not in gone]
        assert gone or r["text"] == texts[r["doc_id"]]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in kept[4].collect()}
    assert {r["doc_id"]: r["n"] for r in kept[5].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == want


def test_pipeline_takes_odd_rows(spark):
    schema = table(spark, SF, "documents").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "a b", "en", "s", 3), (1, "", "en", "s", 0), (2, None, "en", "s", None), (3, "x\ny", "en", "s", 3), (3, "x\ny", "en", "s", 3)], schema)
    for rows in (odd, odd.limit(0)):
        docs = rows.withColumns({c: F.lit(1) for c in ("score", "predicted", "row", "kept", "th", "component", "key")})
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), "odd")
        assert docs.count() == (5 if rows is odd else 0)


def test_pipeline_keeps_texts_of_odd_ids(spark):
    rng = np.random.default_rng(4)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10**6, 80))
    one, two, three, four = (text() for _ in range(4))
    rows = [(7, one), (7, two), (None, three), (None, three), (9, four), (8, four), (None, four), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], table(spark, SF, "documents").schema)
    docs = written(corpus_pipeline.drop_near_copies(spark, docs, SF), "odd")
    assert sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str) == sorted([(7, one), (7, two), (None, three), (8, four), (None, None)], key=str)
    docs = corpus_pipeline.drop_repeated_passages(spark, docs, SF)
    assert sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str) == sorted([(7, one), (7, two), (None, three), (8, four), (None, None)], key=str)


def test_quality_learns_from_whole_texts(spark, monkeypatch):
    # a poor part between what four excerpts of 1024 bytes would show
    texts = {i: "fine words here. " * 200 + (f"junk{i}!! " * 500 if i % 2 else "") + "fine words here. " * 200 for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in texts], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality.Network, "fit", lambda self, rows, label: seen.extend(rows))
    quality.train(docs, labels)
    assert len(seen) > 20 and set(seen) <= {t.encode() for t in texts.values()}
