"""Settings, progress and whole jobs."""

import json
import math

import pytest

from sigloom import config
from sigloom.plans import jobs
from sigloom.streaming.progress import Progress, counted


def test_layers_and_paths(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"db": {"host": "${HOST:local}", "port": 1}, "s2.1_part": {"n": "7"}, "api_key": "x"}))
    c = config.Config({"db": {"host": "d", "user": "u"}}, tmp_path / "c.json", "APP", ["limits.rate=100"], {"APP__db__port": "6543", "APP__list": "[1,2]", "HOST": "h"})
    assert c.get("db.host") == "h" and c.get("db.user") == "u" and c.get("db.port") == 6543 and c.get("list") == [1, 2] and c.get("limits.rate", int) == 100
    assert c.get("s2.1_part.n", int) == 7 and c.get("none.such", int, 3) == 3 and c.get("db.host", int, 5) == 5
    before = c.fingerprint()
    c.reload()
    assert c.fingerprint() == before and c.get("limits.rate") == 100
    assert c.export()["api_key"] == "***" and c.export(redact=False)["api_key"] == "x"
    c.validate({"db.port": int})
    for bad in (lambda: c.validate({"db.port": str}), lambda: config.from_arguments(["x"])):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(TypeError):
        c.snapshot()["a"] = 1
    assert [config.scalar(t) for t in ("null", "TRUE", "3", "2.5", "{bad", "x")] == [None, True, 3, 2.5, "{bad", "x"]
    assert config.session_settings(config.Config({"executor": {"max_retries": 1}})) == {"spark.task.maxFailures": "2"}


def test_yaml_with_includes(tmp_path):
    if config.yaml is None:
        with pytest.raises(RuntimeError):
            config.read(tmp_path / "a.yaml")
        return
    (tmp_path / "b.yaml").write_text("x: 1")
    (tmp_path / "t.txt").write_text("text")
    (tmp_path / "a.yaml").write_text("b: !include b.yaml\nt: !include t.txt")
    assert config.read(tmp_path / "a.yaml") == {"b": {"x": 1}, "t": "text"}


def test_progress(spark):
    told = []
    p = Progress(lambda n, percent: told.append((n, percent)), total=3)
    p.add(1)
    p.discovered(3)
    p.add(5)
    assert told == [(1, 33.33), (6, 100.0)]
    df, seen = counted(spark.range(5))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 5


def test_signature_job(spark, tmp_path):
    corners = lambda part, side: [(part, i, side * (i & 1), side * (i >> 1 & 1), side * (i >> 2)) for i in range(8)]
    points = spark.createDataFrame([*corners("A", 10.0), *corners("B", 10.0), *corners("C", 13.0), ("D", 0, 0.0, 0.0, 0.0)], "part string, idx int, x double, y double, z double")
    faces = spark.createDataFrame([(p, "plane") for p in "ABC" for _ in range(6)], "part string, surface_type string")
    edges = spark.createDataFrame([(p, "e", s, 1.0 - s, float(s), 0.0) for p in "ABC" for s in range(2)], "part string, edge string, seq int, nx double, ny double, nz double")
    rows = jobs.descriptors(points, faces, edges)
    found = {r["part_id"]: r for r in rows.collect()}
    assert found["A"]["geom_hash"] == found["B"]["geom_hash"] == found["C"]["geom_hash"] != "" and found["D"]["geom_hash"] == ""
    assert found["D"]["has_points"] == 0 and found["D"]["d2_hist"] is None and len(found["A"]["d2_hist"]) == 64 and sum(found["A"]["dih_hist"]) > 0.99
    calls = []
    summary = jobs.run(rows, str(tmp_path / "out"), lambda: calls.append("before"), calls.append)
    assert summary["rows"] == 4 and summary["output"] and calls == ["before", summary]
    assert jobs.run(rows.limit(0), str(tmp_path / "none")) == {"rows": 0, "fingerprint": None, "output": None}


def test_example_job(spark, tmp_path):
    weights = [1.2, 0.8, 0.4, 0.5, 2.6, 1.9]
    (tmp_path / "i.json").write_text(json.dumps([{"part_id": f"part-{i}", "group": "g", "weight": w, "category": "c", "description": "d"} for i, w in enumerate(weights)]))
    total = jobs.example(spark, str(tmp_path / "i.json"), str(tmp_path / "summary"))
    assert (total["tasks"], total["items"]) == (12, 12) and math.isclose(total["weight"], 14.8, abs_tol=1e-9)
