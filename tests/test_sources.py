from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quern.sources import files, sinks
from quern.streaming import events


def test_jsonl_blank_missing_and_malformed(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\n\n  \n{"a": 2}\n')
    assert sorted(r.a for r in files.read_jsonl(spark, f"file://{p}", "a long").collect()) == [1, 2]
    assert files.read_jsonl(spark, f"file://{tmp_path}/none", "a long", missing_ok=True).count() == 0
    p.write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, f"file://{p}", "a long").collect()
    good, bad = files.split_jsonl(spark, f"file://{p}", "a long")
    assert [r.a for r in good.collect()] == [1] and [(r.number, r.line) for r in bad.collect()] == [(2, '{"a": ')]


def test_yaml_and_source_trees(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "level1").mkdir()
    (tmp_path / "level1" / "x.yaml").write_text("id: a\nprompt: say\nempty:\n")
    (tmp_path / "level1" / "y.py").write_text("x = 1\n")
    rows = files.read_yaml(spark, f"file://{tmp_path}").collect()
    assert [r.record for r in rows] == [{"id": "a", "prompt": "say", "empty": None}]
    assert [r.code for r in files.read_sources(spark, f"file://{tmp_path}").collect()] == ["x = 1\n"]
    assert files.file_hashes(spark, f"file://{tmp_path}", "*.py").count() == 1


def test_problem_folders_and_latest(spark, tmp_path):
    pytest.importorskip("yaml")
    for folder, name in (("level2", "b"), ("level1", "z"), ("bugfix", "a"), ("other", "q")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / f"{name}.yaml").write_text(f"- id: {name}\n  n: 3\n- just text\n")
    got = files.read_problems(spark, f"file://{tmp_path}").collect()
    assert [r.record["id"] for r in got] == ["a", "z", "b"] and got[0].record["n"] == "3"
    assert [r.record["id"] for r in files.read_problems(spark, f"file://{tmp_path}", ["level1"], ()).collect()] == ["z"]
    assert files.latest(spark, f"file://{tmp_path}", "^level").endswith("/level2") and files.latest(spark, f"file://{tmp_path}/none") is None


def test_write_counts(spark, tmp_path):
    assert sinks.write_jsonl(spark.range(7), f"file://{tmp_path}/o") == 7 and sinks.write_jsonl(spark.range(0), f"file://{tmp_path}/o") == 0


def test_matching(spark):
    df = spark.createDataFrame([(2, "a"), (1, "b"), (3, "a")], "row_idx long, source string")
    assert [r.row_idx for r in files.matching(df, 1, source=[" a "]).collect()] == [2]
    assert files.matching(df, source=None).count() == 3 and files.matching(df, source=[""]).count() == 3


def test_unique_write_keeps_old_file_on_failure(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    sinks.write_unique_jsonl(spark.createDataFrame([("a", 1)], "k string, v int"), path, "k")
    with pytest.raises(ValueError):
        sinks.write_unique_jsonl(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), path, "k")
    assert spark.read.json(path).count() == 1
    sinks.write_unique_jsonl(spark.createDataFrame([("a", 1), ("b", None)], "k string, v int"), path, "k", "k")
    assert spark.read.json(path).count() == 2
    sinks.append_jsonl(spark.createDataFrame([("c", 3)], "k string, v int"), path)
    assert spark.read.json(path).count() == 3
    assert not [p for p in tmp_path.iterdir() if p.name != "out" and not p.name.startswith(".")]


def test_bundle(spark, tmp_path):
    sinks.write_bundle({"rows": spark.range(3)}, f"file://{tmp_path}/b", {"n": 3})
    assert json.loads((tmp_path / "b" / "manifest.json").read_text()) == {"n": 3}
    assert [r.id for r in sinks.first_rows(spark.range(9), "id", 2).collect()] == [0, 1]


def test_stream_windows_equal_batch(spark, small, tmp_path):
    schema = spark.read.parquet(f"{small}/events.parquet").schema
    stream = events.read_stream(spark, small, "events.parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    query = events.tumbling(stream.withWatermark("ts", "1 day"), "ts", "1 hour", "event_type")
    run = query.writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination()
    batch = events.tumbling(spark.read.parquet(f"{small}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", "event_type")
    show = lambda df: sorted((str(r.start), r.event_type, r.n, round(r.total, 6)) for r in df.collect())
    assert show(spark.table("tumbled")) == show(batch)


def test_stream_first_seen_and_registry(spark, tmp_path):
    folder = tmp_path / "in"
    schema = "text string, ts timestamp"
    for i, texts in enumerate((["a", "A ", "b"], ["b", "c"])):
        spark.createDataFrame([(t,) for t in texts], "text string").withColumn("ts", F.lit("2024-01-01").cast("timestamp")).coalesce(1).write.parquet(f"file://{folder}/part{i}.parquet")
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"file://{folder}")
    run = events.first_seen(rows, "text", "ts", "1 hour").writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    run.awaitTermination()
    assert sorted(r.text.strip().lower() for r in spark.table("seen").collect()) == ["a", "b", "c"]
    keyed = rows.withColumn("k", F.lower(F.trim("text")))
    events.against_registry(keyed, f"file://{tmp_path}/reg", "k", f"file://{tmp_path}/out", f"file://{tmp_path}/ckpt").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == ["a", "b", "c"]
