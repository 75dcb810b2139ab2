import json

import pytest
from pyspark.sql import functions as F

from casegrid.sources import readers, sinks
from casegrid.streaming import streams


def test_packets(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"12345")
    (tmp_path / "b.pdf").write_bytes(b"1")
    (tmp_path / "c.txt").write_bytes(b"x")
    got = readers.packets(spark, str(tmp_path)).orderBy("length", "path").collect()
    assert [r["stem"] for r in got] == ["b", "a"] and len(got[0]["sha256"]) == 64


def test_states_skip_torn_lines_and_keep_the_first(spark, tmp_path):
    rows = [{"stem": "a", "shard": 1, "gen": 0, "line": 0, "status": "late"}, {"stem": "a", "shard": 0, "gen": 0, "line": 5, "status": "first"}, {"stem": "b", "shard": 0, "gen": 1, "line": 0, "status": "ok"}]
    (tmp_path / "s.jsonl").write_text("\n".join(map(json.dumps, rows)) + '\n{"stem": "c", "sta')
    got = {r["stem"]: r["status"] for r in readers.states(spark, str(tmp_path / "s.jsonl")).collect()}
    assert got == {"a": "first", "b": "ok"}


@pytest.mark.parametrize("text", ['{"case_id": "a"}\n{"case_id": "a"}', '{"case_id": null}', '{"case_id": ', ""])
def test_strict_rows_raise(spark, tmp_path, text):
    (tmp_path / "r.jsonl").write_text(text)
    with pytest.raises(Exception):  # noqa: B017, PT011
        readers.strict_rows(spark, str(tmp_path / "r.jsonl"), readers.PREDICTIONS).collect()


def test_predictions_and_ledger(spark, tmp_path):
    rows = spark.createDataFrame([("MIB-000001", 2), ("MIB-000001", 1), ("bad", 3)], "case_id string, n int")
    sinks.write_predictions(rows, str(tmp_path / "p"), ["n"])
    assert [tuple(r) for r in spark.read.schema("case_id string, n int").json(str(tmp_path / "p")).collect()] == [("MIB-000001", 1)]
    evidence = spark.createDataFrame([("MIB-000001", "visa_class", "DIP-1", "note", 1, 90, 2)], "case_id string, field string, value string, source string, rank int, score int, agreement int")
    sinks.write_ledger(sinks.ledger_rows(rows, evidence), str(tmp_path / "l"))
    text = "".join(p.read_text() for p in (tmp_path / "l").glob("part-*"))
    assert text.count("evidence") == 2 and '"bad","n":3}' in text


def test_receipts_are_written_once_and_only_for_unchanged_inputs(spark, tmp_path):
    a = spark.createDataFrame([("x", 1, "h")], "stem string, length long, sha256 string")
    sinks.write_receipt(a, a, str(tmp_path / "r"))
    with pytest.raises(Exception):  # noqa: B017, PT011
        sinks.write_receipt(a, a, str(tmp_path / "r"))
    with pytest.raises(ValueError):
        sinks.write_receipt(a, a.withColumnRenamed("stem", "stem").limit(0), str(tmp_path / "q"))


def test_artefact_default(spark, tmp_path):
    got = readers.artefact(spark, str(tmp_path / "none.json"), readers.T.StructType([readers.T.StructField("p", readers.T.DoubleType())]), [(0.55,)])
    assert got.first()["p"] == 0.55


def test_a_stream_in_shuffled_batches_gives_the_batch_result(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    folder = str(tmp_path / "events.parquet")
    events.orderBy("props").repartition(4).write.parquet(folder)
    got = streams.drained(streams.tumbling(streams.events(spark, folder, "60 days")), "complete")
    want = streams.tumbling(events.withColumn("ts", events["ts"].cast("timestamp")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    keys = streams.drained(streams.distinct(streams.events(spark, folder, "60 days"), ["user_id"]), "append")
    assert keys.count() == events.select("user_id").distinct().count()


def test_page_dumps_timings_and_run_receipts(spark, tmp_path):
    lines = spark.createDataFrame([("a", 1, 2, "second", 0.5), ("a", 1, 1, "first", 0.9), ("b", 1, 1, None, None)], "case_id string, page int, line_no int, text string, conf double")
    sinks.dump_pages(lines, None)
    sinks.dump_pages(lines, str(tmp_path / "pages"))
    pages = {r["case_id"]: [x["text"] for x in r["lines"]] for r in spark.read.json(str(tmp_path / "pages")).collect()}
    assert pages == {"a": ["first", "second"], "b": [None]}
    times = spark.createDataFrame([("a", "read", 1.5), ("b", "read", float("nan")), ("c", "read", -1.0), ("d", "read", None)], "case_id string, stage string, seconds double")
    for _ in range(2):
        sinks.append_timings(times, str(tmp_path / "times"))
    assert [r["seconds"] for r in spark.read.json(str(tmp_path / "times")).collect()] == [1.5, 1.5]
    before = spark.createDataFrame([("a", 3, "x"), ("b", 4, "y")], "stem string, length long, sha256 string")
    sinks.write_run_receipt(before, lambda: before.orderBy("sha256"), {"mode": "full"}, str(tmp_path / "one"))
    sinks.write_run_receipt(before.orderBy("length", ascending=False), lambda: before, {"mode": "full"}, str(tmp_path / "two"))
    one, two = (spark.read.json(str(tmp_path / x)).first() for x in ("one", "two"))
    assert one == two and one["inputs"] == 2 and one["mode"] == "full" and len(one["manifest"]) == 64
    changed = before.withColumn("sha256", F.lit("z"))
    with pytest.raises(ValueError, match="changed"):
        sinks.write_run_receipt(before, lambda: changed, {}, str(tmp_path / "three"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_run_receipt(before, lambda: before, {}, str(tmp_path / "one"))
