import json

from pyspark.sql import functions as F

from ledgerloom.sources import files, sinks
from ledgerloom.streaming import events as E


def test_workbook_round_trip(spark, tmp_path):
    sinks.write_workbook({"Date": (["cod", "nume"], [("51.02", "=1+1"), (None, "a\x01b & <c>")])}, str(tmp_path / "a.xlsx"))
    (tmp_path / "broken.xlsx").write_bytes(b"no zip")
    got = {(r.row, r.col): r.cell for r in files.read_workbooks(spark, str(tmp_path)).where("cell is not null").collect()}
    assert got == {(0, 0): "cod", (0, 1): "nume", (1, 0): "51.02", (1, 1): "=1+1", (2, 1): "ab & <c>"}
    assert files.read_workbooks(spark, str(tmp_path)).where("cell is null").count() == 1


def test_bundle_is_whole_or_not(tmp_path):
    folder = str(tmp_path)
    assert sinks.audit(folder) == ["no manifest"]
    first = sinks.publish({"a.json": b"1", "b.json": b"2"}, folder)
    assert sinks.publish({"b.json": b"2", "a.json": b"1"}, folder) == first and sinks.audit(folder) == []
    (tmp_path / first / "a.json").write_bytes(b"9")
    (tmp_path / first / "b.json").unlink()
    assert sinks.audit(folder) == ["changed: a.json", "missing: b.json"]


def test_facts_first_wins(spark, tmp_path):
    rows = ["municipality,siruta,year,suffix,section,kind,code,func_code,column,value,verified,page", "A,1,2024,02,TOTAL,revenue,10,,total,5,True,1", "A,1,2024,02,TOTAL,revenue,10,,total,7,False,2", "A,1,2024,02,TOTAL,revenue,11,,total,0.5,True,1", "A,1,2024,02,TOTAL,revenue,,,total,8,True,1", "A,1,2024,02,TOTAL,revenue,12,,total,n/a,True,1"]
    (tmp_path / "f.csv").write_text("\n".join(rows))
    got = files.read_facts(spark, str(tmp_path / "f.csv")).collect()
    assert [(r.code, int(r.value), r.verified) for r in got] == [("10", 5, True)]


def test_grids_lines_and_discovery(spark, tmp_path):
    (tmp_path / "q1").mkdir()
    (tmp_path / "q1" / "g.json").write_text(json.dumps({"text": "t", "rotation_applied": 0, "grid": [["a", "b"], ["c"]]}))
    assert files.read_grids(spark, str(tmp_path / "q1")).count() == 3
    found = files.discover(spark, str(tmp_path), "*.json", r"/q([1-4])/", {"quarter": 1}).collect()
    assert [r.quarter for r in found] == ["1"]
    (tmp_path / "l.jsonl").write_text('{"model": "m", "cost": 1.5}\nbroken\n')
    got = files.read_lines(spark, str(tmp_path / "l.jsonl"), "model string, cost double").cache()
    assert got.where("_corrupt is not null").count() == 1 and got.agg(F.sum("cost")).first()[0] == 1.5


def test_sheet_rows(spark):
    assert sinks.sheet_order(["est2027", "trim2", "total_2026", "trim1", "total", "credite_restante"]) == ["total", "total_2026", "trim1", "trim2", "credite_restante", "est2027"]
    f = spark.createDataFrame([("a\x02", "total", 1), ("a\x02", "trim1", 2)], "name string, column_name string, value int")
    assert [tuple(r) for r in sinks.sheet_rows(f, ["name"], ["trim1", "total"]).collect()] == [("a", 1, 2)]


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i:02d}:00", i % 2, 1.0) for i in range(10)]
    table = spark.createDataFrame(rows, "event_id int, ts string, user_id long, value double").withColumn("ts", F.to_timestamp("ts"))
    folder = tmp_path / "in"
    folder.mkdir()
    table.where("event_id < 6").toPandas().to_parquet(folder / "events.parquet", coerce_timestamps="us")
    run = lambda: E.run_available(E.running_totals(E.read(spark, str(folder), "events")), "update", E.upsert_into(str(tmp_path / "out"), ["user_id"]), str(tmp_path / "state"))
    run()
    assert {r.user_id: r.events for r in E.latest(spark, str(tmp_path / "out"), ["user_id"]).collect()} == {0: 3, 1: 3}
    table.where("event_id >= 6").toPandas().to_parquet(folder / "events-2.parquet", coerce_timestamps="us")
    run()
    assert {r.user_id: r.events for r in E.latest(spark, str(tmp_path / "out"), ["user_id"]).collect()} == {0: 5, 1: 5}


def test_once_each(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:01:00"), (2, "2024-01-01 00:02:00")]
    spark.createDataFrame(rows, "event_id int, ts string").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "events.parquet"))
    stream = spark.readStream.schema("event_id int, ts timestamp").parquet(str(tmp_path / "events.parquet"))
    E.run_available(E.once_each(stream, "ts", "event_id"), "append", E.upsert_into(str(tmp_path / "out"), ["event_id"]), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out") + "/batch=*").count() == 2


def test_streams_read_a_directory_whatever_its_order(spark, smallest, tmp_path):
    from ledgerloom.plans import stream_queries as Q
    from ledgerloom.session import table

    events = table(spark, smallest, "events").select("event_id", "ts", "event_type", "value", "user_id").orderBy("ts").limit(70).collect()
    schema = table(spark, smallest, "events").select("event_id", "ts", "event_type", "value", "user_id").schema
    spark.createDataFrame(events, schema).repartition(70, "event_id").write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "events.parquet"))
    assert sum(r.events for r in Q.stream_totals(spark, str(tmp_path)).collect()) == 70
    assert sum(r.events for r in Q.stream_hourly(spark, str(tmp_path)).collect()) == 70
