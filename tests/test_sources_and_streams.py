"""Readers, writers, scalar functions and streaming operators."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.functions import scalars
from paceline.operators import merge, pit
from paceline.sources import readers, sinks
from paceline.streaming import windows

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "name": "x"}\n\nnot json\n{"id": 2, "name": null}\n')
    (tmp_path / "b.json").write_text(json.dumps([{"id": 3, "name": "y"}, {"id": 4}]))
    (tmp_path / "c.json").write_text(json.dumps({"k1": {"id": 5, "name": "z"}, "k2": {"id": 6}}))
    assert [r.id for r in readers.json_lines(spark, str(tmp_path / "a.jsonl"), RECORD).orderBy("id").collect()] == [1, 2]
    assert readers.json_lines(spark, str(tmp_path / "a.jsonl"), RECORD, keep_bad=True).count() == 3
    assert readers.by_suffix(spark, str(tmp_path / "b.json"), RECORD).count() == 2
    assert sorted((r.key, r.id) for r in readers.json_map(spark, str(tmp_path / "c.json"), RECORD).collect()) == [("k1", 5), ("k2", 6)]
    assert readers.first_existing(spark, [str(tmp_path / "none"), str(tmp_path / "b.json")]).endswith("b.json")
    with pytest.raises(FileNotFoundError):
        readers.first_existing(spark, [str(tmp_path / "none")])
    raw = spark.createDataFrame([(b"\xe9t\xe9",), ("été".encode(),)], "b binary").select(readers.latin_or_utf8(F.col("b")).alias("t"))
    assert {r.t for r in raw.collect()} == {"été"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [1, 2], datetime.date(2024, 1, 1)), (2, "b", [], datetime.date(2024, 1, 5))], "id long, name string, xs array<int>, day date")
    sinks.three_formats(df, str(tmp_path / "out"))
    assert {spark.read.parquet(str(tmp_path / "out/parquet")).count(), spark.read.json(str(tmp_path / "out/json")).count(), readers.csv(spark, str(tmp_path / "out/csv")).count()} == {2}
    sinks.archive(df, str(tmp_path / "days"), "day")
    sinks.archive(df, str(tmp_path / "days"), "day")
    assert sinks.archived(spark, str(tmp_path / "days"), "day", "2024-01-02", "2024-01-31").count() == 2
    for step, inputs, output in (("s1", ["raw"], "clean"), ("s2", ["clean", "dim"], "fact")):
        sinks.log_step(spark, str(tmp_path / "lineage"), step, inputs, output)
    assert {r.input for r in sinks.lineage(spark, str(tmp_path / "lineage"), "fact").collect()} == {"raw", "clean", "dim"}


def test_scalars(spark):
    df = spark.createDataFrame([("1a2pDa(23)3h", "Élan d'Or ", "2024-03-05T10:00", "Prix de 1.234,56 €", "n/a", 1200)], "form string, name string, day string, text string, gap string, dist int")
    r = df.select(
        scalars.form_string(F.col("form")).alias("form"), scalars.name_key(F.col("name")).alias("key"), scalars.slug(F.col("name")).alias("slug"), scalars.parsed_date(F.col("day")).alias("day"), scalars.parsed_date(F.lit("5/3/2024")).alias("day2"), scalars.parsed_date(F.lit("05032024")).alias("day3"), scalars.parsed_date(F.lit("soon")).alias("day4"),
        scalars.money(F.col("text")).alias("money"), scalars.clean_null(F.col("gap")).alias("gap"), scalars.distance_band(F.col("dist"), "A").alias("a"), scalars.distance_band(F.col("dist"), "B").alias("b"), scalars.minutes_text(F.lit(72340)).alias("t"), scalars.repaired(F.lit("Ã©tÃ©")).alias("fixed"), scalars.first_int(F.lit("x"), F.lit("7")).alias("n"), scalars.missing_as(F.lit(0.0), F.lit(4.0)).alias("odds"),
    ).first()
    assert [(x.place, x.discipline) for x in r.form] == [(1, "a"), (2, "p"), (None, "a"), (3, "h")]
    assert (r.key, r.slug) == ("ELAN D OR", "elan-d-or") and {r.day, r.day2, r.day3} == {datetime.date(2024, 3, 5)} and r.day4 is None
    assert (r.money, r.gap, r.a, r.b, r.t, r.fixed, r.n, r.odds) == (1234.56, None, "sprint", "sprint", "1'12\"3", "été", 7, 4.0)


def test_frames_on_shared_days(spark):
    rows = [("h", 1, 1, 1), ("h", 1, 2, 0), ("h", 3, 3, 1), ("h", 4, 4, 0), (None, 1, 5, 1)]
    df = spark.createDataFrame(rows, "horse string, day int, no int, won int").withColumn("placed", F.col("won"))
    out = pit.history(df, "horse", pit.strict_day("horse"), "f1").withColumn("f3", F.count(F.lit(1)).over(pit.trailing_days("horse", 2))).withColumn("f4", F.count(F.lit(1)).over(pit.sequential("horse", "day", "no")))
    got = {r.no: (r.f1_runs, r.f1_wins, r.f3, r.f4) for r in out.collect()}
    assert got == {1: (0, 0, 0, 0), 2: (0, 0, 0, 1), 3: (2, 1, 2, 2), 4: (3, 2, 1, 3), 5: (0, 0, 0, 0)}
    last = pit.last_n_of_earlier_days(df.where("horse is not null"), "horse", 2, ["day", "no"], ["won"])
    assert {r.no: [x.no for x in r["last"]] for r in last.collect()} == {1: [], 2: [], 3: [2, 1], 4: [3, 2]}


def test_zero_and_empty_never_overwrite(spark):
    a = spark.createDataFrame([(1, "x", 5, True)], "id int, s string, n int, b boolean")
    b = spark.createDataFrame([(1, "", 0, False), (2, None, 0, None)], "id int, s string, n int, b boolean")
    got = {r.id: (r.s, r.n, r.b, r.n_sources) for r in merge.last_filled_wins([a, b], ["id"], ["s", "n", "b"]).collect()}
    assert got == {1: ("x", 5, True, 2), 2: (None, None, None, 1)}


def test_streams(spark, tmp_path):
    rows = [(i, i % 3, datetime.datetime(2024, 1, 1, i % 24), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id long, user long, ts timestamp, value long")
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = windows.event_stream(spark, str(tmp_path / "in"), df.schema)
    for name, out, mode in (("tumble", windows.tumbling(stream, "ts", "6 hours", ["user"], "2 days"), "complete"), ("record", windows.running_record(stream, "user", "value"), "update")):
        q = out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        q.stop()
    batch = df.groupBy(F.window("ts", "6 hours"), "user").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    assert sorted(spark.table("tumble").select("window.start", "user", "n", "total").collect()) == sorted(batch.select("window.start", "user", "n", "total").collect())
    assert {r.user: (r.runs, r.hits) for r in spark.table("record").groupBy("user").agg(F.max("runs").alias("runs"), F.max("hits").alias("hits")).collect()} == {u: (20, 10) for u in range(3)}
