"""Event-outcome views of the star-schema tables: contests, entrants, actors and entity histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EPOCH = "1995-01-01"

#: Rows of contests that one task sorts, beyond the session's shuffle partitions.
ROWS_A_PARTITION = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by keys to so many partitions that each has about ROWS_A_PARTITION of ``rows``; as it is if the session's own are enough.

    Windows and joins by the keys follow these partitions, so what a task
    sorts stays the same however large the table is.
    """
    n = -(-rows // ROWS_A_PARTITION)
    return df if n <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(n, *keys)


def runners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per entrant of a contest: an order line in its order.

    ``no`` is the entrant's place in the contest's total order, ``position``
    its finish (by price, best first), ``uid`` a unique number, ``day`` days
    since the epoch. Money is in whole cents and odds have two decimals, so
    sums are exact.
    """
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    entrants = line.select(
        F.col("l_orderkey").alias("race"),
        F.col("l_partkey").alias("horse"),
        F.col("l_suppkey").alias("jockey"),
        F.col("l_linenumber").alias("draw"),
        F.col("l_returnflag").alias("discipline"),
        F.col("l_linestatus").alias("equipment"),
        F.col("l_shipdate").alias("ship"),
        (1000 + 50 * F.col("l_quantity").cast("int")).alias("distance"),
        F.round(F.col("l_discount") * 100).cast("int").alias("weight"),
        cents.alias("gains"),
        ((100 + cents % 4900) / F.lit(100.0)).alias("odds"),
    )
    entrants = dealt(entrants, line.count(), "race")  # counted in the files' footers
    in_race = Window.partitionBy("race")
    total = ["draw", "horse", "jockey", "ship", "gains"]
    races = order.select(F.col("o_orderkey").alias("race"), F.col("o_custkey").alias("trainer"), F.datediff(F.col("o_orderdate").cast("date"), F.lit(EPOCH)).alias("day"), F.col("o_orderdate").cast("date").alias("race_date"))
    numbered = entrants.withColumns({"no": F.row_number().over(in_race.orderBy(*total)), "position": F.row_number().over(in_race.orderBy(F.desc("gains"), *total[:-1]))})
    out = numbered.join(races, "race")
    return out.drop("ship").withColumns({"won": (F.col("position") == 1).cast("int"), "placed": (F.col("position") <= 3).cast("int"), "uid": F.col("race") * 100 + F.col("no")})


def with_tracks(runners: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runners with the track (nation of the supplier) and sire (brand of the part), null where the side row is missing."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("jockey"), F.col("s_nationkey").alias("track"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("horse"), F.col("p_brand").alias("sire"), F.col("p_type").alias("dam"))
    return runners.join(s, "jockey", "left").join(p, "horse", "left")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event history: entity, ts, day number, kind, value and the number inside the JSON properties."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").alias("entity"), "ts", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01")).alias("day"), F.col("event_type").alias("kind"), "value", F.get_json_object("props", "$.k").cast("int").alias("k"), "props")


# DuckDB twins of the views above, as common table expressions.
RUNNERS_SQL = """
line AS (
  SELECT l_orderkey AS race, l_partkey AS horse, l_suppkey AS jockey, l_linenumber AS draw, l_returnflag AS discipline, l_linestatus AS equipment,
    l_shipdate AS ship, 1000 + 50 * l_quantity::INTEGER AS distance, round(l_discount * 100)::INTEGER AS weight,
    round(l_extendedprice * 100)::BIGINT AS gains, (100 + round(l_extendedprice * 100)::BIGINT % 4900) / 100.0 AS odds
  FROM lineitem),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY race ORDER BY draw, horse, jockey, ship, gains) AS no,
    row_number() OVER (PARTITION BY race ORDER BY gains DESC, draw, horse, jockey, ship) AS position FROM line),
r AS (
  SELECT n.* EXCLUDE (ship), o_custkey AS trainer, date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS day, o_orderdate::DATE AS race_date,
    (position = 1)::INTEGER AS won, (position <= 3)::INTEGER AS placed, race * 100 + no AS uid
  FROM numbered AS n JOIN orders ON race = o_orderkey)
"""
TRACKS_SQL = RUNNERS_SQL + """, rt AS (SELECT r.*, s_nationkey AS track, p_brand AS sire, p_type AS dam FROM r LEFT JOIN supplier ON jockey = s_suppkey LEFT JOIN part ON horse = p_partkey)
"""
EVENTS_SQL = """
e AS (SELECT event_id, user_id AS entity, ts, date_diff('day', DATE '2024-01-01', ts::DATE) AS day, event_type AS kind, value,
  json_extract_string(props, '$.k')::INTEGER AS k, props FROM events)
"""


def pedigree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sire and dam of every horse: the first and the last home, among those that had run on an earlier day, in the first race it ran in. No horse descends from itself."""
    r = runners(spark, sf_dir).select("horse", "race", "day", "no", "position")
    debut = r.groupBy("horse").agg(F.min(F.struct("day", "race")).alias("first"))
    fields = r.join(debut.select("horse", F.col("first.day").alias("since")), "horse").where("since < day").groupBy("race").agg(F.sort_array(F.collect_set(F.struct("position", "horse"))).alias("older"))
    met = debut.select("horse", F.col("first.race").alias("race")).join(fields, "race", "left")
    sire = F.try_element_at("older", F.lit(1))["horse"]
    dam = F.when(F.try_element_at("older", F.lit(-1))["horse"] != sire, F.try_element_at("older", F.lit(-1))["horse"])
    return met.select("horse", sire.alias("sire"), dam.alias("dam"))


PEDIGREE_SQL = RUNNERS_SQL + """, debut AS (SELECT horse, arg_min(race, (day, race)) AS race, min(day) AS since FROM r GROUP BY horse),
older AS (SELECT r.race, list(r.horse ORDER BY r.position) AS h FROM r JOIN debut ON r.horse = debut.horse WHERE since < day GROUP BY r.race),
ped AS (SELECT horse, h[1] AS sire, CASE WHEN h[-1] <> h[1] THEN h[-1] END AS dam FROM debut LEFT JOIN older USING (race))
"""
