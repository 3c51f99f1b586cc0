"""Queries over findings and over tables that go through each format and back, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.operators import findings
from paceline.plans.form_queries import real, real_sql
from paceline.sources import readers, sinks
from paceline.sources.shared import shared_path
from paceline.sources.tables import RUNNERS_SQL, runners, table

R = f"WITH {RUNNERS_SQL}"


def return_significance(spark: SparkSession, sf: str) -> DataFrame:
    """Returns of level stakes by discipline: mean, z against zero, two-sided p-value and interval."""
    r = runners(spark, sf).withColumn("ret", F.col("won") * F.col("odds") - 1)
    out = findings.significance(r, ["discipline"], "ret")
    return out.select("discipline", "n", real(F.col("mean"), "mean"), real(F.col("z"), "z"), (F.round("p_value", 5) + F.lit(0.0)).alias("p_value"), real(F.col("low"), "low"), real(F.col("high"), "high"))


_A = "(1 / (1 + 0.2316419 * abs(z)))"
_TAIL = f"exp(-z * z / 2) / sqrt(2 * pi()) * (0.319381530 * {_A} - 0.356563782 * pow({_A}, 2) + 1.781477937 * pow({_A}, 3) - 1.821255978 * pow({_A}, 4) + 1.330274429 * pow({_A}, 5))"
RETURN_SIGNIFICANCE = f"""{R}, g AS (SELECT discipline, count(*) AS n, avg(won * odds::DOUBLE - 1) AS m, stddev_samp(won * odds::DOUBLE - 1) / sqrt(count(*)) AS e FROM r GROUP BY 1), h AS (SELECT *, m / e AS z FROM g)
SELECT discipline, n, {real_sql("m", "mean")}, {real_sql("z", "z")}, round(least(1, 2 * {_TAIL}), 5) + 0.0 AS p_value, {real_sql("m - 1.96 * e", "low")}, {real_sql("m + 1.96 * e", "high")} FROM h"""


def monthly_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields by month: rows, missing per cent, mean, deviation and ends."""
    r = runners(spark, sf).withColumns({"some": F.when(F.col("uid") % 6 != 0, F.col("weight")), "rare": F.when(F.col("uid") % 997 == 0, F.col("draw"))})
    return findings.monthly(r, "race_date", ["some", "rare", "distance"]).select("period", "field", "n", real(F.col("missing_pct"), "missing_pct"), real(F.col("mean"), "mean"), real(F.col("sd"), "sd"), real(F.col("least"), "least"), real(F.col("most"), "most"))


_LONG = " UNION ALL ".join(f"SELECT race_date, '{f}' AS field, ({x})::DOUBLE AS v FROM r" for f, x in (("some", "CASE WHEN uid % 6 <> 0 THEN weight END"), ("rare", "CASE WHEN uid % 997 = 0 THEN draw END"), ("distance", "distance")))
MONTHLY_FIELDS = f"""{R}, l AS ({_LONG}) SELECT strftime(race_date, '%Y-%m') AS period, field, count(*) AS n, {real_sql("count(*) FILTER (v IS NULL) / count(*) * 100", "missing_pct")}, {real_sql("avg(v)", "mean")}, {real_sql("coalesce(stddev_samp(v), CASE WHEN count(v) = 1 THEN 0 END)", "sd")}, {real_sql("min(v)", "least")}, {real_sql("max(v)", "most")} FROM l GROUP BY 1, 2"""


def range_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Values that break what their fields' names promise; rules follow from the names."""
    r = runners(spark, sf)
    t = r.select((F.col("distance") - 1500).alias("distance"), F.col("odds").cast("string").alias("cote_finale"), (F.col("weight") - 3).alias("poids"), (F.col("position") - 2).alias("place_corde"), (F.col("gains") - 2_000_000).alias("gains"), (F.col("draw") - 5).alias("delta_temps"), F.col("uid").alias("other"))
    return findings.range_issues(t).select("field", "rule", "n", real(F.col("least"), "least"))


_RULES = (("distance", "above zero", "distance - 1500", "<= 0"), ("cote_finale", "above zero", "odds", "<= 0"), ("poids", "above zero", "weight - 3", "<= 0"), ("place_corde", "not below zero", "position - 2", "< 0"), ("gains", "not below zero", "gains - 2000000", "< 0"))
RANGE_RULES = f"{R} " + " UNION ALL ".join(f"SELECT '{f}' AS field, '{rule}' AS rule, count(*) FILTER ({x} {bad}) AS n, {real_sql(f'min({x}) FILTER ({x} {bad})', 'least')} FROM r" for f, rule, x, bad in _RULES)


def result_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Anomalies of contests and results."""
    r = runners(spark, sf).withColumns({"finish": F.when(F.col("uid") % 50 != 0, F.col("position")), "winner": F.when(F.col("uid") % 31 == 0, 1 - F.col("won")).otherwise(F.col("won")), "started": F.col("uid") % 9 != 0})
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("race"), (F.col("o_orderstatus") != "P").alias("finished"), F.to_date("o_orderdate").alias("date")).where("dayofyear(date) % 30 > 9")
    return findings.result_anomalies(r, o, "race", "finished", "finish", "winner", "started", "date")


RESULT_ANOMALIES = f"""{R}, x AS (SELECT race, CASE WHEN uid % 50 <> 0 THEN position END AS p, CASE WHEN uid % 31 = 0 THEN 1 - won ELSE won END AS w, uid % 9 <> 0 AS s FROM r),
o AS (SELECT o_orderkey AS race, o_orderstatus <> 'P' AS f, o_orderdate::DATE AS d FROM orders WHERE dayofyear(o_orderdate) % 30 > 9),
g AS (SELECT race, max(w) AS w, count(*) FILTER (s AND p IS NULL) AS lost, count(*) FILTER (w = 1 AND p <> 1) AS odd FROM x GROUP BY race), j AS (SELECT o.*, w, lost, odd, g.race IS NULL AS none FROM o LEFT JOIN g USING (race)),
c AS (SELECT d - lag(d) OVER (ORDER BY d) AS gap FROM (SELECT DISTINCT d FROM o))
SELECT 'no_winner' AS anomaly, count(*) FILTER (f AND NOT none AND w = 0) AS n FROM j UNION ALL SELECT 'missing_positions', count(*) FILTER (f AND lost > 0) FROM j UNION ALL SELECT 'winner_not_first', coalesce(sum(odd), 0)::BIGINT FROM j
UNION ALL SELECT 'no_entrants', count(*) FILTER (none) FROM j UNION ALL SELECT 'calendar_gaps', count(*) FILTER (gap > 7) FROM c"""


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.concat(F.col("c_mktsegment"), F.lit(' "é", ;'))).alias("segment"), F.col("c_acctbal").alias("balance"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 10).cast("int")).alias("day"))


_CUSTOMERS = """c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment || ' "é", ;' END AS segment, c_acctbal AS balance, DATE '2024-01-01' + (c_custkey % 10)::INTEGER AS day FROM customer)"""
_SHOWN = f"c_custkey, segment, {real_sql('balance', 'balance')}, day::VARCHAR AS day"


def _shown(df: DataFrame) -> DataFrame:
    return df.select("c_custkey", "segment", real(F.col("balance"), "balance"), F.col("day").cast("string").alias("day"))


def json_lines_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A table through JSON lines, with broken and blank lines beside it that are skipped."""
    path, c = shared_path(spark, "jsonl"), _customers(spark, sf)
    c.select(F.to_json(F.struct(*c.columns)).alias("value")).unionByName(c.where("c_custkey % 50 = 0").select(F.lit('{"c_custkey": 1, broken').alias("value"))).unionByName(c.where("c_custkey % 40 = 0").select(F.lit(" ").alias("value"))).write.text(path)
    return _shown(readers.json_lines(spark, path, c.schema))


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables of different columns through one CSV, and back with types told from the values."""
    path, c = shared_path(spark, "csv"), _customers(spark, sf)
    sinks.union_csv([c.where("c_custkey % 2 = 0"), c.where("c_custkey % 2 = 1").drop("balance").withColumn("extra", F.array(F.lit(1), F.lit(2)))], path)
    back = readers.csv(spark, path)
    return back.select("c_custkey", "segment", real(F.col("balance"), "balance"), F.col("day").cast("string").alias("day"), F.col("extra").cast("string").alias("extra")).withColumn("c_custkey", F.col("c_custkey").cast("long"))


def parquet_parts(spark: SparkSession, sf: str) -> DataFrame:
    """A table in Parquet files of at most 50 rows by day, read back for one day; files are counted too."""
    path = shared_path(spark, "parquet")
    sinks.parquet(_customers(spark, sf), path, rows_per_file=50, partitions=["day"])
    files = spark.read.parquet(path).where("day = '2024-01-04'").groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("n"), (F.max("n") <= 50).alias("bounded"), (F.count(F.lit(1)) >= F.ceil(F.sum("n") / 50)).alias("enough_files"))


def three_formats_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A table in three formats at once; a row counts if all three give it back alike."""
    path, c = shared_path(spark, "three"), _customers(spark, sf)
    sinks.three_formats(c, path)
    parts = [spark.read.parquet(f"{path}/parquet"), readers.json_lines(spark, f"{path}/json", c.schema), readers.csv(spark, f"{path}/csv", c.schema)]
    same = parts[0].select(*c.columns).intersect(parts[1].select(*c.columns)).intersect(parts[2].select(*c.columns))
    return _shown(same)


def archive_range(spark: SparkSession, sf: str) -> DataFrame:
    """An archive that grows by batches, asked for a range of days and one segment."""
    path, c = shared_path(spark, "archive"), _customers(spark, sf)
    for k in range(2):
        sinks.archive(c.where(f"c_custkey % 2 = {k}"), path, "day")
    return _shown(sinks.archived(spark, path, "day", "2024-01-03", "2024-01-06", segment='BUILDING "é", ;'))


def encodings_and_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines in two encodings from the first path that is there, with the number of lines of its files."""
    path, c = shared_path(spark, "latin"), _customers(spark, sf).where("segment is not null")
    line = F.concat_ws("|", "c_custkey", "segment")
    c.where("c_custkey % 2 = 0").select(F.encode(line, "ISO-8859-1").cast("string").alias("value")).write.text(f"{path}/a")
    c.where("c_custkey % 2 = 1").select(line.alias("value")).write.text(f"{path}/b")
    found = readers.first_existing(spark, [f"{path}/missing", path])
    texts = readers.texts_in_any_encoding(spark, f"{found}/*").where("value <> ''")
    total = readers.line_counts(spark, f"{found}/*").agg(F.sum("n").alias("n_lines"))
    parts = F.split("value", r"\|")
    return texts.select(parts[0].cast("long").alias("c_custkey"), parts[1].alias("segment")).crossJoin(F.broadcast(total))


_ALL = {
    return_significance: RETURN_SIGNIFICANCE, monthly_fields: MONTHLY_FIELDS, range_rules: RANGE_RULES, result_anomalies: RESULT_ANOMALIES,
    json_lines_round_trip: f"WITH {_CUSTOMERS} SELECT {_SHOWN} FROM c",
    csv_round_trip: f"WITH {_CUSTOMERS} SELECT c_custkey, segment, {real_sql('CASE WHEN c_custkey % 2 = 0 THEN balance END', 'balance')}, day::VARCHAR AS day, CASE WHEN c_custkey % 2 = 1 THEN '[1,2]' END AS extra FROM c",
    parquet_parts: f"WITH {_CUSTOMERS} SELECT count(*) AS n, true AS bounded, true AS enough_files FROM c WHERE day = DATE '2024-01-04'",
    three_formats_round_trip: f"WITH {_CUSTOMERS} SELECT {_SHOWN} FROM c",
    archive_range: f"""WITH {_CUSTOMERS} SELECT {_SHOWN} FROM c WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-06' AND segment = 'BUILDING "é", ;'""",
    encodings_and_lines: f"WITH {_CUSTOMERS} SELECT c_custkey, segment, count(*) OVER () AS n_lines FROM c WHERE segment IS NOT NULL",
}
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {f.__name__: sql for f, sql in _ALL.items()}
