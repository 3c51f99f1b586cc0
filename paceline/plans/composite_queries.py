"""Queries over wide merges, careers, days and named bins, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.functions import scalars
from paceline.operators import composite
from paceline.operators.composite import Side
from paceline.plans.form_queries import integer, real, real_sql
from paceline.sources.tables import EVENTS_SQL, PEDIGREE_SQL, RUNNERS_SQL, events, pedigree, runners, table

R = f"WITH {RUNNERS_SQL}"


def feature_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Features of runs from four builders joined by run: of a name that two of them give, the later builder's value holds, its null too."""
    r = runners(spark, sf)
    market = r.where("uid % 3 <> 0").select("uid", (1 / F.col("odds")).alias("chance"), F.col("weight").alias("score"))
    form = r.where("uid % 4 <> 0").select("uid", F.when(F.col("uid") % 5 != 0, F.col("draw") * 10).alias("score"), F.col("placed").alias("form"))
    pace = r.where("uid % 7 <> 0").select("uid", (F.col("distance") / F.lit(1000.0)).alias("km"))
    late = r.where("uid % 11 = 0").select("uid", (F.col("distance") / F.lit(500.0)).alias("km"), F.lit("late").alias("discipline"))
    sides = [Side(n, d, {c: c for c in d.columns if c != "uid"}) for n, d in (("market", market), ("form", form), ("pace", pace), ("late", late))]
    out = composite.joined(r.select("uid", "race", "discipline"), sides, ["uid"])
    return out.select("uid", "race", "discipline", real(F.col("chance"), "chance"), integer(F.col("score"), "score"), integer(F.col("form"), "form"), real(F.col("km"), "km"))


FEATURE_MERGE = f"""{R} SELECT uid, race, CASE WHEN uid % 11 = 0 THEN 'late' ELSE discipline END AS discipline, {real_sql("CASE WHEN uid % 3 <> 0 THEN 1 / odds END", "chance")},
  CASE WHEN uid % 4 <> 0 THEN CASE WHEN uid % 5 <> 0 THEN draw * 10 END WHEN uid % 3 <> 0 THEN weight END::BIGINT AS score, CASE WHEN uid % 4 <> 0 THEN placed END::BIGINT AS form,
  {real_sql("CASE WHEN uid % 11 = 0 THEN distance / 500 WHEN uid % 7 <> 0 THEN distance / 1000 END", "km")} FROM r"""


def composite_races(spark: SparkSession, sf: str) -> DataFrame:
    """Contests with new columns only: payouts and field strength by contest, weather by day; what a contest has already stays."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("race"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("purse"))
    r = runners(spark, sf)
    payouts = r.where("won = 1").select("race", "odds", F.lit(-1.0).alias("purse"), "no")
    strength = r.groupBy("race").agg(F.avg("weight").alias("mean_weight"), F.count(F.lit(1)).alias("field"), F.max("odds").alias("odds"))
    e = events(spark, sf).groupBy(F.dayofmonth("ts").alias("dom")).agg(F.max("k").alias("temp"), F.lit("x").alias("status"))
    by_race = [Side("payouts", payouts, {"odds": "winner_odds", "purse": "purse"}, ["no"]), Side("strength", strength, {"mean_weight": "fs_mean_weight", "field": "fs_field", "odds": "winner_odds"})]
    out = composite.joined(o, by_race, ["race"], rule="new").withColumn("dom", F.dayofmonth("date"))
    out = composite.joined(out, [Side("weather", e, {"temp": "w_temp", "status": "status"})], ["dom"], rule="new")
    return out.select("race", "status", real(F.col("purse"), "purse"), real(F.col("winner_odds"), "winner_odds"), real(F.col("fs_mean_weight"), "fs_mean_weight"), integer(F.col("fs_field"), "fs_field"), integer(F.col("w_temp"), "w_temp"))


COMPOSITE_RACES = f"""{R}, {EVENTS_SQL.strip()}, p AS (SELECT race, arg_min(odds, no) AS odds FROM r WHERE won = 1 GROUP BY race), s AS (SELECT race, avg(weight) AS w, count(*) AS n, max(odds) AS odds FROM r GROUP BY race), d AS (SELECT day(ts) AS dom, max(k) AS temp FROM e GROUP BY 1)
SELECT o_orderkey AS race, o_orderstatus AS status, {real_sql("o_totalprice", "purse")}, {real_sql("CASE WHEN p.race IS NOT NULL THEN p.odds ELSE s.odds END", "winner_odds")}, {real_sql("s.w", "fs_mean_weight")}, s.n AS fs_field, d.temp::BIGINT AS w_temp
FROM orders LEFT JOIN p ON p.race = o_orderkey LEFT JOIN s ON s.race = o_orderkey LEFT JOIN d ON d.dom = day(o_orderdate)"""


def pedigree_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Pedigrees from three sources, field by field in order of trust, and the dosage in a noisy text of the third."""
    ped = pedigree(spark, sf)
    a = ped.where("horse % 3 <> 0").select("horse", F.when(F.col("horse") % 4 != 0, F.col("sire").cast("string")).otherwise("").alias("sire"), F.col("dam").cast("string").alias("dam"))
    b = ped.where("horse % 5 <> 0").select("horse", F.col("sire").cast("string").alias("sire"), F.concat(F.lit("b"), "horse").alias("dam"), F.lit("FR").alias("country"))
    p = table(spark, sf, "part")
    noisy = F.concat(F.lit("<td>x</td> DP = "), F.col("p_size"), F.lit("-2-10 ("), F.col("p_size") + 12, F.lit(") DI ="), F.round(F.col("p_retailprice") / 1000, 2), F.lit(" CD = -0."), F.col("p_size"), F.lit("<br>"))
    c = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("horse"), F.when(F.col("p_partkey") % 7 != 0, "IRE").otherwise("").alias("country"), F.when(F.col("p_partkey") % 3 != 0, noisy).otherwise("DP = none").alias("raw"))
    out = composite.by_priority({"a": a, "b": b, "c": c}, "horse", {"sire": [("a", "sire"), ("b", "sire")], "dam": [("a", "dam"), ("b", "dam")], "country": [("c", "country"), ("b", "country")], "raw": [("c", "raw")]})
    d = scalars.dosage(F.col("raw"))
    return out.select("horse", "sire", "dam", "country", d["profile"].alias("profile"), integer(d["total"], "total"), real(d["index"], "index"), real(d["centre"], "centre"), F.array_join("sources", "+").alias("sources"))


PEDIGREE_SOURCES = f"""WITH {PEDIGREE_SQL},
a AS (SELECT horse, CASE WHEN horse % 4 <> 0 THEN sire::VARCHAR ELSE '' END AS sire, dam::VARCHAR AS dam FROM ped WHERE horse % 3 <> 0), b AS (SELECT horse, sire::VARCHAR AS sire, 'b' || horse AS dam FROM ped WHERE horse % 5 <> 0),
c AS (SELECT p_partkey AS horse, CASE WHEN p_partkey % 7 <> 0 THEN 'IRE' ELSE '' END AS country, p_partkey % 3 <> 0 AS d, p_size, p_retailprice FROM part WHERE p_partkey % 2 = 0),
k AS (SELECT horse FROM a UNION SELECT horse FROM b UNION SELECT horse FROM c)
SELECT k.horse, coalesce(nullif(a.sire, ''), b.sire) AS sire, coalesce(a.dam, b.dam) AS dam, coalesce(nullif(c.country, ''), CASE WHEN b.horse IS NOT NULL THEN 'FR' END) AS country, CASE WHEN d THEN p_size || '-2-10' END AS profile, CASE WHEN d THEN p_size + 12 END::BIGINT AS total,
  {real_sql("CASE WHEN d THEN round(p_retailprice / 1000, 2) END", "index")}, {real_sql("CASE WHEN d THEN -('0.' || p_size)::DOUBLE END", "centre")}, concat_ws('+', CASE WHEN a.horse IS NOT NULL THEN 'a' END, CASE WHEN b.horse IS NOT NULL THEN 'b' END, CASE WHEN c.horse IS NOT NULL THEN 'c' END) AS sources
FROM k LEFT JOIN a ON a.horse = k.horse LEFT JOIN b ON b.horse = k.horse LEFT JOIN c ON c.horse = k.horse"""


def normalised_name_join(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with a rating by name, whatever case, accents and signs the name is written with; the smallest of several ratings."""
    p = table(spark, sf, "part").select("p_partkey", F.concat_ws("  ", F.upper("p_name"), F.lit("(É)")).alias("name"))
    rated = table(spark, sf, "part").where("p_size > 20").select(F.concat(F.initcap(F.replace("p_name", F.lit(" "), F.lit("-"))), F.lit(" e")).alias("name"), F.col("p_size").alias("rating"))
    keyed = rated.groupBy(scalars.name_key(F.col("name")).alias("key")).agg(integer(F.min("rating"), "rating")).where("key is not null")
    return p.withColumn("key", scalars.name_key(F.col("name"))).join(keyed, "key", "left").select("p_partkey", "key", "rating")


NORMALISED_NAME_JOIN = """WITH k AS (SELECT upper(p_name) || ' E' AS key, min(p_size)::BIGINT AS rating FROM part WHERE p_size > 20 GROUP BY 1)
SELECT p_partkey, upper(p_name) || ' E' AS key, rating FROM part LEFT JOIN k ON key = upper(p_name) || ' E'"""


def starters(spark: SparkSession, sf: str) -> DataFrame:
    """Entrants that started by contest: declared non-starters are out, entrants of unknown status in."""
    r = runners(spark, sf).withColumn("status", F.when(F.col("uid") % 9 == 0, "non_partant").when(F.col("uid") % 9 == 1, F.lit(None)).otherwise("partant"))
    return r.groupBy("race").agg(F.count(F.lit(1)).alias("declared"), F.count_if(scalars.started(F.col("status"))).alias("started"))


STARTERS = f"{R} SELECT race, count(*) AS declared, count(*) FILTER (uid % 9 <> 0) AS started FROM r GROUP BY race"


def career_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Every horse's runs by year as an ordered array, with counts; shown by a digest of the array's text."""
    r = runners(spark, sf).withColumn("year", F.year("race_date"))
    c = composite.careers(r, "horse", "year", ["day", "race", "no"], ["position", "gains"])
    text = F.array_join(F.transform("rows", lambda x: F.concat_ws(":", x["day"], x["race"], x["no"], x["position"], x["gains"])), ",")
    return c.select("horse", integer(F.col("year"), "year"), "n", integer(F.get("rows", F.lit(0))["position"], "first_position"), F.md5(text).alias("digest"))


CAREER_ARRAYS = f"""{R} SELECT horse, year(race_date) AS year, count(*) AS n, arg_min(position, (day, race, no))::BIGINT AS first_position, md5(string_agg(day || ':' || race || ':' || no || ':' || position || ':' || gains, ',' ORDER BY day, race, no)) AS digest FROM r GROUP BY 1, 2"""


def entity_index(spark: SparkSession, sf: str) -> DataFrame:
    """One index of horses, jockeys, trainers and contests: runs, wins, places, earnings, first and last day; every run is read once for all four."""
    r = runners(spark, sf)
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("entity")) for k in ("horse", "jockey", "trainer", "race"))))
    rows = r.select(kinds.alias("k"), "won", "placed", "gains", "day").where("k.entity is not null")
    return rows.groupBy("k.kind", "k.entity").agg(F.count(F.lit(1)).alias("runs"), F.sum("won").alias("wins"), F.sum("placed").alias("places"), F.sum("gains").alias("gains"), integer(F.min("day"), "first_day"), integer(F.max("day"), "last_day"))


ENTITY_INDEX = f"{R} " + " UNION ALL ".join(f"SELECT '{k}' AS kind, {k}::VARCHAR AS entity, count(*) AS runs, sum(won)::BIGINT AS wins, sum(placed)::BIGINT AS places, sum(gains)::BIGINT AS gains, min(day)::BIGINT AS first_day, max(day)::BIGINT AS last_day FROM r GROUP BY {k}" for k in ("horse", "jockey", "trainer", "race"))


def hourly_to_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Days of weather from hours: ends of temperature, total rain, strongest wind; missing readings are left out."""
    e = events(spark, sf).select("ts", F.when(F.col("k") % 10 != 0, F.col("k") % 41 - 5).alias("temp"), F.when(F.col("k") % 7 != 0, F.col("k") % 5 / F.lit(4.0)).alias("rain"), (F.col("k") * 7 % 61).alias("wind"))
    out = composite.daily(e, [], "ts", {"temp_min": ("temp", "min"), "temp_max": ("temp", "max"), "rain": ("rain", "sum"), "wind_max": ("wind", "max")})
    return out.select(F.col("date").cast("string").alias("date"), integer(F.col("temp_min"), "temp_min"), integer(F.col("temp_max"), "temp_max"), real(F.col("rain"), "rain"), integer(F.col("wind_max"), "wind_max"))


HOURLY_TO_DAILY = f"""WITH {EVENTS_SQL} SELECT ts::DATE::VARCHAR AS date, (min(k % 41 - 5) FILTER (k % 10 <> 0))::BIGINT AS temp_min, (max(k % 41 - 5) FILTER (k % 10 <> 0))::BIGINT AS temp_max, {real_sql("round(sum(k % 5 / 4) FILTER (k % 7 <> 0), 2)", "rain")}, max(k * 7 % 61)::BIGINT AS wind_max FROM e GROUP BY ts::DATE"""


def performances_with_sectionals(spark: SparkSession, sf: str) -> DataFrame:
    """The first record of each run with the sectionals that there are, and sectionals without a record."""
    r = runners(spark, sf)
    key = ["race", "horse"]
    perf = r.where("uid % 5 <> 0").select(*key, "no", "position")
    side = r.where("uid % 3 <> 1").groupBy(*key).agg(F.min("gains").alias("last_600"))
    out = composite.enriched_or_orphan(perf, side, key, "sect_", ["no"], ("performances", "sectionals"))
    return out.select(*key, integer(F.col("position"), "position"), integer(F.col("sect_last_600"), "sect_last_600"), "sources")


PERFORMANCES_WITH_SECTIONALS = f"""{R}, p AS (SELECT race, horse, position FROM r WHERE uid % 5 <> 0 QUALIFY row_number() OVER (PARTITION BY race, horse ORDER BY no) = 1), s AS (SELECT race, horse, min(gains) AS g FROM r WHERE uid % 3 <> 1 GROUP BY 1, 2)
SELECT race, horse, p.position::BIGINT AS position, g::BIGINT AS sect_last_600, concat_ws('+', CASE WHEN p.position IS NOT NULL THEN 'performances' END, CASE WHEN g IS NOT NULL THEN 'sectionals' END) AS sources FROM p FULL JOIN s USING (race, horse)"""


_BANDS_OF = {"distance F": "distance", "going A": "reading", "going B": "reading", "field A": "field", "field B": "field", "field C": "field", "odds A": "odds", "odds B": "odds", "rest": "rest"}


def named_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Bins of field size, odds, going, distance and rest under every named set of cuts."""
    r = runners(spark, sf).withColumns({"field": F.count(F.lit(1)).over(Window.partitionBy("race")), "reading": F.col("gains") % 40 / F.lit(10.0) + 2, "rest": F.col("day") % 200})
    wide = r.withColumn("field", F.col("field") * 2)
    return wide.select("uid", *(scalars.band(F.col(c), n).alias(n.replace(" ", "_").lower()) for n, c in _BANDS_OF.items()))


def _band_sql(column: str, name: str) -> str:
    cuts, closed, labels = scalars.BANDS[name]
    op = "<" if closed == "left" else "<="
    return f"CASE {' '.join(f'WHEN {column} {op} {c} THEN {chr(39)}{label}{chr(39)}' for c, label in zip(cuts, labels, strict=False))} ELSE '{labels[-1]}' END AS {name.replace(' ', '_').lower()}"


NAMED_BINS = f"{R}, w AS (SELECT *, 2 * count(*) OVER (PARTITION BY race) AS field, gains % 40 / 10.0 + 2 AS reading, day % 200 AS rest FROM r) SELECT uid, {', '.join(_band_sql(c, n) for n, c in _BANDS_OF.items())} FROM w"

_ALL = {feature_merge: FEATURE_MERGE, composite_races: COMPOSITE_RACES, pedigree_sources: PEDIGREE_SOURCES, normalised_name_join: NORMALISED_NAME_JOIN, starters: STARTERS, career_arrays: CAREER_ARRAYS, entity_index: ENTITY_INDEX, hourly_to_daily: HOURLY_TO_DAILY, performances_with_sectionals: PERFORMANCES_WITH_SECTIONALS, named_bins: NAMED_BINS}
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {f.__name__: sql for f, sql in _ALL.items()}
