"""Queries over ranks in a field, entity tables, merges, cleaning, stakes and drift, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.functions import scalars
from paceline.operators import cleaning, merge, pit, race
from paceline.plans.form_queries import integer, real, real_sql
from paceline.sources.tables import EVENTS_SQL, RUNNERS_SQL, TRACKS_SQL, events, runners, table, with_tracks

R, RT, E = f"WITH {RUNNERS_SQL}", f"WITH {TRACKS_SQL}", f"WITH {EVENTS_SQL}"
P = f"{R}, pr AS (SELECT *, (1.0 / odds)::DOUBLE / sum((1.0 / odds)::DOUBLE) OVER (PARTITION BY race) AS p, count(*) OVER (PARTITION BY race) AS fs FROM r)"


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    return runners(spark, sf).withColumns(race.implied_probability("odds")).withColumns({"p": F.col("probability"), "fs": F.count(F.lit(1)).over(race.field())})


def field_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Market, form and earnings ranks (unknown odds last, unknown form 0), probability's competition rank, rank over field size, consensus gap."""
    r = _predicted(spark, sf).withColumns({"known_odds": F.when(F.col("uid") % 9 != 0, F.col("odds")), "form": F.when(F.col("uid") % 4 != 0, F.col("weight"))})
    market = race.positional_rank(F.coalesce("known_odds", F.lit(999.0)), "no")
    form = race.positional_rank(F.desc(F.coalesce("form", F.lit(0))), "no")
    by_p = race.competition_rank(F.desc("odds"))
    return r.select("uid", integer(market, "market_rank"), integer(form, "form_rank"), integer(race.positional_rank(F.desc("gains"), "no"), "gains_rank"), integer(by_p, "long_shot_rank"), real(by_p / F.col("fs"), "relative_rank"), integer(market - form, "consensus_gap"))


FIELD_RANKS = f"""{P}, x AS (SELECT *, CASE WHEN uid % 9 <> 0 THEN odds END AS ko, CASE WHEN uid % 4 <> 0 THEN weight END AS form FROM pr),
k AS (SELECT *, row_number() OVER (PARTITION BY race ORDER BY coalesce(ko, 999.0), no) AS m, row_number() OVER (PARTITION BY race ORDER BY coalesce(form, 0) DESC, no) AS f, rank() OVER (PARTITION BY race ORDER BY odds DESC) AS b FROM x)
SELECT uid, m AS market_rank, f AS form_rank, row_number() OVER (PARTITION BY race ORDER BY gains DESC, no) AS gains_rank, b AS long_shot_rank, {real_sql('b / fs', 'relative_rank')}, m - f AS consensus_gap FROM k"""


def field_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Odds (mean, median, least, most, deviation) and weights of each contest, base-2 entropy over its maximum, the market's certainty, purse over its discipline's median."""
    p = _predicted(spark, sf)
    f = p.groupBy("race").agg(F.avg("odds").alias("mo"), F.percentile("odds", F.lit(0.5)).alias("med"), F.min("odds").alias("lo"), F.max("odds").alias("hi"), F.stddev_samp("odds").alias("sd"), F.avg("weight").alias("mw"), F.max("weight").alias("hw"), F.min("weight").alias("lw"), (-F.sum(F.col("p") * F.log2("p"))).alias("ent"), F.max("p").alias("top"), F.count(F.lit(1)).alias("n"), F.sum("gains").alias("purse"), F.min_by("discipline", "no").alias("discipline"))
    middle = f.groupBy(F.col("discipline").alias("of")).agg(F.percentile("purse", F.lit(0.5)).alias("usual"))
    f = f.join(middle, F.col("discipline").eqNullSafe(F.col("of")), "left")
    return f.select("race", real(F.col("mo"), "mean_odds"), real(F.col("med"), "median_odds"), real(F.col("lo"), "least_odds"), real(F.col("hi"), "most_odds"), real(F.col("sd"), "sd_odds"), real(F.col("mw"), "mean_weight"), integer(F.col("hw"), "most_weight"), integer(F.col("lw"), "least_weight"), real(F.when(F.col("n") > 1, F.col("ent") / F.log2("n")), "entropy"), real(F.col("top"), "certainty"), real(F.col("purse") / F.col("usual"), "purse_ratio"))


FIELD_STATISTICS = f"""{P}, f AS (SELECT race, avg(odds) AS mo, median(odds) AS med, min(odds) AS lo, max(odds) AS hi, stddev_samp(odds) AS sd, avg(weight) AS mw, max(weight) AS hw, min(weight) AS lw, -sum(p * log2(p)) AS ent, max(p) AS top, count(*) AS n, sum(gains) AS purse, arg_min(discipline, no) AS discipline FROM pr GROUP BY race),
m AS (SELECT discipline, median(purse::DOUBLE) AS usual FROM f GROUP BY 1)
SELECT race, {real_sql('mo', 'mean_odds')}, {real_sql('med', 'median_odds')}, {real_sql('lo', 'least_odds')}, {real_sql('hi', 'most_odds')}, {real_sql('sd', 'sd_odds')}, {real_sql('mw', 'mean_weight')}, hw::BIGINT AS most_weight, lw::BIGINT AS least_weight, {real_sql('CASE WHEN n > 1 THEN ent / log2(n) END', 'entropy')}, {real_sql('top', 'certainty')}, {real_sql('purse / usual', 'purse_ratio')} FROM f JOIN m ON f.discipline IS NOT DISTINCT FROM m.discipline"""


def market_moves(spark: SparkSession, sf: str) -> DataFrame:
    """From reference odds to final odds: closing line value, relative move, steam and drift, back-lay spread and mid, overbet index, products that are null if a side is."""
    r = _predicted(spark, sf).withColumn("ref", (100 + F.col("gains") % 3700) / F.lit(100.0))
    move = (F.col("odds") - F.col("ref")) / F.col("ref")
    share = F.col("gains") / F.sum("gains").over(race.field())
    lay = F.col("odds") + 0.1 * F.col("draw")
    some = F.when(F.col("uid") % 3 != 0, F.col("weight"))
    flag = lambda c, n: integer(c.cast("int"), n)
    return r.select("uid", real(scalars.clv_implied(F.col("ref"), F.col("odds")), "clv"), real(move, "move"), flag(move < -0.15, "steam"), flag(move > 0.20, "drift"), real(lay - F.col("odds"), "spread"), real(2 / (lay + F.col("odds")), "mid"), real(2 / (lay + F.col("odds")) - F.col("p"), "sharp"), real(share / F.col("p"), "overbet"), real(F.col("p") / share, "underbet"), real(some * F.col("distance"), "weight_distance"), integer(((some >= 8) & (F.col("distance") > 2400)).cast("int"), "burdened"))


MARKET_MOVES = f"""{P}, x AS (SELECT *, (100 + gains % 3700) / 100.0 AS ref, gains / sum(gains) OVER (PARTITION BY race) AS share, odds + 0.1 * draw AS lay, CASE WHEN uid % 3 <> 0 THEN weight END AS sw FROM pr)
SELECT uid, {real_sql('1.0::DOUBLE / odds - 1.0::DOUBLE / ref', 'clv')}, {real_sql('(odds - ref)::DOUBLE / ref', 'move')}, ((odds - ref)::DOUBLE / ref < -0.15)::BIGINT AS steam, ((odds - ref)::DOUBLE / ref > 0.20)::BIGINT AS drift, {real_sql('lay - odds', 'spread')}, {real_sql('2.0::DOUBLE / (lay + odds)', 'mid')}, {real_sql('2.0::DOUBLE / (lay + odds) - p', 'sharp')}, {real_sql('share / p', 'overbet')}, {real_sql('p / share', 'underbet')}, {real_sql('sw * distance', 'weight_distance')}, (sw >= 8 AND distance > 2400)::BIGINT AS burdened FROM x"""


def weather_and_class(spark: SparkSession, sf: str) -> DataFrame:
    """Comfort, wind, moisture and weather score of an event's readings; weather flags that a zero leaves false; class rating and speed figures of runs."""
    e = events(spark, sf).withColumns({"temp": F.col("k") % 41 - 5, "wind": F.col("k") * 7 % 61, "wet": F.col("k") * 3 % 101, "rain": F.col("k") % 5 / 4})
    cold = F.when(F.col("temp") < 0, 3).when(F.col("temp") < 5, 2).when(F.col("temp") > 30, 2).when(F.col("temp") > 25, 1).otherwise(0)
    windy = F.when(F.col("wind") > 50, 3).when(F.col("wind") > 30, 2).when(F.col("wind") > 20, 1).otherwise(0)
    damp = F.when(F.col("wet") > 90, 2).when(F.col("wet") > 80, 1).otherwise(0)
    flag = lambda c, n: integer(c.cast("int"), n)
    comfort = F.greatest(F.lit(0.0), 1 - F.abs(F.col("temp") - 15) / 10 - F.col("wind") / 40 * 0.3 - (F.col("rain") > 0.5).cast("int") * 0.3)
    return e.select("event_id", real(comfort, "comfort"), real((F.col("wind") + F.col("wet") * 0.5) / 30, "wind_impact"), real(F.col("rain") + F.col("wet") / 100 * 2, "moisture"), integer(F.least(cold + windy + damp, F.lit(10)), "weather_score"), flag(F.col("rain") > 0.5, "rainy"), flag(F.col("wind") > 30, "windy"), flag(F.col("temp") > 30, "hot"), flag((F.col("temp") < 5) & (F.col("temp") != 0), "cold"))


WEATHER_AND_CLASS = f"""{E}, x AS (SELECT *, k % 41 - 5 AS temp, k * 7 % 61 AS wind, k * 3 % 101 AS wet, k % 5 / 4 AS rain FROM e)
SELECT event_id, {real_sql('greatest(0, 1 - abs(temp - 15) / 10 - wind / 40 * 0.3 - (rain > 0.5)::INTEGER * 0.3)', 'comfort')}, {real_sql('(wind + wet * 0.5) / 30', 'wind_impact')}, {real_sql('rain + wet / 100 * 2', 'moisture')},
  least(10, CASE WHEN temp < 0 THEN 3 WHEN temp < 5 THEN 2 WHEN temp > 30 THEN 2 WHEN temp > 25 THEN 1 ELSE 0 END + CASE WHEN wind > 50 THEN 3 WHEN wind > 30 THEN 2 WHEN wind > 20 THEN 1 ELSE 0 END + CASE WHEN wet > 90 THEN 2 WHEN wet > 80 THEN 1 ELSE 0 END)::BIGINT AS weather_score, (rain > 0.5)::BIGINT AS rainy, (wind > 30)::BIGINT AS windy, (temp > 30)::BIGINT AS hot, (temp < 5 AND temp <> 0)::BIGINT AS cold FROM x"""


def speed_figures(spark: SparkSession, sf: str) -> DataFrame:
    """Speed in km/h, figure against the track's past (100 + 15 deviations), class rating of three capped terms."""
    r = with_tracks(runners(spark, sf), spark, sf).withColumn("ms", 60000 + F.col("gains") % 90000)
    r = r.withColumn("red", F.floor(F.col("ms") * 1000 / F.col("distance"))).withColumn("square", F.col("red").cast("double") * F.col("red"))
    r = pit.daily_history(r, ["track"], "t", {"red": "red", "square": "square"})
    mean = F.try_divide(F.col("t_red").cast("double"), "t_runs")
    sd = F.sqrt(F.greatest(F.lit(0.0), F.try_divide("t_square", "t_runs") - mean * mean))
    rating = F.least(F.col("gains") / 100 / 5000, F.lit(50)) + F.col("won") * 30 + F.least(F.sum("gains").over(race.field()) / 100 / 2000, F.lit(20))
    return r.select("uid", real(F.col("distance") / 1000 / (F.col("ms") / 3600000), "kmh"), (F.round(F.when(F.round(sd, 6) > 0, 100 + (mean - F.col("red")) / sd * 15), 3) + F.lit(0.0)).alias("figure"), real(rating, "class_rating"))


SPEED_FIGURES = f"""{RT}, x AS (SELECT *, 60000 + gains % 90000 AS ms, floor((60000 + gains % 90000) * 1000 / distance) AS red FROM rt)
SELECT uid, {real_sql('distance / 1000 / (ms / 3600000)', 'kmh')}, round(CASE WHEN stddev_pop(red) OVER w > 0 THEN 100 + (avg(red) OVER w - red) / stddev_pop(red) OVER w * 15 END, 3) + 0.0 AS figure, {real_sql('least(gains / 100 / 5000, 50) + won * 30 + least(sum(gains) OVER (PARTITION BY race) / 100 / 2000, 20)', 'class_rating')}
FROM x WINDOW w AS (PARTITION BY track ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def trainer_table(spark: SparkSession, sf: str) -> DataFrame:
    """Trainers' careers: counts, rates, distinct horses and jockeys, runs of the 30, 90 and 365 days up to their own last run, all jockeys with 2 or more runs (most first), runs by year."""
    r = runners(spark, sf).withColumn("last_day", F.max("day").over(Window.partitionBy("trainer")))
    by = r.groupBy("trainer", "jockey").agg(F.count(F.lit(1)).alias("n"))
    pairs = by.groupBy(F.col("trainer").alias("of")).agg(integer(F.count("jockey"), "jockeys"), F.sort_array(F.collect_list(F.when(F.col("n") >= 2, F.struct((-F.col("n")).alias("m"), "jockey", "n")))).alias("l"))
    years = r.groupBy("trainer", F.year("race_date").alias("y")).agg(F.count(F.lit(1)).alias("n")).groupBy("trainer").agg(F.sort_array(F.collect_list(F.struct("y", "n"))).alias("l"))
    text = lambda a, k: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x[k], x["n"])), ",")
    # Distinct horses are the groups of a sum that goes on to the trainer; counted beside the jockeys, each run would stand in memory three times.
    since = {f"runs_{d}": F.count_if(F.col("day") >= F.col("last_day") - d) for d in (30, 90, 365)}
    horses = r.groupBy("trainer", "horse").agg(F.count(F.lit(1)).alias("runs"), *(F.sum(c).alias(c) for c in ("won", "placed", "position", "gains")), F.max("day").alias("day"), *(c.alias(n) for n, c in since.items()))
    rate = lambda c: F.sum(c).cast("double") / F.sum("runs")
    t = horses.groupBy("trainer").agg(integer(F.sum("runs"), "runs"), integer(F.sum("won"), "wins"), integer(F.sum("placed"), "places"), real(rate("won"), "win_rate"), real(rate("position"), "mean_position"), integer(F.sum("gains"), "gains"), integer(F.count("horse"), "horses"), integer(F.max("day"), "last_day"), *(integer(F.sum(n), n) for n in since))
    t = t.join(pairs, F.col("trainer").eqNullSafe(F.col("of"))).join(years.select("trainer", text("l", "y").alias("career")), "trainer", "left")
    partners = F.when(F.col("trainer").isNotNull() & (F.size("l") > 0), text("l", "jockey"))
    return t.select("trainer", "runs", "wins", "places", "win_rate", "mean_position", "gains", "horses", "jockeys", "last_day", *since, partners.alias("partners"), "career")


TRAINER_TABLE = f"""{R}, x AS (SELECT *, max(day) OVER (PARTITION BY trainer) AS ld FROM r),
p AS (SELECT trainer, string_agg(jockey || ':' || n, ',' ORDER BY n DESC, jockey) AS partners FROM (SELECT trainer, jockey, count(*) AS n FROM r GROUP BY 1, 2 HAVING count(*) >= 2) GROUP BY 1),
y AS (SELECT trainer, string_agg(yr || ':' || n, ',' ORDER BY yr) AS career FROM (SELECT trainer, year(race_date) AS yr, count(*) AS n FROM r GROUP BY ALL) GROUP BY 1),
t AS (SELECT trainer, count(*) AS runs, sum(won)::BIGINT AS wins, sum(placed)::BIGINT AS places, {real_sql('avg(won)', 'win_rate')}, {real_sql('avg(position)', 'mean_position')}, sum(gains)::BIGINT AS gains, count(DISTINCT horse) AS horses, count(DISTINCT jockey) AS jockeys, max(day)::BIGINT AS last_day, {", ".join(f"count(*) FILTER (day >= ld - {d}) AS runs_{d}" for d in (30, 90, 365))} FROM x GROUP BY trainer)
SELECT * FROM t LEFT JOIN p USING (trainer) LEFT JOIN y USING (trainer)"""


def completeness_cube(spark: SparkSession, sf: str) -> DataFrame:
    """Filled share of three fields by year and discipline, with all subtotals."""
    r = runners(spark, sf).withColumns({"w": F.when(F.col("uid") % 7 != 0, F.col("weight")), "e": F.when(F.col("uid") % 5 != 0, F.col("equipment")), "year": F.year("race_date")})
    long = r.select("year", "discipline", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).isNotNull().alias("ok")) for c in ("w", "e", "draw")))).alias("x")).select("year", "discipline", "x.*")
    return long.cube("field", "year", "discipline").agg(integer(F.count(F.lit(1)), "n"), integer(F.count_if("ok"), "filled"), integer(F.grouping_id(), "level")).withColumn("year", F.col("year").cast("long"))


COMPLETENESS_CUBE = f"""{R}, x AS (SELECT *, CASE WHEN uid % 7 <> 0 THEN weight END AS w, CASE WHEN uid % 5 <> 0 THEN equipment END AS e, year(race_date)::BIGINT AS year FROM r),
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS field, year, discipline, {c} IS NOT NULL AS ok FROM x" for c in ("w", "e", "draw"))})
SELECT field, year, discipline, count(*) AS n, count(*) FILTER (ok) AS filled, grouping_id(field, year, discipline)::BIGINT AS level FROM l GROUP BY CUBE (field, year, discipline)"""


def reservoir(spark: SparkSession, sf: str) -> DataFrame:
    """A sample of 100 runs: those with the smallest hash of their number, whatever the partitions."""
    r = runners(spark, sf)
    return r.select("uid", "race", F.md5(F.concat(F.lit("s"), F.col("uid").cast("string"))).alias("h")).orderBy("h", "uid").limit(100).select("uid", "race")


RESERVOIR = f"""{R} SELECT uid, race FROM r ORDER BY md5('s' || uid), uid LIMIT 100"""


def category_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Categories of each field that appear, disappear and stay between two periods, and their shared part."""
    r = runners(spark, sf).withColumn("late", F.col("day") > 1200)
    long = r.select("late", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in ("discipline", "horse", "draw")))).alias("x")).select("late", "x.*")
    seen = long.groupBy("field", "value").agg(F.max(F.col("late").cast("int")).alias("b"), F.max((~F.col("late")).cast("int")).alias("a"))
    out = seen.groupBy("field").agg(integer(F.sum(F.col("b") * (1 - F.col("a"))), "appeared"), integer(F.sum(F.col("a") * (1 - F.col("b"))), "disappeared"), integer(F.sum(F.col("a") * F.col("b")), "stayed"), integer(F.count(F.lit(1)), "all_values"))
    return out.withColumn("overlap", F.round(F.col("stayed") / F.col("all_values"), 6))


CATEGORY_DRIFT = f"""{R}, l AS ({" UNION ALL ".join(f"SELECT '{f}' AS field, {f}::VARCHAR AS value, day > 1200 AS late FROM r" for f in ("discipline", "horse", "draw"))}), s AS (SELECT field, value, bool_or(late) AS b, bool_or(NOT late) AS a FROM l GROUP BY 1, 2)
SELECT field, count(*) FILTER (b AND NOT a) AS appeared, count(*) FILTER (a AND NOT b) AS disappeared, count(*) FILTER (a AND b) AS stayed, count(*) AS all_values, round(count(*) FILTER (a AND b) / count(*), 6) AS overlap FROM s GROUP BY field"""


def batch_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Each month against all months: null rate, shift of the mean in deviations, share of outliers beyond 3 deviations, constant column."""
    r = runners(spark, sf).withColumns({"w": F.when(F.col("uid") % 7 != 0, F.col("weight")), "month": F.date_format("race_date", "yyyy-MM")})
    base = r.agg(F.avg("w").alias("m"), F.stddev_pop("w").alias("s"), F.avg("distance").alias("dm"), F.stddev_pop("distance").alias("ds"))
    x = r.crossJoin(F.broadcast(base))  # one row
    return x.groupBy("month").agg(integer(F.count(F.lit(1)), "n"), real(F.avg(F.col("w").isNull().cast("int")), "null_rate"), real((F.avg("w") - F.first("m")) / F.first("s"), "weight_shift"), real((F.avg("distance") - F.first("dm")) / F.first("ds"), "distance_shift"), real(F.avg((F.abs(F.col("distance") - F.col("dm")) > 1.7 * F.col("ds")).cast("int")), "outliers"), integer((F.min("w") == F.max("w")).cast("int"), "constant"))


BATCH_QUALITY = f"""{R}, x AS (SELECT *, CASE WHEN uid % 7 <> 0 THEN weight END AS w, strftime(race_date, '%Y-%m') AS month FROM r), b AS (SELECT avg(w) AS m, stddev_pop(w) AS s, avg(distance) AS dm, stddev_pop(distance) AS ds FROM x)
SELECT month, count(*) AS n, {real_sql('avg((w IS NULL)::INTEGER)', 'null_rate')}, {real_sql('(avg(w) - any_value(m)) / any_value(s)', 'weight_shift')}, {real_sql('(avg(distance) - any_value(dm)) / any_value(ds)', 'distance_shift')}, {real_sql('avg((abs(distance - dm) > 1.7 * ds)::INTEGER)', 'outliers')}, (min(w) = max(w))::BIGINT AS constant FROM x, b GROUP BY month"""


def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Labels in long form: counts and shares of binary and categorical ones, moments of continuous ones."""
    r = runners(spark, sf)
    n = F.sum("n").over(Window.partitionBy("label"))
    values = [F.struct(F.lit(c).alias("label"), F.col(c).cast("string").alias("value")) for c in ("won", "placed", "position")]
    counted = r.select(F.explode(F.array(*values)).alias("x")).select("x.*").groupBy("label", "value").agg(F.count(F.lit(1)).alias("n"))
    none = lambda c: F.lit(None).cast("double").alias(c)
    discrete = counted.select("label", "value", "n", real(F.col("n") / n, "share"), none("mean"), none("sd"))
    moments = r.agg(F.count(F.lit(1)).alias("n"), F.avg("gains").alias("m"), F.stddev_pop("gains").alias("s"))
    return discrete.unionByName(moments.select(F.lit("gains").alias("label"), F.lit(None).cast("string").alias("value"), "n", none("share"), F.round("m", 2).alias("mean"), F.round("s", 2).alias("sd")))


LABEL_DISTRIBUTION = f"""{R}, l AS ({" UNION ALL ".join(f"SELECT '{c}' AS label, {c}::VARCHAR AS value FROM r" for c in ("won", "placed", "position"))})
SELECT label, value, count(*) AS n, {real_sql('count(*) / sum(count(*)) OVER (PARTITION BY label)', 'share')}, NULL::DOUBLE AS mean, NULL::DOUBLE AS sd FROM l GROUP BY 1, 2 UNION ALL SELECT 'gains', NULL, count(*), NULL, round(avg(gains), 2), round(stddev_pop(gains), 2) FROM r"""

SIDES_SQL = f"""{R}, base AS (SELECT uid, horse, day, discipline, race, no, weight FROM r), side AS (SELECT horse, day, discipline, position, uid AS su FROM r WHERE uid % 3 <> 0)"""


def three_key_match(spark: SparkSession, sf: str) -> DataFrame:
    """Match on horse, day and discipline, else on horse and day: the first side row by number."""
    r = runners(spark, sf)
    side = r.where("uid % 3 <> 0").select("horse", "day", "discipline", "position", F.col("uid").alias("su"))
    other = r.select("uid", "horse", "day", F.when(F.col("uid") % 2 == 0, F.col("discipline")).otherwise("X").alias("discipline"))
    return merge.fallback_join(other, side, ["horse", "day", "discipline"], ["horse", "day"], ["position"], [F.col("su")]).select("uid", integer(F.col("position"), "position"), integer(F.col("matched_by"), "matched_by"))


THREE_KEY_MATCH = f"""{SIDES_SQL}, o AS (SELECT uid, horse, day, CASE WHEN uid % 2 = 0 THEN discipline ELSE 'X' END AS discipline FROM base), a AS (SELECT * FROM side QUALIFY row_number() OVER (PARTITION BY horse, day, discipline ORDER BY su) = 1), b AS (SELECT * FROM side QUALIFY row_number() OVER (PARTITION BY horse, day ORDER BY su) = 1)
SELECT uid, coalesce(a.position, b.position)::BIGINT AS position, CASE WHEN a.su IS NOT NULL THEN 1 WHEN b.su IS NOT NULL THEN 2 ELSE 0 END::BIGINT AS matched_by FROM o LEFT JOIN a ON o.horse = a.horse AND o.day = a.day AND o.discipline = a.discipline LEFT JOIN b ON o.horse = b.horse AND o.day = b.day"""


def prediction_results(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions matched with results (unmatched dropped): hit flags, rank error, log loss and return of each contest's first choice."""
    p = _predicted(spark, sf).withColumn("rank", race.positional_rank(F.desc("p"), "no"))
    predictions = p.where("race % 5 <> 0").select("uid", "race", "p", "rank", "odds")
    results = runners(spark, sf).where("race % 7 <> 0").select("uid", "position", "won")
    x = predictions.join(results, "uid")
    loss = -F.ln(F.when(F.col("won") == 1, F.col("p")).otherwise(1 - F.col("p")) + 1e-15)
    top = lambda k: integer(F.max(F.when(F.col("won") == 1, (F.col("rank") <= k).cast("int"))), f"hit_{k}")
    return x.groupBy("race").agg(integer(F.count(F.lit(1)), "n"), top(1), top(3), top(5), real(F.avg(F.abs(F.col("rank") - F.col("position"))), "rank_error"), real(F.avg(loss), "log_loss"), real(F.max(F.when(F.col("rank") == 1, F.when(F.col("won") == 1, F.col("odds") - 1).otherwise(-1.0))), "return"))


_PREDICTED_SQL = "pp AS (SELECT *, row_number() OVER (PARTITION BY race ORDER BY p DESC, no) AS rank FROM pr WHERE race % 5 <> 0), m AS (SELECT pp.* FROM pp WHERE race % 7 <> 0)"
PREDICTION_RESULTS = f"""{P}, {_PREDICTED_SQL} SELECT race, count(*) AS n, {", ".join(f"(max(CASE WHEN won = 1 THEN (rank <= {k})::INTEGER END))::BIGINT AS hit_{k}" for k in (1, 3, 5))}, {real_sql('avg(abs(rank - position))', 'rank_error')}, {real_sql('avg(-ln(CASE WHEN won = 1 THEN p ELSE 1 - p END + 1e-15))', 'log_loss')}, {real_sql('max(CASE WHEN rank = 1 THEN CASE WHEN won = 1 THEN odds - 1 ELSE -1 END END)', '"return"')} FROM m GROUP BY race"""


def worst_races(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 contests that the predictions missed most, by log loss."""
    return prediction_results(spark, sf).where("n > 1").orderBy(F.desc("log_loss"), "race").limit(20).select("race", "log_loss")


WORST_RACES = f"""SELECT race, log_loss FROM ({PREDICTION_RESULTS}) WHERE n > 1 ORDER BY log_loss DESC, race LIMIT 20"""


def bets_at_close(spark: SparkSession, sf: str) -> DataFrame:
    """Bets matched with closing odds above 1, by discipline: mean closing line value, share beaten, stakes and returns."""
    r = runners(spark, sf).withColumn("taken", (100 + F.col("gains") % 3700) / F.lit(100.0))
    bets = r.where("uid % 4 = 0").select("uid", "taken", "discipline", "won")
    closing = r.where("uid % 6 <> 0").select("uid", F.col("odds").alias("close"))
    x = bets.join(closing, "uid").where("close > 1 and taken > 1").withColumn("clv", scalars.clv_ratio(F.col("taken"), F.col("close")))
    sd = F.stddev_samp("clv")
    return x.groupBy("discipline").agg(integer(F.count(F.lit(1)), "n"), real(F.avg("clv"), "clv"), real(F.avg((F.col("clv") > 0).cast("int")), "beaten"), real(F.sum(F.col("won") * F.col("taken")) - F.count(F.lit(1)), "profit"), real(F.avg("clv") - 1.96 * sd / F.sqrt(F.count(F.lit(1))), "low"), real(F.avg("clv") + 1.96 * sd / F.sqrt(F.count(F.lit(1))), "high"))


BETS_AT_CLOSE = f"""{R}, x AS (SELECT *, (100 + gains % 3700) / 100.0 AS taken FROM r), m AS (SELECT *, taken::DOUBLE / odds - 1 AS clv FROM x WHERE uid % 4 = 0 AND uid % 6 <> 0 AND odds > 1 AND taken > 1)
SELECT discipline, count(*) AS n, {real_sql('avg(clv)', 'clv')}, {real_sql('avg((clv > 0)::INTEGER)', 'beaten')}, {real_sql('sum(won * taken) - count(*)', 'profit')}, {real_sql('avg(clv) - 1.96 * stddev_samp(clv) / sqrt(count(*))', 'low')}, {real_sql('avg(clv) + 1.96 * stddev_samp(clv) / sqrt(count(*))', 'high')} FROM m GROUP BY discipline"""


def merge_races(spark: SparkSession, sf: str) -> DataFrame:
    """Two race sources merged on customer and day: the first fills its holes from the second, identity columns are never taken, the source is named."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("cust"), F.to_date("o_orderdate").alias("day"), "o_orderpriority", "o_orderstatus")
    first = merge.newest(o.where("key % 3 <> 0"), ["cust", "day"], [F.col("key")]).select("cust", "day", "key", F.when(F.col("key") % 2 == 0, F.col("o_orderpriority")).alias("priority"), F.lit(None).cast("string").alias("status"))
    second = merge.newest(o.where("key % 4 <> 0"), ["cust", "day"], [F.desc("key")]).select("cust", "day", "key", F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    out = merge.fill_holes(first, second, ["cust", "day"], ["priority", "status"], identity=["key"], names=("a", "b"))
    return out.withColumn("day", F.col("day").cast("string"))


MERGE_RACES = """WITH o AS (SELECT o_orderkey AS key, o_custkey AS cust, o_orderdate::DATE AS day, o_orderpriority AS pr, o_orderstatus AS st FROM orders),
a AS (SELECT * FROM o WHERE key % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY cust, day ORDER BY key) = 1), b AS (SELECT * FROM o WHERE key % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY cust, day ORDER BY key DESC) = 1)
SELECT coalesce(a.cust, b.cust) AS cust, coalesce(a.day, b.day)::VARCHAR AS day, CASE WHEN a.key IS NOT NULL THEN a.key ELSE b.key END AS key, CASE WHEN a.key IS NULL THEN b.pr ELSE coalesce(CASE WHEN a.key % 2 = 0 THEN a.pr END, b.pr) END AS priority, b.st AS status, CASE WHEN b.key IS NULL THEN 'a' WHEN a.key IS NULL THEN 'b' ELSE 'a+b' END AS source FROM a FULL JOIN b ON a.cust = b.cust AND a.day = b.day"""


def merge_runners(spark: SparkSession, sf: str) -> DataFrame:
    """Two runner sources: match by number, else by race and draw, then the second's rows that neither key matched."""
    r = runners(spark, sf)
    first = r.where("uid % 3 <> 0").select("uid", "race", "draw", F.col("weight").alias("w1"))
    second = r.where("uid % 4 <> 0").select(F.when(F.col("uid") % 5 != 0, F.col("uid")).otherwise(-F.col("uid")).alias("uid"), "race", "draw", F.col("position").alias("p2"))
    out = merge.two_key_merge(first, second, ["uid"], ["race", "draw"], ["p2"], [F.col("uid")])
    return out.select("uid", "race", integer(F.col("draw"), "draw"), integer(F.col("w1"), "w1"), integer(F.col("p2"), "p2"), "matched")


MERGE_RUNNERS = f"""{R}, a AS (SELECT uid, race, draw, weight AS w1 FROM r WHERE uid % 3 <> 0), b AS (SELECT CASE WHEN uid % 5 <> 0 THEN uid ELSE -uid END AS uid, race, draw, position AS p2 FROM r WHERE uid % 4 <> 0),
k2 AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY race, draw ORDER BY uid) = 1),
m AS (SELECT a.uid, a.race, a.draw::BIGINT AS draw, w1::BIGINT AS w1, coalesce(b.p2, k2.p2)::BIGINT AS p2, CASE WHEN b.uid IS NOT NULL THEN 'first' WHEN k2.uid IS NOT NULL THEN 'second' ELSE 'none' END AS matched FROM a LEFT JOIN b ON a.uid = b.uid LEFT JOIN k2 ON a.race = k2.race AND a.draw = k2.draw)
SELECT * FROM m UNION ALL SELECT uid, race, draw::BIGINT, NULL, p2::BIGINT, 'only second' FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.uid = b.uid) AND NOT EXISTS (SELECT 1 FROM a WHERE a.race = b.race AND a.draw = b.draw)"""


def key_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Shared and own keys of each pair of sources, by one pass over the tagged union of their keys."""
    c, o, e = table(spark, sf, "customer").select(F.col("c_custkey").alias("key")), table(spark, sf, "orders").select(F.col("o_custkey").alias("key")), table(spark, sf, "events").select(F.col("user_id").alias("key"))
    return merge.key_overlap({"customer": c, "orders": o, "events": e}, "key")


KEY_OVERLAP = """WITH u AS (SELECT 'customer' AS s, c_custkey AS key FROM customer UNION SELECT 'orders', o_custkey FROM orders UNION SELECT 'events', user_id FROM events),
k AS (SELECT key, bool_or(s = 'customer') AS customer, bool_or(s = 'orders') AS orders, bool_or(s = 'events') AS events FROM u GROUP BY key)
""" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} AND {b}) AS shared, count(*) FILTER ({a} AND NOT {b}) AS only_a, count(*) FILTER ({b} AND NOT {a}) AS only_b, round(100.0 * count(*) FILTER ({a} AND {b}) / nullif(count(*) FILTER ({a} OR {b}), 0), 6) AS percent FROM k" for a, b in (("customer", "orders"), ("customer", "events"), ("orders", "events")))


def clean_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaner by kind of field with the number of changes it made to each."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")).alias("name"), F.when(F.col("p_partkey") % 5 == 0, "N/A").otherwise(F.col("p_brand")).alias("brand"), F.concat(F.col("p_size").cast("string"), F.lit(" kg")).alias("weight"))
    out = cleaning.clean(p, {"name": "name", "brand": "text", "weight": "number"})
    return out.select("id", "name", "brand", integer(F.col("weight"), "weight"), integer(F.col("changes"), "changes"))


CLEAN_FIELDS = """WITH p AS (SELECT p_partkey AS id, ' ' || p_name || '  ' AS n0, CASE WHEN p_partkey % 5 = 0 THEN 'N/A' ELSE p_brand END AS b0, p_size || ' kg' AS w0 FROM part),
c AS (SELECT *, trim(regexp_replace(upper(n0), '[^A-Z0-9]+', ' ', 'g')) AS name, CASE WHEN b0 <> 'N/A' THEN b0 END AS brand, regexp_extract(w0, '[0-9]+')::BIGINT AS weight FROM p)
SELECT id, name, brand, weight, ((name IS DISTINCT FROM n0)::INTEGER + (brand IS DISTINCT FROM b0)::INTEGER + (weight::VARCHAR IS DISTINCT FROM w0)::INTEGER)::BIGINT AS changes FROM c"""

_GAPS = {"weight": "uid % 3 = 0", "distance": "uid % 7 = 0", "equipment": "uid % 5 = 0"}


def gap_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A cascade of fill rules where later ones see earlier fills: surface by discipline, distance by discipline, weight from base and surcharge, time from reduction and distance."""
    r = runners(spark, sf).select("uid", "discipline", *(F.when(~F.expr(c), F.col(f)).alias(f) for f, c in _GAPS.items()), F.when(F.expr("uid % 4 <> 0"), F.col("draw")).alias("base"), F.when(F.expr("uid % 8 <> 0"), F.col("won")).alias("extra"), F.when(F.expr("uid % 2 = 0"), F.col("gains") % 90000).alias("red"))
    rules = [("equipment", F.when(F.col("discipline") == "A", "F").when(F.col("discipline") == "N", "O")), ("distance", F.when(F.col("discipline") == "A", 2700).when(F.col("discipline") == "N", 1600)), ("weight", F.col("base") + F.coalesce("extra", F.lit(0))), ("time", F.floor(F.col("red") * F.col("distance") / 1000))]
    out = cleaning.fill_cascade(r.withColumn("time", F.lit(None).cast("long")), rules)
    return out.select("uid", "equipment", *(integer(F.col(c), c) for c in ("distance", "weight", "time", "fills")))


GAP_RULES = f"""{R}, x AS (SELECT uid, discipline, {", ".join(f"CASE WHEN NOT ({c}) THEN {f} END AS {f}" for f, c in _GAPS.items())}, CASE WHEN uid % 4 <> 0 THEN draw END AS base, CASE WHEN uid % 8 <> 0 THEN won END AS extra, CASE WHEN uid % 2 = 0 THEN gains % 90000 END AS red FROM r),
y AS (SELECT *, coalesce(equipment, CASE discipline WHEN 'A' THEN 'F' WHEN 'N' THEN 'O' END) AS e, coalesce(distance, CASE discipline WHEN 'A' THEN 2700 WHEN 'N' THEN 1600 END) AS d, coalesce(weight, base + coalesce(extra, 0)) AS w FROM x), z AS (SELECT *, floor(red * d / 1000)::BIGINT AS t FROM y)
SELECT uid, e AS equipment, d::BIGINT AS distance, w::BIGINT AS weight, t AS time, ((equipment IS NULL AND e IS NOT NULL)::INTEGER + (distance IS NULL AND d IS NOT NULL)::INTEGER + (weight IS NULL AND w IS NOT NULL)::INTEGER + (t IS NOT NULL)::INTEGER)::BIGINT AS fills FROM z"""


def impute_strategies(spark: SparkSession, sf: str) -> DataFrame:
    """One column with holes filled by nine strategies: mean, median, mode, zero, constant, forward, backward, group median, and the rows that dropping would keep."""
    r = runners(spark, sf).withColumn("w", F.when(F.col("uid") % 3 != 0, F.col("weight").cast("double")))
    out = cleaning.imputed(r, "w", group="discipline", entity="horse", order=["day", "race", "no"], constant=-1.0)
    return out.select("uid", *(real(F.col(f"w_{s}"), f"w_{s}") for s in cleaning.STRATEGIES), integer(F.col("w").isNotNull().cast("int"), "w_kept"))


IMPUTE_STRATEGIES = f"""{R}, x AS (SELECT *, CASE WHEN uid % 3 <> 0 THEN weight::DOUBLE END AS w FROM r), a AS (SELECT avg(w) AS mean, median(w) AS med FROM x), m AS (SELECT w AS mode FROM x WHERE w IS NOT NULL GROUP BY w ORDER BY count(*) DESC, w LIMIT 1), g AS (SELECT discipline, median(w) AS gm FROM x GROUP BY 1)
SELECT uid, {real_sql('coalesce(w, mean)', 'w_mean')}, {real_sql('coalesce(w, med)', 'w_median')}, {real_sql('coalesce(w, mode)', 'w_mode')}, {real_sql('coalesce(w, 0)', 'w_zero')}, {real_sql('coalesce(w, -1)', 'w_constant')}, {real_sql('coalesce(w, last_value(w IGNORE NULLS) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))', 'w_forward')}, {real_sql('coalesce(w, first_value(w IGNORE NULLS) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))', 'w_backward')}, {real_sql('coalesce(w, gm)', 'w_group_median')}, (w IS NOT NULL)::BIGINT AS w_kept
FROM x JOIN g USING (discipline), a, m WINDOW o AS (PARTITION BY horse ORDER BY day, race, no)"""


def outlier_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Values beyond the quartile fences clipped, nulled, flagged, and kept or not; z-scores beyond 1.5 flagged."""
    r = runners(spark, sf).withColumn("x", F.col("distance").cast("double"))
    out = cleaning.fenced(r, "x", times=0.3)
    return out.select("uid", real(F.col("x_clipped"), "x_clipped"), real(F.col("x_nulled"), "x_nulled"), integer(F.col("x_outlier").cast("int"), "x_outlier"), integer((F.abs(F.col("x_z")) > 1.5).cast("int"), "x_far"))


OUTLIER_ACTIONS = f"""{R}, b AS (SELECT quantile_cont(distance, 0.25) AS q1, quantile_cont(distance, 0.75) AS q3, avg(distance) AS m, stddev_samp(distance) AS s FROM r), f AS (SELECT *, q1 - 0.3 * (q3 - q1) AS lo, q3 + 0.3 * (q3 - q1) AS hi FROM b)
SELECT uid, {real_sql('greatest(lo, least(hi, distance))', 'x_clipped')}, {real_sql('CASE WHEN distance BETWEEN lo AND hi THEN distance END', 'x_nulled')}, (distance NOT BETWEEN lo AND hi)::BIGINT AS x_outlier, (abs((distance - m) / s) > 1.5)::BIGINT AS x_far FROM r, f"""


def scaled_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A column by standard, min-max and robust scaling, and back."""
    out = cleaning.scaled(runners(spark, sf).withColumn("x", F.col("distance").cast("double")), "x")
    return out.select("uid", *(real(F.col(f"x_{k}"), f"x_{k}") for k in ("standard", "minmax", "robust")), real(F.col("x_back"), "x_back"))


SCALED_COLUMNS = f"""{R}, b AS (SELECT avg(distance) AS m, stddev_pop(distance) AS s, min(distance) AS lo, max(distance) AS hi, median(distance) AS med, quantile_cont(distance, 0.75) - quantile_cont(distance, 0.25) AS iqr FROM r)
SELECT uid, {real_sql('(distance - m) / s', 'x_standard')}, {real_sql('(distance - lo) / (hi - lo)', 'x_minmax')}, {real_sql('(distance - med) / iqr', 'x_robust')}, {real_sql('distance', 'x_back')} FROM r, b"""


def harville_unordered(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets of three of each contest's four likeliest runners in any order: probability over all orders, expected value at a payout of 50, best first."""
    p = _predicted(spark, sf).withColumn("k", race.positional_rank(F.desc("p"), "no")).where("k <= 4 and fs >= 3")
    own = p.groupBy("race").agg(F.sort_array(F.collect_list(F.struct("k", "uid", "p"))).alias("l"))
    combos = F.array(*(F.array(*map(F.lit, c)) for c in ((0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3))))
    picks = own.select("race", "l", F.explode(combos).alias("c")).where("array_max(c) < size(l)")
    at = lambda i: F.get("l", F.get("c", F.lit(i)))["p"]
    orders = ((0, 1, 2), (0, 2, 1), (1, 0, 2), (1, 2, 0), (2, 0, 1), (2, 1, 0))
    # a field of three is certain to fill the places in some order: the mass left for the last is all of it
    one = lambda a, b, c: at(a) * F.try_divide(at(b), 1 - at(a)) * F.coalesce(F.try_divide(at(c), F.greatest(1 - at(a) - at(b), at(c))), F.lit(0.0))
    chance = sum((one(*o) for o in orders), F.lit(0.0))
    ticket = F.array_join(F.transform("c", lambda i: F.get("l", i)["uid"].cast("string")), "-")
    ranked = picks.select("race", ticket.alias("ticket"), chance.alias("chance"))
    w = Window.partitionBy("race").orderBy(F.desc(F.round("chance", 9)), "ticket")
    return ranked.select("race", "ticket", real(F.col("chance"), "chance"), real(F.col("chance") * 50 - 1, "value"), integer(F.row_number().over(w), "place")).where("place <= 3")


_PERMS = " + ".join(f"p{a} * p{b} / (1 - p{a}) * p{c} / greatest(1 - p{a} - p{b}, p{c})" for a, b, c in (("a", "b", "c"), ("a", "c", "b"), ("b", "a", "c"), ("b", "c", "a"), ("c", "a", "b"), ("c", "b", "a")))
HARVILLE_UNORDERED = f"""{P}, k AS (SELECT *, row_number() OVER (PARTITION BY race ORDER BY p DESC, no) AS k FROM pr WHERE fs >= 3 QUALIFY k <= 4),
t AS (SELECT a.race, a.uid || '-' || b.uid || '-' || c.uid AS ticket, a.p AS pa, b.p AS pb, c.p AS pc FROM k AS a JOIN k AS b ON a.race = b.race AND a.k < b.k JOIN k AS c ON b.race = c.race AND b.k < c.k), v AS (SELECT race, ticket, {_PERMS} AS chance FROM t)
SELECT race, ticket, {real_sql('chance', 'chance')}, {real_sql('chance * 50 - 1', 'value')}, row_number() OVER (PARTITION BY race ORDER BY round(chance, 9) DESC, ticket) AS place FROM v QUALIFY place <= 3"""


def outsiders(spark: SparkSession, sf: str) -> DataFrame:
    """Runners whose model probability is 1.5 times the market's or more at odds of 5 to 100, with a credibility score of its factors."""
    p = _predicted(spark, sf)
    model = F.col("gains") / F.sum("gains").over(race.field())
    w = Window.partitionBy("horse").orderBy("day", "race", "no")
    p = p.withColumns({"model": model, "before": F.lag("equipment").over(w), "gone": F.lag("distance").over(w), "rate5": F.avg("won").over(w.rowsBetween(-5, -1)), "lead": F.lag("position", 1).over(w) - F.lag("position", 2).over(w)})
    ratio = F.col("model") * F.col("odds")
    score = F.when(F.col("lead") < 0, 30).when(F.col("lead") == 0, 15).otherwise(0) + F.when(F.col("before") != F.col("equipment"), 15).otherwise(0) + F.when(F.abs(F.col("distance") - F.col("gone")) <= 100, 20).when(F.abs(F.col("distance") - F.col("gone")) <= 300, 10).otherwise(0) + F.when(F.col("rate5") >= 0.2, 10).when(F.col("rate5") >= 0.1, 5).otherwise(0)
    return p.where(F.col("odds").between(5, 100) & (ratio >= 1.5)).select("uid", real(ratio, "ratio"), real(ratio - 1, "value"), real(F.col("model") - 1 / F.col("odds"), "edge"), integer(score, "score"), real(score / 75 * 100, "credibility"))


OUTSIDERS = f"""{P}, x AS (SELECT *, gains / sum(gains) OVER (PARTITION BY race) AS model, lag(equipment) OVER w AS before, lag(distance) OVER w AS gone, avg(won) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS rate5, lag(position, 1) OVER w - lag(position, 2) OVER w AS lead FROM pr WINDOW w AS (PARTITION BY horse ORDER BY day, race, no)),
s AS (SELECT *, CASE WHEN lead < 0 THEN 30 WHEN lead = 0 THEN 15 ELSE 0 END + CASE WHEN before <> equipment THEN 15 ELSE 0 END + CASE WHEN abs(distance - gone) <= 100 THEN 20 WHEN abs(distance - gone) <= 300 THEN 10 ELSE 0 END + CASE WHEN rate5 >= 0.2 THEN 10 WHEN rate5 >= 0.1 THEN 5 ELSE 0 END AS score FROM x)
SELECT uid, {real_sql('model * odds', 'ratio')}, {real_sql('model * odds - 1', 'value')}, {real_sql('model - 1.0::DOUBLE / odds', 'edge')}, score::BIGINT AS score, {real_sql('score / 75 * 100', 'credibility')} FROM s WHERE odds BETWEEN 5 AND 100 AND model * odds >= 1.5"""


def training_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Training labels: winner, placed, not finished, return at final odds, place return at a third of the odds, value label."""
    r = runners(spark, sf).withColumns({"n": F.count(F.lit(1)).over(race.field()), "dnf": F.col("draw") == 7})
    value = F.when((F.col("placed") == 1), F.col("odds") > F.col("n")).otherwise(F.lit(False))
    return r.select("uid", "won", "placed", integer(F.col("dnf").cast("int"), "dnf"), real(F.when(F.col("won") == 1, F.col("odds") - 1).otherwise(-1.0), "roi"), real(F.when(F.col("placed") == 1, F.col("odds") / 3 - 1).otherwise(-1.0), "roi_place"), integer(value.cast("int"), "value"))


TRAINING_LABELS = f"""{R}, x AS (SELECT *, count(*) OVER (PARTITION BY race) AS n FROM r) SELECT uid, won, placed, (draw = 7)::BIGINT AS dnf, {real_sql('CASE WHEN won = 1 THEN odds - 1 ELSE -1 END', 'roi')}, {real_sql('CASE WHEN placed = 1 THEN odds::DOUBLE / 3 - 1 ELSE -1 END', 'roi_place')}, (placed = 1 AND odds > n)::BIGINT AS value FROM x"""


def value_table(spark: SparkSession, sf: str) -> DataFrame:
    """Expected value of a win bet from the model's probability, and again with the favourite excluded from the field."""
    p = _predicted(spark, sf)
    model = F.col("gains") / F.sum("gains").over(race.field())
    p = p.withColumns({"model": model, "fav": race.positional_rank(F.col("odds"), "no") == 1})
    rest = F.sum(F.when(~F.col("fav"), F.col("model"))).over(race.field())
    without = F.when(~F.col("fav"), F.col("model") / rest)
    return p.select("uid", real(F.col("model") * F.col("odds") - 1, "value"), real(without, "without_favourite"), real(without * F.col("odds") - 1, "value_without"))


VALUE_TABLE = f"""{P}, x AS (SELECT *, gains / sum(gains) OVER (PARTITION BY race) AS model, row_number() OVER (PARTITION BY race ORDER BY odds, no) = 1 AS fav FROM pr), y AS (SELECT *, CASE WHEN NOT fav THEN model / sum(CASE WHEN NOT fav THEN model END) OVER (PARTITION BY race) END AS wo FROM x)
SELECT uid, {real_sql('model * odds - 1', 'value')}, {real_sql('wo', 'without_favourite')}, {real_sql('wo * odds - 1', 'value_without')} FROM y"""


def returns_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """Flat stakes on long odds by day, week, month and discipline: bets, hits, return, ratio of mean to deviation, z against none."""
    r = runners(spark, sf).where("odds >= 20").withColumn("pl", F.when(F.col("won") == 1, F.col("odds") - 1).otherwise(-1.0))
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), F.col("race_date")).cast("string"), F.lit("-W"), F.lpad(F.weekofyear("race_date").cast("string"), 2, "0"))
    keys = {"day": F.col("race_date").cast("string"), "week": week, "month": F.date_format("race_date", "yyyy-MM"), "discipline": F.col("discipline")}
    long = r.select("pl", "won", F.explode(F.array(*(F.struct(F.lit(k).alias("by"), v.alias("period")) for k, v in keys.items()))).alias("x")).select("pl", "won", "x.*")
    sd = F.stddev_samp("pl")
    return long.groupBy("by", "period").agg(integer(F.count(F.lit(1)), "bets"), integer(F.sum("won"), "hits"), real(F.avg("pl"), "roi"), real(F.when(sd > 0, F.avg("pl") / sd), "sharpe"), real(F.when(sd > 0, F.avg("pl") / sd * F.sqrt(F.count(F.lit(1)))), "z"))


RETURNS_BY_PERIOD = f"""{R}, b AS (SELECT *, (CASE WHEN won = 1 THEN odds - 1 ELSE -1 END)::DOUBLE AS pl FROM r WHERE odds >= 20),
l AS (SELECT 'day' AS "by", race_date::VARCHAR AS period, pl, won FROM b UNION ALL SELECT 'week', isoyear(race_date) || '-W' || lpad(weekofyear(race_date)::VARCHAR, 2, '0'), pl, won FROM b UNION ALL SELECT 'month', strftime(race_date, '%Y-%m'), pl, won FROM b UNION ALL SELECT 'discipline', discipline, pl, won FROM b)
SELECT "by", period, count(*) AS bets, sum(won)::BIGINT AS hits, {real_sql('avg(pl)', 'roi')}, {real_sql('CASE WHEN stddev_samp(pl) > 0 THEN avg(pl) / stddev_samp(pl) END', 'sharpe')}, {real_sql('CASE WHEN stddev_samp(pl) > 0 THEN avg(pl) / stddev_samp(pl) * sqrt(count(*)) END', 'z')} FROM l GROUP BY 1, 2"""


def segment_decay(spark: SparkSession, sf: str) -> DataFrame:
    """Log loss, hit rate and return of each segment in its last year against before, with a verdict; calibration error over five stretches of days."""
    p = _predicted(spark, sf).withColumn("first", (race.positional_rank(F.desc("p"), "no") == 1).cast("int"))
    loss = -F.ln(F.when(F.col("won") == 1, F.col("p")).otherwise(1 - F.col("p")) + 1e-15)
    p = p.withColumns({"late": F.col("day") > 2000, "loss": loss, "hit": F.when(F.col("first") == 1, F.col("won"))})
    long = p.select("late", "loss", "hit", F.explode(F.array(*(F.struct(F.lit(k).alias("segment"), v.cast("string").alias("value")) for k, v in (("all", F.lit("all")), ("discipline", F.col("discipline")), ("draw", F.col("draw")))))).alias("x")).select("late", "loss", "hit", "x.*")
    m = lambda c, late: F.avg(F.when(F.col("late") == late, F.col(c)))
    change = m("loss", True) / m("loss", False) - 1
    verdict = F.when(change > 0.10, "severe").when(change > 0.03, "moderate").when(change > 0.01, "mild").otherwise("none")
    return long.groupBy("segment", "value").agg(integer(F.count_if("late"), "n_late"), real(m("loss", False), "loss_before"), real(m("loss", True), "loss_late"), real(m("hit", False), "hit_before"), real(m("hit", True), "hit_late"), verdict.alias("verdict"))


SEGMENT_DECAY = f"""{P}, x AS (SELECT *, day > 2000 AS late, -ln(CASE WHEN won = 1 THEN p ELSE 1 - p END + 1e-15) AS loss, CASE WHEN row_number() OVER (PARTITION BY race ORDER BY p DESC, no) = 1 THEN won END AS hit FROM pr),
l AS (SELECT 'all' AS segment, 'all' AS value, late, loss, hit FROM x UNION ALL SELECT 'discipline', discipline, late, loss, hit FROM x UNION ALL SELECT 'draw', draw::VARCHAR, late, loss, hit FROM x),
g AS (SELECT segment, value, count(*) FILTER (late) AS n_late, avg(loss) FILTER (NOT late) AS lb, avg(loss) FILTER (late) AS ll, avg(hit) FILTER (NOT late) AS hb, avg(hit) FILTER (late) AS hl FROM l GROUP BY 1, 2)
SELECT segment, value, n_late, {real_sql('lb', 'loss_before')}, {real_sql('ll', 'loss_late')}, {real_sql('hb', 'hit_before')}, {real_sql('hl', 'hit_late')}, CASE WHEN ll / lb - 1 > 0.10 THEN 'severe' WHEN ll / lb - 1 > 0.03 THEN 'moderate' WHEN ll / lb - 1 > 0.01 THEN 'mild' ELSE 'none' END AS verdict FROM g"""


def calibration_by_stretch(spark: SparkSession, sf: str) -> DataFrame:
    """Expected calibration error over five stretches of equal days: bins of a tenth, added up before anything is compared."""
    p = _predicted(spark, sf).withColumns({"stretch": F.least(F.floor(F.col("day") / 500), F.lit(4)), "bin": F.least(F.floor(F.col("p") * 10), F.lit(9))})
    bins = p.groupBy("stretch", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("p"), F.sum("won").alias("w"))
    return bins.groupBy("stretch").agg(integer(F.sum("n"), "n"), real(F.sum(F.abs(F.col("p") - F.col("w"))) / F.sum("n"), "ece"), real(F.max(F.abs(F.col("p") - F.col("w")) / F.col("n")), "mce"))


CALIBRATION_BY_STRETCH = f"""{P}, b AS (SELECT least(day // 500, 4) AS stretch, least(floor(p * 10), 9) AS bin, count(*) AS n, sum(p) AS sp, sum(won) AS w FROM pr GROUP BY 1, 2) SELECT stretch, sum(n)::BIGINT AS n, {real_sql('sum(abs(sp - w)) / sum(n)', 'ece')}, {real_sql('max(abs(sp - w) / n)', 'mce')} FROM b GROUP BY stretch"""

_NAMES = ("field_ranks", "field_statistics", "market_moves", "weather_and_class", "speed_figures", "trainer_table", "completeness_cube", "reservoir", "category_drift", "batch_quality", "label_distribution", "three_key_match", "prediction_results", "worst_races", "bets_at_close", "merge_races", "merge_runners", "key_overlap", "clean_fields", "gap_rules", "impute_strategies", "outlier_actions", "scaled_columns", "harville_unordered", "outsiders", "training_labels", "value_table", "returns_by_period", "segment_decay", "calibration_by_stretch")
QUERIES = {n: globals()[n] for n in _NAMES}
ORACLES = {n: globals()[n.upper()] for n in _NAMES}
