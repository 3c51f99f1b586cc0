"""Queries for models, integrity checks and the remaining joins, with SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.operators import models, quality, race
from paceline.sources.tables import EVENTS_SQL, RUNNERS_SQL, TRACKS_SQL, events, runners, table, with_tracks

R, RT, E = f"WITH {RUNNERS_SQL}", f"WITH {TRACKS_SQL}", f"WITH {EVENTS_SQL}"
FEATURES = ["odds", "distance", "weight", "draw"]


def _model(kind: str, spark: SparkSession, sf: str) -> DataFrame:
    train, _, test = models.by_time(runners(spark, sf).select("uid", "day", "won", *FEATURES), "day")
    return models.scored(models.fitted(train, FEATURES, "won", kind), test, FEATURES).select("uid", F.round("score", 6).alias("score"), "won")


def model_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the last days by a logistic regression of the first."""
    return _model("logistic", spark, sf)


def model_forest(spark: SparkSession, sf: str) -> DataFrame:
    """The same by a random forest."""
    return _model("forest", spark, sf)


def model_boosted(spark: SparkSession, sf: str) -> DataFrame:
    """The same by boosted trees."""
    return _model("boosted", spark, sf)


def model_report(spark: SparkSession, sf: str) -> DataFrame:
    """Log loss and AUC of the logistic scores, raw and under three calibrators fitted on the validation days."""
    train, valid, test = models.by_time(runners(spark, sf).select("uid", "day", "won", *FEATURES), "day")
    m = models.fitted(train, FEATURES, "won", "logistic")
    v, t = models.scored(m, valid, FEATURES), models.scored(m, test, FEATURES)
    sets = {"raw": t.withColumn("calibrated", F.col("score")), "platt": models.platt(v, t, "score", "won"), "temperature": models.temperature(v, t, "score", "won"), "isotonic": models.isotonic(v, t.withColumn("won", F.col("won").cast("double")), "score", "won")}
    parts = [quality.log_loss_and_auc(d.withColumn("won", F.col("won").cast("int")), "calibrated", "won").withColumn("calibrator", F.lit(k)) for k, d in sets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def feature_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Votes for features: variance, correlation with the label, no repetition of an earlier feature."""
    return models.votes(runners(spark, sf).withColumns({"twice": F.col("weight") * 2, "fixed": F.lit(1)}), ["weight", "twice", "fixed", "gains", "odds"], "won")


VOTES = f"""{R}, x AS (SELECT *, weight * 2 AS twice, 1 AS fixed FROM r), f AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, (var_pop({f}) > 0)::INTEGER AS varies, (CASE WHEN var_pop({f}) > 0 THEN abs(corr({f}, won)) >= 0.01 ELSE false END)::INTEGER AS goes_with_label, ({' AND '.join([f'(CASE WHEN var_pop({g}) > 0 AND var_pop({f}) > 0 THEN abs(corr({g}, {f})) <= 0.95 ELSE true END)' for g in before] or ['true'])})::INTEGER AS is_new FROM x" for f, before in (("weight", []), ("twice", ["weight"]), ("fixed", ["weight", "twice"]), ("gains", ["weight", "twice", "fixed"]), ("odds", ["weight", "twice", "fixed", "gains"])))})
SELECT *, varies + goes_with_label + is_new AS votes FROM f"""


def model_per_context(spark: SparkSession, sf: str) -> DataFrame:
    """Model with the least squared error in each draw, with a fallback for draws of few rows."""
    r = runners(spark, sf).withColumn("fs", F.count(F.lit(1)).over(race.field()))
    guesses = F.explode(F.array(F.struct(F.lit("even").alias("model"), (1 / F.col("fs")).alias("p")), F.struct(F.lit("coin").alias("model"), F.lit(0.5).alias("p"))))
    d = r.select("draw", "won", guesses.alias("g")).select("draw", "g.model", F.pow(F.col("g.p") - F.col("won"), 2).alias("loss"))
    return models.best_per_context(d, "draw", "model", "loss", least=200)


CONTEXT = f"""{R}, f AS (SELECT draw, won, 1 / count(*) OVER (PARTITION BY race) AS e FROM r), d AS (SELECT draw, 'even' AS model, (e - won) ** 2 AS loss FROM f UNION ALL SELECT draw, 'coin', (0.5 - won) ** 2 FROM f),
o AS (SELECT model FROM d GROUP BY model ORDER BY avg(loss), model LIMIT 1), g AS (SELECT draw, model, avg(loss) AS l FROM d GROUP BY draw, model HAVING count(*) >= 200), b AS (SELECT draw, arg_min(model, l) AS own FROM g GROUP BY draw)
SELECT x.draw, coalesce(own, o.model) AS model, own IS NULL AS is_fallback FROM (SELECT DISTINCT draw FROM d) AS x LEFT JOIN b ON x.draw = b.draw, o"""


def nearest_going(spark: SparkSession, sf: str) -> DataFrame:
    """For each order, the same customer's nearest urgent order within thirty days, the earlier on ties."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("race"), F.col("o_custkey").alias("cust"), F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01")).alias("day"), "o_orderpriority")
    urgent = o.where("o_orderpriority = '1-URGENT'").select("cust", "day", F.col("race").alias("found"))
    return models.nearest(o.where("o_orderpriority <> '1-URGENT'").select("race", "cust", "day"), urgent, ["cust"], "day", 30, ["found"], "race").select("race", "found", F.col("days_apart").cast("long").alias("days_apart"))


NEAREST = """WITH o AS (SELECT o_orderkey AS race, o_custkey AS cust, date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS day, o_orderpriority AS p FROM orders)
SELECT a.race, b.race AS found, abs(a.day - b.day) AS days_apart FROM o AS a LEFT JOIN o AS b ON a.cust = b.cust AND b.p = '1-URGENT' AND abs(a.day - b.day) <= 30 WHERE a.p <> '1-URGENT'
QUALIFY row_number() OVER (PARTITION BY a.race ORDER BY abs(a.day - b.day), b.day, b.race) = 1"""


def integrity(spark: SparkSession, sf: str) -> DataFrame:
    """Integrity anomalies: contests without entrants, entrants without contests, keys used twice, gaps in the calendar."""
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    empty = o.join(li, o["o_orderkey"] == li["l_orderkey"], "left_anti")
    lost = li.join(o, o["o_orderkey"] == li["l_orderkey"], "left_anti")
    twice = li.groupBy("l_orderkey", "l_linenumber").count().where("count > 1")
    days = o.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    gaps = days.withColumn("gap", F.datediff("d", F.lag("d").over(Window.orderBy("d")))).where("gap > 1")
    one = lambda name, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("anomaly"), "n")
    return one("contest_without_entrants", empty).union(one("entrant_without_contest", lost)).union(one("key_used_twice", twice)).union(one("calendar_gap", gaps))


INTEGRITY = """SELECT 'contest_without_entrants' AS anomaly, count(*) AS n FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey UNION ALL SELECT 'entrant_without_contest', count(*) FROM lineitem ANTI JOIN orders ON o_orderkey = l_orderkey
UNION ALL SELECT 'key_used_twice', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'calendar_gap', count(*) FROM (SELECT d - lag(d) OVER (ORDER BY d) AS gap FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)) WHERE gap > 1"""


def draw_bias(spark: SparkSession, sf: str) -> DataFrame:
    """Runs and wins of each draw of a track against an even share of the field and against one over the draw."""
    r = with_tracks(runners(spark, sf), spark, sf).withColumn("share", 1 / F.count(F.lit(1)).over(race.field()))
    g = r.groupBy("track", "draw").agg(F.count(F.lit(1)).alias("runs"), F.sum("won").alias("wins"), F.sum("share").alias("expected"))
    return g.select("track", "draw", "runs", "wins", F.round(F.col("wins") / F.col("expected"), 6).alias("ratio"), F.round(F.col("wins") / F.col("runs") * F.col("draw"), 6).alias("ratio_by_draw"))


DRAW_BIAS = f"""{RT}, s AS (SELECT *, 1 / count(*) OVER (PARTITION BY race) AS share FROM rt) SELECT track, draw, count(*) AS runs, sum(won)::BIGINT AS wins, round(sum(won) / sum(share), 6) AS ratio, round(sum(won) / count(*) * draw, 6) AS ratio_by_draw FROM s GROUP BY track, draw"""


def weather_join(spark: SparkSession, sf: str) -> DataFrame:
    """Contests with the day's weather (events of that day of month), field by field from two sources in turn."""
    e = events(spark, sf).withColumn("dom", F.dayofmonth("ts"))
    first = e.where("kind = 'view' and k < 60").groupBy("dom").agg(F.max("k").alias("temp"), F.count(F.lit(1)).alias("n_first"))
    second = e.groupBy("dom").agg(F.min("k").alias("temp2"), F.sum("k").alias("rain"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("race"), F.dayofmonth("o_orderdate").alias("dom"))
    out = o.join(first, "dom", "left").join(second, "dom", "left")
    return out.select("race", F.coalesce("temp", "temp2").alias("temp"), "rain", F.when(F.col("temp").isNotNull(), "first").when(F.col("temp2").isNotNull(), "second").otherwise("none").alias("source"))


WEATHER = f"""{E}, a AS (SELECT day(ts) AS dom, max(k) AS temp FROM e WHERE kind = 'view' AND k < 60 GROUP BY 1), b AS (SELECT day(ts) AS dom, min(k) AS temp2, sum(k)::BIGINT AS rain FROM e GROUP BY 1)
SELECT o_orderkey AS race, coalesce(temp, temp2) AS temp, rain, CASE WHEN temp IS NOT NULL THEN 'first' WHEN temp2 IS NOT NULL THEN 'second' ELSE 'none' END AS source FROM orders LEFT JOIN a ON day(o_orderdate) = a.dom LEFT JOIN b ON day(o_orderdate) = b.dom"""


def rolling_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Rolling mean of 50 events against the first half of each kind, with warning and critical bands."""
    e = events(spark, sf)
    w, all_ = Window.partitionBy("kind").orderBy("ts").rowsBetween(-49, 0), Window.partitionBy("kind")
    rn, n = F.row_number().over(Window.partitionBy("kind").orderBy("ts")), F.count(F.lit(1)).over(all_)
    x = e.withColumns({"rn": rn, "n": n, "roll": F.avg("k").over(w)})
    early = F.when(F.col("rn") <= F.col("n") / 2, F.col("k"))
    x = x.withColumns({"mean": F.avg(early).over(all_), "sd": F.stddev_samp(early).over(all_)}).where("rn >= 50")
    z = F.abs(F.col("roll") - F.col("mean")) / (F.col("sd") / F.sqrt(F.lit(50.0)))
    return x.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(z > 2).alias("warnings"), F.count_if(z > 3).alias("critical"), F.round(F.max(z), 5).alias("worst"))


DRIFT = f"""{E}, x AS (SELECT kind, k, row_number() OVER (PARTITION BY kind ORDER BY ts) AS rn, count(*) OVER (PARTITION BY kind) AS n, avg(k) OVER (PARTITION BY kind ORDER BY ts ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS roll FROM e),
y AS (SELECT *, avg(CASE WHEN rn <= n / 2 THEN k END) OVER (PARTITION BY kind) AS m, stddev_samp(CASE WHEN rn <= n / 2 THEN k END) OVER (PARTITION BY kind) AS s FROM x), z AS (SELECT kind, abs(roll - m) / (s / sqrt(50.0)) AS z FROM y WHERE rn >= 50)
SELECT kind, count(*) AS n, count(*) FILTER (z > 2) AS warnings, count(*) FILTER (z > 3) AS critical, round(max(z), 5) AS worst FROM z GROUP BY kind"""

_ALL = {model_logistic: None, model_forest: None, model_boosted: None, model_report: None, feature_votes: VOTES, model_per_context: CONTEXT, nearest_going: NEAREST, integrity: INTEGRITY, draw_bias: DRAW_BIAS, weather_join: WEATHER, rolling_drift: DRIFT}
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {f.__name__: sql for f, sql in _ALL.items() if sql}
