"""Queries for labels, splits, quality, drift, stakes and text, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.functions import scalars
from paceline.operators import betting, quality, race, sequences
from paceline.sources.tables import EVENTS_SQL, RUNNERS_SQL, events, runners, table

R, E = f"WITH {RUNNERS_SQL}", f"WITH {EVENTS_SQL}"
P = f"{R}, pr AS (SELECT *, (1.0 / odds)::DOUBLE / sum((1.0 / odds)::DOUBLE) OVER (PARTITION BY race) AS p, count(*) OVER (PARTITION BY race) AS fs FROM r)"


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    return runners(spark, sf).withColumns(race.implied_probability("odds")).withColumn("p", F.col("probability")).withColumn("fs", F.count(F.lit(1)).over(race.field()))


def r6(c: str) -> Column:
    return (F.round(c, 6) + F.lit(0.0)).alias(c)


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """Training labels: won, top 3 and 5, normalised rank, flat-stake returns, surprise, favourite won."""
    r = race.market(runners(spark, sf))
    w = race.field()
    return r.select("uid", F.col("won").alias("y_won"), F.col("placed").alias("y_top3"), (F.col("position") <= 5).cast("int").alias("y_top5"), F.round(F.when(F.col("field_size") > 1, (F.col("position") - 1) / (F.col("field_size") - 1)), 6).alias("y_rank"), F.round(F.when(F.col("won") == 1, F.col("odds") - 1).otherwise(-1.0), 2).alias("y_roi"), ((F.col("won") == 1) & (F.col("odds") >= 10)).cast("int").alias("y_surprise"), F.max(F.col("favourite") * F.col("won")).over(w).alias("y_favourite_won"))


LABELS = f"""{R}, m AS (SELECT *, count(*) OVER (PARTITION BY race) AS fs, (row_number() OVER (PARTITION BY race ORDER BY odds, no) = 1)::INTEGER AS fav FROM r)
SELECT uid, won AS y_won, placed AS y_top3, (position <= 5)::INTEGER AS y_top5, round(CASE WHEN fs > 1 THEN (position - 1) / (fs - 1) END, 6) AS y_rank, round(CASE WHEN won = 1 THEN odds - 1 ELSE -1 END, 2)::DOUBLE AS y_roi, (won = 1 AND odds >= 10)::INTEGER AS y_surprise, max(fav * won) OVER (PARTITION BY race) AS y_favourite_won FROM m"""


def temporal_split(spark: SparkSession, sf: str) -> DataFrame:
    """Train, validation and test by whole days at 70 and 85 per cent of them, a week purged before each cut."""
    r = runners(spark, sf)
    days = r.select("day").distinct().withColumn("at", F.percent_rank().over(Window.orderBy("day")))
    cut = days.agg(F.min(F.when(F.col("at") >= 0.7, F.col("day"))).alias("a"), F.min(F.when(F.col("at") >= 0.85, F.col("day"))).alias("b"))
    x = r.crossJoin(F.broadcast(cut))
    part = F.when(F.col("day") >= F.col("b"), "test").when(F.col("day") >= F.col("b") - 7, "purged").when(F.col("day") >= F.col("a"), "validation").when(F.col("day") >= F.col("a") - 7, "purged").otherwise("train")
    return x.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("day").cast("long").alias("first_day"), F.max("day").cast("long").alias("last_day"), F.sum("won").alias("wins"))


SPLIT = f"""{R}, d AS (SELECT day, percent_rank() OVER (ORDER BY day) AS place FROM (SELECT DISTINCT day FROM r)), c AS (SELECT min(day) FILTER (place >= 0.7) AS a, min(day) FILTER (place >= 0.85) AS b FROM d)
SELECT CASE WHEN day >= b THEN 'test' WHEN day >= b - 7 THEN 'purged' WHEN day >= a THEN 'validation' WHEN day >= a - 7 THEN 'purged' ELSE 'train' END AS part, count(*) AS n, min(day)::BIGINT AS first_day, max(day)::BIGINT AS last_day, sum(won)::BIGINT AS wins FROM r, c GROUP BY 1"""


def walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Expanding yearly folds: each year is tested on what came before it."""
    r = runners(spark, sf).withColumn("year", F.year("race_date"))
    by_year = r.groupBy(F.col("year").alias("fold")).agg(F.count(F.lit(1)).alias("n_test"), F.sum("won").alias("test_wins"))
    before = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)  # over one row a year
    return by_year.withColumn("n_train", F.sum("n_test").over(before)).where("n_train is not null").select("fold", "n_train", "n_test", "test_wins")


WALK = f"""{R}, y AS (SELECT *, year(race_date)::INTEGER AS year FROM r), f AS (SELECT DISTINCT year AS fold FROM y WHERE year > (SELECT min(year) FROM y))
SELECT fold, count(*) FILTER (year < fold) AS n_train, count(*) FILTER (year = fold) AS n_test, (sum(won) FILTER (year = fold))::BIGINT AS test_wins FROM y JOIN f ON year <= fold GROUP BY fold"""


def calibration_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Reliability table of the market's probabilities."""
    return quality.calibration_bins(_predicted(spark, sf), "p", "won").select("bin", "n", r6("predicted"), r6("observed"))


CALIBRATION = f"""{P} SELECT least(floor(p * 10), 9)::INTEGER AS bin, count(*) AS n, round(avg(p), 6) + 0.0 AS predicted, round(avg(won), 6) + 0.0 AS observed FROM pr GROUP BY 1"""


def calibration_error(spark: SparkSession, sf: str) -> DataFrame:
    """Expected and maximum calibration error."""
    return quality.calibration_error(quality.calibration_bins(_predicted(spark, sf), "p", "won")).select(r6("ece"), r6("mce"), "n")


CALIBRATION_ERROR = f"""{P}, b AS (SELECT count(*) AS n, abs(avg(p) - avg(won)) AS gap FROM pr GROUP BY least(floor(p * 10), 9)) SELECT round(sum(gap * n) / sum(n), 6) + 0.0 AS ece, round(max(gap), 6) + 0.0 AS mce, sum(n)::BIGINT AS n FROM b"""


def logloss_auc(spark: SparkSession, sf: str) -> DataFrame:
    """Log loss, accuracy and area under the ROC curve of the market's probabilities."""
    d = _predicted(spark, sf).withColumn("p", F.round("p", 9))
    return quality.log_loss_and_auc(d, "p", "won").select("n", r6("log_loss"), r6("accuracy"), r6("auc"))


LOGLOSS = f"""{P}, q AS (SELECT round(p, 9) AS p, won FROM pr), k AS (SELECT *, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS rk FROM q)
SELECT count(*) AS n, round(avg(-CASE WHEN won = 1 THEN ln(greatest(1e-15, least(1 - 1e-15, p))) ELSE ln(1 - greatest(1e-15, least(1 - 1e-15, p))) END), 6) + 0.0 AS log_loss, round(avg(((p >= 0.5)::INTEGER = won)::INTEGER), 6) + 0.0 AS accuracy,
  round((sum(rk) FILTER (won = 1) - sum(won) * (sum(won) + 1) / 2) / (sum(won) * (count(*) - sum(won))), 6) + 0.0 AS auc FROM k"""


def psi(spark: SparkSession, sf: str) -> DataFrame:
    """Stability of event numbers in the second half of the period against the first."""
    return quality.psi(events(spark, sf), "k", F.col("day") < 15).select(r6("psi"), "bins")


PSI = f"""{E}, l AS (SELECT min(k) AS lo, max(k) AS hi FROM e WHERE day < 15), b AS (SELECT least(floor((k - lo) / (hi - lo) * 10), 9) AS b, count(*) FILTER (day < 15) AS r, count(*) FILTER (day >= 15) AS c FROM e, l WHERE k BETWEEN lo AND hi GROUP BY 1),
s AS (SELECT greatest(r / sum(r) OVER (), 1e-6) AS r, greatest(c / sum(c) OVER (), 1e-6) AS c FROM b) SELECT round(sum((c - r) * ln(c / r)), 6) + 0.0 AS psi, count(*) AS bins FROM s"""


def ks(spark: SparkSession, sf: str) -> DataFrame:
    """Kolmogorov-Smirnov distance of values in the two halves of the period."""
    return quality.ks(events(spark, sf), "k", F.col("day") < 15).select(r6("ks"))


KS = f"""{E}, c AS (SELECT k, sum(count(*) FILTER (day < 15)) OVER (ORDER BY k) AS a, sum(count(*) FILTER (day >= 15)) OVER (ORDER BY k) AS b FROM e GROUP BY k) SELECT round(max(abs(a / (SELECT max(a) FROM c) - b / (SELECT max(b) FROM c))), 6) + 0.0 AS ks FROM c"""


def leakage_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Correlation of each feature with the label; values near one leak."""
    return quality.correlations(runners(spark, sf), ["distance", "weight", "odds", "gains", "position", "placed"], "won").select("feature", r6("r"), (F.abs("r") > 0.5).cast("int").alias("suspect"))


LEAKAGE = f"""{R} {" UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, won), 6) + 0.0 AS r, (abs(corr({c}, won)) > 0.5)::INTEGER AS suspect FROM r" for c in ("distance", "weight", "odds", "gains", "position", "placed"))}"""


def schema_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that break range and key rules, one scan for all rules."""
    rules = {"distance_range": F.col("distance").between(1200, 3200), "weight_range": F.col("weight").between(1, 9), "draw_range": F.col("draw").between(1, 6), "odds_over_one": F.col("odds") > 1, "finish_range": F.col("position") <= 6}
    return quality.violations(runners(spark, sf), rules)


SCHEMA = f"""{R} {" UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (NOT ({c})) AS broken FROM r" for n, c in (("distance_range", "distance BETWEEN 1200 AND 3200"), ("weight_range", "weight BETWEEN 1 AND 9"), ("draw_range", "draw BETWEEN 1 AND 6"), ("odds_over_one", "odds > 1"), ("finish_range", "position <= 6")))}"""


def outlier_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quartiles and fences of each numeric column."""
    return quality.quantile_bounds(runners(spark, sf), ["distance", "weight", "odds"]).select("field", *map(r6, ("q1", "median", "q3", "low", "high")))


OUTLIERS = f"""{R} {" UNION ALL ".join(f"SELECT '{c}' AS field, round(quantile_cont({c}::DOUBLE, 0.25), 6) + 0.0 AS q1, round(quantile_cont({c}::DOUBLE, 0.5), 6) + 0.0 AS median, round(quantile_cont({c}::DOUBLE, 0.75), 6) + 0.0 AS q3, round(quantile_cont({c}::DOUBLE, 0.25) - 1.5 * (quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25)), 6) + 0.0 AS low, round(quantile_cont({c}::DOUBLE, 0.75) + 1.5 * (quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25)), 6) + 0.0 AS high FROM r" for c in ("distance", "weight", "odds"))}"""


def segment_bias(spark: SparkSession, sf: str) -> DataFrame:
    """Mean prediction against outcome by segment, flagged beyond two standard errors from 30 rows."""
    d = _predicted(spark, sf)
    price = F.when(F.col("odds") < 3, "0-3").when(F.col("odds") < 6, "3-6").when(F.col("odds") < 15, "6-15").otherwise("15+")
    kinds = {"discipline": F.col("discipline"), "odds": price, "field": F.when(F.col("fs") < 3, "small").otherwise("large")}
    seg = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("segment")) for k, v in kinds.items())))
    g = d.select("p", "won", seg.alias("s")).groupBy("s.kind", "s.segment").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("predicted"), F.avg("won").alias("observed"))
    err = F.sqrt(F.col("observed") * (1 - F.col("observed")) / F.col("n"))
    return g.where("n >= 30").withColumn("biased", (F.abs(F.col("predicted") - F.col("observed")) > 2 * err).cast("int")).select("kind", "segment", "n", r6("predicted"), r6("observed"), "biased")


SEGMENT_BIAS = f"""{P}, s AS (SELECT 'discipline' AS kind, discipline AS segment, p, won FROM pr UNION ALL SELECT 'odds', CASE WHEN odds < 3 THEN '0-3' WHEN odds < 6 THEN '3-6' WHEN odds < 15 THEN '6-15' ELSE '15+' END, p, won FROM pr UNION ALL SELECT 'field', CASE WHEN fs < 3 THEN 'small' ELSE 'large' END, p, won FROM pr)
SELECT kind, segment, count(*) AS n, round(avg(p), 6) + 0.0 AS predicted, round(avg(won), 6) + 0.0 AS observed, (abs(avg(p) - avg(won)) > 2 * sqrt(avg(won) * (1 - avg(won)) / count(*)))::INTEGER AS biased FROM s GROUP BY kind, segment HAVING count(*) >= 30"""


def monthly_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly mean, deviation, extremes and gaps of each feature."""
    d = runners(spark, sf).select(F.date_format("race_date", "yyyy-MM").alias("month"), F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in ("distance", "weight", "gains")))).alias("x"))
    return d.groupBy("month", "x.feature").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("x.v"), 6).alias("mean"), F.round(F.stddev_samp("x.v"), 4).alias("sd"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi"))


MONTHLY = f"""{R} {" UNION ALL ".join(f"SELECT strftime(race_date, '%Y-%m') AS month, '{c}' AS feature, count(*) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 4) AS sd, min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM r GROUP BY 1" for c in ("distance", "weight", "gains"))}"""


def fill_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Fill rate of each column after cleaning."""
    r = runners(spark, sf).withColumns({"weight": F.nullif("weight", F.lit(0)), "equipment": F.when(F.col("equipment") != "F", F.col("equipment"))})
    return quality.fill_rates(r, ["weight", "equipment", "odds"])


FILL = f"""{R}, c AS (SELECT nullif(weight, 0) AS weight, CASE WHEN equipment <> 'F' THEN equipment END AS equipment, odds FROM r) {" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS n, count({c}) AS filled, count({c}) / count(*) AS rate FROM c" for c in ("weight", "equipment", "odds"))}"""


def value_bets(spark: SparkSession, sf: str) -> DataFrame:
    """Bets whose model probability (even shares here) beats the market, with capped Kelly stakes."""
    d = _predicted(spark, sf).withColumn("model", 1 / F.col("fs"))
    return betting.value_bets(d, "model", "odds").select("uid", r6("edge"), r6("stake"))


VALUE = f"""{P}, v AS (SELECT uid, 1 / fs * odds - 1 AS edge, least(0.05, greatest(0, (1 / fs * odds - 1) / nullif(odds - 1, 0) * 0.25)) AS stake, odds, 1 / fs AS m FROM pr) SELECT uid, round(edge, 6) + 0.0 AS edge, round(stake, 6)::DOUBLE + 0.0 AS stake FROM v WHERE edge >= 0.05 AND odds BETWEEN 1.5 AND 50 AND m >= 0.02 AND stake > 0"""


def kelly_portfolio(spark: SparkSession, sf: str) -> DataFrame:
    """Stakes of each day scaled to 30 per cent exposure, small ones dropped."""
    d = _predicted(spark, sf).withColumn("model", 1 / F.col("fs"))
    bets = betting.scaled(betting.value_bets(d, "model", "odds"), ["day"], "stake")
    return bets.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("stake"), 6).alias("staked")).withColumn("day", F.col("day").cast("long"))


PORTFOLIO = f"""{P}, v AS (SELECT day, 1 / fs * odds - 1 AS edge, least(0.05, greatest(0, (1 / fs * odds - 1) / nullif(odds - 1, 0) * 0.25)) AS stake, odds, 1 / fs AS m FROM pr), b AS (SELECT *, sum(stake) OVER (PARTITION BY day) AS t FROM v WHERE edge >= 0.05 AND odds BETWEEN 1.5 AND 50 AND m >= 0.02 AND stake > 0),
s AS (SELECT day, CASE WHEN t > 0.3 THEN stake * 0.3 / t ELSE stake END AS stake FROM b) SELECT day::BIGINT AS day, count(*) AS n, round(sum(stake), 6)::DOUBLE AS staked FROM s WHERE stake >= 0.001 GROUP BY day"""


def harville_trifecta(spark: SparkSession, sf: str) -> DataFrame:
    """Probabilities of ordered first-three finishes of contests with four entrants or more, the likeliest of each."""
    d = _predicted(spark, sf).where("fs >= 4")
    return betting.likeliest_finish(d, "race", "no", "p").select("race", "ticket", r6("probability"))


HARVILLE = f"""{P}, x AS (SELECT race, no, p FROM pr WHERE fs >= 4), t AS (SELECT a.race, concat_ws('-', a.no, b.no, c.no) AS ticket, a.p * (b.p / (1 - a.p)) * (c.p / (1 - (a.p + b.p))) AS pr FROM x AS a JOIN x AS b ON a.race = b.race AND a.no <> b.no JOIN x AS c ON a.race = c.race AND c.no NOT IN (a.no, b.no))
SELECT race, ticket, round(pr, 6) + 0.0 AS probability FROM t QUALIFY row_number() OVER (PARTITION BY race ORDER BY round(pr, 9) DESC, ticket) = 1"""


def roi_by_week(spark: SparkSession, sf: str) -> DataFrame:
    """Return on one unit on each favourite by ISO week, with Sharpe's ratio."""
    cents = F.when(F.col("won") == 1, F.round(F.col("odds") * 100).cast("long") - 100).otherwise(F.lit(-100))
    r = race.market(runners(spark, sf)).where("favourite = 1").withColumn("cents", cents)
    key = F.concat(F.extract(F.lit("YEAROFWEEK"), "race_date"), F.lit("-W"), F.lpad(F.weekofyear("race_date").cast("string"), 2, "0"))
    return r.groupBy(key.alias("week")).agg(F.count(F.lit(1)).alias("bets"), F.sum("cents").alias("profit"), (F.sum("cents").cast("double") / (100 * F.count(F.lit(1)))).alias("roi"), F.round(F.try_divide(F.avg("cents"), F.stddev_samp("cents")), 4).alias("sharpe"))


ROI_WEEK = f"""{R}, f AS (SELECT *, CASE WHEN won = 1 THEN round(odds * 100)::BIGINT - 100 ELSE -100 END AS cents FROM r QUALIFY row_number() OVER (PARTITION BY race ORDER BY odds, no) = 1)
SELECT isoyear(race_date) || '-W' || lpad(weekofyear(race_date)::VARCHAR, 2, '0') AS week, count(*) AS bets, sum(cents)::BIGINT AS profit, sum(cents)::DOUBLE / (100 * count(*)) AS roi, CASE WHEN stddev_samp(cents) > 0 THEN round(avg(cents) / stddev_samp(cents), 4) END AS sharpe FROM f GROUP BY 1"""


def drawdown(spark: SparkSession, sf: str) -> DataFrame:
    """Balance, peak and drawdown of each entity's events, in whole numbers."""
    return betting.drawdown(events(spark, sf).withColumn("profit", F.col("k") - 50), ["entity"], ["ts"], "profit").select("event_id", "balance", "peak", "drawdown")


DRAWDOWN = f"""{E}, b AS (SELECT event_id, entity, ts, sum(k - 50) OVER (PARTITION BY entity ORDER BY ts ROWS UNBOUNDED PRECEDING)::BIGINT AS balance FROM e), p AS (SELECT *, greatest(0, max(balance) OVER (PARTITION BY entity ORDER BY ts ROWS UNBOUNDED PRECEDING)) AS peak FROM b) SELECT event_id, balance, peak, peak - balance AS drawdown FROM p"""


def clv_report(spark: SparkSession, sf: str) -> DataFrame:
    """Closing line value of opening prices (a tenth longer) by discipline, with its t statistic."""
    d = runners(spark, sf).withColumn("taken", F.col("odds") * 1.1 + F.col("no") / 100.0).withColumn("clv", scalars.clv_implied(F.col("taken"), F.col("odds")))
    return d.groupBy("discipline").agg(F.count(F.lit(1)).alias("n"), F.avg("clv").alias("mean"), F.stddev_samp("clv").alias("sd"), F.avg((F.col("clv") > 0).cast("int")).alias("share")).select("discipline", "n", r6("mean"), r6("share"), F.round(F.col("mean") / (F.col("sd") / F.sqrt("n")), 3).alias("t"))


CLV = f"""{R}, c AS (SELECT discipline, 1 / odds - 1 / (odds * 1.1::DOUBLE + no / 100.0) AS clv FROM r) SELECT discipline, count(*) AS n, round(avg(clv), 6) + 0.0 AS mean, round(avg((clv > 0)::INTEGER), 6) + 0.0 AS share, round(avg(clv) / (stddev_samp(clv) / sqrt(count(*))), 3) AS t FROM c GROUP BY discipline"""


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted ranks against results by year: top-1 and top-3 hits, mean rank error, return."""
    r = race.market(runners(spark, sf))
    top = F.col("odds_rank") == 1
    return r.groupBy(F.year("race_date").alias("year")).agg(F.sum(F.when(top, F.col("won"))).alias("hits"), F.sum(F.when(top, F.col("placed"))).alias("top3_hits"), F.avg(F.abs(F.col("odds_rank") - F.col("position"))).alias("rank_error"), F.round(F.sum(F.when(top, F.when(F.col("won") == 1, F.col("odds") - 1).otherwise(-1.0))), 2).alias("profit"))


RECONCILIATION = f"""{R}, m AS (SELECT *, row_number() OVER (PARTITION BY race ORDER BY odds, no) AS k FROM r) SELECT year(race_date)::INTEGER AS year, (sum(won) FILTER (k = 1))::BIGINT AS hits, (sum(placed) FILTER (k = 1))::BIGINT AS top3_hits, avg(abs(k - position)) AS rank_error, round(sum(CASE WHEN won = 1 THEN odds - 1 ELSE -1 END) FILTER (k = 1), 2)::DOUBLE AS profit FROM m GROUP BY 1"""


def monte_carlo(spark: SparkSession, sf: str) -> DataFrame:
    """Simulated finishes (200 draws); rows only, held against the exact win probabilities in the tests."""
    return betting.simulate(_predicted(spark, sf), "race", "no", "p", 200, 5)


def cusum(spark: SparkSession, sf: str) -> DataFrame:
    """CUSUM and Page-Hinkley alarms of each event kind's numbers."""
    return sequences.alarms(events(spark, sf), "kind", "ts", "k", sequences.cusum(50.0, 10.0, 100.0))


CUSUM = f"""WITH RECURSIVE {EVENTS_SQL}, n AS (SELECT kind, k::DOUBLE AS v, row_number() OVER (PARTITION BY kind ORDER BY ts) AS i FROM e),
s AS (SELECT kind, 0::BIGINT AS i, 0.0::DOUBLE AS up, 0.0::DOUBLE AS down, 0 AS alarms, 0::BIGINT AS last FROM (SELECT DISTINCT kind FROM n)
  UNION ALL SELECT kind, i, CASE WHEN hit THEN 0 ELSE u END, CASE WHEN hit THEN 0 ELSE d END, alarms + hit::INTEGER, CASE WHEN hit THEN i ELSE last END FROM (SELECT *, u > 100 OR d > 100 AS hit FROM (SELECT s.kind, n.i, greatest(0, s.up + v - 50 - 10) AS u, greatest(0, s.down - v + 50 - 10) AS d, alarms, last FROM s JOIN n ON s.kind = n.kind AND n.i = s.i + 1)))
SELECT kind, max(alarms) AS alarms, max(last)::INTEGER AS last_alarm FROM s GROUP BY kind"""


def page_hinkley(spark: SparkSession, sf: str) -> DataFrame:
    """Page-Hinkley alarms of each event kind's numbers."""
    return sequences.alarms(events(spark, sf), "kind", "ts", "k", sequences.page_hinkley(0.5, 400.0))


PAGE = f"""WITH RECURSIVE {EVENTS_SQL}, n AS (SELECT kind, k::DOUBLE AS v, row_number() OVER (PARTITION BY kind ORDER BY ts) AS i FROM e),
s AS (SELECT kind, 0::BIGINT AS i, 0.0::DOUBLE AS mean, 0.0::DOUBLE AS m, 0.0::DOUBLE AS least, 0 AS alarms, 0::BIGINT AS last FROM (SELECT DISTINCT kind FROM n)
  UNION ALL SELECT kind, i, mean, CASE WHEN m2 - l2 > 400 THEN 0 ELSE m2 END, CASE WHEN m2 - l2 > 400 THEN 0 ELSE l2 END, alarms + (m2 - l2 > 400)::INTEGER, CASE WHEN m2 - l2 > 400 THEN i ELSE last END FROM (SELECT *, least(least, m2) AS l2 FROM (SELECT *, m + v - mean - 0.5 AS m2 FROM (SELECT s.kind, n.i, v, s.mean + (v - s.mean) / n.i AS mean, m, least, alarms, last FROM s JOIN n ON s.kind = n.kind AND n.i = s.i + 1))))
SELECT kind, max(alarms) AS alarms, max(last)::INTEGER AS last_alarm FROM s GROUP BY kind"""


def distance_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Runs by every named distance binning."""
    r = runners(spark, sf).select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), scalars.distance_band(F.col("distance"), n).alias("band")) for n in scalars.DISTANCE_BANDS))).alias("x"))
    return r.groupBy("x.name", "x.band").agg(F.count(F.lit(1)).alias("n"))


def _case(name: str) -> str:
    cuts, closed, names = scalars.DISTANCE_BANDS[name]
    return "CASE " + " ".join(f"WHEN distance {'<' if closed == 'left' else '<='} {c} THEN '{n}'" for c, n in zip(cuts, names, strict=False)) + f" ELSE '{names[-1]}' END"


BINS = f"""{R}, x AS ({" UNION ALL ".join(f"SELECT '{n}' AS name, {_case(n)} AS band FROM r" for n in scalars.DISTANCE_BANDS)}) SELECT name, band, count(*) AS n FROM x GROUP BY name, band"""


def name_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """Matching keys and slugs of names."""
    return table(spark, sf, "part").select("p_partkey", scalars.name_key(F.col("p_name")).alias("name_key"), scalars.slug(F.concat_ws(" ", "p_name", "p_type")).alias("slug"))


NAMES = """SELECT p_partkey, nullif(trim(regexp_replace(upper(p_name), '[^A-Z0-9]+', ' ', 'g')), '') AS name_key, trim(regexp_replace(lower(concat_ws(' ', p_name, p_type)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part"""


def form_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Form strings of a horse's results and their decoding: places, wins, mean of those placed, runs of the commonest letter."""
    r = runners(spark, sf)
    text = F.array_join(F.transform(F.reverse(F.sort_array(F.collect_list(F.struct("day", "race", "no", "position", "discipline")))), lambda x: F.concat(F.when(x["position"] > 6, F.lit("D")).otherwise(x["position"].cast("string")), F.when(x["discipline"] == "A", "a").when(x["discipline"] == "N", "p").otherwise("h"))), "")
    t = r.groupBy("horse").agg(text.alias("form")).withColumn("m", scalars.form_string(F.col("form")))
    places = F.filter(F.transform("m", lambda x: x["place"]), lambda p: p.isNotNull())
    return t.select("horse", F.size("m").cast("long").alias("n"), F.size(F.filter(places, lambda p: p == 1)).cast("long").alias("wins"), F.size(F.filter(places, lambda p: p <= 3)).cast("long").alias("top3"), F.aggregate(places, F.lit(0).cast("long"), lambda a, p: a + p).alias("place_sum"), F.size(F.filter("m", lambda x: x["discipline"] == "a")).cast("long").alias("n_a"))


FORM = f"""{R} SELECT horse, count(*) AS n, sum(won)::BIGINT AS wins, sum(placed)::BIGINT AS top3, coalesce(sum(position) FILTER (position <= 6), 0)::BIGINT AS place_sum, count(*) FILTER (discipline = 'A') AS n_a FROM r GROUP BY horse"""


def lexicon_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Balance of good and bad words of each conversation turn."""
    return table(spark, sf, "conversations").select("conv_id", "turn", scalars.lexicon_score(F.col("text"), ["the", "and"], ["of", "is"]).alias("score"))


SENTIMENT = """WITH w AS (SELECT conv_id, turn, string_split_regex(lower(text), '\\s+') AS ws FROM conversations), c AS (SELECT conv_id, turn, len([x FOR x IN ws IF x IN ('the', 'and')]) AS g, len([x FOR x IN ws IF x IN ('of', 'is')]) AS b FROM w) SELECT conv_id, turn, coalesce((g - b) / nullif(g + b, 0), 0)::DOUBLE AS score FROM c"""


def html_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields present in raw pages: title, language, links, paragraphs."""
    p = table(spark, sf, "pages")
    return p.select("page_id", F.regexp_extract("html", r"(?i)<title(?:\s[^>]*)?>([^<]*)</title", 1).alias("title"), F.regexp_extract("html", r"(?i)<html\s[^>]*?lang\s*=\s*[\"']?([a-z]+)", 1).alias("lang"), F.regexp_count("html", F.lit(r"(?i)<a\s[^>]*?href\s*=")).cast("long").alias("links"), F.regexp_count("html", F.lit(r"(?i)<p(?:\s[^>]*)?>")).cast("long").alias("paragraphs"))


HTML = r"""WITH l AS (SELECT page_id, html, lower(html) AS h FROM pages)
SELECT page_id, regexp_extract(html, '(?i)<title( [^>]*)?>([^<]*)<', 2) AS title, regexp_extract(h, '<html [^>]*?lang *= *["'']?([a-z]+)', 1) AS lang, len(list_filter(string_split(h, '<a'), lambda x: regexp_matches(x, '^\s[^>]*href\s*='))) AS links, len(list_filter(string_split(h, '<p'), lambda x: regexp_matches(x, '^(\s[^>]*)?>'))) AS paragraphs FROM l"""


def cosine_shift(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine distance of each label's mean vector from the overall mean."""
    v = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    by = v.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("a"))
    al = v.groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("b"))
    return by.join(al, "i").groupBy("label").agg(F.round(1 - F.sum(F.col("a") * F.col("b")) / F.sqrt(F.sum(F.col("a") * F.col("a")) * F.sum(F.col("b") * F.col("b"))), 5).alias("distance"))


COSINE = """WITH v AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), a AS (SELECT label, i, avg(x) AS a FROM v GROUP BY ALL), b AS (SELECT i, avg(x) AS b FROM v GROUP BY i)
SELECT label, round(1 - sum(a * b) / sqrt(sum(a * a) * sum(b * b)), 5) AS distance FROM a JOIN b USING (i) GROUP BY label"""


def events_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    """Six-hour tumbling counts by kind."""
    return events(spark, sf).groupBy(F.window(F.col("ts").cast("timestamp"), "6 hours").alias("w"), "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total")).select(F.unix_seconds("w.start").alias("start"), "kind", "n", "total")


TUMBLING = f"""{E} SELECT (epoch(ts)::BIGINT // 21600) * 21600 AS start, kind, count(*) AS n, sum(k)::BIGINT AS total FROM (SELECT kind, k, date_trunc('second', ts) AS ts FROM e) GROUP BY 1, 2"""


def events_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Three-day counts sliding by a day."""
    return events(spark, sf).groupBy(F.window(F.col("ts").cast("timestamp"), "3 days", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.unix_seconds("w.start").alias("start"), "n")


SLIDING = f"""{E} SELECT (epoch(ts)::BIGINT // 86400 - d) * 86400 AS start, count(*) AS n FROM (SELECT date_trunc('second', ts) AS ts FROM e), range(3) AS o(d) GROUP BY 1"""


def events_session(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of an entity split by gaps of twelve hours."""
    return events(spark, sf).groupBy("entity", F.session_window(F.col("ts").cast("timestamp"), "12 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total")).select("entity", F.unix_micros("w.start").alias("start"), "n", "total")


SESSION = f"""{E}, g AS (SELECT *, (ts >= lag(ts) OVER (PARTITION BY entity ORDER BY ts) + INTERVAL 12 HOURS)::INTEGER AS new FROM e), s AS (SELECT *, sum(coalesce(new, 0)) OVER (PARTITION BY entity ORDER BY ts) AS s FROM g) SELECT entity, epoch_us(min(ts)) AS start, count(*) AS n, sum(k)::BIGINT AS total FROM s GROUP BY entity, s"""


def impute_group_median(spark: SparkSession, sf: str) -> DataFrame:
    """Missing weights by their discipline's median; columns scaled by minimum and maximum, by median and quartiles."""
    r = runners(spark, sf).withColumn("w", F.when(F.col("uid") % 7 != 0, F.col("weight").cast("double")))
    g = r.groupBy(F.col("discipline").alias("of")).agg(F.median("w").alias("med"))
    x = r.join(g, F.col("discipline").eqNullSafe(F.col("of")), "left").withColumn("w", F.coalesce("w", "med"))
    lim = x.agg(F.min("w").alias("lo"), F.max("w").alias("hi"), F.percentile("distance", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    return x.crossJoin(F.broadcast(lim)).select("uid", F.round("w", 6).alias("weight"), F.round((F.col("w") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)), 6).alias("scaled"), (F.round((F.col("distance") - F.col("q")[1]) / F.nullif(F.col("q")[2] - F.col("q")[0], F.lit(0.0)), 6) + F.lit(0.0)).alias("robust"))


IMPUTE = f"""{R}, w AS (SELECT *, CASE WHEN uid % 7 <> 0 THEN weight::DOUBLE END AS w0 FROM r), x AS (SELECT *, coalesce(w0, median(w0) OVER (PARTITION BY discipline)) AS w FROM w), l AS (SELECT min(w) AS lo, max(w) AS hi, quantile_cont(distance::DOUBLE, [0.25, 0.5, 0.75]) AS q FROM x)
SELECT uid, round(w, 6) AS weight, round((w - lo) / nullif(hi - lo, 0), 6) AS scaled, round((distance - q[2]) / nullif(q[3] - q[1], 0), 6) + 0.0 AS robust FROM x, l"""

_ALL = {
    labels: LABELS, temporal_split: SPLIT, walk_forward: WALK, calibration_bins: CALIBRATION, calibration_error: CALIBRATION_ERROR, logloss_auc: LOGLOSS, psi: PSI, ks: KS, leakage_corr: LEAKAGE, schema_violations: SCHEMA, outlier_bounds: OUTLIERS,
    segment_bias: SEGMENT_BIAS, monthly_stats: MONTHLY, fill_rates: FILL, value_bets: VALUE, kelly_portfolio: PORTFOLIO, harville_trifecta: HARVILLE, roi_by_week: ROI_WEEK, drawdown: DRAWDOWN, clv_report: CLV, reconciliation: RECONCILIATION, monte_carlo: None, cusum: CUSUM, page_hinkley: PAGE,
    distance_bins: BINS, name_normalise: NAMES, form_strings: FORM, lexicon_sentiment: SENTIMENT, html_fields: HTML, cosine_shift: COSINE, events_tumbling: TUMBLING, events_sliding: SLIDING, events_session: SESSION, impute_group_median: IMPUTE,
}
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {f.__name__: sql for f, sql in _ALL.items() if sql}
