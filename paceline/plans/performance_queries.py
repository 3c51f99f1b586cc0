"""Queries over histories of places, times, pace, figures, class and odds, with their SQL.

The tables have no times: the purse of a run stands for its reduction, the
milliseconds a kilometre, which a run that didn't finish lacks, and others too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.functions import arrays
from paceline.operators import pit
from paceline.plans.form_queries import DNF, ORDER, integer, real, real_sql
from paceline.sources.tables import RUNNERS_SQL, runners

WINDOWS = (5, 10, 20)


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    done = ~F.expr(DNF)
    r = runners(spark, sf).withColumns({"dnf": F.expr(DNF).cast("int"), "place": F.when(done, F.col("position")), "reduction": F.when(done & (F.col("gains") % 11 != 0), 70_000 + F.col("gains") % 9_000)})
    figure = F.when(F.col("reduction").isNotNull(), (79_000 - F.col("reduction")) / 100.0)
    rating = F.least(F.col("gains") / 500_000.0, F.lit(50.0)) + F.col("weight")
    return r.withColumns({"time": F.col("reduction") * F.col("distance") / 1000, "figure": figure, "rating": rating, "price": F.when(F.col("gains") % 13 != 0, F.col("odds").cast("double"))})


X = f"""WITH {RUNNERS_SQL}, y AS (SELECT *, ({DNF})::INTEGER AS dnf, CASE WHEN NOT {DNF} THEN position END AS place, CASE WHEN NOT {DNF} AND gains % 11 <> 0 THEN 70000 + gains % 9000 END AS reduction FROM r),
x AS (SELECT *, reduction * distance / 1000 AS time, (79000 - reduction) / 100 AS figure, least(gains / 500000, 50) + weight AS rating, CASE WHEN gains % 13 <> 0 THEN odds::DOUBLE END AS price FROM y)"""


def performance_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Places, times, reductions and earnings over the last 5, 10 and 20 runs of earlier days: mean, deviation, ends and median; steadiness, slope and pattern of the last ten places."""
    figures: dict[str, tuple[int, Column]] = {"places_10": (10, F.collect_list("place")), "dnf_10": (10, F.avg("dnf"))}
    for n in WINDOWS:
        figures |= {f"places_{n}": (n, F.collect_list("place")), f"worst_{n}": (n, F.max("place")), f"sum_{n}": (n, F.sum("gains")), f"gains_{n}": (n, F.avg("gains"))}
        figures |= {f"{k}_{c}_{n}": (n, f(c)) for c in ("place", "time", "reduction") for k, f in (("mean", F.avg), ("sd", F.stddev_samp), ("best", F.min))}
        figures |= {f"{k}_{c}_{n}": (n, f(c)) for c in ("won", "placed") for k, f in (("sum", F.sum), ("rate", F.avg))}
    last = pit.of_earlier_days(_runs(spark, sf), "horse", ORDER, {f"_{k}": v for k, v in figures.items()})
    cols: list[Column] = []
    for n in WINDOWS:
        at = lambda k, n=n: F.col(f"_{k}_{n}")
        cols += [real(at("mean_place"), f"place_mean_{n}"), real(at("sd_place"), f"place_sd_{n}"), real(arrays.median(at("places")), f"place_median_{n}")]
        cols += [integer(at("best_place"), f"place_best_{n}"), integer(at("worst"), f"place_worst_{n}")]
        for c in ("time", "reduction"):
            cols += [real(at(f"{k}_{c}"), f"{c}_{k}_{n}") for k in ("mean", "sd", "best")]
        cols += [real(at("gains"), f"gains_mean_{n}"), integer(at("sum"), f"gains_{n}")]
        cols += [integer(F.coalesce(at(f"sum_{c}"), F.lit(0)), f"{c}_{n}") for c in ("won", "placed")] + [real(at(f"rate_{c}"), f"{c}_rate_{n}") for c in ("won", "placed")]
    ten = F.col("_places_10")
    steep = arrays.slope(ten, least=3)
    steady = F.when(F.size(ten) >= 3, F.try_divide(arrays.sd_sample(ten), arrays.mean(ten)))
    rounded = F.round(steep, 4)
    pattern = F.when(rounded < -0.3, "improving").when(rounded > 0.3, "declining").when(rounded.isNotNull(), "stable")
    return last.select("uid", *cols, real(steady, "steadiness"), real(steep, "slope"), pattern.alias("pattern"), real(F.col("_dnf_10"), "dnf_rate"))


def _prev(value: str | None = None, sequential: bool = False) -> str:
    before = "(b.day, b.race, b.no) < (a.day, a.race, a.no)" if sequential else "b.day < a.day"
    return f"SELECT a.uid, b.*EXCLUDE (uid), row_number() OVER (PARTITION BY a.uid ORDER BY b.day DESC, b.race DESC, b.no DESC) AS k FROM x AS a JOIN x AS b ON a.horse = b.horse AND {before}{f' AND b.{value} IS NOT NULL' if value else ''}"


def _window_sql(n: int) -> str:
    on = f"FILTER (k <= {n})"
    cols = [real_sql(f"avg(p.place) {on}", f"place_mean_{n}"), real_sql(f"stddev_samp(p.place) {on}", f"place_sd_{n}"), real_sql(f"median(p.place) {on}", f"place_median_{n}"), f"(min(p.place) {on})::BIGINT AS place_best_{n}", f"(max(p.place) {on})::BIGINT AS place_worst_{n}"]
    for c in ("time", "reduction"):
        cols += [real_sql(f"avg(p.{c}) {on}", f"{c}_mean_{n}"), real_sql(f"stddev_samp(p.{c}) {on}", f"{c}_sd_{n}"), real_sql(f"min(p.{c}) {on}", f"{c}_best_{n}")]
    cols += [real_sql(f"avg(p.gains) {on}", f"gains_mean_{n}"), f"(sum(p.gains) {on})::BIGINT AS gains_{n}"]
    cols += [f"coalesce(sum(p.{c}) {on}, 0)::BIGINT AS {c}_{n}" for c in ("won", "placed")] + [real_sql(f"avg(p.{c}) {on}", f"{c}_rate_{n}") for c in ("won", "placed")]
    return ", ".join(cols)


PERFORMANCE_WINDOWS = f"""{X}, p AS ({_prev()}),
ten AS (SELECT uid, place, row_number() OVER (PARTITION BY uid ORDER BY k DESC) AS i FROM p WHERE k <= 10 AND place IS NOT NULL),
t AS (SELECT uid, CASE WHEN count(*) >= 3 THEN regr_slope(place, i) END AS s, CASE WHEN count(*) >= 3 THEN stddev_samp(place) / avg(place) END AS c FROM ten GROUP BY uid),
w AS (SELECT x.uid, {", ".join(_window_sql(n) for n in WINDOWS)}, {real_sql("avg(p.dnf) FILTER (k <= 10)", "dnf_rate")} FROM x LEFT JOIN p USING (uid) GROUP BY x.uid)
SELECT w.*, {real_sql("c", "steadiness")}, {real_sql("s", "slope")}, CASE WHEN round(s, 4) < -0.3 THEN 'improving' WHEN round(s, 4) > 0.3 THEN 'declining' WHEN s IS NOT NULL THEN 'stable' END AS pattern FROM w LEFT JOIN t USING (uid)"""


def time_history(spark: SparkSession, sf: str) -> DataFrame:
    """Reductions of earlier days, runs without one left out before counting: mean and best of the last 5 and 10, deviation of all, and the mean of the three before less that of the last three."""
    r = pit.last_known_values(_runs(spark, sf), "horse", {"h": ("reduction", 10)}, ORDER, lambda w: w.orderBy("day").rangeBetween(Window.unboundedPreceding, -1))
    n, s, q = F.col("h_n"), F.col("h_sum").cast("double"), F.col("h_squares")
    spread = F.sqrt(F.greatest(F.lit(0.0), q / n - (s / n) * (s / n)))
    part = lambda a, k: F.slice("h", a, k)
    three, before = part(1, 3), part(4, 3)
    trend = F.when((F.size(three) >= 2) & (F.size(before) >= 2), arrays.mean(before) - arrays.mean(three))
    return r.select("uid", *(real(arrays.mean(part(1, k)), f"mean_{k}") for k in (5, 10)), *(integer(F.array_min(part(1, k)), f"best_{k}") for k in (5, 10)), (F.round(F.when(n >= 3, spread), 3) + F.lit(0.0)).alias("consistency"), real(trend, "trend"))


TIME_HISTORY = f"""{X}, p AS ({_prev("reduction")})
SELECT x.uid, {real_sql("avg(p.reduction) FILTER (k <= 5)", "mean_5")}, {real_sql("avg(p.reduction) FILTER (k <= 10)", "mean_10")}, (min(p.reduction) FILTER (k <= 5))::BIGINT AS best_5, (min(p.reduction) FILTER (k <= 10))::BIGINT AS best_10,
  round(CASE WHEN count(k) >= 3 THEN stddev_pop(p.reduction) END, 3) + 0.0 AS consistency, {real_sql("CASE WHEN count(k) >= 5 THEN avg(p.reduction) FILTER (k BETWEEN 4 AND 6) - avg(p.reduction) FILTER (k <= 3) END", "trend")}
FROM x LEFT JOIN p USING (uid) GROUP BY x.uid"""


def pace_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Over the last 20 runs of earlier days: shares of runs placed from a low draw (front) and from a high one (closer), the style they make, and whether the last three reductions beat the last ten."""
    last = pit.last_n_of_earlier_days(_runs(spark, sf), "horse", 20, ORDER, ["place", "draw", "reduction"])
    valid = F.filter("last", lambda x: x["place"].isNotNull())
    share = lambda c: F.try_divide(F.size(F.filter(valid, c)).cast("double"), F.size(valid))
    front, closer = share(lambda x: (x["draw"] <= 2) & (x["place"] <= 3)), share(lambda x: (x["draw"] > 4) & (x["place"] <= 3))
    style = F.when((front >= closer) & (front > 0), "front").when(closer > front, "closer").when(front.isNotNull(), "mid")
    times = arrays.present(F.transform("last", lambda x: x["reduction"]))
    three, ten = arrays.mean(F.slice(times, 1, 3)), arrays.mean(F.slice(times, 1, 10))
    trend = F.when(F.size(times) >= 4, F.when(F.round(three, 4) < F.round(ten, 4), "improving").when(F.round(three, 4) > F.round(ten, 4), "declining").otherwise("stable"))
    return last.select("uid", real(front, "front"), real(closer, "closer"), style.alias("style"), real(arrays.mean(F.slice(times, 1, 5)), "mean_5"), integer(F.array_min(F.slice(times, 1, 10)), "best_10"), trend.alias("trend"))


PACE_PROFILE = f"""{X}, p AS ({_prev()}), l AS (SELECT * FROM p WHERE k <= 20),
s AS (SELECT uid, avg((draw <= 2 AND place <= 3)::INTEGER) FILTER (place IS NOT NULL) AS front, avg((draw > 4 AND place <= 3)::INTEGER) FILTER (place IS NOT NULL) AS closer FROM l GROUP BY uid),
t AS (SELECT uid, reduction, row_number() OVER (PARTITION BY uid ORDER BY k) AS j FROM l WHERE reduction IS NOT NULL),
u AS (SELECT uid, count(*) AS n, avg(reduction) FILTER (j <= 5) AS m5, min(reduction) FILTER (j <= 10) AS b10, round(avg(reduction) FILTER (j <= 3), 4) AS m3, round(avg(reduction) FILTER (j <= 10), 4) AS m10 FROM t GROUP BY uid)
SELECT x.uid, {real_sql("front", "front")}, {real_sql("closer", "closer")}, CASE WHEN front >= closer AND front > 0 THEN 'front' WHEN closer > front THEN 'closer' WHEN front IS NOT NULL THEN 'mid' END AS style,
  {real_sql("m5", "mean_5")}, b10::BIGINT AS best_10, CASE WHEN n >= 4 THEN CASE WHEN m3 < m10 THEN 'improving' WHEN m3 > m10 THEN 'declining' ELSE 'stable' END END AS trend FROM x LEFT JOIN s USING (uid) LEFT JOIN u USING (uid)"""


def figure_history(spark: SparkSession, sf: str) -> DataFrame:
    """Speed figures before each run (best, mean and slope of the last five, this one against the last three), class ratings (mean of five, change, drop and rise by more than five), and odds (this one against the mean so far; sure if below four fifths of it)."""
    values = {f"h_{value}": (value, n) for value, n in (("figure", 5), ("rating", 5), ("price", 1))}
    r = pit.last_known_values(_runs(spark, sf), "horse", values, ORDER, lambda w: w.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1))
    f, c = F.col("h_figure"), F.col("h_rating")
    own = F.when(F.col("h_figure_n") >= 3, F.col("figure") - arrays.mean(F.slice(f, 1, 3)))
    change = F.round(F.col("rating") - F.get(c, F.lit(0)), 6)
    usual = F.try_divide(F.col("h_price_sum"), F.col("h_price_n"))
    flag = lambda x, name: integer(F.when(x.isNotNull(), x.cast("int")), name)
    fine = lambda x, name: (F.round(x, 9) + F.lit(0.0)).alias(name)
    return r.select(
        "uid", real(F.col("h_figure_max"), "figure_best"), real(arrays.mean(f), "figure_mean_5"), real(arrays.slope(F.reverse(f)), "figure_slope"), real(own, "figure_against_own"),
        fine(arrays.mean(c), "rating_mean_5"), real(change, "class_change"), flag(change < -5, "class_drop"), flag(change > 5, "class_rise"),
        fine(F.when(F.col("price").isNotNull(), usual), "usual_odds"), fine(F.col("price") - usual, "odds_against_usual"), flag(F.round(F.col("price") - usual * 0.8, 6) < 0, "sure"),
    )


FIGURE_HISTORY = f"""{X}, f AS ({_prev("figure", True)}), g AS (SELECT uid, max(figure) AS best, avg(figure) FILTER (k <= 5) AS m5, CASE WHEN count(*) FILTER (k <= 5) >= 2 THEN regr_slope(figure, -k) FILTER (k <= 5) END AS s, CASE WHEN count(*) >= 3 THEN avg(figure) FILTER (k <= 3) END AS m3 FROM f GROUP BY uid),
c AS ({_prev("rating", True)}), d AS (SELECT uid, avg(rating) FILTER (k <= 5) AS m5, max(rating) FILTER (k = 1) AS last FROM c GROUP BY uid),
o AS ({_prev("price", True)}), q AS (SELECT uid, avg(price) AS usual FROM o GROUP BY uid)
SELECT x.uid, {real_sql("g.best", "figure_best")}, {real_sql("g.m5", "figure_mean_5")}, {real_sql("g.s", "figure_slope")}, {real_sql("figure - g.m3", "figure_against_own")}, round(d.m5, 9) + 0.0 AS rating_mean_5, {real_sql("rating - last", "class_change")},
  (round(rating - last, 6) < -5)::BIGINT AS class_drop, (round(rating - last, 6) > 5)::BIGINT AS class_rise, round(CASE WHEN price IS NOT NULL THEN usual END, 9) + 0.0 AS usual_odds, round(price - usual, 9) + 0.0 AS odds_against_usual, (round(price - usual * 0.8, 6) < 0)::BIGINT AS sure
FROM x LEFT JOIN g USING (uid) LEFT JOIN d USING (uid) LEFT JOIN q USING (uid)"""

QUERIES = {f.__name__: f for f in (performance_windows, time_history, pace_profile, figure_history)}
ORACLES = {"performance_windows": PERFORMANCE_WINDOWS, "time_history": TIME_HISTORY, "pace_profile": PACE_PROFILE, "figure_history": FIGURE_HISTORY}
