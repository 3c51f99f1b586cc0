"""Queries over the point-in-time histories of entrants, actors, ancestors and pairs, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.operators import pit
from paceline.sources.tables import EVENTS_SQL, RUNNERS_SQL, TRACKS_SQL, events, runners, with_tracks

R, RT, E = f"WITH {RUNNERS_SQL}", f"WITH {TRACKS_SQL}", f"WITH {EVENTS_SQL}"
ORDER = ["day", "race", "no"]


def pit_actor_history(spark: SparkSession, sf: str) -> DataFrame:
    """Form of each entrant's horse on earlier days: runs, wins, places, rate, days since the last run."""
    r = runners(spark, sf)
    f = pit.strict_day("horse")
    out = pit.history(r, "horse", f, "horse").withColumn("days_since", F.col("day") - F.max("day").over(f))
    return out.select("uid", "horse_runs", "horse_wins", "horse_places", "horse_win_rate", F.col("days_since").cast("long").alias("days_since"))


PIT_ACTOR_HISTORY = f"""{R}
SELECT uid, count(*) OVER w AS horse_runs, coalesce(sum(won) OVER w, 0)::BIGINT AS horse_wins, coalesce(sum(placed) OVER w, 0)::BIGINT AS horse_places,
  CASE WHEN count(*) OVER w > 0 THEN (sum(won) OVER w)::DOUBLE / count(*) OVER w END AS horse_win_rate, (day - max(day) OVER w)::BIGINT AS days_since
FROM r WINDOW w AS (PARTITION BY horse ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def form_last_n(spark: SparkSession, sf: str) -> DataFrame:
    """Last-5 form over earlier days: wins, mean position, best and worst, trend of the last 3."""
    last = pit.last_n_of_earlier_days(runners(spark, sf), "horse", 5, ORDER, ["won", "position", "gains"])
    pos = F.transform("last", lambda x: x["position"])
    total = lambda c: F.aggregate("last", F.lit(0).cast("long"), lambda a, x: a + x[c])
    three = F.slice(pos, 1, 3)
    trend = F.when(F.size(three) > 1, (F.get(three, F.lit(0)) - F.element_at(three, -1)) / (F.size(three) - 1))
    n = F.size("last")
    return last.select("uid", n.cast("long").alias("n_last"), total("won").alias("wins_last"), total("gains").alias("gains_last"), F.when(n > 0, total("position") / n).alias("mean_position"), F.array_min(pos).alias("best"), F.array_max(pos).alias("worst"), F.when(trend < -0.5, "improving").when(trend > 0.5, "declining").when(trend.isNotNull(), "stable").alias("trend"))


FORM_LAST_N = f"""{R},
prev AS (SELECT a.uid, b.won, b.position, b.gains, row_number() OVER (PARTITION BY a.uid ORDER BY b.day DESC, b.race DESC, b.no DESC) AS k FROM r AS a JOIN r AS b ON a.horse = b.horse AND b.day < a.day),
g AS (SELECT uid, count(*) FILTER (k <= 5) AS n, sum(won) FILTER (k <= 5) AS w, sum(gains) FILTER (k <= 5) AS g, sum(position) FILTER (k <= 5) AS p, min(position) FILTER (k <= 5) AS best, max(position) FILTER (k <= 5) AS worst,
  CASE WHEN count(*) > 1 THEN (max(position) FILTER (k = 1) - max(position) FILTER (k = least(3, n_all))) / (least(3, n_all) - 1)::DOUBLE END AS t
  FROM (SELECT *, count(*) OVER (PARTITION BY uid) AS n_all FROM prev) GROUP BY uid, n_all)
SELECT uid, coalesce(n, 0) AS n_last, coalesce(w, 0)::BIGINT AS wins_last, coalesce(g, 0)::BIGINT AS gains_last, p::DOUBLE / n AS mean_position, best, worst,
  CASE WHEN t < -0.5 THEN 'improving' WHEN t > 0.5 THEN 'declining' WHEN t IS NOT NULL THEN 'stable' END AS trend FROM r LEFT JOIN g USING (uid)"""


def rolling_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rolling statistics of the last 3 and 10 rows before each event, whatever their day."""
    e = events(spark, sf)
    cols = {}
    for n in (3, 10):
        w = pit.sequential("entity", "ts", last=n)
        cols |= {f"n{n}": F.count(F.lit(1)).over(w), f"k_sum{n}": F.coalesce(F.sum("k").over(w), F.lit(0)), f"k_mean{n}": F.avg("k").over(w), f"k_min{n}": F.min("k").over(w), f"k_max{n}": F.max("k").over(w), f"k_sd{n}": F.round(F.stddev_samp("k").over(w), 6), f"k_sdp{n}": F.round(F.stddev_pop("k").over(w), 6)}
    return e.select("event_id", *(c.alias(n) for n, c in cols.items()))


ROLLING_ROWS = f"""{E}
SELECT event_id, {", ".join(f"count(*) OVER w{n} AS n{n}, coalesce(sum(k) OVER w{n}, 0)::BIGINT AS k_sum{n}, avg(k) OVER w{n} AS k_mean{n}, min(k) OVER w{n} AS k_min{n}, max(k) OVER w{n} AS k_max{n}, round(stddev_samp(k) OVER w{n}, 6) AS k_sd{n}, round(stddev_pop(k) OVER w{n}, 6) AS k_sdp{n}" for n in (3, 10))}
FROM e WINDOW {", ".join(f"w{n} AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (3, 10))}"""


def trailing_days(spark: SparkSession, sf: str) -> DataFrame:
    """Jockey and trainer form over the 30, 90 and 365 days before each start."""

    def build(df: DataFrame, actor: str) -> DataFrame:
        out = pit.daily_histories(df, [actor], {f"_{d}": d for d in (30, 90, 365)}, {"gains": "gains"})
        return out.withColumnsRenamed({f"_{d}_{m}": f"{actor}_{m}_{d}" for d in (30, 90, 365) for m in ("runs", "wins", "gains")}).drop(*(f"_{d}_win_rate" for d in (30, 90, 365)))

    actors = ["jockey", "trainer"]
    return pit.per_actor(build, runners(spark, sf), actors).select("uid", *(f"{a}_{m}_{d}" for a in actors for d in (30, 90, 365) for m in ("runs", "wins", "gains")))


TRAILING_DAYS = f"""{R}
SELECT uid, {", ".join(f"count(*) OVER {a}{d} AS {a}_runs_{d}, coalesce(sum(won) OVER {a}{d}, 0)::BIGINT AS {a}_wins_{d}, coalesce(sum(gains) OVER {a}{d}, 0)::BIGINT AS {a}_gains_{d}" for a in ("jockey", "trainer") for d in (30, 90, 365))}
FROM r WINDOW {", ".join(f"{a}{d} AS (PARTITION BY {a} ORDER BY day RANGE BETWEEN {d} PRECEDING AND 1 PRECEDING)" for a in ("jockey", "trainer") for d in (30, 90, 365))}"""


def win_streak(spark: SparkSession, sf: str) -> DataFrame:
    """Winning and placing streaks and runs since the last win, over earlier days."""
    r = runners(spark, sf)
    r = pit.streak(r, "jockey", ORDER, "placed", "place_streak")
    r = pit.streak(r, "jockey", ORDER, "won", "win_streak")
    return pit.rows_since(r, "jockey", ORDER, "won", "since_win").select("uid", "place_streak", "win_streak", "since_win")


WIN_STREAK = f"""{R}, n AS (SELECT *, row_number() OVER (PARTITION BY jockey ORDER BY day, race, no) AS rn FROM r)
SELECT uid, {", ".join(f"(coalesce(max(rn) OVER w, 0) - coalesce(max(CASE WHEN {h} = 0 THEN rn END) OVER w, 0))::INTEGER AS {o}" for h, o in (("placed", "place_streak"), ("won", "win_streak")))},
  (max(rn) OVER w - max(CASE WHEN won = 1 THEN rn END) OVER w)::INTEGER AS since_win
FROM n WINDOW w AS (PARTITION BY jockey ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def running_distinct_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct horses of a trainer and of a jockey and trainers of a horse so far: typed degrees of the relation graph."""
    r = pit.running_distinct(runners(spark, sf), "trainer", "horse", ORDER, "trainer_horses")
    r = pit.running_distinct(r, "horse", "trainer", ORDER, "horse_trainers")
    r = pit.running_distinct(r, "jockey", "horse", ORDER, "jockey_horses")
    return r.select("uid", "trainer_horses", "horse_trainers", "jockey_horses", (F.col("horse_trainers") == 0).cast("int").alias("debut"))


RUNNING_DISTINCT = f"""{R}, f AS (SELECT *, {", ".join(f"(row_number() OVER (PARTITION BY {a}, {b} ORDER BY day, race, no) = 1)::INTEGER AS f_{a}_{b}" for a, b in (("trainer", "horse"), ("horse", "trainer"), ("jockey", "horse")))} FROM r)
SELECT uid, {", ".join(f"coalesce(sum(f_{a}_{b}) OVER (PARTITION BY {a} ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS {o}" for a, b, o in (("trainer", "horse", "trainer_horses"), ("horse", "trainer", "horse_trainers"), ("jockey", "horse", "jockey_horses")))},
  (coalesce(sum(f_horse_trainer) OVER (PARTITION BY horse ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0)::INTEGER AS debut FROM f"""


def career_age(spark: SparkSession, sf: str) -> DataFrame:
    """Career so far: days since the first run, mean distance, number of distances, spread of positions, earnings."""
    f = pit.strict_day("horse")
    return runners(spark, sf).select("uid", (F.col("day") - F.min("day").over(f)).cast("long").alias("career_days"), F.avg("distance").over(f).alias("mean_distance"), F.size(F.collect_set("distance").over(f)).cast("long").alias("n_distances"), F.round(F.stddev_samp("position").over(f), 6).alias("regularity"), F.sum("gains").over(f).alias("career_gains"))


CAREER_AGE = f"""{R} SELECT uid, (day - min(day) OVER w)::BIGINT AS career_days, avg(distance) OVER w AS mean_distance, count(DISTINCT distance) OVER w AS n_distances, round(stddev_samp(position) OVER w, 6) AS regularity, (sum(gains) OVER w)::BIGINT AS career_gains
FROM r WINDOW w AS (PARTITION BY horse ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def progression_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of the last 5 against the 5 before, slope of the last 10, momentum of adjacent thirds."""
    e = events(spark, sf).withColumn("rn", F.row_number().over(Window.partitionBy("entity").orderBy("ts")))
    recent, older = pit.sequential("entity", "ts", last=5), pit.sequential("entity", "ts", last=5, skip=5)
    ten = pit.sequential("entity", "ts", last=10)
    a, b = F.avg("k").over(recent), F.avg("k").over(older)
    return e.select("event_id", (F.round(a - b, 6) + F.lit(0.0)).alias("progression"), (F.round(pit.slope(F.col("k"), F.col("rn"), ten), 6) + F.lit(0.0)).alias("slope10"), F.when(a > b, 1).when(a < b, -1).when(a == b, 0).alias("direction"))


PROGRESSION_TREND = f"""{E}, n AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ts) AS rn FROM e)
SELECT event_id, round(avg(k) OVER a - avg(k) OVER b, 6) + 0.0 AS progression, round(regr_slope(k, rn) OVER t, 6) + 0.0 AS slope10, sign(avg(k) OVER a - avg(k) OVER b)::INTEGER AS direction
FROM n WINDOW a AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), b AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 10 PRECEDING AND 6 PRECEDING), t AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)"""


def jt_combo_synergy(spark: SparkSession, sf: str) -> DataFrame:
    """Pair record so far against the mean of its members' rates, and whether the pair is new."""
    r = runners(spark, sf)
    for keys, name in ((["jockey", "trainer"], "pair"), (["jockey"], "j"), (["trainer"], "t")):
        w = pit.sequential(keys, *ORDER)
        r = r.withColumns({f"{name}_n": F.count(F.lit(1)).over(w), f"{name}_w": F.coalesce(F.sum("won").over(w), F.lit(0))}).withColumn(f"{name}_rate", pit.rate(F.col(f"{name}_w"), F.col(f"{name}_n")))
    mean = (F.col("j_rate") + F.col("t_rate")) / 2
    return r.select("uid", "pair_n", "pair_w", (F.col("pair_n") == 0).cast("int").alias("new_pair"), F.round(F.when(mean > 0, F.col("pair_rate") / mean), 6).alias("synergy"))


JT_COMBO = f"""{R}, x AS (SELECT uid, {", ".join(f"count(*) OVER {n} AS {n}_n, coalesce(sum(won) OVER {n}, 0) AS {n}_w" for n in ("pair", "j", "t"))} FROM r
WINDOW pair AS (PARTITION BY jockey, trainer ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), j AS (PARTITION BY jockey ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), t AS (PARTITION BY trainer ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
y AS (SELECT *, (j_w::DOUBLE / nullif(j_n, 0) + t_w::DOUBLE / nullif(t_n, 0)) / 2 AS m FROM x)
SELECT uid, pair_n, pair_w::BIGINT AS pair_w, (pair_n = 0)::INTEGER AS new_pair, round(CASE WHEN m > 0 THEN pair_w::DOUBLE / nullif(pair_n, 0) / m END, 6) AS synergy FROM y"""


def context_affinity(spark: SparkSession, sf: str) -> DataFrame:
    """Rates of a horse by track, discipline and distance band so far, with specialist flags."""
    r = with_tracks(runners(spark, sf), spark, sf).withColumn("band", F.floor(F.col("distance") / 600).cast("int"))
    for c in ("track", "discipline", "band"):
        r = pit.history(r, "horse", pit.strict_day(["horse", c]), c)
    flag = lambda c: (F.coalesce(F.col(f"{c}_runs") >= 2, F.lit(False)) & (F.coalesce(F.col(f"{c}_win_rate"), F.lit(0.0)) > 0.25)).cast("int").alias(f"{c}_specialist")
    return r.select("uid", *(f"{c}_{m}" for c in ("track", "discipline", "band") for m in ("runs", "wins")), *map(flag, ("track", "discipline", "band")))


CONTEXT_AFFINITY = f"""{RT}, b AS (SELECT *, (distance // 600)::INTEGER AS band FROM rt), x AS (SELECT uid, {", ".join(f"count(*) OVER {c} AS {c}_runs, coalesce(sum(won) OVER {c}, 0)::BIGINT AS {c}_wins" for c in ("track", "discipline", "band"))}
FROM b WINDOW {", ".join(f"{c} AS (PARTITION BY horse, b.{c} ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in ("track", "discipline", "band"))})
SELECT *, {", ".join(f"({c}_runs >= 2 AND {c}_wins::DOUBLE / {c}_runs > 0.25)::INTEGER AS {c}_specialist" for c in ("track", "discipline", "band"))} FROM x"""


def sire_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Offspring record of the sire on earlier days, and of sire and discipline, with a minimum sample."""
    r = with_tracks(runners(spark, sf), spark, sf).select("uid", "day", "sire", "discipline", "won")
    r = pit.daily_histories_of(r, {"sire": ["sire"], "nick": ["sire", "discipline"]})
    return r.select("uid", "sire_runs", "sire_wins", F.when(F.col("sire_runs") >= 3, F.col("sire_win_rate")).alias("sire_rate"), "nick_runs", "nick_wins", F.when(F.col("nick_runs") >= 2, F.col("nick_win_rate")).alias("nick_rate"))


SIRE_STATS = f"""{RT}, x AS (SELECT uid, count(*) OVER s AS sire_runs, coalesce(sum(won) OVER s, 0)::BIGINT AS sire_wins, count(*) OVER n AS nick_runs, coalesce(sum(won) OVER n, 0)::BIGINT AS nick_wins FROM rt
WINDOW s AS (PARTITION BY sire ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), n AS (PARTITION BY sire, discipline ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT *, CASE WHEN sire_runs >= 3 THEN sire_wins::DOUBLE / sire_runs END AS sire_rate, CASE WHEN nick_runs >= 2 THEN nick_wins::DOUBLE / nick_runs END AS nick_rate FROM x"""


def track_bias_365(spark: SparkSession, sf: str) -> DataFrame:
    """Draw bias of a track over the year before: observed minus expected win rate of the same draw, from 5 runs."""
    r = with_tracks(runners(spark, sf), spark, sf).withColumn("share", 1.0 / F.count(F.lit(1)).over(Window.partitionBy("race")))
    r = pit.daily_history(r, ["track", "draw"], "b", {"expected": "share"}, days=365)
    n = F.col("b_runs")
    return r.select("uid", n.alias("n_draw"), F.round(F.when(n >= 5, (F.col("b_wins") - F.col("b_expected")) / n), 6).alias("draw_bias"))


TRACK_BIAS = f"""{RT}, s AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY race) AS share FROM rt)
SELECT uid, count(*) OVER w AS n_draw, round(CASE WHEN count(*) OVER w >= 5 THEN (sum(won) OVER w - sum(share) OVER w) / count(*) OVER w END, 6) AS draw_bias
FROM s WINDOW w AS (PARTITION BY track, draw ORDER BY day RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING)"""


def optimal_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Best distance band of a horse so far (two runs or more, the first seen wins ties), and whether today's is it."""
    r = runners(spark, sf).withColumn("band", F.floor(F.col("distance") / 600).cast("int"))
    out = pit.best_context(r.select("uid", *ORDER, "horse", "band", "won"), "horse", "band", ORDER, "uid")
    return out.select("uid", F.col("best_context").alias("best_band"), "best_rate", (F.col("best_context") == F.col("band")).cast("int").alias("at_best"))


OPTIMAL_DISTANCE = f"""{R}, b AS (SELECT *, (distance // 600)::INTEGER AS band FROM r),
h AS (SELECT a.uid, p.band AS ctx, count(*) AS n, sum(p.won) AS w, min((p.day, p.race, p.no)) AS seen FROM b AS a JOIN b AS p ON a.horse = p.horse AND (p.day, p.race, p.no) < (a.day, a.race, a.no) GROUP BY a.uid, p.band HAVING count(*) >= 2),
k AS (SELECT *, w::DOUBLE / n AS rate, row_number() OVER (PARTITION BY uid ORDER BY w::DOUBLE / n DESC, seen) AS k FROM h)
SELECT b.uid, ctx AS best_band, rate AS best_rate, (ctx = band)::INTEGER AS at_best FROM b LEFT JOIN (SELECT * FROM k WHERE k = 1) AS k ON b.uid = k.uid"""


def band_distance_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Record of the horse within 200 m of today's distance, on earlier days."""
    r = runners(spark, sf).select("uid", "horse", "day", "distance", "won", "position")
    out = pit.band_history(r, "horse", "distance", 200, {"n": F.count(F.lit(1)), "w": F.sum("past_won"), "p": F.avg("past_position")}, "uid")
    n = F.coalesce("n", F.lit(0))
    return out.select("uid", n.alias("n_near"), F.coalesce("w", F.lit(0)).alias("wins_near"), pit.rate(F.col("w"), n).alias("rate_near"), F.col("p").alias("mean_position_near"))


BAND_DISTANCE = f"""{R} SELECT a.uid, count(b.uid) AS n_near, coalesce(sum(b.won), 0)::BIGINT AS wins_near, sum(b.won)::DOUBLE / nullif(count(b.uid), 0) AS rate_near, avg(b.position) AS mean_position_near
FROM r AS a LEFT JOIN r AS b ON a.horse = b.horse AND b.day < a.day AND abs(a.distance - b.distance) <= 200 GROUP BY a.uid"""


def asof_rating(spark: SparkSession, sf: str) -> DataFrame:
    """For each purchase, the entity's newest view strictly before it."""
    e = events(spark, sf)
    buys = e.where("kind = 'purchase'").select("event_id", "entity", "ts")
    views = e.where("kind = 'view'").select("entity", "ts", F.col("event_id").alias("view_id"), F.col("k").alias("view_k"))
    return pit.as_of(buys, views, "entity", "ts", "ts", ["view_id", "view_k"]).select("event_id", "view_id", "view_k")


ASOF_RATING = f"""{E} SELECT b.event_id, v.event_id AS view_id, v.k AS view_k FROM (SELECT * FROM e WHERE kind = 'purchase') AS b ASOF LEFT JOIN (SELECT * FROM e WHERE kind = 'view') AS v ON b.entity = v.entity AND b.ts > v.ts"""


def seasonal_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Record by season and weekday so far."""
    m = F.month("race_date")
    season = F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring").when(m.isin(6, 7, 8), "summer").otherwise("autumn")
    r = runners(spark, sf).withColumns({"season": season, "weekday": F.weekday("race_date")})
    for c in ("season", "weekday"):
        w = pit.sequential(["jockey", c], *ORDER)
        r = r.withColumns({f"{c}_n": F.count(F.lit(1)).over(w), f"{c}_w": F.coalesce(F.sum("won").over(w), F.lit(0))})
    return r.select("uid", "season", F.col("weekday").cast("int").alias("weekday"), "season_n", "season_w", "weekday_n", "weekday_w")


SEASONAL_RATE = f"""{R}, s AS (SELECT *, CASE WHEN month(race_date) IN (12, 1, 2) THEN 'winter' WHEN month(race_date) IN (3, 4, 5) THEN 'spring' WHEN month(race_date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season, (isodow(race_date) - 1)::INTEGER AS weekday FROM r)
SELECT uid, season, weekday, {", ".join(f"count(*) OVER w_{c} AS {c}_n, coalesce(sum(won) OVER w_{c}, 0)::BIGINT AS {c}_w" for c in ("season", "weekday"))}
FROM s WINDOW {", ".join(f"w_{c} AS (PARTITION BY jockey, s.{c} ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in ("season", "weekday"))}"""


def seq_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """The last 5 positions, distances and rest gaps as text, with runs of equal results."""
    w = pit.sequential("horse", *ORDER, last=5)
    r = runners(spark, sf).withColumns({"seq": F.collect_list(F.struct("position", "distance", "day")).over(w)})
    gaps = F.zip_with(F.slice("seq", 2, 5), F.slice("seq", 1, 5), lambda b, a: b["day"] - a["day"])
    gaps = F.filter(gaps, lambda g: g.isNotNull())
    text = lambda a: F.array_join(F.transform(a, lambda v: v.cast("string")), "-")
    return r.select("uid", text(F.transform("seq", lambda x: x["position"])).alias("positions"), text(F.transform("seq", lambda x: x["distance"])).alias("distances"), text(gaps).alias("gaps"), F.size("seq").cast("long").alias("n_seq"))


SEQ_ARRAYS = f"""{R}, x AS (SELECT uid, list({{'p': position, 'd': distance, 'y': day}}) OVER (PARTITION BY horse ORDER BY day, race, no ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS s FROM r)
SELECT uid, coalesce(array_to_string([v.p FOR v IN s], '-'), '') AS positions, coalesce(array_to_string([v.d FOR v IN s], '-'), '') AS distances,
  coalesce(array_to_string([s[i + 1].y - s[i].y FOR i IN range(1, len(s))], '-'), '') AS gaps, coalesce(len(s), 0) AS n_seq FROM x"""


def slope_momentum(spark: SparkSession, sf: str) -> DataFrame:
    """Momentum: slope of the 3 rows before the last 3, minus that of the last 3."""
    e = events(spark, sf).withColumn("rn", F.row_number().over(Window.partitionBy("entity").orderBy("ts")))
    a, b = pit.sequential("entity", "ts", last=3), pit.sequential("entity", "ts", last=3, skip=3)
    return e.select("event_id", (F.round(pit.slope(F.col("k"), F.col("rn"), b) - pit.slope(F.col("k"), F.col("rn"), a), 6) + F.lit(0.0)).alias("momentum"))


SLOPE_MOMENTUM = f"""{E}, n AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ts) AS rn FROM e)
SELECT event_id, round(regr_slope(k, rn) OVER b - regr_slope(k, rn) OVER a, 6) + 0.0 AS momentum FROM n
WINDOW a AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), b AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 4 PRECEDING)"""


def equipment_change(spark: SparkSession, sf: str) -> DataFrame:
    """Changes against the horse's previous run: equipment, discipline, distance, weight, jockey; first time with an equipment."""
    w = pit.in_order("horse", *ORDER)
    r = runners(spark, sf)
    changed = lambda c: F.when(F.lag(c).over(w).isNotNull(), (F.col(c) != F.lag(c).over(w)).cast("int")).alias(f"{c}_changed")
    first = (F.row_number().over(pit.in_order(["horse", "equipment"], *ORDER)) == 1).cast("int")
    return r.select("uid", *map(changed, ("equipment", "discipline", "jockey")), (F.col("distance") - F.lag("distance").over(w)).alias("distance_step"), (F.col("weight") - F.lag("weight").over(w)).alias("weight_step"), (F.col("day") - F.lag("day").over(w)).cast("long").alias("rest_days"), first.alias("first_time"))


EQUIPMENT_CHANGE = f"""{R} SELECT uid, {", ".join(f"({c} <> lag({c}) OVER w)::INTEGER AS {c}_changed" for c in ("equipment", "discipline", "jockey"))}, distance - lag(distance) OVER w AS distance_step, weight - lag(weight) OVER w AS weight_step, (day - lag(day) OVER w)::BIGINT AS rest_days,
  (row_number() OVER (PARTITION BY horse, equipment ORDER BY day, race, no) = 1)::INTEGER AS first_time FROM r WINDOW w AS (PARTITION BY horse ORDER BY day, race, no)"""


def entity_snapshot_global(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-career totals on every row: looks ahead by design, hence the name."""
    r = runners(spark, sf)
    g = r.groupBy(F.col("horse").alias("of")).agg(F.count(F.lit(1)).alias("global_runs"), F.sum("won").alias("global_wins"), F.sum("gains").alias("global_gains"))
    return r.select("uid", "horse").join(g, F.col("horse").eqNullSafe(F.col("of")), "left").select("uid", "global_runs", "global_wins", "global_gains")


ENTITY_SNAPSHOT = f"""{R} SELECT uid, count(*) OVER w AS global_runs, (sum(won) OVER w)::BIGINT AS global_wins, (sum(gains) OVER w)::BIGINT AS global_gains FROM r WINDOW w AS (PARTITION BY horse)"""

QUERIES = {f.__name__: f for f in (pit_actor_history, form_last_n, rolling_rows, trailing_days, win_streak, running_distinct_tracks, career_age, progression_trend, jt_combo_synergy, context_affinity, sire_stats, track_bias_365, optimal_distance, band_distance_rate, asof_rating, seasonal_rate, seq_arrays, slope_momentum, equipment_change, entity_snapshot_global)}
ORACLES = dict(zip(QUERIES, (PIT_ACTOR_HISTORY, FORM_LAST_N, ROLLING_ROWS, TRAILING_DAYS, WIN_STREAK, RUNNING_DISTINCT, CAREER_AGE, PROGRESSION_TREND, JT_COMBO, CONTEXT_AFFINITY, SIRE_STATS, TRACK_BIAS, OPTIMAL_DISTANCE, BAND_DISTANCE, ASOF_RATING, SEASONAL_RATE, SEQ_ARRAYS, SLOPE_MOMENTUM, EQUIPMENT_CHANGE, ENTITY_SNAPSHOT), strict=True))
