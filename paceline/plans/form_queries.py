"""Queries over form: windows of runs and days, pairs, changes, rest, ancestors and contexts, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.functions import scalars
from paceline.operators import pit
from paceline.sources.tables import RUNNERS_SQL, TRACKS_SQL, runners, with_tracks

R, RT = f"WITH {RUNNERS_SQL}", f"WITH {TRACKS_SQL}"
ORDER = ["day", "race", "no"]
#: A run that didn't finish: the tables have no such flag, so the last draw stands for it.
DNF = "draw = 7"


def integer(c: Column, name: str) -> Column:
    return c.cast("long").alias(name)


def real(c: Column, name: str) -> Column:
    """A value rounded for comparison as the SQL rounds it (the product with 10^6 to a whole number, then divided), without negative zeros.

    ``round(c, 6)`` goes by the decimal digits, which puts 803 / 3200 on the other side.
    """
    return (F.round(c.cast("double") * F.lit(1e6)) / F.lit(1e6) + F.lit(0.0)).alias(name)


def real_sql(x: str, name: str) -> str:
    return f"round(({x})::DOUBLE, 6) + 0.0 AS {name}"


def form_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Form over the last 3, 5, 10 and 20 runs of earlier days: win and place rates, mean position, earnings, non-finishers, odds, best, worst, share of top 3."""
    r = runners(spark, sf).withColumns({"dnf": F.expr(DNF).cast("int"), "cents": F.round(F.col("odds") * 100).cast("long")})
    figures, cols = {}, []
    for n in (3, 5, 10, 20):
        figures |= {f"_runs_{n}": (n, F.count(F.lit(1))), f"_gains_{n}": (n, F.sum("gains")), f"_best_{n}": (n, F.min("position")), f"_worst_{n}": (n, F.max("position"))}
        figures |= {f"_{c}_{n}": (n, F.avg(c)) for c in ("won", "placed", "position", "dnf", "cents")}
        mean = lambda c, n=n: F.col(f"_{c}_{n}")
        cols += [integer(F.col(f"_runs_{n}"), f"runs_{n}"), real(mean("won"), f"win_rate_{n}"), real(mean("placed"), f"place_rate_{n}"), real(mean("position"), f"mean_position_{n}"), integer(F.coalesce(f"_gains_{n}", F.lit(0)), f"gains_{n}"), real(mean("dnf"), f"dnf_rate_{n}"), real(mean("cents") / 100, f"mean_odds_{n}"), integer(F.col(f"_best_{n}"), f"best_{n}"), integer(F.col(f"_worst_{n}"), f"worst_{n}")]
    return pit.of_earlier_days(r, "horse", ORDER, figures).select("uid", *cols)


FORM_WINDOWS = f"""{R},
prev AS (SELECT a.uid, b.won, b.placed, b.position, b.gains, (b.{DNF})::INTEGER AS dnf, round(b.odds * 100)::BIGINT AS cents, row_number() OVER (PARTITION BY a.uid ORDER BY b.day DESC, b.race DESC, b.no DESC) AS k FROM r AS a JOIN r AS b ON a.horse = b.horse AND b.day < a.day)
SELECT r.uid, {", ".join(f"count(k) FILTER (k <= {n}) AS runs_{n}, {real_sql(f'avg(prev.won) FILTER (k <= {n})', f'win_rate_{n}')}, {real_sql(f'avg(prev.placed) FILTER (k <= {n})', f'place_rate_{n}')}, {real_sql(f'avg(prev.position) FILTER (k <= {n})', f'mean_position_{n}')}, coalesce(sum(prev.gains) FILTER (k <= {n}), 0)::BIGINT AS gains_{n}, {real_sql(f'avg(dnf) FILTER (k <= {n})', f'dnf_rate_{n}')}, {real_sql(f'avg(cents) FILTER (k <= {n}) / 100', f'mean_odds_{n}')}, (min(prev.position) FILTER (k <= {n}))::BIGINT AS best_{n}, (max(prev.position) FILTER (k <= {n}))::BIGINT AS worst_{n}" for n in (3, 5, 10, 20))}
FROM r LEFT JOIN prev USING (uid) GROUP BY r.uid"""


def form_sequential(spark: SparkSession, sf: str) -> DataFrame:
    """Form over the 5, 10 and 20 runs before each run, those of its own day included: counts, rates, finish share, earnings, positions and their deviation."""
    r = runners(spark, sf).withColumn("dnf", F.expr(DNF).cast("int"))
    cols = []
    for n in (5, 10, 20):
        w = pit.sequential("horse", *ORDER, last=n)
        runs = F.count(F.lit(1)).over(w)
        cols += [integer(runs, f"runs_{n}"), integer(F.coalesce(F.sum("won").over(w), F.lit(0)), f"wins_{n}"), integer(F.coalesce(F.sum("placed").over(w), F.lit(0)), f"places_{n}"), real(F.avg("won").over(w), f"win_rate_{n}"), real(1 - F.avg("dnf").over(w), f"finish_share_{n}"), integer(F.coalesce(F.sum("gains").over(w), F.lit(0)), f"gains_{n}"), real(F.avg("position").over(w), f"mean_{n}"), integer(F.min("position").over(w), f"best_{n}"), integer(F.max("position").over(w), f"worst_{n}"), real(F.stddev_pop("position").over(w), f"sd_{n}")]
    return r.select("uid", *cols)


FORM_SEQUENTIAL = f"""{R} SELECT uid, {", ".join(f"count(*) OVER w{n} AS runs_{n}, coalesce(sum(won) OVER w{n}, 0)::BIGINT AS wins_{n}, coalesce(sum(placed) OVER w{n}, 0)::BIGINT AS places_{n}, {real_sql(f'avg(won) OVER w{n}', f'win_rate_{n}')}, {real_sql(f'1 - avg(({DNF})::INTEGER) OVER w{n}', f'finish_share_{n}')}, coalesce(sum(gains) OVER w{n}, 0)::BIGINT AS gains_{n}, {real_sql(f'avg(position) OVER w{n}', f'mean_{n}')}, (min(position) OVER w{n})::BIGINT AS best_{n}, (max(position) OVER w{n})::BIGINT AS worst_{n}, {real_sql(f'stddev_pop(position) OVER w{n}', f'sd_{n}')}" for n in (5, 10, 20))}
FROM r WINDOW {", ".join(f"w{n} AS (PARTITION BY horse ORDER BY day, race, no ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (5, 10, 20))}"""


def form_days(spark: SparkSession, sf: str) -> DataFrame:
    """Runs, earnings and win rate over the 30, 60, 90 and 180 days before each run, its own day's earlier runs included."""
    r = runners(spark, sf)
    alone = pit.of("horse", *ORDER)
    rest = pit.of(["horse", "day"], *ORDER).orderBy("race", "no").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cols = []
    for d in (30, 60, 90, 180):
        w = alone.orderBy("day").rangeBetween(-d, 0)
        so_far = lambda c, w=w: F.sum(c).over(w) - F.sum(c).over(rest)
        runs = F.count(F.lit(1)).over(w) - F.count(F.lit(1)).over(rest)
        cols += [integer(runs, f"runs_{d}"), integer(so_far("gains"), f"gains_{d}"), real(F.when(runs > 0, so_far("won") / runs), f"win_rate_{d}")]
    return r.select("uid", *cols)


FORM_DAYS = f"""{R} SELECT a.uid, {", ".join(f"count(b.uid) FILTER (b.day >= a.day - {d}) AS runs_{d}, coalesce(sum(b.gains) FILTER (b.day >= a.day - {d}), 0)::BIGINT AS gains_{d}, {real_sql(f'avg(b.won) FILTER (b.day >= a.day - {d})', f'win_rate_{d}')}" for d in (30, 60, 90, 180))}
FROM r AS a LEFT JOIN r AS b ON a.horse = b.horse AND b.day >= a.day - 180 AND (b.day, b.race, b.no) < (a.day, a.race, a.no) GROUP BY a.uid"""

PAIRS = {"jt": ("jockey", "trainer"), "jh": ("jockey", "horse"), "th": ("trainer", "horse"), "jk": ("jockey", "track"), "tk": ("trainer", "track"), "jd": ("jockey", "band"), "td": ("trainer", "band")}


def pair_histories(spark: SparkSession, sf: str) -> DataFrame:
    """Runs, wins and win rate of seven pairs on earlier days, whether the pair is new, and whether the horse's jockey changed."""
    r = with_tracks(runners(spark, sf), spark, sf).withColumn("band", scalars.distance_band(F.col("distance"), "E"))
    r = pit.gathered(r.select("uid", *ORDER, "horse", "jockey", "trainer", "track", "band", "won"), "horse", *ORDER)
    r = r.withColumn("changed", F.lag("jockey").over(pit.inside("horse").orderBy(*ORDER)) != F.col("jockey"))
    for entity, pairs in (("horse", ("jh", "th")), ("jockey", ("jt", "jk", "jd")), ("trainer", ("tk", "td"))):
        other = {p: next(k for k in PAIRS[p] if k != entity) for p in pairs}
        r = pit.histories_inside(r, entity, other, *ORDER)
    rate = lambda p: pit.rate(F.col(f"{p}_wins"), F.col(f"{p}_runs"))
    cols = [c for p in PAIRS for c in (integer(F.col(f"{p}_runs"), f"{p}_runs"), integer(F.col(f"{p}_wins"), f"{p}_wins"), real(rate(p), f"{p}_rate"), integer((F.col(f"{p}_runs") == 0).cast("int"), f"{p}_new"))]
    return r.select("uid", *cols, integer(F.col("changed").cast("int"), "jockey_changed"))


BAND_SQL = "CASE WHEN distance < 1400 THEN 'sprint' WHEN distance < 1800 THEN 'mile' WHEN distance < 2200 THEN 'middle' WHEN distance < 2800 THEN 'long' ELSE 'marathon' END"
PAIR_HISTORIES = f"""{RT}, x AS (SELECT *, {BAND_SQL} AS band FROM rt)
SELECT uid, {", ".join(f"count(*) OVER {p} AS {p}_runs, coalesce(sum(won) OVER {p}, 0)::BIGINT AS {p}_wins, {real_sql(f'avg(won) OVER {p}', f'{p}_rate')}, (count(*) OVER {p} = 0)::BIGINT AS {p}_new" for p in PAIRS)},
  (lag(jockey) OVER (PARTITION BY horse ORDER BY day, race, no) <> jockey)::BIGINT AS jockey_changed
FROM x WINDOW {", ".join(f"{p} AS (PARTITION BY {a}, {b} ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for p, (a, b) in PAIRS.items())}"""


def duo_affinity(spark: SparkSession, sf: str) -> DataFrame:
    """Horse with jockey before each run: the pair's win rate over the mean of both own rates; the trainer's tracks seen and whether a specialist of this one."""
    r = with_tracks(runners(spark, sf), spark, sf).select("uid", *ORDER, "horse", "jockey", "trainer", "track", "won")
    w = lambda *k: pit.inside(*k).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    own = lambda k, value, none=None: F.when(pit.known(list(k)), value).otherwise(F.lit(none))
    duo, home = ("horse", "jockey"), ("trainer", "track")
    r = pit.gathered(r, "horse", *ORDER).withColumns({"duo_runs": own(duo, F.count(F.lit(1)).over(w(*duo)), 0), "duo_rate": own(duo, F.avg("won").over(w(*duo))), "horse_rate": F.avg("won").over(w("horse"))})
    r = pit.gathered(r.drop("_alone"), "jockey", *ORDER).withColumn("jockey_rate", F.avg("won").over(w("jockey")))
    fresh = own(home, (F.row_number().over(pit.inside(*home).orderBy(*ORDER)) == 1).cast("int"))
    r = pit.gathered(r.drop("_alone"), "trainer", *ORDER).withColumns({"fresh": fresh, "track_runs": own(home, F.count(F.lit(1)).over(w(*home)), 0), "track_rate": own(home, F.avg("won").over(w(*home)))})
    r = r.withColumn("tracks_seen", F.coalesce(F.sum("fresh").over(w("trainer")), F.lit(0)))
    mean = (F.col("horse_rate") + F.col("jockey_rate")) / 2
    specialist = F.coalesce((F.col("track_runs") >= 10) & (F.col("track_rate") > 0.15), F.lit(False))
    return r.select("uid", integer(F.col("duo_runs"), "duo_runs"), real(F.col("duo_rate"), "duo_rate"), real(F.when(mean > 0, F.col("duo_rate") / mean), "affinity"), integer(F.col("tracks_seen"), "tracks_seen"), integer(F.col("track_runs"), "track_runs"), real(F.col("track_rate"), "track_rate"), integer(specialist.cast("int"), "specialist"))


def _before(*keys: str) -> str:
    return f"(PARTITION BY {', '.join(keys)} ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


DUO_AFFINITY = f"""{RT}, f AS (SELECT *, (row_number() OVER (PARTITION BY trainer, track ORDER BY day, race, no) = 1)::INTEGER AS fresh FROM rt)
SELECT uid, count(*) OVER d AS duo_runs, {real_sql('avg(won) OVER d', 'duo_rate')}, {real_sql('CASE WHEN avg(won) OVER h + avg(won) OVER j > 0 THEN avg(won) OVER d / ((avg(won) OVER h + avg(won) OVER j) / 2) END', 'affinity')},
  coalesce(sum(fresh) OVER t, 0)::BIGINT AS tracks_seen, count(*) OVER k AS track_runs, {real_sql('avg(won) OVER k', 'track_rate')}, coalesce(count(*) OVER k >= 10 AND avg(won) OVER k > 0.15, false)::BIGINT AS specialist
FROM f WINDOW d AS {_before('horse', 'jockey')}, h AS {_before('horse')}, j AS {_before('jockey')}, t AS {_before('trainer')}, k AS {_before('trainer', 'track')}"""


def run_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Change from the horse's run before: distance, class (purse), discipline, track and surface, runs at one track in a row, purse changes in the last 5 runs."""
    r = with_tracks(runners(spark, sf), spark, sf)
    purse = F.sum("gains").over(Window.partitionBy("race"))
    w = pit.in_order("horse", *ORDER)
    r = r.withColumn("purse", purse).withColumns({"same": (F.lag("track").over(w) == F.col("track")).cast("int"), "moved": F.coalesce((F.lag("purse").over(w) != F.col("purse")).cast("int"), F.lit(0)), "rn": F.row_number().over(w)})
    broken = F.max(F.when(F.coalesce("same", F.lit(0)) == 0, F.col("rn"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    changed = lambda c: integer((F.lag(c).over(w) != F.col(c)).cast("int"), f"{c}_changed")
    return r.select("uid", integer(F.col("distance") - F.lag("distance").over(w), "distance_change"), integer(F.signum(F.col("purse") - F.lag("purse").over(w)), "class_move"), changed("discipline"), changed("track"), changed("equipment"), integer(F.col("rn") - broken, "same_track_run"), integer(F.sum("moved").over(w.rowsBetween(-4, 0)), "purse_changes_5"))


RUN_CHANGES = f"""{RT}, p AS (SELECT *, sum(gains) OVER (PARTITION BY race) AS purse FROM rt),
q AS (SELECT *, lag(distance) OVER w AS d0, lag(purse) OVER w AS p0, lag(discipline) OVER w AS i0, lag(track) OVER w AS t0, lag(equipment) OVER w AS e0, row_number() OVER w AS rn FROM p WINDOW w AS (PARTITION BY horse ORDER BY day, race, no))
SELECT uid, (distance - d0)::BIGINT AS distance_change, sign(purse - p0)::BIGINT AS class_move, (discipline <> i0)::BIGINT AS discipline_changed, (track <> t0)::BIGINT AS track_changed, (equipment <> e0)::BIGINT AS equipment_changed,
  (rn - max(CASE WHEN t0 IS NULL OR t0 <> track THEN rn END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS same_track_run, (sum(coalesce((purse <> p0)::INTEGER, 0)) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))::BIGINT AS purse_changes_5
FROM q WINDOW w AS (PARTITION BY horse ORDER BY day, race, no)"""


def rest_and_layoff(spark: SparkSession, sf: str) -> DataFrame:
    """Days since the last run of an earlier day, its category, layoff flags, runs in the 30, 60, 90 and 365 days before, debut and comeback."""
    r = runners(spark, sf)
    f = pit.strict_day("horse")
    r = r.withColumn("gap", F.col("day") - F.max("day").over(f))
    runs = [integer(F.count(F.lit(1)).over(pit.trailing_days("horse", d)), f"runs_{d}") for d in (30, 60, 90, 365)]
    flag = lambda c, name: integer(F.coalesce(c, F.lit(False)).cast("int"), name)
    category = F.when(F.col("gap").isNull(), "debut").when(F.col("gap") <= 14, "quick").when(F.col("gap") <= 60, "rested").when(F.col("gap") <= 180, "long").otherwise("absence")
    five = [integer(F.coalesce(F.sum(c).over(pit.sequential("horse", *ORDER, last=5)), F.lit(0)), f"{c}_5") for c in ("won", "placed")]
    return r.select("uid", integer(F.col("gap"), "gap"), category.alias("category"), real(F.log1p(F.coalesce("gap", F.lit(365))), "log_gap"), *(flag(F.col("gap") > d, f"layoff_{d}") for d in (14, 35, 90)), flag(F.col("gap").isNull(), "debut"), *runs, *five)


REST_AND_LAYOFF = f"""{R}, g AS (SELECT *, day - max(day) OVER (PARTITION BY horse ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM r)
SELECT uid, gap::BIGINT AS gap, CASE WHEN gap IS NULL THEN 'debut' WHEN gap <= 14 THEN 'quick' WHEN gap <= 60 THEN 'rested' WHEN gap <= 180 THEN 'long' ELSE 'absence' END AS category, {real_sql('ln(1 + coalesce(gap, 365))', 'log_gap')}, {", ".join(f"coalesce(gap > {d}, false)::BIGINT AS layoff_{d}" for d in (14, 35, 90))}, (gap IS NULL)::BIGINT AS debut,
  {", ".join(f"count(*) OVER (PARTITION BY horse ORDER BY day RANGE BETWEEN {d} PRECEDING AND 1 PRECEDING) AS runs_{d}" for d in (30, 60, 90, 365))}, {", ".join(f"coalesce(sum({c}) OVER (PARTITION BY horse ORDER BY day, race, no ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 0)::BIGINT AS {c}_5" for c in ("won", "placed"))}
FROM g"""


def recent_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct tracks of each trainer over the 30 days before: sets by day, joined over the frame of days."""
    r = with_tracks(runners(spark, sf), spark, sf)
    days = r.where("trainer is not null").groupBy("trainer", "day").agg(F.collect_set("track").alias("tracks"))
    seen = F.size(F.array_distinct(F.flatten(F.collect_list("tracks").over(pit.trailing_days("trainer", 30)))))
    return r.select("uid", "trainer", "day").join(days.select("trainer", "day", integer(seen, "tracks_30")), ["trainer", "day"], "left").select("uid", F.coalesce("tracks_30", F.lit(0)).alias("tracks_30"))


RECENT_TRACKS = f"""{RT} SELECT a.uid, count(DISTINCT b.track) AS tracks_30 FROM rt AS a LEFT JOIN rt AS b ON a.trainer = b.trainer AND b.day BETWEEN a.day - 30 AND a.day - 1 GROUP BY a.uid"""


def pedigree_history(spark: SparkSession, sf: str) -> DataFrame:
    """Sire, dam and sire by discipline on earlier days, null below the least sample; share of the sire's wins from far and short distances."""
    r = with_tracks(runners(spark, sf), spark, sf).select("uid", "day", "sire", "dam", "discipline", "distance", "won")
    far, short = (F.col("won") * (F.col("distance") >= 2400).cast("int")).alias("far"), (F.col("won") * (F.col("distance") < 1400).cast("int")).alias("short")
    r = r.withColumns({"far": far, "short": short})
    r = pit.daily_histories_of(r, {"sire": ["sire"], "dam": ["dam"], "sd": ["sire", "discipline"]}, {"sire": {"far": "far", "short": "short"}})
    enough = lambda p, n: F.when(F.col(f"{p}_runs") >= n, F.col(f"{p}_win_rate"))
    return r.select("uid", integer(F.col("sire_runs"), "sire_runs"), integer(F.col("sire_wins"), "sire_wins"), real(enough("sire", 3), "sire_rate"), integer(F.col("dam_runs"), "dam_runs"), real(enough("dam", 2), "dam_rate"), integer(F.col("sd_runs"), "sd_runs"), real(enough("sd", 3), "sd_rate"), real(F.try_divide(F.col("sire_far").cast("double"), F.col("sire_wins")), "stamina"), real(F.try_divide(F.col("sire_short").cast("double"), F.col("sire_wins")), "speed"))


PEDIGREE_HISTORY = f"""{RT} SELECT uid, count(*) OVER s AS sire_runs, coalesce(sum(won) OVER s, 0)::BIGINT AS sire_wins, {real_sql('CASE WHEN count(*) OVER s >= 3 THEN avg(won) OVER s END', 'sire_rate')}, count(*) OVER d AS dam_runs, {real_sql('CASE WHEN count(*) OVER d >= 2 THEN avg(won) OVER d END', 'dam_rate')}, count(*) OVER x AS sd_runs, {real_sql('CASE WHEN count(*) OVER x >= 3 THEN avg(won) OVER x END', 'sd_rate')},
  {real_sql('sum(CASE WHEN distance >= 2400 THEN won ELSE 0 END) OVER s / nullif(sum(won) OVER s, 0)', 'stamina')}, {real_sql('sum(CASE WHEN distance < 1400 THEN won ELSE 0 END) OVER s / nullif(sum(won) OVER s, 0)', 'speed')}
FROM rt WINDOW {", ".join(f"{n} AS (PARTITION BY {k} ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for n, k in (("s", "sire"), ("d", "dam"), ("x", "sire, discipline")))}"""


def track_biases(spark: SparkSession, sf: str) -> DataFrame:
    """Over the 365 days before: win rate of the draw's rail bin at the track less the track's own, and of the surface at the track less that of the surface."""
    r = with_tracks(runners(spark, sf), spark, sf).withColumn("rail", scalars.binned(F.col("draw"), (3, 5), ("rail", "middle", "wide"), "right"))
    for name, keys in (("b", ["track", "rail"]), ("t", ["track"]), ("s", ["track", "equipment"]), ("g", ["equipment"])):
        r = pit.daily_history(r, keys, name, days=365)
    gap = lambda a, b: F.when(F.col(f"{a}_runs") >= 5, F.col(f"{a}_win_rate") - F.col(f"{b}_win_rate"))
    return r.select("uid", "rail", integer(F.col("b_runs"), "rail_runs"), real(gap("b", "t"), "rail_bias"), integer(F.col("s_runs"), "surface_runs"), real(gap("s", "g"), "surface_bias"))


TRACK_BIASES = f"""{RT}, x AS (SELECT *, CASE WHEN draw <= 3 THEN 'rail' WHEN draw <= 5 THEN 'middle' ELSE 'wide' END AS rail FROM rt)
SELECT uid, rail, count(*) OVER b AS rail_runs, {real_sql('CASE WHEN count(*) OVER b >= 5 THEN avg(won) OVER b - avg(won) OVER t END', 'rail_bias')}, count(*) OVER s AS surface_runs, {real_sql('CASE WHEN count(*) OVER s >= 5 THEN avg(won) OVER s - avg(won) OVER g END', 'surface_bias')}
FROM x WINDOW {", ".join(f"{n} AS (PARTITION BY {k} ORDER BY day RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING)" for n, k in (("b", "track, rail"), ("t", "track"), ("s", "track, equipment"), ("g", "equipment")))}"""


def quarter_gains(spark: SparkSession, sf: str) -> DataFrame:
    """Earnings of each horse by quarter, those of its quarter before and their ratio, and the season's win rate so far; runs of unknown horses have no quarters."""
    r = runners(spark, sf).where("horse is not null").withColumn("quarter", F.year("race_date") * 4 + F.quarter("race_date"))
    q = r.groupBy("horse", "quarter").agg(F.sum("gains").alias("gains"), F.sum("won").alias("wins"), F.count(F.lit(1)).alias("runs"))
    w = Window.partitionBy("horse").orderBy("quarter")
    before = F.lag("gains").over(w)
    season = Window.partitionBy("horse", F.pmod("quarter", F.lit(4))).orderBy("quarter").rowsBetween(Window.unboundedPreceding, -1)
    return q.select("horse", integer(F.col("quarter"), "quarter"), integer(F.col("gains"), "gains"), integer(before, "gains_before"), real(F.try_divide(F.col("gains").cast("double"), before), "ratio"), integer(F.col("quarter") - F.lag("quarter").over(w), "quarters_since"), real(F.try_divide(F.sum("wins").over(season).cast("double"), F.sum("runs").over(season)), "season_rate"))


QUARTER_GAINS = f"""{R}, q AS (SELECT horse, year(race_date) * 4 + quarter(race_date) AS quarter, sum(gains) AS gains, sum(won) AS wins, count(*) AS runs FROM r WHERE horse IS NOT NULL GROUP BY 1, 2)
SELECT horse, quarter::BIGINT AS quarter, gains::BIGINT AS gains, (lag(gains) OVER w)::BIGINT AS gains_before, {real_sql('gains / lag(gains) OVER w', 'ratio')}, (quarter - lag(quarter) OVER w)::BIGINT AS quarters_since, {real_sql('sum(wins) OVER s / sum(runs) OVER s', 'season_rate')}
FROM q WINDOW w AS (PARTITION BY horse ORDER BY quarter), s AS (PARTITION BY horse, quarter % 4 ORDER BY quarter ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

CONTEXTS = {"track": ["track"], "band": ["band"], "going": ["equipment"], "disc": ["discipline"], "mix": ["band", "equipment"]}


def context_specialists(spark: SparkSession, sf: str) -> DataFrame:
    """Runs and win rate of the horse before each run in five contexts, with specialist flags."""
    r = with_tracks(runners(spark, sf), spark, sf).withColumn("band", scalars.distance_band(F.col("distance"), "E"))
    r = pit.gathered(r.select("uid", *ORDER, "horse", "track", "band", "equipment", "discipline", "won"), "horse", *ORDER)
    cols = []
    for name, keys in CONTEXTS.items():
        w, own = pit.inside("horse", *keys).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1), pit.known(keys)
        least = {"track": 0.25, "band": 0.20}.get(name, 0.30)
        n, rate = F.when(own, F.count(F.lit(1)).over(w)).otherwise(0), F.when(own, F.avg("won").over(w))
        cols += [integer(n, f"{name}_runs"), real(rate, f"{name}_rate"), integer(F.coalesce((n >= 3) & (rate > least), F.lit(False)).cast("int"), f"{name}_specialist")]
    return r.select("uid", *cols)


CONTEXT_SPECIALISTS = f"""{RT}, x AS (SELECT *, {BAND_SQL} AS band FROM rt) SELECT uid, {", ".join(f"count(*) OVER {c} AS {c}_runs, {real_sql(f'avg(won) OVER {c}', f'{c}_rate')}, coalesce(count(*) OVER {c} >= 3 AND avg(won) OVER {c} > { {'track': 0.25, 'band': 0.2}.get(c, 0.3) }, false)::BIGINT AS {c}_specialist" for c in CONTEXTS)}
FROM x WINDOW {", ".join(f"{c} AS {_before('horse', *k)}" for c, k in CONTEXTS.items())}"""


def optimal_going(spark: SparkSession, sf: str) -> DataFrame:
    """The surface with the horse's best win rate so far among those with two runs, the earliest seen on ties, and whether this run is on it."""
    best = pit.best_context(runners(spark, sf).select("uid", *ORDER, "horse", "equipment", "won"), "horse", "equipment", ORDER, "uid")
    return best.select("uid", F.col("best_context").alias("best_going"), real(F.col("best_rate"), "best_rate"), integer((F.col("best_context") == F.col("equipment")).cast("int"), "at_best"))


OPTIMAL_GOING = f"""{R}, own AS (SELECT horse, equipment AS ctx, min((day, race, no)) AS seen FROM r GROUP BY 1, 2),
d AS (SELECT r.uid, r.equipment, ctx, seen, count(*) FILTER (equipment = ctx) OVER w AS n, sum(CASE WHEN equipment = ctx THEN won END) OVER w AS wins FROM r JOIN own USING (horse) WINDOW w AS (PARTITION BY horse, ctx ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT uid, ctx, wins / n AS rate FROM d WHERE n >= 2 QUALIFY row_number() OVER (PARTITION BY uid ORDER BY wins / n DESC, seen) = 1)
SELECT uid, ctx AS best_going, {real_sql('rate', 'best_rate')}, (ctx = equipment)::BIGINT AS at_best FROM r LEFT JOIN b USING (uid)"""


def actor_degrees(spark: SparkSession, sf: str) -> DataFrame:
    """Degrees in the graph of horses, jockeys and trainers before each run, and first meetings."""
    r = pit.gathered(runners(spark, sf).select("uid", *ORDER, "horse", "jockey", "trainer"), "horse", *ORDER)
    # Whether a pair meets for the first time is the same on both sides.
    for other in ("jockey", "trainer"):
        r = r.withColumn(f"first_{other}", (F.row_number().over(pit.inside("horse", other).orderBy(*ORDER)) == 1).cast("int"))
    met = lambda other: F.when(pit.known(["horse", other]), F.col(f"first_{other}"))
    before = lambda entity, other: F.coalesce(F.sum(met(other)).over(pit.inside(entity).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    r = r.withColumns({"horse_jockeys": before("horse", "jockey"), "horse_trainers": before("horse", "trainer")})
    for actor in ("jockey", "trainer"):
        r = pit.gathered(r.drop("_alone"), actor, *ORDER).withColumn(f"{actor}_horses", before(actor, actor))
    first = lambda horse, other: F.coalesce(met(other), F.lit(1))
    names = ("jockey_horses", "trainer_horses", "horse_jockeys", "horse_trainers")
    return r.select("uid", *(integer(F.col(n), n) for n in names), integer(F.col("horse_jockeys") + F.col("horse_trainers"), "horse_degree"), integer(first("horse", "jockey"), "first_duo"), integer(first("horse", "trainer"), "first_stable"))


_DEGREES = (("jockey", "horse", "jockey_horses"), ("trainer", "horse", "trainer_horses"), ("horse", "jockey", "horse_jockeys"), ("horse", "trainer", "horse_trainers"))
ACTOR_DEGREES = f"""{R}, f AS (SELECT *, {", ".join(f"(row_number() OVER (PARTITION BY {a}, {b} ORDER BY day, race, no) = 1)::INTEGER AS f_{n}" for a, b, n in _DEGREES)} FROM r),
g AS (SELECT *, {", ".join(f"coalesce(sum(f_{n}) OVER {_before(a)}, 0)::BIGINT AS {n}" for a, _, n in _DEGREES)} FROM f)
SELECT uid, {", ".join(n for _, _, n in _DEGREES)}, horse_jockeys + horse_trainers AS horse_degree, f_horse_jockeys::BIGINT AS first_duo, f_horse_trainers::BIGINT AS first_stable FROM g"""


def purse_percentile(spark: SparkSession, sf: str) -> DataFrame:
    """Percentile rank of the run's earnings among the horse's earlier days: mid-rank and strictly below."""
    r = pit.rank_before(runners(spark, sf), "horse", "gains", "uid")
    return r.select("uid", real((F.col("n_below") + 0.5 * F.col("n_equal")) / F.nullif(F.col("n_before"), F.lit(0)), "mid_rank"), real(F.col("n_below") / F.nullif(F.col("n_before"), F.lit(0)), "below_rank"))


PURSE_PERCENTILE = f"""{R} SELECT a.uid, {real_sql('(count(*) FILTER (b.gains < a.gains) + 0.5 * count(*) FILTER (b.gains = a.gains)) / nullif(count(b.uid), 0)', 'mid_rank')}, {real_sql('count(*) FILTER (b.gains < a.gains) / nullif(count(b.uid), 0)', 'below_rank')} FROM r AS a LEFT JOIN r AS b ON a.horse = b.horse AND b.day < a.day GROUP BY a.uid"""


def position_series(spark: SparkSession, sf: str) -> DataFrame:
    """Slopes of the last 5 and 10 positions, volatility, variation, and momentum: slope of the three before less that of the last three."""
    r = runners(spark, sf)
    order = pit.in_order("horse", *ORDER)
    r = r.withColumn("rn", F.row_number().over(order))
    w = lambda last, skip=0: pit.sequential("horse", *ORDER, last=last, skip=skip)
    at = lambda k: F.lag("position", k).over(order)  # noqa: E731  slope of three equal steps is half the change
    recent, older = (at(1) - at(3)) / 2, (at(4) - at(6)) / 2
    mean, sd = F.avg("position").over(w(10)), F.stddev_pop("position").over(w(10))
    return r.select("uid", real(pit.slope(F.col("position"), F.col("rn"), w(5)), "slope_5"), real(pit.slope(F.col("position"), F.col("rn"), w(10)), "slope_10"), real(sd, "volatility"), real(F.when(mean > 0, sd / mean), "variation"), real(older - recent, "momentum"))


POSITION_SERIES = f"""{R}, s AS (SELECT *, row_number() OVER w AS rn FROM r WINDOW w AS (PARTITION BY horse ORDER BY day, race, no))
SELECT uid, {real_sql('CASE WHEN count(*) OVER w5 > 1 THEN regr_slope(position, rn) OVER w5 END', 'slope_5')}, {real_sql('CASE WHEN count(*) OVER w10 > 1 THEN regr_slope(position, rn) OVER w10 END', 'slope_10')}, {real_sql('stddev_pop(position) OVER w10', 'volatility')}, {real_sql('stddev_pop(position) OVER w10 / avg(position) OVER w10', 'variation')},
  {real_sql('(lag(position, 4) OVER w - lag(position, 6) OVER w) / 2 - (lag(position, 1) OVER w - lag(position, 3) OVER w) / 2', 'momentum')}
FROM s WINDOW w AS (PARTITION BY horse ORDER BY day, race, no), {", ".join(f"w{n} AS (PARTITION BY horse ORDER BY day, race, no ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (5, 10))}"""


def series_reset(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of wins, of places without a win and of misses that end before each run; a mere place ends a run of wins."""
    r = runners(spark, sf).withColumn("kind", F.when(F.col("won") == 1, "win").when(F.col("placed") == 1, "place").otherwise("miss"))
    w = pit.in_order("horse", *ORDER)
    r = r.withColumn("turn", F.coalesce((F.lag("kind").over(w) != F.col("kind")).cast("int"), F.lit(1)))
    r = r.withColumn("series", F.sum("turn").over(w))
    r = r.withColumn("length", F.row_number().over(pit.in_order(["horse", "series"], *ORDER)))
    last, length = F.lag("kind").over(w), F.lag("length").over(w)
    return r.select("uid", *(integer(F.when(last == k, length).otherwise(0), f"{k}_series") for k in ("win", "place", "miss")))


SERIES_RESET = f"""{R}, k AS (SELECT *, CASE WHEN won = 1 THEN 'win' WHEN placed = 1 THEN 'place' ELSE 'miss' END AS kind FROM r),
i AS (SELECT *, row_number() OVER (PARTITION BY horse ORDER BY day, race, no) - row_number() OVER (PARTITION BY horse, kind ORDER BY day, race, no) AS grp FROM k),
l AS (SELECT *, row_number() OVER (PARTITION BY horse, kind, grp ORDER BY day, race, no) AS length FROM i),
p AS (SELECT uid, lag(kind) OVER w AS last, lag(length) OVER w AS n FROM l WINDOW w AS (PARTITION BY horse ORDER BY day, race, no))
SELECT uid, {", ".join(f"CASE WHEN last = '{k}' THEN n ELSE 0 END::BIGINT AS {k}_series" for k in ("win", "place", "miss"))} FROM p"""


def null_actors(spark: SparkSession, sf: str) -> DataFrame:
    """Histories where a fifth of the horses are unknown: their rows stay, without any history."""
    r = runners(spark, sf).withColumn("horse", F.when(F.col("uid") % 5 != 0, F.col("horse")))
    r = pit.history(r, "horse", pit.strict_day("horse"), "h")
    last = pit.last_n_of_earlier_days(r, "horse", 5, ORDER, ["position"])
    return last.select("uid", "h_runs", real(F.col("h_win_rate"), "h_win_rate"), integer(F.size("last"), "n_last"), integer(F.get("last", F.lit(0))["position"], "last_position"))


NULL_ACTORS = f"""{R}, x AS (SELECT * EXCLUDE (horse), CASE WHEN uid % 5 <> 0 THEN horse END AS horse FROM r)
SELECT a.uid, count(b.uid) AS h_runs, {real_sql('avg(b.won)', 'h_win_rate')}, least(count(b.uid), 5) AS n_last, (arg_max(b.position, b.day * 10000000000 + b.race * 100 + b.no))::BIGINT AS last_position FROM x AS a LEFT JOIN x AS b ON a.horse = b.horse AND b.day < a.day GROUP BY a.uid"""

_NAMES = ("form_windows", "form_sequential", "form_days", "pair_histories", "duo_affinity", "run_changes", "rest_and_layoff", "recent_tracks", "pedigree_history", "track_biases", "quarter_gains", "context_specialists", "optimal_going", "actor_degrees", "purse_percentile", "position_series", "series_reset", "null_actors")
QUERIES = {n: globals()[n] for n in _NAMES}
ORACLES = {n: globals()[n.upper()] for n in _NAMES}
