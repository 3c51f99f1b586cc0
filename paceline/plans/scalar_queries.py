"""Queries over keys, dates, form and conditions texts, sets, registries and tables as a whole, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.functions import scalars
from paceline.functions.conditions import conditions
from paceline.operators import merge, race
from paceline.plans.form_queries import integer, real, real_sql
from paceline.sources.tables import RUNNERS_SQL, TRACKS_SQL, runners, table, with_tracks

R, RT = f"WITH {RUNNERS_SQL}", f"WITH {TRACKS_SQL}"


def row_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Composite keys with an empty text for a missing part, their digest, and the whole numbers of a combination text."""
    r = runners(spark, sf).withColumn("maybe", F.when(F.col("uid") % 7 != 0, F.col("trainer")))
    key, numbers = scalars.row_key(F.col("race"), F.col("maybe"), F.col("no")), scalars.picks(F.concat_ws("-", "draw", "no", "weight"))
    return r.select("uid", key.alias("row_key"), F.md5(key).alias("digest"), integer(F.size(numbers), "n_picks"), integer(F.array_max(numbers), "largest_pick"))


ROW_KEYS = f"""{R}, k AS (SELECT *, race::VARCHAR || '|' || CASE WHEN uid % 7 <> 0 THEN trainer::VARCHAR ELSE '' END || '|' || no::VARCHAR AS row_key FROM r)
SELECT uid, row_key, md5(row_key) AS digest, 3::BIGINT AS n_picks, greatest(draw, no, weight)::BIGINT AS largest_pick FROM k"""


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Time of day, month on a circle, the date three months on, and whether a date is in range or to come."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    sin, cos = scalars.cyclic(F.month("d"), 12)
    return o.select("o_orderkey", scalars.hour_minute(F.col("o_orderkey") * 977777).alias("clock"), real(sin, "month_sin"), real(cos, "month_cos"), F.add_months("d", 3).cast("string").alias("later"), F.col("d").between("1996-01-01", "1997-12-31").alias("in_range"), (F.col("d") > F.lit("1998-01-01").cast("date")).alias("to_come"))


CALENDAR = f"""WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, (o_orderkey * 977777) // 60000 AS minute FROM orders)
SELECT o_orderkey, lpad((minute // 60 % 24)::VARCHAR, 2, '0') || ':' || lpad((minute % 60)::VARCHAR, 2, '0') AS clock, {real_sql('sin(2 * pi() * month(d) / 12)', 'month_sin')}, {real_sql('cos(2 * pi() * month(d) / 12)', 'month_cos')},
  (d + INTERVAL 3 MONTH)::DATE::VARCHAR AS later, d BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AS in_range, d > DATE '1998-01-01' AS to_come FROM o"""


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Newest date of each dated table and the days it is behind the newest of all."""
    dated = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    newest = None
    for name, column in dated.items():
        one = table(spark, sf, name).agg(F.lit(name).alias("name"), F.max(column).cast("date").alias("newest"), F.count(F.lit(1)).alias("n"))
        newest = one if newest is None else newest.unionByName(one)
    behind = F.datediff(F.max("newest").over(Window.partitionBy(F.lit(1))), "newest")
    return newest.select("name", "n", F.col("newest").cast("string").alias("newest"), integer(behind, "days_behind"), F.when(behind > 365, "stale").otherwise("fresh").alias("verdict"))


FRESHNESS = """WITH t AS (SELECT 'orders' AS name, max(o_orderdate)::DATE AS m, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', max(l_shipdate)::DATE, count(*) FROM lineitem UNION ALL SELECT 'events', max(ts)::DATE, count(*) FROM events),
g AS (SELECT max(m) AS top FROM t)
SELECT name, n, m::VARCHAR AS newest, date_diff('day', m, top) AS days_behind, CASE WHEN date_diff('day', m, top) > 365 THEN 'stale' ELSE 'fresh' END AS verdict FROM t, g"""


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    """Products of two columns: null if either is, with stand-ins for what is missing, and gated by a threshold."""
    r = runners(spark, sf).withColumns({"rest": F.when(F.col("uid") % 6 != 0, F.col("day") % 90), "load": F.when(F.col("uid") % 4 != 0, F.col("weight"))})
    return r.select("uid", real(F.col("odds") * F.col("rest"), "odds_rest"), integer(F.coalesce("load", F.lit(0)) * F.coalesce("rest", F.lit(365)), "load_rest"), real(F.when(F.col("rest") > 60, F.col("odds") * F.col("load")), "tired_load"), integer(((F.col("load") >= 8) & (F.col("distance") >= 2400)).cast("int"), "heavy_long"))


INTERACTIONS = f"""{R}, x AS (SELECT *, CASE WHEN uid % 6 <> 0 THEN day % 90 END AS rest, CASE WHEN uid % 4 <> 0 THEN weight END AS load FROM r)
SELECT uid, {real_sql('odds * rest', 'odds_rest')}, (coalesce(load, 0) * coalesce(rest, 365))::BIGINT AS load_rest, {real_sql('CASE WHEN rest > 60 THEN odds * load END', 'tired_load')}, (load >= 8 AND distance >= 2400)::BIGINT AS heavy_long FROM x"""


def empty_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns with the number of values they hold and whether they are dropped as empty: one pass over the rows."""
    r = runners(spark, sf).select("uid", "odds", F.when(F.col("uid") < 0, F.col("weight")).alias("never"), F.lit("").alias("blank"), F.when(F.col("uid") % 3 == 0, "x").alias("some"))
    filled = r.agg(*(F.count_if(merge.filled(c) if c in ("blank", "some") else F.col(c).isNotNull()).alias(c) for c in r.columns))
    return filled.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("n_filled"), (F.col(c) == 0).alias("dropped")) for c in r.columns)))).select("col.*")


EMPTY_COLUMNS = f"""{R} SELECT 'uid' AS field, count(*) AS n_filled, count(*) = 0 AS dropped FROM r UNION ALL SELECT 'odds', count(odds), count(odds) = 0 FROM r UNION ALL SELECT 'never', 0, true UNION ALL SELECT 'blank', 0, true
UNION ALL SELECT 'some', count(*) FILTER (uid % 3 = 0), count(*) FILTER (uid % 3 = 0) = 0 FROM r"""


def record_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each discipline before and after whole records that repeat are dropped."""
    line = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey", "l_quantity", "l_discount")
    before = line.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_before"))
    after = line.dropDuplicates().groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_after"))
    return before.join(after, "l_returnflag").withColumn("removed", F.col("n_before") - F.col("n_after"))


RECORD_DEDUP = """WITH l AS (SELECT l_returnflag, l_linestatus, l_suppkey, l_quantity, l_discount FROM lineitem), a AS (SELECT l_returnflag, count(*) AS n FROM (SELECT DISTINCT * FROM l) GROUP BY 1), b AS (SELECT l_returnflag, count(*) AS n FROM l GROUP BY 1)
SELECT l_returnflag, b.n AS n_before, a.n AS n_after, b.n - a.n AS removed FROM b JOIN a USING (l_returnflag)"""


def source_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Histogram of how many sources know a runner, and how often each does."""
    r = runners(spark, sf).withColumns({"a": (F.col("uid") % 2 == 0).cast("int"), "b": (F.col("weight") > 4).cast("int"), "c": (F.col("equipment") == "F").cast("int")})
    return r.groupBy((F.col("a") + F.col("b") + F.col("c")).cast("long").alias("n_sources")).agg(F.count(F.lit(1)).alias("n"), integer(F.sum("a"), "in_a"), integer(F.sum("b"), "in_b"), integer(F.sum("c"), "in_c"))


SOURCE_PRESENCE = f"""{R}, x AS (SELECT (uid % 2 = 0)::INTEGER AS a, (weight > 4)::INTEGER AS b, (equipment = 'F')::INTEGER AS c FROM r)
SELECT (a + b + c)::BIGINT AS n_sources, count(*) AS n, sum(a)::BIGINT AS in_a, sum(b)::BIGINT AS in_b, sum(c)::BIGINT AS in_c FROM x GROUP BY 1"""


def tip_consensus(spark: SparkSession, sf: str) -> DataFrame:
    """Tips of each runner, its share of the race's tips, its rank by them, and probabilities by softmax."""
    r = runners(spark, sf)
    w = race.field()
    force = F.exp(F.col("weight") / 5.0)
    return r.select("uid", real(F.try_divide(F.col("weight").cast("double"), F.sum("weight").over(w)), "tip_share"), integer(race.positional_rank(F.desc("weight"), "no"), "tip_rank"), real(force / F.sum(force).over(w), "softmax"))


TIP_CONSENSUS = f"""{R} SELECT uid, {real_sql('CASE WHEN sum(weight) OVER w > 0 THEN weight / sum(weight) OVER w END', 'tip_share')}, row_number() OVER (PARTITION BY race ORDER BY weight DESC, no) AS tip_rank, {real_sql('exp(weight / 5.0) / sum(exp(weight / 5.0)) OVER w', 'softmax')} FROM r WINDOW w AS (PARTITION BY race)"""


def form_years(spark: SparkSession, sf: str) -> DataFrame:
    """Summary of a form text with year tokens: runs, places, their mean and spread, failures, commonest discipline, years."""
    text = F.concat(F.col("position"), F.lit("a"), F.col("no"), F.lit("p("), 20 + F.col("uid") % 5, F.lit(")"), F.col("draw"), F.lit("hDh("), 15 + F.col("uid") % 5, F.lit(")Tp"))
    runs = F.col("runs")
    r = runners(spark, sf).select("uid", scalars.form_runs(text).alias("runs")).withColumn("places", F.filter(runs["place"], lambda x: x.isNotNull()))
    total = lambda f: F.aggregate("places", F.lit(0.0), lambda s, x: s + f(x))
    r = r.withColumn("mean", F.try_divide(total(lambda x: x), F.size("places")))
    letters = runs["discipline"]
    commonest = F.array_min(F.transform(F.array_distinct(letters), lambda d: F.struct((-F.size(F.filter(letters, lambda x: x == d))).alias("n"), d.alias("d"))))["d"]
    sd = F.sqrt(F.try_divide(total(lambda x: (x - F.col("mean")) * (x - F.col("mean"))), F.size("places")))
    return r.select("uid", integer(F.size("runs"), "n_runs"), integer(F.size("places"), "n_places"), real(F.col("mean"), "mean_place"), real(sd, "place_sd"), integer(F.array_min("places"), "best_place"), integer(F.size("runs") - F.size("places"), "n_failed"), commonest.alias("discipline"), integer(F.array_min(runs["year"]), "first_year"), integer(F.array_max(runs["year"]), "last_year"), integer(F.size(F.filter(runs["year"], lambda y: y.isNull())), "n_current"))


FORM_YEARS = rf"""{R}, x AS (SELECT uid, regexp_extract_all(position || 'a' || no || 'p(' || (20 + uid % 5) || ')' || draw || 'hDh(' || (15 + uid % 5) || ')Tp', '\(\d{{2}}\)|(?:\d+|[DTAR])[amphsc]') AS tokens FROM r),
t AS (SELECT uid, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS i FROM x),
y AS (SELECT *, 2000 + last_value(try_cast(regexp_extract(tok, '^\((\d+)\)$', 1) AS INTEGER) IGNORE NULLS) OVER (PARTITION BY uid ORDER BY i) AS yr, try_cast(regexp_extract(tok, '^(\d+)[a-z]$', 1) AS INTEGER) AS place, right(tok, 1) AS d FROM t),
n AS (SELECT *, count(*) OVER (PARTITION BY uid, d) AS c FROM y WHERE NOT starts_with(tok, '('))
SELECT uid, count(*) AS n_runs, count(place) AS n_places, {real_sql('avg(place)', 'mean_place')}, {real_sql('stddev_pop(place)', 'place_sd')}, min(place)::BIGINT AS best_place, count(*) - count(place) AS n_failed, first(d ORDER BY c DESC, d) AS discipline,
  min(yr)::BIGINT AS first_year, max(yr)::BIGINT AS last_year, count(*) FILTER (yr IS NULL) AS n_current FROM n GROUP BY uid"""


def conditions_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields of conditions texts; the SQL has the values that the texts were written from."""
    u = F.col("uid")
    kind = F.element_at(F.array(F.lit("Groupe II"), F.lit("Listed"), F.lit("Handicap"), F.lit("Prix")), (u % 4 + 1).cast("int"))
    text = F.concat(kind, F.lit(" pour "), F.when(u % 5 == 0, "pouliches de ").otherwise("chevaux de "), 2 + u % 4, F.lit(" à "), 4 + u % 4, F.lit(" ans, "), F.col("distance"), F.lit(" mètres, "), 50 + F.col("weight"), F.lit(" kg, "), 1000 + u % 9000, F.lit(" euros"), F.when(u % 3 == 0, ", départ autostart").otherwise(""))
    c = runners(spark, sf).select("uid", conditions(text).alias("c"))
    return c.select("uid", integer(F.col("c.age_min"), "age_min"), integer(F.col("c.age_max"), "age_max"), integer(F.col("c.distance"), "distance"), integer(F.col("c.weight"), "weight"), real(F.col("c.prize"), "prize"), F.col("c.category").alias("category"), F.col("c.start").alias("start"), F.col("c.females_only").alias("females_only"))


CONDITIONS_FIELDS = f"""{R} SELECT uid, 2 + uid % 4 AS age_min, 4 + uid % 4 AS age_max, distance::BIGINT AS distance, 50 + weight::BIGINT AS weight, (1000 + uid % 9000)::DOUBLE AS prize, CASE uid % 4 WHEN 0 THEN 'group 2' WHEN 1 THEN 'listed' WHEN 2 THEN 'handicap' ELSE 'ordinary' END AS category, CASE WHEN uid % 3 = 0 THEN 'autostart' END AS start, uid % 5 = 0 AS females_only FROM r"""


def repaired_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Names read in the wrong alphabet, amounts and times as texts; the SQL has what they were written from."""
    r = runners(spark, sf)
    name = F.concat(F.lit("Élève Noël à côté n°"), F.col("no"))
    wrong = F.when(F.col("uid") % 2 == 0, F.decode(F.encode(name, "UTF-8"), "ISO-8859-1")).otherwise(name)
    euros = F.concat(F.floor(F.col("gains") / 100), F.lit(","), F.lpad((F.col("gains") % 100).cast("string"), 2, "0"), F.lit(" €"))
    return r.select("uid", scalars.repaired(wrong).alias("name"), real(scalars.money(euros), "amount"), scalars.minutes_text(F.col("distance") * 60 + F.col("weight")).alias("time"))


REPAIRED_TEXTS = f"""{R} SELECT uid, 'Élève Noël à côté n°' || no AS name, round(gains / 100.0, 6)::DOUBLE AS amount, ((distance * 60 + weight) // 60000) || chr(39) || lpad(((distance * 60 + weight) // 1000 % 60)::VARCHAR, 2, '0') || '"' || ((distance * 60 + weight) // 100 % 10) AS "time" FROM r"""


def top_earners(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty horses with the highest gains; the lower number goes first among equals."""
    return runners(spark, sf).groupBy("horse").agg(F.sum("gains").alias("gains"), F.count(F.lit(1)).alias("runs")).orderBy(F.desc("gains"), "horse").limit(20)


TOP_EARNERS = f"{R} SELECT horse, sum(gains)::BIGINT AS gains, count(*) AS runs FROM r GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"


def sectional_gains(spark: SparkSession, sf: str) -> DataFrame:
    """Places gained since the start, strong and weak finishes, speed against the race, a stamina mark of the distance."""
    r = runners(spark, sf).withColumn("speed", F.col("gains") / F.col("distance"))
    gained = F.col("no") - F.col("position")
    return r.withColumns(race.spread("speed")).select("uid", integer(gained, "gained"), (gained >= 2).alias("strong_finish"), (gained <= -2).alias("weak_finish"), real(F.col("speed_z"), "speed_z"), real(F.col("speed_z") * F.col("distance") / 2400, "stamina"))


SECTIONAL_GAINS = f"""{R}, s AS (SELECT *, gains / distance::DOUBLE AS speed FROM r), z AS (SELECT *, CASE WHEN stddev_samp(speed) OVER w > 0 THEN (speed - avg(speed) OVER w) / stddev_samp(speed) OVER w END AS z FROM s WINDOW w AS (PARTITION BY race))
SELECT uid, (no - position)::BIGINT AS gained, no - position >= 2 AS strong_finish, no - position <= -2 AS weak_finish, {real_sql('z', 'speed_z')}, {real_sql('z * distance / 2400', 'stamina')} FROM z"""


def sire_aptitude(spark: SparkSession, sf: str) -> DataFrame:
    """Win rate of each sire's runners by distance band, against its rate over all distances."""
    r = with_tracks(runners(spark, sf), spark, sf).where("sire is not null")
    bands = r.groupBy("sire", scalars.distance_band(F.col("distance"), "C").alias("band")).agg(F.count(F.lit(1)).alias("runs"), F.sum("won").alias("wins"))
    w = Window.partitionBy("sire")
    own, all_ = F.col("wins") / F.col("runs"), F.sum("wins").over(w) / F.sum("runs").over(w)
    return bands.select("sire", "band", "runs", "wins", real(own, "rate"), real(own - all_, "aptitude"))


SIRE_APTITUDE = f"""{RT}, b AS (SELECT sire, CASE WHEN distance <= 1400 THEN 'sprint' WHEN distance <= 1800 THEN 'mile' WHEN distance <= 2200 THEN 'middle' WHEN distance <= 2800 THEN 'long' ELSE 'marathon' END AS band, count(*) AS runs, sum(won)::BIGINT AS wins FROM rt WHERE sire IS NOT NULL GROUP BY 1, 2)
SELECT sire, band, runs, wins, {real_sql('wins / runs', 'rate')}, {real_sql('wins / runs - sum(wins) OVER w / sum(runs) OVER w', 'aptitude')} FROM b WINDOW w AS (PARTITION BY sire)"""


def registry_youngest(spark: SparkSession, sf: str) -> DataFrame:
    """Registered names of one breed, the youngest entry of each, counted by brand: the thirty commonest."""
    p = table(spark, sf, "part").where(F.lower("p_type").contains("brushed"))
    youngest = p.groupBy("p_name").agg(F.max_by("p_brand", F.struct(-F.col("p_size"), -F.col("p_partkey"))).alias("brand"))
    return youngest.groupBy("brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "brand").limit(30)


REGISTRY_YOUNGEST = """WITH y AS (SELECT p_name, first(p_brand ORDER BY p_size, p_partkey) AS brand FROM part WHERE contains(lower(p_type), 'brushed') GROUP BY 1) SELECT brand, count(*) AS n FROM y GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30"""


def meeting_json(spark: SparkSession, sf: str) -> DataFrame:
    """One row per runner out of a race's nested JSON, keyed by number, amounts from cents."""
    entry = F.struct("horse", "gains", F.struct("odds").alias("market"))
    payload = F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("no").cast("string"), entry))))
    races = runners(spark, sf).groupBy("race").agg(payload.alias("payload"))
    parsed = races.select("race", F.explode(F.from_json("payload", "map<string, struct<horse: bigint, gains: bigint, market: struct<odds: double>>>")).alias("no", "x"))
    return parsed.select("race", integer(F.col("no"), "no"), F.col("x.horse").alias("horse"), real(F.col("x.gains") / 100, "euros"), real(F.col("x.market.odds"), "odds"))


MEETING_JSON = f"{R} SELECT race, no::BIGINT AS no, horse, {real_sql('gains / 100.0', 'euros')}, {real_sql('odds', 'odds')} FROM r"


def canonical_disciplines(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical names of disciplines with the number of rows that changed."""
    r = runners(spark, sf).withColumn("canonical", scalars.alias(F.col("discipline"), {"A": "trot", "R": "flat"}))
    return r.groupBy("canonical").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("canonical") != F.col("discipline")).alias("changed"))


CANONICAL_DISCIPLINES = f"""{R}, c AS (SELECT discipline, CASE discipline WHEN 'A' THEN 'trot' WHEN 'R' THEN 'flat' ELSE discipline END AS canonical FROM r) SELECT canonical, count(*) AS n, count(*) FILTER (canonical <> discipline) AS changed FROM c GROUP BY 1"""


def final_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, races, entities and dates of the whole fact by discipline."""
    r = runners(spark, sf)
    return r.groupBy("discipline").agg(F.count(F.lit(1)).alias("n"), *(F.count_distinct(c).alias(f"n_{c}") for c in ("race", "horse", "jockey")), integer(F.min("day"), "first_day"), integer(F.max("day"), "last_day"), integer(F.sum("gains"), "gains"))


FINAL_STATISTICS = f"{R} SELECT discipline, count(*) AS n, count(DISTINCT race) AS n_race, count(DISTINCT horse) AS n_horse, count(DISTINCT jockey) AS n_jockey, min(day)::BIGINT AS first_day, max(day)::BIGINT AS last_day, sum(gains)::BIGINT AS gains FROM r GROUP BY 1"

_NAMES = ("row_keys", "calendar", "freshness", "interactions", "empty_columns", "record_dedup", "source_presence", "tip_consensus", "form_years", "conditions_fields", "repaired_texts", "top_earners", "sectional_gains", "sire_aptitude", "registry_youngest", "meeting_json", "canonical_disciplines", "final_statistics")
QUERIES = {n: globals()[n] for n in _NAMES}
ORACLES = {n: globals()[n.upper()] for n in _NAMES}
