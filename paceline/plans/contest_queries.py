"""Queries over contests, merges of sources and entity profiles, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.operators import merge, race
from paceline.sources.tables import EVENTS_SQL, RUNNERS_SQL, TRACKS_SQL, events, runners, table, with_tracks

R, RT, E = f"WITH {RUNNERS_SQL}", f"WITH {TRACKS_SQL}", f"WITH {EVENTS_SQL}"


def market_overround(spark: SparkSession, sf: str) -> DataFrame:
    """Odds rank, favourite, normalised probability, overround, concentration and entropy of each contest."""
    m = race.market(runners(spark, sf))
    r6 = lambda c: (F.round(c, 6) + F.lit(0.0)).alias(c)
    return m.select("uid", "odds_rank", "favourite", *map(r6, ("overround", "probability", "hhi", "entropy", "entropy_share", "top1", "top3")), "field_size")


MARKET = f"""{R}, p AS (SELECT *, (1.0 / odds)::DOUBLE AS imp, count(*) OVER (PARTITION BY race) AS field_size, row_number() OVER (PARTITION BY race ORDER BY odds, no) AS odds_rank FROM r),
q AS (SELECT *, sum(imp) OVER (PARTITION BY race) AS over, imp / sum(imp) OVER (PARTITION BY race) AS prob FROM p),
z AS (SELECT *, -sum(prob * ln(prob)) OVER (PARTITION BY race) AS ent FROM q)
SELECT uid, odds_rank::INTEGER AS odds_rank, (odds_rank = 1)::INTEGER AS favourite, round(over, 6) AS overround, round(prob, 6) AS probability, round(sum(prob * prob) OVER w, 6) AS hhi, round(ent, 6) + 0.0 AS entropy,
  round(CASE WHEN field_size > 1 THEN ent / ln(field_size) END, 6) AS entropy_share, round(sum(CASE WHEN odds_rank <= 1 THEN prob END) OVER w, 6) AS top1, round(sum(CASE WHEN odds_rank <= 3 THEN prob END) OVER w, 6) AS top3, field_size
FROM z WINDOW w AS (PARTITION BY race)"""


def weight_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Competition rank by weight, gap to the top weight, top and bottom flags (ties all flagged)."""
    r, w = runners(spark, sf), race.field()
    top, low = F.max("weight").over(w), F.min("weight").over(w)
    return r.select("uid", race.competition_rank(F.desc("weight")).alias("weight_rank"), (top - F.col("weight")).alias("gap_to_top"), (F.col("weight") == top).cast("int").alias("is_top"), (F.col("weight") == low).cast("int").alias("is_bottom"))


WEIGHT_RANK = f"""{R} SELECT uid, rank() OVER (PARTITION BY race ORDER BY weight DESC)::INTEGER AS weight_rank, max(weight) OVER w - weight AS gap_to_top, (weight = max(weight) OVER w)::INTEGER AS is_top, (weight = min(weight) OVER w)::INTEGER AS is_bottom FROM r WINDOW w AS (PARTITION BY race)"""


def field_zscore(spark: SparkSession, sf: str) -> DataFrame:
    """z-score and variation of distance and weight in the contest; single entrants have none."""
    r = runners(spark, sf).withColumns(race.spread("distance")).withColumns(race.spread("weight"))
    return r.select("uid", *((F.round(c, 6) + F.lit(0.0)).alias(c) for v in ("distance", "weight") for c in (f"{v}_mean", f"{v}_sd", f"{v}_z", f"{v}_cv")))


FIELD_ZSCORE = f"""{R} SELECT uid, {", ".join(f"round(avg({v}) OVER w, 6) + 0.0 AS {v}_mean, round(stddev_samp({v}) OVER w, 6) + 0.0 AS {v}_sd, round(CASE WHEN stddev_samp({v}) OVER w > 0 THEN ({v} - avg({v}) OVER w) / stddev_samp({v}) OVER w END, 6) + 0.0 AS {v}_z, round(CASE WHEN avg({v}) OVER w <> 0 THEN stddev_samp({v}) OVER w / avg({v}) OVER w END, 6) + 0.0 AS {v}_cv" for v in ("distance", "weight"))} FROM r WINDOW w AS (PARTITION BY race)"""


def speed_vs_winner(spark: SparkSession, sf: str) -> DataFrame:
    """Distance figures against the winner's and the contest's median; known only after the race."""
    r, w = runners(spark, sf), race.field()
    lead = F.max(F.when(F.col("won") == 1, F.col("gains"))).over(w)
    return r.select("uid", (lead - F.col("gains")).alias("behind"), F.round(F.col("gains") / lead, 6).alias("ratio"), F.percentile("gains", F.lit(0.5)).over(w).alias("median_gains"))


SPEED_VS_WINNER = f"""{R} SELECT uid, max(CASE WHEN won = 1 THEN gains END) OVER w - gains AS behind, round(gains / max(CASE WHEN won = 1 THEN gains END) OVER w, 6) AS ratio, median(gains) OVER w AS median_gains FROM r WINDOW w AS (PARTITION BY race)"""


def open_race_flags(spark: SparkSession, sf: str) -> DataFrame:
    """One row per contest: field size, favourite's price and gap to the second, contenders above half an even share, openness."""
    m = race.market(runners(spark, sf)).withColumn("contender", (F.col("probability") > 1 / (2 * F.col("field_size"))).cast("int"))
    at = lambda k: F.max(F.when(F.col("odds_rank") == k, F.col("odds")))
    g = m.groupBy("race").agg(F.count(F.lit(1)).alias("field_size"), at(1).alias("favourite_odds"), (at(2) - at(1)).alias("gap"), F.sum("contender").alias("contenders"), F.max(F.when((F.col("favourite") == 1), F.col("won"))).alias("favourite_won"))
    return g.withColumn("gap", F.round("gap", 6)).withColumn("kind", F.when(F.col("favourite_odds") < 3, "dominated").when(F.coalesce("gap", F.lit(0.0)) < 2, "open").otherwise("ordinary"))


OPEN_RACE = f"""{R}, p AS (SELECT *, count(*) OVER (PARTITION BY race) AS fs, row_number() OVER (PARTITION BY race ORDER BY odds, no) AS k, (1.0 / odds)::DOUBLE AS imp FROM r), q AS (SELECT *, imp / sum(imp) OVER (PARTITION BY race) AS prob FROM p),
g AS (SELECT race, count(*) AS field_size, max(CASE WHEN k = 1 THEN odds END) AS favourite_odds, round(max(CASE WHEN k = 2 THEN odds END) - max(CASE WHEN k = 1 THEN odds END), 6) AS gap, sum((prob > 1.0 / (2 * fs))::INTEGER)::BIGINT AS contenders, max(CASE WHEN k = 1 THEN won END) AS favourite_won FROM q GROUP BY race)
SELECT *, CASE WHEN favourite_odds < 3 THEN 'dominated' WHEN coalesce(gap, 0) < 2 THEN 'open' ELSE 'ordinary' END AS kind FROM g"""


def _sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three overlapping sources of customer facts."""
    o = table(spark, sf, "orders")
    a = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    b = o.where("o_custkey % 2 = 0").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderpriority").alias("segment"), F.count(F.lit(1)).alias("orders"))
    c = table(spark, sf, "customer").where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 10 == 0, "").otherwise(F.col("c_name")).alias("segment"), (F.col("c_nationkey") % 4).alias("nation"))
    return a, b, c


SOURCES = """a AS (SELECT c_custkey AS id, c_mktsegment AS segment, c_nationkey AS nation FROM customer WHERE c_custkey % 3 <> 0),
b AS (SELECT o_custkey AS id, min(o_orderpriority) AS segment, count(*) AS orders FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1),
c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN '' ELSE c_name END AS segment, c_nationkey % 4 AS nation FROM customer WHERE c_custkey % 5 = 0)"""


def last_non_null_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Three sources merged; for each field the last source with a filled value wins (zero and empty don't count)."""
    return merge.last_filled_wins(list(_sources(spark, sf)), ["id"], ["segment", "nation", "orders"]).withColumn("nation", F.col("nation").cast("int"))


LAST_NON_NULL = f"""WITH {SOURCES}, u AS (SELECT id, segment, nation, NULL::BIGINT AS orders, 0 AS src FROM a UNION ALL SELECT id, segment, NULL, orders, 1 FROM b UNION ALL SELECT id, segment, nation, NULL, 2 FROM c)
SELECT id, arg_max(segment, src) FILTER (segment IS NOT NULL AND segment <> '') AS segment, (arg_max(nation, src) FILTER (nation <> 0))::INTEGER AS nation, arg_max(orders, src) FILTER (orders <> 0) AS orders, count(DISTINCT src)::INTEGER AS n_sources FROM u GROUP BY id"""


def full_outer_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Full outer merge of two sources with the primary's value first and its provenance."""
    a, b, _ = _sources(spark, sf)
    return merge.outer_with_provenance(a, b, ["id"], ["segment", "nation", "orders"], ("a", "b"))


FULL_OUTER = f"""WITH {SOURCES} SELECT coalesce(a.id, b.id) AS id, coalesce(a.segment, b.segment) AS segment, a.nation, b.orders, CASE WHEN b.id IS NULL THEN 'a' WHEN a.id IS NULL THEN 'b' ELSE 'a+b' END AS source FROM a FULL JOIN b ON a.id = b.id"""


def left_anti_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Base rows with the side's columns, and the side's rows without a base row appended."""
    a, b, _ = _sources(spark, sf)
    return merge.with_orphans(a.select("id", "nation"), b.select("id", "orders"), ["id"], ["orders"])


ORPHANS = f"""WITH {SOURCES} SELECT a.id, nation, orders, false AS orphan FROM a LEFT JOIN b ON a.id = b.id UNION ALL SELECT b.id, NULL, orders, true FROM b ANTI JOIN a ON a.id = b.id"""


def dedup_most_complete(spark: SparkSession, sf: str) -> DataFrame:
    """The most complete of each key's records over three sources, the first source on ties."""
    parts = [s.withColumn("src", F.lit(i)) for i, s in enumerate(_sources(spark, sf))]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return merge.keep_most_complete(both, ["id"], ["segment", "nation", "orders"], ["src"]).withColumn("nation", F.col("nation").cast("int"))


DEDUP = f"""WITH {SOURCES}, u AS (SELECT id, segment, nation, NULL::BIGINT AS orders, 0 AS src FROM a UNION ALL SELECT id, segment, NULL, orders, 1 FROM b UNION ALL SELECT id, segment, nation, NULL, 2 FROM c)
SELECT id, segment, nation::INTEGER AS nation, orders, src FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY (segment IS NOT NULL AND segment <> '')::INTEGER + (nation IS NOT NULL)::INTEGER + (orders IS NOT NULL)::INTEGER DESC, src) = 1"""


def prefixed_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their part and supplier under prefixes; each side one row per key."""
    r = runners(spark, sf).select("uid", "horse", "jockey")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("horse"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("jockey"), F.col("s_nationkey").alias("nation"))
    out = merge.prefixed_left_join(r, p, ["horse"], "ped_", [F.col("brand")])
    return merge.prefixed_left_join(out, s, ["jockey"], "act_", [F.col("nation")])


PREFIXED = f"""{R} SELECT uid, horse, jockey, p_brand AS ped_brand, p_size AS ped_size, s_nationkey AS act_nation FROM r LEFT JOIN part ON horse = p_partkey LEFT JOIN supplier ON jockey = s_suppkey"""


def composite_key_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Match events to orders by day and customer, else by customer alone (latest order)."""
    e = events(spark, sf).select("event_id", F.col("entity").alias("cust"), F.dayofmonth("ts").alias("dom"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("cust"), F.dayofmonth("o_orderdate").alias("dom"), "o_orderkey", "o_orderdate")
    return merge.fallback_join(e, o, ["cust", "dom"], ["cust"], ["o_orderkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("event_id", "o_orderkey", "matched_by")


FALLBACK = f"""{E}, o1 AS (SELECT o_custkey AS c, day(o_orderdate) AS d, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, day(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
o2 AS (SELECT o_custkey AS c, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT event_id, coalesce(o1.o_orderkey, o2.o_orderkey) AS o_orderkey, CASE WHEN o1.c IS NOT NULL THEN 1 WHEN o2.c IS NOT NULL THEN 2 ELSE 0 END AS matched_by FROM e LEFT JOIN o1 ON entity = o1.c AND day(ts) = o1.d LEFT JOIN o2 ON entity = o2.c"""


def payout_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Long payouts to one wide row per contest: an ordinal for repeated kinds, and the payouts past the second as text."""
    return merge.pivot_ordinals(runners(spark, sf), ["race"], "discipline", ["A", "N", "R"], "gains", ["no"], 2)


PAYOUT = f"""{R}, n AS (SELECT *, row_number() OVER (PARTITION BY race, discipline ORDER BY no) AS k FROM r) SELECT race, {", ".join(f"max(CASE WHEN discipline = '{d}' AND k = {i} THEN gains END) AS {d.lower()}_{i}" for d in "ANR" for i in (1, 2))}, {", ".join(f"coalesce(string_agg(CASE WHEN discipline = '{d}' AND k > 2 THEN gains::VARCHAR END, '-' ORDER BY k), '') AS {d.lower()}_rest" for d in "ANR")} FROM n GROUP BY race"""


def golden_record(spark: SparkSession, sf: str) -> DataFrame:
    """Majority value of each field of a horse over its runs, with confidence and conflicts."""
    return merge.majority(runners(spark, sf), ["horse"], ["discipline", "equipment", "draw"])


GOLDEN = f"""{R}, l AS ({" UNION ALL ".join(f"SELECT horse, '{f}' AS field, {f}::VARCHAR AS value FROM r" for f in ("discipline", "equipment", "draw"))}), v AS (SELECT horse, field, value, count(*) AS votes FROM l GROUP BY ALL)
SELECT horse, field, value, votes, votes / sum(votes) OVER w AS confidence, count(*) OVER w - 1 AS conflicts FROM v WINDOW w AS (PARTITION BY horse, field) QUALIFY row_number() OVER (PARTITION BY horse, field ORDER BY votes DESC, value) = 1"""


def gap_fill_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Fill a missing weight from the horse's mean, then the track's, then a default; later rules see earlier fills."""
    r = with_tracks(runners(spark, sf), spark, sf).withColumn("w", F.when(F.col("uid") % 7 != 0, F.col("weight")))
    by = lambda c: F.floor(F.avg("w").over(Window.partitionBy(c)))
    r = r.withColumns({"h": by("horse"), "t": by("track")})
    step = F.when(F.col("w").isNotNull(), "given").when(F.col("h").isNotNull(), "horse").when(F.col("t").isNotNull(), "track").otherwise("default")
    return r.select("uid", F.coalesce(F.col("w").cast("long"), "h", "t", F.lit(5)).cast("long").alias("weight"), step.alias("rule"))


GAP_FILL = f"""{RT}, g AS (SELECT *, CASE WHEN uid % 7 <> 0 THEN weight END AS w FROM rt), h AS (SELECT *, floor(avg(w) OVER (PARTITION BY horse)) AS h, floor(avg(w) OVER (PARTITION BY track)) AS t FROM g)
SELECT uid, coalesce(w, h, t, 5)::BIGINT AS weight, CASE WHEN w IS NOT NULL THEN 'given' WHEN h IS NOT NULL THEN 'horse' WHEN t IS NOT NULL THEN 'track' ELSE 'default' END AS rule FROM h"""


def horse_career(spark: SparkSession, sf: str) -> DataFrame:
    """Career totals of a horse: runs, wins, rates, earnings, best context with two runs or more."""
    r = runners(spark, sf)
    base = r.groupBy("horse").agg(F.count(F.lit(1)).alias("runs"), F.sum("won").alias("wins"), F.sum("placed").alias("places"), F.sum("gains").alias("gains"), F.avg("position").alias("mean_position"), F.median("odds").alias("median_odds"), F.count_distinct("jockey").alias("n_jockeys"), F.min("day").cast("long").alias("first_day"), F.max("day").cast("long").alias("last_day"))
    ctx = r.groupBy("horse", "discipline").agg(F.count(F.lit(1)).alias("n"), F.sum("won").alias("w")).where("n >= 2")
    best = ctx.withColumn("k", F.row_number().over(Window.partitionBy("horse").orderBy(F.desc(F.col("w") / F.col("n")), "discipline"))).where("k = 1").select("horse", F.col("discipline").alias("best_discipline"))
    return base.join(best, "horse", "left").withColumn("win_rate", F.col("wins") / F.col("runs"))


HORSE_CAREER = f"""{R}, b AS (SELECT horse, count(*) AS runs, sum(won)::BIGINT AS wins, sum(placed)::BIGINT AS places, sum(gains)::BIGINT AS gains, avg(position) AS mean_position, median(odds) AS median_odds, count(DISTINCT jockey) AS n_jockeys, min(day)::BIGINT AS first_day, max(day)::BIGINT AS last_day FROM r GROUP BY horse),
c AS (SELECT horse, discipline, count(*) AS n, sum(won) AS w FROM r GROUP BY ALL HAVING count(*) >= 2), d AS (SELECT horse, discipline AS best_discipline FROM c QUALIFY row_number() OVER (PARTITION BY horse ORDER BY w / n DESC, discipline) = 1)
SELECT b.*, best_discipline, wins / runs AS win_rate FROM b LEFT JOIN d USING (horse)"""


def jockey_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a jockey with windows that end at its own last race, and its three commonest partners."""
    r = runners(spark, sf).withColumn("last", F.max("day").over(Window.partitionBy("jockey")))
    within = lambda d: F.col("day") >= F.col("last") - d
    cols = [x for d in (30, 90, 365) for x in (F.count_if(within(d)).alias(f"runs_{d}"), F.sum(F.when(within(d), F.col("won")).otherwise(0)).alias(f"wins_{d}"))]
    base = r.groupBy("jockey").agg(F.count(F.lit(1)).alias("runs"), F.sum("won").alias("wins"), *cols)
    top = r.groupBy("jockey", "trainer").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.row_number().over(Window.partitionBy("jockey").orderBy(F.desc("n"), "trainer"))).where("k <= 3")
    partners = top.groupBy(F.col("jockey").alias("of")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "trainer"))), lambda x: x["trainer"].cast("string")), ",").alias("partners"))
    return base.join(partners, F.col("jockey").eqNullSafe(F.col("of")), "left").drop("of")


JOCKEY_PROFILE = f"""{R}, l AS (SELECT *, max(day) OVER (PARTITION BY jockey) AS last FROM r), t AS (SELECT jockey, trainer, row_number() OVER (PARTITION BY jockey ORDER BY n DESC, trainer) AS k FROM (SELECT jockey, trainer, count(*) AS n FROM r GROUP BY jockey, trainer)),
p AS (SELECT jockey, string_agg(trainer::VARCHAR, ',' ORDER BY k) AS partners FROM t WHERE k <= 3 GROUP BY jockey)
SELECT l.jockey, count(*) AS runs, sum(won)::BIGINT AS wins, {", ".join(f"count(*) FILTER (day >= last - {d}) AS runs_{d}, coalesce(sum(won) FILTER (day >= last - {d}), 0)::BIGINT AS wins_{d}" for d in (30, 90, 365))}, any_value(partners) AS partners FROM l JOIN p ON l.jockey IS NOT DISTINCT FROM p.jockey GROUP BY l.jockey"""


def track_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Track totals: favourite win rate, field sizes, commonest discipline, winners' odds, draw bias in the first third."""
    r = with_tracks(race.market(runners(spark, sf)), spark, sf)
    modal = r.groupBy("track", "discipline").count().withColumn("k", F.row_number().over(Window.partitionBy("track").orderBy(F.desc("count"), "discipline"))).where("k = 1").select(F.col("track").alias("of"), F.col("discipline").alias("modal_discipline"))
    low = F.col("draw") * 3 <= F.col("field_size")
    g = r.groupBy("track").agg(F.count(F.lit(1)).alias("runs"), F.count_distinct("race").alias("races"), F.sum("favourite").alias("favourites"), F.sum(F.col("favourite") * F.col("won")).alias("favourite_wins"), F.avg("field_size").alias("mean_field"), F.median("field_size").alias("median_field"), F.median(F.when(F.col("won") == 1, F.col("odds"))).alias("winner_odds"), F.sum(F.when(low, F.col("won")).otherwise(0)).alias("low_draw_wins"))
    return g.join(modal, F.col("track").eqNullSafe(F.col("of")), "left").drop("of")


TRACK_PROFILE = f"""{RT}, m AS (SELECT *, count(*) OVER (PARTITION BY race) AS field_size, (row_number() OVER (PARTITION BY race ORDER BY odds, no) = 1)::INTEGER AS favourite FROM rt), d AS (SELECT track, discipline AS modal_discipline FROM (SELECT track, discipline, count(*) AS n FROM rt GROUP BY track, discipline) QUALIFY row_number() OVER (PARTITION BY track ORDER BY n DESC, discipline) = 1)
SELECT m.track, count(*) AS runs, count(DISTINCT race) AS races, sum(favourite)::BIGINT AS favourites, sum(favourite * won)::BIGINT AS favourite_wins, avg(field_size) AS mean_field, median(field_size) AS median_field, median(CASE WHEN won = 1 THEN odds END) AS winner_odds, sum(CASE WHEN draw * 3 <= field_size THEN won ELSE 0 END)::BIGINT AS low_draw_wins, any_value(modal_discipline) AS modal_discipline FROM m JOIN d ON m.track IS NOT DISTINCT FROM d.track GROUP BY m.track"""


def coverage_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of each discipline in each year of the table, with a zero where it had none, and its share of the year."""
    n = runners(spark, sf).groupBy("discipline", F.year("race_date").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    cells = n.select("discipline").distinct().crossJoin(F.broadcast(n.select("year").distinct()))  # disciplines by years
    out = cells.join(n, ["discipline", "year"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("year")), 6))


COVERAGE = f"""{R}, y AS (SELECT DISTINCT year(race_date)::INTEGER AS year FROM r), d AS (SELECT DISTINCT discipline FROM r)
SELECT d.discipline, y.year, count(uid) AS n, round(count(uid) / sum(count(uid)) OVER (PARTITION BY y.year), 6) AS share FROM d CROSS JOIN y LEFT JOIN r ON r.discipline = d.discipline AND year(race_date) = y.year GROUP BY 1, 2"""


def completeness_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Fill counts over year, discipline and their totals by grouping sets."""
    r = runners(spark, sf).withColumns({"year": F.year("race_date"), "w": F.when(F.col("uid") % 7 != 0, F.col("weight"))})
    return r.rollup("year", "discipline").agg(F.count(F.lit(1)).alias("n"), F.count("w").alias("filled"), F.grouping_id().cast("int").alias("level"))


ROLLUP = f"""{R}, x AS (SELECT *, year(race_date)::INTEGER AS year, CASE WHEN uid % 7 <> 0 THEN weight END AS w FROM r) SELECT year, discipline, count(*) AS n, count(w) AS filled, grouping(year, discipline)::INTEGER AS level FROM x GROUP BY ROLLUP (year, discipline)"""


def arrival_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Draw numbers missing below the largest and drawn twice, of each contest."""
    g = runners(spark, sf).groupBy("race").agg(F.collect_set("draw").alias("have"), F.max("draw").alias("most"), F.count(F.lit(1)).alias("n"))
    missing = F.array_join(F.sort_array(F.array_except(F.sequence(F.lit(1), "most"), "have")), ",")
    return g.select("race", missing.alias("missing"), (F.col("n") - F.size("have")).cast("long").alias("n_repeated"))


ARRIVAL_GAPS = f"""{R}, g AS (SELECT race, list(DISTINCT draw) AS have, max(draw) AS most, count(*) AS n FROM r GROUP BY race)
SELECT race, coalesce(array_to_string([i FOR i IN range(1, most + 1) IF NOT list_contains(have, i)], ','), '') AS missing, (n - len(have))::BIGINT AS n_repeated FROM g"""


def top_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """The three best paid horses of each discipline."""
    g = runners(spark, sf).groupBy("discipline", "horse").agg(F.sum("gains").alias("gains"))
    return g.withColumn("rank", F.row_number().over(Window.partitionBy("discipline").orderBy(F.desc("gains"), "horse"))).where("rank <= 3")


TOP_PER_GROUP = f"""{R} SELECT *, row_number() OVER (PARTITION BY discipline ORDER BY gains DESC, horse)::INTEGER AS rank FROM (SELECT discipline, horse, sum(gains)::BIGINT AS gains FROM r GROUP BY discipline, horse) QUALIFY rank <= 3"""


def set_operations(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of two sources: union, intersection and both differences, counted."""
    a, b, _ = _sources(spark, sf)
    a, b = a.select("id"), b.select("id")
    parts = {"union": a.union(b).distinct(), "both": a.intersect(b), "only_a": a.exceptAll(b), "only_b": b.exceptAll(a)}
    out = [d.agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("total")).select(F.lit(k).alias("part"), "n", "total") for k, d in parts.items()]
    return out[0].union(out[1]).union(out[2]).union(out[3])


SET_OPS = f"""WITH {SOURCES}, x AS (SELECT id FROM a), y AS (SELECT id FROM b), s AS (SELECT 'union' AS part, id FROM (SELECT * FROM x UNION SELECT * FROM y) UNION ALL SELECT 'both', id FROM (SELECT * FROM x INTERSECT SELECT * FROM y) UNION ALL SELECT 'only_a', id FROM (SELECT * FROM x EXCEPT SELECT * FROM y) UNION ALL SELECT 'only_b', id FROM (SELECT * FROM y EXCEPT SELECT * FROM x))
SELECT part, count(*) AS n, sum(id)::BIGINT AS total FROM s GROUP BY part"""

QUERIES = {f.__name__: f for f in (market_overround, weight_rank, field_zscore, speed_vs_winner, open_race_flags, last_non_null_wins, full_outer_provenance, left_anti_orphans, dedup_most_complete, prefixed_left_join, composite_key_fallback, payout_pivot, golden_record, gap_fill_cascade, horse_career, jockey_profile, track_profile, coverage_matrix, completeness_rollup, arrival_gaps, top_per_group, set_operations)}
ORACLES = dict(zip(QUERIES, (MARKET, WEIGHT_RANK, FIELD_ZSCORE, SPEED_VS_WINNER, OPEN_RACE, LAST_NON_NULL, FULL_OUTER, ORPHANS, DEDUP, PREFIXED, FALLBACK, PAYOUT, GOLDEN, GAP_FILL, HORSE_CAREER, JOCKEY_PROFILE, TRACK_PROFILE, COVERAGE, ROLLUP, ARRIVAL_GAPS, TOP_PER_GROUP, SET_OPS), strict=True))
