"""Queries over ancestors, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.operators import lineage
from paceline.plans.form_queries import integer, real, real_sql
from paceline.sources.tables import PEDIGREE_SQL, pedigree

GENERATIONS = 4


def ancestor_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Known ancestors of each horse within four generations, how far they reach, whether one stands on several paths, and its nick (sire and dam's sire)."""
    ped = pedigree(spark, sf)
    paths = lineage.ancestor_paths(ped, "horse", "sire", "dam", GENERATIONS)
    found = paths.groupBy(F.col("animal").alias("horse")).agg(F.countDistinct("ancestor").alias("n"), F.count(F.lit(1)).alias("n_paths"), F.max("steps").alias("reach"))
    maternal = ped.select(F.col("horse").alias("dam"), F.col("sire").alias("dam_sire"))
    out = ped.join(found, "horse", "left").join(maternal, "dam", "left")
    known = F.coalesce("n", F.lit(0))
    nick = F.when(F.col("sire").isNotNull() & F.col("dam_sire").isNotNull(), F.concat_ws("|", "sire", "dam_sire"))
    return out.select("horse", integer(known, "n_ancestors"), integer(F.coalesce("reach", F.lit(0)), "generations"), (F.coalesce("n_paths", F.lit(0)) > known).alias("repeated"), nick.alias("nick"))


def inbreeding(spark: SparkSession, sf: str) -> DataFrame:
    """Wright's coefficient of every horse whose sire and dam have a common ancestor within four generations."""
    paths = lineage.ancestor_paths(pedigree(spark, sf), "horse", "sire", "dam", GENERATIONS)
    out = lineage.inbreeding(paths)
    return out.select(F.col("animal").alias("horse"), integer(F.col("n_common"), "n_common"), integer(F.col("nearest"), "nearest"), real(F.col("inbreeding"), "inbreeding"))


def sire_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Founder of every horse's line of sires and the steps to it."""
    return lineage.lines(pedigree(spark, sf), "horse", "sire").select(F.col("animal").alias("horse"), "founder", integer(F.col("depth"), "depth"))


def ancestor_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Ancestors that both sides of a horse have, their share of all, and whether one side has an ancestor on several paths."""
    ped = pedigree(spark, sf)
    paths = lineage.ancestor_paths(ped, "horse", "sire", "dam", GENERATIONS)
    sides = paths.groupBy("animal").pivot("side", ["sire", "dam"]).agg(F.collect_list("ancestor"))
    none = F.array().cast("array<long>")
    both = ped.select(F.col("horse").alias("animal")).join(sides, "animal", "left").select(F.col("animal").alias("horse"), F.coalesce("sire", none).alias("a"), F.coalesce("dam", none).alias("b"))
    common, total = F.size(F.array_intersect("a", "b")), F.size(F.array_union("a", "b"))
    twice = lambda c: F.size(c) > F.size(F.array_distinct(c))
    return both.select("horse", integer(common, "n_common"), integer(total, "n_total"), real(F.try_divide(common, total), "overlap"), (twice("a") | twice("b")).alias("repeated"))


_PATHS_SQL = f"""WITH RECURSIVE {PEDIGREE_SQL},
step AS (SELECT horse AS id, 'sire' AS side, sire AS up FROM ped WHERE sire IS NOT NULL UNION ALL SELECT horse, 'dam', dam FROM ped WHERE dam IS NOT NULL),
path AS (SELECT id, side, up AS a, [up] AS way, 1 AS n FROM step
  UNION ALL SELECT path.id, path.side, step.up, list_append(way, step.up), n + 1 FROM path JOIN step ON step.id = path.a WHERE n < {GENERATIONS} AND NOT list_contains(way, step.up) AND step.up <> path.id)"""

ANCESTOR_SUMMARY = f"""{_PATHS_SQL}, found AS (SELECT id, count(DISTINCT a) AS n, count(*) AS paths, max(n) AS reach FROM path GROUP BY id)
SELECT ped.horse, coalesce(found.n, 0) AS n_ancestors, coalesce(reach, 0)::BIGINT AS generations, coalesce(paths, 0) > coalesce(found.n, 0) AS repeated,
  CASE WHEN ped.sire IS NOT NULL AND up.sire IS NOT NULL THEN ped.sire || '|' || up.sire END AS nick
FROM ped LEFT JOIN found ON found.id = ped.horse LEFT JOIN ped AS up ON up.horse = ped.dam"""

INBREEDING = f"""{_PATHS_SQL},
pair AS (SELECT s.id, s.a, s.n + d.n AS steps FROM path AS s JOIN path AS d ON s.id = d.id AND s.a = d.a WHERE s.side = 'sire' AND d.side = 'dam' AND NOT list_has_any(s.way[1:-2], d.way[1:-2])),
f1 AS (SELECT id, sum(pow(0.5, steps - 1)) AS f FROM pair GROUP BY id),
f2 AS (SELECT pair.id, sum(pow(0.5, steps - 1) * (1 + coalesce(f1.f, 0))) AS f FROM pair LEFT JOIN f1 ON f1.id = pair.a GROUP BY pair.id),
f3 AS (SELECT pair.id, sum(pow(0.5, steps - 1) * (1 + coalesce(f2.f, 0))) AS f, count(DISTINCT a) AS n, min(steps) AS nearest FROM pair LEFT JOIN f2 ON f2.id = pair.a GROUP BY pair.id)
SELECT id AS horse, n AS n_common, nearest::BIGINT AS nearest, {real_sql("f", "inbreeding")} FROM f3"""

SIRE_LINES = f"""WITH RECURSIVE {PEDIGREE_SQL},
above AS (SELECT horse, horse AS top, 0 AS depth FROM ped UNION ALL SELECT above.horse, ped.sire, depth + 1 FROM above JOIN ped ON ped.horse = above.top WHERE ped.sire IS NOT NULL)
SELECT horse, arg_max(top, depth) AS founder, max(depth)::BIGINT AS depth FROM above GROUP BY horse"""

ANCESTOR_OVERLAP = f"""{_PATHS_SQL},
side AS (SELECT id, coalesce(list(a) FILTER (side = 'sire'), []) AS a, coalesce(list(a) FILTER (side = 'dam'), []) AS b FROM path GROUP BY id),
every AS (SELECT horse, coalesce(a, []) AS a, coalesce(b, []) AS b FROM ped LEFT JOIN side ON side.id = ped.horse)
SELECT horse, len(list_intersect(a, b))::BIGINT AS n_common, len(list_distinct(a || b))::BIGINT AS n_total, {real_sql("len(list_intersect(a, b)) / nullif(len(list_distinct(a || b)), 0)", "overlap")},
  len(a) > len(list_distinct(a)) OR len(b) > len(list_distinct(b)) AS repeated FROM every"""

QUERIES = {f.__name__: f for f in (ancestor_summary, inbreeding, sire_lines, ancestor_overlap)}
ORACLES = {"ancestor_summary": ANCESTOR_SUMMARY, "inbreeding": INBREEDING, "sire_lines": SIRE_LINES, "ancestor_overlap": ANCESTOR_OVERLAP}
