"""Queries over streams that are replayed from the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.operators import pit
from paceline.sources.shared import kept, shared_path
from paceline.sources.tables import EPOCH, TRACKS_SQL, runners, with_tracks
from paceline.streaming.tracker import by_time, replayed, tracked

ORDER = ["day", "race", "no"]
CONTEXTS = ["sire", "discipline"]
GAP_DAYS = 20
CHUNKS = 3
COLUMNS = ["kind", "entity", "uid", "day", "runs", "wins", "places", "gains", "n_contexts", "form_runs", "form_wins", *(f"{c}_{k}" for c in CONTEXTS for k in ("runs", "wins"))]


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    r = with_tracks(runners(spark, sf), spark, sf)
    return r.select(F.col("jockey").alias("entity"), "uid", *ORDER, F.col("race_date").cast("timestamp").alias("ts"), "won", "placed", "gains", *CONTEXTS)


def cumulative_record(spark: SparkSession, sf: str) -> DataFrame:
    """A jockey's record before each run: totals, sires met, the last 20 results, and figures by sire and discipline."""
    out = pit.cumulative_record(_runs(spark, sf), "entity", CONTEXTS, ORDER)
    return out.select(*(F.col(c).cast("long").alias(c) for c in COLUMNS if c != "kind"))


def tracker_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The same record from a stream: history is replayed in chunks, each by a query that restarts from the checkpoint; a jockey who isn't heard of for 20 days gives a row of its own."""
    chunks = by_time(kept(_runs(spark, sf), "tracker-runs"), "day", CHUNKS)
    out = replayed(spark, chunks, lambda stream: tracked(stream, CONTEXTS, ORDER, GAP_DAYS), shared_path(spark, "tracker"))
    return out.withColumn("day", F.datediff(F.col("ts").cast("date"), F.lit(EPOCH))).select("kind", *(F.col(c).cast("long").alias(c) for c in COLUMNS if c != "kind"))


_RECORD_SQL = f"""WITH {TRACKS_SQL},
x AS (SELECT jockey AS entity, uid, day, race, no, won, placed, gains, sire, discipline,
  (row_number() OVER (PARTITION BY jockey, sire ORDER BY day, race, no) = 1 AND sire IS NOT NULL)::INTEGER AS fresh FROM rt),
w AS (SELECT *, count(*) OVER a AS runs_until, sum(won) OVER a AS wins_until, sum(placed) OVER a AS places_until, sum(gains) OVER a AS gains_until, sum(fresh) OVER a AS contexts_until,
  sum(won) OVER recent AS form_until, coalesce(sum(won) OVER earlier, 0) AS form_before, count(*) OVER s AS sire_n, coalesce(sum(won) OVER s, 0) AS sire_w, count(*) OVER d AS discipline_n, coalesce(sum(won) OVER d, 0) AS discipline_w,
  lead(day) OVER (PARTITION BY entity ORDER BY day, race, no) AS next_day, max(day) OVER () AS newest FROM x
  WINDOW a AS (PARTITION BY entity ORDER BY day, race, no), recent AS (PARTITION BY entity ORDER BY day, race, no ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
  earlier AS (PARTITION BY entity ORDER BY day, race, no ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING),
  s AS (PARTITION BY entity, sire ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), d AS (PARTITION BY entity, discipline ORDER BY day, race, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
run AS (SELECT 'run' AS kind, entity, uid, day::BIGINT AS day, runs_until - 1 AS runs, (wins_until - won)::BIGINT AS wins, (places_until - placed)::BIGINT AS places, (gains_until - gains)::BIGINT AS gains, (contexts_until - fresh)::BIGINT AS n_contexts,
  least(runs_until - 1, 20) AS form_runs, form_before::BIGINT AS form_wins, CASE WHEN sire IS NOT NULL THEN sire_n END AS sire_runs, CASE WHEN sire IS NOT NULL THEN sire_w END::BIGINT AS sire_wins,
  CASE WHEN discipline IS NOT NULL THEN discipline_n END AS discipline_runs, CASE WHEN discipline IS NOT NULL THEN discipline_w END::BIGINT AS discipline_wins FROM w)"""
CUMULATIVE_RECORD = f"{_RECORD_SQL} SELECT * EXCLUDE (kind) FROM run"
TRACKER_REPLAY = f"""{_RECORD_SQL} SELECT * FROM run UNION ALL
SELECT 'silent', entity, NULL, day + {GAP_DAYS}, runs_until, wins_until::BIGINT, places_until::BIGINT, gains_until::BIGINT, contexts_until::BIGINT, least(runs_until, 20), form_until::BIGINT, NULL, NULL, NULL, NULL
FROM w WHERE CASE WHEN next_day IS NULL THEN newest - day >= {GAP_DAYS} ELSE next_day - day > {GAP_DAYS} END"""

QUERIES = {"cumulative_record": cumulative_record, "tracker_replay": tracker_replay}
ORACLES = {"cumulative_record": CUMULATIVE_RECORD, "tracker_replay": TRACKER_REPLAY}
