"""Every history over tables in which a fifth of the horses and trainers are unknown: no row is lost, and each unknown is like a newcomer of its own."""

import duckdb
import pandas as pd
import pytest

from paceline.operators import pit
from paceline.plans.registry import ORACLES, QUERIES
from tests.test_queries import SMALL, TABLES, cells

HISTORIES = (
    "pit_actor_history form_last_n form_windows form_sequential form_days trailing_days win_streak run_changes rest_and_layoff recent_tracks pair_histories context_specialists optimal_going "
    "purse_percentile position_series series_reset equipment_change entity_snapshot_global context_affinity optimal_distance band_distance_rate cumulative_record"
).split()
#: These show what all unknown rows have in common by design.
TOGETHER = {"entity_snapshot_global"}


#: In these, entrants of one contest see those before them, so a contest's trainer has to be known.
SEQUENTIAL = ("duo_affinity", "jt_combo_synergy")


@pytest.fixture(scope="module")
def unknown(tmp_path_factory):
    return without(tmp_path_factory.mktemp("unknown"), trainers=True)


@pytest.fixture(scope="module")
def unknown_horses(tmp_path_factory):
    return without(tmp_path_factory.mktemp("horses"), trainers=False)


def without(at, trainers):
    """The tables with nulls, and a database in which every null is a number of its own that sorts where null does."""
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE TABLE {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    db.execute("CREATE OR REPLACE TABLE lineitem AS SELECT * REPLACE (CASE WHEN (l_orderkey * 7 + l_linenumber) % 5 = 0 THEN -1000000 + row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice) ELSE l_partkey END AS l_partkey) FROM lineitem")
    if trainers:
        db.execute("CREATE OR REPLACE TABLE orders AS SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 1 THEN -1000000 + o_orderkey ELSE o_custkey END AS o_custkey) FROM orders")
    for t in TABLES:
        nulls = {"lineitem": "CASE WHEN l_partkey >= 0 THEN l_partkey END AS l_partkey", "orders": "CASE WHEN o_custkey >= 0 THEN o_custkey END AS o_custkey"}
        db.execute(f"COPY (SELECT * {f'REPLACE ({nulls[t]})' if t in nulls else ''} FROM {t}) TO '{at}/{t}.parquet'")
    return f"file://{at}", db


@pytest.mark.parametrize("name", HISTORIES)
def test_unknown_entities(spark, unknown, name):
    path, db = unknown
    found, expected = QUERIES[name](spark, path).toPandas(), db.execute(ORACLES[name]).df()
    assert len(found) == len(expected)
    hide = lambda df: df.drop(columns=[c for c in ("horse", "trainer") if c in df.columns])
    if name not in TOGETHER:
        assert cells(hide(found)) == cells(hide(expected))


@pytest.mark.parametrize("name", SEQUENTIAL)
def test_unknown_horses(spark, unknown_horses, name):
    path, db = unknown_horses
    assert cells(QUERIES[name](spark, path).toPandas()) == cells(db.execute(ORACLES[name]).df())


def test_distinct_values_are_known_ones(spark):
    rows = [(1, 1, "a"), (1, 2, None), (1, 3, "b"), (1, 4, "a"), (None, 5, "a"), (None, 6, "b"), (1, 7, "c")]
    out = pit.running_distinct(spark.createDataFrame(rows, "who int, at int, what string"), "who", "what", ["at"], "n")
    assert [r.n for r in out.orderBy("at").collect()] == [0, 1, 1, 2, 0, 0, 2]


@pytest.mark.parametrize(("name", "key"), [("jockey_profile", "jockey"), ("track_profile", "track"), ("trainer_table", "trainer"), ("horse_career", "horse")])
def test_profiles_keep_the_unknown(spark, unknown, name, key):
    found = QUERIES[name](spark, unknown[0]).toPandas()
    runs = found["runs"].sum()
    assert runs == pd.read_parquet(f"{SMALL}/lineitem.parquet").shape[0]
    if key in ("trainer", "horse"):
        assert found[key].isna().sum() == 1
