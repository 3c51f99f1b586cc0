"""The streaming record: equal to the batch one however it is cut, restarted or killed, with timers for silent entities."""

import datetime

import pytest
from pyspark.sql import functions as F

from paceline.operators import pit
from paceline.streaming.tracker import Tracker, appended_once, by_time, replayed, run_available, tracked

ORDER, CONTEXTS = ["day", "race"], ["track", "kind_of"]
SCHEMA = "entity long, uid long, day int, race int, ts timestamp, won int, placed int, gains long, track string, kind_of string"
FIGURES = ["entity", "uid", "runs", "wins", "places", "gains", "n_contexts", "form_runs", "form_wins", "track_runs", "track_wins", "kind_of_runs", "kind_of_wins"]
BEGIN = datetime.datetime(2024, 1, 1)


def rows(days, entities=5):
    out = []
    for d in days:
        for e in range(entities):
            if (d * 7 + e * 3) % 4 == 0 or (e == 4 and 20 < d < 60):
                continue
            for race in range(1 + (d + e) % 2):
                won = int((d + e + race) % 3 == 0)
                out.append((e, d * 1000 + e * 10 + race, d, race, BEGIN + datetime.timedelta(days=d), won, int((d + e) % 2), d * 5 + e, [None, "north", "south"][(d + race) % 3], "abc"[e % 3]))
    return out


def found(out):
    return sorted(map(tuple, out.where("kind = 'run'").select(*FIGURES).collect()), key=repr)


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(rows(range(80)) + [(None, 1, 5, 0, BEGIN, 1, 1, 1, "north", "a")], SCHEMA)


@pytest.fixture(scope="module")
def batch(runs):
    return sorted(map(tuple, pit.cumulative_record(runs.where("entity is not null"), "entity", CONTEXTS, ORDER).select(*FIGURES).collect()), key=repr)


def build(stream):
    return tracked(stream, CONTEXTS, ORDER, 15)


@pytest.mark.parametrize("n", [1, 4])
def test_replay_equals_the_batch_record(spark, runs, batch, tmp_path, n):
    out = replayed(spark, by_time(runs, "day", n), build, f"file://{tmp_path}")
    assert found(out) == batch
    silent = sorted((r.entity, (r.ts - BEGIN).days - 15) for r in out.where("kind = 'silent'").collect())
    assert silent == sorted(tuple(r) for r in pit.silences(runs, "entity", "day", 15).collect()) and (4, 19) in silent


def test_killed_in_a_batch_and_restarted(spark, runs, batch, tmp_path):
    folder, write = f"file://{tmp_path}", appended_once(f"file://{tmp_path}/out")
    chunks, failed = by_time(runs, "day", 4), []

    def breaks(df, number):
        write(df.limit(3), number)  # a part is out when the job dies
        failed.append(number)
        raise RuntimeError("killed")

    replayed(spark, chunks[:2], build, folder)
    chunks[2].write.mode("append").parquet(f"{folder}/in")
    stream = lambda: build(spark.readStream.schema(runs.schema).parquet(f"{folder}/in"))
    with pytest.raises(Exception, match="killed"):
        run_available(stream(), breaks, f"{folder}/checkpoint")
    assert failed
    out = replayed(spark, chunks[3:], build, folder)
    assert found(out) == batch


def test_late_rows_are_dropped_and_a_voice_after_silence_goes_on(spark, tmp_path):
    early, late = rows(range(30), 2), rows([3], 1)
    back = [(0, 999_999, 70, 0, BEGIN + datetime.timedelta(days=70), 1, 1, 7, "north", "a")]
    frames = [spark.createDataFrame(x, SCHEMA) for x in (early, late, back)]
    out = replayed(spark, frames, build, f"file://{tmp_path}")
    assert out.where("uid = 999999").first()["runs"] == sum(r[0] == 0 for r in early)
    assert out.where("kind = 'run'").count() == len(early) + 1
    assert {r.entity for r in out.where("kind = 'silent'").collect()} == {0, 1}


def test_unknown_entities_and_contexts_in_the_batch_record(spark, runs):
    out = pit.cumulative_record(runs, "entity", CONTEXTS, ORDER)
    assert out.count() == runs.count()
    nobody = out.where("entity is null").first()
    assert nobody["runs"] is None and nobody["gains"] is None and nobody["track_runs"] is None
    assert out.where("track is null and track_runs is not null").count() == 0
    assert out.where(F.col("runs").isNull()).count() == 1


class Handle:
    """A state store that counts its calls."""

    def __init__(self):
        self.calls = 0

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            return False if name == "containsKey" else None

        made = {"getValueState", "getMapState", "getListState"}
        return (lambda *_: self) if name in made else call


def test_calls_to_the_state_do_not_grow_with_the_contexts_met():
    import pandas as pd

    calls = []
    for n in (5, 200):
        handle, own = Handle(), Tracker(CONTEXTS, ORDER, 15, 20)
        own.init(handle)
        data = [(1, i, i, 0, BEGIN + datetime.timedelta(days=i), i % 2, 1, i, f"track {i}", f"kind {i}") for i in range(n)]
        (out,) = own.handleInputRows((1,), iter([pd.DataFrame(data, columns=[c.split()[0] for c in SCHEMA.split(", ")])]), None)
        assert out["n_contexts"].tolist() == list(range(n)) and out["gains"].iloc[-1] == sum(range(n - 1))
        calls.append(handle.calls)
    assert calls[0] == calls[1] < 10
