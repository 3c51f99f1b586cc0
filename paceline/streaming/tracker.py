"""Cumulative records of entities on a stream, with contexts, timers and restarts.

The batch twin is ``paceline.operators.pit.cumulative_record``: a replayed
stream gives the same rows, however it is cut into batches and wherever it is
killed, as long as the batches follow each other in time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RECORD = "runs long, wins long, places long, gains long, n_contexts long, form_runs long, form_wins long"
DAY_MS = 86_400_000


class Tracker(StatefulProcessor):
    """Before each row: what the entity has done so far; and a row of its own when nothing is heard of it for ``gap_days``.

    State per entity: its totals with the results of the last runs, and a list
    of (context, runs, wins) for each context column, which is read and written
    whole once a micro-batch, as every call to the state is a message to the
    JVM. The event-time timer is moved with every batch of rows; it fires when
    the watermark has passed the last row by the gap.
    """

    def __init__(self, contexts: list[str], order: list[str], gap_days: int, last: int):
        self.contexts, self.order, self.gap, self.last = contexts, order, gap_days, last
        self.figures = ["runs", "wins", "places", "gains", "n_contexts", "form_runs", "form_wins", *(f"{c}_{k}" for c in contexts for k in ("runs", "wins"))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "runs long, wins long, places long, gains long, n long, last_ms long, timer long, form string")
        self.met = {c: handle.getListState(f"by_{c}", "context string, runs long, wins long") for c in self.contexts}

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        runs, wins, places, gains, n, last_ms, timer, form = self.totals.get() or (0, 0, 0, 0, 0, None, None, "")
        # A new entity has no lists.
        seen: dict[str, dict[str, list[int]]] = {c: {} if last_ms is None else {name: [r, w] for name, r, w in self.met[c].get()} for c in self.contexts}
        out, gap_ms, silent_told = [], self.gap * DAY_MS, last_ms is not None and timer is None
        names = [batch[c].where(batch[c].notna(), None).tolist() for c in self.contexts]
        uids = batch["uid"].astype("Int64").astype(object).where(batch["uid"].notna(), None).tolist()
        numbers = [batch[c].astype("int64").tolist() for c in ("won", "placed", "gains")]
        times = batch["ts"].to_numpy("datetime64[ns]").astype("int64").tolist()
        for ns, uid, won, placed, gained, *named in zip(times, uids, *numbers, *names, strict=True):
            now = ns // 1_000_000
            if last_ms is not None and not silent_told and now > last_ms + gap_ms:
                out.append(self._silent(last_ms, runs, wins, places, gains, n, form))
            before, by_context = n, []
            for c, name in zip(self.contexts, named, strict=True):
                if name is None:
                    by_context += (None, None)
                    continue
                own = seen[c].setdefault(name, [0, 0])
                by_context += own
                n += c == self.contexts[0] and own[0] == 0
                own[0], own[1] = own[0] + 1, own[1] + won
            out.append(("run", uid, ns, runs, wins, places, gains, before, len(form), form.count("1"), *by_context))
            runs, wins, places, gains = runs + 1, wins + won, places + placed, gains + gained
            form = (form + ("1" if won else "0"))[-self.last :]
            last_ms, silent_told = now, False
        for c, own in seen.items():
            if own:
                self.met[c].put([(name, r, w) for name, (r, w) in own.items()])
        if timer:
            self.handle.deleteTimer(timer)
        timer = last_ms + gap_ms
        self.handle.registerTimer(timer)
        self.totals.update((runs, wins, places, gains, n, last_ms, timer, form))
        yield self._frame(key, out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        runs, wins, places, gains, n, last_ms, _, form = self.totals.get()
        self.totals.update((runs, wins, places, gains, n, last_ms, None, form))
        yield self._frame(key, [self._silent(last_ms, runs, wins, places, gains, n, form)])

    def _silent(self, last_ms: int, runs: int, wins: int, places: int, gains: int, n: int, form: str) -> tuple:
        return ("silent", None, (last_ms + self.gap * DAY_MS) * 1_000_000, runs, wins, places, gains, n, len(form), form.count("1"), *[None] * (2 * len(self.contexts)))

    def _frame(self, key: Any, rows: list[tuple]) -> pd.DataFrame:
        kind, uid, times, *figures = zip(*rows, strict=True)
        columns = {"kind": list(kind), "entity": np.full(len(rows), key[0], np.int64), "uid": _nullable(uid), "ts": np.array(times, np.int64).view("datetime64[ns]")}
        return pd.DataFrame(columns | {c: _nullable(v) for c, v in zip(self.figures, figures, strict=True)})


def _nullable(values: tuple) -> Any:
    missing = np.fromiter((v is None for v in values), bool, len(values))
    return pd.arrays.IntegerArray(np.fromiter((v or 0 for v in values), np.int64, len(values)), missing)


def tracked(runs: DataFrame, contexts: list[str], order: list[str], gap_days: int, last: int = 20) -> DataFrame:
    """Cumulative records on a stream of ``entity``, ``uid``, ``ts``, ``won``, ``placed``, ``gains`` and text contexts.

    Rows without an entity have no record and are left out; a null context
    has no figures of its own. Rows behind the watermark, the newest time of
    earlier batches, come too late and are dropped.
    """
    runs.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    schema = f"kind string, entity long, uid long, ts timestamp, {RECORD}" + "".join(f", {c}_runs long, {c}_wins long" for c in contexts)
    known = runs.where("entity is not null").withWatermark("ts", "0 seconds")
    return known.groupBy("entity").transformWithStateInPandas(Tracker(contexts, order, gap_days, last), schema, "append", "eventTime")


def appended_once(path: str) -> Callable[[DataFrame, int], None]:
    """A sink of batches by number: a batch that is written again after a failure replaces itself."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Work off what has arrived, from where the checkpoint stands, and stop."""
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def replayed(spark: SparkSession, chunks: list[DataFrame], build: Callable[[DataFrame], DataFrame], folder: str, write: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Feed chunks of history to a streaming operator, one after the other, and return all it gave.

    Every chunk is appended to the stream's folder and worked off by a query
    of its own that starts from the checkpoint of the one before, so each
    chunk is also a restart.
    """
    schema = chunks[0].schema
    for chunk in chunks:
        chunk.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        run_available(build(stream), write or appended_once(f"{folder}/out"), f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").drop("batch")


def by_time(df: DataFrame, time: str, n: int) -> list[DataFrame]:
    """``df`` in n chunks of equal spans of a whole-numbered time; equal times stay together."""
    ends = df.agg(F.min(time).alias("a"), F.max(time).alias("b")).first()
    if ends["a"] is None:
        return [df]
    width = (ends["b"] - ends["a"]) // n + 1
    return [df.where(F.col(time).between(ends["a"] + k * width, ends["a"] + (k + 1) * width - 1)) for k in range(n)]
