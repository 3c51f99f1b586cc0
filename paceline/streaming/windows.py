"""Streaming counterparts of the batch windows and histories."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def tumbling(events: DataFrame, time: str, width: str, keys: list[str], late: str) -> DataFrame:
    """Counts and sums per window; rows later than ``late`` behind the newest are dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def sliding(events: DataFrame, time: str, width: str, slide: str, keys: list[str], late: str) -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.window(time, width, slide), *keys).agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, time: str, gap: str, keys: list[str], late: str) -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count(F.lit(1)).alias("n"))


def running_record(events: DataFrame, entity: str, hit: str) -> DataFrame:
    """Runs and hits of an entity so far, updated batch by batch; the state is two numbers an entity."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        runs, hits = state.get if state.exists else (0, 0)
        for b in batches:
            runs, hits = runs + len(b), hits + int(b[hit].sum())
        state.update((runs, hits))
        yield pd.DataFrame({entity: [key[0]], "runs": [runs], "hits": [hits]})

    kind = events.schema[entity].dataType.simpleString()
    return events.groupBy(entity).applyInPandasWithState(update, f"{entity} {kind}, runs long, hits long", "runs long, hits long", "update", GroupStateTimeout.NoTimeout)
