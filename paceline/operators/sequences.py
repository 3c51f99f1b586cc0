"""Sequential detectors with reset, as folds over one segment's ordered values.

A segment (a model, a track) is read as a sorted stream in one task, which
holds only the detector's state; Spark's sort spills what doesn't fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Adds the next value (None if unknown) to a segment's state and says whether it raises an alarm.
Step = Callable[[float | None], bool]


def alarms(df: DataFrame, key: str, order: str, value: str, detector: Callable[[], Step]) -> DataFrame:
    """Number of alarms of each segment and index of the last; rows of equal order go by value."""
    rows = df.select(F.col(key).alias("key"), F.col(order).alias("order"), F.col(value).cast("double").alias("v"))
    ordered = rows.repartition("key").sortWithinPartitions("key", "order", "v").select("key", "v")
    schema = T.StructType([T.StructField(key, ordered.schema["key"].dataType), T.StructField("alarms", T.IntegerType()), T.StructField("last_alarm", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, step, i, n, last, kind = None, None, 0, 0, 0, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([n], pa.int32()), pa.array([last], pa.int32())], names=schema.names)

        for b in batches:
            kind = b.schema.field("key").type
            for k, v in zip(b["key"].to_pylist(), b["v"].to_pylist(), strict=True):
                if step is None or k != key:
                    if step is not None:
                        yield row()
                    key, step, i, n, last = k, detector(), 0, 0, 0
                i += 1
                if step(v):
                    n, last = n + 1, i
        if step is not None:
            yield row()

    return ordered.mapInArrow(run, schema)


def cusum(target: float, slack: float, limit: float) -> Callable[[], Step]:
    """Two-sided CUSUM; both sums restart after an alarm, and at an unknown value."""

    def start() -> Step:
        up = down = 0.0

        def step(v: float | None) -> bool:
            nonlocal up, down
            if v is None:
                up = down = 0.0
                return False
            up, down = max(0.0, up + v - target - slack), max(0.0, down - v + target - slack)
            hit = up > limit or down > limit
            if hit:
                up = down = 0.0
            return hit

        return step

    return start


def page_hinkley(delta: float, limit: float) -> Callable[[], Step]:
    """Page-Hinkley test for a rise of the mean; the mean keeps its index over resets of the sum, and is unknown from an unknown value on."""

    def start() -> Step:
        mean, m, least, i = 0.0, 0.0, 0.0, 0

        def step(v: float | None) -> bool:
            nonlocal mean, m, least, i
            if v is None or mean is None:
                mean = None
                return False
            i += 1
            mean += (v - mean) / i
            m += v - mean - delta
            least = min(least, m)
            hit = m - least > limit
            if hit:
                m = least = 0.0
            return hit

        return step

    return start
