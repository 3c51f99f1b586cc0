"""Exact nearest neighbours in a few dimensions, without comparing everything with everything.

Points are dealt to the cells of a tree that halves each axis a few levels at
a time, until a cell holds few of them. Queries go down the tree together: of
the cells that may hold one of a query's k nearest points, those farther than
its bound are dropped, and the bound is the distance within which the cells
left surely hold k points. Only then are points met, cell by cell.

Equal points are kept k at most, equal queries once, so a third of all rows in
one place costs no more than a row. Keys that many queries share are joined
by a broadcast of bounded length (``skew.looked_up``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.operators.skew import joined_by_hot_key, looked_up
from paceline.sources.shared import kept

#: Bits of an axis in a cell's number: three axes fit a long.
BITS = 20
#: Levels that a step goes down.
STEP = 2
EARTH_KM = 6371.0088


def _cell(axes: list[Column], level: int) -> Column:
    """Number of the cell at a level, of points scaled to [0, 1]."""
    at = lambda z: F.least(F.greatest(F.floor(z * F.lit(float(1 << level))), F.lit(0)), F.lit((1 << level) - 1)).cast("long")
    return reduce(lambda a, b: F.shiftleft(a, BITS).bitwiseOR(b), (at(z) for z in axes))


def _sides(cell: Column, level: Column, dims: int) -> list[tuple[Column, Column]]:
    """Lower and upper end of a cell on each axis."""
    width = F.pow(F.lit(2.0), -level)
    number = lambda i: F.shiftright(cell, BITS * (dims - 1 - i)).bitwiseAND(F.lit((1 << BITS) - 1))
    return [(number(i) * width, (number(i) + 1) * width) for i in range(dims)]


def _tree(points: DataFrame, axes: list[str], full: int) -> tuple[DataFrame, DataFrame]:
    """Cells (``cell``, ``level``, ``n``, ``leaf`` and their ``parent``) and the points with their leaf; a leaf has at most ``full`` rows, or can't be halved any more."""
    cols, rest, cells, leaves = [F.col(a) for a in axes], points, [], []
    last = BITS // STEP * STEP
    for level in range(STEP, last + 1, STEP):
        rest = rest.withColumn("cell", _cell(cols, level))
        counts = kept(rest.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.lit(level).alias("level"), F.first(_cell(cols, level - STEP)).alias("parent")).withColumn("leaf", (F.col("n") <= full) | F.lit(level == last)), "cells")
        total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
        placed = kept(looked_up(rest, counts.select("cell", "n", "level", "leaf"), ["cell"], "n", total), "placed")
        cells.append(counts)
        leaves.append(placed.where("leaf").drop("leaf"))
        rest = placed.where("not leaf").drop("leaf", "level", "cell")
        if level == last or rest.isEmpty():
            break
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return union(cells), union(leaves)


def nearest(queries: DataFrame, points: DataFrame, axes: list[str], k: int, key: str, scale: dict[str, float] | None = None, full: int | None = None, carry: tuple[str, ...] = (), measure: Callable[[Column], Column] | None = None, slack: float = 0.0) -> DataFrame:
    """The k points nearest to each query: columns of ``queries``, ``neighbour`` (the point's key), ``distance`` and ``rank`` from 1.

    Euclidean distance over ``axes`` (one to three numeric columns of both
    tables), each divided by its range over all rows or by ``scale``. Equal
    distances are ranked by the key. Queries and points with a null or
    non-finite axis, and points without a key, have no distance: such
    queries are left out. With fewer than k points all are returned.

    ``measure`` is a finer distance from the query's row to a point, of which
    it gets the columns ``carry``. All points up to ``slack`` (scaled) beyond
    the k-th are weighed by it, and it ranks them.
    """
    dims, full = len(axes), full or max(4 * k, 32)
    if not 1 <= dims <= 3:
        raise ValueError("one to three axes")
    fine = reduce(lambda a, b: a & b, (F.col(a).isNotNull() & ~F.isnan(F.col(a).cast("double")) & (F.abs(F.col(a).cast("double")) != F.lit(float("inf"))) for a in axes))
    queries, points = queries.where(fine), points.where(fine & F.col(key).isNotNull()).select(F.col(key).alias("neighbour"), *axes, *carry)
    ends = queries.select(*axes).unionByName(points.select(*axes)).agg(*(f(F.col(a).cast("double")).alias(f"{n}_{a}") for a in axes for n, f in (("lo", F.min), ("hi", F.max)))).first()
    low = {a: ends[f"lo_{a}"] or 0.0 for a in axes}
    unit = {a: (scale or {}).get(a) or ((ends[f"hi_{a}"] or 0.0) - low[a]) or 1.0 for a in axes}
    # Cells are cubes of the scaled space, so all axes share the widest span.
    widest = max([((ends[f"hi_{a}"] or 0.0) - low[a]) / unit[a] for a in axes] + [1e-300])
    names = [f"_z{i}" for i in range(dims)]
    scaled = lambda df: df.withColumns({z: (F.col(a).cast("double") - F.lit(low[a])) / F.lit(unit[a]) for z, a in zip(names, axes, strict=True)})
    first = Window.partitionBy(*names, *carry).orderBy("neighbour")
    distinct = scaled(points).drop(*axes).dropDuplicates(["neighbour", *names, *carry]).withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= k).drop("_k")
    share = [f"_u{i}" for i in range(dims)]
    spread = lambda df: df.withColumns({u: F.col(z) / F.lit(widest) for u, z in zip(share, names, strict=True)})
    cells, placed = _tree(kept(spread(distinct), "points"), share, full)
    asked = kept(spread(scaled(queries).select(*names).distinct()).withColumn("_q", F.monotonically_increasing_id()), "asked")

    below = cells.groupBy(F.col("parent").alias("cell"), (F.col("level") - STEP).alias("level")).agg(F.collect_list(F.struct("cell", F.col("level").cast("int").alias("level"), "n", "leaf")).alias("below"))
    below = kept(below.select(F.struct("level", "cell").alias("at"), "below"), "below")
    now = asked.select("_q", *share, F.lit(0).alias("level"), F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("leaf"))
    for level in range(0, BITS, STEP):
        going = now.where("not leaf")
        if going.isEmpty():
            break
        met = joined_by_hot_key(going.select("_q", *share, F.struct("level", "cell").alias("at")), below.where(F.col("at.level") == level), "at")
        reached = met.select("_q", *share, F.explode("below").alias("to")).select("_q", *share, "to.level", "to.cell", "to.n", "to.leaf")
        every = reached.unionByName(now.where("leaf").select(*reached.columns))
        sides = _sides(F.col("cell"), F.col("level"), dims)
        gap = [F.greatest(F.lit(0.0), a - F.col(u), F.col(u) - b) for u, (a, b) in zip(share, sides, strict=True)]
        span = [F.greatest(F.abs(F.col(u) - a), F.abs(F.col(u) - b)) for u, (a, b) in zip(share, sides, strict=True)]
        length = lambda parts: F.sqrt(reduce(lambda a, b: a + b, (p * p for p in parts)))
        bounded = every.withColumns({"near": length(gap), "far": length(span)})
        so_far = F.sum("n").over(Window.partitionBy("_q").orderBy("far").rangeBetween(Window.unboundedPreceding, Window.currentRow))
        bounded = bounded.withColumn("so_far", so_far)
        bound = F.coalesce(F.min(F.when(F.col("so_far") >= k, F.col("far"))).over(Window.partitionBy("_q")), F.lit(float("inf")))
        # A little more than the bound, for what is lost in rounding.
        now = kept(bounded.withColumn("bound", bound).where("near <= bound * (1 + 1e-9) + 1e-12").select(*now.columns), "cells-left")
    leaf = placed.groupBy(F.struct("level", "cell").alias("at")).agg(F.collect_list(F.struct("neighbour", *names, *carry)).alias("points"))
    pairs = joined_by_hot_key(now.where("leaf").select("_q", F.struct("level", "cell").alias("at")), leaf, "at").join(asked.select("_q", *(F.col(z).alias(f"q{z}") for z in names)), "_q")
    pairs = pairs.select("_q", *(f"q{z}" for z in names), F.explode("points").alias("p"))
    distance = F.sqrt(reduce(lambda a, b: a + b, ((F.col(f"q{z}") - F.col("p")[z]) * (F.col(f"q{z}") - F.col("p")[z]) for z in names)))
    pairs = pairs.select("_q", F.col("p.neighbour").alias("neighbour"), distance.alias("distance"), *(F.col("p")[c].alias(f"_at_{c}") for c in carry))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("_q").orderBy("distance", "neighbour")))
    if measure:
        last = F.max(F.when(F.col("rank") <= k, F.col("distance"))).over(Window.partitionBy("_q"))
        ranked = ranked.withColumn("_last", last).where(F.col("distance") <= F.col("_last") + slack)
    else:
        ranked = ranked.where(F.col("rank") <= k)
    found = ranked.groupBy("_q").agg(F.array_sort(F.collect_list(F.struct("rank", "neighbour", "distance", *(F.col(f"_at_{c}").alias(c) for c in carry)))).alias("_found")).join(asked.select("_q", F.struct(*names).alias("_z")), "_q").select("_z", "_found")
    out = joined_by_hot_key(scaled(queries).withColumn("_z", F.struct(*names)).drop(*names), found, "_z")
    if measure:
        weighed = F.slice(F.array_sort(F.transform("_found", lambda x: F.struct(measure(x).alias("distance"), x["neighbour"].alias("neighbour")))), 1, k)
        return out.select(*queries.columns, F.posexplode(weighed).alias("_place", "_one")).select(*queries.columns, "_one.neighbour", "_one.distance", (F.col("_place") + 1).alias("rank"))
    return out.select(*queries.columns, F.explode("_found").alias("_one")).select(*queries.columns, "_one.neighbour", "_one.distance", "_one.rank")


def imputed_by_neighbours(df: DataFrame, value: str, axes: list[str], k: int, key: str, scale: dict[str, float] | None = None) -> DataFrame:
    """``df`` with the missing ``value`` replaced by the mean of its k nearest rows that have one.

    Rows that miss an axis as well keep the null. ``key`` is unique.
    """
    known = df.where(F.col(value).isNotNull())
    gaps = df.where(F.col(value).isNull())
    near = nearest(gaps.select(key, *axes), known.select(key, *axes), axes, k, key, scale)
    values = joined_by_hot_key(near.select(F.col(key).alias("_row"), "neighbour", "rank"), known.select(F.col(key).alias("neighbour"), F.col(value).cast("double").alias("_value")), "neighbour")
    # Summed in the order of the ranks, so that the mean doesn't depend on the partitions.
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "_value"))), lambda x: x["_value"])
    means = values.groupBy("_row").agg(ordered.alias("_all")).select("_row", (F.aggregate("_all", F.lit(0.0), lambda a, x: a + x) / F.size("_all")).alias("_mean"))
    filled = gaps.join(means, gaps[key] == means["_row"], "left").select(*(F.col("_mean").alias(c) if c == value else gaps[c] for c in df.columns))
    return known.withColumn(value, F.col(value).cast("double")).select(*df.columns).unionByName(filled)


def on_sphere(lat: Column, lon: Column) -> dict[str, Column]:
    """Points of the unit sphere, on which straight distances order places as distances over ground do, at poles and the date line too."""
    a, b = F.radians(lat), F.radians(lon)
    return {"_x": F.cos(a) * F.cos(b), "_y": F.cos(a) * F.sin(b), "_w": F.sin(a)}


def nearest_places(places: DataFrame, stations: DataFrame, key: str, k: int = 1, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The k stations nearest to each place: columns of ``places``, ``neighbour``, ``km`` (great circle) and ``rank``.

    Places without coordinates have none and are left out. Straight distances
    find the candidates; coordinates that differ by no more than their last
    digits are told apart by the haversine of the angles, which keeps digits
    that points of the sphere have lost. Equal distances go by the key.
    """
    axes, a, o = ["_x", "_y", "_w"], F.radians(F.col(lat).cast("double")), F.radians(F.col(lon).cast("double"))
    put = lambda df: df.withColumns(on_sphere(F.col(lat).cast("double"), F.col(lon).cast("double")))
    half = lambda x: F.pow(F.sin(x / 2), F.lit(2.0))
    to = lambda x: (F.radians(x["_lat"]), F.radians(x["_lon"]))
    km = lambda x: 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(half(to(x)[0] - a) + F.cos(to(x)[0]) * F.cos(a) * half(to(x)[1] - o))))
    there = put(stations).withColumns({"_lat": F.col(lat).cast("double"), "_lon": F.col(lon).cast("double")})
    near = nearest(put(places), there, axes, k, key, dict.fromkeys(axes, 1.0), carry=("_lat", "_lon"), measure=km, slack=1e-13)
    return near.withColumnRenamed("distance", "km").drop(*axes)
