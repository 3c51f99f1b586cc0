"""Point-in-time operators: what is known of an entity before a row.

Four frames are kept apart on purpose: earlier days only (strict day), the
last n rows of earlier days, a trailing number of days, and every row before
this one in a total order (sequential). A row whose entity is null keeps its
place in the output and has no history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from paceline.sources.shared import kept

Keys = str | list[str]


def _keys(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def known(keys: Keys) -> Column:
    """Whether all of an entity's keys are there."""
    out = F.lit(True)
    for k in _keys(keys):
        out = out & F.col(k).isNotNull()
    return out


def of(entity: Keys, *alone: str) -> WindowSpec:
    """An entity's rows. Rows without one stand apart by the columns ``alone``, so they share no history and make no hot partition."""
    return Window.partitionBy(*_keys(entity), F.when(~known(entity), F.struct(*alone)))


def apart(df: DataFrame, entity: Keys, *alone: str) -> DataFrame:
    """``df`` with ``_alone``, by which rows without an entity stand apart as in ``of``. Windows over one such column share a shuffle; each ``of`` takes its own."""
    return df.withColumn("_alone", F.when(~known(entity), F.struct(*alone)))


def gathered(df: DataFrame, entity: Keys, *alone: str) -> DataFrame:
    """``df`` as by ``apart``, shuffled by the entity. All windows ``inside`` it share that shuffle, also those over further keys."""
    return apart(df, entity, *alone).repartition(*_keys(entity), "_alone")


def inside(entity: Keys, *keys: str) -> WindowSpec:
    """Rows of a gathered entity that have the same further ``keys``; those without a key are together, so figures over them need ``known``."""
    return Window.partitionBy(*_keys(entity), "_alone", *keys)


def in_order(entity: Keys, *order: str) -> WindowSpec:
    """An entity's rows in a total order; a row without an entity is alone."""
    return of(entity, *order).orderBy(*order)


def strict_day(entity: Keys, day: str = "day") -> WindowSpec:
    """Rows of the entity on earlier days; rows of one day don't see each other."""
    return of(entity, day).orderBy(day).rangeBetween(Window.unboundedPreceding, -1)


def trailing_days(entity: Keys, days: int, day: str = "day") -> WindowSpec:
    """Rows of the entity on the ``days`` days before this one, today excluded."""
    return of(entity, day).orderBy(day).rangeBetween(-days, -1)


def sequential(entity: Keys, *order: str, last: int | None = None, skip: int = 0) -> WindowSpec:
    """Rows of the entity before this one in a total order, or the ``last`` of them after skipping ``skip``."""
    start = Window.unboundedPreceding if last is None else -(last + skip)
    return in_order(entity, *order).rowsBetween(start, -1 - skip)


def rate(hits: Column, n: Column) -> Column:
    """hits / n, null without any."""
    return F.try_divide(hits.cast("double"), n)


def history(df: DataFrame, entity: Keys, frame: WindowSpec, prefix: str, won: str = "won", placed: str = "placed") -> DataFrame:
    """Runs, wins, places and win rate within a frame."""
    own = known(entity)
    runs, wins, places = F.count(F.when(own, 1)).over(frame), F.coalesce(F.sum(F.when(own, F.col(won))).over(frame), F.lit(0)), F.coalesce(F.sum(F.when(own, F.col(placed))).over(frame), F.lit(0))
    return df.withColumns({f"{prefix}_runs": runs, f"{prefix}_wins": wins, f"{prefix}_places": places}).withColumn(f"{prefix}_win_rate", rate(F.col(f"{prefix}_wins"), F.col(f"{prefix}_runs")))


def daily_history(df: DataFrame, keys: list[str], prefix: str, sums: dict[str, str] | None = None, days: int | None = None, day: str = "day") -> DataFrame:
    """Runs, wins, win rate and other sums of earlier days, or of the ``days`` before."""
    return daily_histories(df, keys, {prefix: days}, sums, day)


def daily_histories(df: DataFrame, keys: list[str], frames: dict[str, int | None], sums: dict[str, str] | None = None, day: str = "day", rows: DataFrame | None = None) -> DataFrame:
    """Runs, wins, win rate and other sums within several frames: prefix and number of days before, or None for all earlier ones.

    The rows (``rows``, or ``df`` itself) are first added up by day, so that a
    frame has at most one row a day however busy the entity is, and joined
    back on the entity and its day.
    """
    sums = {"wins": "won"} | (sums or {})
    rows = df if rows is None else rows
    by_day = rows.where(known(keys)).groupBy(*keys, day).agg(F.count(F.lit(1)).alias("_runs"), *(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    frame = lambda days: strict_day(keys, day) if days is None else trailing_days(keys, days, day)
    totals = {f"{p}_{n}": F.coalesce(F.sum(f"_{n}").over(frame(days)), F.lit(0)) for p, days in frames.items() for n in ("runs", *sums)}
    past = by_day.select(*keys, day, *(c.alias(n) for n, c in totals.items()))
    out = df.join(past, [*keys, day], "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in totals})
    return out.withColumns({f"{p}_win_rate": rate(F.col(f"{p}_wins"), F.col(f"{p}_runs")) for p in frames})


def daily_histories_of(df: DataFrame, entities: dict[str, list[str]], sums: dict[str, dict[str, str]] | None = None, days: int | None = None, day: str = "day") -> DataFrame:
    """``daily_history`` for several entities by prefix. ``df`` is stored once and each entity is added up from it, not from the result of the one before."""
    rows = out = kept(df, "histories")
    for prefix, keys in entities.items():
        out = daily_histories(out, keys, {prefix: days}, (sums or {}).get(prefix), day, rows)
    return out


def histories_inside(df: DataFrame, entity: str, others: dict[str, str], *alone: str, day: str = "day") -> DataFrame:
    """Runs and wins on earlier days of an entity's pairs with other columns, by prefix: one shuffle for all pairs. The entity's rows are sorted in one task."""
    out = gathered(df, entity, *alone)
    for prefix, other in others.items():
        frame = inside(entity, other).orderBy(day).rangeBetween(Window.unboundedPreceding, -1)
        own = known([entity, other, day])
        out = out.withColumns({f"{prefix}_runs": F.when(own, F.count(F.lit(1)).over(frame)).otherwise(0), f"{prefix}_wins": F.when(own, F.coalesce(F.sum("won").over(frame), F.lit(0))).otherwise(0)})
    return out.drop("_alone")


def of_earlier_days(df: DataFrame, entity: Keys, order: list[str], figures: dict[str, tuple[int, Column]], day: str = "day") -> DataFrame:
    """Add figures over the last n rows of earlier days: name, n and an aggregate each.

    They are taken at the entity's first row of a day, from the n rows before
    it, and its later rows of that day repeat them: one shuffle and one sort
    for all figures, and no join.
    """
    total = [day, *(c for c in order if c != day)]
    rows = Window.partitionBy(*_keys(entity), "_alone").orderBy(*total)
    starts = (F.row_number().over(rows) == 1) | ~F.lag(day).over(rows).eqNullSafe(F.col(day))
    taken = F.struct(*(c.over(rows.rowsBetween(-n, -1)).alias(k) for k, (n, c) in figures.items()))
    found = apart(df, entity, *total).withColumns({"_starts": starts, "_taken": taken})
    carried = F.last(F.when(F.col("_starts"), F.col("_taken")), ignorenulls=True).over(rows.rowsBetween(Window.unboundedPreceding, 0))
    return found.withColumn("_taken", carried).select(*df.columns, "_taken.*")


def last_n_of_earlier_days(df: DataFrame, entity: Keys, n: int, order: list[str], values: list[str], out: str = "last", day: str = "day") -> DataFrame:
    """Array ``out`` of the last n rows (newest first) of earlier days, as structs of ``values``."""
    row = F.struct(*order, *(v for v in values if v not in order))
    return of_earlier_days(df, entity, order, {out: (n, F.collect_list(row))}, day).withColumn(out, F.reverse(out))


def streak(df: DataFrame, entity: Keys, order: list[str], hit: str, out: str, day: str = "day") -> DataFrame:
    """Length of the run of hits that ends with the last row of earlier days."""
    rank = F.row_number().over(of(entity, day).orderBy(*order))
    frame = strict_day(entity, day)
    last, miss = F.max("_rn").over(frame), F.max(F.when(F.col(hit) == 0, F.col("_rn"))).over(frame)
    return df.withColumn("_rn", rank).withColumn(out, F.coalesce(last, F.lit(0)) - F.coalesce(miss, F.lit(0))).drop("_rn")


def rows_since(df: DataFrame, entity: Keys, order: list[str], hit: str, out: str, day: str = "day") -> DataFrame:
    """Rows of earlier days since the last hit; null if there was none."""
    rank = F.row_number().over(of(entity, day).orderBy(*order))
    frame = strict_day(entity, day)
    return df.withColumn("_rn", rank).withColumn(out, F.max("_rn").over(frame) - F.max(F.when(F.col(hit) == 1, F.col("_rn"))).over(frame)).drop("_rn")


def running_distinct(df: DataFrame, entity: Keys, value: str, order: list[str], out: str) -> DataFrame:
    """Distinct known values among the rows before this one."""
    keys = _keys(entity)
    first = (F.row_number().over(Window.partitionBy(*keys, value).orderBy(*order)) == 1) & known([*keys, value])
    return df.withColumn("_first", first.cast("int")).withColumn(out, F.coalesce(F.sum("_first").over(sequential(keys, *order)), F.lit(0))).drop("_first")


def band_history(df: DataFrame, entity: Keys, value: str, width: int, aggregates: dict[str, Column], key: str, day: str = "day") -> DataFrame:
    """Aggregates over the entity's rows of earlier days whose ``value`` is within ``width``.

    Values are cut into bands of that width; a row meets its own band and the
    two beside it by an equi-join. ``aggregates`` refer to the past row's
    columns by the prefix ``past_``.
    """
    keys = _keys(entity)
    band = F.floor(F.col(value) / width)
    past = df.select(*(F.col(c).alias(f"past_{c}") for c in df.columns), *keys, band.alias("_band"))
    probe = df.select(key, *keys, value, day, F.explode(F.array(band - 1, band, band + 1)).alias("_band"))
    met = probe.join(past, [*keys, "_band"]).where((F.col(f"past_{day}") < F.col(day)) & (F.abs(F.col(f"past_{value}") - F.col(value)) <= width))
    return df.join(met.groupBy(key).agg(*(c.alias(n) for n, c in aggregates.items())), key, "left")


def as_of(left: DataFrame, right: DataFrame, keys: Keys, left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """Left rows with the values of the newest right row strictly before them: one union and one window, no range join."""
    keys = _keys(keys)
    a = left.select(*keys, F.col(left_time).alias("_t"), F.lit(0).alias("_side"), F.struct(*left.columns).alias("_left"), F.lit(None).alias("_right"))
    b = right.select(*keys, F.col(right_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).alias("_left"), F.struct(*values).alias("_right"))
    frame = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, -1)
    both = a.unionByName(b).withColumn("_found", F.last("_right", ignorenulls=True).over(frame))
    return both.where("_side = 0").select("_left.*", *(F.col(f"_found.{v}").alias(v) for v in values))


def best_context(df: DataFrame, entity: Keys, context: str, order: list[str], key: str, hit: str = "won", least: int = 2, few: int = 32) -> DataFrame:
    """Context with the best hit rate so far among those with enough rows; the earliest seen wins ties.

    With at most ``few`` contexts in all (bands, surfaces) each has its running
    counts beside each other, over one shuffle and one sort. Otherwise the
    rows are spread over the entity's own contexts, at a cost of rows times
    contexts.
    """
    found = [r[0] for r in df.where(known(entity) & F.col(context).isNotNull()).select(context).distinct().limit(few + 1).collect()]
    if len(found) > few:
        return _best_context_spread(df, entity, context, order, key, hit, least)
    kind = df.schema[context].dataType
    rows = Window.partitionBy(*_keys(entity), "_alone").orderBy(*order)
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    here = lambda c, value: F.when(F.col(context) == F.lit(c), value)
    counts = {f"_{k}{i}": g(here(c, v)).over(before) for i, c in enumerate(found) for k, g, v in (("n", F.count, F.lit(1)), ("w", F.sum, F.col(hit)), ("s", F.min, F.col("_at")))}
    rate = lambda i: F.col(f"_w{i}") / F.col(f"_n{i}")
    one = lambda i, c: F.when(F.col(f"_n{i}") >= least, F.struct(F.coalesce(-rate(i), F.lit(float("inf"))).alias("order"), F.col(f"_s{i}").alias("seen"), F.lit(c).cast(kind).alias("context"), rate(i).alias("rate")))
    top = F.array_min(F.array(*(one(i, c) for i, c in enumerate(found)))) if found else F.lit(None).cast(StructType([StructField("context", kind), StructField("rate", DoubleType())]))
    counted = apart(df, entity, *order).withColumn("_at", F.row_number().over(rows)).withColumns(counts).withColumn("_top", top)
    return counted.select(*df.columns, F.col("_top.context").alias("best_context"), F.col("_top.rate").alias("best_rate"))


def _best_context_spread(df: DataFrame, entity: Keys, context: str, order: list[str], key: str, hit: str, least: int) -> DataFrame:
    keys = _keys(entity)
    own = df.groupBy(*keys, F.col(context).alias("_ctx")).agg(F.min(F.struct(*order)).alias("_seen"))
    dense = df.join(own, keys).withColumn("_here", (F.col(context) == F.col("_ctx")).cast("int"))
    frame = Window.partitionBy(*keys, "_ctx").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = dense.withColumns({"_n": F.sum("_here").over(frame), "_w": F.sum(F.col("_here") * F.col(hit)).over(frame)}).where(F.col("_n") >= least)
    best = Window.partitionBy(key).orderBy(F.desc(F.col("_w") / F.col("_n")), "_seen")
    top = sums.withColumn("_k", F.row_number().over(best)).where("_k = 1").select(key, F.col("_ctx").alias("best_context"), (F.col("_w") / F.col("_n")).alias("best_rate"))
    return df.join(top, key, "left")


def slope(y: Column, x: Column, frame: WindowSpec) -> Column:
    """Least-squares slope of y over x within a frame."""
    return F.regr_slope(y, x).over(frame)


def per_actor(build: Callable[[DataFrame, str], DataFrame], df: DataFrame, actors: list[str]) -> DataFrame:
    """The same features for several roles, each built on the last result."""
    for actor in actors:
        df = build(df, actor)
    return df


def cumulative_record(df: DataFrame, entity: str, contexts: list[str], order: list[str], last: int = 20) -> DataFrame:
    """What an entity has done before each row, in a total order: totals, number of contexts of the first kind, the last results, and figures within each context.

    Adds ``runs``, ``wins``, ``places``, ``gains``, ``n_contexts``, ``form_runs``,
    ``form_wins`` and ``<context>_runs`` and ``_wins`` from ``won``, ``placed``
    and ``gains``. Without an entity all are null, without a context its own.
    """
    before, recent = sequential(entity, *order), sequential(entity, *order, last=last)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    first = (F.row_number().over(Window.partitionBy(entity, contexts[0]).orderBy(*order)) == 1) & F.col(contexts[0]).isNotNull()
    figures = {"runs": F.count(F.lit(1)).over(before), "wins": total("won", before), "places": total("placed", before), "gains": total("_gains", before), "n_contexts": total("_first", before), "form_runs": F.count(F.lit(1)).over(recent), "form_wins": total("won", recent)}
    out = df.withColumns({"_gains": F.col("gains"), "_first": first.cast("int")}).withColumns({k: F.when(known(entity), v) for k, v in figures.items() if k != "gains"} | {"_total": F.when(known(entity), figures["gains"])})
    for c in contexts:
        own = sequential([entity, c], *order)
        out = out.withColumns({f"{c}_runs": F.when(known([entity, c]), F.count(F.lit(1)).over(own)), f"{c}_wins": F.when(known([entity, c]), total("won", own))})
    return out.withColumn("gains", F.col("_total")).drop("_gains", "_first", "_total")


def silences(df: DataFrame, entity: str, day: str, gap: int) -> DataFrame:
    """``entity`` and ``last_day`` of every stretch of more than ``gap`` days without a row, or of at least ``gap`` up to the newest day of all."""
    days = df.where(known(entity)).select(entity, day).distinct()
    newest = days.agg(F.max(day).alias("_newest"))
    after = days.withColumn("_next", F.lead(day).over(Window.partitionBy(entity).orderBy(day)))
    out = after.join(F.broadcast(newest), F.when(F.col("_next").isNull(), F.col("_newest") - F.col(day) >= gap).otherwise(F.col("_next") - F.col(day) > gap))
    return out.select(entity, F.col(day).alias("last_day"))


def rank_before(df: DataFrame, entity: str, value: str, key: str, day: str = "day", few: int = 512) -> DataFrame:
    """Add ``n_before``, ``n_below`` and ``n_equal``: the entity's rows of earlier days, those of a smaller and of the same ``value``.

    An entity of at most ``few`` rows compares each with those before it, in one
    window. For the others ranks are counted by merging runs of rows: values are cut into blocks that
    double in width, a row meets the blocks that make up all smaller values,
    and each block keeps a running count over the days, so their rows are never
    paired with each other. ``value`` is a whole number, not negative.
    """
    v = F.col(value)
    own = Window.partitionBy(entity, "_alone")
    sized = apart(df, entity, day).withColumn("_rows", F.count(F.lit(1)).over(own))
    seen = F.when(known(entity) & v.isNotNull(), F.collect_list(value).over(own.orderBy(day).rangeBetween(Window.unboundedPreceding, -1)))
    of_few = sized.where(~known(entity) | (F.col("_rows") <= few)).withColumn("_seen", F.coalesce(seen, F.array().cast(f"array<{dict(df.dtypes)[value]}>")))
    counts = {"n_before": F.size("_seen"), "n_below": F.size(F.filter("_seen", lambda x: x < v)), "n_equal": F.size(F.filter("_seen", lambda x: x == v))}
    ranked = of_few.withColumns({k: c.cast("long") for k, c in counts.items()}).drop("_rows", "_seen", "_alone")
    return ranked.unionByName(_rank_by_blocks(sized.where(known(entity) & (F.col("_rows") > few)).drop("_rows", "_alone"), entity, value, key, day))


def _rank_by_blocks(df: DataFrame, entity: str, value: str, key: str, day: str) -> DataFrame:
    levels = max(1, int(df.agg(F.max(value).alias("m")).first()["m"] or 0).bit_length())
    rows = df.where(known(entity) & F.col(value).isNotNull())
    level = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    # Level k has blocks of 2 ** k values. A value's smaller ones are the left neighbours of its blocks wherever its bit is set.
    every = rows.select(entity, day, key, F.col(value).alias("_v"), level.alias("_k"))
    block = F.expr("shiftright(_v, _k)")
    added = every.groupBy(entity, "_k", block.alias("_b"), day).agg(F.count(F.lit(1)).alias("_n"))
    odd = (block % 2 == 1) & (F.col("_k") < levels)
    asks = every.where(odd).select(entity, "_k", (block - 1).alias("_b"), day, key, F.lit("below").alias("_what")).unionByName(every.where("_k = 0").select(entity, "_k", block.alias("_b"), day, key, F.lit("equal").alias("_what"))).unionByName(every.where(F.col("_k") == levels).select(entity, "_k", block.alias("_b"), day, key, F.lit("before").alias("_what")))
    counted = added.select(entity, "_k", "_b", day, "_n", F.lit(None).cast(dict(df.dtypes)[key]).alias(key), F.lit(None).cast("string").alias("_what"))
    both = counted.unionByName(asks.withColumn("_n", F.lit(0).cast("long")))
    frame = Window.partitionBy(entity, "_k", "_b").orderBy(day).rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("_sum", F.coalesce(F.sum("_n").over(frame), F.lit(0))).where("_what is not null")
    sums = found.groupBy(key).agg(*(F.sum(F.when(F.col("_what") == w, F.col("_sum")).otherwise(0)).alias(f"n_{w}") for w in ("before", "below", "equal")))
    return df.join(sums, key, "left").withColumns({f"n_{w}": F.coalesce(f"n_{w}", F.lit(0)) for w in ("before", "below", "equal")})


def last_known(df: DataFrame, entity: Keys, value: str, n: int, order: list[str], frame: WindowSpec, out: str) -> DataFrame:
    """The last n rows within ``frame`` that have a ``value``, however many without one lie between.

    ``frame`` is any frame of the entity's first rows: earlier days, or all
    rows before. Adds ``out`` (values, newest first), ``<out>_n`` (how many
    there are in all), ``<out>_sum``, ``<out>_squares`` and ``<out>_max`` over
    all of them. A row with a value knows these up to itself, and a row takes
    them from the last such row of its frame, so nothing is joined.
    """
    return _last_known(apart(df, entity, *order), entity, value, n, order, frame, out).drop("_alone")


def last_known_values(df: DataFrame, entity: Keys, values: dict[str, tuple[str, int]], order: list[str], within: Callable[[WindowSpec], WindowSpec]) -> DataFrame:
    """``last_known`` for several values (``out``: value and n) over one shuffle; ``within`` makes the frame from the window of the entity's rows."""
    df = apart(df, entity, *order)
    for out, (value, n) in values.items():
        df = _last_known(df, entity, value, n, order, within(Window.partitionBy(*_keys(entity), "_alone")), out)
    return df.drop("_alone")


def _last_known(df: DataFrame, entity: Keys, value: str, n: int, order: list[str], frame: WindowSpec, out: str) -> DataFrame:
    keys, v = _keys(entity), F.col(value)
    own = known(keys) & v.isNotNull()
    mine = Window.partitionBy(*keys, "_alone", own).orderBy(*order)
    up_to = mine.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = F.struct(
        F.row_number().over(mine).alias("at"),
        F.reverse(F.collect_list(v).over(mine.rowsBetween(1 - n, 0))).alias("values"),
        F.sum(v).over(up_to).alias("sum"),
        F.sum(v.cast("double") * v).over(up_to).alias("squares"),
        F.max(v).over(up_to).alias("max"),
    )
    counted = df.withColumn(f"{out}_n", F.when(known(keys), F.count(v).over(frame)).otherwise(0))
    found = counted.withColumn("_state", F.when(own, state)).withColumn("_state", F.max("_state").over(frame))
    return found.withColumns({out: F.col("_state.values"), **{f"{out}_{c}": F.col(f"_state.{c}") for c in ("sum", "squares", "max")}}).drop("_state")
