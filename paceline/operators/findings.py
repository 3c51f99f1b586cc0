"""Statistics for reports: significance of returns, monthly figures with missing shares, rules by field names, anomalies of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Coefficients of the rational approximation of the normal tail (Abramowitz and Stegun, 26.2.17), good to 7.5e-8.
TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
TAIL_STEP = 0.2316419
# Parts of field names and the range that they promise; names of any sign come first, then those above zero.
ANY_SIGN = ("variation_cote", "delta", "diff", "ecart_cote", "temperature", "temp")
ABOVE_ZERO = ("cote", "cote_probable", "cote_depart", "cote_actuelle", "rapport_simple", "rapport_couple", "distance", "distance_course", "dist", "numero", "allocation", "prix", "dotation", "age", "poids", "poids_jockey", "handicap_poids")
NOT_BELOW_ZERO = ("place", "rang", "classement", "gain", "gains", "gains_carriere", "gain_annee", "nb_courses", "nb_victoires", "nb_places", "temps", "reduction_km", "temps_km", "ecart")


def normal_tail(z: Column) -> Column:
    """Probability of a standard normal value above ``z``, for z of 0 or more."""
    t = 1 / (1 + TAIL_STEP * z)
    poly = F.lit(0.0)
    for c in reversed(TAIL):
        poly = (poly + F.lit(c)) * t
    return F.exp(-z * z / 2) / F.sqrt(2 * F.pi()) * poly


def significance(df: DataFrame, keys: list[str], value: str, null_mean: float = 0.0, least: int = 2) -> DataFrame:
    """Per key the ``n``, ``mean``, ``z`` of the mean against ``null_mean``, two-sided ``p_value`` and the 95 % interval ``low`` to ``high``.

    Null below ``least`` values, and where all values are equal.
    """
    g = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("_sd"))
    error = F.when((F.col("n") >= least) & (F.col("_sd") > 0), F.col("_sd") / F.sqrt("n"))
    out = g.withColumn("z", (F.col("mean") - null_mean) / error)
    p = F.when(F.col("z").isNotNull(), F.least(F.lit(1.0), 2 * normal_tail(F.abs("z"))))
    return out.withColumns({"p_value": p, "low": F.col("mean") - 1.96 * error, "high": F.col("mean") + 1.96 * error}).drop("_sd")


def monthly(df: DataFrame, date: str, columns: list[str]) -> DataFrame:
    """Rows, missing per cent, mean, deviation (0 for one value), ends of each column by month; one scan for all columns."""
    cell = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("v")) for c in columns)))
    long = df.select(F.date_format(date, "yyyy-MM").alias("period"), cell.alias("c"))
    v = F.col("c.v")
    return long.groupBy("period", "c.field").agg(F.count(F.lit(1)).alias("n"), (F.count_if(v.isNull()) / F.count(F.lit(1)) * 100).alias("missing_pct"), F.avg(v).alias("mean"), F.coalesce(F.stddev_samp(v), F.when(F.count(v) == 1, 0.0)).alias("sd"), F.min(v).alias("least"), F.max(v).alias("most"))


def promised_range(name: str) -> str | None:
    """What a field's name promises of its values: "above zero", "not below zero", or nothing."""
    low = name.lower()
    if any(p in low for p in ANY_SIGN):
        return None
    return "above zero" if any(p in low for p in ABOVE_ZERO) else "not below zero" if any(p in low for p in NOT_BELOW_ZERO) else None


def range_issues(df: DataFrame) -> DataFrame:
    """``field``, ``rule``, the ``n`` values that break what the field's name promises and the ``least`` of them, for every column whose name says something; texts count where they are numbers. One scan."""
    rules = {c: r for c in df.columns if (r := promised_range(c))}
    if not rules:
        return df.sparkSession.createDataFrame([], "field string, rule string, n long, least double")
    value = lambda c: F.expr(f"try_cast(`{c}` AS DOUBLE)")
    bad = lambda c: (value(c) <= 0) if rules[c] == "above zero" else (value(c) < 0)
    row = df.agg(*(F.count_if(bad(c)).alias(f"n_{i}") for i, c in enumerate(rules)), *(F.min(F.when(bad(c), value(c))).alias(f"e_{i}") for i, c in enumerate(rules)))
    cells = F.array(*(F.struct(F.lit(c).alias("field"), F.lit(r).alias("rule"), F.col(f"n_{i}").alias("n"), F.col(f"e_{i}").alias("least")) for i, (c, r) in enumerate(rules.items())))
    return row.select(F.explode(cells).alias("x")).select("x.*")


def result_anomalies(runs: DataFrame, races: DataFrame, race: str, finished: str, position: str, won: str, started: str, day: str, most_days: int = 7) -> DataFrame:
    """Counts of ``anomaly``: finished contests without a winner, with starters that have no position, without entrants; winners with another position than 1; gaps of more than ``most_days`` days in the calendar.

    ``races`` has one row a contest with the flag ``finished``; ``runs`` has
    ``position``, ``won`` and ``started`` of the entrants.
    """
    per = runs.groupBy(race).agg(F.max(F.col(won).cast("int")).alias("_won"), F.count_if(F.col(started) & F.col(position).isNull()).alias("_lost"), F.count_if((F.col(won) == 1) & F.col(position).isNotNull() & (F.col(position) != 1)).alias("_odd"), F.lit(1).alias("_any"))
    joined = races.join(per, race, "left")
    done = F.col(finished)
    row = joined.agg(F.count_if(done & F.col("_any").isNotNull() & (F.coalesce("_won", F.lit(0)) == 0)).alias("no_winner"), F.count_if(done & (F.col("_lost") > 0)).alias("missing_positions"), F.coalesce(F.sum("_odd"), F.lit(0)).alias("winner_not_first"), F.count_if(F.col("_any").isNull()).alias("no_entrants"))
    days = races.select(F.col(day).alias("_d")).where("_d is not null").distinct()
    gap = days.withColumn("_gap", F.datediff("_d", F.lag("_d").over(Window.orderBy("_d")))).agg(F.count_if(F.col("_gap") > most_days).alias("calendar_gaps"))
    names = ("no_winner", "missing_positions", "winner_not_first", "no_entrants", "calendar_gaps")
    both = row.crossJoin(F.broadcast(gap))
    return both.select(F.explode(F.array(*(F.struct(F.lit(n).alias("anomaly"), F.col(n).alias("n")) for n in names))).alias("x")).select("x.*")


def without_empty_columns(df: DataFrame) -> DataFrame:
    """``df`` without the columns that are null, empty or "None" in every row; one scan decides."""
    text = lambda c: F.col(f"`{c}`").cast("string")
    simple = [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct", "binary"))]
    row = df.agg(*(F.count_if(~F.trim(text(c)).isin("", "None")).alias(str(i)) for i, c in enumerate(simple)), *(F.count(f"`{c}`").alias(f"x{i}") for i, c in enumerate(df.columns) if c not in simple)).first()
    gone = {c for i, c in enumerate(simple) if not row[str(i)]} | {c for i, c in enumerate(df.columns) if c not in simple and not row[f"x{i}"]}
    return df.select(*(f"`{c}`" for c in df.columns if c not in gone))
