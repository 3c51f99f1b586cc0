"""Set statistics inside a contest: ranks, market shares, spread and concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def field(race: str = "race"):
    return Window.partitionBy(race)


def positional_rank(value: Column, *ties: str | Column, race: str = "race") -> Column:
    """1, 2, 3, ... with ties broken by the given columns."""
    return F.row_number().over(field(race).orderBy(value, *ties))


def competition_rank(value: Column, race: str = "race") -> Column:
    """Equal values share a rank, the next one counts all before it."""
    return F.rank().over(field(race).orderBy(value))


def implied_probability(odds: str, race: str = "race") -> dict[str, Column]:
    """Raw and normalised implied probability and the market's overround."""
    raw = F.try_divide(F.lit(1.0), F.col(odds))
    total = F.sum(raw).over(field(race))
    return {"implied": raw, "overround": total, "probability": raw / total}


def concentration(p: str, race: str = "race") -> dict[str, Column]:
    """Herfindahl index, entropy (natural and base 2, the latter also relative to its maximum) of shares ``p``."""
    w, n = field(race), F.count(F.lit(1)).over(field(race))
    plogp = F.when(F.col(p) > 0, F.col(p) * F.ln(p)).otherwise(0.0)
    entropy = -F.sum(plogp).over(w)
    return {"hhi": F.sum(F.col(p) * F.col(p)).over(w), "entropy": entropy, "entropy_share": F.when(n > 1, entropy / F.ln(n))}


def spread(value: str, race: str = "race") -> dict[str, Column]:
    """Mean, sample deviation, z-score and variation of a value in its contest."""
    w = field(race)
    mean, sd = F.avg(value).over(w), F.stddev_samp(value).over(w)
    return {f"{value}_mean": mean, f"{value}_sd": sd, f"{value}_z": F.when(sd > 0, (F.col(value) - mean) / sd), f"{value}_cv": F.when(mean != 0, sd / mean)}


def top_mass(p: str, k: int, tie: str, race: str = "race") -> Column:
    """Share of the k largest of ``p``; needs ``_rank`` from a positional rank by it."""
    return F.sum(F.when(F.col("_rank") <= k, F.col(p))).over(field(race))


def market(df: DataFrame, odds: str = "odds", tie: str = "no") -> DataFrame:
    """Odds ranks, favourite flags, normalised probabilities and concentration of each contest."""
    out = df.withColumns(implied_probability(odds)).withColumn("odds_rank", positional_rank(F.col(odds), tie))
    out = out.withColumns(concentration("probability")).withColumn("_rank", F.col("odds_rank"))
    return out.withColumns({"favourite": (F.col("odds_rank") == 1).cast("int"), "top1": top_mass("probability", 1, tie), "top3": top_mass("probability", 3, tie), "field_size": F.count(F.lit(1)).over(field())}).drop("_rank")
