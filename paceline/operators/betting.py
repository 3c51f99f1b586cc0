"""Stake sizing, ticket enumeration, returns and simulation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def kelly(p: Column, odds: Column, fraction: float = 0.25, cap: float = 0.05) -> Column:
    """Fractional Kelly stake as a share of the bankroll, at most ``cap``, never negative."""
    full = F.try_divide(p * odds - 1, odds - 1)
    return F.least(F.lit(cap), F.greatest(F.lit(0.0), full * fraction))


def value_bets(df: DataFrame, p: str, odds: str, edge: float = 0.05, odds_range: tuple[float, float] = (1.5, 50.0), least_p: float = 0.02) -> DataFrame:
    """Rows whose expected return beats the edge within the accepted odds."""
    value = F.col(p) * F.col(odds) - 1
    out = df.withColumns({"edge": value, "stake": kelly(F.col(p), F.col(odds))})
    return out.where((value >= edge) & F.col(odds).between(*odds_range) & (F.col(p) >= least_p) & (F.col("stake") > 0))


def scaled(df: DataFrame, keys: list[str], stake: str, exposure: float = 0.3, least: float = 0.001) -> DataFrame:
    """Stakes of one portfolio scaled down to the exposure; those below the least stake are dropped."""
    total = F.sum(stake).over(Window.partitionBy(*keys))
    return df.withColumn(stake, F.when(total > exposure, F.col(stake) * exposure / total).otherwise(F.col(stake))).where(F.col(stake) >= least)


def _fields(df: DataFrame, race: str, runner: str, p: str) -> DataFrame:
    """One row a contest with its entrants (``no``, ``p``) as the array ``field``."""
    return df.groupBy(F.col(race).alias("race")).agg(F.collect_list(F.struct(F.col(runner).alias("no"), F.col(p).alias("p"))).alias("field"))


def _orders(field: Column, places: int) -> Column:
    """Every ordered finish of the first ``places`` among a field's entrants: ``order``, ``probability`` and the shares ``gone``."""
    out = F.transform(field, lambda x: F.struct(F.array(x["no"]).alias("order"), x["p"].alias("probability"), x["p"].alias("gone")))
    left = lambda o: F.filter(field, lambda x: ~F.array_contains(o["order"], x["no"]))
    then = lambda o, x: F.struct(F.concat(o["order"], F.array(x["no"])).alias("order"), (o["probability"] * F.try_divide(x["p"], 1 - o["gone"])).alias("probability"), (o["gone"] + x["p"]).alias("gone"))
    for _ in range(places - 1):
        out = F.flatten(F.transform(out, lambda o: F.transform(left(o), lambda x: then(o, x))))
    return out


def ordered_finish(df: DataFrame, race: str, runner: str, p: str, places: int = 3) -> DataFrame:
    """Harville probabilities of ordered finishes: each next place by the shares of those still left."""
    return _fields(df, race, runner, p).select("race", F.explode(_orders(F.col("field"), places)).alias("x")).select("race", "x.order", "x.probability")


def likeliest_finish(df: DataFrame, race: str, runner: str, p: str, places: int = 3, digits: int = 9) -> DataFrame:
    """The likeliest ordered finish of each contest, to so many digits; of equal ones the first as text (``ticket``). Tickets are weighed within the contest's row."""
    tickets = F.transform(_orders(F.col("field"), places), lambda x: F.struct((-F.round(x["probability"], digits)).alias("less"), F.array_join(x["order"], "-").alias("ticket"), x["probability"].alias("probability")))
    # Without a probability a ticket comes last.
    known = F.filter(tickets, lambda x: x["less"].isNotNull())
    best = F.coalesce(F.array_min(known), F.array_min(tickets))
    return _fields(df, race, runner, p).select("race", best.alias("x")).where("x is not null").select("race", "x.ticket", "x.probability")


def drawdown(df: DataFrame, keys: list[str], order: list[str], profit: str) -> DataFrame:
    """Cumulative profit, its running peak (never below 0) and the distance to it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("balance", F.sum(profit).over(w))
    return out.withColumn("peak", F.greatest(F.lit(0), F.max("balance").over(w))).withColumn("drawdown", F.col("peak") - F.col("balance"))


def simulate(df: DataFrame, race: str, runner: str, p: str, runs: int, seed: int) -> DataFrame:
    """Plackett-Luce finishes by Gumbel noise: win, place and show shares and mean position over ``runs`` draws.

    Noise is hashed from (race, runner, run), so a retried task draws the same.
    A contest's entrants are gathered once and ranked within each draw, so no
    draw is shuffled or sorted; memory is that of a contest's field.
    """
    drawn = _fields(df, race, runner, p).select("race", "field", F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("run"))
    u = lambda x: (F.pmod(F.xxhash64(F.lit(seed), "race", x["no"], "run"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    scored = drawn.withColumn("scores", F.transform("field", lambda x: F.ln(x["p"]) - F.ln(-F.ln(u(x)))))
    ranked = scored.withColumn("best", F.sort_array("scores", asc=False)).select("race", "best", F.explode(F.arrays_zip("field", "scores")).alias("x"))
    # Entrants without a probability share the place after all others.
    place = F.coalesce(F.array_position("best", F.col("x.scores")), F.size(F.array_compact("best")) + 1)
    placed = ranked.select("race", F.col("x.field.no").alias("no"), place.alias("place"))
    return placed.groupBy("race", "no").agg(*(F.avg((F.col("place") <= k).cast("double")).alias(n) for k, n in ((1, "win"), (2, "top2"), (3, "top3"))), F.avg("place").alias("mean_place"))
