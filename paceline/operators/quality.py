"""Data quality, calibration and drift as single-pass aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.sources.shared import kept


def fill_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: rows, filled rows, distinct values. One scan, then a stack of the single result row."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count(c).alias(f"f_{c}") for c in columns))
    cells = F.array(*(F.struct(F.lit(c).alias("field"), F.col("_n").alias("n"), F.col(f"f_{c}").alias("filled")) for c in columns))
    return row.select(F.explode(cells).alias("x")).select("x.*", F.try_divide(F.col("x.filled").cast("double"), F.col("x.n")).alias("rate"))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Count of rows that break each named rule, in one scan; an unknown outcome breaks none."""
    row = df.agg(*(F.count_if(F.coalesce(~ok, F.lit(False))).alias(name) for name, ok in rules.items()))
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("broken")) for n in rules))).alias("x")).select("x.*")


def quantile_bounds(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Exact quartiles and the fences k ranges beyond them, one row per column."""
    row = df.agg(*(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(c) for c in columns))
    one = lambda c: F.struct(F.lit(c).alias("field"), F.col(c)[0].alias("q1"), F.col(c)[1].alias("median"), F.col(c)[2].alias("q3"))
    out = row.select(F.explode(F.array(*map(one, columns))).alias("x")).select("x.*")
    iqr = F.col("q3") - F.col("q1")
    return out.withColumns({"low": F.col("q1") - k * iqr, "high": F.col("q3") + k * iqr})


def calibration_bins(df: DataFrame, p: str, y: str, n: int = 10) -> DataFrame:
    """Mean prediction and outcome per equal-width bin; a prediction of 1 is in the last bin."""
    b = F.least(F.floor(F.col(p) * n), F.lit(n - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("predicted"), F.avg(y).alias("observed"))


def calibration_error(bins: DataFrame) -> DataFrame:
    gap = F.abs(F.col("predicted") - F.col("observed"))
    return bins.agg((F.sum(gap * F.col("n")) / F.sum("n")).alias("ece"), F.max(gap).alias("mce"), F.sum("n").alias("n"))


def running_sums(df: DataFrame, value: str, counts: list[str]) -> DataFrame:
    """Rows of distinct values with the sums of the counts up to and with each.

    The rows are dealt by ranges of the value and stored, so what ``df`` takes
    is worked out once; sums run within a partition and continue by the totals
    of the partitions before, one row each.
    """
    ranged = kept(df.repartitionByRange(value).withColumn("_part", F.spark_partition_id()), "ranged")
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    before = ranged.groupBy("_part").agg(*(F.sum(c).alias(f"_{c}") for c in counts)).select("_part", *(F.coalesce(F.sum(f"_{c}").over(w), F.lit(0)).alias(f"_{c}") for c in counts))
    within = Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({f"sum_{c}": F.sum(c).over(within) for c in counts}).join(F.broadcast(before), "_part")
    return summed.withColumns({f"sum_{c}": F.col(f"sum_{c}") + F.col(f"_{c}") for c in counts}).drop("_part", *(f"_{c}" for c in counts))


def log_loss_and_auc(df: DataFrame, p: str, y: str, eps: float = 1e-15) -> DataFrame:
    """Log loss, accuracy at one half, and the area under the ROC curve by average ranks.

    All three come from the counts and hits per distinct score, which are
    taken in one pass; rows without a score or an outcome are left out.
    """
    scores = df.where(F.col(p).isNotNull() & F.col(y).isNotNull()).groupBy(p).agg(F.count(F.lit(1)).alias("c"), F.sum(F.col(y).cast("long")).alias("pos"))
    q = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(p)))
    neg = F.col("c") - F.col("pos")
    ranks = running_sums(scores, p, ["c"]).withColumn("rank", F.col("sum_c") - F.col("c") + (F.col("c") + 1) / 2)
    sums = ranks.agg(
        F.sum("c").alias("n"),
        F.sum(-(F.col("pos") * F.ln(q) + neg * F.ln(1 - q))).alias("loss"),
        F.sum(F.when(F.col(p) >= 0.5, F.col("pos")).otherwise(neg)).alias("right"),
        F.sum(F.col("rank") * F.col("pos")).alias("s"),
        F.sum("pos").alias("p"),
        F.sum(neg).alias("q"),
    )
    area = F.try_divide(F.col("s") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * F.col("q"))
    return sums.select(F.coalesce("n", F.lit(0)).alias("n"), F.try_divide("loss", "n").alias("log_loss"), F.try_divide(F.col("right").cast("double"), "n").alias("accuracy"), area.alias("auc"))


def psi(df: DataFrame, value: str, reference: Column, n: int = 10, eps: float = 1e-6) -> DataFrame:
    """Population stability index over equal-width bins of the reference's range; other values are left out."""
    lim = df.where(reference).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    b = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * n), F.lit(n - 1))
    binned = df.crossJoin(F.broadcast(lim)).where((F.col(value) >= F.col("lo")) & (F.col(value) <= F.col("hi"))).groupBy(b.alias("bin")).agg(F.count_if(reference).alias("r"), F.count_if(~reference).alias("c"))
    total = binned.agg(F.sum("r").alias("rt"), F.sum("c").alias("ct"))
    share = lambda c, t: F.greatest(F.col(c) / F.col(t), F.lit(eps))
    r, c = share("r", "rt"), share("c", "ct")
    return binned.crossJoin(F.broadcast(total)).agg(F.sum((c - r) * F.ln(c / r)).alias("psi"), F.count(F.lit(1)).alias("bins"))


def ks(df: DataFrame, value: str, first: Column) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic from the counts per distinct value; null values are left out."""
    g = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count_if(first).alias("a"), F.count_if(~first).alias("b"))
    cum = running_sums(g, value, ["a", "b"])
    tot = cum.agg(F.max("sum_a").alias("na"), F.max("sum_b").alias("nb"))
    return cum.crossJoin(F.broadcast(tot)).agg(F.max(F.abs(F.col("sum_a") / F.col("na") - F.col("sum_b") / F.col("nb"))).alias("ks"))


def correlation(a: str, b: str) -> Column:
    """Pearson's correlation over the rows that have both, null where either side is constant.

    A constant is told by its ends: merged over partitions, its variance may come out a little over 0.
    """
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y)))


def correlations(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    row = df.agg(*(correlation(c, label).alias(c) for c in columns))
    return row.select(F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("r")) for c in columns))).alias("x")).select("x.*")
