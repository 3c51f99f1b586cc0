"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

Each source gets a mean repetition rate that brings it to its target share.
A document's count is the inverse of the Poisson distribution with that rate
at a number that a keyed hash draws from its id, so a rerun or a retried task
gives the same mixture. Documents are exploded by their counts and dealt out
and ordered by another keyed hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Without weights, a source's share is its size to this power, which flattens the mixture.
EXPONENT = 0.7
#: Larger rates are drawn as a sum of this many or more independent parts, as exp(-rate) must not vanish.
PART = 32.0
#: Sources up to which their rates are broadcast (a few KB each); beyond it they are joined on source and a salt.
MAX_BROADCAST_SOURCES = 2000
SALTS = 64
#: Equal rows without an id that are made again in one piece.
PIECE = 10_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 random bits from the parts' MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, source_col: str = "source", exponent: float = EXPONENT) -> DataFrame:
    """One row per source: size, mean repetition rate, number of parts and the distribution function of one part.

    A source that ``weights`` doesn't name has weight 0.
    """
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("mix_source")).agg(F.count(F.lit(1)).alias("size"))
    if weights is None:
        share = F.pow(F.col("size").cast("double"), F.lit(exponent))
    else:
        known = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))]) if weights else F.lit(None).cast("map<string,double>")
        share = F.coalesce(F.try_element_at(known, F.coalesce("mix_source", F.lit(""))), F.lit(0.0))
    sized = sizes.withColumn("share", share)
    sums = sized.agg(F.sum("share").alias("shares"), F.sum("size").alias("n")).first()
    n, shares = total if total is not None else (sums["n"] or 0), sums["shares"] or 1.0
    rate = F.col("share") / F.lit(float(shares)) * F.lit(float(n)) / F.col("size")
    rates = sized.withColumn("rate", rate).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
    lam = F.col("rate") / F.col("parts")
    last = F.ceil(lam + 12 * F.sqrt(lam) + 20).cast("int")
    start = F.struct(F.exp(-lam).alias("term"), F.exp(-lam).alias("sum"), F.array(F.exp(-lam)).alias("cdf"))

    def step(a: Column, k: Column) -> Column:
        term = a["term"] * lam / k
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"), F.concat(a["cdf"], F.array(a["sum"] + term)).alias("cdf"))

    return rates.withColumn("cdf", F.aggregate(F.sequence(F.lit(1), last), start, step)["cdf"]).select("mix_source", "size", "rate", "parts", "cdf")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows without an id, numbered among those that are equal in ``mix_id``.

    Equal rows are counted, which Spark combines before it shuffles, and made
    again by their number, in pieces dealt to all partitions.
    """
    counted = rows.groupBy("row", "mix_source", "mix_id").agg(F.count(F.lit(1)).alias("n"))
    pieces = counted.withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(PIECE).cast("long")))).repartition("mix_id", "first")
    each = F.explode(F.sequence("first", F.least(F.col("n"), F.col("first") + PIECE - 1)))
    return pieces.select("row", "mix_source", "mix_id", each.alias("number")).select("row", "mix_source", F.concat_ws("#", "mix_id", "number").alias("mix_id"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", exponent: float = EXPONENT) -> DataFrame:
    """Documents repeated to their source's target weight and globally shuffled.

    ``weights`` maps sources to relative target shares of documents, by
    default size ** exponent; ``total`` is the expected number of rows, by
    default that of the input. Returns the columns of the input and ``copy``
    (from 1), in partitions dealt and ordered by a keyed hash.

    A null source is a source of its own (weight 0 if ``weights`` are given,
    unless they name the empty string). Rows without an id draw by their text
    and by their number among equal rows, each on its own; rows with equal ids
    draw equal counts. An empty table gives an empty result; a column of the
    input named ``copy`` is replaced.
    """
    spark, columns = docs.sparkSession, [c for c in docs.columns if c != "copy"]
    rates = source_rates(docs, weights, total, source_col, exponent)
    packed = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row")
    source = F.col(source_col).cast("string").alias("mix_source")
    named = docs.where(F.col(id_col).isNotNull()).select(packed, source, F.col(id_col).cast("string").alias("mix_id"))
    text = F.coalesce(F.md5(F.col(text_col).cast("string")), F.lit(""))
    row = named.unionByName(_numbered(docs.where(F.col(id_col).isNull()).select(packed, source, text.alias("mix_id"))))
    known = rates.limit(MAX_BROADCAST_SOURCES + 1).collect()
    schema = "mix_source string, size long, rate double, parts int, cdf array<double>"
    if len(known) <= MAX_BROADCAST_SOURCES:
        row = row.join(F.broadcast(spark.createDataFrame([tuple(r) for r in known], schema)).withColumnRenamed("mix_source", "of"), F.col("mix_source").eqNullSafe(F.col("of")), "left")
    else:
        salt = F.pmod(F.xxhash64("mix_id"), F.lit(SALTS))
        dealt = rates.withColumnRenamed("mix_source", "of").withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        row = row.withColumn("salt", salt).join(dealt, F.col("mix_source").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("at")), "left")
    draw = lambda j: uniform(F.lit(str(seed)), F.col("mix_id"), j.cast("string"))
    below = lambda u: F.size(F.filter("cdf", lambda c: c <= u))
    count = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda a, j: a + below(draw(j)))
    repeated = row.withColumn("n", count).where("n > 0").select("row", "mix_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    place = F.md5(F.concat_ws("|", F.lit(f"{seed} order"), F.col("mix_id"), F.col("copy").cast("string")))
    return repeated.withColumn("place", place).repartition("place").sortWithinPartitions("place").select("row.*", "copy")
