"""Queries over nearest neighbours, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.operators import neighbours
from paceline.plans.form_queries import integer, real, real_sql
from paceline.sources.tables import table

K = 5


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with price and quantity sold; every fifth has lost its size."""
    sold = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("sold"))
    p = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("price"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_size")).alias("size"))
    return p.join(sold, "p_partkey", "left")


def knn_imputation(spark: SparkSession, sf: str) -> DataFrame:
    """Missing sizes of parts as the mean of the five parts nearest in price and quantity sold, each axis over its range."""
    out = neighbours.imputed_by_neighbours(_parts(spark, sf), "size", ["price", "sold"], K, "p_partkey")
    return out.select("p_partkey", real(F.col("size"), "size"))


def nearest_parts(spark: SparkSession, sf: str) -> DataFrame:
    """For every part without a size, the three nearest that have one, by price and quantity sold."""
    p = _parts(spark, sf)
    near = neighbours.nearest(p.where("size is null").select("p_partkey", "price", "sold"), p.where("size is not null"), ["price", "sold"], 3, "p_partkey")
    return near.select("p_partkey", "neighbour", integer(F.col("rank"), "rank"), real(F.col("distance"), "distance"))


def nearest_station(spark: SparkSession, sf: str) -> DataFrame:
    """The supplier nearest to each customer over ground; balances stand for latitude and longitude, so places reach both poles and the date line."""
    place = lambda name, key, balance: table(spark, sf, name).select(F.col(key).alias("key"), (F.col(balance) % 90).alias("lat"), ((F.col(balance) * 7) % 180).alias("lon"))
    near = neighbours.nearest_places(place("customer", "c_custkey", "c_acctbal"), place("supplier", "s_suppkey", "s_acctbal"), "key")
    return near.select(F.col("key").alias("place"), F.col("neighbour").alias("station"), real(F.col("km"), "km"))


_PARTS_SQL = """p AS (SELECT p_partkey, p_retailprice AS price, CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS size, sold FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS sold FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
ends AS (SELECT min(price) AS lp, max(price) - min(price) AS up, min(sold) AS ls, max(sold) - min(sold) AS us FROM p WHERE price IS NOT NULL AND sold IS NOT NULL),
z AS (SELECT p_partkey, size, (price - lp) / up AS a, (sold - ls) / us AS b FROM p, ends WHERE price IS NOT NULL AND sold IS NOT NULL),
far AS (SELECT q.p_partkey, d.p_partkey AS neighbour, d.size, sqrt((q.a - d.a) * (q.a - d.a) + (q.b - d.b) * (q.b - d.b)) AS distance FROM z AS q JOIN z AS d ON q.size IS NULL AND d.size IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY distance, neighbour) AS rank FROM far)"""

KNN_IMPUTATION = f"""WITH {_PARTS_SQL}, filled AS (SELECT p_partkey, avg(size) AS size FROM ranked WHERE rank <= {K} GROUP BY p_partkey)
SELECT p.p_partkey, {real_sql("coalesce(p.size, filled.size)", "size")} FROM p LEFT JOIN filled USING (p_partkey)"""

NEAREST_PARTS = f"WITH {_PARTS_SQL} SELECT p_partkey, neighbour, rank, {real_sql('distance', 'distance')} FROM ranked WHERE rank <= 3"

NEAREST_STATION = f"""WITH c AS (SELECT c_custkey AS place, radians(c_acctbal % 90) AS lat, radians(c_acctbal * 7 % 180) AS lon FROM customer),
s AS (SELECT s_suppkey AS station, radians(s_acctbal % 90) AS lat, radians(s_acctbal * 7 % 180) AS lon FROM supplier),
far AS (SELECT place, station, 2 * {neighbours.EARTH_KM} * asin(sqrt(pow(sin((s.lat - c.lat) / 2), 2) + cos(s.lat) * cos(c.lat) * pow(sin((s.lon - c.lon) / 2), 2))) AS km FROM c, s)
SELECT place, arg_min(station, km) AS station, {real_sql("min(km)", "km")} FROM far GROUP BY place"""

QUERIES = {"knn_imputation": knn_imputation, "nearest_parts": nearest_parts, "nearest_station": nearest_station}
ORACLES = {"knn_imputation": KNN_IMPUTATION, "nearest_parts": NEAREST_PARTS, "nearest_station": NEAREST_STATION}
