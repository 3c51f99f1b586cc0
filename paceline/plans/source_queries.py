"""Queries that write a table in some form and read it back, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.functions import payloads
from paceline.operators import matching
from paceline.plans.form_queries import real, real_sql
from paceline.sources import publish
from paceline.sources.json_records import split_json_array, split_json_map
from paceline.sources.shared import shared_path
from paceline.sources.tables import table

ORDER_RECORD = "id long, note string, lines array<struct<part: long, quantity: double, mark: string>>"
#: Text that a reader takes for structure if it loses count of quotes and escapes.
_NOTE = 'a "quoted" }, { note [with \\ brackets]'


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as nested records, with marks and notes full of braces, quotes and line breaks."""
    line = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(F.struct(F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"), F.concat_ws("}\n{", "l_returnflag", "l_linestatus").alias("mark")))).alias("lines"))
    order = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.concat_ws(" ", F.lit(_NOTE), "o_orderpriority").alias("note"))
    return order.join(line, "id", "left")


def _digest(records: DataFrame) -> DataFrame:
    lines = F.coalesce("lines", F.array().cast(records.schema["lines"].dataType))
    total = F.aggregate(lines, F.lit(0.0), lambda a, x: a + x["quantity"])
    marks = F.array_join(F.transform(lines, lambda x: x["mark"]), "|")
    return records.select("id", F.md5("note").alias("note_digest"), F.size(lines).cast("long").alias("n_lines"), real(total, "quantity"), F.md5(marks).alias("marks_digest"))


_DIGEST_SQL = f"""note AS (SELECT o_orderkey AS id, md5('{_NOTE} ' || o_orderpriority) AS note_digest FROM orders),
lines AS (SELECT l_orderkey AS id, count(*) AS n, sum(l_quantity) AS q, md5(string_agg(l_returnflag || '}}' || chr(10) || '{{' || l_linestatus, '|' ORDER BY l_partkey, l_quantity, l_returnflag || '}}' || chr(10) || '{{' || l_linestatus)) AS m FROM lineitem GROUP BY 1)
SELECT id, note_digest, coalesce(n, 0) AS n_lines, {real_sql("coalesce(q, 0)", "quantity")}, coalesce(m, md5('')) AS marks_digest FROM note LEFT JOIN lines USING (id)"""


def json_array_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Nested records from JSON arrays that are read in splits; every file is cut off after its last whole record."""
    path = shared_path(spark, "json-array")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    _orders(spark, sf).select(F.concat(F.when(first, "[").otherwise(""), F.to_json(F.struct("id", "note", "lines"))).alias("value")).write.option("lineSep", ",\n").text(path)
    return _digest(split_json_array(spark, path, spark.createDataFrame([], ORDER_RECORD).schema))


def json_map_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Nested records from JSON maps by key, read in splits."""
    path = shared_path(spark, "json-map")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    entry = F.concat(F.when(first, "{").otherwise(""), F.lit('"order '), "id", F.lit('": '), F.to_json(F.struct("note", "lines")))
    _orders(spark, sf).select(entry.alias("value")).write.option("lineSep", ",\n").text(path)
    schema = spark.createDataFrame([], ORDER_RECORD.removeprefix("id long, ")).schema
    return _digest(split_json_map(spark, path, schema).withColumn("id", F.regexp_extract("key", r"\d+", 0).cast("long")))


def published_orders(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is published twice and read at its newest version: orders by priority, first of one status, then of all."""
    path, orders = shared_path(spark, "published"), table(spark, sf, "orders")
    for rows in (orders.where("o_orderstatus = 'F'"), orders):
        publish.publish(rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("o_orderdate").cast("date")).cast("string").alias("newest")), path)
    return publish.published(spark, path)


PUBLISHED_ORDERS = "SELECT o_orderpriority, count(*) AS n, max(o_orderdate)::DATE::VARCHAR AS newest FROM orders GROUP BY 1"


def memoised_quantities(spark: SparkSession, sf: str) -> DataFrame:
    """Quantities by part and flag, stored under the digest of files and plan; the second call reads what the first one stored."""
    folder, source = shared_path(spark, "memo"), f"{sf}/lineitem.parquet"
    build = lambda: spark.read.parquet(source).groupBy("l_partkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), real(F.sum("l_quantity"), "quantity"))
    publish.memoised(spark, "quantities", [source], build, folder)
    return publish.memoised(spark, "quantities", [source], build, folder)


MEMOISED_QUANTITIES = f"SELECT l_partkey, l_returnflag, count(*) AS n, {real_sql('sum(l_quantity)', 'quantity')} FROM lineitem GROUP BY 1, 2"


def json_key_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Key paths of the nested order records and of the properties of events, with the number of texts that have them."""
    o = _orders(spark, sf).withColumn("rare", F.when(F.col("id") % 10 == 0, F.struct(F.lit(1).alias("deep"))))
    texts = o.select(F.to_json(F.struct("id", "note", "lines", "rare")).alias("t")).unionByName(table(spark, sf, "events").select(F.col("props").alias("t")))
    return payloads.key_paths(texts, "t")


JSON_KEY_PATHS = """WITH t AS (SELECT o_orderkey AS id, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders),
p AS (SELECT unnest(['id', 'note']) AS path FROM t UNION ALL SELECT unnest(['lines', 'lines[].part', 'lines[].quantity', 'lines[].mark']) FROM t WHERE n > 0 UNION ALL SELECT unnest(['rare', 'rare.deep']) FROM t WHERE id % 10 = 0
  UNION ALL SELECT unnest(json_keys(props)) FROM events)
SELECT path, count(*) AS n FROM p GROUP BY path"""

#: Bet types of payout payloads.
BET_KINDS = {"SIMPLE_GAGNANT": "simple_gagnant", "SIMPLE_PLACE": "simple_place", "COUPLE_GAGNANT": "couple_gagnant", "TIERCE": "tierce", "QUARTE_PLUS": "quarte", "QUINTE_PLUS": "quinte"}


def payout_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Payout payloads of contests, one row a combination."""
    line = table(spark, sf, "lineitem").select("l_orderkey", F.when(F.col("l_returnflag") == "R", "simple_gagnant").when(F.col("l_returnflag") == "A", "TIERCE ").otherwise("other").alias("typePari"), F.struct(F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("combinaison"), F.when(F.col("l_partkey") % 7 != 0, F.round(F.col("l_extendedprice") * 100).cast("long")).alias("dividende"), (F.col("l_suppkey") % 3).cast("double").alias("nombreGagnants"), F.col("l_quantity").alias("nbGagnants")).alias("rapport"))
    blocks = line.groupBy("l_orderkey", "typePari").agg(F.collect_list("rapport").alias("rapports")).groupBy(F.col("l_orderkey").alias("race")).agg(F.collect_list(F.struct("typePari", "rapports")).alias("rapportsDefinitifs"))
    texts = blocks.select("race", F.to_json(F.struct("rapportsDefinitifs")).alias("payload"))
    out = payloads.payout_rows(texts, "payload", ["race"], BET_KINDS)
    return out.select("race", "kind", "combination", real(F.col("payout"), "payout"), real(F.col("winners"), "winners"), "payout_uid")


PAYOUT_PAYLOADS = f"""WITH l AS (SELECT l_orderkey AS race, CASE l_returnflag WHEN 'R' THEN 'simple_gagnant' WHEN 'A' THEN 'tierce' ELSE 'other' END AS kind, l_linenumber || '-' || l_partkey || '-' || l_suppkey AS combination,
  CASE WHEN l_partkey % 7 <> 0 THEN round(l_extendedprice * 100)::BIGINT END / 100 AS p, CASE WHEN l_suppkey % 3 <> 0 THEN l_suppkey % 3 ELSE l_quantity END AS w FROM lineitem)
SELECT race, kind, combination, {real_sql("p", "payout")}, {real_sql("w", "winners")}, md5(race || '|' || kind || '|' || combination) AS payout_uid FROM l"""


def name_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    """Names with words after them looked up by the longest known name that they begin with."""
    p = table(spark, sf, "part")
    known = p.where("p_size % 2 = 1").select(F.col("p_name").alias("name"), "p_name").unionByName(p.select(F.substring_index("p_name", " ", 1).alias("name"), F.upper(F.substring_index("p_name", " ", 1)).alias("p_name")))
    named = p.select("p_partkey", F.concat_ws(" - ", F.initcap("p_name"), F.lower("p_type"), "p_brand").alias("name"))
    return matching.longest_prefix(named, "name", known, "name", "p_name", "found").select("p_partkey", "found", "found_rest")


NAME_PREFIXES = """WITH k AS (SELECT DISTINCT p_name AS name, p_name AS found FROM part WHERE p_size % 2 = 1 UNION SELECT split_part(p_name, ' ', 1), upper(split_part(p_name, ' ', 1)) FROM part),
n AS (SELECT p_partkey, trim(regexp_replace(lower(p_name || ' - ' || p_type || ' - ' || p_brand), '[^a-z0-9]+', ' ', 'g')) AS name FROM part)
SELECT p_partkey, found, substr(n.name, length(k.name) + 2) AS found_rest FROM n LEFT JOIN k ON starts_with(n.name || ' ', k.name || ' ') QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(k.name) DESC) = 1"""


def matching_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of order lines that hold the keys of other tables, found by their values."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    others = {"orders": ["o_orderkey", "o_totalprice"], "part": ["p_partkey", "p_name"], "supplier": ["s_suppkey", "s_name"]}
    found = None
    for name, columns in others.items():
        one = matching.column_matches(line, table(spark, sf, name).select(*columns), least=0.8, least_values=5).select(F.lit(name).alias("table_name"), "left_column", "right_column")
        found = one if found is None else found.unionByName(one)
    return found


_CONTAINED = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{a}' AS left_column, '{b}' AS right_column, (SELECT count(*) FROM (SELECT DISTINCT {a}::VARCHAR FROM lineitem INTERSECT SELECT DISTINCT {b}::VARCHAR FROM {t})) AS common, (SELECT least(count(DISTINCT {a}), (SELECT count(DISTINCT {b}) FROM {t})) FROM lineitem) AS fewer" for t, bs in (("orders", ("o_orderkey", "o_totalprice")), ("part", ("p_partkey", "p_name")), ("supplier", ("s_suppkey", "s_name"))) for b in bs for a in ("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"))
MATCHING_COLUMNS = f"SELECT table_name, left_column, right_column FROM ({_CONTAINED}) WHERE fewer >= 5 AND common >= 0.8 * fewer"

_ALL = {json_array_splits: f"WITH {_DIGEST_SQL}", json_map_splits: f"WITH {_DIGEST_SQL}", published_orders: PUBLISHED_ORDERS, memoised_quantities: MEMOISED_QUANTITIES, json_key_paths: JSON_KEY_PATHS, payout_payloads: PAYOUT_PAYLOADS, name_prefixes: NAME_PREFIXES, matching_columns: MATCHING_COLUMNS}
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {f.__name__: sql for f, sql in _ALL.items()}
