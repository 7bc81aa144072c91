"""Ranking frames over the star schema, as DataFrames and as SQL, for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    """``cust_id, yr, prod_name, q``: what a customer bought of a part type in a year."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("cust_id"), F.trunc("o_orderdate", "year").alias("yr"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("prod_name"))
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("cust_id", "yr", "prod_name").agg(F.sum("l_quantity").alias("q"))


def pred(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates: every part type for each customer in each year of activity; score from the year before, label from this year.

    Purchases are summed once and gathered per customer (a few years times the part
    types), so that candidates need no join back to them and stay dealt out by
    customer, as windows over queries want them.
    """
    items = table(spark, sf, "part").select(F.col("p_type").alias("prod_name")).distinct()
    bought = purchases(spark, sf).groupBy("cust_id").agg(F.collect_list(F.struct("yr", "prod_name", "q")).alias("bought"))
    years = bought.withColumn("snap_date", F.explode(F.array_distinct(F.transform("bought", lambda x: x["yr"]))))

    def of_year(year):
        own = F.filter("bought", lambda x: x["yr"] == year)
        return F.map_from_entries(F.transform(own, lambda x: F.struct(x["prod_name"], x["q"])))

    dated = years.select("cust_id", "snap_date", of_year(F.col("snap_date")).alias("now"), of_year(F.add_months("snap_date", -12)).alias("before"))
    q = F.coalesce(F.element_at("before", F.col("prod_name")), F.lit(0.0))
    return dated.crossJoin(F.broadcast(items)).select(  # part types: a fixed few
        "snap_date", "cust_id", "prod_name", F.map_contains_key("now", F.col("prod_name")).cast("int").alias("label"), (q / (q + 50.0)).alias("score"), q.alias("score_uncalibrated")
    )


def segments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("cust_id"), F.col("c_mktsegment").alias("segment"))


def categories(spark: SparkSession, sf: str) -> DataFrame:
    """Two-level grouping of part types."""
    items = table(spark, sf, "part").select(F.col("p_type").alias("prod_name")).distinct()
    return items.withColumn("category", F.when(F.col("prod_name").isin("LARGE", "MEDIUM", "SMALL"), "SIZED").otherwise("OTHER"))


PRED = """
buy AS (SELECT o_custkey AS cust_id, date_trunc('year', o_orderdate)::DATE AS yr, p_type AS prod_name, sum(l_quantity) AS q
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL),
items AS (SELECT DISTINCT p_type AS prod_name FROM part),
act AS (SELECT DISTINCT cust_id, yr FROM buy),
pred AS (SELECT a.yr AS snap_date, a.cust_id, i.prod_name, CASE WHEN n.q IS NULL THEN 0 ELSE 1 END AS label,
    coalesce(p.q, 0) / (coalesce(p.q, 0) + 50.0) AS score, coalesce(p.q, 0) AS score_uncalibrated
  FROM act a CROSS JOIN items i
  LEFT JOIN buy n ON n.cust_id = a.cust_id AND n.yr = a.yr AND n.prod_name = i.prod_name
  LEFT JOIN buy p ON p.cust_id = a.cust_id AND (p.yr + INTERVAL 1 YEAR)::DATE = a.yr AND p.prod_name = i.prod_name),
seg AS (SELECT c_custkey AS cust_id, c_mktsegment AS segment FROM customer),
cat AS (SELECT prod_name, CASE WHEN prod_name IN ('LARGE','MEDIUM','SMALL') THEN 'SIZED' ELSE 'OTHER' END AS category FROM items)"""


def enriched_sql(source: str = "pred", prefix: str = "") -> str:
    """CTEs ``{prefix}ranked`` and ``{prefix}enr`` with contributions at 3 and 5."""
    def at(k: int) -> str:
        ideal = " + ".join(f"CASE WHEN least(total_rel, {k}) >= {i} THEN 1 / log2({i} + 1) ELSE 0 END" for i in range(1, k + 1))
        return (f"(pos <= {k})::INT * label AS hit{k}, (pos <= {k})::INT * label * cum_rel / pos AS ap{k}, "
                f"(pos <= {k})::INT * label / log2(pos + 1) / ({ideal}) AS ndcg{k}")  # fmt: skip

    return f"""
{prefix}ranked AS (SELECT *, row_number() OVER (PARTITION BY snap_date, cust_id ORDER BY score DESC, prod_name) AS pos,
    sum(label) OVER (PARTITION BY snap_date, cust_id) AS total_rel FROM {source}),
{prefix}cum AS (SELECT *, sum(label) OVER (PARTITION BY snap_date, cust_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cum_rel FROM {prefix}ranked WHERE total_rel > 0),
{prefix}enr AS (SELECT *, {at(3)}, {at(5)} FROM {prefix}cum),
{prefix}pq AS (SELECT snap_date, cust_id, {", ".join(f'sum(ap{k})/max(total_rel) AS "map@{k}", sum(ndcg{k}) AS "ndcg@{k}", sum(hit{k})/{k}.0 AS "precision@{k}", sum(hit{k})/max(total_rel) AS "recall@{k}"' for k in (3, 5))}
  FROM {prefix}enr GROUP BY ALL)"""
