"""Source jobs: features, labels, sample pool and population for a target date, as DataFrame jobs over the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _date(d: str) -> Column:
    return F.to_date(F.lit(d))


def balances(customers: DataFrame, d: str) -> DataFrame:
    return customers.select(_date(d).alias("snap_date"), F.col("c_custkey").alias("cust_id"), F.coalesce("c_acctbal", F.lit(0.0)).alias("balance"))


def card_features(orders: DataFrame, d: str, days: int = 30) -> DataFrame:
    """Orders of ``(d - days, d]``: sums by status, an urgent flag, a safe ratio and distinct days."""
    day = F.to_date("o_orderdate")
    own = orders.where((day > F.date_sub(_date(d), days)) & (day <= _date(d)))
    done, total = F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)), F.sum("o_totalprice")
    return own.groupBy(F.col("o_custkey").alias("cust_id")).agg(
        total.alias("spend"), done.alias("spend_done"), F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("urgent"),
        F.when(total > 0, done / total).alias("done_ratio"), F.countDistinct(day).alias("days")).select(_date(d).alias("snap_date"), "*")


def card_limits(lines: DataFrame, orders: DataFrame, suppliers: DataFrame, d: str, days: int = 30) -> DataFrame:
    """Lines of orders of ``(d - days, d]`` against a dimension of the same customer's suppliers: spend, limit, ratio to the limit, distinct cards.

    A supplier stands for a card, and its balance for the card's limit. The
    dimension's own condition is in the join, so that lines without a valid card stay.
    """
    day = F.to_date("o_orderdate")
    facts = orders.where((day > F.date_sub(_date(d), days)) & (day <= _date(d))).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    joined = facts.join(suppliers, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("s_acctbal") > 0), "left")
    spend, limit = F.coalesce(F.sum("l_extendedprice"), F.lit(0.0)), F.max("s_acctbal")
    return joined.groupBy(F.col("o_custkey").alias("cust_id")).agg(
        F.count("l_orderkey").alias("n_lines"), spend.alias("spend"), F.max(F.coalesce((F.col("s_acctbal") > 5000).cast("int"), F.lit(0))).alias("high_limit"),
        limit.alias("card_limit"), F.when(limit > 0, spend / limit).otherwise(0.0).alias("utilisation"), F.countDistinct("s_suppkey").alias("cards"),
    ).select(_date(d).alias("snap_date"), "*")


def savings_flows(events: DataFrame, d: str) -> DataFrame:
    """Events of ``[a month before d, d)``: value in by purchases, out by all others. The target date is the partition."""
    day = F.to_date("ts")
    own = events.where((day >= F.add_months(_date(d), -1)) & (day < _date(d)))
    credit = F.col("event_type") == "purchase"
    return own.groupBy(F.col("user_id").alias("cust_id")).agg(
        F.sum(F.when(credit, F.col("value")).otherwise(0.0)).alias("amount_in"), F.sum(F.when(~credit, F.col("value")).otherwise(0.0)).alias("amount_out"),
        F.sum(credit.cast("long")).alias("n_in")).select(_date(d).alias("snap_date"), "*")


def demographics(customers: DataFrame, nations: DataFrame, d: str) -> DataFrame:
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(_date(d).alias("snap_date"), F.col("c_custkey").alias("cust_id"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null if the denominator is missing or negative, 0 if it is zero."""
    return F.when(denominator.isNull() | (denominator < 0), None).when(denominator == 0, 0.0).otherwise(F.try_divide(numerator, denominator))


def feature_concat(families: list[DataFrame], d: str) -> DataFrame:
    """Every customer of any family, with the families' columns joined on; the date is carried."""
    keys = reduce(DataFrame.union, (f.select("cust_id") for f in families)).distinct()
    out = reduce(lambda acc, f: acc.join(f.drop("snap_date"), "cust_id", "left"), families, keys)
    out = out.select(_date(d).alias("snap_date"), *out.columns)
    if {"amount_in", "amount_out"} <= {*out.columns}:
        out = out.withColumn("flow_ratio", safe_ratio(F.col("amount_in"), F.col("amount_out")))
    return out


def label_family(events: DataFrame, items: list[str], d: str, days: int = 30) -> DataFrame:
    """Labels of one family of items from ``events(cust_id, day, item)`` of ``(d, d + days]``.

    Customers with any event in the family meet all its items: label 1 and the
    event's dates where there was one, else 0 and null dates.
    """
    own = events.where((F.col("day") > _date(d)) & (F.col("day") <= F.date_add(_date(d), days)) & F.col("item").isin(*items))
    once = own.groupBy("cust_id", F.col("item").alias("prod_name")).agg(F.min("day").alias("apply_start_date"), F.max("day").alias("apply_end_date"))
    names = events.sparkSession.createDataFrame([(i,) for i in items], "prod_name string")
    grid = own.select("cust_id").distinct().crossJoin(F.broadcast(names))  # the caller's list
    joined = grid.join(once.withColumn("label", F.lit(1)), ["cust_id", "prod_name"], "left")
    return joined.select(_date(d).alias("snap_date"), "cust_id", "prod_name", F.coalesce("label", F.lit(0)).alias("label"), "apply_start_date", "apply_end_date")


def label_table(families: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, families)


def sample_pool(customers: DataFrame, labels: DataFrame, features: DataFrame, items: list[str], d: str) -> DataFrame:
    """Distinct customers times items with labels (a miss is 0) and a feature column."""
    names = customers.sparkSession.createDataFrame([(i,) for i in items], "prod_name string")
    grid = customers.select("cust_id").distinct().crossJoin(F.broadcast(names))  # the caller's list
    joined = grid.join(labels.select("cust_id", "prod_name", "label"), ["cust_id", "prod_name"], "left").join(features.select("cust_id", "segment"), "cust_id", "left")
    return joined.select(_date(d).alias("snap_date"), "cust_id", "prod_name", F.coalesce("label", F.lit(0)).alias("label"), "segment")


def inference_population(features: DataFrame) -> DataFrame:
    return features.select("snap_date", "cust_id").distinct()
