"""The general patterns of the operators over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.adapter import table
from tidemark.plans.registry import query


@query("select p_brand as brand, count(*) as n, sum(l_quantity)::bigint as quantity from lineitem join part on l_partkey = p_partkey group by p_brand")
def join_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equi-join with a dimension; its size decides whether it is broadcast."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    return lines.join(parts, "l_partkey").groupBy("brand").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query(
    "with counts as (select case when o_custkey % 3 = 0 then null else o_custkey end as k, count(*) as n from orders group by k) "
    "select c_custkey, coalesce(n, 0) as orders from customer left join counts on k is not distinct from case when c_custkey % 3 = 0 then null else c_custkey end"
)
def join_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each customer's key, where null meets null; orders are counted first, so a key shared by many rows meets one row."""
    return join_null_safe_all(spark, sf_dir).select("c_custkey", "orders")


@query(
    "with counts as (select case when o_custkey % 3 = 0 then null else o_custkey end as k, count(*) as n, count(*) filter (where o_orderstatus = 'F') as f, max(o_orderdate) as last from orders group by 1) "
    "select c_custkey, coalesce(n, 0) as orders, coalesce(f, 0) as filled, cast(last as varchar) as last_order from customer left join counts on k is not distinct from case when c_custkey % 3 = 0 then null else c_custkey end"
)
def join_null_safe_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers with what the orders of their key, null among them, come to: all, those filled, the last date."""
    blank = lambda c: F.when(F.col(c) % 3 != 0, F.col(c))
    found = [F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.max("o_orderdate").alias("last")]
    counts = table(spark, sf_dir, "orders").withColumn("k", blank("o_custkey")).groupBy("k").agg(*found)
    customers = table(spark, sf_dir, "customer").select("c_custkey", blank("c_custkey").alias("ck"))
    joined = customers.join(counts, F.col("ck").eqNullSafe(F.col("k")), "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"), F.coalesce("f", F.lit(0)).alias("filled"), F.col("last").cast("string").alias("last_order"))


@query(
    "select o_custkey, "
    + ", ".join(f"count(*) filter (o_orderpriority = '{p}') as p{p[0]}" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
    + " from orders group by o_custkey"
)
def pivot_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(*[F.count_if(F.col("o_orderpriority") == p).alias(f"p{p[0]}") for p in wanted])


@query(
    "select l_suppkey, month, l_orderkey, l_linenumber, rank from (select *, row_number() over (partition by l_suppkey, month order by l_extendedprice desc, l_orderkey, l_linenumber)::int as rank "
    "from (select *, date_trunc('month', l_shipdate)::date as month from lineitem)) where rank <= 2"
)
def top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("month", F.trunc(F.col("l_shipdate").cast("date"), "month"))
    w = Window.partitionBy("l_suppkey", "month").orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber")
    return rows.withColumn("rank", F.row_number().over(w)).filter("rank <= 2").select("l_suppkey", "month", "l_orderkey", "l_linenumber", "rank")


@query(
    "select o.o_orderkey, coalesce(p.o_orderkey, -1) as last_order from orders o left join lateral (select x.o_orderkey from orders x where x.o_custkey = o.o_custkey and (x.o_orderdate, x.o_orderkey) < (o.o_orderdate, o.o_orderkey) and x.o_orderstatus = 'F' "
    "order by x.o_orderdate desc, x.o_orderkey desc limit 1) p on true"
)
def as_of_last_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.last(filled, ignorenulls=True).over(w), F.lit(-1).cast("long")).alias("last_order"))


@query("select o_custkey as custkey from orders union select c_custkey from customer")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    return a.unionByName(b).distinct()


@query("select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(filled, "c_custkey", "left_anti").select("c_custkey", "c_name")
