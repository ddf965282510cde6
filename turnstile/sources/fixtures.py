"""Derived HR-shaped views over the driver's TPC-H-ish tables.

The driver's tables hold no nulls; these views add nulls, sentinels and class
imbalance by key arithmetic only, so every derived row grows with the input
tables.  The Spark side is written with the DataFrame API (pruned, pushed-down
parquet scans); the same definitions as SQL text feed the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                 "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")


def emp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HR table with nulls, 'null' text, zeros and epoch seconds (from orders)."""
    return emp_from_orders(table(spark, sf_dir, "orders"))


def emp_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same view over a file stream of the orders table."""
    # As a pattern the path may be a single file as well as a folder of part
    # files; a plain path must be a folder.
    o = (spark.readStream.schema(ORDERS_SCHEMA).format("parquet")
         .load(f"{sf_dir.rstrip('/')}/orders.parque[t]"))
    return emp_from_orders(o)


def emp_from_orders(o: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    null_s = F.lit(None).cast("string")
    days = F.datediff(F.col("o_orderdate"), F.lit("1970-01-01").cast("date"))
    return o.select(
        k.alias("employee_id"),
        F.when(k % 11 == 0, null_s).when(k % 23 == 0, F.lit("null"))
         .otherwise(F.col("o_orderpriority")).alias("position"),
        F.when(k % 29 == 0, null_s).otherwise(F.col("o_orderstatus")).alias("department"),
        (F.lit(20) + c % 45).cast("double").alias("age"),
        F.when(c % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(c % 5 == 0, "No").otherwise("Yes").alias("is_active"),
        F.when(k % 9 == 0, F.lit(None).cast("bigint")).otherwise(k % 5).alias("education"),
        F.when(c % 3 == 0, "Medical").when(c % 3 == 1, "Life Sciences")
         .otherwise("Other").alias("education_field"),
        (c % 4).alias("job_satisfaction"),
        F.when(k % 6 == 0, F.lit(None).cast("double")).when(k % 10 == 0, F.lit(0.0))
         .otherwise(F.col("o_totalprice")).cast("double").alias("monthly_income"),
        F.when(k % 10 == 0, 40).otherwise(0).alias("standard_hours"),
        null_s.alias("salary_scale"),
        F.when(k % 13 == 0, F.lit(0).cast("bigint"))
         .when(k % 17 == 0, F.lit(None).cast("bigint"))
         .otherwise(days.cast("bigint") * 86400 + 3600).alias("start_date"),
    )


def cust_emp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete numeric HR table (from customer), for balancing and models."""
    cu = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return cu.select(
        k.alias("employee_id"),
        (F.lit(20) + k % 45).cast("double").alias("age"),
        F.col("c_acctbal").alias("monthly_income"),
        F.col("c_nationkey").cast("double").alias("total_working_years"),
        F.col("c_mktsegment").alias("department"),
        F.when(k % 5 == 0, "No").otherwise("Yes").alias("is_active"),
    )


# ---------------------------------------------------------------------------
# The same views as DuckDB SQL (oracle side).
# ---------------------------------------------------------------------------

EMP_SQL = """
select o_orderkey as employee_id,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 23 = 0 then 'null' else o_orderpriority end as position,
  case when o_orderkey % 29 = 0 then null else o_orderstatus end as department,
  cast(20 + o_custkey % 45 as double) as age,
  case when o_custkey % 2 = 0 then 'Female' else 'Male' end as gender,
  case when o_custkey % 5 = 0 then 'No' else 'Yes' end as is_active,
  case when o_orderkey % 9 = 0 then null else o_orderkey % 5 end as education,
  case when o_custkey % 3 = 0 then 'Medical' when o_custkey % 3 = 1 then 'Life Sciences' else 'Other' end as education_field,
  o_custkey % 4 as job_satisfaction,
  cast(case when o_orderkey % 6 = 0 then null when o_orderkey % 10 = 0 then 0 else o_totalprice end as double) as monthly_income,
  case when o_orderkey % 10 = 0 then 40 else 0 end as standard_hours,
  cast(null as varchar) as salary_scale,
  case when o_orderkey % 13 = 0 then 0 when o_orderkey % 17 = 0 then null
       else cast(datediff('day', date '1970-01-01', o_orderdate) as bigint) * 86400 + 3600 end as start_date
from orders
"""

CUST_EMP_SQL = """
select c_custkey as employee_id,
  cast(20 + c_custkey % 45 as double) as age,
  c_acctbal as monthly_income,
  cast(c_nationkey as double) as total_working_years,
  c_mktsegment as department,
  case when c_custkey % 5 = 0 then 'No' else 'Yes' end as is_active
from customer
"""
