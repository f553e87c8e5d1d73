"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.registry import Tables, query


@query("f01_equality_predicates", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IS NOT NULL AND o_totalprice <> 0")
def equality(t: Tables) -> DataFrame:
    return t.orders.where((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_custkey").isNotNull() & (F.col("o_totalprice") != 0)).select("o_orderkey", "o_custkey")


@query("f02_prefix_like", "SELECT p_partkey, p_name FROM part WHERE p_type LIKE 'S%' AND p_brand NOT LIKE 'Brand#1%'")
def prefix_like(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_type").startswith("S") & ~F.col("p_brand").startswith("Brand#1")).select("p_partkey", "p_name")


@query("f03_case_projection", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 40 THEN 'large' WHEN l_quantity >= 20 THEN 'medium' ELSE 'small' END AS size_class, CASE WHEN l_linestatus = 'F' THEN l_partkey END AS shipped_part FROM lineitem")
def case_projection(t: Tables) -> DataFrame:
    size = F.when(F.col("l_quantity") >= 40, "large").when(F.col("l_quantity") >= 20, "medium").otherwise("small")
    return t.lineitem.select("l_orderkey", "l_linenumber", size.alias("size_class"), F.when(F.col("l_linestatus") == "F", F.col("l_partkey")).alias("shipped_part"))


@query("f04_case_in_aggregate", "SELECT l_returnflag, CAST(COUNT(*) FILTER (l_linestatus = 'F') AS BIGINT) AS accepted, CAST(SUM(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS BIGINT) AS large, COUNT(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END) AS accepted_orders FROM lineitem GROUP BY 1")
def case_in_aggregate(t: Tables) -> DataFrame:
    done = F.col("l_linestatus") == "F"
    return t.lineitem.groupBy("l_returnflag").agg(F.count_if(done).alias("accepted"), F.sum(F.when(F.col("l_quantity") > 25, 1).otherwise(0)).alias("large"), F.countDistinct(F.when(done, F.col("l_orderkey"))).alias("accepted_orders"))


@query("f05_coalesce", "SELECT c_custkey, COALESCE(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def null_handling(t: Tables) -> DataFrame:
    n = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return t.customer.join(n, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"))


def rewrite_prefix(col: str, old: str, new: str) -> F.Column:
    """Ids that begin with ``old`` begin with ``new`` instead; null for others."""
    return F.when(F.col(col).startswith(old), F.concat(F.lit(new), F.substring(F.col(col), len(old) + 1, 1_000_000)))


@query("f06_key_rewrite", "SELECT s_name, 'u-r2-' || SUBSTRING(s_name, 10) AS new_id, LENGTH(s_name) AS old_length FROM supplier WHERE STARTS_WITH(s_name, 'Supplier#')")
def key_rewrite(t: Tables) -> DataFrame:
    out = t.supplier.select("s_name", rewrite_prefix("s_name", "Supplier#", "u-r2-").alias("new_id"), F.length("s_name").cast("long").alias("old_length"))
    return out.where("new_id IS NOT NULL")


@query("f07_drop_key", "SELECT * EXCLUDE (n_nationkey) FROM nation")
def drop_key(t: Tables) -> DataFrame:
    return t.nation.drop("n_nationkey")


def seconds_since_first(events: DataFrame) -> DataFrame:
    """``elapsed``: whole seconds since the first event; the range is one row."""
    start = events.agg(F.min("ts").alias("t0"))
    return events.crossJoin(F.broadcast(start)).withColumn("elapsed", (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("t0").cast("timestamp"))) / 1_000_000)


ELAPSED = "WITH e AS (SELECT *, (epoch_us(ts) - (SELECT MIN(epoch_us(ts)) FROM events)) / 1000000.0 AS elapsed FROM events)"


@query("f08_time_range", f"{ELAPSED} SELECT event_id, CASE WHEN elapsed >= 86400 AND elapsed <= 864000 THEN 'measurement' ELSE 'drain' END AS phase FROM e WHERE elapsed >= 86400 AND elapsed <= 864000 OR elapsed > 864000 AND elapsed <= 1728000")
def time_range(t: Tables) -> DataFrame:
    e = seconds_since_first(t.events)
    phase = F.when(F.col("elapsed").between(86_400, 864_000), "measurement").when((F.col("elapsed") > 864_000) & (F.col("elapsed") <= 1_728_000), "drain")
    return e.select("event_id", phase.alias("phase")).where("phase IS NOT NULL")


@query("f09_expired_lease", "SELECT o_orderkey FROM orders WHERE o_orderdate < (SELECT MAX(o_orderdate) - INTERVAL 30 DAY FROM orders) AND o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')")
def expired_lease(t: Tables) -> DataFrame:
    now = t.orders.agg((F.max("o_orderdate") - F.expr("INTERVAL 30 DAYS")).alias("now"))
    late = t.orders.where("o_orderstatus = 'O'").crossJoin(F.broadcast(now)).where("o_orderdate < now")
    done = t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return late.join(done, "o_orderkey", "left_anti").select("o_orderkey")


@query("f10_bound_parameters", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000 AND c_name <> 'a ? in quotes'")
def bound_parameters(t: Tables) -> DataFrame:
    return t.spark.sql("SELECT c_custkey, c_name FROM {c} WHERE c_mktsegment = :segment AND c_acctbal > :least AND c_name <> 'a ? in quotes'", args={"segment": "BUILDING", "least": 5000}, c=t.customer)
