"""Windows, ordering, limits and top-k."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.registry import Tables, query


@query("w01_value_once_per_group", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1 THEN o_orderpriority END AS shipped_once FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def value_once(t: Tables) -> DataFrame:
    """A wide column of a group goes with its first row only."""
    rn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("rn", rn)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("rn") == 1, F.col("o_orderpriority")).alias("shipped_once"))


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key; an aggregation, so a hot key is combined before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_x")).select(key, "_x.*")


@query("w02_latest_per_key", "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def latest_per_key(t: Tables) -> DataFrame:
    return latest(t.orders, "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_orderstatus")


@query("w03_first_per_key", "SELECT SHA256(text) AS hash, MIN(doc_id) AS doc_id, ARG_MIN(source, doc_id) AS source FROM documents GROUP BY 1")
def first_per_key(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.sha2("text", 256).alias("hash")).agg(F.min("doc_id").alias("doc_id"), F.min_by("source", "doc_id").alias("source"))


def hash_order(prefix: str, col: str) -> Column:
    """A deterministic order that looks random."""
    return F.sha2(F.concat(F.lit(prefix), F.col(col).cast("string")), 256)


BLOCK_ROWS = 50_000


def hex_digits(rows: DataFrame) -> int:
    """So many digits of a hash keep blocks of about ``BLOCK_ROWS`` rows."""
    return max(1, math.ceil(math.log(max(1, rows.count() / BLOCK_ROWS), 16)))


def places(rows: DataFrame, blocks: dict[str, Column], *order: Column | str, by: str | None = None) -> DataFrame:
    """``place`` (from 1) of every row in order, within each ``by``, without one task holding all rows.

    ``blocks`` names columns whose values, few and in the order given for each, follow the order of the rows;
    rows fall into blocks of equal values, and the sizes of the blocks before one are summed up first.
    """
    keys = [*([by] if by else []), *blocks]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_base", running_offset("_n", *blocks.values(), by=by))
    sizes = sizes.drop("_n").withColumnsRenamed({b: f"_of_{b}" for b in keys})
    same = reduce(and_, (F.col(b).eqNullSafe(F.col(f"_of_{b}")) for b in keys))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    # dealt out first, so that an order by expressions doesn't send their values as well
    met = rows.repartition(*keys).withColumn("_within", within).join(sizes, same)
    return met.withColumn("place", (F.col("_base") + F.col("_within")).cast("long")).drop("_base", "_within", *(f"_of_{b}" for b in keys))


def key_ranges(rows: DataFrame, key: str, block_rows: int = BLOCK_ROWS) -> Column:
    """Number of the block of an integer key: equal ranges of it, as many as keep about ``block_rows`` rows in each."""
    low, high, n = rows.agg(F.min(key), F.max(key), F.count("*")).first()
    width = max(1, ((high or 0) - (low or 0) + 1) * block_rows // max(1, n))
    return F.floor(F.col(key) / width).cast("long")


@query("w04_multi_key_sort", "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderpriority DESC, o_orderstatus, SHA256('b:' || o_orderkey)) AS place FROM orders")
def multi_key_sort(t: Tables) -> DataFrame:
    """The place of every row."""
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", hash_order("b:", "o_orderkey").alias("h"))
    o = o.withColumn("head", F.substring("h", 1, hex_digits(t.orders)))
    blocks = {"o_orderpriority": F.desc("o_orderpriority"), "o_orderstatus": F.col("o_orderstatus"), "head": F.col("head")}
    return places(o, blocks, "h", "o_orderkey").select("o_orderkey", "place")


def hardest_and_sample(rows: DataFrame, key: str, size: str, *, hardest: float, sample: int, prefix: str) -> DataFrame:
    """The largest share of the rows, and of the others so many by hash order; ``pick`` says which.

    Rows are counted by size, and the counts, from large to small, say at which
    size the share ends; only rows of that one size are put in order.
    """
    n = int(rows.count() * hardest)
    counts = rows.groupBy(F.col(size).alias("_size")).agg(F.count("*").alias("_n")).withColumn("_before", running_offset("_n", F.desc("_size")))
    end = counts.where((F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n)).first()
    if end is None:
        top = rows.limit(0).select(key)
    else:
        above = rows.where(F.lit(True) if end["_size"] is None else F.col(size) > end["_size"]).where(F.col(size).isNotNull())
        top = above.select(key).unionByName(rows.where(F.col(size).eqNullSafe(F.lit(end["_size"]))).orderBy(key).limit(n - end["_before"]).select(key))
    top = top.withColumn("pick", F.lit("hardest"))
    rest = rows.join(top.select(key), key, "left_anti").orderBy(hash_order(prefix, key)).limit(sample).select(key).withColumn("pick", F.lit("sample"))
    return top.unionByName(rest)


@query("w05_hardest_and_hash_sample", "WITH top AS (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT (SELECT CAST(FLOOR(COUNT(*) * 0.2) AS BIGINT) FROM documents)) SELECT doc_id, 'hardest' AS pick FROM top UNION ALL (SELECT doc_id, 'sample' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM top) ORDER BY SHA256('s:' || doc_id) LIMIT 50)")
def hardest(t: Tables) -> DataFrame:
    return hardest_and_sample(t.documents.select("doc_id", "n_chars"), "doc_id", "n_chars", hardest=0.2, sample=50, prefix="s:")


def running_offset(size: str, *order: Column | str, by: str | None = None) -> Column:
    """Sum of the sizes before a row."""
    w = (Window.partitionBy(by) if by else Window.partitionBy()).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(w), F.lit(0))


def running_offset_in_blocks(rows: DataFrame, size: str, key: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``offset`` of every row in key order without one task holding all rows.

    Rows fall into ranges of the key, whose number follows that of the rows; the totals of ranges are summed up first.
    """
    b = rows.withColumn("_b", key_ranges(rows, key, block_rows))
    totals = b.groupBy("_b").agg(F.sum(size).alias("_t")).withColumn("_base", running_offset("_t", "_b")).drop("_t")
    return b.join(totals, "_b").withColumn("offset", F.col("_base") + running_offset(size, key, by="_b")).drop("_b", "_base")


@query("w06_running_offset", "SELECT doc_id, CAST(COALESCE(SUM(STRLEN(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM documents")
def offsets(t: Tables) -> DataFrame:
    sized = t.documents.select("doc_id", F.octet_length("text").cast("long").alias("bytes"))
    return running_offset_in_blocks(sized, "bytes", "doc_id").select("doc_id", F.col("offset").cast("long").alias("offset"))


@query("w07_contiguity", "WITH o AS (SELECT event_id, ts, LAG(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) SELECT CAST(COUNT(*) FILTER (before >= event_id) AS BIGINT) AS broken, COUNT(*) AS checked FROM o")
def contiguity(t: Tables) -> DataFrame:
    o = t.events.withColumn("before", F.lag("event_id").over(Window.partitionBy("user_id").orderBy("event_id")))
    return o.agg(F.count_if(F.expr("before >= event_id")).alias("broken"), F.count("*").alias("checked"))


@query("w08_order_by_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def order_by_limit(t: Tables) -> DataFrame:
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


def pages(rows: DataFrame, size: int, key: str, *, by: str) -> DataFrame:
    """``page`` (from 0) of ``size`` rows in the order of an integer key, within each ``by``, however many rows that has."""
    placed = places(rows.withColumn("_range", key_ranges(rows, key)), {"_range": F.col("_range")}, key, by=by)
    return placed.withColumn("page", F.floor((F.col("place") - 1) / size).cast("long")).drop("place", "_range")


@query("w09_fixed_size_pages", "SELECT c_custkey, (ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 10 AS page FROM customer")
def fixed_pages(t: Tables) -> DataFrame:
    return pages(t.customer, 10, "c_custkey", by="c_nationkey").select("c_custkey", "page")


@query("w10_hash_order", "SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY SHA256('pilot-v1:' || c_custkey)) AS place FROM customer")
def by_hash(t: Tables) -> DataFrame:
    """The place of every row."""
    c = t.customer.select("c_custkey", hash_order("pilot-v1:", "c_custkey").alias("h"))
    c = c.withColumn("head", F.substring("h", 1, hex_digits(t.customer)))
    return places(c, {"head": F.col("head")}, "h", "c_custkey").select("c_custkey", "place")


@query("w11_interval_rate", "WITH s AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0 AS sec, LAG(event_id) OVER w AS prev, LAG(epoch_us(ts) / 1000000.0) OVER w AS prev_sec FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT event_id, ROUND((event_id - prev) * 60.0 / GREATEST(ABS(sec - prev_sec), 1), 6) AS per_minute FROM s WHERE prev IS NOT NULL")
def interval_rate(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    s = t.events.withColumn("sec", F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).withColumn("prev", F.lag("event_id").over(w)).withColumn("prev_sec", F.lag("sec").over(w))
    return s.where("prev IS NOT NULL").select("event_id", F.round((F.col("event_id") - F.col("prev")) * 60.0 / F.greatest(F.abs(F.col("sec") - F.col("prev_sec")), F.lit(1)), 6).alias("per_minute"))
