"""Aggregations: counts, pivots, percentiles, digests, grouped collections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.projections import ELAPSED, seconds_since_first
from sparkloom.registry import Tables, query


@query("g01_global_aggregates", "SELECT COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS quantity, MAX(l_orderkey) AS last_key FROM lineitem")
def global_aggregates(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"), F.max("l_orderkey").alias("last_key"))


@query("g02_group_by_one", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1")
def group_by_one(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("g03_group_by_many", "SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2")
def group_by_many(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("g04_count_distinct", "SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"))


@query("g05_conditional_distinct", "SELECT c_custkey, COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS done, COUNT(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END) AS open_kinds FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def conditional_distinct(t: Tables) -> DataFrame:
    j = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.groupBy("c_custkey").agg(F.countDistinct(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("done"), F.countDistinct(F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))).alias("open_kinds"))


@query("g06_having", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def having(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("g07_string_aggregate", "SELECT n_regionkey, STRING_AGG(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def string_aggregate(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.expr("listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name)").alias("names"))


@query("g08_two_level_preaggregation", "WITH a AS (SELECT l_orderkey, COUNT(*) AS units, SUM(l_quantity) AS q FROM lineitem GROUP BY 1), b AS (SELECT o_custkey, COUNT(*) AS orders, SUM(COALESCE(units, 0)) AS units, SUM(COALESCE(q, 0)) AS q FROM orders LEFT JOIN a ON l_orderkey = o_orderkey GROUP BY 1) SELECT c_mktsegment, CAST(SUM(orders) AS BIGINT) AS orders, CAST(SUM(units) AS BIGINT) AS units, CAST(SUM(q) AS BIGINT) AS quantity FROM customer JOIN b ON o_custkey = c_custkey GROUP BY 1")
def two_level(t: Tables) -> DataFrame:
    a = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("units"), F.sum("l_quantity").alias("q"))
    b = t.orders.join(a, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum("units").alias("units"), F.sum("q").alias("q"))
    return t.customer.join(b, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.sum("orders").alias("orders"), F.sum("units").alias("units"), F.sum("q").cast("long").alias("quantity"))


@query("g09_distinct_with_order_key", "SELECT DISTINCT o_orderdate, o_orderkey, o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linestatus = 'O'")
def distinct_rows(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.where("l_linestatus = 'O'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("o_orderdate", "o_orderkey", "o_custkey").distinct()


@query("g10_total_minus_incomplete", "SELECT (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS total, (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem WHERE l_linestatus <> 'F') AS incomplete, (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) - (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem WHERE l_linestatus <> 'F') AS complete")
def total_minus_incomplete(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(F.bool_or(F.col("l_linestatus") != "F").alias("open"))
    return per.agg(F.count("*").alias("total"), F.count_if(F.expr("open")).alias("incomplete"), F.count_if(F.expr("not open")).alias("complete"))


TOKENS = "tok AS (SELECT source, UNNEST(REGEXP_EXTRACT_ALL(LOWER(text), '[a-z]+')) AS term FROM documents), freq AS (SELECT source, term, COUNT(*) AS n FROM tok GROUP BY 1, 2), ranked AS (SELECT source, term, ROW_NUMBER() OVER (PARTITION BY source ORDER BY n DESC, term) AS rank FROM freq)"


def frequency_lists(t: Tables) -> DataFrame:
    """(source, term, rank): the tokens of each source, the most frequent first."""
    tok = t.documents.select("source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("term"))
    freq = tok.groupBy("source", "term").agg(F.count("*").alias("n"))
    return freq.select("source", "term", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "term")).cast("long").alias("rank"))


@query("g11_best_rank", f"WITH {TOKENS} SELECT term, MIN(rank) AS best FROM ranked WHERE rank <= 1000 GROUP BY 1")
def best_rank(t: Tables) -> DataFrame:
    return frequency_lists(t).where("rank <= 1000").groupBy("term").agg(F.min("rank").alias("best"))


@query("g12_set_cardinalities", f"WITH {TOKENS}, m AS (SELECT term, BOOL_OR(source = 'src0') AS a, BOOL_OR(source = 'src1') AS b FROM ranked WHERE rank <= 500 GROUP BY 1) SELECT CAST(COUNT(*) FILTER (a OR b) AS BIGINT) AS union_size, CAST(COUNT(*) FILTER (a AND b) AS BIGINT) AS common, CAST(COUNT(*) FILTER (a AND NOT b) AS BIGINT) AS only_first FROM m")
def set_cardinalities(t: Tables) -> DataFrame:
    m = frequency_lists(t).where("rank <= 500").groupBy("term").agg(F.bool_or(F.col("source") == "src0").alias("a"), F.bool_or(F.col("source") == "src1").alias("b"))
    return m.agg(F.count_if(F.expr("a or b")).alias("union_size"), F.count_if(F.expr("a and b")).alias("common"), F.count_if(F.expr("a and not b")).alias("only_first"))


@query("g13_membership_histogram", f"WITH {TOKENS}, m AS (SELECT term, COUNT(DISTINCT source) AS sources FROM ranked WHERE rank <= 300 GROUP BY 1) SELECT sources, COUNT(*) AS terms FROM m GROUP BY 1")
def membership_histogram(t: Tables) -> DataFrame:
    """A map of ranks by source for each term, and how many terms have so many sources."""
    pivot = frequency_lists(t).where("rank <= 300").groupBy("term").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "rank")))).alias("ranks"))
    return pivot.groupBy(F.size("ranks").cast("long").alias("sources")).agg(F.count("*").alias("terms"))


@query("g14_three_way_status", "SELECT CASE WHEN l_orderkey IS NULL THEN 'absent' WHEN done THEN 'translated' ELSE 'untranslated' END AS status, COUNT(*) AS n FROM orders LEFT JOIN (SELECT l_orderkey, BOOL_AND(l_linestatus = 'F') AS done FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1")
def three_way_status(t: Tables) -> DataFrame:
    done = t.lineitem.groupBy("l_orderkey").agg(F.every(F.col("l_linestatus") == "F").alias("done"))
    status = F.when(F.col("l_orderkey").isNull(), "absent").when(F.col("done"), "translated").otherwise("untranslated")
    return t.orders.join(done, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


ACCURACY = 10_000


def exact_ranks(rows: DataFrame, key: str, col: str, picks: dict[str, tuple[float, Callable[[Column], Column]]]) -> DataFrame:
    """The values at given 0-based places of each key's non-null values in order.

    ``picks`` has for each name a fraction near the place and the place as a
    function of the number of values. Sketches bound each value closely from both
    sides, the rows below are counted, and only those between are put in order:
    few, however many rows a key has.
    """
    some = rows.where(F.col(col).isNotNull()).select(F.col(key).alias("_key"), F.col(col).alias("_v"))
    slack = 3 / ACCURACY
    ends = {name: [max(0.0, f - slack), min(1.0, f + slack)] for name, (f, _) in picks.items()}
    sketch = some.groupBy("_key").agg(F.count("*").alias("_n"), *(F.percentile_approx("_v", e, ACCURACY).alias(f"_{name}") for name, e in ends.items()))
    found = rows.select(F.col(key).alias("_key")).distinct()
    met = some.join(sketch.withColumnRenamed("_key", "_k"), F.col("_key").eqNullSafe(F.col("_k"))).drop("_k")
    # one pass counts what lies below the bounds, another one keeps what lies between; few values are kept all
    few = F.col("_n") <= ACCURACY
    bounds = {name: (F.col(f"_{name}")[0], F.col(f"_{name}")[1]) for name in picks}
    below = met.groupBy("_key").agg(*(F.count_if(~few & (F.col("_v") < low)).alias(f"_b_{name}") for name, (low, _) in bounds.items()))
    near = met.withColumn("_pick", F.explode(F.filter(F.array(*(F.when(few | F.col("_v").between(low, high), F.lit(name)) for name, (low, high) in bounds.items())), lambda x: x.isNotNull())))
    counted = near.groupBy("_key", "_n", "_pick", "_v").agg(F.count("*").alias("_c"))
    start = F.sum("_c").over(Window.partitionBy("_key", "_pick").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1))
    placed = counted.withColumn("_from", F.coalesce(start, F.lit(0))).join(below.withColumnRenamed("_key", "_k"), F.col("_key").eqNullSafe(F.col("_k"))).drop("_k")
    chosen = []
    for name, (_, place) in picks.items():
        at = place(F.col("_n")) - F.col(f"_b_{name}")
        chosen.append(F.max(F.when((F.col("_pick") == name) & (F.col("_from") <= at) & (at < F.col("_from") + F.col("_c")), F.col("_v"))).alias(name))
    got = placed.groupBy("_key").agg(*chosen).withColumnRenamed("_key", "_k")
    return found.join(got, F.col("_key").eqNullSafe(F.col("_k")), "left").drop("_k").withColumnRenamed("_key", key)


def nearest_rank(fraction: float) -> tuple[float, Callable[[Column], Column]]:
    """The place ceil(fraction * n), from 1."""
    return fraction, lambda n: F.least(n - 1, F.ceil(n * F.lit(fraction)) - 1)


@query("g15_nearest_rank_percentile", "WITH r AS (SELECT event_type, value, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, COUNT(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_type, MAX(value) FILTER (i = LEAST(n - 1, CEIL(0.5 * n) - 1)) AS p50, MAX(value) FILTER (i = LEAST(n - 1, CEIL(0.95 * n) - 1)) AS p95 FROM r GROUP BY 1")
def nearest_rank_percentile(t: Tables) -> DataFrame:
    return exact_ranks(t.events, "event_type", "value", {"p50": nearest_rank(0.5), "p95": nearest_rank(0.95)})


def rounded_rank(rows: DataFrame, key: str, col: str, fractions: dict[str, float]) -> DataFrame:
    """Percentiles at 0-based place round((n - 1) * fraction), halves to even; null for no values."""
    return exact_ranks(rows, key, col, {name: (f, lambda n, f=f: F.bround((n - 1) * F.lit(f), 0).cast("long")) for name, f in fractions.items()})


@query("g16_rounded_rank_percentile", "WITH r AS (SELECT event_type, value, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, COUNT(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_type, MAX(value) FILTER (i = ROUND_EVEN((n - 1) * 0.5, 0)) AS p50, MAX(value) FILTER (i = ROUND_EVEN((n - 1) * 0.95, 0)) AS p95, MAX(value) FILTER (i = ROUND_EVEN((n - 1) * 0.99, 0)) AS p99 FROM r GROUP BY 1")
def rounded_rank_percentile(t: Tables) -> DataFrame:
    return rounded_rank(t.events, "event_type", "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query("g17_index_picks", "WITH r AS (SELECT user_id, value, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value) - 1 AS i, COUNT(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, MIN(value) AS least, MAX(value) FILTER (i = n // 2) AS median, MAX(value) FILTER (i = FLOOR((n - 1) * 0.95)) AS p95, MAX(value) AS most FROM r GROUP BY 1")
def index_picks(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id")
    r = t.events.withColumn("i", F.row_number().over(w.orderBy("value")) - 1).withColumn("n", F.count("*").over(w))
    return r.groupBy("user_id").agg(F.min("value").alias("least"), F.max(F.when(F.col("i") == F.floor(F.col("n") / 2), F.col("value"))).alias("median"), F.max(F.when(F.col("i") == F.floor((F.col("n") - 1) * 0.95), F.col("value"))).alias("p95"), F.max("value").alias("most"))


@query("g18_rates", f"{ELAPSED} SELECT event_type, ROUND(COUNT(*) * 60.0 / GREATEST(MAX(elapsed) - MIN(elapsed), 1), 6) AS per_minute, ROUND(COUNT(*) FILTER (value > 50) / GREATEST(COUNT(*), 1)::DOUBLE, 6) AS error_rate FROM e GROUP BY 1")
def rates(t: Tables) -> DataFrame:
    e = seconds_since_first(t.events)
    return e.groupBy("event_type").agg(F.round(F.count("*") * 60.0 / F.greatest(F.max("elapsed") - F.min("elapsed"), F.lit(1)), 6).alias("per_minute"), F.round(F.count_if(F.col("value") > 50) / F.greatest(F.count("*"), F.lit(1)), 6).alias("error_rate"))


def counter_delta(col: str, order: str, *, slack: float = 1e-6) -> Column:
    """Last less first value of a counter that may not fall; small falls count as zero."""
    delta = F.max_by(col, order) - F.min_by(col, order)
    return F.when(delta < -slack, F.raise_error(F.lit(f"{col} has fallen")).cast("double")).otherwise(F.greatest(delta, F.lit(0.0)))


@query("g19_counter_delta", "WITH c AS (SELECT user_id, event_id, COUNT(*) OVER (PARTITION BY user_id ORDER BY event_id) AS running FROM events) SELECT user_id, GREATEST(CAST(ARG_MAX(running, event_id) - ARG_MIN(running, event_id) AS DOUBLE), 0) AS delta FROM c GROUP BY 1")
def counter_deltas(t: Tables) -> DataFrame:
    running = F.count("*").over(Window.partitionBy("user_id").orderBy("event_id")).cast("double")
    return t.events.withColumn("running", running).groupBy("user_id").agg(counter_delta("running", "event_id").alias("delta"))


#: A window's events: what each of them says, in words that Spark and DuckDB share.
WINDOW_SECONDS = 432_000
SAID = {
    "completed": "event_type = 'purchase'", "submitted": "event_type = 'signup'", "failed": "event_type = 'error'",
    "rate_limit": "event_type = 'error' AND k % 5 = 0", "timeout": "event_type = 'error' AND k % 5 = 1", "transport": "event_type = 'error' AND k % 5 = 2", "rejected": "event_type = 'error' AND k % 5 = 3", "stale": "event_type = 'error' AND k % 5 = 4",
    "retry": "event_type = 'click' AND k = 0", "split": "event_type = 'click' AND k = 1", "drained": "event_type = 'view' AND k = 0",
}
ERRORS = ("failed", "rate_limit", "timeout", "transport", "rejected", "stale")
TOKENS_OF = {"input_tokens": "100 + k", "cached_tokens": "k", "output_tokens": "10 * k"}
DONE = "event_type = 'purchase'"


def window_events(t: Tables) -> DataFrame:
    e = seconds_since_first(t.events)
    return e.withColumn("window_id", F.floor(F.col("elapsed") / WINDOW_SECONDS).cast("long")).withColumn("k", F.get_json_object("props", "$.k").cast("long"))


def window_summary(e: DataFrame) -> DataFrame:
    """Some thirty measures of each window in one aggregation, and latencies by exact ranks.

    Counters that only grow (``elapsed`` stands for one) are taken as last less
    first, and a fall is an error; rates are by the minute; shares have at least one below the line.
    """
    done = F.expr(DONE)
    minutes = F.greatest(F.max("elapsed") - F.min("elapsed"), F.lit(1e-9)) / 60
    measured = F.max("elapsed") - F.min("elapsed")
    busy = F.round(F.coalesce(F.sum(F.when(done, F.col("value"))), F.lit(0.0)), 4)  # the same in any order
    n = F.greatest(F.count_if(done), F.lit(1))
    g = e.groupBy("window_id").agg(
        measured.alias("measured_seconds"),
        *(F.count_if(F.expr(v)).alias(k) for k, v in SAID.items()),
        *(F.coalesce(F.sum(F.when(done, F.expr(v))), F.lit(0)).alias(k) for k, v in TOKENS_OF.items()),
        F.countDistinct("user_id").alias("workers"),
        F.max(F.when(done | (F.col("event_type") == "view"), F.col("value"))).alias("peak"),
        counter_delta("elapsed", "elapsed").alias("counter_delta"),
        (busy / (measured * 1000)).alias("duty_cycle"),
        (busy / n).alias("average_milliseconds"),
        (F.count_if(done) / minutes).alias("completed_per_minute"),
        (F.count("*") / minutes).alias("events_per_minute"),
        F.min_by("event_id", F.when(done, F.struct("elapsed", "event_id"))).alias("first_batch"),
        F.max_by("event_id", F.when(done, F.struct("elapsed", "event_id"))).alias("last_batch"),
        *((F.count_if(F.expr(SAID[k])) / n).alias(f"{k}_rate") for k in ERRORS),
    )
    return g.join(rounded_rank(e.where(done), "window_id", "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99}), "window_id", "left")


def _summary_sql() -> str:
    n, minutes = f"GREATEST(COUNT(*) FILTER ({DONE}), 1)", "(GREATEST(MAX(elapsed) - MIN(elapsed), 1e-9) / 60)"
    busy = f"ROUND(COALESCE(SUM(value) FILTER ({DONE}), 0), 4)"
    cols = [
        "MAX(elapsed) - MIN(elapsed) AS measured_seconds", *(f"CAST(COUNT(*) FILTER ({v}) AS BIGINT) AS {k}" for k, v in SAID.items()), *(f"CAST(COALESCE(SUM({v}) FILTER ({DONE}), 0) AS BIGINT) AS {k}" for k, v in TOKENS_OF.items()),
        "COUNT(DISTINCT user_id) AS workers", f"MAX(value) FILTER ({DONE} OR event_type = 'view') AS peak", "MAX(elapsed) - MIN(elapsed) AS counter_delta", f"{busy} / ((MAX(elapsed) - MIN(elapsed)) * 1000) AS duty_cycle", f"{busy} / {n} AS average_milliseconds",
        f"COUNT(*) FILTER ({DONE}) / {minutes} AS completed_per_minute", f"COUNT(*) / {minutes} AS events_per_minute", f"ARG_MIN(event_id, elapsed) FILTER ({DONE}) AS first_batch", f"ARG_MAX(event_id, elapsed) FILTER ({DONE}) AS last_batch",
        *(f"COUNT(*) FILTER ({SAID[k]}) / {n}::DOUBLE AS {k}_rate" for k in ERRORS),
    ]
    picks = ", ".join(f"MAX(value) FILTER (i = ROUND_EVEN((n - 1) * {f}, 0)) AS p{round(f * 100)}" for f in (0.5, 0.95, 0.99))
    return f"{ELAPSED}, w AS (SELECT *, CAST(FLOOR(elapsed / {WINDOW_SECONDS}) AS BIGINT) AS window_id, CAST(props->>'k' AS BIGINT) AS k FROM e), a AS (SELECT window_id, {', '.join(cols)} FROM w GROUP BY 1), r AS (SELECT window_id, value, ROW_NUMBER() OVER (PARTITION BY window_id ORDER BY value) - 1 AS i, COUNT(*) OVER (PARTITION BY window_id) AS n FROM w WHERE {DONE}), b AS (SELECT window_id, {picks} FROM r GROUP BY 1) SELECT * FROM a LEFT JOIN b USING (window_id)"


@query("g20_event_window_summary", _summary_sql())
def event_window_summary(t: Tables) -> DataFrame:
    return window_summary(window_events(t))


@query("g21_monitor_summary", "SELECT user_id, MAX(value) AS most, CAST(COUNT(*) FILTER (event_type = 'click') AS BIGINT) AS waiting, ROUND(ARG_MAX(value, event_id) - ARG_MIN(value, event_id), 6) AS change FROM events GROUP BY 1")
def monitor_summary(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.max("value").alias("most"), F.count_if(F.col("event_type") == "click").alias("waiting"), F.round(F.max_by("value", "event_id") - F.min_by("value", "event_id"), 6).alias("change"))


LIMBS = 16


def multiset_digest(rows: DataFrame, canonical: Column) -> DataFrame:
    """One row that depends on the rows but not on their order: n, the sums and the xors of 16-bit limbs of their SHA-256.

    Sums of limbs stay exact in 64 bits for 10**14 rows; a total modulo 2**256
    follows from them by carrying.
    """
    h = rows.select(F.sha2(canonical, 256).alias("h"))
    limb = [F.conv(F.substring("h", 4 * k + 1, 4), 16, 10).cast("long") for k in range(LIMBS)]
    return h.agg(F.count("*").alias("n"), *(F.sum(x).alias(f"sum{k}") for k, x in enumerate(limb)), *(F.bit_xor(x).alias(f"xor{k}") for k, x in enumerate(limb)))


LIMB_SQL = [f"('0x' || SUBSTRING(h, {4 * k + 1}, 4))::BIGINT" for k in range(LIMBS)]


@query("g22_multiset_digest", f"WITH r AS (SELECT SHA256(l_orderkey::VARCHAR || ',' || l_partkey::VARCHAR || ',' || l_returnflag) AS h FROM lineitem) SELECT COUNT(*) AS n, {', '.join(f'CAST(SUM({x}) AS BIGINT) AS sum{k}, BIT_XOR({x}) AS xor{k}' for k, x in enumerate(LIMB_SQL))} FROM r")
def digest(t: Tables) -> DataFrame:
    return multiset_digest(t.lineitem, F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), "l_returnflag"))


RANGE_KEYS = 10_000


def joined_hash(order: str, line: str, separator: str = "\n") -> Column:
    """Aggregate: SHA-256 of the lines in order."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: x[line])
    return F.sha2(F.array_join(lines, separator), 256)


def ordered_fingerprint(rows: DataFrame, key: str, line: Column, *, by: str | None = None, keys: int = RANGE_KEYS, separator: str = "\n") -> DataFrame:
    """A digest of the lines in the order of an integer key, one for each value of ``by``.

    The lines of ``keys`` consecutive keys have a SHA-256, and these, in order,
    the digest: no task gathers more than one range, or one hash for each range.
    """
    own = [by] if by else []
    parts = rows.select(*own, F.col(key).alias("_key"), line.alias("_line"), F.floor(F.col(key) / keys).alias("_range"))
    parts = parts.groupBy(*own, "_range").agg(joined_hash("_key", "_line", separator).alias("_digest"))
    return parts.groupBy(*own).agg(joined_hash("_range", "_digest").alias("digest"))


def fingerprint_sql(table: str, key: str, line: str, by: str | None = None, separator: str = "chr(10)") -> str:
    """The same digest, for DuckDB."""
    own, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"SELECT {own}SHA256(STRING_AGG(d, chr(10) ORDER BY r)) AS digest FROM (SELECT {own}{key} // {RANGE_KEYS} AS r, SHA256(STRING_AGG({line}, {separator} ORDER BY {key})) AS d FROM {table} GROUP BY {own}r) {group}"


@query("g23_ordered_fingerprint", f"WITH d AS ({fingerprint_sql('nation', 'n_nationkey', chr(39).join(('n_nationkey::VARCHAR || ', ':', ' || n_name')), 'n_regionkey')}) SELECT n_regionkey, digest, (SELECT digest FROM ({fingerprint_sql('d', 'n_regionkey', 'digest')})) AS whole FROM d")
def fingerprints(t: Tables) -> DataFrame:
    d = ordered_fingerprint(t.nation, "n_nationkey", F.concat_ws(":", F.col("n_nationkey").cast("string"), "n_name"), by="n_regionkey")
    whole = ordered_fingerprint(d, "n_regionkey", F.col("digest")).withColumnRenamed("digest", "whole")
    return d.crossJoin(F.broadcast(whole))


@query("g24_length_prefixed_digest", fingerprint_sql("orders", "o_orderkey", "LENGTH(o_orderpriority)::VARCHAR || ':' || o_orderpriority", separator="''"))
def length_prefixed(t: Tables) -> DataFrame:
    one = F.concat(F.length("o_orderpriority").cast("string"), F.lit(":"), F.col("o_orderpriority"))
    return ordered_fingerprint(t.orders, "o_orderkey", one, separator="")


@query("g25_weighted_histogram", "WITH picks AS (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) SELECT o_orderpriority, COUNT(*) AS weight FROM picks JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def weighted_histogram(t: Tables) -> DataFrame:
    """Ids that repeat weigh as often as they do."""
    return t.lineitem.where("l_quantity > 45").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderpriority").agg(F.count("*").alias("weight"))


def ordered_distinct(value: Column, order: Column) -> Column:
    """Aggregate: the values in order, each at its first place."""
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"]))


WORDS = "w AS (SELECT p_partkey AS entry, STRING_SPLIT(p_name, ' ')[1] AS expression, STRING_SPLIT(p_name, ' ')[-1] AS reading FROM part)"


def entries(t: Tables) -> DataFrame:
    parts = F.split("p_name", " ")
    return t.part.select(F.col("p_partkey").alias("entry"), parts[0].alias("expression"), F.element_at(parts, -1).alias("reading"))


@query("g26_variants_by_expression", f"WITH {WORDS}, f AS (SELECT expression, reading, MIN(entry) AS first FROM w WHERE reading <> expression GROUP BY 1, 2), r AS (SELECT expression, STRING_AGG(reading, ',' ORDER BY first) AS readings FROM f GROUP BY 1) SELECT w.expression, COUNT(*) AS variants, COALESCE(MIN(readings), '') AS readings FROM w LEFT JOIN r ON r.expression = w.expression GROUP BY 1")
def variants_by_expression(t: Tables) -> DataFrame:
    reading = F.when(F.col("reading") != F.col("expression"), F.col("reading"))
    g = entries(t).groupBy("expression").agg(F.count("*").alias("variants"), ordered_distinct(reading, F.col("entry")).alias("r"))
    return g.select("expression", "variants", F.array_join(F.filter("r", lambda x: x.isNotNull()), ",").alias("readings"))


@query("g27_inverted_index", f"WITH {WORDS}, x AS (SELECT DISTINCT reading, expression FROM w WHERE reading NOT IN (SELECT expression FROM w)) SELECT reading, COUNT(*) AS targets, CASE WHEN COUNT(*) = 1 THEN 'redirect' ELSE 'disambiguation' END AS kind, STRING_AGG(expression, ',' ORDER BY expression) AS target_list FROM x GROUP BY 1")
def inverted_index(t: Tables) -> DataFrame:
    w = entries(t)
    x = w.select("reading", "expression").distinct().join(w.select(F.col("expression").alias("reading")), "reading", "left_anti")
    g = x.groupBy("reading").agg(F.count("*").alias("targets"), F.array_join(F.array_sort(F.collect_list("expression")), ",").alias("target_list"))
    return g.withColumn("kind", F.when(F.col("targets") == 1, "redirect").otherwise("disambiguation"))


@query("g28_index_pairs", f"WITH {WORDS} SELECT expression AS title, reading AS value FROM w UNION SELECT reading, reading FROM w")
def index_pairs(t: Tables) -> DataFrame:
    pairs = F.explode(F.array(F.struct(F.col("expression").alias("title"), F.col("reading").alias("value")), F.struct(F.col("reading").alias("title"), F.col("reading").alias("value"))))
    return entries(t).select(pairs.alias("p")).select("p.*").dropDuplicates()


@query("g29_feature_counters", "WITH u AS (SELECT 'brand' AS kind, p_brand AS value FROM part UNION ALL SELECT 'type', p_type FROM part UNION ALL SELECT 'size', p_size::VARCHAR FROM part) SELECT kind, value, COUNT(*) AS n, MAX(STRLEN(value)) AS most_bytes FROM u GROUP BY 1, 2")
def feature_counters(t: Tables) -> DataFrame:
    u = t.part.selectExpr("stack(3, 'brand', p_brand, 'type', p_type, 'size', cast(p_size as string)) as (kind, value)")
    return u.groupBy("kind", "value").agg(F.count("*").alias("n"), F.max(F.octet_length("value")).cast("long").alias("most_bytes"))


@query("g30_merged_counters", "SELECT k, CAST(SUM(n) AS BIGINT) AS n FROM (SELECT l_returnflag AS k, COUNT(*) AS n FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY 1 UNION ALL SELECT l_returnflag, COUNT(*) FROM lineitem WHERE l_orderkey % 2 = 1 GROUP BY 1) GROUP BY 1")
def merged_counters(t: Tables) -> DataFrame:
    parts = [t.lineitem.where(F.col("l_orderkey") % 2 == k).groupBy(F.col("l_returnflag").alias("k")).agg(F.count("*").alias("n")) for k in (0, 1)]
    return parts[0].unionByName(parts[1]).groupBy("k").agg(F.sum("n").alias("n"))


@query("g31_loss_ledger", "SELECT p_type AS feature, CAST(COUNT(*) FILTER (p_size % 4 = 0) AS BIGINT) AS exact, CAST(COUNT(*) FILTER (p_size % 4 = 1) AS BIGINT) AS adapted, CAST(COUNT(*) FILTER (p_size % 4 = 2) AS BIGINT) AS degraded, CAST(COUNT(*) FILTER (p_size % 4 = 3) AS BIGINT) AS omitted FROM part GROUP BY 1")
def loss_ledger(t: Tables) -> DataFrame:
    levels = ["exact", "adapted", "degraded", "omitted"]
    level = F.element_at(F.array(*map(F.lit, levels)), (F.col("p_size") % 4 + 1).cast("int"))
    return t.part.withColumn("level", level).groupBy(F.col("p_type").alias("feature")).pivot("level", levels).agg(F.count(F.lit(1))).na.fill(0)


@query("g32_sample_limited", "SELECT event_type, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) WHERE rn <= 10")
def sample_limited(t: Tables) -> DataFrame:
    return t.events.withColumn("rn", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id"))).where("rn <= 10").select("event_type", "event_id")


@query("g33_content_hash_groups", "SELECT SHA256(text) AS hash, COUNT(*) AS n, MIN(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING COUNT(*) > 1")
def content_hash_groups(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.sha2("text", 256).alias("hash")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@query("g34_findings_by_unit", "WITH f AS (SELECT user_id, event_type, MIN(event_id) AS first FROM events GROUP BY 1, 2) SELECT user_id, STRING_AGG(event_type, ',' ORDER BY first) AS codes FROM f GROUP BY 1")
def findings_by_unit(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.array_join(ordered_distinct(F.col("event_type"), F.col("event_id")), ",").alias("codes"))


@query("g35_size_estimate", "SELECT o_custkey, CAST(SUM(q) + 512 * SUM(units) + 1024 * COUNT(*) AS BIGINT) AS estimate FROM orders JOIN (SELECT l_orderkey, SUM(l_quantity) AS q, COUNT(*) AS units FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1")
def size_estimate(t: Tables) -> DataFrame:
    a = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"), F.count("*").alias("units"))
    return t.orders.join(a, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg((F.sum("q") + 512 * F.sum("units") + 1024 * F.count("*")).cast("long").alias("estimate"))


CASES = {"long_text": "n_chars > 5000", "short_text": "n_chars < 200", "french": "lang = 'fr'", "first_source": "source = 'src0'"}


@query("g36_smoke_cases", " UNION ALL ".join(f"SELECT '{k}' AS case_name, MIN(doc_id) AS doc_id FROM documents WHERE {v}" for k, v in CASES.items()) + " UNION ALL SELECT 'longest', (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 1)")
def smoke_cases(t: Tables) -> DataFrame:
    """The first row for which each predicate holds, and the longest one, in one pass."""
    firsts = [F.min(F.when(F.expr(v), F.col("doc_id"))).alias(k) for k, v in CASES.items()]
    longest = F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("longest")
    names = [*CASES, "longest"]
    return t.documents.agg(*firsts, longest).selectExpr(f"stack({len(names)}, {', '.join(f'\'{n}\', {n}' for n in names)}) as (case_name, doc_id)")


#: Features of an article, over its lines: thirteen conditions on what an aggregation of them has.
FEATURES = {
    "oversize": "bytes > 150", "single_unit": "units = 1", "multi_unit": "units > 1", "has_returns": "returned > 0", "open_lines": "open > 0", "all_open": "open = units", "large_line": "largest >= 45", "small_line": "smallest <= 5",
    "many_sources": "sources > 2", "one_source": "sources = 1", "discounted": "discount >= 0.1", "untaxed": "tax = 0", "late": "late > 0",
}
LINE_AGGREGATES = {
    "units": "COUNT(*)", "bytes": "CAST(SUM(l_quantity) AS BIGINT)", "returned": "SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)", "open": "SUM(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)", "largest": "MAX(l_quantity)", "smallest": "MIN(l_quantity)",
    "sources": "COUNT(DISTINCT l_suppkey)", "discount": "MAX(l_discount)", "tax": "MIN(l_tax)", "late": "SUM(CASE WHEN l_linenumber > 5 THEN 1 ELSE 0 END)",
}


@query("g37_feature_vector", f"WITH a AS (SELECT l_orderkey, {', '.join(f'{v} AS {k}' for k, v in LINE_AGGREGATES.items())} FROM lineitem GROUP BY 1), r AS (SELECT l_orderkey, STRING_AGG(l_returnflag || ':' || n, ',' ORDER BY l_returnflag) AS roles FROM (SELECT l_orderkey, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1) SELECT a.l_orderkey, units, bytes, roles, CONCAT_WS(',', {', '.join(f'CASE WHEN {v} THEN {chr(39)}{k}{chr(39)} END' for k, v in sorted(FEATURES.items()))}) AS features FROM a JOIN r ON r.l_orderkey = a.l_orderkey")
def feature_vector(t: Tables) -> DataFrame:
    """Size, counts by role, and the names of the features that an article has."""
    a = t.lineitem.groupBy("l_orderkey").agg(*(F.expr(v).alias(k) for k, v in LINE_AGGREGATES.items()), F.array_sort(F.collect_list("l_returnflag")).alias("flags"))
    roles = F.transform(F.array_distinct("flags"), lambda f: F.concat(f, F.lit(":"), F.size(F.filter("flags", lambda x: x == f)).cast("string")))
    return a.select("l_orderkey", "units", "bytes", F.array_join(roles, ",").alias("roles"), F.concat_ws(",", *(F.when(F.expr(v), F.lit(k)) for k, v in sorted(FEATURES.items()))).alias("features"))


def self_hashed(payload: Column, name: str = "sha256") -> Column:
    """The struct with the hash of its JSON, taken without that field, as a field of it."""
    return payload.withField(name, F.sha2(F.to_json(payload, {"ignoreNullFields": "false"}), 256))


@query("g38_self_hash", """SELECT s_suppkey, SHA256('{"name":"' || s_name || '","nation":' || s_nationkey || '}') AS sha256 FROM supplier""")
def self_hash(t: Tables) -> DataFrame:
    payload = F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return t.supplier.select("s_suppkey", self_hashed(payload)["sha256"].alias("sha256"))


@query("g39_subset_hash_dedupe", "SELECT SHA256(p_brand || '|' || p_type || '|' || p_size) AS identity, MIN(p_partkey) AS kept, COUNT(*) AS n FROM part GROUP BY 1")
def subset_hash(t: Tables) -> DataFrame:
    return t.part.groupBy(F.sha2(F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string")), 256).alias("identity")).agg(F.min("p_partkey").alias("kept"), F.count("*").alias("n"))


@query("g40_activity_histogram", "SELECT event_type, CAST(FLOOR(value / 10) AS BIGINT) AS bucket, COUNT(*) AS n FROM events GROUP BY 1, 2 HAVING COUNT(*) > 1")
def activity_histogram(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.floor(F.col("value") / 10).cast("long").alias("bucket")).agg(F.count("*").alias("n")).where("n > 1")
