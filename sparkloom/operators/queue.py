"""Leased work queue, state machines and event windows, as plans over event tables."""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from sparkloom.operators.aggregates import rounded_rank
from sparkloom.operators.packing import halves
from sparkloom.operators.projections import ELAPSED, seconds_since_first
from sparkloom.operators.windows import places
from sparkloom.registry import Tables, query


def claim_plan(batches: DataFrame, workers: int, day: str, *order: str, by: str) -> DataFrame:
    """``worker`` and ``turn`` of each ready batch: the queue dealt out in order, by day first. Spark has no row locks."""
    placed = places(batches, {day: F.col(day)}, *order, by=by)
    place = F.col("place") - 1
    return placed.withColumn("worker", (place % workers).cast("long")).withColumn("turn", F.floor(place / workers).cast("long")).drop("place")


@query("q01_claim_plan", "SELECT o_orderkey, (rn - 1) % 4 AS worker, (rn - 1) // 4 AS turn FROM (SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'O')")
def claims(t: Tables) -> DataFrame:
    return claim_plan(t.orders.where("o_orderstatus = 'O'"), 4, "o_orderdate", "o_orderkey", by="o_orderpriority").select("o_orderkey", "worker", "turn")


@query("q02_lease_expiry", "WITH l AS (SELECT user_id, event_id, epoch_us(ts) AS t0, LEAD(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS next_at FROM events) SELECT event_id, next_at IS NULL OR next_at - t0 > 30 * 60 * 1000000 AS expired FROM l")
def lease_expiry(t: Tables) -> DataFrame:
    """A lease that isn't renewed within 30 minutes expires."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    l = t.events.withColumn("at", at).withColumn("next_at", F.lead("at").over(Window.partitionBy("user_id").orderBy("at", "event_id")))  # noqa: E741
    return l.select("event_id", (F.col("next_at").isNull() | (F.col("next_at") - F.col("at") > 30 * 60 * 1_000_000)).alias("expired"))


LEGAL = {"ready": ("leased",), "leased": ("validated", "retryable"), "retryable": ("ready", "blocked"), "validated": ("complete",)}


STATES = {"view": "ready", "click": "leased", "signup": "validated", "purchase": "complete", "error": "retryable"}


def illegal_moves(events: DataFrame, key: str, order: str, state: str, legal: dict[str, tuple[str, ...]] = LEGAL) -> DataFrame:
    """Events whose state may not follow the one before."""
    allowed = F.create_map(*(x for a, bs in legal.items() for x in (F.lit(a), F.array(*map(F.lit, bs)))))
    s = events.withColumn("before", F.lag(state).over(Window.partitionBy(key).orderBy(order)))
    return s.where(F.col("before").isNotNull() & ~F.coalesce(F.array_contains(F.try_element_at(allowed, F.col("before")), F.col(state)), F.lit(False)))


@query(
    "q03_state_machine",
    f"WITH s AS (SELECT user_id, event_id, CASE event_type {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in STATES.items())} END AS state FROM events), b AS (SELECT *, LAG(state) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM s) "
    f"SELECT user_id, ARG_MAX(state, event_id) AS state, CAST(COUNT(*) FILTER (before IS NOT NULL AND NOT ({' OR '.join(f'(before = {chr(39)}{a}{chr(39)} AND state = {chr(39)}{b}{chr(39)})' for a, bs in LEGAL.items() for b in bs)})) AS BIGINT) AS illegal, CAST(COUNT(*) FILTER (before = state) AS BIGINT) AS repeated FROM b GROUP BY 1",
)
def state_machine(t: Tables) -> DataFrame:
    """The state of each batch after all its events, and how many of these the machine doesn't allow."""
    states = F.create_map(*(F.lit(x) for pair in STATES.items() for x in pair))
    s = t.events.select("user_id", "event_id", states[F.col("event_type")].alias("state"))
    last = s.withColumn("before", F.lag("state").over(Window.partitionBy("user_id").orderBy("event_id"))).groupBy("user_id").agg(F.max_by("state", "event_id").alias("state"), F.count_if(F.col("before") == F.col("state")).alias("repeated"))
    bad = illegal_moves(s, "user_id", "event_id", "state").groupBy("user_id").agg(F.count("*").alias("illegal"))
    return last.join(bad, "user_id", "left").na.fill(0, ["illegal"]).select("user_id", "state", "illegal", "repeated")


@query("q04_retry_then_split", "WITH r AS (SELECT l_orderkey, COUNT(*) AS tries, LIST(l_partkey ORDER BY l_linenumber, l_partkey) AS x FROM lineitem GROUP BY 1) SELECT l_orderkey, CASE WHEN tries <= 3 THEN 'retry' WHEN LEN(x) > 1 THEN 'split' ELSE 'blocked' END AS outcome, CASE WHEN tries > 3 THEN CAST(LEN(x) // 2 AS BIGINT) END AS first_half FROM r")
def retry_then_split(t: Tables) -> DataFrame:
    r = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("tries"), F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda s: s["l_partkey"]).alias("x"))
    h = halves(F.col("x"))
    return r.select("l_orderkey", F.when(F.col("tries") <= 3, "retry").when(F.size("x") > 1, "split").otherwise("blocked").alias("outcome"), F.when(F.col("tries") > 3, F.size(h[0]).cast("long")).alias("first_half"))


def dispatch(durations: Iterable[tuple[float, float]], *, workers: int, ramp: float, drain: float, stop: float) -> list[tuple[float | None, float | None, str]]:
    """(launch, end, outcome) of calls (ready, seconds) in order, ``workers`` at once.

    The first calls start ``ramp`` seconds apart; none starts from ``drain`` on,
    and what still runs at ``stop`` is interrupted, after which none starts either.
    """
    drain = min(drain, stop)
    free: list[float] = []  # when busy workers are free again
    out, opened, now = [], 0, 0.0
    for ready, seconds in durations:
        if opened < workers and (not free or free[0] > max(now, ready, opened * ramp)):
            at = max(now, ready, opened * ramp)
            opened += 1
        elif free:
            at = max(now, ready, heapq.heappop(free))
        else:
            at = max(now, ready)
        now = at
        if at >= drain:
            out.append((None, None, "not_launched"))
            heapq.heappush(free, at)
            continue
        end = min(at + seconds, stop)
        heapq.heappush(free, end)
        out.append((at, end, "interrupted" if at + seconds > stop else "completed"))
    return out


@query("q05_dispatch_plan")
def dispatch_plan(t: Tables) -> DataFrame:
    """Calls of each user, three at once: no SQL, as each launch depends on all before it; a plain simulation says the same (in the tests)."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("event_id")
        got = dispatch([(0.0, v) for v in group["value"].to_pylist()], workers=3, ramp=2.0, drain=60.0, stop=75.0)
        return pa.table({"event_id": group["event_id"], "launch": pa.array([x[0] for x in got], pa.float64()), "ended": pa.array([x[1] for x in got], pa.float64()), "outcome": pa.array([x[2] for x in got])})

    return t.events.where("value IS NOT NULL").select("user_id", "event_id", "value").groupBy("user_id").applyInArrow(run, "event_id long, launch double, ended double, outcome string")


def error_category(message: Column) -> Column:
    """What kind of error a message is: only a transient one is worth another try."""
    m = F.lower(message)
    has = lambda *xs: reduce(or_, (F.contains(m, F.lit(x)) for x in xs))
    return F.when(has("constraint"), "constraint").when(has("locked", "busy"), "transient").when(has("closed", "unable to open"), "connection_loss").otherwise("permanent")


def retry_delay(attempt: Column, jitter: Column, *, base: int = 200, most: int = 2000) -> Column:
    """Milliseconds before the next try: doubled each time up to ``most``, and up to a quarter more; ``jitter`` is 0 to 1."""
    delay = F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(float(most)))
    return delay + jitter * delay / 4


ERRORS_SAID = ("database is locked", "UNIQUE constraint failed", "Busy, try again", "connection closed", "syntax error", "unable to open file")


@query(
    "q12_retry_schedule",
    f"WITH e AS (SELECT event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS attempt, CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 'transient' WHEN 1 THEN 'constraint' WHEN 2 THEN 'transient' WHEN 3 THEN 'connection_loss' WHEN 4 THEN 'permanent' ELSE 'connection_loss' END AS category FROM events WHERE event_type = 'error') "
    "SELECT event_id, attempt, category, CASE WHEN category = 'transient' AND attempt + 1 < 6 THEN ROUND(LEAST(200 * POW(2, attempt), 2000) * (1 + (event_id * 7919 % 1000) / 4000.0), 6) END AS delay FROM e",
)
def retry_schedule(t: Tables) -> DataFrame:
    """The errors of each user as tries of one operation, six at most; jitter comes from the id, so that a rerun gives the same schedule."""
    message = F.element_at(F.array(*map(F.lit, ERRORS_SAID)), (F.col("event_id") % 6 + 1).cast("int"))
    e = t.events.where("event_type = 'error'").withColumn("attempt", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long") - 1).withColumn("category", error_category(message))
    delay = retry_delay(F.col("attempt"), (F.col("event_id") * 7919 % 1000) / 1000.0)
    return e.select("event_id", "attempt", "category", F.when((F.col("category") == "transient") & (F.col("attempt") + 1 < 6), F.round(delay, 6)).alias("delay"))


@query("q06_phase_windows", f"{ELAPSED}, p AS (SELECT 'measurement' AS phase, 0 AS a, 864000 AS b UNION ALL SELECT 'drain', 864000, 1728000 UNION ALL SELECT 'shutdown', 1728000, 999999999) SELECT phase, COUNT(*) AS n, COUNT(DISTINCT user_id) AS users FROM e JOIN p ON elapsed > a AND elapsed <= b GROUP BY 1")
def phase_windows(t: Tables) -> DataFrame:
    """A range join with three phases, small enough to send to every task."""
    p = t.spark.createDataFrame([("measurement", 0, 864_000), ("drain", 864_000, 1_728_000), ("shutdown", 1_728_000, 999_999_999)], "phase string, a long, b long")
    e = seconds_since_first(t.events)
    return e.join(F.broadcast(p), (F.col("elapsed") > F.col("a")) & (F.col("elapsed") <= F.col("b"))).groupBy("phase").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("q07_exactly_one_phase", "SELECT event_type, COUNT(*) = 1 AS exactly_one FROM events GROUP BY 1")
def exactly_one(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg((F.count("*") == 1).alias("exactly_one"))


def in_flight(spans: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, most): how many spans are open at once, at most; one that ends when another begins is closed before."""
    moves = spans.select(key, F.col(start).alias("at"), F.lit(1).alias("d")).unionByName(spans.select(key, F.col(end).alias("at"), F.lit(-1).alias("d")))
    running = F.sum("d").over(Window.partitionBy(key).orderBy("at", "d").rowsBetween(Window.unboundedPreceding, 0))
    return moves.withColumn("n", running).groupBy(key).agg(F.max("n").alias("most"))


@query("q08_in_flight_maximum", "WITH m AS (SELECT user_id, event_id AS t0, 1 AS d FROM events UNION ALL SELECT user_id, event_id + 300 + CAST(FLOOR(value) AS BIGINT) % 400, -1 FROM events), r AS (SELECT user_id, SUM(d) OVER (PARTITION BY user_id ORDER BY t0, d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM m) SELECT user_id, CAST(MAX(n) AS BIGINT) AS most FROM r GROUP BY 1")
def most_in_flight(t: Tables) -> DataFrame:
    """Every event is a span that begins at its id and lasts as long as its value says."""
    spans = t.events.select("user_id", F.col("event_id").alias("a"), (F.col("event_id") + 300 + F.floor("value").cast("long") % 400).alias("b"))
    return in_flight(spans, "user_id", "a", "b")


@query("q09_idempotent_replay", "WITH r AS (SELECT user_id, event_type, props, MIN(event_id) AS event_id, COUNT(*) AS n FROM events GROUP BY 1, 2, 3) SELECT event_id, n - 1 AS replays, COUNT(*) OVER (PARTITION BY user_id, event_type) > 1 AS conflict FROM r")
def replay(t: Tables) -> DataFrame:
    """Equal requests are no-ops; one id with two contents is a conflict."""
    r = t.events.groupBy("user_id", "event_type", "props").agg(F.min("event_id").alias("event_id"), (F.count("*") - 1).alias("replays"))
    return r.withColumn("conflict", F.count("*").over(Window.partitionBy("user_id", "event_type")) > 1).select("event_id", "replays", "conflict")


@query("q10_window_classification", f"{ELAPSED}, w AS (SELECT CAST(FLOOR(elapsed / 432000) AS BIGINT) AS window_id, COUNT(*) AS n, CAST(COUNT(*) FILTER (event_type = 'purchase') AS BIGINT) AS done FROM e GROUP BY 1) SELECT window_id, CASE WHEN done = 0 THEN 'dry_run' WHEN done * 20 < n THEN 'incomplete' ELSE 'complete' END AS kind FROM w")
def window_classes(t: Tables) -> DataFrame:
    w = seconds_since_first(t.events).groupBy(F.floor(F.col("elapsed") / 432_000).cast("long").alias("window_id")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("done"))
    return w.select("window_id", F.expr("case when done = 0 then 'dry_run' when done * 20 < n then 'incomplete' else 'complete' end").alias("kind"))


@query("q11_outcome_by_substring", "SELECT doc_id, CASE WHEN LOWER(text) LIKE '%rate%' THEN 'rate_limit' WHEN LOWER(text) LIKE '%time%' THEN 'timeout' WHEN LOWER(text) LIKE '%valid%' THEN 'validation' ELSE 'transport' END AS outcome FROM documents")
def outcome(t: Tables) -> DataFrame:
    x = F.lower("text")
    return t.documents.select("doc_id", F.when(x.contains("rate"), "rate_limit").when(x.contains("time"), "timeout").when(x.contains("valid"), "validation").otherwise("transport").alias("outcome"))


@query("q13_deadline_decision", f"{ELAPSED} SELECT event_id, CASE WHEN elapsed > 1728000 THEN 'interrupt' WHEN elapsed > 864000 THEN 'drain' ELSE 'none' END AS decision FROM e")
def deadline(t: Tables) -> DataFrame:
    return seconds_since_first(t.events).select("event_id", F.when(F.col("elapsed") > 1_728_000, "interrupt").when(F.col("elapsed") > 864_000, "drain").otherwise("none").alias("decision"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A frame that counts its rows and their bytes on the way, in the job that writes it; the observation has them then."""
    seen = Observation(name)
    size = F.sum(F.length(F.to_json(F.struct(*df.columns))))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), size.alias("bytes")), seen


@query("q14_phase_metrics", "WITH r AS (SELECT event_type, value, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, COUNT(*) OVER (PARTITION BY event_type) AS n FROM events), a AS (SELECT event_type, COUNT(*) AS n, MAX(value) AS peak, (MAX(epoch_us(ts)) - MIN(epoch_us(ts))) / 1000000.0 AS wall_seconds, ROUND(SUM(value) / 1000, 6) AS busy_seconds FROM events GROUP BY 1) SELECT a.*, p50, p95 FROM a JOIN (SELECT event_type, MAX(value) FILTER (i = ROUND_EVEN((n - 1) * 0.5, 0)) AS p50, MAX(value) FILTER (i = ROUND_EVEN((n - 1) * 0.95, 0)) AS p95 FROM r GROUP BY 1) USING (event_type)")
def phase_metrics(t: Tables) -> DataFrame:
    """Rows, wall and busy time, peak and percentiles of each phase."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    a = t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("peak"), ((F.max(at) - F.min(at)) / 1_000_000.0).alias("wall_seconds"), F.round(F.sum("value") / 1000, 6).alias("busy_seconds"))
    return a.join(rounded_rank(t.events, "event_type", "value", {"p50": 0.5, "p95": 0.95}), "event_type")
