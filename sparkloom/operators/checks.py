"""Integrity and quality checks: each returns counts, and zero means that it passed."""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions import patterns
from sparkloom.operators.aggregates import LIMB_SQL, TOKENS, fingerprint_sql, frequency_lists, multiset_digest, ordered_fingerprint
from sparkloom.operators.joins import reconcile
from sparkloom.operators.nested import nodes
from sparkloom.operators.windows import running_offset
from sparkloom.registry import Tables, query


def one_row(*frames: DataFrame) -> DataFrame:
    """Frames of one row each, side by side: they are laid below one another, and each column has one value."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.agg(*(F.max(c).alias(c) for c in out.columns))


@query("c01_selection_gate", "WITH p AS (SELECT c_custkey, COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) SELECT COUNT(*) AS notes, CAST(COUNT(*) FILTER (n = 1) AS BIGINT) AS resolved, CAST(COUNT(*) FILTER (n = 0) AS BIGINT) AS unresolved, CAST(COUNT(*) FILTER (n > 1) AS BIGINT) AS ambiguous FROM p")
def selection_gate(t: Tables) -> DataFrame:
    p = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(F.countDistinct(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("n"))
    return p.agg(F.count("*").alias("notes"), F.count_if(F.expr("n = 1")).alias("resolved"), F.count_if(F.expr("n = 0")).alias("unresolved"), F.count_if(F.expr("n > 1")).alias("ambiguous"))


@query("c02_scope_report", "SELECT COUNT(*) AS articles, COUNT(DISTINCT o_custkey) AS headwords, CAST(COUNT(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS selected FROM orders")
def scope_report(t: Tables) -> DataFrame:
    return t.orders.agg(F.count("*").alias("articles"), F.countDistinct("o_custkey").alias("headwords"), F.count_if(F.col("o_orderstatus") == "F").alias("selected"))


@query("c03_progress_report", "SELECT o_orderstatus AS run, CAST(COUNT(*) FILTER (l_returnflag = 'A') AS BIGINT) AS accepted, CAST(COUNT(*) FILTER (l_returnflag = 'N') AS BIGINT) AS fresh, CAST(COUNT(*) FILTER (l_returnflag = 'R') AS BIGINT) AS rejected FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def progress_report(t: Tables) -> DataFrame:
    j = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    wide = j.groupBy(F.col("o_orderstatus").alias("run")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.count(F.lit(1))).na.fill(0)
    return wide.withColumnsRenamed({"A": "accepted", "N": "fresh", "R": "rejected"})


@query("c04_release_validation", "WITH u AS (SELECT o_orderkey, COUNT(l_orderkey) AS n, CAST(COUNT(*) FILTER (l_linestatus = 'F') AS BIGINT) AS f FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) SELECT CAST(SUM(n) AS BIGINT) AS units, CAST(SUM(f) AS BIGINT) AS accepted, CAST(COUNT(*) FILTER (n <> f) AS BIGINT) AS blocking, CAST(COUNT(*) FILTER (n = 0) AS BIGINT) AS empty_articles, COUNT(*) FILTER (n <> f) = 0 AS release_ready FROM u")
def release_validation(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("f"))
    u = t.orders.join(per, F.col("l_orderkey") == F.col("o_orderkey"), "left").na.fill(0, ["n", "f"])
    return u.agg(F.sum("n").alias("units"), F.sum("f").alias("accepted"), F.count_if(F.expr("n <> f")).alias("blocking"), F.count_if(F.expr("n = 0")).alias("empty_articles")).withColumn("release_ready", F.expr("blocking = 0"))


ENTRIES = "entries AS (SELECT p_partkey AS entry, STRING_SPLIT(p_name, ' ')[1] AS expression, STRING_SPLIT(p_name, ' ')[-1] AS reading FROM part), lists AS (SELECT p_brand AS source, word AS term, MIN(p_partkey) AS rank FROM (SELECT p_brand, p_partkey, UNNEST(STRING_SPLIT(p_name, ' ')) AS word FROM part) GROUP BY 1, 2), hits AS (SELECT source, term, entry, MIN(kind) AS kind FROM (SELECT source, term, entry, 'expression' AS kind FROM lists JOIN entries ON expression = term UNION ALL SELECT source, term, entry, 'reading' FROM lists JOIN entries ON reading = term) GROUP BY 1, 2, 3), members AS (SELECT DISTINCT l_partkey AS entry FROM lineitem WHERE l_returnflag = 'R')"


def scope(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ranked term lists by source, their matches with precedence, and the run's members."""
    words = F.split("p_name", " ")
    entries = t.part.select(F.col("p_partkey").alias("entry"), words[0].alias("expression"), F.element_at(words, -1).alias("reading"))
    lists = t.part.select(F.col("p_brand").alias("source"), "p_partkey", F.explode(words).alias("term")).groupBy("source", "term").agg(F.min("p_partkey").alias("rank"))
    both = [lists.join(entries, F.col(k) == F.col("term")).select("source", "term", "entry", F.lit(k).alias("kind")) for k in ("expression", "reading")]
    hits = both[0].unionByName(both[1]).groupBy("source", "term", "entry").agg(F.min("kind").alias("kind"))
    members = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("entry")).distinct()
    return lists, hits, members


@query("c05_any_coverage", f"WITH {ENTRIES} SELECT source, COUNT(*) AS terms, CAST(COUNT(*) FILTER (EXISTS (SELECT 1 FROM hits h JOIN members m ON m.entry = h.entry WHERE h.source = l.source AND h.term = l.term)) AS BIGINT) AS covered FROM lists l GROUP BY 1")
def any_coverage(t: Tables) -> DataFrame:
    """A term is covered if any of its entries is in the run."""
    lists, hits, members = scope(t)
    covered = hits.join(members, "entry", "left_semi").select("source", "term").distinct().withColumn("hit", F.lit(1))
    return lists.join(covered, ["source", "term"], "left").groupBy("source").agg(F.count("*").alias("terms"), F.count("hit").alias("covered"))


@query("c06_combined_coverage", f"WITH {ENTRIES} SELECT source, COUNT(*) AS terms, CAST(COUNT(*) FILTER (EXISTS (SELECT 1 FROM hits h WHERE h.source = l.source AND h.term = l.term)) AS BIGINT) AS matched, CAST(COUNT(*) FILTER (EXISTS (SELECT 1 FROM hits h WHERE h.source = l.source AND h.term = l.term) AND NOT EXISTS (SELECT 1 FROM hits h WHERE h.source = l.source AND h.term = l.term AND NOT EXISTS (SELECT 1 FROM members m WHERE m.entry = h.entry))) AS BIGINT) AS covered, MIN(rank) AS best_rank FROM lists l GROUP BY 1")
def combined_coverage(t: Tables) -> DataFrame:
    """A term is covered if it has entries and all of them are in the run."""
    lists, hits, members = scope(t)
    state = hits.join(members.withColumn("m", F.lit(True)), "entry", "left").groupBy("source", "term").agg(F.every(F.coalesce("m", F.lit(False))).alias("whole"))
    j = lists.join(state, ["source", "term"], "left")
    return j.groupBy("source").agg(F.count("*").alias("terms"), F.count("whole").alias("matched"), F.count_if("whole").alias("covered"), F.min("rank").alias("best_rank"))


@query("c07_headword_progress", "WITH inc AS (SELECT DISTINCT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linestatus <> 'F' UNION SELECT o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) SELECT (SELECT COUNT(DISTINCT o_custkey) FROM orders) AS total, (SELECT COUNT(*) FROM inc) AS incomplete, (SELECT COUNT(DISTINCT o_custkey) FROM orders) - (SELECT COUNT(*) FROM inc) AS complete")
def headword_progress(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(F.every(F.col("l_linestatus") == "F").alias("done"))
    heads = t.orders.join(per, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy("o_custkey").agg(F.every(F.coalesce("done", F.lit(False))).alias("done"))
    return heads.agg(F.count("*").alias("total"), F.count_if(F.expr("not done")).alias("incomplete"), F.count_if("done").alias("complete"))


@query("c08_workload_progress", "SELECT COUNT(DISTINCT o_custkey) AS headwords, COUNT(DISTINCT o_orderkey) AS articles, COUNT(*) AS units, CAST(SUM(l_quantity) AS BIGINT) AS characters, CAST(COUNT(*) FILTER (l_linestatus = 'F' OR o_orderstatus = 'P') AS BIGINT) AS complete FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def workload_progress(t: Tables) -> DataFrame:
    j = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.agg(F.countDistinct("o_custkey").alias("headwords"), F.countDistinct("o_orderkey").alias("articles"), F.count("*").alias("units"), F.sum("l_quantity").cast("long").alias("characters"), F.count_if(F.expr("l_linestatus = 'F' or o_orderstatus = 'P'")).alias("complete"))


@query("c09_source_identity", "WITH a AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A') SELECT (SELECT COUNT(*) FROM a) AS baseline, (SELECT COUNT(*) FROM b) AS candidate, (SELECT COUNT(*) FROM (FROM a EXCEPT FROM b)) AS missing, (SELECT COUNT(*) FROM (FROM b EXCEPT FROM a)) AS extra")
def source_identity(t: Tables) -> DataFrame:
    a, b = t.lineitem.where("l_returnflag = 'R'"), t.lineitem.where("l_returnflag = 'A'")
    return one_row(a.agg(F.count("*").alias("baseline")), b.agg(F.count("*").alias("candidate")), reconcile(a, b, ["l_partkey", "l_suppkey"]).drop("passed"))


HISTORY = (("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name"), ("supplier", "s_suppkey", "s_name"), ("customer", "c_custkey", "c_name"), ("part", "p_partkey", "p_name"), ("orders", "o_orderkey", "o_orderstatus"), ("events", "event_id", "event_type"), ("documents", "doc_id", "source"), ("pages", "page_id", "url"))


@query("c10_history_fingerprint", " UNION ALL ".join(f"SELECT '{name}' AS table_name, digest FROM ({fingerprint_sql(name, key, f'{key} || chr(58) || {label}')})" for name, key, label in HISTORY))
def history_fingerprint(t: Tables) -> DataFrame:
    out = None
    for name, key, label in HISTORY:
        one = ordered_fingerprint(getattr(t, name), key, F.concat(F.col(key).cast("string"), F.lit(":"), label)).select(F.lit(name).alias("table_name"), "digest")
        out = one if out is None else out.unionByName(one)
    return out


#: What must be zero before a run may start; the other counters of a preflight must not be.
BLOCKING = ("unbatched_ready_units", "claimed_attempts", "unresolved_errors", "source_identity_gaps", "source_acceptance_gaps", "source_unfinished_batches")
SAME_UNIT = ("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")


@query(
    "c11_source_preflight",
    "WITH c AS (SELECT (SELECT COUNT(*) FROM customer) AS articles, (SELECT COUNT(*) FROM orders) AS units, (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'O') AS ready_units, (SELECT COUNT(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'O') AS ready_batches, "
    "(SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS unbatched_ready_units, (SELECT COUNT(*) FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity = 50) AS claimed_attempts, "
    "(SELECT COUNT(*) FROM events WHERE event_type = 'error' AND CAST(props->>'k' AS BIGINT) = 0) AS unresolved_errors, (SELECT COUNT(*) FROM lineitem a WHERE a.l_linenumber = 1 AND NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_linenumber <> 1 AND " + " AND ".join(f"b.{k} = a.{k}" for k in SAME_UNIT) + ")) AS source_identity_gaps, "
    "(SELECT COUNT(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')) AS source_acceptance_gaps, (SELECT COUNT(*) FROM orders WHERE o_orderstatus IN ('O', 'P')) AS source_unfinished_batches, (SELECT COUNT(*) FROM pages WHERE html <> '') AS verified_exports) "
    f"SELECT *, CONCAT_WS(',', {', '.join(f'CASE WHEN {b} > 0 THEN {chr(39)}{b}{chr(39)} END' for b in BLOCKING)}) AS blocked_by FROM c",
)
def source_preflight(t: Tables) -> DataFrame:
    """Eleven counters of one row, and which of them block."""
    def orphans(a: DataFrame, b: DataFrame, on: list[str], name: str) -> DataFrame:
        return a.join(b.select(*on), on, "left_anti").agg(F.count("*").alias(name))

    of_order = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    ready = F.col("o_orderstatus") == "O"
    row = one_row(
        t.customer.agg(F.count("*").alias("articles")),
        t.orders.agg(F.count("*").alias("units"), F.count_if(ready).alias("ready_units"), F.countDistinct(F.when(ready, F.col("o_custkey"))).alias("ready_batches")),
        orphans(t.orders.where(ready), of_order, ["o_orderkey"], "unbatched_ready_units"),
        t.lineitem.agg(F.count_if(F.expr("l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity = 50")).alias("claimed_attempts")),
        t.events.agg(F.count_if((F.col("event_type") == "error") & (F.get_json_object("props", "$.k").cast("long") == 0)).alias("unresolved_errors")),
        orphans(t.lineitem.where("l_linenumber = 1"), t.lineitem.where("l_linenumber <> 1"), list(SAME_UNIT), "source_identity_gaps"),
        orphans(t.orders, of_order.where("l_linestatus = 'F'"), ["o_orderkey"], "source_acceptance_gaps"),
        t.orders.agg(F.count_if(F.col("o_orderstatus").isin("O", "P")).alias("source_unfinished_batches")),
        t.pages.agg(F.count_if(F.col("html") != "").alias("verified_exports")),
    )
    return row.withColumn("blocked_by", F.concat_ws(",", *(F.when(F.col(b) > 0, F.lit(b)) for b in BLOCKING)))


@query("c12_migration_safety", "SELECT CAST(COUNT(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS leased, CAST(COUNT(*) FILTER (o_totalprice < 0) AS BIGINT) AS negative, CAST(COUNT(*) FILTER (o_orderdate IS NULL) AS BIGINT) AS undated FROM orders")
def migration_safety(t: Tables) -> DataFrame:
    return t.orders.agg(F.count_if(F.expr("o_orderstatus = 'P'")).alias("leased"), F.count_if(F.expr("o_totalprice < 0")).alias("negative"), F.count_if(F.expr("o_orderdate IS NULL")).alias("undated"))


@query(
    "c13_benchmark_postflight",
    "SELECT (SELECT COUNT(*) FROM lineitem WHERE l_linestatus = 'O' AND l_quantity >= 49) AS claimed_attempts, (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P') AS leased_batches, (SELECT COUNT(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS missing_units, "
    "(SELECT COUNT(*) FROM (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1)) AS duplicate_translations, (SELECT COUNT(*) FROM events WHERE event_type = 'error') AS blocking_errors, (SELECT COUNT(*) FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 1) AS source_hash_mismatches",
)
def benchmark_postflight(t: Tables) -> DataFrame:
    """Six counters that must all be zero; the last compares the hashes in nested manifests with those of the units."""
    said = F.when(F.col("o_orderkey") % 97 == 0, F.lit("other")).otherwise(F.sha2("o_orderpriority", 256))
    unit = F.struct(F.when(F.col("o_orderkey") % 89 == 1, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("unit_id"), said.alias("source_sha256"))
    manifests = t.orders.groupBy("o_custkey").agg(F.to_json(F.struct(F.array(F.struct(F.collect_list(unit).alias("units"))).alias("articles"))).alias("manifest"))
    listed = manifests.select(F.explode(F.from_json("manifest", "articles array<struct<units:array<struct<unit_id:long,source_sha256:string>>>>")["articles"]).alias("a")).select(F.explode("a.units").alias("u")).select("u.*")
    expected = t.orders.select(F.col("o_orderkey").alias("unit_id"), F.sha2("o_orderpriority", 256).alias("own"))
    return one_row(
        t.lineitem.agg(F.count_if(F.expr("l_linestatus = 'O' AND l_quantity >= 49")).alias("claimed_attempts")),
        t.orders.agg(F.count_if(F.col("o_orderstatus") == "P").alias("leased_batches")),
        t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(F.count("*").alias("missing_units")),
        t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("duplicate_translations")),
        t.events.agg(F.count_if(F.col("event_type") == "error").alias("blocking_errors")),
        listed.join(expected, "unit_id", "left").agg(F.count_if(~F.col("own").eqNullSafe(F.col("source_sha256"))).alias("source_hash_mismatches")),
    )


@query("c14_window_postflight", "SELECT o_orderstatus, COUNT(*) AS n, CAST(COUNT(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS BIGINT) AS without_units FROM orders GROUP BY 1 HAVING COUNT(*) <> 1")
def window_postflight(t: Tables) -> DataFrame:
    has = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("h", F.lit(1))
    return t.orders.join(has, "o_orderkey", "left").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_if(F.expr("h is null")).alias("without_units")).where("n <> 1")


@query("c15_batch_verification", "WITH b AS (SELECT o_custkey, COUNT(*) AS articles, SUM(q) AS bytes FROM orders JOIN (SELECT l_orderkey, SUM(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1) SELECT COUNT(*) AS batches, CAST(COUNT(*) FILTER (articles > 12) AS BIGINT) AS soft, CAST(COUNT(*) FILTER (bytes > 2000) AS BIGINT) AS hard, (SELECT COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM b)) AS missing FROM b")
def batch_verification(t: Tables) -> DataFrame:
    q = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    b = t.orders.join(q, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.count("*").alias("articles"), F.sum("q").alias("bytes"))
    missing = t.customer.join(b, F.col("c_custkey") == F.col("o_custkey"), "left_anti").agg(F.count("*").alias("missing"))
    return one_row(b.agg(F.count("*").alias("batches"), F.count_if(F.expr("articles > 12")).alias("soft"), F.count_if(F.expr("bytes > 2000")).alias("hard")), missing)


@query("c16_table_parity", f"WITH r AS (SELECT SHA256(c_custkey || ',' || c_name || ',' || c_nationkey) AS h FROM customer), d AS (SELECT COUNT(*) AS n, {', '.join(f'CAST(SUM({x}) AS BIGINT) AS sum{k}' for k, x in enumerate(LIMB_SQL))} FROM r) SELECT n, sum0, sum7, TRUE AS equal FROM d")
def table_parity(t: Tables) -> DataFrame:
    """The same table in another order has the same digest."""
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"))
    one, two = multiset_digest(t.customer, line), multiset_digest(t.customer.repartition(7, "c_mktsegment"), line)
    cols = one.columns
    other = two.toDF(*(f"_{c}" for c in cols))
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return one.crossJoin(F.broadcast(other)).select("n", "sum0", "sum7", same.alias("equal"))


@query("c17_manifest_consistency", "SELECT (SELECT COUNT(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(DISTINCT o_custkey) > 1)) AS shared_articles, (SELECT COUNT(*) FROM orders) AS listed, (SELECT CAST(SUM(n) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_custkey)) AS total")
def manifest_consistency(t: Tables) -> DataFrame:
    heads = t.orders.groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("articles"))
    shared = heads.select("o_custkey", F.explode("articles").alias("a")).groupBy("a").agg(F.countDistinct("o_custkey").alias("n")).where("n > 1")
    return one_row(shared.agg(F.count("*").alias("shared_articles")), t.orders.agg(F.count("*").alias("listed")), heads.agg(F.sum(F.size("articles")).alias("total")))


@query("c18_result_contract", "SELECT CAST(COUNT(*) FILTER (l_discount > 1) AS BIGINT) AS cached_over_input, CAST(COUNT(*) FILTER (l_quantity < 0 OR l_extendedprice < 0) AS BIGINT) AS negative, CAST(COUNT(*) FILTER (l_tax > l_quantity) AS BIGINT) AS part_over_whole FROM lineitem")
def result_contract(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count_if(F.expr("l_discount > 1")).alias("cached_over_input"), F.count_if(F.expr("l_quantity < 0 or l_extendedprice < 0")).alias("negative"), F.count_if(F.expr("l_tax > l_quantity")).alias("part_over_whole"))


@query(
    "c19_archive_verification",
    "WITH a AS (SELECT p_type, COUNT(*) AS articles, CAST(COUNT(*) FILTER (p_partkey % 35 = 0) AS BIGINT) AS missing_media, CAST(COUNT(*) FILTER (p_size % 10 = 7) AS BIGINT) AS issues, CAST(COUNT(*) FILTER (p_partkey % 50 = 0) AS BIGINT) AS repeated_members FROM part GROUP BY 1) "
    "SELECT p_type, articles, articles - CASE WHEN STARTS_WITH(p_type, 'S') THEN 1 ELSE 0 END AS expected, repeated_members, missing_media, issues, NOT STARTS_WITH(p_type, 'S') AND repeated_members + missing_media + issues = 0 AS verified FROM a",
)
def archive_verification(t: Tables) -> DataFrame:
    """An archive for each type: as many articles as its run has, no member twice, every medium there, no issue in a visible text."""
    run = t.part.groupBy("p_type").agg((F.count("*") - F.when(F.col("p_type").startswith("S"), 1).otherwise(0)).alias("expected"))
    # members by name: an article each, some of them twice; media but some
    name = F.concat(F.lit("term_"), F.col("p_partkey").cast("string"))
    members = t.part.select("p_type", F.explode(F.when(F.col("p_partkey") % 50 == 0, F.array(name, name)).otherwise(F.array(name))).alias("name"))
    repeated = members.groupBy("p_type", "name").agg(F.count("*").alias("n")).groupBy("p_type").agg(F.sum(F.col("n") - 1).alias("repeated_members"))
    media = t.part.where("p_partkey % 5 = 0 AND p_partkey % 35 <> 0").select(F.concat(F.lit("media/"), F.col("p_partkey").cast("string"), F.lit(".avif")).alias("text"))
    n = nodes(t)
    wanted = n.where("field IN ('path', 'src')").join(t.part.select("p_partkey", "p_type"), "p_partkey")
    missing = wanted.join(media, "text", "left_anti").groupBy("p_type").agg(F.count("*").alias("missing_media"))
    seen = n.where("kind = 'string' AND field = 'title'").where(F.col("text").rlike("[0-9]*7$")).join(t.part.select("p_partkey", "p_type"), "p_partkey").groupBy("p_type").agg(F.count("*").alias("issues"))
    whole = t.part.groupBy("p_type").agg(F.count("*").alias("articles")).join(run, "p_type").join(repeated, "p_type", "left").join(missing, "p_type", "left").join(seen, "p_type", "left").na.fill(0)
    return whole.withColumn("verified", F.expr("articles = expected AND repeated_members + missing_media + issues = 0"))


def index_faults(index: DataFrame, by: str, key: str, start: str, size: str, data: DataFrame) -> DataFrame:
    """What is wrong with the index of each volume: keys out of order (ASCII letters folded), gaps or overlaps, an end that isn't the data's, empty articles."""
    w = Window.partitionBy(by).orderBy(start, key)
    folded = F.translate(F.col(key), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    i = index.withColumn("_before", F.lag(F.struct(folded, F.col(key))).over(w)).withColumn("_end", F.coalesce(F.lag(F.col(start) + F.col(size)).over(w), F.lit(0)))
    g = i.groupBy(by).agg(
        F.count("*").alias("entries"),
        F.count_if(F.col("_before") > F.struct(folded, F.col(key))).alias("unsorted"),
        F.count_if(F.col("_end") != F.col(start)).alias("not_contiguous"),
        F.count_if(F.col(size) <= 0).alias("empty"),
        F.max(F.col(start) + F.col(size)).alias("_last"),
    )
    return g.join(data, by).withColumn("end_matches", F.col("_last") == F.col("data_size")).select(by, "entries", "unsorted", "not_contiguous", "empty", "end_matches")


@query(
    "c20_index_verification",
    "WITH a AS (SELECT p_type, STRING_SPLIT(p_name, ' ')[1] AS word, SUM(STRLEN(p_name) + 1) AS size FROM part GROUP BY 1, 2), b AS (SELECT p_type, word, size, COALESCE(SUM(size) OVER (PARTITION BY p_type ORDER BY word ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM a), "
    "c AS (SELECT p_type, CASE WHEN p_type LIKE '%E' AND word = (SELECT MAX(word) FROM a x WHERE x.p_type = b.p_type) THEN 'aaa' ELSE word END AS word, CASE WHEN p_type LIKE '%L' AND start > 0 THEN start + 1 ELSE start END AS start, size FROM b), "
    "d AS (SELECT *, LAG(word) OVER w AS before, COALESCE(LAG(start + size) OVER w, 0) AS prev_end FROM c WINDOW w AS (PARTITION BY p_type ORDER BY start, word)) SELECT p_type, COUNT(*) AS entries, CAST(COUNT(*) FILTER (before > word) AS BIGINT) AS unsorted, CAST(COUNT(*) FILTER (prev_end <> start) AS BIGINT) AS not_contiguous, "
    "CAST(COUNT(*) FILTER (size <= 0) AS BIGINT) AS empty, MAX(start + size) = (SELECT SUM(STRLEN(p_name) + 1) FROM part x WHERE x.p_type = d.p_type) AS end_matches FROM d GROUP BY p_type",
)
def index_verification(t: Tables) -> DataFrame:
    """Volumes by type: of some the last key is out of place, of others all articles but the first lie a byte too far."""
    a = t.part.groupBy("p_type", F.split("p_name", " ")[0].alias("word")).agg(F.sum(F.octet_length("p_name") + 1).alias("size"))
    whole = a.withColumn("start", running_offset("size", "word", by="p_type")).withColumn("last", F.max("word").over(Window.partitionBy("p_type")))
    spoilt = whole.withColumn("word", F.when(F.col("p_type").endswith("E") & (F.col("word") == F.col("last")), "aaa").otherwise(F.col("word"))).withColumn("start", F.when(F.col("p_type").endswith("L") & (F.col("start") > 0), F.col("start") + 1).otherwise(F.col("start")))
    data = t.part.groupBy("p_type").agg(F.sum(F.octet_length("p_name") + 1).alias("data_size"))
    return index_faults(spoilt, "p_type", "word", "start", "size", data)


@query("c20_xml_verification", "SELECT p_type, COUNT(*) AS entries, CAST(SUM(1 + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS index_values, CAST(COUNT(*) FILTER (p_partkey % 41 = 0) AS BIGINT) AS malformed, CAST(COUNT(*) FILTER (p_partkey % 43 = 0 AND p_partkey % 41 <> 0) AS BIGINT) AS untitled FROM part GROUP BY 1")
def xml_verification(t: Tables) -> DataFrame:
    """Entries of an XML project: well formed, titled, and with how many index values."""
    key = F.col("p_partkey").cast("string")
    title = F.when(F.col("p_partkey") % 43 == 0, F.lit("")).otherwise(F.col("p_name"))
    values = F.when(F.col("p_partkey") % 3 == 0, F.lit('<index value="a"/><index value="b"/>')).otherwise(F.lit('<index value="a"/>'))
    xml = F.concat(F.lit('<entry id="'), key, F.lit('"><title>'), title, F.lit("</title>"), values, F.when(F.col("p_partkey") % 41 == 0, F.lit("</entr>")).otherwise(F.lit("</entry>")))
    read = F.from_xml(xml, "_id string, title string, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    e = t.part.select("p_type", read.alias("e"), F.regexp_count(xml, F.lit("<index ")).alias("values"))
    bad = F.col("e._corrupt_record").isNotNull()
    return e.groupBy("p_type").agg(F.count("*").alias("entries"), F.sum("values").cast("long").alias("index_values"), F.count_if(bad).alias("malformed"), F.count_if(~bad & (F.coalesce("e.title", F.lit("")) == "")).alias("untitled"))


@query("c20_sorted_index", "WITH o AS (SELECT c_name, LAG(c_name) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS before FROM customer) SELECT COUNT(*) AS entries, CAST(COUNT(*) FILTER (before > c_name) AS BIGINT) AS unsorted FROM o")
def sorted_index(t: Tables) -> DataFrame:
    o = t.customer.withColumn("before", F.lag("c_name").over(Window.partitionBy("c_nationkey").orderBy("c_custkey")))
    return o.agg(F.count("*").alias("entries"), F.count_if(F.expr("before > c_name")).alias("unsorted"))


def gate_files(files: DataFrame, lines: DataFrame) -> DataFrame:
    """(name, state) of files (name, sha256) against lines of a checksum list, ``digest  name``: ok, mismatch, missing, unlisted, malformed or listed twice."""
    parts = F.regexp_extract("line", "^([0-9a-f]{64})  (.+)$", 2), F.regexp_extract("line", "^([0-9a-f]{64})  (.+)$", 1)
    listed = lines.select("line", parts[0].alias("listed"), parts[1].alias("digest"))
    good = listed.where("listed <> ''").groupBy("listed").agg(F.count("*").alias("times"), F.min("digest").alias("digest"))
    met = files.join(good, F.col("name") == F.col("listed"), "full_outer")
    state = F.when(F.col("listed").isNull(), "unlisted").when(F.col("name").isNull(), "missing").when(F.col("times") > 1, "listed_twice").when(F.col("digest") != F.col("sha256"), "mismatch").otherwise("ok")
    return met.select(F.coalesce("name", "listed").alias("name"), state.alias("state")).unionByName(listed.where("listed = ''").select(F.col("line").alias("name"), F.lit("malformed").alias("state")))


@query(
    "c21_release_gate",
    "SELECT doc_id || '.txt' AS name, CASE WHEN doc_id % 7 = 0 THEN 'unlisted' WHEN doc_id % 17 = 0 THEN 'listed_twice' WHEN doc_id % 11 = 0 THEN 'mismatch' ELSE 'ok' END AS state FROM documents UNION ALL SELECT (doc_id + 10000000) || '.txt', 'missing' FROM documents WHERE doc_id % 13 = 0 UNION ALL SELECT 'x  ' || doc_id || '.txt', 'malformed' FROM documents WHERE doc_id % 7 = 0",
)
def release_gate(t: Tables) -> DataFrame:
    """Files of all documents, and a list that lacks some, has others that aren't there, and wrong, double and unreadable lines."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    own = F.sha2(F.coalesce("text", F.lit("")), 256)
    line = F.concat(F.when((F.col("doc_id") % 11 == 0) & (F.col("doc_id") % 17 != 0), F.sha2(own, 256)).when(F.col("doc_id") % 7 == 0, F.lit("x")).otherwise(own), F.lit("  "), name)
    line = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("x  "), name)).otherwise(line)
    extra = F.concat(own, F.lit("  "), (F.col("doc_id") + 10_000_000).cast("string"), F.lit(".txt"))
    lines = t.documents.select(F.explode(F.array_compact(F.array(line, F.when((F.col("doc_id") % 17 == 0) & (F.col("doc_id") % 7 != 0), line), F.when(F.col("doc_id") % 13 == 0, extra)))).alias("line"))
    return gate_files(t.documents.select(name.alias("name"), own.alias("sha256")), lines)


#: Fixed values of a template, and of targets that stand for unfinished ones.
TEMPLATE = "Redirected from "


def target_findings(role: Column, source: Column, target: Column, approved: dict[str, str], unfinished: tuple[str, ...]) -> Column:
    """array<struct<pointer, code, token>> of an accepted target: a JSON array for a glossary set, else a scalar."""
    leaves = F.when(role == "glossary_set", F.transform(F.from_json(target, "array<string>"), lambda x, k: F.struct(F.concat(F.lit("/"), k.cast("string")).alias("pointer"), x.alias("text")))).otherwise(F.array(F.struct(F.lit("").alias("pointer"), target.alias("text"))))
    one = lambda pointer, code, token: F.struct(pointer.alias("pointer"), F.lit(code).alias("code"), token.alias("token"))
    whole = F.array_compact(F.array(F.when(source.isin(*approved) & target.isin(*unfinished), one(F.lit(""), "approved_residual", F.lit(None).cast("string")))))

    def each(leaf: Column) -> Column:
        raw = F.when(leaf["text"].startswith(TEMPLATE), one(leaf["pointer"], "raw_template", F.lit(TEMPLATE.strip())))
        words = F.filter(F.regexp_extract_all(leaf["text"], F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: w.rlike(patterns.MIXED_ALPHABET))
        return F.concat(F.array_compact(F.array(raw)), F.transform(words, lambda w: one(leaf["pointer"], "mixed_alphabet_token", w)))

    return F.concat(whole, F.flatten(F.transform(leaves, each)))


@query(
    "c22_localisation_audit",
    "SELECT p_partkey, '' AS pointer, 'approved_residual' AS code, NULL AS token FROM part WHERE p_partkey % 6 = 0 AND p_type = (SELECT MIN(p_type) FROM part) UNION ALL SELECT p_partkey, '', 'raw_template', 'Redirected from' FROM part WHERE p_partkey % 6 = 1 "
    "UNION ALL SELECT p_partkey, '/1', 'mixed_alphabet_token', 'словоx' FROM part WHERE p_partkey % 6 = 2 UNION ALL SELECT p_partkey, '/2', 'raw_template', 'Redirected from' FROM part WHERE p_partkey % 6 = 2 UNION ALL SELECT p_partkey, '', 'mixed_alphabet_token', 'aб' FROM part WHERE p_partkey % 6 = 3 UNION ALL SELECT p_partkey, '', 'mixed_alphabet_token', 'вc' FROM part WHERE p_partkey % 6 = 3",
)
def localisation_audit(t: Tables) -> DataFrame:
    first = t.part.agg(F.min("p_type")).first()[0]
    k = F.col("p_partkey") % 6
    target = F.when(k == 0, F.lit("TODO")).when(k == 1, F.lit("Redirected from here")).when(k == 2, F.to_json(F.array(F.lit("слово"), F.lit("это словоx тут"), F.lit("Redirected from there")))).when(k == 3, F.lit("aб, слово и вc")).otherwise(F.lit("слово word"))
    role = F.when(k == 2, F.lit("glossary_set")).otherwise(F.lit("note"))
    found = target_findings(role, F.col("p_type"), target, {first: "слово"}, ("TODO",))
    return t.part.select("p_partkey", F.explode(found).alias("x")).select("p_partkey", "x.*")


def audit_records(strings: DataFrame, text: str) -> DataFrame:
    """(class, records, digest): visible strings by what is to become of them, each distinct one a record with its number of occurrences."""
    kind = F.when(F.col(text).rlike("^[A-Z]{2,}#[0-9]+$|^Brand#"), "MUST_PRESERVE").when(F.col(text).rlike("[0-9]"), "REVIEW").otherwise("MUST_TRANSLATE")
    records = strings.groupBy(kind.alias("class"), F.col(text).alias("t")).agg(F.count("*").alias("n"))
    line = F.concat_ws("|", "t", F.col("n").cast("string"))
    # sums of hashes are the same in any order
    return records.groupBy("class").agg(F.count("*").alias("records"), F.sum("n").alias("occurrences"), F.sum(F.conv(F.substring(F.sha2(line, 256), 1, 8), 16, 10).cast("long")).alias("digest"))


@query(
    "c23_archive_audit",
    "WITH v AS (SELECT p_brand AS x FROM part UNION ALL SELECT 'size ' || p_size FROM part UNION ALL SELECT p_name FROM part), r AS (SELECT CASE WHEN REGEXP_MATCHES(x, '^Brand#') THEN 'MUST_PRESERVE' WHEN REGEXP_MATCHES(x, '[0-9]') THEN 'REVIEW' ELSE 'MUST_TRANSLATE' END AS class, x, COUNT(*) AS n FROM v GROUP BY ALL) "
    "SELECT class, COUNT(*) AS records, CAST(SUM(n) AS BIGINT) AS occurrences, CAST(SUM(('0x' || SUBSTRING(SHA256(x || '|' || n), 1, 8))::BIGINT) AS BIGINT) AS digest, class <> 'REVIEW' AS approved FROM r GROUP BY 1",
)
def archive_audit(t: Tables) -> DataFrame:
    """Records of an archive by class, and whether an approval has exactly these: it was given for other sizes."""
    own = t.part.select(F.explode(F.array("p_brand", F.concat(F.lit("size "), F.col("p_size").cast("string")), "p_name")).alias("x"))
    then = t.part.select(F.explode(F.array("p_brand", F.concat(F.lit("size "), (F.col("p_size") + 1).cast("string")), "p_name")).alias("x"))
    now, approval = audit_records(own, "x"), audit_records(then, "x").select(F.col("class").alias("_class"), *(F.col(c).alias(f"_{c}") for c in ("records", "occurrences", "digest")))
    same = F.col("_class").isNotNull() & F.col("records").eqNullSafe(F.col("_records")) & F.col("occurrences").eqNullSafe(F.col("_occurrences")) & F.col("digest").eqNullSafe(F.col("_digest"))
    return now.join(approval, F.col("class") == F.col("_class"), "left").select("class", "records", "occurrences", "digest", same.alias("approved"))


@query("c24_before_after_report", "SELECT c_mktsegment, COUNT(*) AS before, CAST(COUNT(*) FILTER (c_custkey % 5 = 0) AS BIGINT) AS replaced, CAST(COUNT(*) FILTER (c_custkey % 5 <> 0) AS BIGINT) AS kept FROM customer GROUP BY 1")
def before_after(t: Tables) -> DataFrame:
    after = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("after"))
    j = t.customer.join(after, "c_custkey")
    return j.groupBy("c_mktsegment").agg(F.count("*").alias("before"), F.count_if(F.expr("after <> c_mktsegment")).alias("replaced"), F.count_if(F.expr("after = c_mktsegment")).alias("kept"))


@query("c25_workload_profile", "WITH picks AS (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 48) SELECT o_orderpriority, COUNT(*) AS repeated_units, COUNT(DISTINCT o_orderkey) AS articles, COUNT(DISTINCT o_custkey) AS headwords FROM picks JOIN orders ON o_orderkey = l_orderkey GROUP BY 1")
def workload_profile(t: Tables) -> DataFrame:
    j = t.lineitem.where("l_quantity >= 48").join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("o_orderpriority").agg(F.count("*").alias("repeated_units"), F.countDistinct("o_orderkey").alias("articles"), F.countDistinct("o_custkey").alias("headwords"))


USAGE = {"input": "l_partkey", "cached": "CASE WHEN l_quantity = 48 THEN l_partkey + 1 ELSE LEAST(l_partkey, l_suppkey) END", "output": "CASE WHEN l_quantity = 49 THEN -l_linenumber ELSE l_linenumber END", "total": "l_partkey + l_linenumber + CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END"}


@query("c26_usage_consistency", f"WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, {', '.join(f'{v} AS {k}' for k, v in USAGE.items())} FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN input < 0 OR cached < 0 OR output < 0 OR total < 0 THEN 'negative' WHEN cached > input THEN 'cached_over_input' WHEN total <> input + output THEN 'total_mismatch' END AS violation FROM u")
def usage_consistency(t: Tables) -> DataFrame:
    """The first rule that a row of token counts breaks: none below zero, no more cached than read, the total their sum."""
    u = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *(F.expr(v).alias(k) for k, v in USAGE.items()))
    return u.select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.least("input", "cached", "output", "total") < 0, "negative").when(F.col("cached") > F.col("input"), "cached_over_input").when(F.col("total") != F.col("input") + F.col("output"), "total_mismatch").alias("violation"))


@query("c27_frequency_metadata", f"WITH {TOKENS}, m AS (SELECT source, COUNT(*) AS terms, MAX(rank) AS deepest FROM ranked WHERE rank <= 200 GROUP BY 1) SELECT source, terms, CASE WHEN deepest < 200 THEN 'short' WHEN terms = deepest THEN 'complete' ELSE 'inconsistent' END AS label FROM m")
def frequency_metadata(t: Tables) -> DataFrame:
    m = frequency_lists(t).where("rank <= 200").groupBy("source").agg(F.count("*").alias("terms"), F.max("rank").alias("deepest"))
    return m.select("source", "terms", F.expr("case when deepest < 200 then 'short' when terms = deepest then 'complete' else 'inconsistent' end").alias("label"))


#: What a report on a clean installation must attest, all of it and nothing else.
SMOKE_CHECKS = (
    "expression_lookup", "reading_lookup", "inflected_lookup", "kana_only_lookup", "multiple_readings", "xrefs", "ruby", "examples", "tables", "links", "long_entry",
    "redirect_localization", "restriction_localization", "preserved_terminology", "repaired_mixed_alphabet", "owned_update_upgrade", "settings_preserved", "no_foreign_names",
)
REPORT_FIELDS = ("checks", "clean_profile", "imported", "notes", "schema_version", "zip_sha256")


def attest(reports: DataFrame, exports: DataFrame, recorded: DataFrame) -> DataFrame:
    """(report_id, outcome, export_id): reports (report_id, raw) against verified exports (export_id, zip_sha256) and those already recorded (export_id).

    The last export of an archive counts; a report for one that is recorded changes nothing.
    """
    v = F.try_parse_json("raw")
    # fields that Spark's JSON reader finds, and the checks as a map: an unknown, a missing or a false one is seen
    checks = F.from_json(F.get_json_object("raw", "$.checks"), "map<string,string>")
    names = F.array(*map(F.lit, sorted(SMOKE_CHECKS)))
    last = exports.groupBy("zip_sha256").agg(F.max("export_id").alias("export_id"))
    met = reports.withColumn("zip_sha256", F.get_json_object("raw", "$.zip_sha256")).join(last, "zip_sha256", "left").join(recorded.select("export_id").distinct().withColumn("_seen", F.lit(True)), "export_id", "left")
    outcome = F.when(~F.coalesce(F.array_sort(F.json_object_keys("raw")) == F.array(*map(F.lit, REPORT_FIELDS)), F.lit(False)), "unexpected_fields")
    outcome = outcome.when(~F.coalesce((F.try_variant_get(v, "$.schema_version", "int") == 1) & F.try_variant_get(v, "$.clean_profile", "boolean") & F.try_variant_get(v, "$.imported", "boolean"), F.lit(False)), "not_attested")
    outcome = outcome.when(~F.coalesce((F.array_sort(F.map_keys(checks)) == names) & F.forall(F.map_values(checks), lambda x: x == "true"), F.lit(False)), "checks_failed")
    outcome = outcome.when(~F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.notes", "variant")) == "STRING", F.lit(False)), "notes_not_text").when(F.col("export_id").isNull(), "no_verified_export")
    return met.select("report_id", outcome.when(F.col("_seen"), "already_recorded").otherwise("recorded").alias("outcome"), "export_id")


@query(
    "c28_attestation",
    "WITH e AS (SELECT CAST(MAX(c_custkey) AS BIGINT) AS export_id, c_nationkey FROM customer WHERE c_custkey % 2 = 0 GROUP BY 2) SELECT s_suppkey AS report_id, CASE s_suppkey % 11 WHEN 1 THEN 'unexpected_fields' WHEN 2 THEN 'not_attested' WHEN 3 THEN 'checks_failed' WHEN 4 THEN 'checks_failed' WHEN 5 THEN 'checks_failed' WHEN 6 THEN 'notes_not_text' WHEN 7 THEN 'not_attested' ELSE "
    "CASE WHEN export_id IS NULL THEN 'no_verified_export' WHEN c_nationkey % 3 = 0 THEN 'already_recorded' ELSE 'recorded' END END AS outcome, export_id FROM supplier LEFT JOIN e ON c_nationkey = s_nationkey AND s_suppkey % 11 <> 9",
)
def attestation(t: Tables) -> DataFrame:
    """A report for each supplier, some of them broken, on the archive of its nation."""
    k = F.col("s_suppkey") % 11
    names = list(SMOKE_CHECKS)
    said = lambda ns, last="true": "{" + ",".join(f'"{n}":{last if n == ns[-1] else "true"}' for n in ns) + "}"
    checks = F.when(k == 3, F.lit(said(names, "false"))).when(k == 4, F.lit(said(names[:-1]))).when(k == 5, F.lit(said([*names, "one_more"]))).otherwise(F.lit(said(names)))
    raw = F.concat(
        F.lit('{"schema_version":'), F.when(k == 2, "2").otherwise("1"), F.lit(',"zip_sha256":"'), F.when(k == 9, F.lit("none")).otherwise(F.sha2(F.col("s_nationkey").cast("string"), 256)), F.lit('","clean_profile":true,"imported":'), F.when(k == 7, "false").otherwise("true"),
        F.lit(',"checks":'), checks, F.lit(',"notes":'), F.when(k == 6, F.lit("1")).otherwise(F.lit('""')), F.when(k == 1, F.lit(',"extra":1')).otherwise(F.lit("")), F.lit("}"),
    )
    exports = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("export_id"), F.sha2(F.col("c_nationkey").cast("string"), 256).alias("zip_sha256"), "c_nationkey")
    recorded = exports.where("c_nationkey % 3 = 0").select("export_id")
    return attest(t.supplier.select(F.col("s_suppkey").alias("report_id"), raw.alias("raw")), exports, recorded)


@query("c29_catalog_assertions", "SELECT COUNT(DISTINCT n_regionkey) AS categories, COUNT(*) - COUNT(DISTINCT n_name) AS label_collisions, CAST(COUNT(*) FILTER (n_name IS NULL OR n_name = '') AS BIGINT) AS unlabelled, COUNT(*) - COUNT(DISTINCT REPLACE(n_name, ' ', chr(160))) AS encoded_collisions FROM nation")
def catalog_assertions(t: Tables) -> DataFrame:
    return t.nation.agg(F.countDistinct("n_regionkey").alias("categories"), (F.count("*") - F.countDistinct("n_name")).alias("label_collisions"), F.count_if(F.expr("n_name is null or n_name = ''")).alias("unlabelled"), (F.count("*") - F.countDistinct(F.translate("n_name", " ", " "))).alias("encoded_collisions"))


OWNED = {"title": "Owned Title", "source": "ja", "target": "ru", "url": "https://owned.example/", "version": "2.0", "index_url": "https://owned.example/index.json", "download_url": "https://owned.example/latest.zip"}
FOREIGN = ("foreign.example",)


def metadata_issue(raw: Column, owned: dict[str, str], foreign: tuple[str, ...], *, must_update: bool | None = None) -> Column:
    """The first rule that an archive's metadata breaks: title, languages, owned addresses, the version in the revision, and update fields all or none."""
    text = lambda k: F.get_json_object(raw, f"$.{k}")
    update = ("isUpdatable", "indexUrl", "downloadUrl")
    there = [F.array_contains(F.json_object_keys(raw), k) for k in update]
    some, all_ = reduce(or_, there), reduce(and_, there)
    on = F.coalesce(text("isUpdatable") == "true", F.lit(False))
    wrong = lambda k, v: ~text(k).eqNullSafe(F.lit(v))
    bad = reduce(or_, (F.contains(F.lower(F.coalesce(text(k), F.lit(""))), F.lit(x)) for k in ("url", "indexUrl", "downloadUrl") for x in foreign))
    out = F.when(wrong("title", owned["title"]), "title").when(wrong("sourceLanguage", owned["source"]) | wrong("targetLanguage", owned["target"]), "languages").when(bad, "foreign_url").when(wrong("url", owned["url"]), "url")
    out = out.when(~F.coalesce(F.contains(text("revision"), F.lit(f"v{owned['version']}")), F.lit(False)), "revision").when(some & ~(all_ & on), "partial_update")
    if must_update is not None:
        out = out.when(~on if must_update else some, "update_required" if must_update else "update_not_allowed")
    return out.when(on & (wrong("indexUrl", owned["index_url"]) | wrong("downloadUrl", owned["download_url"])), "update_urls")


def metadata(**changes: object) -> str:
    base = {"title": OWNED["title"], "revision": "v2.0-1", "sourceLanguage": "ja", "targetLanguage": "ru", "url": OWNED["url"], "isUpdatable": True, "indexUrl": OWNED["index_url"], "downloadUrl": OWNED["download_url"]}
    return json.dumps({k: v for k, v in (base | changes).items() if v is not None})


METADATA = [
    (metadata(), None), (metadata(title="Other"), "title"), (metadata(targetLanguage="en"), "languages"), (metadata(url="https://other.example/"), "url"), (metadata(revision="v1.0"), "revision"), (metadata(indexUrl=None), "partial_update"),
    (metadata(isUpdatable=False), "partial_update"), (metadata(isUpdatable=None, indexUrl=None, downloadUrl=None), None), (metadata(downloadUrl="https://else.example/x"), "update_urls"), (metadata(indexUrl="https://FOREIGN.example/"), "foreign_url"), (metadata(sourceLanguage=None), "languages"),
]


@query("c30_metadata_rules", f"SELECT page_id, CASE page_id % {len(METADATA)}" + "".join(f" WHEN {k} THEN '{x}'" for k, (_, x) in enumerate(METADATA) if x) + " END AS issue FROM pages")
def metadata_rules(t: Tables) -> DataFrame:
    rows = t.spark.createDataFrame([(k, raw) for k, (raw, _) in enumerate(METADATA)], "k int, raw string")
    return t.pages.join(F.broadcast(rows), F.col("page_id") % len(METADATA) == F.col("k")).select("page_id", metadata_issue(F.col("raw"), OWNED, FOREIGN).alias("issue"))


@query("c31_payload_integrity", "SELECT o_custkey, COUNT(*) = COUNT(DISTINCT o_orderkey) AS unique_ids, SHA256(STRING_AGG(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey)) AS sha256 FROM orders GROUP BY 1")
def payload_integrity(t: Tables) -> DataFrame:
    ids = F.array_sort(F.collect_list("o_orderkey"))
    g = t.orders.groupBy("o_custkey").agg(ids.alias("x"))
    return g.select("o_custkey", (F.size("x") == F.size(F.array_distinct("x"))).alias("unique_ids"), F.sha2(F.array_join(F.transform("x", lambda v: v.cast("string")), ","), 256).alias("sha256"))


@query("c32_member_checks", "SELECT CAST(COUNT(*) FILTER (REGEXP_MATCHES(url, '\\.\\./|^/')) AS BIGINT) AS unsafe, COUNT(*) - COUNT(DISTINCT (page_id, url)) AS repeated FROM pages")
def member_checks(t: Tables) -> DataFrame:
    return t.pages.agg(F.count_if(F.col("url").rlike(r"\.\./|^/")).alias("unsafe"), (F.count("*") - F.countDistinct("page_id", "url")).alias("repeated"))


@query("c33_marker_equality", "SELECT event_type, COUNT(*) AS n, COUNT(*) = 1 AS exactly_one FROM events GROUP BY 1")
def marker_equality(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).withColumn("exactly_one", F.expr("n = 1"))


@query(
    "c33_phase_pairs",
    "SELECT user_id, CAST(COUNT(*) FILTER (event_type = 'signup') AS BIGINT) AS begins, CAST(COUNT(*) FILTER (event_type = 'purchase') AS BIGINT) AS ends, COUNT(DISTINCT props) FILTER (event_type IN ('signup', 'purchase')) = 1 AS same_identity, "
    "CASE WHEN COUNT(*) FILTER (event_type = 'signup') = 1 AND COUNT(*) FILTER (event_type = 'purchase') = 1 AND MAX(epoch_us(ts)) FILTER (event_type = 'purchase') >= MAX(epoch_us(ts)) FILTER (event_type = 'signup') THEN (MAX(epoch_us(ts)) FILTER (event_type = 'purchase') - MAX(epoch_us(ts)) FILTER (event_type = 'signup')) / 1000000.0 END AS measured FROM events GROUP BY 1",
)
def phase_pairs(t: Tables) -> DataFrame:
    """A stage is measured if it has exactly one begin and one end, in this order; its markers must say the same identity."""
    begin, end = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    g = t.events.groupBy("user_id").agg(F.count_if(begin).alias("begins"), F.count_if(end).alias("ends"), (F.countDistinct(F.when(begin | end, F.col("props"))) == 1).alias("same_identity"), F.max(F.when(begin, at)).alias("a"), F.max(F.when(end, at)).alias("b"))
    return g.select("user_id", "begins", "ends", "same_identity", F.when((F.col("begins") == 1) & (F.col("ends") == 1) & (F.col("b") >= F.col("a")), (F.col("b") - F.col("a")) / 1_000_000.0).alias("measured"))


SEQUENCES = (("orders", "o_orderkey"), ("customer", "c_custkey"), ("events", "event_id"), ("documents", "doc_id"), ("nation", "n_nationkey"))


@query("c34_sequence_safety", " UNION ALL ".join(f"SELECT '{name}' AS table_name, MAX({key}) AS high, COUNT(*) AS next_value, COUNT(*) > MAX({key}) AS next_is_free FROM {name}" for name, key in SEQUENCES))
def sequence_safety(t: Tables) -> DataFrame:
    """Would the next value of a sequence that counted the rows be a key that none has? Not where keys start at 1 or have gaps."""
    out = None
    for name, key in SEQUENCES:
        one = getattr(t, name).agg(F.max(F.col(key).cast("long")).alias("high"), F.count("*").alias("next_value")).select(F.lit(name).alias("table_name"), "high", "next_value", (F.col("next_value") > F.col("high")).alias("next_is_free"))
        out = one if out is None else out.unionByName(one)
    return out
