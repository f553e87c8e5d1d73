"""Set operations, and mutations as functions from old tables to new ones."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.registry import Tables, query


@query("o01_union_distinct", "SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O' UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def union_distinct(t: Tables) -> DataFrame:
    return t.lineitem.where("l_linestatus = 'O'").select("l_orderkey").union(t.orders.where("o_orderstatus = 'P'").select("o_orderkey")).distinct()


@query("o02_except_both_ways", "WITH a AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A') SELECT 'missing' AS side, l_partkey, l_suppkey FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'extra', l_partkey, l_suppkey FROM (FROM b EXCEPT FROM a)")
def except_both(t: Tables) -> DataFrame:
    a, b = (t.lineitem.where(F.col("l_returnflag") == f).select("l_partkey", "l_suppkey") for f in "RA")
    return a.subtract(b).withColumn("side", F.lit("missing")).unionByName(b.subtract(a).withColumn("side", F.lit("extra")))


@query("o03_set_algebra", "WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O') SELECT (SELECT COUNT(*) FROM (FROM a UNION FROM b)) AS either, (SELECT COUNT(*) FROM (FROM a INTERSECT FROM b)) AS both, (SELECT COUNT(*) FROM (FROM a EXCEPT FROM b)) = 0 AS subset")
def set_algebra(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("a"), F.bool_or(F.col("o_orderstatus") == "O").alias("b"))
    return per.agg(F.count_if(F.expr("a or b")).alias("either"), F.count_if(F.expr("a and b")).alias("both"), (F.count_if(F.expr("a and not b")) == 0).alias("subset"))


@query("o04_heterogeneous_union", "SELECT 'nation' AS source_kind, n_nationkey::BIGINT AS code, n_name AS label, NULL::BIGINT AS occurrences FROM nation UNION ALL SELECT 'segment', NULL, c_mktsegment, COUNT(*) FROM customer GROUP BY c_mktsegment")
def heterogeneous_union(t: Tables) -> DataFrame:
    a = t.nation.select(F.lit("nation").alias("source_kind"), F.col("n_nationkey").cast("long").alias("code"), F.col("n_name").alias("label"))
    b = t.customer.groupBy(F.col("c_mktsegment").alias("label")).agg(F.count("*").alias("occurrences")).withColumn("source_kind", F.lit("segment"))
    return a.unionByName(b, allowMissingColumns=True)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key ``old`` lacks, one for each key."""
    return new.dropDuplicates(keys).join(old.select(keys), keys, "left_anti")


@query("u01_insert_or_ignore", "SELECT c_custkey, COUNT(*) OVER () AS inserted FROM (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'P') WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def insert_or_ignore(t: Tables) -> DataFrame:
    new = insert_missing(t.customer.where("c_mktsegment = 'BUILDING'"), t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])
    return new.crossJoin(F.broadcast(new.agg(F.count("*").alias("inserted"))))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with their keys."""
    return old.join(new.select(keys), keys, "left_anti").unionByName(new)


@query("u02_upsert", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 10 <> 0 UNION ALL SELECT c_custkey, 'UPDATED', c_acctbal + 1 FROM customer WHERE c_custkey % 10 = 0")
def upserted(t: Tables) -> DataFrame:
    old = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return upsert(old, old.where("c_custkey % 10 = 0").select("c_custkey", F.lit("UPDATED").alias("c_mktsegment"), (F.col("c_acctbal") + 1).alias("c_acctbal")), ["c_custkey"])


def preserving_upsert(old: DataFrame, new: DataFrame, key: str, source_hash: str, preserved: list[str]) -> DataFrame:
    """The new rows; ``preserved`` columns stay as long as a key's source hash does."""
    o = old.select(F.col(key).alias("_k"), F.col(source_hash).alias("_h"), *(F.col(c).alias(f"_{c}") for c in preserved))
    met = new.join(o, F.col(key) == F.col("_k"), "left")
    same = F.col(source_hash) == F.col("_h")
    return met.select(*new.columns, *(F.when(same, F.col(f"_{c}")).alias(c) for c in preserved))


@query("u03_preserving_upsert", "SELECT p_partkey, SHA256(CASE WHEN p_partkey % 7 = 0 THEN p_name || '!' ELSE p_name END) AS h, CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 3 <> 0 THEN p_brand END AS label FROM part")
def preserving(t: Tables) -> DataFrame:
    old = t.part.where("p_partkey % 3 <> 0").select("p_partkey", F.sha2("p_name", 256).alias("h"), F.col("p_brand").alias("label"))
    name = F.when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name"))
    return preserving_upsert(old, t.part.select("p_partkey", F.sha2(name, 256).alias("h")), "p_partkey", "h", ["label"])


@query("u04_insert_select", "SELECT 'u-r2-' || l_orderkey || '-' || l_linenumber AS id, 2 AS run_id, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def insert_select(t: Tables) -> DataFrame:
    kept = t.lineitem.where("l_returnflag = 'R'").join(t.orders.where("o_orderstatus = 'P'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return kept.select(F.concat_ws("-", F.lit("u-r2"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"), F.lit(2).alias("run_id"), "l_partkey")


@query("u05_update_where_exists", "SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') THEN 'review' ELSE o_orderstatus END AS status FROM orders")
def update_where_exists(t: Tables) -> DataFrame:
    hit = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    return t.orders.join(hit, "o_orderkey", "left").select("o_orderkey", F.when(F.col("hit"), "review").otherwise(F.col("o_orderstatus")).alias("status"))


def selected_flag(rows: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """``selected`` (0 or 1) as a derived column: nothing is reset or set."""
    return rows.join(chosen.select(key).distinct().withColumn("_in", F.lit(1)), key, "left").withColumn("selected", F.coalesce("_in", F.lit(0))).drop("_in")


@query("u06_reset_then_set", "SELECT p_partkey, CAST(p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50) AS INT) AS selected FROM part")
def reset_then_set(t: Tables) -> DataFrame:
    chosen = t.lineitem.where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return selected_flag(t.part.select("p_partkey"), chosen, "p_partkey")


def compare_and_swap(batches: DataFrame, claims: DataFrame, *, outcome: str = "accepted", state: str = "validated") -> DataFrame:
    """Claims (attempt, batch, token, attempt_state) against the leases they were given (batch, state, token).

    A claim swaps the state of its batch only while it is open and its token is
    that of the lease, and only if it is the one claim that can; others are stale,
    and change nothing. One row for each claim: attempt, batch, swapped, attempt_state, batch_state.
    """
    lease = batches.select(F.col("batch").alias("_batch"), F.col("state").alias("_state"), F.col("token").alias("_token"))
    met = claims.join(lease, F.col("batch") == F.col("_batch"), "left")
    owns = F.coalesce((F.col("attempt_state") == "claimed") & (F.col("_state") == "leased") & (F.col("token") == F.col("_token")), F.lit(False))
    # the row count that a conditional update would give: exactly one, or the swap is off
    able = met.withColumn("_owns", owns).groupBy(F.col("batch").alias("_of")).agg(F.count_if("_owns").alias("_able"))
    both = met.withColumn("_owns", owns).join(able, F.col("batch") == F.col("_of"))
    swapped = F.col("_owns") & (F.col("_able") == 1)
    return both.select("attempt", "batch", swapped.alias("swapped"), F.when(swapped, outcome).otherwise(F.col("attempt_state")).alias("attempt_state"), F.when(swapped, state).otherwise(F.col("_state")).alias("batch_state"))


#: Leases and claims as their tables would have them: some leases were taken over, some batches aren't leased, some tokens were given twice.
LEASES = {"batch": "o_orderkey", "state": "CASE WHEN o_orderstatus = 'P' THEN 'ready' ELSE 'leased' END", "token": "CASE WHEN o_orderkey % 5 = 0 THEN 'new' || o_custkey WHEN o_orderkey % 7 = 0 THEN NULL ELSE 't' || o_custkey END"}
CLAIMS = {"attempt": "l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey", "batch": "l_orderkey", "token": "CASE WHEN l_linenumber = 1 OR l_partkey % 9 = 0 THEN 't' || o_custkey ELSE 'x' END", "attempt_state": "CASE WHEN l_returnflag = 'A' THEN 'rejected' ELSE 'claimed' END"}


@query(
    "u07_compare_and_swap",
    f"WITH b AS (SELECT {', '.join(f'{v} AS {k}' for k, v in LEASES.items())} FROM orders), c AS (SELECT DISTINCT {', '.join(f'{v} AS {k}' for k, v in CLAIMS.items())} FROM lineitem JOIN orders ON o_orderkey = l_orderkey), "
    "o AS (SELECT c.*, b.state, c.attempt_state = 'claimed' AND b.state = 'leased' AND c.token = b.token IS TRUE AS owns FROM c JOIN b USING (batch)), n AS (SELECT *, owns AND COUNT(*) FILTER (owns) OVER (PARTITION BY batch) = 1 AS swapped FROM (SELECT * REPLACE (COALESCE(attempt_state = 'claimed' AND state = 'leased' AND owns, FALSE) AS owns) FROM o)) "
    "SELECT attempt, batch, swapped, CASE WHEN swapped THEN 'accepted' ELSE attempt_state END AS attempt_state, CASE WHEN swapped THEN 'validated' ELSE state END AS batch_state FROM n",
)
def swapped_leases(t: Tables) -> DataFrame:
    batches = t.orders.select(*(F.expr(v).alias(k) for k, v in LEASES.items()))
    claims = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*(F.expr(v).alias(k) for k, v in CLAIMS.items())).distinct()
    return compare_and_swap(batches, claims)


@query("u07_supersede", "SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS current FROM orders")
def supersede(t: Tables) -> DataFrame:
    """A later row of a key supersedes the earlier ones."""
    last = t.orders.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey"))["o_orderkey"].alias("last"))
    return t.orders.join(last, "o_custkey").select("o_orderkey", "o_custkey", (F.col("o_orderkey") == F.col("last")).alias("current"))


def versions(rows: DataFrame, key: str, *order: str, value: str) -> DataFrame:
    """History of a value: a row for every change, valid from its order up to the next change."""
    w = Window.partitionBy(key).orderBy(*order)
    changed = rows.withColumn("_old", F.lag(value).over(w)).where(F.col("_old").isNull() | (F.col("_old") != F.col(value)))
    return changed.select(key, F.col(value), F.col(order[0]).alias("valid_from"), F.lead(order[0]).over(w).alias("valid_to"), F.row_number().over(w).cast("long").alias("version"))


@query("u08_versioned_history", "WITH c AS (SELECT *, LAG(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS old FROM orders), d AS (SELECT * FROM c WHERE old IS NULL OR old <> o_orderstatus) SELECT o_custkey, o_orderstatus, o_orderdate AS valid_from, LEAD(o_orderdate) OVER w AS valid_to, ROW_NUMBER() OVER w AS version FROM d WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def versioned_history(t: Tables) -> DataFrame:
    return versions(t.orders, "o_custkey", "o_orderdate", "o_orderkey", value="o_orderstatus")


def approve(current: DataFrame, approved: DataFrame, key: str, values: list[str], authority: str, provenance: list[str]) -> tuple[DataFrame, DataFrame]:
    """The table after an approval, and the rows that go to its history.

    A row whose values and provenance are the approved ones stays; one that
    differs in provenance alone, under the same authority, only gets that; any
    other is kept in the history, with the hash that replaced it, and overwritten.
    ``what`` says which of the three it was; rows that aren't approved stay.
    """
    both = [*values, *provenance]
    new = approved.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in both))
    met = current.join(new, F.col(key) == F.col("_key"), "left")
    same = lambda cs: reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cs))
    ours = F.col("authority") == authority
    what = F.when(F.col("_key").isNull() | (same(values) & ours & same(provenance)), "unchanged").when(same(values) & ours, "provenance").otherwise("changed")
    told = met.withColumn("what", what)
    put = lambda c, kinds: F.when(F.col("what").isin(*kinds), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    after = told.select(key, *(put(c, ("changed",)) for c in values), *(put(c, ("changed", "provenance")) for c in provenance), F.when(F.col("what") == "changed", F.lit(authority)).otherwise(F.col("authority")).alias("authority"), "what")
    history = told.where("what = 'changed'").select(key, *both, "authority", F.col(f"_{provenance[0]}").alias("replaced_by"))
    return after, history


TAGS = {"id": "p_partkey", "label": "p_brand", "description": "p_type", "hash": "CASE WHEN p_partkey % 4 = 1 THEN 'h0' ELSE 'h1' END", "authority": "CASE WHEN p_partkey % 4 = 3 THEN 'model' ELSE 'approved' END"}
#: Every third part isn't approved, every fifth one gets another label.
APPROVED = {"id": "p_partkey", "label": "CASE WHEN p_partkey % 5 = 0 THEN LOWER(p_brand) ELSE p_brand END", "description": "p_type", "hash": "'h1'"}


def approvals(t: Tables) -> tuple[DataFrame, DataFrame]:
    current = t.part.select(*(F.expr(v).alias(k) for k, v in TAGS.items()))
    approved = t.part.where("p_partkey % 3 <> 0").select(*(F.expr(v).alias(k) for k, v in APPROVED.items()))
    return approve(current, approved, "id", ["label", "description"], "approved", ["hash"])


APPROVAL_SQL = f"""WITH c AS (SELECT {', '.join(f'{v} AS {k}' for k, v in TAGS.items())}, p_partkey % 3 <> 0 AS covered, {APPROVED['label']} AS new_label FROM part), w AS (SELECT *, CASE WHEN NOT covered THEN 'unchanged'
 WHEN label <> new_label OR authority <> 'approved' THEN 'changed' WHEN hash <> 'h1' THEN 'provenance' ELSE 'unchanged' END AS what FROM c)"""


@query("u08_approval", f"{APPROVAL_SQL} SELECT id, CASE WHEN what = 'changed' THEN new_label ELSE label END AS label, description, CASE WHEN what = 'unchanged' THEN hash ELSE 'h1' END AS hash, CASE WHEN what = 'changed' THEN 'approved' ELSE authority END AS authority, what FROM w")
def approved_rows(t: Tables) -> DataFrame:
    return approvals(t)[0]


@query("u08_approval_history", f"{APPROVAL_SQL} SELECT id, label, description, hash, authority, 'h1' AS replaced_by FROM w WHERE what = 'changed'")
def approval_history(t: Tables) -> DataFrame:
    return approvals(t)[1]


@query("u09_canonicalisation", "WITH s AS (SELECT p_partkey AS id, 'S:' || p_brand AS v FROM part WHERE p_partkey % 3 = 0), m AS (SELECT p_partkey AS id, 'M:' || p_type AS v FROM part WHERE p_partkey % 2 = 0) SELECT p_partkey, p_name AS old_text, COALESCE(s.v, m.v, p_name) AS new_text, COALESCE(s.v, m.v, p_name) <> p_name AS changed FROM part LEFT JOIN s ON s.id = p_partkey LEFT JOIN m ON m.id = p_partkey")
def canonicalise(t: Tables) -> DataFrame:
    """Structured labels come before those of the manifest; a second run changes nothing."""
    s = t.part.where("p_partkey % 3 = 0").select("p_partkey", F.concat(F.lit("S:"), "p_brand").alias("sv"))
    m = t.part.where("p_partkey % 2 = 0").select("p_partkey", F.concat(F.lit("M:"), "p_type").alias("mv"))
    j = t.part.join(s, "p_partkey", "left").join(m, "p_partkey", "left").withColumn("new_text", F.coalesce("sv", "mv", "p_name"))
    return j.select("p_partkey", F.col("p_name").alias("old_text"), "new_text", (F.col("new_text") != F.col("p_name")).alias("changed"))


@query("u10_hash_ids", "SELECT s_suppkey, SUBSTRING(SHA256('supplier:' || s_name), 1, 16) AS id FROM supplier")
def hash_ids(t: Tables) -> DataFrame:
    """Ids that any rerun gives again, in place of a sequence."""
    return t.supplier.select("s_suppkey", F.substring(F.sha2(F.concat(F.lit("supplier:"), "s_name"), 256), 1, 16).alias("id"))


def migrate(children: DataFrame, parents: DataFrame, old_keys: list[str], new_key: str) -> DataFrame:
    """Children of a table keyed by ``old_keys`` with the key that replaces the last of these, from their parents.

    ``violation`` says which children have no parent (they would be lost) or, as
    an old key isn't unique, several.
    """
    met = children.join(parents.groupBy(*old_keys).agg(F.count("*").alias("_n"), F.min(new_key).alias(new_key)), old_keys, "left")
    return met.withColumn("violation", F.when(F.col("_n").isNull(), "no_parent").when(F.col("_n") > 1, "several_parents")).drop("_n")


RANKED = "SELECT source, SHA256(source) AS source_hash, doc_id AS article, n_chars % 50 AS rank FROM documents"


@query("u11_legacy_migration", f"WITH f AS ({RANKED}), p AS (SELECT source, source_hash, rank, COUNT(*) AS n, MIN(article) AS term FROM f WHERE rank % 7 <> 3 GROUP BY ALL) SELECT f.source, f.rank, f.article, p.term, CASE WHEN n IS NULL THEN 'no_parent' WHEN n > 1 THEN 'several_parents' END AS violation FROM f LEFT JOIN p ON p.source = f.source AND p.source_hash = f.source_hash AND p.rank = f.rank")
def legacy_migration(t: Tables) -> DataFrame:
    """Articles keyed by (source, hash, rank) get their term; ranks are shared, and some terms are gone."""
    f = t.documents.select("source", F.sha2("source", 256).alias("source_hash"), F.col("doc_id").alias("article"), (F.col("n_chars") % 50).alias("rank"))
    terms = f.where("rank % 7 <> 3").withColumnRenamed("article", "term")
    return migrate(f, terms, ["source", "source_hash", "rank"], "term").select("source", "rank", "article", "term", "violation")


def reload(old: DataFrame, scopes: DataFrame, new: DataFrame, scope: str) -> DataFrame:
    """``old`` without any row of the given scopes, and with the new rows of these: an overwrite of those partitions alone."""
    return old.join(scopes.select(scope).distinct(), scope, "left_anti").unionByName(new.join(scopes.select(scope).distinct(), scope, "left_semi"))


@query("u12_delete_and_reload", "SELECT o_orderpriority, o_orderkey, o_custkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') UNION ALL SELECT o_orderpriority, o_orderkey + 10000000, o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O'")
def delete_and_reload(t: Tables) -> DataFrame:
    """Two scopes are deleted and loaded anew; new rows of other scopes aren't taken."""
    old = t.orders.select("o_orderpriority", "o_orderkey", "o_custkey")
    new = t.orders.where("o_orderstatus = 'O'").select("o_orderpriority", (F.col("o_orderkey") + 10_000_000).alias("o_orderkey"), "o_custkey")
    return reload(old, t.spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "o_orderpriority string"), new, "o_orderpriority")


@query("u13_requeue_one_claim", "SELECT o_orderkey, CASE WHEN o_orderkey = (SELECT MIN(o_orderkey) FROM orders WHERE o_orderstatus = 'P') THEN 'ready' ELSE 'leased' END AS state FROM orders WHERE o_orderstatus = 'P'")
def requeue(t: Tables) -> DataFrame:
    p = t.orders.where("o_orderstatus = 'P'")
    first = p.agg(F.min("o_orderkey").alias("k"))
    return p.crossJoin(F.broadcast(first)).select("o_orderkey", F.when(F.col("o_orderkey") == F.col("k"), "ready").otherwise("leased").alias("state"))


@query("u14_manual_resolutions", "SELECT o_custkey, MIN(o_orderkey) AS resolved FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'N' JOIN customer ON c_custkey = o_custkey AND c_mktsegment = 'MACHINERY' GROUP BY 1")
def manual_resolutions(t: Tables) -> DataFrame:
    ok = t.orders.join(t.lineitem.where("l_returnflag = 'N'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").join(t.customer.where("c_mktsegment = 'MACHINERY'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return ok.groupBy("o_custkey").agg(F.min("o_orderkey").alias("resolved"))


def repair_leaves(leaves: DataFrame, needed: Column) -> DataFrame:
    """Children that supersede leaves (id, unit, tokens) whose manifest lacks tokens that their source calls for.

    A child has its parent's tokens and the missing ones, in order; its id is a
    hash of what was repaired, so a rerun gives the same child, and a second
    repair none. ``outcome`` says which leaves stay.
    """
    missing = F.array_except(needed, F.col("tokens"))
    told = leaves.withColumn("missing", missing).withColumn("outcome", F.when(F.size("missing") > 0, "superseded").otherwise("kept"))
    identity = F.concat_ws("|", F.col("id").cast("string"), F.lit("tokens-v1"), F.col("unit").cast("string"), F.array_join("missing", ","))
    child = F.when(F.col("outcome") == "superseded", F.concat(F.lit("b-"), F.substring(F.sha2(identity, 256), 1, 24)))
    return told.select("id", "unit", "outcome", child.alias("child"), F.concat("tokens", "missing").alias("tokens"))


@query(
    "u15_leaf_repair",
    "WITH l AS (SELECT p_partkey AS id, p_size AS unit, STRING_SPLIT(p_name, ' ') AS w, p_partkey % 3 AS k FROM part WHERE p_partkey NOT IN (SELECT p_partkey // 2 FROM part WHERE p_partkey % 10 = 0)), "
    "n AS (SELECT id, unit, k, CASE k WHEN 0 THEN '' WHEN 1 THEN w[1] ELSE w[2] || ',' || w[1] END AS tokens, CASE k WHEN 0 THEN w[1] || CASE WHEN w[2] <> w[1] THEN ',' || w[2] ELSE '' END WHEN 1 THEN CASE WHEN w[2] <> w[1] THEN w[2] ELSE '' END ELSE '' END AS missing FROM l) "
    "SELECT id, unit, CASE WHEN missing <> '' THEN 'superseded' ELSE 'kept' END AS outcome, CASE WHEN missing <> '' THEN 'b-' || SUBSTRING(SHA256(id || '|tokens-v1|' || unit || '|' || missing), 1, 24) END AS child, CONCAT_WS(',', NULLIF(tokens, ''), NULLIF(missing, '')) AS tokens FROM n",
)
def leaf_repair(t: Tables) -> DataFrame:
    """Batches that were split aren't leaves; a manifest has none, one or all of the words its source calls for."""
    split = t.part.where("p_partkey % 10 = 0").select(F.floor(F.col("p_partkey") / 2).alias("p_partkey"))
    w = F.split("p_name", " ")
    none = F.array().cast("array<string>")
    tokens = F.when(F.col("p_partkey") % 3 == 0, none).when(F.col("p_partkey") % 3 == 1, F.array(w[0])).otherwise(F.array(w[1], w[0]))
    leaves = t.part.join(split, "p_partkey", "left_anti").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("unit"), tokens.alias("tokens"), F.array_distinct(F.array(w[0], w[1])).alias("needed"))
    return repair_leaves(leaves, F.col("needed")).withColumn("tokens", F.array_join("tokens", ","))


def transaction(state: dict[str, DataFrame], steps: list[Callable[[dict[str, DataFrame]], dict[str, DataFrame]]], checks: dict[str, Callable[[dict[str, DataFrame]], DataFrame]]) -> tuple[dict[str, DataFrame], list[str]]:
    """All steps on some tables, or none: the new tables and no broken check, or the old ones and the checks that have rows.

    Steps are plans; nothing is written before the checks passed, and then as a new version (:func:`publish`).
    """
    after = dict(state)
    for step in steps:
        after |= step(after)
    broken = [name for name, check in checks.items() if not check(after).isEmpty()]
    return (state, broken) if broken else (after, [])


@query("u16_transaction_scope", "SELECT 'good' AS attempt, o_orderstatus AS status, CAST(COUNT(*) AS BIGINT) AS n FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_totalprice > 1000) GROUP BY 2 UNION ALL SELECT 'bad', o_orderstatus, COUNT(*) FROM orders GROUP BY 2")
def transaction_scope(t: Tables) -> DataFrame:
    """Two steps that keep the rules are both seen; of two of which the second breaks one, neither is."""
    drop = lambda s: {"orders": s["orders"].where("o_totalprice > 1000")}
    close = lambda s: {"orders": s["orders"].withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")))}
    spoil = lambda s: {"orders": s["orders"].withColumn("o_orderstatus", F.lit(None).cast("string"))}
    checks = {"status": lambda s: s["orders"].where("o_orderstatus IS NULL"), "customer": lambda s: s["orders"].join(s["customer"], F.col("o_custkey") == F.col("c_custkey"), "left_anti")}
    begin = {"orders": t.orders, "customer": t.customer}
    good, _ = transaction(begin, [drop, close], checks)
    bad, _ = transaction(begin, [drop, spoil], checks)
    count = lambda name, s: s["orders"].groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n")).select(F.lit(name).alias("attempt"), "status", "n")
    return count("good", good).unionByName(count("bad", bad))


def publish(df: DataFrame, path: str, version: str) -> str:
    """Write a whole new version beside the old ones; readers move when they are given its folder.

    A failed write leaves the old version as it was: what a transaction is for.
    """
    target = f"{path}/version={version}"
    df.write.mode("errorifexists").parquet(target)
    return target
