"""Joins: dictionary matches with precedence, semi, anti, division, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.registry import Tables, query, tasks


def match_terms(terms: DataFrame, entries: DataFrame, *, term: str = "term", entry: str = "entry", keys: tuple[tuple[str, str], ...] = (("expression", "expression"), ("reading", "reading"))) -> DataFrame:
    """(term, entry, kind): entries that a term matches by one of the key columns.

    ``keys`` are (kind, column); an entry that matches by several keeps the kind
    that sorts first. Each key is an equi-join, so nothing is broadcast by hand.
    """
    hits = None
    for kind, col in keys:
        one = terms.select(term).distinct().join(entries.select(F.col(col).alias(term), F.col(entry)), term).withColumn("kind", F.lit(kind))
        hits = one if hits is None else hits.unionByName(one)
    return hits.groupBy(term, entry).agg(F.min("kind").alias("kind"))


#: Rows of a key in a cell: the array that a left row meets, and the left rows that meet it.
CELL, MEETING = 1024, 8192


def dealt_join(left: DataFrame, right: DataFrame, on: list[str], value: str, condition: Column | None = None) -> DataFrame:
    """An inner join on ``on`` whose keys may all be very common; ``condition`` may use all columns but ``value``, of the right.

    The pairs of a key are dealt in a grid of cells, by hashes of ``value`` and of
    left rows. A cell has its values in arrays, so a pair costs no more than its
    row. Only common keys, with over CELL rows each, are broadcast, with their counts.
    """
    sides = {"left": left.dropna(subset=on), "right": right.dropna(subset=on)}
    for side, rows, most in (("left", sides["left"], MEETING), ("right", sides["right"], CELL)):
        cells = F.ceil(F.col("count") / most).cast("int")
        common = rows.groupBy(*on).count().where(F.col("count") > most).select(*on, cells.alias(f"_{side}_cells"))
        sides = {k: x.join(F.broadcast(common), on, "left").na.fill(1, [f"_{side}_cells"]) for k, x in sides.items()}
    place = lambda side, *cols: F.pmod(F.xxhash64(*cols), F.col(f"_{side}_cells")).cast("int").alias(f"_{side}")
    each = lambda side: F.explode(F.sequence(F.lit(0), F.col(f"_{side}_cells") - 1)).alias(f"_{side}")
    keys, n = [*on, "_left", "_right"], tasks(left.sparkSession)
    mine = sides["left"].select(*left.columns, place("left", *left.columns), each("right")).repartition(n, *keys)
    own = [c for c in right.columns if c != value]
    values = F.transform(F.collect_list(F.struct(value)), lambda x: x[value]).alias("_values")
    cells = sides["right"].select(*right.columns, "_left_cells", place("right", value)).groupBy(*own, "_left_cells", "_right").agg(values)
    theirs = cells.select(*own, "_right", "_values", each("left")).repartition(n, *keys)
    met = mine.join(theirs.hint("merge"), keys)
    met = met if condition is None else met.where(condition)
    return met.select(*left.columns, *(c for c in own if c not in on), F.explode("_values").alias(value))


def words_of(t: Tables) -> DataFrame:
    """Part names as headwords: expression is the first word, reading the last one."""
    return t.part.select(F.col("p_partkey").alias("entry"), F.element_at(F.split("p_name", " "), 1).alias("expression"), F.element_at(F.split("p_name", " "), -1).alias("reading"))


WORDS = "entries AS (SELECT p_partkey AS entry, STRING_SPLIT(p_name, ' ')[1] AS expression, STRING_SPLIT(p_name, ' ')[-1] AS reading FROM part)"
TERMS = "terms AS (SELECT DISTINCT expression AS term FROM entries UNION SELECT DISTINCT reading FROM entries WHERE entry % 3 = 0)"


def terms_of(t: Tables) -> DataFrame:
    w = words_of(t)
    return w.select(F.col("expression").alias("term")).union(w.where("entry % 3 = 0").select("reading")).distinct()


@query("j01_expression_reading_match", f"WITH {WORDS}, {TERMS} SELECT term, entry, MIN(kind) AS kind FROM (SELECT term, entry, 'expression' AS kind FROM terms JOIN entries ON expression = term UNION ALL SELECT term, entry, 'reading' FROM terms JOIN entries ON reading = term) GROUP BY term, entry")
def two_key_match(t: Tables) -> DataFrame:
    return match_terms(terms_of(t), words_of(t))


@query("j02_candidate_generation", f"WITH {WORDS}, notes AS (SELECT s_suppkey AS note, CASE s_suppkey % 3 WHEN 0 THEN [] WHEN 1 THEN ['steel', 'brass', 'widget'] ELSE ['none'] END AS variants, (SELECT expression FROM entries WHERE entry = s_suppkey + 1) AS word FROM supplier) SELECT note, entry FROM notes JOIN entries ON word = expression WHERE LEN(variants) = 0 OR LIST_CONTAINS(variants, reading)")
def candidates(t: Tables) -> DataFrame:
    """A note without variants meets all entries of its word, another one those whose reading is a variant."""
    w = words_of(t)
    variants = F.when(F.col("s_suppkey") % 3 == 0, F.array().cast("array<string>")).when(F.col("s_suppkey") % 3 == 1, F.array(F.lit("steel"), F.lit("brass"), F.lit("widget"))).otherwise(F.array(F.lit("none")))
    notes = t.supplier.select(F.col("s_suppkey").alias("note"), variants.alias("variants"), (F.col("s_suppkey") + 1).alias("at")).join(w.select(F.col("entry").alias("at"), F.col("expression").alias("word")).hint("merge"), "at")
    free = dealt_join(notes.where(F.size("variants") == 0).select("note", F.col("word").alias("expression")), w.select("expression", "entry"), ["expression"], "entry")
    said = notes.select("note", F.col("word").alias("expression"), F.explode(F.array_distinct("variants")).alias("reading"))
    return free.select("note", "entry").unionByName(dealt_join(said, w, ["expression", "reading"], "entry").select("note", "entry"))


@query("j03_variant_fallback", f"WITH {WORDS}, notes AS (SELECT p_partkey AS note, STRING_SPLIT(p_name, ' ') AS variants FROM part), hits AS (SELECT note, entry, 'expression' AS kind FROM notes JOIN entries ON expression = variants[1] UNION ALL SELECT note, entry, 'reading' FROM (SELECT note, UNNEST(variants) AS v FROM notes) JOIN entries ON reading = v) SELECT note, entry, MIN(kind) AS kind FROM hits GROUP BY note, entry")
def variant_fallback(t: Tables) -> DataFrame:
    """All parts are notes, and entries.

    A pair's kind shows in the pair itself, so the many pairs (keys are unique) aren't grouped.
    """
    w = words_of(t)
    notes = t.part.select(F.col("p_partkey").alias("note"), F.split("p_name", " ").alias("variants"))
    first = dealt_join(notes.select("note", F.col("variants")[0].alias("expression")), w.select("expression", "entry"), ["expression"], "entry").select("note", "entry", F.lit("expression").alias("kind"))
    said = notes.select("note", F.col("variants")[0].alias("head"), F.explode(F.array_distinct("variants")).alias("reading"))
    other = dealt_join(said, w, ["reading"], "entry", F.col("head") != F.col("expression"))
    return first.unionByName(other.select("note", "entry", F.lit("reading").alias("kind")))


@query("j04_four_column_join", "SELECT a.l_orderkey, a.l_partkey, COUNT(*) AS pairs FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag GROUP BY 1, 2")
def reuse_join(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"]
    return t.lineitem.select(keys).join(t.lineitem.select(keys), keys).groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("pairs"))


@query("j05_join_chain", "SELECT r_name, n_name, COUNT(*) AS n_lines, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def join_chain(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    buyers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(buyers, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name", "n_name").agg(F.count("*").alias("n_lines"), F.sum("l_quantity").cast("long").alias("quantity"))


@query("j06_left_join_aggregate", "SELECT o_orderkey, COUNT(l_orderkey) AS units, CAST(COALESCE(SUM(l_quantity), 0) AS BIGINT) AS bytes FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def left_join_aggregate(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("units"), F.sum("l_quantity").cast("long").alias("bytes"))
    return t.orders.join(per, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", F.coalesce("units", F.lit(0)).alias("units"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


@query("j07_left_join_is_null", "SELECT o_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL")
def anti_by_null(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey")


@query("j08_not_exists", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def not_exists(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_orderstatus = 'P'"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


def for_all(groups: DataFrame, members: DataFrame, passing: DataFrame, *, group: str, member: str) -> DataFrame:
    """Groups all of whose members are in ``passing``; a group without members passes."""
    open_ = members.join(passing.select(member).distinct(), member, "left_anti").select(group)
    return groups.join(open_, group, "left_anti")


@query("j09_relational_division", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F'))")
def division(t: Tables) -> DataFrame:
    groups, members = t.customer.select("c_custkey"), t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("k"))
    return for_all(groups, members, t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("k")), group="c_custkey", member="k")


@query("j10_exists", "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def exists(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.where("l_returnflag = 'R'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("o_orderkey")


@query("j11_or_of_exists", "SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F') OR EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING') AS complete FROM orders")
def or_of_exists(t: Tables) -> DataFrame:
    done = t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("k")).distinct().withColumn("a", F.lit(True))
    safe = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("c")).distinct().withColumn("b", F.lit(True))
    out = t.orders.join(done, F.col("o_orderkey") == F.col("k"), "left").join(safe, F.col("o_custkey") == F.col("c"), "left")
    return out.select("o_orderkey", (F.coalesce("a", F.lit(False)) | F.coalesce("b", F.lit(False))).alias("complete"))


@query("j12_in_subquery", "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)")
def in_subquery(t: Tables) -> DataFrame:
    return t.part.join(t.lineitem.where("l_quantity >= 50"), F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_name")


@query("j13_scalar_subquery", "SELECT o_orderkey FROM orders WHERE (SELECT COUNT(*) FROM lineitem WHERE l_orderkey = o_orderkey) <> (SELECT COUNT(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')")
def scalar_subquery(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("f"))
    out = t.orders.join(per, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return out.where(F.coalesce("n", F.lit(0)) != F.coalesce("f", F.lit(0))).select("o_orderkey")


@query("j14_top_one_join", "SELECT c_custkey, o_orderkey AS best_order FROM customer JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F')::INT DESC, o_orderkey DESC) AS rn FROM orders) ON o_custkey = c_custkey AND rn = 1")
def top_one(t: Tables) -> DataFrame:
    best = t.orders.groupBy("o_custkey").agg(F.max(F.struct((F.col("o_orderstatus") == "F").alias("f"), "o_orderkey")).alias("b"))
    return t.customer.join(best, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", F.col("b.o_orderkey").alias("best_order"))


@query("j15_lookup_with_fallback", f"WITH {WORDS}, single AS (SELECT reading, MIN(entry) AS e2 FROM entries GROUP BY 1 HAVING COUNT(*) = 1), exact AS (SELECT expression, reading, MIN(entry) AS e1 FROM entries WHERE entry % 2 = 0 GROUP BY 1, 2) SELECT w.entry, COALESCE(e1, e2) AS found FROM entries w LEFT JOIN exact x ON x.expression = w.expression AND x.reading = w.reading LEFT JOIN single s ON s.reading = w.reading")
def lookup_with_fallback(t: Tables) -> DataFrame:
    w = words_of(t)
    single = w.groupBy("reading").agg(F.min("entry").alias("e2"), F.count("*").alias("n")).where("n = 1").drop("n")
    exact = w.where("entry % 2 = 0").groupBy("expression", "reading").agg(F.min("entry").alias("e1"))
    return w.join(exact, ["expression", "reading"], "left").join(single, "reading", "left").select("entry", F.coalesce("e1", "e2").alias("found"))


@query("j16_snapshot_difference", "WITH added AS (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) SELECT o_orderkey, (SELECT COUNT(*) FROM added) AS added_total FROM added ORDER BY o_orderdate, o_orderkey LIMIT 100")
def snapshot_difference(t: Tables) -> DataFrame:
    old = t.orders.where("o_orderstatus = 'F'").select("o_custkey")
    added = t.orders.where("o_orderstatus <> 'F'").join(old, "o_custkey", "left_anti")
    total = added.agg(F.count("*").alias("added_total"))
    return added.orderBy("o_orderdate", "o_orderkey").limit(100).crossJoin(F.broadcast(total)).select("o_orderkey", "added_total")


@query("j17_membership_difference", "SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A') ORDER BY l_orderkey LIMIT 500")
def membership_difference(t: Tables) -> DataFrame:
    a, b = (t.lineitem.where(F.col("l_returnflag") == f).select("l_orderkey").distinct() for f in "RA")
    return a.join(b, "l_orderkey", "left_anti").orderBy("l_orderkey").limit(500)


@query("j18_code_lookup", "SELECT s_suppkey, n_name AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def code_lookup(t: Tables) -> DataFrame:
    """A code without a label is an error, not a missing row."""
    out = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return out.select("s_suppkey", F.when(F.col("n_name").isNotNull(), F.col("n_name")).otherwise(F.raise_error(F.concat(F.lit("unknown code "), F.col("s_nationkey").cast("string")))).alias("label"))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys only in ``left`` (missing), only in ``right`` (extra), and whether both are none."""
    both = left.select(keys).distinct().withColumn("_l", F.lit(1)).join(right.select(keys).distinct().withColumn("_r", F.lit(1)), keys, "full_outer")
    return both.agg(F.count_if(F.expr("_r is null")).alias("missing"), F.count_if(F.expr("_l is null")).alias("extra")).withColumn("passed", F.expr("missing = 0 and extra = 0"))


@query("j19_two_sided_reconciliation", "WITH a AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'), m AS (SELECT COUNT(*) AS missing FROM (FROM a EXCEPT FROM b)), e AS (SELECT COUNT(*) AS extra FROM (FROM b EXCEPT FROM a)) SELECT missing, extra, missing = 0 AND extra = 0 AS passed FROM m, e")
def two_sided(t: Tables) -> DataFrame:
    return reconcile(t.lineitem.where("l_returnflag = 'R'"), t.lineitem.where("l_returnflag = 'A'"), ["l_partkey", "l_suppkey"])


@query("j20_attempt_match", "WITH a AS (SELECT conv_id, MIN(turn) AS t FROM conversations GROUP BY 1), b AS (SELECT c_custkey AS conv_id, MIN(c_custkey % 2) AS t FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1) SELECT COALESCE(a.conv_id, b.conv_id) AS custom_id, CASE WHEN b.conv_id IS NULL THEN 'missing' WHEN a.conv_id IS NULL THEN 'unknown' WHEN a.t = b.t THEN 'replay' ELSE 'conflict' END AS outcome FROM a FULL JOIN b ON a.conv_id = b.conv_id")
def attempt_match(t: Tables) -> DataFrame:
    a = t.conversations.groupBy("conv_id").agg(F.min("turn").alias("ta"))
    b = t.customer.where("c_custkey % 3 <> 0").groupBy(F.col("c_custkey").alias("id")).agg(F.min(F.col("c_custkey") % 2).alias("tb"))
    out = a.join(b, F.col("conv_id") == F.col("id"), "full_outer")
    kind = F.when(F.col("id").isNull(), "missing").when(F.col("conv_id").isNull(), "unknown").when(F.col("ta") == F.col("tb"), "replay").otherwise("conflict")
    return out.select(F.coalesce("conv_id", "id").alias("custom_id"), kind.alias("outcome"))


@query("j21_positional_join", "WITH a AS (SELECT conv_id, turn, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, role FROM conversations WHERE role = 'user'), b AS (SELECT conv_id, turn, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, role FROM conversations WHERE role <> 'user') SELECT COALESCE(a.conv_id, b.conv_id) AS conv_id, COALESCE(a.pos, b.pos) AS pos, a.turn AS asked, b.turn AS answered FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.pos = b.pos")
def positional_join(t: Tables) -> DataFrame:
    def numbered(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("x")).select("conv_id", F.posexplode("x").alias("p", name)).select("conv_id", (F.col("p") + 1).cast("long").alias("pos"), name)

    c = t.conversations
    return numbered(c.where("role = 'user'"), "asked").join(numbered(c.where("role <> 'user'"), "answered"), ["conv_id", "pos"], "full_outer")


@query("j22_run_self_join", "SELECT a.o_orderkey AS old_order, b.o_orderkey AS new_order FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderpriority = b.o_orderpriority WHERE a.o_orderstatus = 'F' AND b.o_orderstatus = 'P'")
def run_self_join(t: Tables) -> DataFrame:
    a = t.orders.where("o_orderstatus = 'F'").select("o_custkey", "o_orderpriority", F.col("o_orderkey").alias("old_order"))
    b = t.orders.where("o_orderstatus = 'P'").select("o_custkey", "o_orderpriority", F.col("o_orderkey").alias("new_order"))
    return a.join(b, ["o_custkey", "o_orderpriority"]).select("old_order", "new_order")


@query("j23_ordered_collect", "SELECT o_orderkey, STRING_AGG(l_linenumber::VARCHAR || ':' || l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS units, BOOL_AND(l_linestatus = 'F') AS complete FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def ordered_collect(t: Tables) -> DataFrame:
    j = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    items = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    out = j.groupBy("o_orderkey").agg(items.alias("i"), F.every(F.col("l_linestatus") == "F").alias("complete"))
    return out.select("o_orderkey", F.array_join(F.transform("i", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))), ",").alias("units"), "complete")


@query("j24_unresolved_candidates", "SELECT c_custkey, COALESCE(STRING_AGG(n_name, ',' ORDER BY n_name), '') AS candidates FROM customer LEFT JOIN nation ON n_regionkey = c_nationkey % 5 AND n_nationkey <> c_nationkey WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1")
def unresolved(t: Tables) -> DataFrame:
    open_ = t.customer.join(t.orders.where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_nationkey", (F.col("c_nationkey") % 5).alias("r"))
    met = open_.join(t.nation, (F.col("n_regionkey") == F.col("r")) & (F.col("n_nationkey") != F.col("c_nationkey")), "left")
    return met.groupBy("c_custkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("candidates"))


