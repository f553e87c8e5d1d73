"""Trees in JSON: a flat node table, leaves, pointers, fingerprints, re-assembly and rendering.

A tree is a string, a list of trees, or an object with ``tag``, ``content`` and
other fields. :func:`node_table` walks it once per row; most else is relational
work over that table. What joins nodes of one tree is made in the walk
(:func:`per_tree`), so that nodes aren't shuffled.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType
from pyspark.sql.functions import udtf

from sparkloom.operators.windows import pages
from sparkloom.registry import Tables, query, tasks

NODE = "ordinal int, pointer string, depth int, kind string, tag string, cls string, code string, lang string, selector string, path array<string>, anchors array<string>, field string, hidden boolean, text string"
#: Fields whose strings are no text.
NO_TEXT = frozenset("data href path src lang style tag imageRendering appearance verticalAlign border borderRadius sizeUnits".split())


def escape_token(x: str) -> str:
    return x.replace("~", "~0").replace("/", "~1")


def walk(tree) -> Iterator[tuple]:
    """Rows of :data:`NODE` for a parsed tree, parents before children, in the order of the document.

    ``path`` has the selectors of the objects around a node and its own, ``anchors``
    where these objects are; ``hidden`` nodes are inside a field that holds no text.
    """
    # a stack of its own: trees may be deeper than Python's
    todo = [(tree, "", 0, (), (), None, None, "", False)]
    ordinal = 0
    while todo:
        node, pointer, depth, path, anchors, tag, lang, field, hidden = todo.pop()
        if isinstance(node, list):
            todo += [(x, f"{pointer}/{k}", depth + 1, path, anchors, tag, lang, field, hidden) for k, x in reversed(list(enumerate(node)))]
            continue
        if isinstance(node, dict):
            data = node.get("data") if isinstance(node.get("data"), dict) else {}
            selector = data.get("content") or data.get("class")
            selector = selector if isinstance(selector, str) else None
            if selector:
                path, anchors = (*path, selector), (*anchors, pointer)
            lang, tag = node.get("lang", lang), node.get("tag")
            yield ordinal, pointer, depth, "object", tag, data.get("class"), data.get("code"), lang, selector, list(path), list(anchors), field, hidden, None
            todo += [(node[key], f"{pointer}/{escape_token(key)}", depth + 1, path, anchors, tag, lang, key, hidden or key in NO_TEXT) for key in reversed(node) if key not in ("data", "tag", "lang", "style")]
        else:
            kind = "string" if isinstance(node, str) else "null" if node is None else type(node).__name__
            yield ordinal, pointer, depth, kind, tag, None, None, lang, path[-1] if path else None, list(path), list(anchors), field, hidden, node if isinstance(node, str) else json.dumps(node)
        ordinal += 1


def parsed(raw: str | None):
    """The tree that a JSON text holds; none for text that doesn't parse."""
    try:
        return json.loads(raw) if raw is not None else None
    except (ValueError, RecursionError):
        return None


@udtf(returnType=NODE, useArrow=True)
class NodeTable:
    """Nodes of one JSON text; text that doesn't parse has none."""

    def eval(self, raw: str):
        if (tree := parsed(raw)) is not None:
            yield from walk(tree)


def node_table(rows: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, :data:`NODE`) for the trees in the column ``raw``."""
    spark = rows.sparkSession
    spark.udtf.register("sparkloom_nodes", NodeTable)
    return spark.sql(f"SELECT r.`{key}`, n.* FROM {{rows}} r, LATERAL sparkloom_nodes(r.`{raw}`) n", rows=rows)


def per_tree(rows: DataFrame, key: str, raw: str, made: Callable[[object], Iterable[tuple]], schema: str) -> DataFrame:
    """(key, schema): the rows that ``made`` makes of each tree in the column ``raw``, in one walk and without a join."""
    types = StructType.fromDDL(schema)
    arrow, names = to_arrow_schema(types), [key, *types.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(batch, at, out):
            columns = zip(*out, strict=True) if out else [()] * len(arrow)
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True))], names)

        for batch in batches:
            at, out = [], []
            for k, x in enumerate(batch.column(1)):
                if (tree := parsed(x.as_py())) is not None:
                    out += made(tree)
                    at += [k] * (len(out) - len(at))
                if len(out) >= 10_000:
                    yield packed(batch, at, out)
                    at, out = [], []
            yield packed(batch, at, out)

    return rows.select(key, raw).mapInArrow(run, StructType([rows.schema[key], *types]))


def spread(rows: DataFrame) -> DataFrame:
    """The rows, dealt to as many tasks as a shuffle has: a small file of short rows is one task, however much is made of them."""
    return rows.repartition(tasks(rows.sparkSession))


def trees(t: Tables) -> DataFrame:
    """(p_partkey, raw): an article for each part, as an editor would nest it."""
    q = lambda c: F.to_json(F.struct(F.col(c).alias("x")))
    text = lambda c: F.regexp_extract(q(c), r'^\{"x":(.*)\}$', 1)
    gloss = F.concat(F.lit('{"tag":"ul","data":{"content":"glossary"},"content":['), F.lit('{"tag":"li","content":'), text("p_name"), F.lit('},{"tag":"li","content":'), text("p_type"), F.lit("}]}"))
    label = F.concat(F.lit('{"tag":"span","data":{"class":"tag","code":'), text("p_brand"), F.lit('},"title":"size '), F.col("p_size").cast("string"), F.lit('","content":'), text("p_brand"), F.lit("}"))
    image = F.concat(F.lit('{"tag":"img","path":"media/'), F.col("p_partkey").cast("string"), F.lit('.avif"}'))
    raw = F.concat(F.lit('{"tag":"div","lang":"en","content":['), label, F.lit(","), gloss, F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit(","), image)).otherwise(F.lit("")), F.lit("]}"))
    return spread(t.part).select("p_partkey", raw.alias("raw"))


def nodes(t: Tables) -> DataFrame:
    return node_table(trees(t), "p_partkey", "raw")


@query("n01_node_table", "SELECT p_partkey, CAST(9 + CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 0 END AS BIGINT) AS nodes FROM part")
def count_nodes(t: Tables) -> DataFrame:
    return nodes(t).groupBy("p_partkey").agg(F.count("*").alias("nodes"))


def leaves(table: DataFrame, *, excluded: tuple[str, ...] = (), fields: tuple[str, ...] = ("content", "title")) -> DataFrame:
    """Strings with a Latin letter in the given fields, outside excluded selectors; the role is the nearest selector."""
    kept = table.where(F.col("kind") == "string").where(F.col("field").isin(*fields) & F.col("text").rlike("[A-Za-z]"))
    for selector in excluded:
        kept = kept.where(~F.array_contains("path", selector))
    return kept.withColumn("role", F.coalesce(F.element_at(F.col("path"), F.when(F.size("path") > 0, F.lit(-1))), F.lit("text")))


def pair_with_last(rows: DataFrame, key: str, order: str, kind: str, text: str, asks: str) -> DataFrame:
    """(key, order, asked, answered): each question with what comes right behind it, if that isn't a question too.

    An answer goes to the last question, and only if that has none yet, so it is
    the one that follows; no array of the pairs so far is carried along.
    """
    w = Window.partitionBy(key).orderBy(order)
    n = rows.select(key, order, kind, text, F.lead(kind).over(w).alias("_next"), F.lead(text).over(w).alias("_said"))
    return n.where(F.col(kind) == asks).select(key, order, F.col(text).alias("asked"), F.when(F.col("_next") != asks, F.col("_said")).alias("answered"))


@query("n07_stateful_pairing", "WITH u AS (SELECT conv_id, turn, role, LEAD(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations WHERE role IN ('user', 'assistant')) SELECT conv_id, CAST(COUNT(*) FILTER (role = 'user') AS BIGINT) AS asked, CAST(COUNT(*) FILTER (role = 'user' AND next = 'assistant') AS BIGINT) AS answered FROM u GROUP BY 1")
def stateful_pairing(t: Tables) -> DataFrame:
    c = t.conversations.where("role IN ('user', 'assistant')").withColumn("text", F.coalesce("text", F.lit("")))
    ids = c.select("conv_id").distinct()
    p = pair_with_last(c, "conv_id", "turn", "role", "text", "user").groupBy("conv_id").agg(F.count("*").alias("asked"), F.count("answered").alias("answered"))
    return ids.join(p, "conv_id", "left").na.fill(0)


def pointer_tokens(pointer: str) -> list[str]:
    return [x.replace("~1", "/").replace("~0", "~") for x in pointer.split("/")[1:]]


def pointer_get(tree, pointer: str):
    for x in pointer_tokens(pointer):
        tree = tree[int(x)] if isinstance(tree, list) else tree[x]
    return tree


def pointer_set(tree, pointer: str, value):
    """The tree with another value at a pointer; an empty pointer is the whole tree."""
    parts = pointer_tokens(pointer)
    if not parts:
        return value
    at = tree
    for x in parts[:-1]:
        at = at[int(x)] if isinstance(at, list) else at[x]
    at[int(parts[-1]) if isinstance(at, list) else parts[-1]] = value
    return tree


def canonical(tree) -> str:
    return json.dumps(tree, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


@F.pandas_udf(StringType())
def json_pointer(raw: pd.Series, pointer: pd.Series) -> pd.Series:
    """Canonical JSON of what a pointer leads to; null if it leads nowhere."""

    def one(r: str, p: str) -> str | None:
        try:
            return canonical(pointer_get(json.loads(r), p))
        except (ValueError, KeyError, IndexError, TypeError):
            return None

    return pd.Series([one(r, p) for r, p in zip(raw, pointer, strict=True)])


@query("n08_json_pointer", "SELECT p_partkey, '\"' || p_name || '\"' AS value FROM part")
def pointers(t: Tables) -> DataFrame:
    return trees(t).select("p_partkey", json_pointer("raw", F.lit("/content/1/content/0/content")).alias("value"))


@F.pandas_udf(StringType())
def structural_fingerprint(raw: pd.Series, units: pd.Series) -> pd.Series:
    """Hash of a tree with its units' values masked: the same as long as only those change."""

    def one(r: str, pointers_: list[str]) -> str:
        tree = json.loads(r)
        for p in pointers_:
            tree = pointer_set(tree, p, "\x00unit")
        return hashlib.sha256(canonical(tree).encode()).hexdigest()

    return pd.Series([one(r, list(u)) for r, u in zip(raw, units, strict=True)])


UNITS = ("/content/0/content", "/content/0/title", "/content/1/content/0/content", "/content/1/content/1/content")


@query("n09_structural_fingerprint", "SELECT p_partkey, CAST(COUNT(*) OVER (PARTITION BY CASE WHEN p_partkey % 5 = 0 THEN p_partkey || p_brand ELSE p_brand END) AS BIGINT) AS alike FROM part")
def fingerprint(t: Tables) -> DataFrame:
    """Articles of one brand, without images, differ in units only."""
    f = trees(t).withColumn("f", structural_fingerprint("raw", F.array(*map(F.lit, UNITS))))
    return f.select("p_partkey", F.count("*").over(Window.partitionBy("f")).alias("alike"))


@F.pandas_udf(StringType())
def reassemble(raw: pd.Series, targets: pd.Series) -> pd.Series:
    """The tree with accepted targets (array of struct<pointer, text>) in place and its language changed; outer white space stays."""

    def one(r: str, ts) -> str:
        tree = json.loads(r)
        for x in ts:
            old = pointer_get(tree, x["pointer"])
            lead, tail = old[: len(old) - len(old.lstrip())], old[len(old.rstrip()) :]
            tree = pointer_set(tree, x["pointer"], f"{lead}{x['text']}{tail}")

        def flip(node):
            if isinstance(node, list):
                return [flip(n) for n in node]
            if isinstance(node, dict):
                return {k: "ru" if k == "lang" and v == "en" else flip(v) for k, v in node.items()}
            return node

        return canonical(flip(tree))

    return pd.Series([one(r, list(ts)) for r, ts in zip(raw, targets, strict=True)])


@query("n10_reassembly", "SELECT p_partkey, UPPER(p_name) AS gloss, 'ru' AS lang FROM part")
def reassembled(t: Tables) -> DataFrame:
    units = leaves(nodes(t)).where("pointer = '/content/1/content/0/content'").select("p_partkey", F.struct("pointer", F.upper("text").alias("text")).alias("x"))
    whole = trees(t).join(units.groupBy("p_partkey").agg(F.collect_list("x").alias("targets")), "p_partkey")
    out = whole.select("p_partkey", reassemble("raw", "targets").alias("raw"))
    return out.select("p_partkey", F.get_json_object("raw", "$.content[1].content[0].content").alias("gloss"), F.get_json_object("raw", "$.lang").alias("lang"))


@query("n11_media_paths", "SELECT DISTINCT 'media/' || p_partkey || '.avif' AS path FROM part WHERE p_partkey % 5 = 0")
def media_paths(t: Tables) -> DataFrame:
    return nodes(t).where("field IN ('path', 'src')").where(F.col("text").rlike(r"\.(avif|png|svg|mp3)$")).select(F.col("text").alias("path")).distinct()


RULES = {"brand": ("Brand#1", "Marke#1"), "size": ("size ", "Größe ")}


@query("n12_localised_templates", "SELECT 'brand' AS rule, COUNT(*) AS n FROM part WHERE p_brand LIKE 'Brand#1%' UNION ALL SELECT 'size', COUNT(*) FROM part")
def localised(t: Tables) -> DataFrame:
    """Fixed beginnings of leaves are replaced; counted by rule."""
    rule = None
    for name, (old, _) in RULES.items():
        rule = F.when(F.col("text").startswith(old), name) if rule is None else rule.when(F.col("text").startswith(old), name)
    return leaves(nodes(t)).withColumn("rule", rule).where("rule IS NOT NULL").groupBy("rule").agg(F.count("*").alias("n"))


@query("n13_leaf_classes", "SELECT class, COUNT(*) AS n FROM (SELECT CASE WHEN REGEXP_MATCHES(x, '^Brand#') THEN 'MUST_PRESERVE' WHEN REGEXP_MATCHES(x, '[0-9]') THEN 'REVIEW' ELSE 'MUST_TRANSLATE' END AS class FROM (SELECT p_brand AS x FROM part UNION ALL SELECT 'size ' || p_size FROM part UNION ALL SELECT p_name FROM part UNION ALL SELECT p_type FROM part)) GROUP BY 1")
def leaf_classes(t: Tables) -> DataFrame:
    cls = F.when(F.col("text").rlike("^Brand#"), "MUST_PRESERVE").when(F.col("text").rlike("[0-9]"), "REVIEW").otherwise("MUST_TRANSLATE")
    return leaves(nodes(t)).groupBy(cls.alias("class")).agg(F.count("*").alias("n"))


@query("n14_issue_tokens", "SELECT p_partkey, token, COUNT(*) AS n FROM (SELECT p_partkey, UNNEST(REGEXP_EXTRACT_ALL(p_brand || ' size ' || p_size, '[0-9]+')) AS token FROM part) GROUP BY 1, 2")
def issue_tokens(t: Tables) -> DataFrame:
    l = leaves(nodes(t)).where("role = 'tag'")  # noqa: E741
    return l.select("p_partkey", F.explode(F.regexp_extract_all("text", F.lit("[0-9]+"), 0)).alias("token")).groupBy("p_partkey", "token").agg(F.count("*").alias("n"))


@query("n15_tag_override", "SELECT COUNT(*) AS tags, CAST(COUNT(*) FILTER (p_brand LIKE 'Brand#2%') AS BIGINT) AS replaced FROM part")
def tag_override(t: Tables) -> DataFrame:
    """Labels that differ from the catalog's are replaced, and counted."""
    catalog = t.part.select(F.col("p_brand").alias("code")).distinct().withColumn("label", F.when(F.col("code").startswith("Brand#2"), F.lower("code")).otherwise(F.col("code")))
    tags = nodes(t).where("cls = 'tag'").select("p_partkey", "code").join(catalog, "code", "left")
    return tags.agg(F.count("*").alias("tags"), F.count_if(F.col("label") != F.col("code")).alias("replaced"))


def map_codes(field: Column, labels: Column) -> Column:
    """Space-separated codes mapped to labels; spaces inside a label become no-break ones."""
    parts = F.filter(F.split(field, " "), lambda x: x != "")
    return F.array_join(F.transform(parts, lambda x: F.translate(F.coalesce(F.try_element_at(labels, x), x), " ", " ")), " ")


@query("n16_code_fields", "SELECT p_partkey, ARRAY_TO_STRING([CASE x WHEN 'steel' THEN 'hard' || chr(160) || 'metal' ELSE x END FOR x IN LIST_FILTER(STRING_SPLIT(p_name, ' '), lambda y: y <> '')], ' ') AS mapped FROM part")
def code_fields(t: Tables) -> DataFrame:
    labels = F.create_map(F.lit("steel"), F.lit("hard metal"))
    return t.part.select("p_partkey", map_codes(F.col("p_name"), labels).alias("mapped"))


ALLOWED = frozenset("div span ul ol li p table tr td th img a ruby rt rp br details summary".split())


def render(node, *, xml: bool = False) -> str:
    """A tree as HTML, or as XML with every element closed; tags that aren't allowed become spans."""
    if isinstance(node, list):
        return "".join(render(n, xml=xml) for n in node)
    if not isinstance(node, dict):
        return html.escape(str(node)) if node is not None else ""
    tag = node.get("tag") if node.get("tag") in ALLOWED else "span"
    attrs = {k: node[k] for k in ("lang", "title", "href") if isinstance(node.get(k), str)}
    data = node.get("data") if isinstance(node.get("data"), dict) else {}
    if data.get("class") or data.get("content"):
        attrs["class"] = " ".join(x for x in (data.get("class"), data.get("content")) if x)
    if tag == "img":
        attrs["src"] = node.get("path", "")
    said = "".join(f' {k}="{html.escape(v)}"' for k, v in attrs.items())
    if tag in ("img", "br"):
        return f"<{tag}{said}/>" if xml else f"<{tag}{said}>"
    return f"<{tag}{said}>{render(node.get('content'), xml=xml)}</{tag}>"


def rendered(xml: bool = False):
    @F.pandas_udf("string")
    def run(raw: pd.Series) -> pd.Series:
        return raw.map(lambda r: render(json.loads(r), xml=xml))

    return run


@query("n17_rendering", "SELECT p_partkey, '<div lang=\"en\"><span title=\"size ' || p_size || '\" class=\"tag\">' || p_brand || '</span><ul class=\"glossary\"><li>' || p_name || '</li><li>' || p_type || '</li></ul>' || CASE WHEN p_partkey % 5 = 0 THEN '<img src=\"media/' || p_partkey || '.avif\">' ELSE '' END || '</div>' AS html FROM part")
def rendering(t: Tables) -> DataFrame:
    return trees(t).select("p_partkey", rendered()("raw").alias("html"))


@query("n18_target_leaves", "SELECT o_custkey, '/' || (ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) AS pointer, o_orderpriority AS text FROM orders")
def target_leaves(t: Tables) -> DataFrame:
    """An array target has a leaf for each element, a scalar one an empty pointer."""
    g = t.orders.groupBy("o_custkey").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))), lambda x: x["o_orderpriority"])).alias("target"))
    flat = g.select("o_custkey", F.posexplode(F.from_json("target", "array<string>")).alias("k", "text"))
    return flat.select("o_custkey", F.concat(F.lit("/"), F.col("k").cast("string")).alias("pointer"), "text")


@query("n19_array_dedupe", "WITH w AS (SELECT p_partkey, UNNEST(STRING_SPLIT(p_name || ' ' || p_name, ' ')) AS x, GENERATE_SUBSCRIPTS(STRING_SPLIT(p_name || ' ' || p_name, ' '), 1) AS i FROM part), f AS (SELECT p_partkey, x, MIN(i) AS i FROM w GROUP BY 1, 2) SELECT p_partkey, STRING_AGG(x, ' ' ORDER BY i) AS words FROM f GROUP BY 1")
def array_dedupe(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(F.array_distinct(F.split(F.concat_ws(" ", "p_name", "p_name"), " ")), " ").alias("words"))


@query("n20_array_checks", "WITH g AS (SELECT o_custkey, LIST(o_orderstatus) AS x FROM orders GROUP BY 1) SELECT o_custkey, LEN(x) BETWEEN 1 AND 12 AS size_ok, LEN(LIST_DISTINCT(x)) = LEN(x) AS unique_items, LIST_CONTAINS(x, 'P') AS has_p FROM g")
def array_checks(t: Tables) -> DataFrame:
    g = t.orders.groupBy("o_custkey").agg(F.collect_list("o_orderstatus").alias("x"))
    return g.select("o_custkey", F.size("x").between(1, 12).alias("size_ok"), (F.size(F.array_distinct("x")) == F.size("x")).alias("unique_items"), F.array_contains("x", "P").alias("has_p"))


@query("n21_batched_nesting", "WITH n AS (SELECT c_custkey, c_nationkey, (ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 10 AS batch FROM customer) SELECT c_nationkey, batch, COUNT(*) AS notes, STRING_AGG(c_custkey::VARCHAR, ',' ORDER BY c_custkey) AS members FROM n GROUP BY 1, 2")
def batched_nesting(t: Tables) -> DataFrame:
    n = pages(t.customer, 10, "c_custkey", by="c_nationkey")
    g = n.groupBy("c_nationkey", F.col("page").alias("batch")).agg(F.array_sort(F.collect_list("c_custkey")).alias("x"))
    return g.select("c_nationkey", "batch", F.size("x").cast("long").alias("notes"), F.array_join(F.transform("x", lambda v: v.cast("string")), ",").alias("members"))


@query("n22_envelope_assembly", """SELECT o_orderkey, SHA256('{"article":' || o_orderkey || ',"units":[' || STRING_AGG('{"line":' || l_linenumber || ',"part":' || l_partkey || '}', ',' ORDER BY l_linenumber, l_partkey, l_suppkey) || ']}') AS sha256 FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def envelope(t: Tables) -> DataFrame:
    units = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: F.struct(x["l_linenumber"].alias("line"), x["l_partkey"].alias("part"))).alias("units"))
    j = t.orders.join(units, "o_orderkey")
    return j.select("o_orderkey", F.sha2(F.to_json(F.struct(F.col("o_orderkey").alias("article"), "units")), 256).alias("sha256"))


@query("n23_parent_terminology", "SELECT p_partkey, p_name AS text, '/content/1/content/0' AS parent FROM part")
def parent_terminology(t: Tables) -> DataFrame:
    """A leaf and the node around it, joined by the parent part of its pointer."""
    n = nodes(t)
    inner = n.where("pointer = '/content/1/content/0/content'").select("p_partkey", "text", F.regexp_replace("pointer", "/[^/]*$", "").alias("parent"))
    outer = n.where("kind = 'object'").select("p_partkey", F.col("pointer").alias("parent"))
    return inner.join(outer, ["p_partkey", "parent"]).select("p_partkey", "text", "parent")


@query("n24_key_whitelist", "SELECT event_id, event_id % 5 <> 0 AS exact FROM events")
def key_whitelist(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_id") % 5 == 0, '{"b":1,"a":2,"c":3}').otherwise('{"b":1,"a":2}')
    return t.events.select("event_id", (F.array_sort(F.json_object_keys(raw)) == F.array(F.lit("a"), F.lit("b"))).alias("exact"))


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """Violations of a small part of JSON Schema: type, required, properties, additionalProperties, items, const, enum."""
    kinds = {"object": dict, "array": list, "string": str, "integer": int, "number": (int, float), "boolean": bool, "null": type(None)}
    out = []
    want = schema.get("type")
    if want and (not isinstance(value, kinds[want]) or want in ("integer", "number") and isinstance(value, bool)):
        return [f"{at}: not {want}"]
    if "const" in schema and value != schema["const"]:
        out.append(f"{at}: not the constant")
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in the enumeration")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unexpected" for k in sorted(set(value) - set(known))]
        for k in sorted(set(value) & set(known)):
            out += schema_errors(value[k], known[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for k, x in enumerate(value):
            out += schema_errors(x, schema["items"], f"{at}[{k}]")
    return out


def schema_check(schema: dict):
    """UDF: the first violation of a JSON text, or null."""

    @F.pandas_udf("string")
    def run(raw: pd.Series) -> pd.Series:
        def one(r: str) -> str | None:
            try:
                return next(iter(schema_errors(json.loads(r), schema)), None)
            except ValueError:
                return "$: not JSON"

        return raw.map(one)

    return run


@query("n25_schema_validation", "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '$.k: not integer' END AS violation FROM events")
def schema_validation(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_id") % 9 == 0, '{"k":"x"}').otherwise(F.col("props"))
    check = schema_check({"type": "object", "required": ["k"], "properties": {"k": {"type": "integer"}}, "additionalProperties": False})
    return t.events.select("event_id", check(raw).alias("violation"))


@query("n26_two_sided_coverage", "SELECT COALESCE(n.n_nationkey, s.s_nationkey) AS code, CASE WHEN n.n_nationkey IS NULL THEN 'unknown' WHEN s.s_nationkey IS NULL THEN 'missing' ELSE 'ok' END AS state FROM nation n FULL JOIN (SELECT DISTINCT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0) s ON n.n_nationkey = s.s_nationkey")
def two_sided_coverage(t: Tables) -> DataFrame:
    used = t.supplier.where("s_suppkey % 3 = 0").select("s_nationkey").distinct()
    j = t.nation.join(used, F.col("n_nationkey") == F.col("s_nationkey"), "full_outer")
    return j.select(F.coalesce("n_nationkey", "s_nationkey").alias("code"), F.when(F.col("n_nationkey").isNull(), "unknown").when(F.col("s_nationkey").isNull(), "missing").otherwise("ok").alias("state"))


@query("n27_target_normalisation", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '[\"' || p_name || '\"]' ELSE p_name END AS stored FROM part")
def target_normalisation(t: Tables) -> DataFrame:
    """A glossary is stored as a JSON array, a scalar as its string; by the variant's type."""
    raw = F.when(F.col("p_partkey") % 2 == 0, F.to_json(F.array("p_name"))).otherwise(F.regexp_extract(F.to_json(F.struct(F.col("p_name").alias("x"))), r'^\{"x":(.*)\}$', 1))
    v = F.try_parse_json(raw)
    stored = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))
    return t.part.select("p_partkey", stored.alias("stored"))


@query("n29_grouped_assembly", "WITH w AS (SELECT STRING_SPLIT(p_name, ' ')[1] AS head, p_partkey, p_type FROM part) SELECT head, SHA256('<h1>' || head || '</h1>' || STRING_AGG('<p>' || p_type || '</p>', '' ORDER BY p_partkey)) AS sha256 FROM w GROUP BY 1")
def grouped_assembly(t: Tables) -> DataFrame:
    g = t.part.groupBy(F.split("p_name", " ")[0].alias("head")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_type"))).alias("x"))
    body = F.array_join(F.transform("x", lambda x: F.concat(F.lit("<p>"), x["p_type"], F.lit("</p>"))), "")
    return g.select("head", F.sha2(F.concat(F.lit("<h1>"), "head", F.lit("</h1>"), body), 256).alias("sha256"))


@query("n30_output_schema", """SELECT conv_id, '{"const":[' || STRING_AGG(turn::VARCHAR, ',' ORDER BY turn) || ']}' AS schema FROM conversations GROUP BY 1""")
def output_schema(t: Tables) -> DataFrame:
    g = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("const"))
    return g.select("conv_id", F.to_json(F.struct("const")).alias("schema"))


TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)")


@udtf(returnType="tag string, depth int, ordinal int", useArrow=True)
class HtmlTags:
    """Start tags of a page in order, with the number of open ones."""

    def eval(self, source: str):
        depth = k = 0
        for m in TAG.finditer(source or ""):
            if m[1]:
                depth = max(0, depth - 1)
            else:
                yield m[2].lower(), depth, k
                k += 1
                depth += m[2].lower() not in ("br", "img", "meta", "link", "input", "hr")
