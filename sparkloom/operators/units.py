"""Units of nested articles: leaves by role, glossary sets, visible text, senses and their inventory.

A string knows the selectors around it and where they are, so the visible text of
any element is a group of strings, in document order, whose way from that element
leads through ``content`` fields alone. Leaves are relational work over the node
table; sets and senses, which join nodes of one article, are made in its walk.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.nested import node_table, per_tree, spread, walk
from sparkloom.registry import Tables, query

#: The role of text by the selector around it, and the selectors whose text is no unit.
ROLES = {
    "glossary": "glossary", "example-sentence-b": "example", "part-of-speech-info": "pos",
    "misc-info": "register", "field-info": "label", "dialect-info": "register",
    "sense-note": "note", "info-gloss": "note", "xref": "xref_gloss", "antonym": "xref_gloss",
    "forms": "label", "lang-source": "note",
}
EXCLUDED = ("example-sentence-a", "attribution", "attribution-footnote", "redirect", "ruby", "rt")
SENSE_LABELS = ("part-of-speech-info", "misc-info", "field-info", "dialect-info", "sense-note", "info-gloss")
INVENTORY = ("forms", "example-sentence-a", "xref", "antonym", "sense-note", "lang-source", "attribution")
LATIN = "[A-Za-z]"
CONTENT_ONLY = r"^(/content|/[0-9]+)*$"

#: An article for each part: up to 14 glosses, half of them inside an element without a role, examples in
#: unequal numbers, tooltips, an element that is excluded and one without a Latin letter.
ARTICLE = """'{"tag":"div","lang":"en","content":[{"tag":"span","data":{"content":"part-of-speech-info"},"title":"size ' || p_size || '","content":"' || p_brand || '"},{"tag":"div","data":{"content":"sense"},"content":[{"tag":"ul","data":{"content":"glossary"},"content":['
 || ARRAY_JOIN(TRANSFORM(SEQUENCE(0, p_partkey % 14), k -> CASE WHEN k % 2 = 0 THEN '{"tag":"li","content":"  ' || p_name || ' ' || k || ' "}' ELSE '{"tag":"li","data":{"content":"highlight"},"content":["' || p_name || '",{"tag":"b","content":"' || k || 'th"}]}' END), ',')
 || ']},{"tag":"div","data":{"content":"example-sentence-a"},"content":"文 x' || p_size || '"},{"tag":"div","data":{"content":"example-sentence-b"},"content":"Example ' || p_size || '"}'
 || CASE WHEN p_partkey % 2 = 0 THEN ',{"tag":"div","data":{"content":"example-sentence-a"},"content":"二"}' ELSE '' END
 || ']},{"tag":"div","data":{"content":"sense"},"content":[{"tag":"p","data":{"content":"glossary"},"content":"' || p_type || '"},{"tag":"span","data":{"content":"sense-note"},"title":"see note","content":["note ",{"tag":"img","path":"media/note.avif","title":"2"}]}]},{"tag":"div","data":{"content":"attribution"},"content":"Source text"},{"tag":"div","data":{"content":"forms"},"content":"1 2 3"}]}'"""


def articles(t: Tables) -> DataFrame:
    return spread(t.part).select("p_partkey", F.expr(ARTICLE).alias("raw"))


def article_nodes(t: Tables) -> DataFrame:
    return node_table(articles(t), "p_partkey", "raw")


def role_of(path: Column) -> Column:
    """The role of the nearest selector that has one."""
    roles = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    return F.element_at(F.filter(F.transform(path, lambda s: F.try_element_at(roles, s)), lambda r: r.isNotNull()), -1)


def has_role(path: Column) -> Column:
    return F.exists(path, lambda s: s.isin(*ROLES)) & ~F.exists(path, lambda s: s.isin(*EXCLUDED))


def scalar_units(nodes: DataFrame) -> DataFrame:
    """Strings with a Latin letter that have a role, outside excluded elements; a title is a tooltip."""
    some = nodes.where((F.col("kind") == "string") & ~F.col("hidden") & has_role(F.col("path"))).withColumn("text", F.trim("text")).where(F.col("text").rlike(LATIN))
    return some.withColumn("role", F.when(F.col("pointer").endswith("/title"), "tooltip").otherwise(role_of(F.col("path"))))


#: Ways through content alone, and the item of the content list that one begins with.
WAY, ITEM = re.compile("(?:/content|/[0-9]+)*"), re.compile("/content/([0-9]+)")


def shown_in(nodes: list[tuple]) -> dict[str, list[str]]:
    """What each element with a selector shows, by where it is: a text for each item of its content list, in order."""
    shown: dict[str, dict[str, list[str]]] = {}
    for _, pointer, _, kind, *_, anchors, _, _, text in nodes:
        if kind == "string" and (text := text.strip(" ")):
            for anchor in anchors:
                if WAY.fullmatch(pointer, len(anchor)):
                    item = ITEM.match(pointer, len(anchor))
                    shown.setdefault(anchor, {}).setdefault(item[1] if item else "", []).append(text)
    return {anchor: [" ".join(x) for x in items.values()] for anchor, items in shown.items()}


def in_order(order: str, text: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text])


def units_of(tree) -> Iterator[tuple]:
    """Rows (ordinal, pointer, role, text) of a parsed tree."""
    nodes = list(walk(tree))
    shown = shown_in(nodes)
    for ordinal, pointer, _, kind, _, _, _, _, selector, path, _, _, hidden, text in nodes:
        if ROLES.keys().isdisjoint(path) or not set(EXCLUDED).isdisjoint(path):
            continue
        if kind == "object":
            items = shown.get(pointer, [])
            if selector == "glossary" and path.count("glossary") == 1 and any(re.search(LATIN, x) for x in items):
                yield ordinal, f"{pointer}/content", "glossary_set", " | ".join(items)
        elif kind == "string" and not hidden and "glossary" not in path and re.search(LATIN, text):
            role = "tooltip" if pointer.endswith("/title") else next(ROLES[s] for s in reversed(path) if s in ROLES)
            yield ordinal, pointer, role, text.strip(" ")


def lexicographic_units(rows: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, ordinal, pointer, role, text): an outermost glossary is one unit of its items, other leaves are scalar units."""
    return per_tree(rows, key, raw, units_of, "ordinal int, pointer string, role string, text string")


GLOSS = "SELECT p_partkey, UNNEST(RANGE(0, p_partkey % 14 + 1)) AS k, p_name FROM part"


@query("n02_leaf_extraction", f"""WITH g AS ({GLOSS}) SELECT p_partkey, '/content/0/title' AS pointer, 'tooltip' AS role, 'size ' || p_size AS text FROM part UNION ALL SELECT p_partkey, '/content/0/content', 'pos', p_brand FROM part
UNION ALL SELECT p_partkey, '/content/1/content/0/content/' || k || '/content', 'glossary', p_name || ' ' || k FROM g WHERE k % 2 = 0
UNION ALL SELECT p_partkey, '/content/1/content/0/content/' || k || '/content/0', 'glossary', p_name FROM g WHERE k % 2 = 1 UNION ALL SELECT p_partkey, '/content/1/content/0/content/' || k || '/content/1/content', 'glossary', k || 'th' FROM g WHERE k % 2 = 1
UNION ALL SELECT p_partkey, '/content/1/content/2/content', 'example', 'Example ' || p_size FROM part UNION ALL SELECT p_partkey, '/content/2/content/0/content', 'glossary', p_type FROM part
UNION ALL SELECT p_partkey, '/content/2/content/1/title', 'tooltip', 'see note' FROM part UNION ALL SELECT p_partkey, '/content/2/content/1/content/0', 'note', 'note' FROM part""")
def leaf_extraction(t: Tables) -> DataFrame:
    return scalar_units(article_nodes(t)).select("p_partkey", "pointer", "role", "text")


GLOSS_TEXT = "CASE WHEN k % 2 = 0 THEN p_name || ' ' || k ELSE p_name || ' ' || k || 'th' END"


@query("n03_glossary_sets", f"""WITH g AS ({GLOSS}) SELECT p_partkey, '/content/1/content/0/content' AS pointer, 'glossary_set' AS role, STRING_AGG({GLOSS_TEXT}, ' | ' ORDER BY k) AS text FROM g GROUP BY 1
UNION ALL SELECT p_partkey, '/content/2/content/0/content', 'glossary_set', p_type FROM part UNION ALL SELECT p_partkey, '/content/0/title', 'tooltip', 'size ' || p_size FROM part UNION ALL SELECT p_partkey, '/content/0/content', 'pos', p_brand FROM part
UNION ALL SELECT p_partkey, '/content/1/content/2/content', 'example', 'Example ' || p_size FROM part UNION ALL SELECT p_partkey, '/content/2/content/1/title', 'tooltip', 'see note' FROM part UNION ALL SELECT p_partkey, '/content/2/content/1/content/0', 'note', 'note' FROM part""")
def glossary_sets(t: Tables) -> DataFrame:
    return lexicographic_units(articles(t), "p_partkey", "raw").select("p_partkey", "pointer", "role", "text")


@query("n04_visible_text", f"WITH g AS ({GLOSS}), s AS (SELECT p_partkey, STRING_AGG({GLOSS_TEXT}, ' ' ORDER BY k) AS glosses FROM g GROUP BY 1) SELECT p_partkey, p_brand || ' ' || glosses || ' 文 x' || p_size || ' Example ' || p_size || CASE WHEN p_partkey % 2 = 0 THEN ' 二' ELSE '' END || ' ' || p_type || ' note Source text 1 2 3' AS visible FROM part JOIN s USING (p_partkey)")
def visible_text(t: Tables) -> DataFrame:
    strings = article_nodes(t).where("kind = 'string'").where(F.col("pointer").rlike(CONTENT_ONLY)).withColumn("text", F.trim("text")).where("text <> ''")
    return strings.groupBy("p_partkey").agg(F.array_join(in_order("ordinal", "text"), " ").alias("visible"))


def senses_of(tree) -> Iterator[tuple]:
    """Rows (sense, glosses, labels, examples) of a parsed tree; what is inside a sense of a sense belongs to both."""
    nodes = list(walk(tree))
    shown = shown_in(nodes)
    within: dict[str, dict[str, list[list[str]]]] = {}
    for _, pointer, _, kind, _, _, _, _, selector, path, anchors, *_ in nodes:
        if kind != "object" or not selector:
            continue
        for s, anchor in zip(path, anchors, strict=True):
            if s == "sense" and anchor != pointer:
                within[anchor].setdefault(selector, []).append(shown.get(pointer, []))
        if selector == "sense":
            within[pointer] = {}
    for number, own in enumerate(within.values(), 1):
        text = {s: [" ".join(x) for x in items] for s, items in own.items()}
        glosses = [x for items in own.get("glossary", []) for x in items]
        labels = [x for s in SENSE_LABELS for x in text.get(s, []) if x]
        pairs = zip_longest(text.get("example-sentence-a", []), text.get("example-sentence-b", []), fillvalue="")
        yield number, " | ".join(glosses), " | ".join(labels), " | ".join(f"{a} = {b}" for a, b in pairs)


def sense_context(rows: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, sense, glosses, labels, examples): a row for each sense, in order.

    Examples pair sentences by place, the shorter side padded with empty texts;
    labels come by selector, in a fixed order of these.
    """
    return per_tree(rows, key, raw, senses_of, "sense long, glosses string, labels string, examples string")


@query("n06_sense_context", f"""WITH g AS ({GLOSS}) SELECT p_partkey, CAST(1 AS BIGINT) AS sense, ANY_VALUE(glosses) AS glosses, '' AS labels, '文 x' || ANY_VALUE(p_size) || ' = Example ' || ANY_VALUE(p_size) || CASE WHEN p_partkey % 2 = 0 THEN ' | 二 = ' ELSE '' END AS examples FROM part JOIN (SELECT p_partkey, STRING_AGG({GLOSS_TEXT}, ' | ' ORDER BY k) AS glosses FROM g GROUP BY 1) USING (p_partkey) GROUP BY p_partkey
UNION ALL SELECT p_partkey, CAST(2 AS BIGINT), p_type, 'note', '' FROM part""")
def senses(t: Tables) -> DataFrame:
    return sense_context(articles(t), "p_partkey", "raw")


@query("n06_inventory", "SELECT p_partkey, 'forms' AS element, CAST(1 AS BIGINT) AS n FROM part UNION ALL SELECT p_partkey, 'attribution', 1 FROM part UNION ALL SELECT p_partkey, 'sense-note', 1 FROM part UNION ALL SELECT p_partkey, 'example-sentence-a', CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 1 END FROM part")
def inventory(t: Tables) -> DataFrame:
    """How often an article has each element that must be preserved."""
    kept = article_nodes(t).where("kind = 'object'").where(F.col("selector").isin(*INVENTORY))
    return kept.groupBy("p_partkey", F.col("selector").alias("element")).agg(F.count("*").alias("n"))


@query("n05_select_by_selector", f"WITH g AS ({GLOSS}) SELECT p_partkey, 'glossary' AS selector, '/content/1/content/0' AS pointer FROM part UNION ALL SELECT p_partkey, 'glossary', '/content/2/content/0' FROM part UNION ALL SELECT p_partkey, 'highlight', '/content/1/content/0/content/' || k FROM g WHERE k % 2 = 1")
def by_selector(t: Tables) -> DataFrame:
    """Elements by selector, those inside others too."""
    return article_nodes(t).where("kind = 'object'").where(F.col("selector").isin("glossary", "highlight")).select("p_partkey", "selector", "pointer")


@query("n28_visible_strings", f"WITH g AS ({GLOSS}) SELECT p_partkey, CAST(SUM(CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END) + 10 + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS strings FROM g GROUP BY 1")
def visible_strings(t: Tables) -> DataFrame:
    """Strings that are content or titles, without those of metadata."""
    return article_nodes(t).where("kind = 'string' AND field IN ('content', 'title') AND NOT hidden").groupBy("p_partkey").agg(F.count("*").alias("strings"))
