"""Operators on tiny inputs with literal expectations."""

from __future__ import annotations

import hashlib
import json
import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import patterns, scalars
from sparkloom.operators import aggregates, checks, joins, mutations, nested, packing, queue, rules, units, windows
from sparkloom.registry import Tables
from sparkloom.sources import blocks, scans, sinks
from sparkloom.streaming import events


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_match_prefers_the_expression(spark):
    entries = spark.createDataFrame([(1, "猫", "ねこ"), (2, "有る", "ある"), (3, "ある", "ある")], "entry int, expression string, reading string")
    terms = spark.createDataFrame([("猫",), ("ある",), ("不在",)], "term string")
    assert rows(joins.match_terms(terms, entries)) == [("ある", 2, "reading"), ("ある", 3, "expression"), ("猫", 1, "expression")]


def test_pairs_of_common_keys_are_dealt_in_cells(spark, monkeypatch):
    monkeypatch.setattr(joins, "CELL", 3)
    monkeypatch.setattr(joins, "MEETING", 5)
    left = [(("a", "a", "a", "b", None, "c")[i % 6], i % 7, i // 2) for i in range(90)]
    right = [(("a", "a", "b", None, "d")[i % 5], i % 3, None if i % 11 == 0 else i) for i in range(80)]
    got = joins.dealt_join(spark.createDataFrame(left, "k string, x int, note int"), spark.createDataFrame(right, "k string, y int, entry int"), ["k"], "entry", F.col("x") != F.col("y"))
    want = [(k, x, note, y, entry) for k, x, note in left for q, y, entry in right if k is not None and k == q and x != y]
    assert got.columns == ["k", "x", "note", "y", "entry"] and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    none = spark.createDataFrame([], "k string, y int, entry int")
    assert joins.dealt_join(spark.createDataFrame(left, "k string, x int, note int"), none, ["k"], "entry").count() == 0


def test_candidates_of_every_kind_of_note(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "CELL", 4)
    names = {i: None if i == 9 else f"{('red', 'old')[i % 2]} {('steel', 'tin', 'widget', 'none')[i // 2 % 4]}" for i in range(1, 60)}
    spark.createDataFrame(list(names.items()), "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(i,) for i in range(1, 70)], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    variants, words = ((), ("steel", "brass", "widget"), ("none",)), {i: x.split(" ") for i, x in names.items() if x}
    want = [(i, k) for i in range(1, 70) if i + 1 in words for k, w in words.items() if w[0] == words[i + 1][0] and (i % 3 == 0 or w[1] in variants[i % 3])]
    assert rows(joins.candidates(Tables(spark, str(tmp_path)))) == sorted(want)


def test_division_passes_groups_without_members(spark):
    groups = spark.createDataFrame([(1,), (2,), (3,)], "g int")
    members = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "g int, m int")
    passing = spark.createDataFrame([(10,)], "m int")
    assert rows(joins.for_all(groups, members, passing, group="g", member="m")) == [(2,), (3,)]


def test_reconcile(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (3,)], "k int")
    assert rows(joins.reconcile(a, b, ["k"])) == [(1, 1, False)]
    assert rows(joins.reconcile(a, a, ["k"])) == [(0, 0, True)]


def test_percentiles_round_half_to_even(spark):
    df = spark.createDataFrame([("a", 100.0), ("a", 300.0)], "k string, v double")
    assert rows(aggregates.rounded_rank(df, "k", "v", {"p50": 0.5, "p95": 0.95})) == [("a", 100.0, 300.0)]
    assert rows(aggregates.exact_ranks(df, "k", "v", {"p50": aggregates.nearest_rank(0.5)})) == [("a", 100.0)]


def test_exact_ranks_equal_a_sort(spark):
    rng = random.Random(5)
    data = [(k, float(rng.choice([rng.random(), 1, 2, 3]))) for k, n in (("a", 20_000), ("b", 1), ("c", 7), (None, 50)) for _ in range(n)] + [("d", None), ("c", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: (r.p50, r.p95, r.p100, r.disc) for r in aggregates.exact_ranks(df, "k", "v", {"p50": (0.5, lambda n: F.bround((n - 1) * F.lit(0.5), 0).cast("long")), "p95": (0.95, lambda n: F.floor((n - 1) * 0.95)), "p100": (1.0, lambda n: n - 1), "disc": aggregates.nearest_rank(0.25)}).collect()}
    for key in ("a", "b", "c", None):
        own = sorted(v for k, v in data if k == key and v is not None)
        n = len(own)
        assert got[key] == (own[round((n - 1) * 0.5)], own[int((n - 1) * 0.95)], own[-1], own[min(n - 1, math.ceil(n * 0.25) - 1)])
    assert got["d"] == (None, None, None, None)


def test_digest_ignores_order_and_keeps_duplicates(spark):
    line = F.col("x")
    one = spark.createDataFrame([("a",), ("b",)], "x string")
    assert rows(aggregates.multiset_digest(one, line)) == rows(aggregates.multiset_digest(one.orderBy(F.desc("x")), line))
    assert rows(aggregates.multiset_digest(one, line)) != rows(aggregates.multiset_digest(one.union(one.limit(1)), line))


def test_falling_counter_is_an_error(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 3.0)], "t int, c double")
    with pytest.raises(Exception, match="has fallen"):
        df.agg(aggregates.counter_delta("c", "t")).collect()


def naive_pack(items, most, bytes_, units):
    out, batch, n, size, u, closed = [], -1, 0, 0, 0, False
    for b, k in items:
        alone = b + 2 > bytes_ or k > units
        if alone or closed or n == 0 or n + 1 > most or size + 1 + b > bytes_ or u + k > units:
            batch, n, size, u = batch + 1, 1, b + 2, k
        else:
            n, size, u = n + 1, size + 1 + b, u + k
        closed = alone
        out.append(batch)
    return out


def test_packing_equals_the_plain_loop(spark):
    items = [(200 + 37 * i % 900 * (6 if i % 50 == 0 else 1), 1 + i % 7) for i in range(249)]
    df = spark.createDataFrame([(0, i, b, u) for i, (b, u) in enumerate(items)], "g int, o int, bytes long, units long")
    got = packing.pack_groups(df, "g", "o", items=5, bytes_=4500, units=18).orderBy("o").collect()
    assert [r.batch for r in got] == naive_pack(items, 5, 4500, 18)


def test_whole_chunking_equals_the_plain_loop(spark, tmp_path):
    docs = [(i, "x" * (37 * i % 9100), ("en", "de", None)[i % 3]) for i in range(1200)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for lang in ("en", "de", None):
        own = [(i, len(x)) for i, x, k in docs if k == lang]
        want |= zip((i for i, _ in own), naive_pack([(n, 1) for _, n in own], 1 << 40, 8000, 1 << 40), strict=True)
    got = packing.byte_chunking(Tables(spark, str(tmp_path))).collect()
    assert {r.doc_id: (r.lang, r.chunk) for r in got} == {i: (k, want[i]) for i, _, k in docs} and len(got) == len(docs)


def test_segments_of_two_units(spark):
    df = spark.createDataFrame([(0, i, 1, 1) for i in range(5)], "g int, o int, bytes long, units long")
    got = packing.pack_groups(df, "g", "o", items=100, bytes_=1000, units=2).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == [2, 2, 1]


def test_hard_ceilings_and_singletons(spark):
    df = spark.createDataFrame([(0, i, b, 1) for i, b in enumerate([10, 10, 50, 10, 10])], "g int, o int, bytes long, units long")
    got = packing.pack_groups(df, "g", "o", items=9, bytes_=90, units=9, singleton=40).orderBy("o").collect()
    assert [r.batch for r in got] == [0, 0, 1, 2, 2]
    for caps in ({"hard_bytes": 51}, {"hard_units": 0}):
        with pytest.raises(Exception, match="hard ceiling"):
            packing.pack_groups(df, "g", "o", items=9, bytes_=90, units=9, **caps).collect()


def test_ranges_of_large_groups(spark):
    df = spark.createDataFrame([("g", i, 10, 1) for i in range(25)], "g string, o int, bytes long, units long")
    got = packing.pack_ranges(df, "g", "o", keys=10, items=4, bytes_=1000, units=99).orderBy("o").collect()
    assert [(r["range"], r.batch) for r in got] == [(i // 10, i % 10 // 4) for i in range(25)]


def quota_rows(n):
    return [{"id": i, "bytes": 100 + 7 * i % 90, "units": 3 + i % 5, "roles": {"a": i % 4, "b": int(i % 10 == 0)}, "features": {"odd"} if i % 2 else {"big"} if i == 8 else set()} for i in range(n)]


def test_quota_fill():
    metrics = quota_rows(40)
    order = lambda k: f"{k * 17 % 41:03d}"
    ids = packing.fill_quotas(metrics, targets={"a": 30, "b": 3}, least_units=120, required=("odd",), oversize="big", order=order)
    by = {r["id"]: r for r in metrics}
    size = sorted(metrics, key=lambda r: (r["bytes"], r["id"]))
    must = {8, size[0]["id"], size[20]["id"], size[int(39 * 0.95)]["id"], size[39]["id"], 4, min((r["id"] for r in metrics if r["id"] % 2), key=order)}
    assert must <= set(ids) and ids == sorted(ids)
    assert sum(by[i]["roles"]["a"] for i in ids) >= 30 and sum(by[i]["roles"]["b"] for i in ids) >= 3 and sum(by[i]["units"] for i in ids) >= 120
    # the last ones, added for their units alone, come in order
    rest = [i for i in sorted(by, key=order) if i not in ids]
    assert not rest or sum(by[i]["units"] for i in ids) - min(by[i]["units"] for i in ids) < 120 + 7
    for kw, said in (({"targets": {"b": 5}, "least_units": 1}, "target for b"), ({"targets": {}, "least_units": 999}, "999 units")):
        with pytest.raises(ValueError, match=said):
            packing.fill_quotas(metrics, **kw)
    with pytest.raises(ValueError, match="nothing"):
        packing.fill_quotas([], targets={}, least_units=0)


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "k int, v string")
    assert rows(mutations.insert_missing(old, new, ["k"])) == [(3, "d")]
    assert rows(mutations.upsert(old, new.distinct(), ["k"])) == [(1, "a"), (2, "c"), (3, "d")]
    o = spark.createDataFrame([(1, "h1", "x"), (2, "h2", "y")], "k int, h string, label string")
    n = spark.createDataFrame([(1, "h1"), (2, "changed"), (3, "h3")], "k int, h string")
    assert sorted(map(tuple, mutations.preserving_upsert(o, n, "k", "h", ["label"]).collect()), key=str) == [(1, "h1", "x"), (2, "changed", None), (3, "h3", None)]


def test_versions(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b")], "k int, t int, v string")
    assert rows(mutations.versions(df, "k", "t", value="v").select("version", "v", "valid_from", "valid_to")) == [(1, "a", 1, 3), (2, "b", 3, None)]


def test_running_offsets_in_blocks(spark):
    df = spark.range(25).withColumn("size", F.lit(2))
    got = windows.running_offset_in_blocks(df, "size", "id", 4).orderBy("id").collect()
    assert [r["offset"] for r in got] == [2 * i for i in range(25)]


def test_reading_variants(spark):
    df = spark.createDataFrame([("ナニ・なん",), ("ﾊﾟﾝ",)], "x string")
    assert [list(r[0]) for r in df.select(scalars.reading_variants(F.col("x"))).collect()] == [["なに", "なん"], ["ぱん"]]


def test_unicode_strip_and_nfc(spark):
    df = spark.createDataFrame([("　が ",)], "x string")
    assert df.select(scalars.unicode_strip(F.col("x"))).first()[0] == "が"
    assert df.select(scalars.nfc("x")).first()[0] == "が"


def plain_binomials(text, stop):
    """The rules of Latin pairs, character by character."""

    def run(at, chars):
        end = at
        while end < len(text) and text[end] in chars:
            end += 1
        return end

    small, pairs, at = "abcdefghijklmnopqrstuvwxyz", [], 0
    while at < len(text):
        for mark in ("", text[at]) if at == 0 else (text[at],):  # at the start no mark is needed
            if mark not in ("", ";", "(", ","):
                continue
            i = at + len(mark)
            while mark and i < len(text) and text[i].isspace():
                i += 1
            a = run(i + 1, small)
            b = a
            while b < len(text) and text[b].isspace():
                b += 1
            c = run(b, small + "-") if b < len(text) and text[b] in small else b
            while c > b and (not text[c - 1].isalnum() if c == len(text) or not (text[c].isalnum() or text[c] == "_") else text[c - 1] != "-"):
                c -= 1  # a word ends here
            if i < len(text) and text[i] in small.upper() and a - i >= 3 and b > a and c - b >= 3:
                pairs.append((mark, text[i:a], text[b:c], text[i:c]))
                at = c - 1
                break
        at += 1
    genera = [g for _, g, _, _ in pairs]
    return list(dict.fromkeys(w for m, g, e, w in pairs if g.lower() not in stop and e.lower() not in stop and (m in ("(", ",") or genera.count(g) > 1)))


def test_binomials_equal_the_plain_scan(spark, tmp_path):
    rng, stop = random.Random(3), frozenset({"the", "and", "der", "les"})
    bits = ["Rosa canina", "Rosa  rugosa", "Quercus robur", "The cat", "Rosa and", "(", ", ", "; ", ") ", " x ", "Felis silvestris-catus", "Ab cde", "Abies al", "Pinus nigra_", "\n", "word "]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(400)]
    texts += [None, "x " * 400 + "(Rosa canina), Rosa rugosa", "Rosa canina; Rosa rugosa; Rosa canina", "Rosa canina; Felis catus", "(Abies alba-, x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.found for r in scalars.latin(Tables(spark, str(tmp_path))).collect()}
    assert got == {i: len(plain_binomials(x or "", stop)) for i, x in enumerate(texts)}
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    names = {r.i: r.n for r in df.select("i", patterns.binomials(F.col("text"), tuple(stop), tuple(stop)).alias("n")).collect()}
    assert [names[i] for i in range(len(texts))] == [plain_binomials(x or "", stop) for x in texts]
    assert got[401] == 2 and got[402] == 2 and got[403] == 0


def test_whole_texts_are_normalised(spark, tmp_path):
    texts = [None, "", " \u3000", "x" * 90 + "e\u0301", "x" * 90 + "\u00e9 \u3000\n", "x" * 90 + "e"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.h for r in scalars.nfc_strip(Tables(spark, str(tmp_path))).collect()}
    assert got == {i: None if x is None else hashlib.md5(unicodedata.normalize("NFC", x).strip().encode()).hexdigest() for i, x in enumerate(texts)}
    assert got[3] == got[4] != got[5]


def test_whole_keys_of_all_rows_are_ordered(spark, tmp_path):
    texts = [None, "", None, *("same head " * 200 + tail for tail in ("b", "B", "a", "é", "b")), *(f"{'aBcé'[i % 4]}{i * 7919 % 1000}" for i in range(1500))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    folded = str.maketrans(scalars.UPPER, scalars.UPPER.lower())
    want = sorted(range(len(texts)), key=lambda i: (texts[i] is not None, (texts[i] or "").translate(folded).encode(), (texts[i] or "").encode(), i))
    got = scalars.locale_free(Tables(spark, str(tmp_path)))
    assert [r.doc_id for r in got.orderBy("place").collect()] == want and sorted(r.place for r in got.collect()) == list(range(1, len(texts) + 1))


def test_all_rows_have_a_place(spark, tmp_path):
    data = [(i, ("1-URGENT", "5-LOW", None)[i % 3], "FOP"[i % 2]) for i in range(2500)]
    spark.createDataFrame(data, "o_orderkey long, o_orderpriority string, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(500).withColumnRenamed("id", "c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    t, digest = Tables(spark, str(tmp_path)), lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted(data, key=lambda r: (["5-LOW", "1-URGENT", None].index(r[1]), r[2], digest(f"b:{r[0]}")))
    assert rows(windows.multi_key_sort(t)) == sorted((r[0], n + 1) for n, r in enumerate(want))
    want = sorted(range(500), key=lambda i: digest(f"pilot-v1:{i}"))
    assert rows(windows.by_hash(t)) == sorted((i, n + 1) for n, i in enumerate(want))


def test_every_note_and_event_counts(spark, tmp_path):
    names = {i: " ".join(("red", "tin", "old", "box")[(i * k) % 4] for k in (1, 3, 2)) for i in range(1, 40)}
    spark.createDataFrame(list(names.items()), "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(7, "a"), (500, "b"), (777, "b")], "event_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    words = {i: x.split(" ") for i, x in names.items()}
    want = [(i, j, "expression" if v[0] == w[0] else "reading") for i, v in words.items() for j, w in words.items() if v[0] == w[0] or w[-1] in v]
    assert rows(joins.variant_fallback(Tables(spark, str(tmp_path)))) == sorted(want)
    assert rows(checks.marker_equality(Tables(spark, str(tmp_path)))) == [("a", 1, True), ("b", 2, False)]


def test_exact_cost(spark):
    df = spark.createDataFrame([(1_000_000, 400_000, 10)], "i long, c long, o long")
    assert float(df.select(scalars.token_cost(F.col("i"), F.col("c"), F.col("o"), "0.25", "0.025", "2.0", "1")).first()[0]) == pytest.approx(0.16002)


def test_pointers_and_fingerprint(spark):
    raw = json.dumps({"a/b": [{"content": "x"}], "c": "y"})
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(nested.json_pointer("raw", F.lit("/a~1b/0/content"))).first()[0] == '"x"'
    assert df.select(nested.json_pointer("raw", F.lit("/none"))).first()[0] is None
    other = raw.replace('"x"', '"z"')
    units = F.array(F.lit("/a~1b/0/content"))
    f = [spark.createDataFrame([(r,)], "raw string").select(nested.structural_fingerprint("raw", units)).first()[0] for r in (raw, other, raw.replace('"c"', '"d"'))]
    assert f[0] == f[1] != f[2]


def test_node_table_skips_what_does_not_parse(spark):
    df = spark.createDataFrame([(1, '["a",{"tag":"p","content":"b"}]'), (2, "{"), (3, None)], "k int, raw string")
    assert rows(nested.node_table(df, "k", "raw").where("kind = 'string'").select("k", "pointer", "text")) == [(1, "/0", "a"), (1, "/1/content", "b")]


def test_glossary_sets_of_a_walk(spark):
    inner = {"tag": "ul", "data": {"content": "glossary"}, "content": "in"}
    tree = [{"data": {"content": "glossary"}, "content": ["a", [" b "], inner, {"title": "t", "content": "c"}]}, {"data": {"content": "redirect"}, "content": [inner]}, {"data": {"content": "xref"}, "content": [{"content": " x "}, "文"], "title": "y"}]
    df = spark.createDataFrame([(1, json.dumps(tree)), (2, "{"), (3, None), (None, json.dumps(inner))], "k int, raw string")
    want = [(1, "/0/content", "glossary_set", "a | b | in | c"), (1, "/2/content/0/content", "xref_gloss", "x"), (1, "/2/title", "tooltip", "y"), (None, "/content", "glossary_set", "in")]
    assert sorted(map(tuple, units.lexicographic_units(df, "k", "raw").select("k", "pointer", "role", "text").collect()), key=str) == sorted(want, key=str)


def test_senses_of_a_walk(spark):
    e = lambda selector, *content: {"data": {"content": selector}, "content": list(content)}
    inner = e("sense", e("glossary", "in"), e("example-sentence-b", "B2"))
    tree = [e("sense", e("sense-note", "n"), e("glossary", "a", ["b", "c"]), e("misc-info", "m"), e("example-sentence-a", "A1"), e("example-sentence-b", "B1"), inner), e("sense")]
    df = spark.createDataFrame([(1, json.dumps(tree)), (2, '"x"'), (3, "{"), (None, json.dumps(inner))], "k int, raw string")
    want = [(1, 1, "a | b c | in", "m | n", "A1 = B1 |  = B2"), (1, 2, "in", "", " = B2"), (1, 3, "", "", ""), (None, 1, "in", "", " = B2")]
    assert sorted(map(tuple, units.sense_context(df, "k", "raw").collect()), key=str) == sorted(want, key=str)


def test_tags_of_a_walk(spark):
    tag = lambda code, content: {"data": {"class": "tag", "code": code}, "content": content}
    tree = [tag("a", "A"), tag("b", ["B"]), tag("c", tag("d", " D ")), {"data": {"class": "other", "code": "e"}, "content": "E"}, tag(None, "N")]
    df = spark.createDataFrame([(1, json.dumps(tree)), (2, json.dumps(tag("a", ""))), (3, "{"), (4, None)], "k int, raw string")
    assert sorted(map(tuple, scans.tags(df, "k", "raw").collect()), key=str) == [(1, "a", "A"), (1, "d", " D "), (1, None, "N"), (2, "a", "")]


def test_rendering():
    tree = {"tag": "div", "content": ["a & b", {"tag": "script", "content": "x"}, {"tag": "img", "path": "m.png"}]}
    assert nested.render(tree) == '<div>a &amp; b<span>x</span><img src="m.png"></div>'
    assert nested.render(tree, xml=True).endswith('<img src="m.png"/></div>')


def test_schema_errors():
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer"}}, "additionalProperties": False}
    assert nested.schema_errors({"a": 1}, schema) == []
    assert nested.schema_errors({"a": True, "b": 1}, schema) == ["$.b: unexpected", "$.a: not integer"]
    assert nested.schema_errors([], schema) == ["$: not object"]


def test_rules(spark):
    df = spark.createDataFrame([(1, ""), (2, "x1"), (3, "ok")], "k int, t string")
    broken = {"empty": F.col("t") == "", "digit": F.col("t").rlike("[0-9]")}
    assert rows(rules.issue_table(df, "k", broken)) == [(1, "empty"), (2, "digit")]


def test_illegal_moves(spark):
    df = spark.createDataFrame([(1, 1, "ready"), (1, 2, "leased"), (1, 3, "complete"), (2, 1, "leased")], "k int, t int, s string")
    assert rows(queue.illegal_moves(df, "k", "t", "s").select("k", "t", "s")) == [(1, 3, "complete")]


def test_bank_scan_orders_members_by_number(spark):
    names = [f"term_bank_{i}.json" for i in (10, 2, 1)] + ["index.json"]
    texts = ['[["j"]]', '[["b"],["c"]]', '[["a"]]', "{}"]
    df = spark.createDataFrame([(names, texts)], "n array<string>, t array<string>").select(scans.zip_members("n", "t").alias("content"))
    got = scans.scan_banks(df).collect()
    assert [(r.bank_number, r.entry_ordinal, r.raw) for r in got] == [(1, 0, '["a"]'), (2, 0, '["b"]'), (2, 1, '["c"]'), (10, 0, '["j"]')]


def test_recorded_ranks(spark):
    df = spark.createDataFrame([(x,) for x in ("3", "2.9", '{"value":4}', '{"frequency":5,"value":1}', "true", '{"value":true}', "0", "99", None, "x")], "r string")
    assert [r[0] for r in df.select(scans.recorded_rank(F.col("r"), 10)).collect()] == [3, 2, 4, 5, None, None, None, None, None, None]


def test_strict_json_lines(spark):
    good = spark.createDataFrame([('{"a":1}',)], "value string")
    assert scans.strict_json_lines(good).count() == 1
    with pytest.raises(Exception, match="not a JSON object"):
        scans.strict_json_lines(spark.createDataFrame([("[1]",)], "value string")).collect()


def test_strict_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\n2,y\n")
    assert scans.strict_csv(spark, str(tmp_path / "x.csv"), "a int, b string", 2).count() == 2
    with pytest.raises(ValueError):
        scans.strict_csv(spark, str(tmp_path / "x.csv"), "a int, b string", 3)


def test_decks(spark, tmp_path):
    import sqlite3
    import zipfile

    with sqlite3.connect(tmp_path / "c.db") as db:
        db.execute("CREATE TABLE notes (id INTEGER, flds TEXT)")
        db.execute("INSERT INTO notes VALUES (7, 'a\x1fb')")
    with zipfile.ZipFile(tmp_path / "d.apkg", "w") as z:
        z.write(tmp_path / "c.db", "collection.anki2")
    got = scans.scan_decks(scans.binary_files(spark, str(tmp_path / "d.apkg"))).collect()
    assert [(r.id, list(r.fields)) for r in got] == [(7, ["a", "b"])]


def test_json_chunks(spark):
    df = spark.createDataFrame([(0, i, "x" * n) for i, n in enumerate((5, 7, 9, 11, 13))], "g int, o int, s string")
    got = sinks.json_chunks(df, "g", "o", F.col("s"), 5 + 7 + 3).orderBy("chunk").collect()
    assert got[0].text == f"[{'x' * 5},{'x' * 7}]" and all(len(r.text) <= 15 or "," not in r.text for r in got)


def test_streams(spark, tmp_path):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    data = [(i, 1 + i % 2, t0 + dt.timedelta(minutes=10 * i), "click", 1.0) for i in range(12)]
    schema = "event_id long, user_id long, ts timestamp, event_type string, value double"
    spark.createDataFrame(data + data[:3], schema).write.parquet(str(tmp_path / "in"))
    stream = events.read_events(spark, str(tmp_path / "in"), schema)
    q = events.without_replays(stream, "event_id").writeStream.format("memory").queryName("dedupe").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination()
    assert spark.table("dedupe").count() == 12
    q = events.windowed_counts(stream, "event_type").writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2")).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 15
    q = events.lease_states(stream, "user_id").writeStream.outputMode("update").format("memory").queryName("leases").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c3")).start()
    q.awaitTermination()
    assert spark.table("leases").where("open").agg(F.sum("claims")).first()[0] == 2


def test_versioned_write_and_audit(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    place = mutations.publish(df, str(tmp_path / "t"), "1")
    with pytest.raises(Exception, match="exist"):
        mutations.publish(df, str(tmp_path / "t"), "1")
    assert spark.read.parquet(place).count() == 2
    for _ in range(2):
        sinks.append_audit(df, str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 4
    sinks.write_table(df, str(tmp_path / "p"), by=["v"])
    sinks.write_table(df.limit(1), str(tmp_path / "p"), by=["v"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
    (tmp_path / "x.xml").write_text("<d><e><n>1</n></e><e><n>2</n></e></d>")
    assert rows(scans.xml_rows(spark, str(tmp_path / "x.xml"), "e", "n int")) == [(1,), (2,)]
    assert scans.file_hashes(scans.binary_files(spark, str(tmp_path / "x.xml"))).count() == 1


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_dictionary_files_are_read_back(n):
    entries = [(f"Key {i * 7919 % 5003:05d}" if i % 2 else f"key {i:05d}", "record é " * (i % 40)) for i in range(n)]
    data = blocks.write_dictionary(entries, 'A "title" & more')
    head, found = blocks.read_dictionary(data)
    assert head["Title"] == 'A "title" & more' and found == sorted(entries, key=lambda e: (e[0].lower().encode(), e[0].encode()))
    for spoilt in (data[:-1], data + b"x", data[:3], data[:60] + bytes([data[60] ^ 1]) + data[61:]):
        with pytest.raises(ValueError):
            blocks.read_dictionary(spoilt)
    for bad in (("", "x"), ("a\nb", "x"), ("a", "x\0")):
        with pytest.raises(ValueError):
            blocks.write_dictionary([bad], "t")


def test_rows_are_observed_on_the_way(spark, tmp_path):
    df, seen = queue.observed(spark.range(10), "ten")
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get["rows"] == 10 and seen.get["bytes"] > 0


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    with pytest.raises(Exception, match="no"):
        sinks.replace_table(spark.range(9).select(F.when(F.col("id") > 5, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_swap_needs_exactly_one_owner(spark):
    batches = spark.createDataFrame([(1, "leased", "t"), (2, "leased", "t"), (3, "ready", "t"), (4, "leased", None)], "batch int, state string, token string")
    claims = spark.createDataFrame([(10, 1, "t", "claimed"), (11, 1, "old", "claimed"), (20, 2, "t", "claimed"), (21, 2, "t", "claimed"), (30, 3, "t", "claimed"), (40, 4, None, "claimed"), (50, 9, "t", "claimed")], "attempt int, batch int, token string, attempt_state string")
    got = {r.attempt: (r.swapped, r.attempt_state, r.batch_state) for r in mutations.compare_and_swap(batches, claims).collect()}
    assert got == {10: (True, "accepted", "validated"), 11: (False, "claimed", "leased"), 20: (False, "claimed", "leased"), 21: (False, "claimed", "leased"), 30: (False, "claimed", "ready"), 40: (False, "claimed", "leased"), 50: (False, "claimed", None)}


def test_deep_trees_are_walked(spark):
    raw = '{"content":[' * 3000 + '"x"' + "]}" * 3000
    tree = "x"
    for _ in range(3000):
        tree = {"content": [tree]}
    rows_ = list(nested.walk(tree))
    assert rows_[-1][1] == "/content/0" * 3000 and rows_[-1][-1] == "x"
    assert nested.node_table(spark.createDataFrame([(1, raw)], "k int, raw string"), "k", "raw").count() in (0, len(rows_))


def test_nodes_come_in_the_order_of_the_document(spark):
    raw = '{"content":[' + ",".join(f'"w{i}"' for i in range(12)) + '],"a":"last"}'
    got = nested.node_table(spark.createDataFrame([(1, raw)], "k int, raw string"), "k", "raw").where("kind = 'string'").orderBy("ordinal").collect()
    assert [r.text for r in got] == [*(f"w{i}" for i in range(12)), "last"]


def test_issues_of_texts(spark):
    say = lambda text, tokens=(), **kw: spark.range(1).select(rules.text_issues(F.lit(text).cast("string"), F.array(*map(F.lit, tokens)).cast("array<string>"), **kw).alias("x")).first().x
    assert say(None) == say("  ") == say("　") == ["empty_or_non_string"]
    assert say("слово") == [] and say("word") == ["no_cyrillic"] and say("word", any_script=True) == []
    assert say("слово ```") == say("слово [a](b)") == ["markup_detected"]
    assert say("слово\x0b") == ["control_character"]
    assert say("слово NASA", ("NASA", "ESA")) == ["protected_token_missing"]
    assert say("словo") == ["mixed_alphabet_token"] and say("словоNASA", ("NASA",)) == []
    assert say("слово one two three") == ["too_much_english"] and say("слово one two") == []
    assert say("слово (Felis catus), one two") == [] and say("слово éone twoé three four") == []


def plain_dispatch(seconds, workers, ramp, drain, stop):
    """The same in small steps of time."""
    drain = min(drain, stop)
    out, running, opened, todo, now = {}, [], 0, list(enumerate(seconds)), 0.0
    while todo:
        running = [e for e in running if e > now + 1e-9]
        while todo and now < drain:
            if len(running) < opened:
                pass
            elif opened < workers and now >= opened * ramp - 1e-9:
                opened += 1
            else:
                break
            k, s = todo.pop(0)
            running.append(min(now + s, stop))
            out[k] = (round(now, 6), round(min(now + s, stop), 6), "interrupted" if now + s > stop + 1e-9 else "completed")
        if now >= drain:
            break
        now = round(now + 0.25, 6)
    return [out.get(k, (None, None, "not_launched")) for k in range(len(seconds))]


def test_dispatch_equals_a_simulation():
    rng = random.Random(4)
    for _ in range(60):
        seconds = [rng.randint(1, 80) / 4 for _ in range(rng.randint(0, 30))]
        own = {"workers": rng.randint(1, 4), "ramp": rng.choice([0.0, 0.5, 2.0, 7.5]), "drain": rng.choice([5.0, 20.0, 100.0]), "stop": 110.0 if rng.random() < 0.5 else 22.0}
        got = queue.dispatch([(0.0, s) for s in seconds], **own)
        assert [(None if a is None else round(a, 6), None if b is None else round(b, 6), c) for a, b, c in got] == plain_dispatch(seconds, **own)


def test_pinned_content_and_tools(tmp_path):
    good, waits, given = hashlib.sha256(b"x").hexdigest(), [], iter([b"bad", OSError(), b"x"])

    def read():
        x = next(given)
        if isinstance(x, Exception):
            raise x
        return x

    assert scans.fetch_pinned(read, good, wait=waits.append) == b"x" and waits == [1.0, 2.0]
    with pytest.raises(ValueError, match="pinned"):
        scans.fetch_pinned(lambda: b"y", good, wait=waits.append)
    tool = tmp_path / "tool"
    tool.write_text("#!/bin/sh\necho said $1\n")
    tool.chmod(0o755)
    pin = hashlib.sha256(tool.read_bytes()).hexdigest()
    assert sinks.run_pinned(str(tool), pin, "so") == "said so\n"
    with pytest.raises(ValueError, match="hash"):
        sinks.run_pinned(str(tool), good)
