"""Scalar functions on text, hashes, paths, ranks, times and costs."""

from __future__ import annotations

import json
import unicodedata
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sparkloom.functions import patterns
from sparkloom.operators.windows import places
from sparkloom.registry import Tables, query


@F.pandas_udf(StringType())
def nfc(x: pd.Series) -> pd.Series:
    """NFC without white space at the ends; Spark has no built-in normaliser."""
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFC", s).strip())


@F.pandas_udf(StringType())
def nfkc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


@query("x01_nfc_strip", "SELECT doc_id, MD5(REGEXP_REPLACE(nfc_normalize(text), '^\\s+|\\s+$', '', 'g')) AS h FROM documents")
def nfc_strip(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(nfc("text")).alias("h"))


#: The kana blocks, small a to small ke, as code points.
KATAKANA = "".join(map(chr, range(0x30A1, 0x30F7)))
HIRAGANA = "".join(map(chr, range(0x3041, 0x3097)))
SEPARATORS = "[・/／,、]"


def reading_variants(col: Column) -> Column:
    """The distinct readings in a field, compatibility forms folded, katakana as hiragana."""
    parts = F.transform(F.split(nfkc(col), SEPARATORS), lambda p: F.translate(unicode_strip(p), KATAKANA, HIRAGANA))
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


@query("x02_reading_variants", "SELECT n_nationkey, ARRAY_TO_STRING(LIST_FILTER([TRIM(x) FOR x IN STRING_SPLIT(n_name || '/' || LOWER(n_name), '/')], lambda x: x <> ''), '|') AS variants FROM nation")
def variants(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", F.array_join(reading_variants(F.concat("n_name", F.lit("/"), F.lower("n_name"))), "|").alias("variants"))


def all_kana(col: Column) -> Column:
    return col.rlike("^[ぁ-ゖァ-ヺー・]+$")


@query("x03_all_kana", "SELECT s_suppkey, s_suppkey % 2 = 0 AS kana FROM supplier")
def kana(t: Tables) -> DataFrame:
    word = F.when(F.col("s_suppkey") % 2 == 0, "ねこカー・").otherwise(F.concat(F.lit("ねこ"), "s_name"))
    return t.supplier.select("s_suppkey", all_kana(word).alias("kana"))


def unicode_strip(col: Column) -> Column:
    """Without white space of any script at the ends (the built-in trim knows the ASCII space)."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


@query("x04_unicode_strip", "SELECT r_regionkey, r_name AS stripped FROM region")
def strip(t: Tables) -> DataFrame:
    return t.region.select("r_regionkey", unicode_strip(F.concat(F.lit("　\t "), "r_name", F.lit(" 　\n"))).alias("stripped"))


@query("x05_sha256", "SELECT doc_id, SHA256(text) AS sha256 FROM documents")
def sha256(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.sha2("text", 256).alias("sha256"))


@F.pandas_udf(StringType())
def canonical_json(x: pd.Series) -> pd.Series:
    """JSON text with sorted keys, no spaces and no ASCII escapes; null if it doesn't parse."""

    def one(s: str | None) -> str | None:
        try:
            return None if s is None else json.dumps(json.loads(s), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        except ValueError:
            return None

    return x.map(one)


@query("x06_canonical_json", """SELECT c_custkey, '{"a":' || c_nationkey || ',"b":null,"name":"' || c_name || '"}' AS canonical FROM customer""")
def canonical(t: Tables) -> DataFrame:
    """Structs with fields in order of name give canonical JSON without Python."""
    s = F.struct(F.col("c_nationkey").alias("a"), F.lit(None).cast("string").alias("b"), F.col("c_name").alias("name"))
    return t.customer.select("c_custkey", F.to_json(s, {"ignoreNullFields": "false"}).alias("canonical"))


@query("x07_truncated_hash_ids", "SELECT p_partkey, SUBSTRING(SHA256(p_name), 1, 12) AS id12, SUBSTRING(SHA256(p_name || p_brand), 1, 24) AS id24 FROM part")
def truncated(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.substring(F.sha2("p_name", 256), 1, 12).alias("id12"), F.substring(F.sha2(F.concat("p_name", "p_brand"), 256), 1, 24).alias("id24"))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_order(col: Column) -> list[Column]:
    """Sort keys: ASCII letters folded, then the bytes; no locale."""
    return [F.translate(col, UPPER, UPPER.lower()), col]


def key_blocks(rows: DataFrame, col: str, id_col: str, *, blocks: int = 64, chars: int = 1000, sample: int = 2000) -> Column:
    """The number of the block of ``col`` in ASCII order; bounds are heads of keys drawn by hash, the same for the same rows."""
    head = F.translate(F.substring(col, 1, chars), UPPER, UPPER.lower())
    share = int(min(1.0, sample / max(1, rows.count())) * (1 << 30))  # so no task sends more than its part of about ``sample`` heads
    drawn = rows.where(F.col(col).isNotNull() & (F.pmod(F.xxhash64(id_col, col), F.lit(1 << 30)) <= share)).select(head.alias("k")).collect()
    keys = sorted((r["k"] for r in drawn), key=str.encode)
    bounds = sorted({keys[len(keys) * i // blocks] for i in range(1, blocks)} if keys else (), key=str.encode)
    bounds = [b.encode() for b in bounds]

    @F.pandas_udf("int")
    def find(x: pd.Series) -> pd.Series:
        return x.map(lambda s: 0 if s is None else bisect_right(bounds, s.encode()))

    return find(head)


@query("x08_locale_free_sort", f"SELECT doc_id, ROW_NUMBER() OVER (ORDER BY TRANSLATE(text, '{UPPER}', '{UPPER.lower()}') NULLS FIRST, text, doc_id) AS place FROM documents")
def locale_free(t: Tables) -> DataFrame:
    """The place of every document by its whole text."""
    docs = t.documents.select("doc_id", "text")
    docs = docs.withColumn("block", key_blocks(docs, "text", "doc_id"))
    return places(docs, {"block": F.col("block")}, *ascii_order(F.col("text")), F.col("doc_id")).select("doc_id", "place")


TOKEN_FAMILIES = (r"[0-9]+(?:[.,][0-9]+)*", r"[A-Z]{2,}[0-9]*", r"https?://[^ ]+")


def protected_tokens(col: Column, families: tuple[str, ...] = TOKEN_FAMILIES) -> Column:
    """All matches of the token families, in their order, each once."""
    return F.array_distinct(F.concat(*(F.regexp_extract_all(col, F.lit(f), 0) for f in families)))


@query("x09_protected_tokens", "SELECT doc_id, LEN(LIST_DISTINCT(LIST_CONCAT(REGEXP_EXTRACT_ALL(text, '[0-9]+(?:[.,][0-9]+)*'), REGEXP_EXTRACT_ALL(text, '[A-Z]{2,}[0-9]*'), REGEXP_EXTRACT_ALL(text, 'https?://[^ ]+')))) AS tokens FROM documents")
def tokens(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.size(protected_tokens(F.col("text"))).cast("long").alias("tokens"))


STOP = ("the", "and", "der", "les")
#: DuckDB's boundary of words knows ASCII alone: other letters stand as digits.
NOT_ASCII = r"[\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{2af}\x{370}-\x{1fff}\x{2c00}-\x{d7ff}]"


@query(
    "x10_latin_binomials",
    f"WITH d AS (SELECT doc_id, REGEXP_REPLACE(COALESCE(text, ''), '{NOT_ASCII}', '0', 'g') AS x FROM documents), "
    f"p AS (SELECT doc_id, {', '.join(f'REGEXP_EXTRACT_ALL(x, \'{patterns.BINOMIAL}\', {k}) AS {c}' for k, c in ((1, 'b'), (2, 'w'), (3, 'g'), (4, 'e')))} FROM d) "
    f"SELECT doc_id, CAST(LEN(LIST_DISTINCT(LIST_TRANSFORM(LIST_FILTER(LIST_ZIP(b, w, g, e), lambda z: LOWER(z[3]) NOT IN {STOP} AND LOWER(z[4]) NOT IN {STOP} AND (LEFT(z[1], 1) IN ('(', ',') OR LEN(LIST_FILTER(g, lambda y: y = z[3])) > 1)), lambda z: z[2]))) AS BIGINT) AS found FROM p",
)
def latin(t: Tables) -> DataFrame:
    """Names of species, by the words of these texts' languages that can't be one."""
    return t.documents.select("doc_id", F.size(patterns.binomials(F.col("text"), STOP, STOP)).cast("long").alias("found"))


@query("x11_script_predicates", "SELECT doc_id, REGEXP_MATCHES(text, '[Ѐ-ӿ]') AS cyrillic, REGEXP_MATCHES(text, '[A-Za-z]') AS latin, REGEXP_MATCHES(text, '[À-ÿ][A-Za-z]') AS mixed, REGEXP_MATCHES(text, '[\\x00-\\x08]') AS control, REGEXP_MATCHES(text, '<[a-z]+>') AS markup FROM documents")
def scripts(t: Tables) -> DataFrame:
    x = F.col("text")
    return t.documents.select("doc_id", x.rlike("[Ѐ-ӿ]").alias("cyrillic"), x.rlike("[A-Za-z]").alias("latin"), x.rlike("[À-ÿ][A-Za-z]").alias("mixed"), x.rlike(r"[\x00-\x08]").alias("control"), x.rlike("<[a-z]+>").alias("markup"))


@query("x12_word_count", "SELECT doc_id, LEN(REGEXP_EXTRACT_ALL(text, '[A-Za-z]{3,}')) AS words FROM documents")
def word_count(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.regexp_count("text", F.lit("[A-Za-z]{3,}")).cast("long").alias("words"))


def without_tokens(text: Column, tokens: Column) -> Column:
    """The text after every token, in order, is replaced by nothing."""
    return F.aggregate(tokens, text, lambda acc, x: F.replace(acc, x, F.lit("")))


@query("x13_sequential_replace", "SELECT p_partkey, REPLACE(REPLACE(p_name, STRING_SPLIT(p_name, ' ')[1], ''), 'e', '') AS rest FROM part")
def sequential(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", without_tokens(F.col("p_name"), F.array(F.split("p_name", " ")[0], F.lit("e"))).alias("rest"))


@query("x14_full_match", "SELECT p_partkey, REGEXP_FULL_MATCH(p_brand, 'Brand#[0-9]+') AS full_match FROM part")
def full_match(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.col("p_brand").rlike("^(?:Brand#[0-9]+)$").alias("full_match"))


@query("x15_homoglyphs", "SELECT s_suppkey, TRANSLATE(s_name, 'aeo', 'аео') AS mapped FROM supplier")
def homoglyphs(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", F.translate("s_name", "aeo", "аео").alias("mapped"))


@query("x16_substring_count", "SELECT page_id, LEN(REGEXP_EXTRACT_ALL(LOWER(html), '<p>')) AS paragraphs FROM pages")
def substring_count(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_count(F.lower("html"), F.lit("<p>")).cast("long").alias("paragraphs"))


def url_kind(url: Column) -> Column:
    return F.when(F.parse_url(url, F.lit("QUERY"), F.lit("query")).isNotNull(), "dictionary-query").when(url.rlike("^https?://"), "external-http").when(url.rlike("^[a-z]+:"), F.concat(F.lit("scheme-"), F.regexp_extract(url, "^([a-z]+):", 1))).otherwise("relative")


@query("x17_url_kinds", "SELECT page_id, CASE WHEN REGEXP_MATCHES(u, '[?&]query=') THEN 'dictionary-query' WHEN REGEXP_MATCHES(u, '^https?://') THEN 'external-http' WHEN REGEXP_MATCHES(u, '^[a-z]+:') THEN 'scheme-' || REGEXP_EXTRACT(u, '^([a-z]+):', 1) ELSE 'relative' END AS kind FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '?query=x' WHEN 1 THEN 'mailto:x' WHEN 2 THEN 'a/b.html' ELSE 'https://example.com/' || page_id END AS u FROM pages)")
def url_kinds(t: Tables) -> DataFrame:
    u = F.when(F.col("page_id") % 4 == 0, "?query=x").when(F.col("page_id") % 4 == 1, "mailto:x").when(F.col("page_id") % 4 == 2, "a/b.html").otherwise(F.concat(F.lit("https://example.com/"), F.col("page_id").cast("string")))
    return t.pages.select("page_id", url_kind(u).alias("kind"))


def html_escape(col: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        col = F.replace(col, F.lit(a), F.lit(b))
    return col


@query("x18_html_escape", "SELECT page_id, MD5(REPLACE(REPLACE(REPLACE(REPLACE(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')) AS h FROM pages")
def escaped(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(html_escape(F.col("html"))).alias("h"))


def css_class(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, "[^a-zA-Z0-9_-]+", "-"), "^-+|-+$", "")


@query("x19_css_class", "SELECT p_partkey, TRIM(REGEXP_REPLACE('#' || p_brand || ' ' || p_type || '!', '[^a-zA-Z0-9_-]+', '-', 'g'), '-') AS css FROM part")
def css(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", css_class(F.concat(F.lit("#"), "p_brand", F.lit(" "), "p_type", F.lit("!"))).alias("css"))


def safe_path(col: Column) -> Column:
    """Relative, without empty, ``.`` or ``..`` parts or backslashes."""
    return ~(col.rlike(r"^/|\\|^$") | F.exists(F.split(col, "/"), lambda p: p.isin("", ".", "..")))


PATHS = (("media/x.png", True), ("a/../b", False), ("/etc", False), ("..", False), ("a/..b/c", True), ("", False), ("a//b", False), ("./a", False), ("a\\b", False), ("é/ü.mp3", True))


@query("x20_safe_path", f"SELECT page_id, CASE page_id % {len(PATHS)} " + " ".join(f"WHEN {k} THEN {str(v).upper()}" for k, (_, v) in enumerate(PATHS)) + " END AS safe FROM pages")
def safe(t: Tables) -> DataFrame:
    p = F.element_at(F.array(*(F.lit(x) for x, _ in PATHS)), (F.col("page_id") % len(PATHS) + 1).cast("int"))
    return t.pages.select("page_id", safe_path(p).alias("safe"))


@query("x21_rank_labels", "SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 0 THEN (o_orderkey // 1000) || 'k' ELSE FORMAT('{:,}', o_orderkey) END AS label FROM orders")
def rank_labels(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", F.when(k % 1000 == 0, F.concat((k / 1000).cast("long").cast("string"), F.lit("k"))).otherwise(F.format_number(k, 0)).alias("label"))


@query("x22_version_extract", "SELECT p_partkey, REGEXP_EXTRACT(p_brand, '#([0-9]+)', 1) AS version FROM part")
def version(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.regexp_extract("p_brand", "#([0-9]+)", 1).alias("version"))


@query("x23_iso_timestamps", "SELECT event_id, STRFTIME(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def iso(t: Tables) -> DataFrame:
    """Naive times are UTC."""
    return t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))


@query("x24_byte_and_code_point_length", "SELECT doc_id, CAST(STRLEN(text) AS BIGINT) AS bytes, LENGTH(text) AS code_points FROM documents")
def lengths(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.octet_length("text").cast("long").alias("bytes"), F.length("text").cast("long").alias("code_points"))


def token_cost(tokens_in: Column, cached: Column, tokens_out: Column, price_in: str, price_cached: str, price_out: str, factor: str = "1") -> Column:
    """Exact cost in decimals: prices are for a million tokens."""
    d = lambda x: F.lit(x).cast("decimal(10,4)")
    n = lambda c: c.cast("decimal(12,0)")
    return ((n(tokens_in - cached) * d(price_in) + n(cached) * d(price_cached) + n(tokens_out) * d(price_out)) * F.lit(factor).cast("decimal(4,2)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,12)")


@query("x25_exact_cost", "SELECT o_orderkey, CAST((CAST(1000 + o_custkey - 100 AS DECIMAL(18,4)) * 0.25 + CAST(100 AS DECIMAL(18,4)) * 0.025 + CAST(o_custkey AS DECIMAL(18,4)) * 2.0) * 0.5 * 1000000 AS BIGINT) AS micro_cost FROM orders")
def exact_cost(t: Tables) -> DataFrame:
    cost = token_cost(F.lit(1000) + F.col("o_custkey"), F.lit(100), F.col("o_custkey"), "0.25", "0.025", "2.0", "0.5")
    return t.orders.select("o_orderkey", (cost * F.lit(10**12).cast("decimal(13,0)")).cast("long").alias("micro_cost"))


@query("x26_backend_normalisation", "SELECT o_orderkey, STRFTIME(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dated, HEX(o_orderstatus) AS status_hex, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders")
def normalised(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("dated"), F.hex("o_orderstatus").alias("status_hex"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


#: JSON values, and whether each is a non-negative integer.
VALUES = (("3", True), ("0", True), ("-1", False), ("true", False), ("false", False), ("1.5", False), ("1.0", False), ('"1"', False), ("null", False), ("[1]", False), ("12345678901", True))


@query("x27_integer_strictness", f"SELECT event_id, CASE event_id % {len(VALUES)} " + " ".join(f"WHEN {k} THEN {str(v).upper()}" for k, (_, v) in enumerate(VALUES)) + " END AS strict FROM events")
def strictness(t: Tables) -> DataFrame:
    """A JSON number without a fraction that isn't below zero; true and false are none."""
    raw = F.concat(F.lit('{"k":'), F.element_at(F.array(*(F.lit(x) for x, _ in VALUES)), (F.col("event_id") % len(VALUES) + 1).cast("int")), F.lit("}"))
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(F.try_variant_get(v, "$.k", "variant"))
    fine = kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT") & (F.try_variant_get(v, "$.k", "bigint") >= 0)
    return t.events.select("event_id", F.coalesce(fine, F.lit(False)).alias("strict"))


@query("x28_suffix_swap", "SELECT page_id, REGEXP_REPLACE('media/' || page_id || '.avif', '\\.avif$', '.png') AS path FROM pages")
def suffix_swap(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_replace(F.concat(F.lit("media/"), F.col("page_id").cast("string"), F.lit(".avif")), r"\.avif$", ".png").alias("path"))
