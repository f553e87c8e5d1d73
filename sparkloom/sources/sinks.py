"""Sinks: bounded chunks, deterministic archives, manifests, indexes with offsets, export frames."""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import io
import shutil
import subprocess
import tempfile
import uuid
import zipfile
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.scalars import html_escape
from sparkloom.operators.aggregates import ordered_distinct
from sparkloom.operators.packing import BIG, pack_ranges, recursive_pack
from sparkloom.operators.windows import key_ranges, pages, places, running_offset
from sparkloom.registry import Tables, query
from sparkloom.sources.scans import pack_index, part_archives, zip_members


def scratch(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see: below ``spark.checkpoint.dir``, or a temporary one in a local session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named}/sparkloom-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    place = tempfile.mkdtemp(prefix="sparkloom-")
    atexit.register(shutil.rmtree, place, ignore_errors=True)
    return f"file://{place}/t"


def write_table(df: DataFrame, path: str, *, by: list[str] | None = None, mode: str = "overwrite") -> None:
    """A committed columnar table: either all of it is visible or nothing."""
    w = df.write.mode(mode)
    (w.partitionBy(*by) if by else w).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """A table in place of the one at ``path``: written beside it and moved there when it is whole, so a failed write leaves the old one."""
    spark = df.sparkSession
    fresh = f"{path}.{uuid.uuid4().hex}.tmp"
    at, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, fresh))
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.parquet(fresh)
        files.delete(at, True)
        if not files.rename(new, at):
            raise OSError(f"could not move the new table to {path}")
    finally:
        files.delete(new, True)


@query("k01_atomic_write", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def atomic_write(t: Tables) -> DataFrame:
    """What stands after a good write, a better one, and one that fails half way."""
    path = scratch(t.spark)
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    replace_table(rows, path)
    replace_table(rows.where("o_orderstatus = 'F'"), path)
    broken = F.when(F.col("o_orderkey") > 10, F.raise_error(F.lit("half way")).cast("string")).otherwise(F.col("o_orderstatus"))
    with contextlib.suppress(Exception):
        replace_table(rows.select("o_orderkey", broken.alias("o_orderstatus")), path)
    return t.spark.read.parquet(path)


def bulk_load(df: DataFrame, path: str, *, by: str, keys: list[str]) -> DataFrame:
    """A table loaded in parallel, a folder for each value of ``by``, read back; keys that come twice are an error, before anything is written."""
    if not (twice := df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")).isEmpty():
        raise ValueError(f"keys come twice, such as {twice.first()}")
    df.repartition(by).write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("k02_bulk_load", "SELECT c_nationkey, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys, COUNT(DISTINCT c_name) AS names FROM customer GROUP BY 1")
def loaded(t: Tables) -> DataFrame:
    got = bulk_load(t.customer.select("c_custkey", "c_name", "c_nationkey"), scratch(t.spark), by="c_nationkey", keys=["c_custkey"])
    return got.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"), F.countDistinct("c_name").alias("names"))


def json_chunks(rows: DataFrame, group: str, order: str, line: Column, limit: int) -> DataFrame:
    """(group, chunk, text): JSON arrays of consecutive lines of at most ``limit`` bytes, brackets and commas included.

    ``order`` is an integer key; a chunk never spans two of its ranges (:func:`pack_ranges`).
    """
    sized = rows.select(group, order, line.alias("line")).withColumn("bytes", F.octet_length("line").cast("long")).withColumn("units", F.lit(1).cast("long"))
    placed = pack_ranges(sized, group, order, items=BIG, bytes_=limit, units=BIG)
    g = sized.join(placed, [group, order]).groupBy(group, "range", "batch").agg(F.array_sort(F.collect_list(F.struct(order, "line"))).alias("x"))
    # a short row for each chunk
    numbers = placed.select(F.col(group).alias("_group"), F.col("range").alias("_range"), F.col("batch").alias("_batch")).distinct().withColumn("chunk", F.row_number().over(Window.partitionBy("_group").orderBy("_range", "_batch")).cast("long") - 1)
    met = g.join(numbers, F.col(group).eqNullSafe(F.col("_group")) & (F.col("range") == F.col("_range")) & (F.col("batch") == F.col("_batch")))
    return met.select(group, "chunk", F.concat(F.lit("["), F.array_join(F.transform("x", lambda v: v["line"]), ","), F.lit("]")).alias("text"))


def chunk_sql(limit: int) -> str:
    """Chunks b(g, o, line, chunk) of l(g, o, line) for DuckDB: folded in the same ranges of keys, numbered across them."""
    return f"""s AS (SELECT g || '/' || (o // 100000) AS g, o, CAST(STRLEN(line) AS BIGINT) AS bytes, 1::BIGINT AS units FROM l), {recursive_pack(BIG, limit, BIG)}, b AS (SELECT l.g, l.o, l.line, DENSE_RANK() OVER (PARTITION BY l.g ORDER BY l.o // 100000, batch) - 1 AS chunk FROM f JOIN l ON f.g = l.g || '/' || (l.o // 100000) AND f.o = l.o)"""


@query("k03_bounded_json_chunks", f"""WITH RECURSIVE l AS (SELECT p_type AS g, p_partkey AS o, '{{"n":"' || p_name || '"}}' AS line FROM part), {chunk_sql(2000)} SELECT g AS p_type, chunk, SHA256('[' || STRING_AGG(line, ',' ORDER BY o) || ']') AS sha256, CAST(SUM(STRLEN(line)) + COUNT(*) + 1 AS BIGINT) AS bytes FROM b GROUP BY 1, 2""")
def bounded_chunks(t: Tables) -> DataFrame:
    line = F.to_json(F.struct(F.col("p_name").alias("n")))
    c = json_chunks(t.part, "p_type", "p_partkey", line, 2000)
    return c.select("p_type", "chunk", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"))


@query("k04_deterministic_archive", "SELECT p_type, TRUE AS reproducible FROM part GROUP BY 1")
def deterministic(t: Tables) -> DataFrame:
    a = part_archives(t).select("p_type", F.sha2("content", 256).alias("a"))
    b = part_archives(t).select("p_type", F.sha2("content", 256).alias("b"))
    return a.join(b, "p_type").select("p_type", (F.col("a") == F.col("b")).alias("reproducible"))


def file_manifest(files: DataFrame, path: str, content: Column) -> DataFrame:
    """One row: the sorted list of path, hash and size, and its own hash."""
    f = files.select(F.col(path).alias("path"), F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("bytes"))
    g = f.agg(F.array_sort(F.collect_list(F.struct("path", "sha256", "bytes"))).alias("files"))
    return g.select("files", F.sha2(F.array_join(F.transform("files", lambda x: F.concat_ws(" ", x["path"], x["sha256"], x["bytes"].cast("string"))), "\n"), 256).alias("manifest_sha256"))


@query("k05_file_manifest", "SELECT COUNT(*) AS files, SHA256(STRING_AGG(n_name || ' ' || SHA256(n_name) || ' ' || STRLEN(n_name), chr(10) ORDER BY n_name)) AS manifest_sha256 FROM nation")
def manifest(t: Tables) -> DataFrame:
    return file_manifest(t.nation, "n_name", F.encode("n_name", "utf-8")).select(F.size("files").cast("long").alias("files"), "manifest_sha256")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("sha256", T.StringType()), T.StructField("bytes", T.LongType())])))
def archive_members(content: pd.Series) -> pd.Series:
    """The members of a ZIP, in its order."""

    def one(data: bytes) -> list[dict]:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            return [{"name": n, "sha256": hashlib.sha256(z.read(n)).hexdigest(), "bytes": z.getinfo(n).file_size} for n in z.namelist()]

    return content.map(one)


def build_archives(articles: DataFrame, by: str, order: str, row: str, index: Column, tags: DataFrame, limit: int = 100_000) -> DataFrame:
    """(by, content): an archive for each group, with its index first, its tag bank, and banks of rows of ``limit`` bytes at most; equal input gives equal bytes."""
    banks = json_chunks(articles, by, order, F.col(row), limit)
    part = lambda place, name, text: F.struct(F.lit(place).alias("place"), F.lit(0).cast("long").alias("nth") if isinstance(name, str) else name[0].alias("nth"), (F.lit(name) if isinstance(name, str) else name[1]).alias("n"), text.alias("t"))
    nth = F.col("chunk") + 1
    terms = banks.select(by, part(2, (nth, F.concat(F.lit("term_bank_"), nth.cast("string"), F.lit(".json"))), F.col("text")).alias("m"))
    groups = articles.select(by).distinct()
    heads = groups.select(by, part(0, "index.json", index).alias("m"))
    bank = tags.groupBy(by).agg(F.sort_array(F.collect_list("tag")).alias("x")).select(by, part(1, "tag_bank_1.json", F.concat(F.lit("["), F.array_join("x", ","), F.lit("]"))).alias("m"))
    g = terms.unionByName(heads).unionByName(bank).groupBy(by).agg(F.sort_array(F.collect_list("m")).alias("m"))
    return g.select(by, zip_members(F.transform("m", lambda v: v["n"]), F.transform("m", lambda v: v["t"])).alias("content"))


ROW_LINE = "'[' || p_partkey || ',\"' || p_name || '\"]'"


@query(
    "k06_archive_build",
    f"""WITH RECURSIVE l AS (SELECT p_type AS g, p_partkey AS o, {ROW_LINE} AS line FROM part), {chunk_sql(1500)}, t AS (SELECT g, chunk AS batch, '[' || STRING_AGG(line, ',' ORDER BY o) || ']' AS text FROM b GROUP BY 1, 2),
 m AS (SELECT g, 0 AS place, 0 AS nth, 'index.json' AS name, '{{"title":"' || g || '","revision":"v1"}}' AS text FROM (SELECT DISTINCT g FROM l) UNION ALL SELECT p_type, 1, 0, 'tag_bank_1.json', '[' || STRING_AGG(DISTINCT '"' || p_brand || '"', ',' ORDER BY '"' || p_brand || '"') || ']' FROM part GROUP BY 1 UNION ALL SELECT g, 2, batch + 1, 'term_bank_' || (batch + 1) || '.json', text FROM t)
 SELECT g AS p_type, CAST(ROW_NUMBER() OVER (PARTITION BY g ORDER BY place, nth) AS BIGINT) AS place, name, SHA256(text) AS sha256, CAST(STRLEN(text) AS BIGINT) AS bytes FROM m""",
)
def archives(t: Tables) -> DataFrame:
    """The members of the archives of all types, as they are read back."""
    tags = t.part.select("p_type", F.concat(F.lit('"'), "p_brand", F.lit('"')).alias("tag")).distinct()
    index = F.concat(F.lit('{"title":"'), F.col("p_type"), F.lit('","revision":"v1"}'))
    built = build_archives(t.part.withColumn("row", F.expr(ROW_LINE)), "p_type", "p_partkey", "row", index, tags, limit=1500)
    m = built.select("p_type", F.posexplode(archive_members("content")).alias("k", "m"))
    return m.select("p_type", (F.col("k") + 1).cast("long").alias("place"), "m.name", "m.sha256", "m.bytes")


@query("k07_offset_index", "WITH a AS (SELECT p_type, STRING_SPLIT(p_name, ' ')[1] AS word, SUM(STRLEN(p_name) + 1) AS size FROM part GROUP BY 1, 2) SELECT p_type, word, CAST(size AS BIGINT) AS size, CAST(COALESCE(SUM(size) OVER (PARTITION BY p_type ORDER BY word ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM a")
def offset_index(t: Tables) -> DataFrame:
    """Articles by headword, laid end to end in each volume."""
    a = t.part.groupBy("p_type", F.split("p_name", " ")[0].alias("word")).agg(F.sum(F.octet_length("p_name") + 1).alias("size"))
    return a.select("p_type", "word", "size", running_offset("size", "word", by="p_type").alias("start"))


def dictionary_records(entries_: DataFrame) -> DataFrame:
    """(key, kind, body) of entries (entry, expression, reading): an article for each expression, naming the others that it is a
    reading of; for a reading that is no expression a redirect, or a list of the expressions that have it."""
    heads = entries_.groupBy("expression").agg(F.count("*").alias("variants"))
    by_reading = entries_.where("reading <> expression").groupBy("reading").agg(F.array_sort(F.collect_set("expression")).alias("targets"))
    related = by_reading.withColumnRenamed("reading", "expression")
    said = F.coalesce(F.array_join("targets", ","), F.lit(""))
    own = heads.join(related, "expression", "left").select(F.col("expression").alias("key"), F.lit("article").alias("kind"), F.concat_ws("|", F.col("variants").cast("string"), said).alias("body"))
    rest = by_reading.join(heads, F.col("reading") == F.col("expression"), "left_anti")
    links = F.concat(F.lit("<ul>"), F.array_join(F.transform("targets", lambda x: F.concat(F.lit('<li><a href="entry://'), F.url_encode(x), F.lit('">'), html_escape(x), F.lit("</a></li>"))), ""), F.lit("</ul>"))
    one = F.size("targets") == 1
    more = rest.select(F.col("reading").alias("key"), F.when(one, "redirect").otherwise("disambiguation").alias("kind"), F.when(one, F.concat(F.lit("@@@LINK="), F.col("targets")[0])).otherwise(links).alias("body"))
    return own.unionByName(more)


PAIRS = "w AS (SELECT p_partkey AS entry, p_brand AS expression, CASE WHEN p_partkey % 3 = 0 THEN p_type WHEN p_partkey % 3 = 1 THEN 'x & ' || p_size ELSE 'Brand#' || (p_size % 60) END AS reading FROM part)"


def pairs(t: Tables) -> DataFrame:
    reading = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("x & "), F.col("p_size").cast("string"))).otherwise(F.concat(F.lit("Brand#"), (F.col("p_size") % 60).cast("string")))
    return t.part.select(F.col("p_partkey").alias("entry"), F.col("p_brand").alias("expression"), reading.alias("reading"))


@query(
    "k08_dictionary_source",
    f"WITH {PAIRS}, h AS (SELECT expression, COUNT(*) AS variants FROM w GROUP BY 1), r AS (SELECT reading, LIST(DISTINCT expression ORDER BY expression) AS x FROM w WHERE reading <> expression GROUP BY 1) SELECT h.expression AS key, 'article' AS kind, variants || '|' || COALESCE(ARRAY_TO_STRING(x, ','), '') AS body FROM h LEFT JOIN r ON r.reading = h.expression "
    "UNION ALL SELECT reading, CASE WHEN LEN(x) = 1 THEN 'redirect' ELSE 'disambiguation' END, CASE WHEN LEN(x) = 1 THEN '@@@LINK=' || x[1] ELSE '<ul>' || ARRAY_TO_STRING([('<li><a href=\"entry://' || REPLACE(e, '#', '%23') || '\">' || e || '</a></li>') FOR e IN x], '') || '</ul>' END FROM r WHERE reading NOT IN (SELECT expression FROM h)",
)
def dictionary_source(t: Tables) -> DataFrame:
    return dictionary_records(pairs(t))


def project_entries(entries_: DataFrame) -> DataFrame:
    """(expression, id, xml) of an XML project: an entry with its id, a title, an index value for the expression and each reading, and its variants."""
    g = entries_.groupBy("expression").agg(F.array_sort(F.collect_set("reading")).alias("r"), F.sort_array(F.collect_list("entry")).alias("v"))
    id_ = F.concat(F.lit("e-"), F.substring(F.sha2("expression", 256), 1, 12))
    value = lambda x: F.concat(F.lit('<d:index d:value="'), html_escape(x), F.lit('"/>'))
    indexes = F.concat(value(F.col("expression")), F.array_join(F.transform(F.filter("r", lambda x: x != F.col("expression")), value), ""))
    body = F.array_join(F.transform("v", lambda x: F.concat(F.lit("<p>"), x.cast("string"), F.lit("</p>"))), "")
    return g.select("expression", id_.alias("id"), F.concat(F.lit('<d:entry id="'), id_, F.lit('" d:title="'), html_escape(F.col("expression")), F.lit('">'), indexes, body, F.lit("</d:entry>")).alias("xml"))


@query(
    "k10_index_project",
    f"WITH {PAIRS}, i AS (SELECT DISTINCT expression, reading FROM w WHERE reading <> expression), x AS (SELECT expression, STRING_AGG('<d:index d:value=\"' || REPLACE(reading, '&', '&amp;') || '\"/>', '' ORDER BY reading) AS others FROM i GROUP BY 1), v AS (SELECT expression, STRING_AGG('<p>' || entry || '</p>', '' ORDER BY entry) AS body FROM w GROUP BY 1) "
    "SELECT v.expression, 'e-' || SUBSTRING(SHA256(v.expression), 1, 12) AS id, SHA256('<d:entry id=\"e-' || SUBSTRING(SHA256(v.expression), 1, 12) || '\" d:title=\"' || v.expression || '\"><d:index d:value=\"' || v.expression || '\"/>' || COALESCE(others, '') || body || '</d:entry>') AS sha256 FROM v LEFT JOIN x ON x.expression = v.expression",
)
def index_project(t: Tables) -> DataFrame:
    return project_entries(pairs(t)).select("expression", "id", F.sha2("xml", 256).alias("sha256"))


@query("k11_key_list", "SELECT DISTINCT p_partkey, UNNEST([p_name, p_brand]) AS key FROM part")
def key_list(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.explode(F.concat(F.array("p_name"), F.array("p_brand"))).alias("key")).distinct()


def run_pinned(tool: str, sha256: str, *args: str, timeout: float = 600) -> str:
    """Output of an external tool, run only if its file has the pinned hash."""
    found = hashlib.sha256(Path(tool).read_bytes()).hexdigest()
    if found != sha256:
        raise ValueError(f"{tool} has the hash {found}")
    return subprocess.run([tool, *args], check=True, capture_output=True, text=True, timeout=timeout).stdout


@query("k12_pinned_tools", "SELECT n_name AS tool, CASE WHEN n_nationkey % 4 = 1 THEN 'hash_mismatch' WHEN n_nationkey % 4 = 2 THEN 'not_pinned' ELSE 'ok' END AS outcome FROM nation UNION ALL SELECT 'gone ' || r_name, 'missing' FROM region")
def pinned_tools(t: Tables) -> DataFrame:
    """Tools by the hash of their file against the pins of a release, before any of them runs."""
    files = t.nation.select(F.col("n_name").alias("tool"), F.sha2(F.when(F.col("n_nationkey") % 4 == 1, F.concat("n_name", F.lit("!"))).otherwise(F.col("n_name")), 256).alias("found"))
    pins = t.nation.where("n_nationkey % 4 <> 2").select(F.col("n_name").alias("_tool"), F.sha2("n_name", 256).alias("pin")).unionByName(t.region.select(F.concat(F.lit("gone "), "r_name").alias("_tool"), F.lit("x").alias("pin")))
    met = files.join(pins, F.col("tool") == F.col("_tool"), "full_outer")
    outcome = F.when(F.col("tool").isNull(), "missing").when(F.col("pin").isNull(), "not_pinned").when(F.col("pin") != F.col("found"), "hash_mismatch").otherwise("ok")
    return met.select(F.coalesce("tool", "_tool").alias("tool"), outcome.alias("outcome"))


def media_plan(media: DataFrame, path: str) -> DataFrame:
    """(source, target, action, collides): what becomes of each medium of an export; ``.avif`` is converted and renamed, the rest copied.

    Two sources may not have one target, folded, as file systems fold names.
    """
    source = F.col(path)
    target = F.regexp_replace(source, r"(?i)\.avif$", ".png")
    m = media.select(source.alias("source"), target.alias("target"), F.when(F.lower(source).endswith(".avif"), "convert").otherwise("copy").alias("action")).distinct()
    shared = m.groupBy(F.lower("target").alias("_folded")).agg((F.count("*") > 1).alias("collides"))
    return m.join(shared, F.lower("target") == F.col("_folded")).select("source", "target", "action", "collides")


@query(
    "k13_media_plan",
    "WITH s AS (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN 'media/' || p_size || '.avif' WHEN 1 THEN 'media/' || p_size || '.png' WHEN 2 THEN 'Media/' || p_size || '.AVIF' ELSE 'sound/' || p_size || '.mp3' END AS source FROM part), m AS (SELECT source, REGEXP_REPLACE(source, '(?i)\\.avif$', '.png') AS target, CASE WHEN LOWER(source) LIKE '%.avif' THEN 'convert' ELSE 'copy' END AS action FROM s) "
    "SELECT *, COUNT(*) OVER (PARTITION BY LOWER(target)) > 1 AS collides FROM m",
)
def media(t: Tables) -> DataFrame:
    k, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    path = F.when(k == 0, F.concat(F.lit("media/"), size, F.lit(".avif"))).when(k == 1, F.concat(F.lit("media/"), size, F.lit(".png"))).when(k == 2, F.concat(F.lit("Media/"), size, F.lit(".AVIF"))).otherwise(F.concat(F.lit("sound/"), size, F.lit(".mp3")))
    return media_plan(t.part.select(path.alias("path")), "path")


@query("k14_pages", "SELECT c_nationkey, page, COUNT(*) AS n, MIN(c_custkey) AS first, MAX(c_custkey) AS last FROM (SELECT c_nationkey, c_custkey, (ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 25 + 1 AS page FROM customer) GROUP BY 1, 2")
def paginated(t: Tables) -> DataFrame:
    p = pages(t.customer, 25, "c_custkey", by="c_nationkey").withColumn("page", F.col("page") + 1)
    return p.groupBy("c_nationkey", "page").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"), F.max("c_custkey").alias("last"))


def report_lines(rows: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """(format, place, line) of a report as CSV, with quotes where they are needed, and as a Markdown table; line 0 is the header."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    cell = lambda x: F.when(x.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)
    csv = F.concat_ws(",", *(cell(text(c)) for c in columns))
    md = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.replace(text(c), F.lit("|"), F.lit("\\|")) for c in columns)), F.lit(" |"))
    both = F.explode(F.array(F.struct(F.lit("csv").alias("format"), csv.alias("line")), F.struct(F.lit("markdown").alias("format"), md.alias("line"))))
    body = places(rows.withColumn("_range", key_ranges(rows, order)), {"_range": F.col("_range")}, order).select("place", both.alias("x")).select("x.format", "place", "x.line")
    head = rows.sparkSession.createDataFrame([("csv", 0, ",".join(columns)), ("markdown", -1, f"| {' | '.join(columns)} |"), ("markdown", 0, "|---" * len(columns) + "|")], "format string, place long, line string")
    return head.unionByName(body)


@query(
    "k15_report",
    "WITH n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY n_nationkey) AS place, CASE WHEN n_nationkey % 3 = 0 THEN n_name || ', \"x\"' WHEN n_nationkey % 3 = 1 THEN n_name || '|y' ELSE n_name END AS label FROM nation) SELECT 'csv' AS format, place, n_nationkey || ',' || CASE WHEN n_nationkey % 3 = 0 THEN '\"' || REPLACE(label, '\"', '\"\"') || '\"' ELSE label END AS line FROM n "
    "UNION ALL SELECT 'markdown', place, '| ' || n_nationkey || ' | ' || REPLACE(label, '|', '\\|') || ' |' FROM n UNION ALL SELECT 'csv', 0, 'n_nationkey,label' UNION ALL SELECT 'markdown', -1, '| n_nationkey | label |' UNION ALL SELECT 'markdown', 0, '|---|---|'",
)
def report(t: Tables) -> DataFrame:
    label = F.when(F.col("n_nationkey") % 3 == 0, F.concat("n_name", F.lit(', "x"'))).when(F.col("n_nationkey") % 3 == 1, F.concat("n_name", F.lit("|y"))).otherwise(F.col("n_name"))
    return report_lines(t.nation.select("n_nationkey", label.alias("label")), "n_nationkey", ["n_nationkey", "label"])


def append_audit(df: DataFrame, path: str) -> None:
    """Rows are added and never changed."""
    df.write.mode("append").parquet(path)


@query("k16_audit_rows", "SELECT o_orderkey, 'status' AS action, '{\"to\":\"' || o_orderstatus || '\"}' AS details FROM orders WHERE o_orderstatus <> 'O'")
def audit_rows(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus <> 'O'").select("o_orderkey", F.lit("status").alias("action"), F.to_json(F.struct(F.col("o_orderstatus").alias("to"))).alias("details"))


@query("k17_timestamp_normalised_copy", "SELECT event_id, epoch_us(ts) AS micros FROM events")
def timestamp_copy(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))


@query("k18_referential_subset", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))")
def referential_subset(t: Tables) -> DataFrame:
    o = t.orders.join(t.customer.where("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("l_orderkey", "l_partkey")


@query("k19_patched_metadata", """SELECT s_suppkey, '{"title":"' || s_name || '","revision":"r2","isUpdatable":true}' AS index_json FROM supplier""")
def patched(t: Tables) -> DataFrame:
    base = F.struct(F.col("s_name").alias("title"), F.lit("r1").alias("revision"), F.lit(False).alias("isUpdatable"))
    return t.supplier.select("s_suppkey", F.to_json(base.withField("revision", F.lit("r2")).withField("isUpdatable", F.lit(True))).alias("index_json"))


def release_manifest(losses: DataFrame, files: DataFrame, tools: dict[str, str]) -> DataFrame:
    """One row: the manifest of a release as JSON, its hash, and whether it may go out.

    ``losses`` (feature, fidelity, n) is the ledger, of which nothing may be
    omitted; ``files`` (path, sha256, bytes) and the tools' hashes come in order.
    """
    by = losses.groupBy("fidelity").agg(F.sum("n").alias("n")).agg(F.sort_array(F.collect_list(F.struct("fidelity", "n"))).alias("losses"))
    omitted = losses.agg(F.coalesce(F.sum(F.when(F.col("fidelity") == "omitted", F.col("n"))), F.lit(0)).alias("omitted"))
    listed = file_manifest(files, "path", F.col("content")).select(F.size("files").cast("long").alias("files"), F.col("manifest_sha256"))
    used = F.to_json(F.array(*(F.struct(F.lit(k).alias("name"), F.lit(v).alias("sha256")) for k, v in sorted(tools.items()))))
    row = listed.crossJoin(F.broadcast(by)).crossJoin(F.broadcast(omitted))
    raw = F.concat(F.lit('{"files":'), F.col("files").cast("string"), F.lit(',"files_sha256":"'), "manifest_sha256", F.lit('","losses":'), F.to_json("losses"), F.lit(',"tools":'), used, F.lit("}"))
    return row.select(raw.alias("manifest"), F.sha2(raw, 256).alias("sha256"), "omitted", (F.col("omitted") == 0).alias("releasable"))


FIDELITY = "CASE p_size % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'adapted' WHEN 2 THEN 'degraded' ELSE 'omitted' END"
TOOLS = {"writer": hashlib.sha256(b"writer-1").hexdigest(), "reader": hashlib.sha256(b"reader-2").hexdigest()}


@query(
    "k20_release_manifest",
    f"WITH l AS (SELECT {FIDELITY} AS fidelity, COUNT(*) AS n FROM part GROUP BY 1), f AS (SELECT COUNT(*) AS files, SHA256(STRING_AGG(n_name || ' ' || SHA256(n_name) || ' ' || STRLEN(n_name), chr(10) ORDER BY n_name)) AS h FROM nation), "
    f"m AS (SELECT '{{\"files\":' || files || ',\"files_sha256\":\"' || h || '\",\"losses\":[' || (SELECT STRING_AGG('{{\"fidelity\":\"' || fidelity || '\",\"n\":' || n || '}}', ',' ORDER BY fidelity) FROM l) || '],\"tools\":[{{\"name\":\"reader\",\"sha256\":\"{TOOLS['reader']}\"}},{{\"name\":\"writer\",\"sha256\":\"{TOOLS['writer']}\"}}]}}' AS manifest FROM f) "
    "SELECT manifest, SHA256(manifest) AS sha256, CAST((SELECT COALESCE(SUM(n) FILTER (fidelity = 'omitted'), 0) FROM l) AS BIGINT) AS omitted, (SELECT COUNT(*) FROM l WHERE fidelity = 'omitted') = 0 AS releasable FROM m",
)
def release(t: Tables) -> DataFrame:
    losses = t.part.groupBy(F.col("p_type").alias("feature"), F.expr(FIDELITY).alias("fidelity")).agg(F.count("*").alias("n"))
    return release_manifest(losses, t.nation.select(F.col("n_name").alias("path"), F.encode("n_name", "utf-8").alias("content")), TOOLS)


@query(
    "k22_package_builds",
    "WITH a AS (SELECT p_type, STRING_SPLIT(p_name, ' ')[1] AS word, SUM(STRLEN(p_name) + 1) AS size FROM part GROUP BY 1, 2), s AS (SELECT p_type, COUNT(*) AS words, CAST(SUM(STRLEN(word) + 9) AS BIGINT) AS index_bytes, CAST(SUM(size) AS BIGINT) AS data_bytes FROM a GROUP BY 1) "
    "SELECT p_type, words, index_bytes, data_bytes, 'version=2.4.2' || chr(10) || 'bookname=' || p_type || chr(10) || 'wordcount=' || words || chr(10) || 'idxfilesize=' || index_bytes || chr(10) AS info, SHA256(chr(10)) <> SHA256('') AS complete FROM s",
)
def package_builds(t: Tables) -> DataFrame:
    """The files of an index dictionary for each type, built and measured: articles end to end, their index, and what describes them."""
    articles = t.part.groupBy("p_type", F.split("p_name", " ")[0].alias("word")).agg(F.array_join(F.sort_array(F.collect_list(F.struct("p_partkey", F.concat("p_name", F.lit("\n")).alias("x")))).getField("x"), "").alias("text"))
    sized = articles.withColumn("size", F.octet_length("text").cast("long"))
    placed = sized.withColumn("start", running_offset("size", "word", by="p_type"))
    record = pack_index(F.col("word"), F.col("start"), F.col("size"))
    g = placed.groupBy("p_type").agg(F.sort_array(F.collect_list(F.struct("start", record.alias("r"), "text"))).alias("x"))
    index, data = F.aggregate(F.col("x.r"), F.lit(b""), lambda a, b: F.concat(a, b)), F.array_join("x.text", "")
    files = g.select("p_type", F.size("x").cast("long").alias("words"), F.length(index).cast("long").alias("index_bytes"), F.octet_length(data).cast("long").alias("data_bytes"))
    info = F.concat(F.lit("version=2.4.2\nbookname="), "p_type", F.lit("\nwordcount="), F.col("words").cast("string"), F.lit("\nidxfilesize="), F.col("index_bytes").cast("string"), F.lit("\n"))
    return files.select("p_type", "words", "index_bytes", "data_bytes", info.alias("info"), (F.col("index_bytes") > 0).alias("complete"))


def export_corpus(rows: DataFrame, expression: str, reading: str, order: str, body: Column) -> DataFrame:
    """One row for each expression: its variants in order, and its other readings, each once. All exports read this."""
    other = F.when(F.col(reading) != F.col(expression), F.col(reading))
    g = rows.groupBy(F.col(expression).alias("expression")).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), body.alias("body")))).alias("v"), ordered_distinct(other, F.col(order)).alias("r"))
    return g.select("expression", F.transform("v", lambda x: x["body"]).alias("variants"), F.filter("r", lambda x: x.isNotNull()).alias("readings"))


@query("k21_export_corpus", "WITH f AS (SELECT p_type, p_brand, MIN(p_partkey) AS k FROM part GROUP BY 1, 2), r AS (SELECT p_type, STRING_AGG(p_brand, ',' ORDER BY k) AS readings FROM f GROUP BY 1) SELECT part.p_type AS expression, SHA256(STRING_AGG(p_name, chr(10) ORDER BY p_partkey)) AS sha256, MIN(readings) AS readings FROM part JOIN r ON r.p_type = part.p_type GROUP BY 1")
def corpus(t: Tables) -> DataFrame:
    c = export_corpus(t.part, "p_type", "p_brand", "p_partkey", F.col("p_name"))
    return c.select("expression", F.sha2(F.array_join("variants", "\n"), 256).alias("sha256"), F.array_join("readings", ",").alias("readings"))


@query("k23_sample_pages", "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R') ORDER BY p_partkey LIMIT 20")
def sample_pages(t: Tables) -> DataFrame:
    wanted = t.lineitem.where("l_quantity = 50 AND l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.join(wanted, "p_partkey", "left_semi").orderBy("p_partkey").limit(20).select("p_partkey", "p_name")


@query("k24_export_registration", "SELECT 'export' AS kind, SHA256(r_name) AS sha256 FROM region UNION ALL SELECT 'export_file', SHA256(n_name) FROM nation UNION ALL SELECT 'audit', SHA256('built:' || r_name) FROM region")
def registration(t: Tables) -> DataFrame:
    one = lambda kind, df, c: df.select(F.lit(kind).alias("kind"), F.sha2(c, 256).alias("sha256"))
    return one("export", t.region, F.col("r_name")).unionByName(one("export_file", t.nation, F.col("n_name"))).unionByName(one("audit", t.region, F.concat(F.lit("built:"), F.col("r_name"))))


