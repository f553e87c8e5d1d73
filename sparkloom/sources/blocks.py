"""Binary dictionaries of compressed key and record blocks: written, read back and verified, a file for each group.

The layout is the public one of version 2: a header in UTF-16 with its checksum,
a section of keys with where their records begin, and a section of records; both
in zlib blocks with an Adler-32 of what they hold. Keys are in the order of their
bytes with ASCII letters folded, then of their bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import quoteattr

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import BinaryType

from sparkloom.registry import Tables, query

#: Fixed values of the format.
ZLIB = b"\x02\x00\x00\x00"
ATTRIBUTES = {"GeneratedByEngineVersion": "2.0", "RequiredEngineVersion": "2.0", "Format": "Html", "Encrypted": "No", "Encoding": "UTF-8"}
BLOCK = 1 << 16


def sort_key(key: str) -> tuple[bytes, bytes]:
    raw = key.encode()
    return raw.lower(), raw  # of bytes: ASCII letters alone


def block(data: bytes) -> bytes:
    return ZLIB + struct.pack(">I", zlib.adler32(data)) + zlib.compress(data, 9)


def unblock(data: bytes) -> bytes:
    if data[:4] != ZLIB:
        raise ValueError("unknown compression")
    out = zlib.decompress(data[8:])
    if struct.pack(">I", zlib.adler32(out)) != data[4:8]:
        raise ValueError("block checksum mismatch")
    return out


def pieces(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of elements of about ``BLOCK`` bytes."""
    at = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > BLOCK:
            yield at, k
            at, total = k, 0
        total += size
    if at < len(sizes):
        yield at, len(sizes)


def write_dictionary(entries: list[tuple[str, str]], title: str) -> bytes:
    for key, body in entries:
        if not key or any(c in key for c in "\0\r\n"):
            raise ValueError(f"not a key: {key!r}")
        if "\0" in body:
            raise ValueError(f"the record of {key!r} holds a zero")
    entries = sorted(entries, key=lambda e: sort_key(e[0]))
    said = "<Dictionary " + " ".join(f"{k}={quoteattr(v)}" for k, v in {**ATTRIBUTES, "Title": title}.items()) + "/>\r\n\0"
    head = said.encode("utf-16-le")
    out = [struct.pack(">I", len(head)), head, struct.pack("<I", zlib.adler32(head))]
    keys, bodies = [k.encode() for k, _ in entries], [b.encode() + b"\0" for _, b in entries]
    starts, at = [], 0
    for body in bodies:
        starts.append(at)
        at += len(body)
    info, key_blocks = [], []
    for a, b in pieces([len(k) + 9 for k in keys]):
        raw = b"".join(struct.pack(">Q", starts[i]) + keys[i] + b"\0" for i in range(a, b))
        packed = block(raw)
        ends = b"".join(struct.pack(">H", len(keys[i])) + keys[i] + b"\0" for i in (a, b - 1))
        info.append(struct.pack(">Q", b - a) + ends + struct.pack(">QQ", len(packed), len(raw)))
        key_blocks.append(packed)
    raw_info = b"".join(info)
    packed_info = block(raw_info)
    counts = struct.pack(">QQQQQ", len(key_blocks), len(keys), len(raw_info), len(packed_info), sum(map(len, key_blocks)))
    out += [counts, struct.pack(">I", zlib.adler32(counts)), packed_info, *key_blocks]
    records = [(b"".join(bodies[a:b])) for a, b in pieces(list(map(len, bodies)))]
    packed = [block(r) for r in records]
    sizes = b"".join(struct.pack(">QQ", len(p), len(r)) for p, r in zip(packed, records, strict=True))
    out += [struct.pack(">QQQQ", len(packed), len(keys), len(sizes), sum(map(len, packed))), sizes, *packed]
    return b"".join(out)


class Reader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        if len(out) != n:
            raise ValueError("truncated file")
        self.at += n
        return out

    def numbers(self, form: str) -> tuple:
        return struct.unpack(form, self.take(struct.calcsize(form)))


def read_header(reader: Reader) -> dict[str, str]:
    """Attributes of a header whose length, checksum, markup and fixed values are right."""
    (size,) = reader.numbers(">I")
    if not size:
        raise ValueError("invalid header length")
    head = reader.take(size)
    if reader.numbers("<I")[0] != zlib.adler32(head):
        raise ValueError("header checksum mismatch")
    try:
        element = ElementTree.fromstring(head.decode("utf-16-le").rstrip("\0\r\n"))
    except (UnicodeDecodeError, ElementTree.ParseError) as error:
        raise ValueError("header isn't XML") from error
    if element.tag != "Dictionary" or any(element.attrib.get(k) != v for k, v in ATTRIBUTES.items()):
        raise ValueError("unsupported header")
    return dict(element.attrib)


def read_dictionary(data: bytes) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """The header and all (key, record) of a file, in its order; anything out of place is an error."""
    reader = Reader(data)
    head = read_header(reader)
    at = reader.at
    blocks, entries, raw_size, packed_size, keys_size = reader.numbers(">QQQQQ")
    if reader.numbers(">I")[0] != zlib.adler32(data[at : at + 40]):
        raise ValueError("key section checksum mismatch")
    info = Reader(unblock(reader.take(packed_size)))
    if len(info.data) != raw_size:
        raise ValueError("key index has another size")
    sizes = []
    for _ in range(blocks):
        (n,) = info.numbers(">Q")
        for _ in range(2):
            info.take(info.numbers(">H")[0] + 1)
        sizes.append((n, *info.numbers(">QQ")))
    if sum(s[1] for s in sizes) != keys_size or sum(s[0] for s in sizes) != entries:
        raise ValueError("key blocks don't add up")
    starts, keys = [], []
    for n, packed, raw in sizes:
        part = Reader(unblock(reader.take(packed)))
        if len(part.data) != raw:
            raise ValueError("key block has another size")
        for _ in range(n):
            starts.append(part.numbers(">Q")[0])
            end = part.data.index(b"\0", part.at)
            keys.append(part.take(end - part.at).decode())
            part.take(1)
    blocks, count, index, total = reader.numbers(">QQQQ")
    sizes = [reader.numbers(">QQ") for _ in range(blocks)]
    if index != 16 * blocks or count != entries or sum(s[0] for s in sizes) != total:
        raise ValueError("record blocks don't add up")
    records = b"".join(unblock(reader.take(packed)) for packed, _ in sizes)
    if reader.at != len(data) or len(records) != sum(s[1] for s in sizes):
        raise ValueError("data after the end")
    if keys != sorted(keys, key=sort_key):
        raise ValueError("keys out of order")
    ends = [*starts[1:], len(records)][: len(starts)]
    if starts and (starts[0] or any(a >= b for a, b in zip(starts, ends, strict=True))):
        raise ValueError("records aren't contiguous")
    return head, [(k, records[a : b - 1].decode()) for k, a, b in zip(keys, starts, ends, strict=True)]


@F.pandas_udf(BinaryType())
def dictionary_file(titles: pd.Series, keys: pd.Series, bodies: pd.Series) -> pd.Series:
    return pd.Series([write_dictionary(list(zip(k, b, strict=True)), t) for t, k, b in zip(titles, keys, bodies, strict=True)])


@udtf(returnType="title string, place int, key string, body string, error string", useArrow=True)
class DictionaryRecords:
    """The records of a file, or one row that says what is wrong with it."""

    def eval(self, data: bytes):
        try:
            head, records = read_dictionary(data)
        except (ValueError, struct.error, zlib.error) as error:
            yield None, None, None, None, str(error)
            return
        for place, (key, body) in enumerate(records):
            yield head["Title"], place, key, body, None


def volumes(t: Tables) -> DataFrame:
    """(p_type, content): parts by name and number, a file for each type."""
    key = F.concat_ws(" ", F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")), F.col("p_partkey").cast("string"))
    g = t.part.groupBy("p_type").agg(F.sort_array(F.collect_list(F.struct(key.alias("k"), F.col("p_brand").alias("b")))).alias("x"))
    return g.select("p_type", dictionary_file("p_type", F.col("x.k"), F.col("x.b")).alias("content"))


def read_files(files: DataFrame, key: str) -> DataFrame:
    files.sparkSession.udtf.register("sparkloom_dictionary", DictionaryRecords)
    return files.sparkSession.sql(f"SELECT f.`{key}`, r.* FROM {{f}} f, LATERAL sparkloom_dictionary(f.content) r", f=files)


VOLUME = "WITH v AS (SELECT p_type, p_brand, CASE WHEN p_partkey % 2 = 0 THEN UPPER(p_name) ELSE p_name END || ' ' || p_partkey AS key FROM part)"


@query("k09_dictionary_writer", f"{VOLUME} SELECT p_type, COUNT(*) AS records, SHA256(STRING_AGG(key || chr(9) || p_brand, chr(10) ORDER BY LOWER(key), key)) AS sha256 FROM v GROUP BY 1")
def written(t: Tables) -> DataFrame:
    """What is read back from the files, in their order."""
    r = read_files(volumes(t), "p_type").groupBy("p_type").agg(F.count("key").alias("records"), F.array_sort(F.collect_list(F.struct("place", "key", "body"))).alias("x"))
    return r.select("p_type", "records", F.sha2(F.array_join(F.transform("x", lambda x: F.concat(x["key"], F.lit("\t"), x["body"])), "\n"), 256).alias("sha256"))


@query("s22_dictionary_decode", f"{VOLUME} SELECT p_type, p_type AS title, CAST(ROW_NUMBER() OVER (PARTITION BY p_type ORDER BY LOWER(key), key) - 1 AS INT) AS place, key, p_brand AS body FROM v")
def decoded(t: Tables) -> DataFrame:
    return read_files(volumes(t), "p_type").select("p_type", "title", "place", "key", "body")


@query("c20_dictionary_verification", "SELECT p_type, CASE WHEN p_type LIKE '%E' THEN 'truncated file' WHEN p_type LIKE '%L' THEN 'header checksum mismatch' END AS error FROM part GROUP BY 1")
def verified(t: Tables) -> DataFrame:
    """Files of some types lack their last bytes, of others a byte of the header is changed."""
    content = F.when(F.col("p_type").endswith("E"), F.expr("substring(content, 1, length(content) - 3)")).when(F.col("p_type").endswith("L"), F.expr("concat(substring(content, 1, 10), unhex('7f'), substring(content, 12))")).otherwise(F.col("content"))
    found = read_files(volumes(t).select("p_type", content.alias("content")), "p_type")
    return found.groupBy("p_type").agg(F.max("error").alias("error"))
