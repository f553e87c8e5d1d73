"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, and what a word is, in the contracts.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def bounded_batches(spark: SparkSession) -> None:
    """Rows may be long, so less goes to Python at once than Spark's default; what a session sets itself stays.

    Plans take these settings when they run, often after the call that made them, so they remain set.
    """
    own = spark.conf.getAll
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")):
        if key not in own:
            spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, whole."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    ``spark.checkpoint.dir`` names it. Where that is unset, a local session, whose
    driver is its only executor, takes a temporary folder; any other one must set it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    place = spark.conf.get("spark.sparkloom.localdir", None)
    if not place:
        place = tempfile.mkdtemp(prefix="sparkloom-")
        atexit.register(shutil.rmtree, place, ignore_errors=True)
        spark.conf.set("spark.sparkloom.localdir", place)
    return f"file://{place}"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session, for a while."""
    before = spark.conf.getAll.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cut(df: DataFrame, *, blobs: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there.

    A lost executor then costs a read of the table, not a new run of what made it.
    The shuffles of the write go with its end. ``blobs`` is for rows of megabytes:
    row groups stay small, as a reader holds one whole. The table goes by
    :func:`forget`, or else when the application ends.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{shared_dir(spark)}/sparkloom-{uuid.uuid4().hex}"
    write = df.write
    if blobs:
        write = write.option("parquet.block.size", str(4 << 20)).option("parquet.page.size.row.check.min", "1").option("parquet.page.size.row.check.max", "4")
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        write.parquet(path)
    files, place = hadoop(spark, path)
    files.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out._sparkloom_path = path
    return out


def hadoop(spark: SparkSession, path: str) -> tuple:
    """A file system and a path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def forget(*frames: DataFrame | None) -> None:
    """Delete tables made by :func:`cut` that nothing will read again."""
    for df in frames:
        path = getattr(df, "_sparkloom_path", None)
        if path:
            files, place = hadoop(df.sparkSession, path)
            files.delete(place, True)
            files.cancelDeleteOnExit(place)


def release() -> None:
    """Give freed memory back: a worker that waits for its next task keeps what its allocators hold."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of a mapInArrow, after which its worker holds no memory that it doesn't use."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


def lean_group(run: Callable) -> Callable:
    """The function of an applyInArrow, alike: of a group, a key and a group, or a key and two of them."""

    def done(out: pa.Table, *groups: pa.Table) -> pa.Table:
        if sum(g.nbytes for g in groups) > 1 << 20:
            release()
        return out

    # Spark counts the arguments
    if run.__code__.co_argcount == 1:
        return lambda group: done(run(group), group)
    if run.__code__.co_argcount == 2:
        return lambda a, b: done(run(a, b), *(x for x in (a, b) if isinstance(x, pa.Table)))
    return lambda key, a, b: done(run(key, a, b), a, b)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of a value's text, modulo ``n``; null counts as empty."""
    return F.pmod(F.crc32(F.encode(F.coalesce(col.cast("string"), F.lit("")), "utf-8")), F.lit(n))


def words(col: Column) -> Column:
    """Number of words in a text; null has none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def text_or_empty(df: DataFrame, col: str = "text") -> Column:
    return F.coalesce(df[col], F.lit(""))
