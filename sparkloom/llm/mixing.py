"""Mixing sources to target weights by entropy balancing.

Wanted are document rates r closest, in relative entropy, to one copy of each
document, such that the words taken from a source meet its target and no rate
exceeds ``cap``. The solution is r = min(cap, exp(lambda * x)) with x the
document's words relative to its source's mean, and one lambda for each source.
Newton steps on the convex dual run over a histogram (source, size), which is
aggregated before any shuffle; all sources step together in one Spark job.

Rates become copies by error diffusion inside blocks of a source, from long to
short documents, so a block misses its share by half of a short document.

Null, empty and odd input: a null text has no words and is taken no times; the
null source is a source of its own, sorted last; a source without words has
target 0; very long texts count like any other, and come first in their block;
documents of one size are placed by id; repeated rows count one by one; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, forget, table, words

WEIGHTS = (5.0, 2.0, 1.0)


def targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row for each source: sid, source, source_size, n, target.

    The final shares are min(cap * size, level * weight): sources that reach
    their cap, sorted by size for each unit of weight, hand the rest on, so the
    level follows from running sums. This sorts one row for each source.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    per = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("w", w)
    top = F.lit(cap) * F.col("source_size")
    ratio = Window.orderBy((top / F.col("w")), "sid")
    before, behind = ratio.rowsBetween(Window.unboundedPreceding, -1), ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum(top).over(before), F.lit(0.0))) / F.sum("w").over(behind)
    # the sources at their cap come first in this order; the first one below its cap sets the level for all others
    free = per.withColumn("level", level).withColumn("place", F.struct(top / F.col("w"), "sid"))
    final = F.min_by("level", F.when(F.col("level") * F.col("w") < top, F.col("place"))).over(whole)
    return free.withColumn("target", F.when(final.isNull(), top).otherwise(F.least(top, final * F.col("w"))).cast("double")).select("sid", "source", F.col("source_size").cast("long").alias("source_size"), "n", "least", "target")


def exact_sum(col: Column) -> Column:
    """A sum that doesn't depend on the order of its terms, so that reruns agree to the last bit."""
    return F.sum(col.cast("decimal(30,9)")).cast("double")


def tilt(sizes: DataFrame, goal: DataFrame, *, cap: float = 2.0, steps: int = 40, tolerance: float = 1e-9) -> DataFrame:
    """One row for each source: sid and its tilt ``lam`` (null: all at the cap, or none).

    Newton on the dual, kept inside a shrinking bracket; the state is a table
    with one row for each source, cut after every step.
    """
    hist = cut(sizes.where("size > 0").groupBy("sid", "size").agg(F.count("*").alias("k")))
    mean = F.col("source_size") / F.col("n")
    state = goal.where("source_size > 0").select(
        "sid", "target", mean.alias("mean"),
        F.lit(0.0).alias("lam"),
        F.when(F.col("target") > 0, F.log(F.col("target") / F.col("source_size")) * mean / F.col("least")).alias("low"),
        (F.lit(math.log(cap)) * mean / F.col("least")).alias("high"),
        F.lit(False).alias("done"),
        (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)).alias("full"),
    ).withColumn("low", F.least("low", F.lit(0.0)) - 1e-9)
    state = cut(state)
    for _ in range(steps):
        x = F.col("size") / F.col("mean")
        e = F.exp(F.least(F.col("lam") * x, F.lit(math.log(cap))))
        got = hist.join(state.where("not done and not full and target > 0"), "sid").groupBy("sid").agg(
            exact_sum(F.col("k") * F.col("size") * e).alias("f"),
            exact_sum(F.when(F.col("lam") * x < math.log(cap), F.col("k") * F.col("size") * x * e).otherwise(0.0)).alias("g"),
        )
        over = F.col("f") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - (F.col("f") - F.col("target")) / F.col("g")
        near = F.abs(F.col("f") - F.col("target")) <= tolerance * F.col("target")
        fresh = state.join(got, "sid", "left").select(
            "sid", "target", "mean", "full",
            F.when(F.col("f").isNull() | near, F.col("lam")).when((F.col("g") > 0) & (newton > low) & (newton < high), newton).otherwise((low + high) / 2).alias("lam"),
            F.when(F.col("f").isNull(), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("f").isNull(), F.col("high")).otherwise(high).alias("high"),
            (F.col("f").isNull() | near).alias("done"),
        )
        fresh = cut(fresh)
        forget(state)
        state = fresh
        if state.where("not done").isEmpty():
            break
    out = state.select("sid", "mean", F.when(~F.col("full") & (F.col("target") > 0), F.col("lam")).alias("lam"))
    forget(hist)
    return out


def diffuse(size: np.ndarray, rate: np.ndarray, cap: float) -> np.ndarray:
    """Copies (0 to ``cap``) whose running words stay nearest to the running rates.

    Long documents come first, so the error left at the end is a short one's.
    """
    order = np.argsort(-size, kind="stable")
    copies = np.zeros(len(size), np.int64)
    top, owed = int(cap), 0.0
    for k in order:
        s = size[k]
        if s <= 0:
            continue
        owed += rate[k] * s
        c = min(top, max(0, math.floor(owed / s + 0.5)))
        copies[k] = c
        owed -= c * s
    return copies


def mix(docs: DataFrame, *, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, block_rows: int = 2_000) -> DataFrame:
    """Copies for every row: the id columns, size, source_size, target, copies, rate.

    ``cap`` is a whole number of copies. No text is shuffled.
    """
    cols = [f"id{i}" for i in range(len(id_cols))]
    base = cut(docs.select(*(docs[c].alias(a) for c, a in zip(id_cols, cols, strict=True)), docs[source_col].alias("source"), words(docs[text_col]).alias("size")))
    goal = cut(targets(base, weights=weights, share=share, cap=cap))
    sized = base.join(goal.select("sid", F.col("source").alias("s"), "source_size", "target", "n"), F.col("source").eqNullSafe(F.col("s")))
    lam = tilt(sized.select("sid", "size"), goal, cap=cap)
    x = F.col("size") / F.col("mean")
    rate = F.when(F.col("size") <= 0, 0.0).when(F.col("target") <= 0, 0.0).when(F.col("lam").isNull(), cap).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * x, F.lit(50.0)))))
    rated = sized.join(lam, "sid", "left").withColumn("rate", rate.cast("double"))
    blocks = F.ceil(F.col("n") / block_rows)
    rated = rated.withColumn("blk", F.pmod(F.xxhash64(*cols, "size"), blocks).cast("int")).select(*cols, "sid", "blk", "size", "source_size", "target", "rate")
    out = rated.select(*cols, "size", "source_size", "target", "rate").schema.add("copies", "long")

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), *((c, "ascending") for c in cols)])
        copies = diffuse(group["size"].to_numpy(), group["rate"].to_numpy(), cap)
        return group.drop_columns(["sid", "blk"]).append_column("copies", pa.array(copies))

    placed = rated.groupBy("sid", "blk").applyInArrow(place, out)
    return placed.withColumnsRenamed(dict(zip(cols, id_cols, strict=True)))


def op9_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table mixed to 150 % of its words."""
    got = mix(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
