"""Mixing sources to target weights (DataFrame functions only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.text import WORD
from corpusloom.runtime import materialize


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """The target of each source. ``sizes`` has one row a source: skey, source_size.

    Sources in order of skey get ``weights`` in turn. Together they get ``share`` times all sizes, by weight, but none more
    than ``max_epochs`` times its own size: what is above is shared anew by weight until none is
    above. That ends at least(cap, level * weight) for one level, which running sums over the sources, sorted by cap / weight, find.
    """
    w = F.element_at(F.lit(list(map(float, weights))), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.select("skey", "source_size", F.row_number().over(Window.orderBy("skey")).alias("rank"))
    capped = ranked.select("skey", "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"))
    filled = Window.orderBy(F.col("cap") / F.col("w"), "skey")
    whole = Window.partitionBy()
    levels = capped.select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(whole)).alias("budget"),
        F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("full"),
        F.sum("w").over(filled.rowsBetween(0, Window.unboundedFollowing)).alias("open_w"),
    ).withColumn("level", (F.col("budget") - F.col("full")) / F.col("open_w"))
    settled = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "skey", "level"))).over(whole)
    return levels.select(
        "skey", "source_size", F.coalesce(F.least("cap", settled["level"] * F.col("w")), F.col("cap")).alias("target")
    )


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 29,
    rows_per_bin: int = 1_000,
    cut: str = "word",
) -> DataFrame:
    """How often, or how much, each document is taken so that every source meets its target of words.

    Every row gets a hash-random key of (seed, id, text). The key's range is cut into equal bins of about ``rows_per_bin`` rows, and the bins into ranges of
    that many bins. Sums by (source, bin) and running sums at each of the three levels give a row's place in its source in key order: the range's offset, plus the bin's
    in its range, plus a running sum in its own (source, bin). So a hot source is spread over its bins, and no running sum
    passes over more than about ``rows_per_bin`` rows, or a ``rows_per_bin`` squared-th of the table. Whole epochs are taken first; the last, partial epoch takes rows in key order up to the
    source's budget: with ``cut='word'`` the row at the budget gives exactly the words that are missing, with
    ``cut='document'`` it is taken whole if more than half of it lies below the budget.

    Returns ``id_col``, ``text_hash`` long (to meet the row again), ``source_col``, size, source_size, target,
    taken (words) and ``copies`` (whole repeats, for ``cut='document'``). Null source: last in order; null text: no
    words, taken 0 times; equal rows are separate rows; an empty table gives no rows. Columns of the input with other
    names are not returned. Same input and seed: same rows.
    """
    if cut not in ("word", "document"):
        raise ValueError(cut)
    skey = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col)))
    rows = materialize(
        df.select(
            F.col(id_col).alias("id"),
            F.xxhash64(F.col(text_col)).alias("text_hash"),
            skey.alias("skey"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("key"),
        ),
        "mix",
    )
    n = rows.count()
    bins = min(1 << 30, max(1, math.ceil(n / rows_per_bin)))
    rows = rows.withColumn("bin", F.shiftright((F.shiftright("key", 32) + (1 << 31)) * bins, 32).cast("int"))
    sums = materialize(rows.groupBy("skey", "bin").agg(F.sum("size").alias("bin_size")), "bins").withColumn("range", F.floor(F.col("bin") / rows_per_bin))
    targets = source_targets(sums.groupBy("skey").agg(F.sum("bin_size").alias("source_size")), weights, share, max_epochs)

    def before(*keys: str):
        return Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)

    ranges = sums.groupBy("skey", "range").agg(F.sum("bin_size").alias("range_size"))
    ranges = ranges.select("skey", "range", F.coalesce(F.sum("range_size").over(before("skey", "range")), F.lit(0)).alias("range_offset")).join(targets, "skey")
    placed_bins = sums.select("skey", "bin", "range", F.coalesce(F.sum("bin_size").over(before("skey", "range", "bin")), F.lit(0)).alias("bin_offset"))
    offsets = placed_bins.join(ranges, ["skey", "range"]).select("skey", "bin", (F.col("range_offset") + F.col("bin_offset")).alias("offset"), "source_size", "target")

    inside = Window.partitionBy("skey", "bin").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select("*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("inner")).join(offsets, ["skey", "bin"])
    words = F.round("target").cast("long")
    placed = placed.select(
        "*",
        F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0)).alias("epochs"),
        words.alias("words"),
    )
    left = F.col("words") - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("inner")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    more = part if cut == "word" else F.when(part * 2 > F.col("size"), F.col("size")).otherwise(F.lit(0))
    once = F.when((F.col("size") > 0) & (more == F.col("size")), F.lit(1)).otherwise(F.lit(0))
    return placed.select(
        F.col("id").alias(id_col),
        "text_hash",
        F.when(F.col("skey") != "1", F.substring("skey", 2, 1 << 30)).alias(source_col),
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + more).cast("long").alias("taken"),
        F.when(F.col("size") > 0, F.col("epochs") + once).otherwise(F.lit(0)).cast("long").alias("copies"),
    )


def repeat_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """``df`` with every row as often as the mix takes it whole (0 times or more), with all its columns.

    Rows of one (id, text) share the copies that the mix takes of them all: n copies over r rows give each n div r, and one more to n mod r of them.
    """
    taken = mix_sources(df, id_col, text_col, cut="document", **kwargs)
    taken = taken.groupBy(F.col(id_col).alias("_cl_id"), F.col("text_hash").alias("_cl_hash")).agg(F.sum("copies").alias("_cl_n"), F.count(F.lit(1)).alias("_cl_rows"))
    taken = materialize(taken.where("_cl_n > 0"), "copies")
    rows = df.withColumn("_cl_key", F.xxhash64(text_col))
    met = rows.join(taken, rows[id_col].eqNullSafe(F.col("_cl_id")) & (F.col("_cl_key") == F.col("_cl_hash")))
    once = met.where("_cl_rows = 1").select(*df.columns, F.col("_cl_n").alias("_cl_copies"))
    # rows that repeat: equal ones are counted before they move, then each run of equal rows takes its part of the copies by running counts
    again = met.where("_cl_rows > 1").groupBy(*df.columns, "_cl_key", "_cl_n", "_cl_rows").agg(F.count(F.lit(1)).alias("_cl_m"))
    tie = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != text_col]))
    upto = F.sum("_cl_m").over(Window.partitionBy(id_col, "_cl_key").orderBy(tie).rowsBetween(Window.unboundedPreceding, 0))
    again = again.withColumn("_cl_upto", upto)
    more = F.greatest(F.lit(0), F.least(F.col("_cl_m"), F.expr("_cl_n % _cl_rows") - F.col("_cl_upto") + F.col("_cl_m")))
    again = again.select(*df.columns, (F.col("_cl_m") * F.expr("_cl_n div _cl_rows") + more).alias("_cl_copies")).where("_cl_copies > 0")
    both = once.unionByName(again)
    return both.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_cl_copies"))).alias("_cl_copy")).drop("_cl_copy")
