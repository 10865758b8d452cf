"""Two-pass external shuffle into shards (DataFrame functions only)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.runtime import without

#: Offsets of so many buckets (16 bytes each, 128 TB of text at the usual size) are broadcast; beyond, they are joined by a shuffle.
BROADCAST_BUCKETS = 4_000_000


def shard_documents(
    df: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 17,
    bucket_bytes: int = 32 << 20,
    most_partitions: int = 100_000,
) -> DataFrame:
    """Put all rows into ``shards`` shards in random order; row counts of shards differ by one at most.

    Pass 1 scatters whole rows by a seeded hash of (id, text) into buckets of about ``bucket_bytes``, as many as the table's bytes ask for. A
    shuffle bears ``most_partitions`` partitions; beyond that a partition holds several buckets, one after the other. Pass 2 orders a bucket by (hash, id, text), so that
    a retried task meets the same rows in the same order, and runs Spark's seeded Fisher-Yates ``shuffle``
    over the bucket's array. The buckets' counts, summed over the (small) bucket table, turn a place in a bucket into a
    place in the whole permutation, which is cut into ``shards`` runs.

    Returns the columns of ``df`` (those named shard or slot are replaced), ``shard`` int and ``slot`` long,
    gapless from 0 in each shard. Null ids and texts are values like others; a null text weighs nothing.
    Repeated rows each get a slot; where rows of one (id, text) fill buckets of their own, they are counted, and each copy gets a hash of its own.
    An empty table gives no rows; with fewer rows than shards some shards stay empty.
    """
    own = without(df, "shard", "slot")
    size = 16 + F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    total = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    if not total["n"]:
        return df.select(*own, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).where("false")
    n, buckets = total["n"], max(1, math.ceil(total["b"] / bucket_bytes))
    parts = min(buckets, most_partitions)
    rows = _spread_copies(df.select(*own), df.select(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("place"), size.alias("size")), id_col, text_col, seed, buckets, bucket_bytes)
    place, bucket = F.col("_cl_place"), F.pmod(F.col("_cl_place"), F.lit(buckets))

    # the bucket table: one row a bucket
    counts = rows.select(bucket.alias("bucket")).groupBy("bucket").count()
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)

    rec = F.struct(*[F.col(c) for c in own]).alias("rec")
    # A key of collated text makes Spark aggregate along the sort, one bucket's array at a time; a hash aggregate would hold all buckets of a partition.
    name = F.collate(bucket.cast("string"), "UTF8_LCASE")
    scattered = rows.select(rec, place.alias("place"), name.alias("name"), F.pmod(bucket, F.lit(parts)).cast("int").alias("part")).repartitionById(parts, F.col("part"))
    ordered = scattered.sortWithinPartitions("part", "name", "place", f"rec.{id_col}", f"rec.{text_col}")
    arrays = ordered.groupBy("part", "name").agg(F.collect_list("rec").alias("recs")).withColumn("bucket", F.col("name").cast("long"))
    # shuffled before the join, where a partition's buckets still stand in order: the generator goes on from one to the next
    mixed = arrays.select("bucket", F.shuffle("recs", F.lit(seed)).alias("recs"))
    dealt = mixed.join(offsets, "bucket").select("offset", F.posexplode("recs").alias("pos", "rec"))
    # g * shards may pass 2^63 only beyond 10^17 rows
    g = F.col("offset") + F.col("pos")
    shard = F.expr(f"(offset + pos) * {shards}L div {n}L")
    start = F.expr(f"(((offset + pos) * {shards}L div {n}L) * {n}L + {shards - 1}L) div {shards}L")
    return dealt.select(*[F.col("rec")[c].alias(c) for c in own], shard.cast("int").alias("shard"), (g - start).alias("slot"))


def _spread_copies(rows: DataFrame, sizes: DataFrame, id_col: str, text_col: str, seed: int, buckets: int, bucket_bytes: int) -> DataFrame:
    """``rows`` with their place: the hash of (id, text), but where rows of one hash outgrow a bucket, a hash of the whole row and the copy's number.

    Such hashes are found in the buckets of over four times the usual size, so that the usual table pays one sum a bucket. Equal rows are counted, map-side first,
    before they move; which copy has which number makes no difference.
    """
    place = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    by_bucket = sizes.groupBy(F.pmod("place", F.lit(buckets)).alias("bucket")).agg(F.sum("size").alias("bytes"))
    if not by_bucket.where(F.col("bytes") > 4 * bucket_bytes).limit(1).count():
        return rows.withColumn("_cl_place", place)
    hot = sizes.groupBy("place").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > bucket_bytes).select(F.col("place").alias("_cl_hot"))  # at most one a bucket's bytes
    light = rows.withColumn("_cl_place", place).join(hot, F.col("_cl_place") == F.col("_cl_hot"), "left_anti")
    heavy = rows.withColumn("_cl_place", place).join(hot, F.col("_cl_place") == F.col("_cl_hot"), "left_semi")
    copies = heavy.groupBy(*heavy.columns).agg(F.count(F.lit(1)).alias("_cl_n"))
    hashed = [F.col(f.name) for f in rows.schema if f.dataType.typeName() not in ("map", "variant")]
    each = copies.select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_cl_n"))).alias("_cl_copy"))
    return light.unionByName(each.select(*rows.columns, F.xxhash64(F.lit(seed), F.col("_cl_copy"), *hashed).alias("_cl_place")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write shards as folders ``shard=N``. A bucket lies in few shards, so that this needs no further shuffle."""
    sharded.write.partitionBy("shard").parquet(path)
