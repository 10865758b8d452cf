"""Exact dedup by composable polynomial fingerprints, with a comparison of the texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corpusloom.llm.text import SPACE
from corpusloom.runtime import discard, materialize, ship

#: Two primes under 2^31 and a base for each: H(s) = sum of s[i] * base^(n-1-i) mod prime.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_017)
#: Bytes of a chunk. 255 * 2^31 * CHUNK stays below 2^53, so that chunk hashes are exact in double precision.
CHUNK = 1024
SEGMENT = 1 << 20
COMPARE = 1 << 16

HASH = "h1 long, h2 long, p1 long, p2 long"


def normalize(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod prime."""
    out = np.ones(1, np.int64)
    step = base % prime
    while len(out) < n:
        out = np.concatenate([out, out * step % prime])
        step = step * step % prime
    return out[:n]


def hash_segments(segments: list[bytes], primes: tuple[int, int] = PRIMES) -> pd.DataFrame:
    """(h1, h2, p1, p2) of each segment: its polynomial hash and base^length, mod either prime.

    All segments' chunks are hashed at once as a matrix product; leading zero bytes change nothing, so a segment's first
    chunk is filled up on the left. Chunks then combine by shifts: H(ab) = H(a) * base^|b| + H(b).
    """
    n = np.array([len(s) for s in segments], np.int64)
    chunks = np.maximum(1, -(-n // CHUNK))
    ends = np.cumsum(chunks)
    flat = np.zeros(int(ends[-1]) * CHUNK if len(n) else 0, np.uint8)
    for s, e in zip(segments, ends.tolist()):
        flat[e * CHUNK - len(s) : e * CHUNK] = np.frombuffer(s, np.uint8)
    out = {}
    rows = flat.reshape(-1, CHUNK)
    place = np.repeat(ends, chunks) - 1 - np.arange(len(rows))  # chunks that follow in the segment
    weights = np.stack([_powers(b, p, CHUNK)[::-1] for b, p in zip(BASES, primes)], 1).astype(np.float64)
    sums = np.empty((len(rows), 2), np.int64)
    for a in range(0, len(rows), 4096):
        sums[a : a + 4096] = (rows[a : a + 4096].astype(np.float64) @ weights).astype(np.int64)
    for k, (b, p) in enumerate(zip(BASES, primes), 1):
        shift = _powers(pow(b, CHUNK, p), p, int(chunks.max()) if len(n) else 0)
        parts = sums[:, k - 1] % p * shift[place] % p
        out[f"h{k}"] = np.add.reduceat(parts, ends - chunks) % p if len(n) else np.empty(0, np.int64)
        out[f"p{k}"] = np.array([pow(b, x, p) for x in n.tolist()], np.int64)
    return pd.DataFrame(out)[["h1", "h2", "p1", "p2"]]


def combine(parts: Column, k: int, prime: int) -> Column:
    """The hash of a whole text from its segments' in order, by length-shifted arithmetic (products stay below 2^62)."""
    return F.aggregate(parts, F.lit(0).cast("long"), lambda h, x: (h * x["h"][f"p{k}"] + x["h"][f"h{k}"]) % prime)


def same_bytes(a: Column, b: Column) -> Column:
    """Equality chunk by chunk; ends at the first chunk that differs."""
    x, y = a.cast("binary"), b.cast("binary")
    at = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.octet_length(a) - 1) / COMPARE).cast("int")))
    equal = F.forall(at, lambda i: F.substring(x, i * COMPARE + 1, F.lit(COMPARE)) == F.substring(y, i * COMPARE + 1, F.lit(COMPARE)))
    return (F.octet_length(a) == F.octet_length(b)) & equal


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes: tuple[int, int] = PRIMES, max_rounds: int = 50) -> DataFrame:
    """Classes of equal normalised texts: every row of ``df`` once, as (id, keep_id, group_size, kept, text_sha256).

    Texts are cut into segments that are hashed apart and combined into (length, two hashes). Rows of equal fingerprints form
    a group; each member's text is compared, chunk by chunk, with that of the group's first. Members that differ (a
    collision) leave the group and are grouped again among themselves, until none is left.

    The smallest id of equal texts stays (nulls last); of equal rows one stays. A null text is an empty one. Columns other than
    id and text are not read. An empty table gives no rows.
    """
    ship(df.sparkSession)
    hasher = pandas_udf(lambda s: hash_segments(s.tolist(), primes), HASH)
    norm = df.select(F.col(id_col).alias("id"), normalize(F.col(text_col)).alias("norm"))
    keyed = norm.select("id", "norm", F.sha2("norm", 256).alias("sha"), F.octet_length("norm").alias("len"))
    last = F.greatest(F.lit(0), F.floor((F.col("len") - 1) / SEGMENT).cast("int"))
    segments = keyed.select("id", "sha", "len", F.col("norm").cast("binary").alias("raw"), F.explode(F.sequence(F.lit(0), last)).alias("seg")).select(
        "id", "sha", "len", "seg", hasher(F.substring("raw", F.col("seg") * SEGMENT + 1, F.lit(SEGMENT))).alias("h")
    )
    ones = segments.groupBy("id", "sha", "len").agg(
        F.count_if(F.col("seg") == 0).alias("copies"), F.array_sort(F.collect_set(F.struct("seg", "h"))).alias("parts")
    )
    units = materialize(
        ones.select("id", "sha", "len", "copies", *[combine(F.col("parts"), k, primes[k - 1]).alias(f"h{k}") for k in (1, 2)], F.lit(0).alias("round")),
        "fingerprints",
    )
    group = ["len", "h1", "h2", "round"]
    for n in range(max_rounds):
        firsts = materialize(_firsts(units, group), "firsts")
        pairs = units.where(F.col("round") == n).join(firsts.where("units > 1"), group)
        pairs = materialize(pairs.where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("sha") == F.col("first.sha")))).select("id", "sha", "first"), "pairs")
        other = materialize(_differing(keyed, pairs), "differing")
        if other.isEmpty():
            break
        moved = other.select(F.col("id").alias("oid"), F.col("sha").alias("osha")).distinct()
        again = units.join(moved, F.col("id").eqNullSafe(F.col("oid")) & (F.col("sha") == F.col("osha")), "left")
        after = materialize(again.select("id", "sha", "len", "copies", "h1", "h2", F.when(F.col("osha").isNotNull(), F.lit(n + 1)).otherwise(F.col("round")).alias("round")), "fingerprints")
        discard(units)
        units = after
    else:
        raise RuntimeError("fingerprints keep colliding")
    found = units.join(firsts, group)
    stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("sha") == F.col("first.sha"))
    return found.select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        stays.alias("stays"),
        F.col("sha").alias("text_sha256"),
    ).select(id_col, "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def _firsts(units: DataFrame, group: list[str]) -> DataFrame:
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("sha").alias("sha")))
    return units.groupBy(*group).agg(first.alias("first"), F.sum("copies").alias("group_size"), F.count(F.lit(1)).alias("units"))


def _differing(keyed: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs whose texts differ. Only texts of groups with several members move further than one shuffle."""
    texts = keyed.select(F.col("id").alias("tid"), F.col("sha").alias("tsha"), F.col("norm").alias("t"))
    firsts = pairs.select(F.col("first.id").alias("id"), F.col("first.sha").alias("sha")).distinct()
    need = pairs.select("id", "sha").union(firsts).distinct()

    def met(left, lid, lsha, how, right=texts):
        return left.join(right, lid.eqNullSafe(right["tid"]) & (lsha == right["tsha"]), how)

    needed = materialize(
        texts.join(need, texts["tid"].eqNullSafe(need["id"]) & (texts["tsha"] == need["sha"]), "left_semi"), "texts"
    )
    mine = met(pairs, pairs["id"], pairs["sha"], "inner", needed).select("id", "sha", "first", F.col("t").alias("mine"))
    reps = met(firsts, firsts["id"], firsts["sha"], "inner", needed).groupBy("id", "sha").agg(F.first("t").alias("rep")).toDF("rid", "rsha", "rep")
    both = mine.join(reps, mine["first.id"].eqNullSafe(reps["rid"]) & (mine["first.sha"] == reps["rsha"]))
    return both.where(~same_bytes(F.col("mine"), F.col("rep"))).select("id", "sha")


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: the row of the smallest id of each class of equal texts."""
    groups = exact_groups(df, id_col, text_col).where("kept").select(F.col(id_col).alias("kid"), F.col("text_sha256").alias("ksha"))
    rows = df.select("*", F.sha2(normalize(F.col(text_col)), 256).alias("_cl_sha"))
    stay = rows.join(groups, rows[id_col].eqNullSafe(groups["kid"]) & (rows["_cl_sha"] == groups["ksha"]), "left_semi")
    return stay.dropDuplicates([id_col, "_cl_sha"]).select(*df.columns)
