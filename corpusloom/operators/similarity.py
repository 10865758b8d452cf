"""Vector similarity joins, duplicate clusters and canonical records."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.operators.graph import connected_components, spanning
from corpusloom.runtime import materialize, ship


def _blocks(rows: DataFrame, blocks: int | None, block_rows: int) -> DataFrame:
    """Rows (id, v) dealt by hash, once for each pair of blocks (i, j) that their block b is part of."""
    n = blocks or max(1, -(-rows.count() // block_rows))
    mine = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    dealt = rows.select("id", "v", mine.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("o"))
    return dealt.select("id", "v", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b")


def _near(pdf, threshold: float, strict: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row, cosine) of the pairs of a pair of blocks, each pair once."""
    x = np.array(pdf["v"].tolist(), np.float64).reshape(len(pdf), -1)
    length = np.sqrt((x**2).sum(1))
    x = x / np.where(length > 0, length, 1.0)[:, None]
    b, i, j = pdf["b"].to_numpy(), pdf["i"].iloc[0], pdf["j"].iloc[0]
    a, z = np.flatnonzero(b == i), np.flatnonzero(b == j)
    s = x[a] @ x[z].T
    p, q = np.nonzero(s > threshold if strict else s >= threshold)
    once = a[p] < z[q] if i == j else np.ones(len(p), bool)
    return a[p][once], z[q][once], s[p, q][once]


def cosine_pairs(df: DataFrame, id_col: str, vec_col: str, threshold: float, blocks: int | None = None, block_rows: int = 2000, strict: bool = True) -> DataFrame:
    """(left, right, cosine) of all pairs with cosine above ``threshold`` (``strict``: equality doesn't count), left < right.

    Exact blocked similarity join: rows are dealt by hash into blocks, each pair of blocks meets in one task as a matrix product. All
    pairs are compared, which grows with the square of the rows; operators that scale search an index instead. Null vectors take no
    part; a zero vector is similar to nothing.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    id_type = rows.schema["id"].dataType.simpleString()

    def compare(pdf):
        import pandas as pd

        a, z, cosine = _near(pdf, threshold, strict)
        ids = pdf["id"].to_numpy()
        left, right = ids[a], ids[z]
        keep = left != right
        lo, hi = np.where(left < right, left, right), np.where(left < right, right, left)
        return pd.DataFrame({"left": lo[keep], "right": hi[keep], "cosine": cosine[keep]})

    return _blocks(rows, blocks, block_rows).groupBy("i", "j").applyInPandas(compare, f"left {id_type}, right {id_type}, cosine double")


def duplicate_clusters(df: DataFrame, id_col: str, vec_col: str, similarity: float = 0.92, blocks: int | None = None, block_rows: int = 2000) -> DataFrame:
    """(id, cluster) of the rows that have a neighbour at cosine >= ``similarity``; the cluster is its smallest id.

    Density clustering with two points a neighbourhood leaves every point with a neighbour in the cluster of that neighbour: clusters are the connected components of the links.
    Equal vectors are one node, however many rows share it, and a pair of blocks answers with a spanning forest of its links, never with all of them.
    """
    ship(df.sparkSession)
    cut = 1 - max(1 - similarity, 1e-6)
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id is not null").where(F.exists("v", lambda x: x != 0))
    nodes = materialize(rows.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "vectors")
    id_type = rows.schema["id"].dataType.simpleString()

    def link(pdf):
        import pandas as pd

        a, z, _ = _near(pdf, cut, False)
        label, ids = spanning(len(pdf), a, z), pdf["id"].to_numpy()
        linked = np.flatnonzero(label != np.arange(len(pdf)))
        return pd.DataFrame({"a": ids[linked], "b": ids[label[linked]]})

    links = _blocks(nodes.select("id", "v"), blocks, block_rows).groupBy("i", "j").applyInPandas(link, f"a {id_type}, b {id_type}")
    found = connected_components(links)
    named = nodes.join(found, nodes["id"] == found["node"], "left").where("component is not null or n > 1").select("v", F.coalesce("component", nodes["id"]).alias("cluster"))
    return rows.join(named, "v").select(F.col("id").alias(id_col), "cluster")


def canonical_ids(groups: DataFrame, group_col: str, id_col: str, preview: Column, limit: int = 4000) -> DataFrame:
    """(child_id, canonical_id): in each group the row of the longest preview (first ``limit`` characters), then the smallest id, stands for the others."""
    w = Window.partitionBy(group_col)
    length = F.length(F.substring(preview, 1, limit))
    best = F.min_by(F.col(id_col), F.struct(-length, F.col(id_col))).over(w)
    return groups.select(F.col(id_col).alias("child_id"), best.alias("canonical_id")).where("child_id <> canonical_id")


def apply_canonical(rows: DataFrame, mapping: DataFrame, id_col: str = "id", current: str = "canonical_id") -> DataFrame:
    """Set the canonical id: from the mapping, else what was there, else the row's own id. Chains aren't followed."""
    new = mapping.select(F.col("child_id").alias("_child"), F.col("canonical_id").alias("_new"))
    old = F.col(current) if current in rows.columns else F.lit(None)
    keep = [c for c in rows.columns if c != current]
    return rows.join(new, rows[id_col] == new["_child"], "left").select(*keep, F.coalesce("_new", old, F.col(id_col)).alias(current))


def sparse_cosine(a: DataFrame, b: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(a, b, overlap): cosine of two sparse count maps given as rows (name, key, n); pairs without a common key have no row.

    With ``pairs`` (a, b) only these are worked out: each side of a pair meets its own counts, so that a key that all names share joins nothing but the pairs.
    """
    x, y = a.toDF("a", "key", "n"), b.toDF("b", "key", "m")
    na = x.groupBy("a").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("na"))
    nb = y.groupBy("b").agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("nb"))
    met = x.join(y, "key") if pairs is None else pairs.select("a", "b").distinct().join(x, "a").join(y, ["b", "key"])
    dots = met.groupBy("a", "b").agg(F.sum(F.col("n") * F.col("m")).alias("dot"))
    return dots.join(na, "a").join(nb, "b").select("a", "b", (F.col("dot") / (F.col("na") * F.col("nb"))).alias("overlap"))
