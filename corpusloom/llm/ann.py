"""Approximate nearest neighbours with balanced posting lists."""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.runtime import frugal, materialize, ship

#: Vectors that a worker handles at a time.
AT_ONCE = 2048


def clean_vectors(df: DataFrame, id_col: str, vec_col: str, is_query: Column) -> DataFrame:
    """(vec_id, v array<double>, dims, asked) of the rows with an id, without null, empty, zero or non-finite vectors."""
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col}: ids must be integers")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good & F.exists("v", lambda x: x != 0)
    return rows.where(good).select("vec_id", "v", F.size("v").alias("dims"), "asked")


def _matrix(column) -> np.ndarray:
    """A list column of vectors of one length as a matrix."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 5, rounds: int = 8) -> np.ndarray:
    """Centroids of about equal lists: the largest list is halved by 2-means with equal halves until there are ``lists``."""
    rng = np.random.default_rng(seed)
    parts = [np.arange(len(x))]
    while len(parts) < min(lists, len(x)):
        parts.sort(key=len)
        rows = parts.pop()
        if len(rows) < 2:
            parts.append(rows)
            break
        y = x[rows]
        a, b = y[rng.integers(len(y))], y[rng.integers(len(y))]
        for _ in range(rounds):
            order = np.argsort(y @ (b - a), kind="stable")
            left, right = order[: len(order) // 2], order[len(order) // 2 :]
            a, b = y[left].mean(0), y[right].mean(0)
        parts += [rows[left], rows[right]]
    return np.stack([x[p].mean(0) for p in parts])


class CentroidGraph:
    """Nearest centroids by best-first search in an in-memory neighbour graph, for many vectors at once.

    Each centroid is joined with its ``degree`` nearest and, so that the graph hangs together, with its successors on a ring
    of power-of-two strides.
    """

    def __init__(self, centroids: np.ndarray, degree: int = 12):
        self.c = centroids
        k = len(centroids)
        sq = (centroids**2).sum(1)
        d = sq[:, None] - 2 * centroids @ centroids.T + sq[None]
        np.fill_diagonal(d, np.inf)
        near = np.argsort(d, 1, kind="stable")[:, : min(degree, max(0, k - 1))]
        strides = [1 << i for i in range(max(1, (k - 1).bit_length()))]
        far = (np.arange(k)[:, None] + np.array(strides)[None]) % k
        self.links = np.concatenate([near, far], 1)
        self.entry = int(np.argmin(((centroids - centroids.mean(0)) ** 2).sum(1)))

    def search(self, x: np.ndarray, beam: int, at_once: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of the ``beam`` nearest found for each row of ``x``, nearest first."""
        beam = min(beam, len(self.c))
        parts = [self._search(x[a : a + at_once], beam) for a in range(0, len(x), at_once)]
        if not parts:
            return np.empty((0, beam), np.int64), np.empty((0, beam))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(x), len(self.c)
        row = np.arange(n)
        seen = np.zeros((n, k + 1), bool)
        seen[:, self.entry] = True
        ids = np.full((n, beam), k)
        dist = np.full((n, beam), np.inf)
        done = np.ones((n, beam), bool)
        ids[:, 0], dist[:, 0], done[:, 0] = self.entry, np.sqrt(((x - self.c[self.entry]) ** 2).sum(1)), False
        while True:
            open_ = np.where(done, np.inf, dist)
            best = open_.argmin(1)
            live = np.flatnonzero(np.isfinite(open_[row, best]))
            if not len(live):
                return ids, dist
            done[live, best[live]] = True
            link = self.links[ids[live, best[live]]]
            fresh = ~seen[live[:, None], link]
            # the same centroid twice in a row of links counts once
            order = np.argsort(link, 1, kind="stable")
            s = np.take_along_axis(link, order, 1)
            twice = np.zeros_like(fresh)
            np.put_along_axis(twice, order[:, 1:], s[:, 1:] == s[:, :-1], 1)
            fresh &= ~twice
            seen[live[:, None], link] = True
            d = np.where(fresh, np.sqrt(((self.c[link] - x[live][:, None]) ** 2).sum(2)), np.inf)
            all_ids = np.concatenate([ids[live], np.where(fresh, link, k)], 1)
            all_d = np.concatenate([dist[live], d], 1)
            all_done = np.concatenate([done[live], ~fresh], 1)
            keep = np.argsort(all_d, 1, kind="stable")[:, :beam]
            ids[live], dist[live], done[live] = (np.take_along_axis(v, keep, 1) for v in (all_ids, all_d, all_done))


class PostingIndex:
    """Centroids, their graph and the ratios that prune lists.

    A vector is written to its nearest list and to up to ``copies`` - 1 further ones whose distance is at most ``boundary``
    times the nearest's (boundary vectors). A query opens the lists whose centroid is at most ``ratio`` times as far as its nearest;
    ``ratio`` is the smallest at which the fitted rows, searched against themselves, reach ``recall``.
    """

    def __init__(self, x: np.ndarray, lists: int, copies: int, boundary: float, recall: float, seed: int = 5, probes: int = 256, top: int = 10):
        self.centroids = balanced_centroids(x, lists, seed)
        self.graph = CentroidGraph(self.centroids)
        self.copies, self.boundary = copies, boundary
        rng = np.random.default_rng(seed)
        q = rng.choice(len(x), min(probes, len(x)), replace=False)
        lists_of, ok = self.assign(x)
        near, dist = self.graph.search(x[q], len(self.centroids))
        rank = np.full((len(q), len(self.centroids) + 1), np.inf)
        np.put_along_axis(rank, near, dist / np.maximum(dist[:, :1], 1e-300), 1)
        need = []
        for i, r in enumerate(q):
            d = ((x - x[r]) ** 2).sum(1)
            d[r] = np.inf
            found = np.argsort(d, kind="stable")[: min(top, len(x) - 1)]
            need.append(np.where(ok[found], rank[i][lists_of[found]], np.inf).min(1))
        all_need = np.sort(np.concatenate(need)) if need else np.array([1.0])
        at = min(len(all_need) - 1, int(np.ceil(recall * len(all_need)))) if len(all_need) else 0
        self.ratio = float(all_need[at]) * (1 + 1e-9) if len(all_need) else 1.0
        most = int((rank[:, :-1] <= self.ratio).sum(1).max()) if len(q) else 1
        self.beam = min(len(self.centroids), most + most // 4 + 8)  # wide enough for all lists that a query opens

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lists, mask) of each vector."""
        near, dist = self.graph.search(x, max(16, self.copies * 4))
        near, dist = near[:, : self.copies], dist[:, : self.copies]
        return near, (dist <= self.boundary * dist[:, :1]) & (near < len(self.centroids))

    def select(self, x: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(lists, mask) that each query opens: those within the ratio, and at any rate the nearest ones that hold ``least`` different vectors (``sizes``: entries by list)."""
        need = self.copies * least  # a vector is in so many lists at most
        near, ok, few = self._within(x, self.beam, sizes, need)
        if few.any() and self.beam < len(self.centroids):
            far, far_ok, _ = self._within(x[few], len(self.centroids), sizes, need)
            wide = np.full((len(x), far.shape[1]), len(self.centroids))
            mask = np.zeros(wide.shape, bool)
            wide[:, : near.shape[1]], mask[:, : near.shape[1]] = near, ok
            wide[few], mask[few] = far, far_ok
            return wide, mask
        return near, ok

    def _within(self, x: np.ndarray, beam: int, sizes: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = sizes[: len(self.centroids)]
        near, dist = self.graph.search(x, beam)
        real = near < len(self.centroids)
        held = np.cumsum(np.where(real, np.append(sizes, 0)[near], 0), 1)
        before = held - np.where(real, np.append(sizes, 0)[near], 0)
        ok = (dist <= self.ratio * np.maximum(dist[:, :1], 1e-300)) | (before < need)
        return near, ok & real, held[:, -1] < need if held.shape[1] else np.zeros(len(x), bool)


def _lists(n: int, rows_a_list: int, least_lists: int, most_lists: int) -> int:
    return max(least_lists, min(most_lists, n // rows_a_list))


def fit_index(vectors: DataFrame, n: int, dims: int, rows_a_list: int = 1_000, least_lists: int = 128, most_lists: int = 2_048, fit_rows: int = 32_768, fit_bytes: int = 128 << 20, copies: int = 3, boundary: float = 1.15, recall: float = 0.96, seed: int = 5) -> PostingIndex:
    """Fit on the rows of smallest hash.

    ``n`` rows ask for n / ``rows_a_list`` lists, between ``least_lists`` and ``most_lists``; 64 rows a list are fitted, ``fit_rows`` rows and ``fit_bytes`` at most (the bound of
    the sample that the driver gets). Where ``most_lists`` isn't enough, ``search`` divides the lists again.
    """
    lists = _lists(n, rows_a_list, least_lists, most_lists)
    most = max(1, min(fit_rows, 64 * lists, fit_bytes // (8 * dims)))
    rows = vectors.select("v", F.xxhash64(F.lit(seed), "vec_id", "v").alias("h")).orderBy("h").limit(most).select("v")
    x = _matrix(rows.toArrow().column("v"))
    return PostingIndex(x, max(1, min(lists, len(x) // 16)), copies, boundary, recall, seed)


def search(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    top: int = 10,
    block: int = 2048,
    query_block: int = 512,
    indexed_lengths: int = 16,
    split_rows: int = 16_000,
    **fit,
) -> DataFrame:
    """The ``top`` nearest rows found for each query row: query_id, rank, vec_id, score (Euclidean distance).

    Equal vectors are one entry that keeps its ``top`` + 1 smallest ids: no query can need more of them, however many rows
    share a vector. Every entry goes to its posting lists, every query vector to the lists that the ratio selects. Lists of over ``split_rows``
    entries get an index of their own, fitted in a task, so that lists don't grow with the table. What is long still, and crowds of queries at one list, are dealt into blocks, so that a task holds ``block`` x ``query_block`` vectors at most. Distances are computed on
    the original vectors in double precision; ties go to the smaller id; a query is no neighbour of itself.

    Only vectors of one length can be neighbours. Each of the ``indexed_lengths`` most common lengths has its index; rows of any other length are one list, searched whole.
    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows of null
    id; ids of another type than integers are refused. Repeated (id, vector) rows count once. Fewer candidates give fewer rows; an empty table gives none.
    """
    spark = df.sparkSession
    ship(spark)
    vectors = clean_vectors(df, id_col, vec_col, is_query)
    lengths = vectors.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).limit(indexed_lengths).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexes = {r["dims"]: fit_index(vectors.where(F.col("dims") == r["dims"]), r["count"], r["dims"], **fit) for r in lengths}
    shared = spark.sparkContext.broadcast(indexes)

    ids = F.slice(F.array_sort(F.collect_set("vec_id")), 1, top + 1)
    least = Window.partitionBy("v").orderBy("vec_id")
    kept = vectors.withColumn("n", F.dense_rank().over(least)).where(F.col("n") <= top + 1)
    entries = kept.groupBy("v").agg(ids.alias("ids")).select(F.size("v").alias("dims"), F.col("ids")[0].alias("key"), "ids", "v")
    asked = materialize(vectors.where("asked").select("vec_id", "v").distinct(), "queries")
    questions = asked.groupBy("v").agg(F.min("vec_id").alias("key")).select(F.size("v").alias("dims"), "key", F.array().cast("array<long>").alias("ids"), "v")

    def post(sizes: dict[int, np.ndarray] | None = None):
        def run(batches):
            for whole in batches:
                for a in range(0, whole.num_rows, AT_ONCE):
                    b = whole.slice(a, AT_ONCE)
                    dims = b.column("dims").to_numpy()
                    for d in np.unique(dims).tolist():
                        rows = np.flatnonzero(dims == d)
                        if d not in shared.value:
                            yield _listed(b, rows, np.zeros(len(rows), np.int32), "list")
                            continue
                        x, ix = _matrix(b.column("v").take(rows)), shared.value[d]
                        near, ok = ix.assign(x) if sizes is None else ix.select(x, sizes[d], top + 1)
                        r, c = np.nonzero(ok)
                        yield _listed(b, rows[r], near[r, c], "list")

        return run

    schema = "list int, dims int, key long, ids array<long>, v array<double>"
    posted = materialize(entries.mapInArrow(frugal(post()), schema), "postings")
    counts = materialize(posted.groupBy("dims", "list").count(), "list-sizes")
    held = {d: np.zeros(len(ix.centroids), np.int64) for d, ix in indexes.items()}
    for r in counts.where(F.col("dims").isin(*held)).collect():  # a number a list, most_lists at most a length
        held[r["dims"]][r["list"]] = r["count"]
    opened = materialize(questions.mapInArrow(frugal(post(held)), schema), "opened")
    group = ["dims", "list", "sub"]
    posted, opened = posted.withColumn("sub", F.lit(0)), opened.withColumn("sub", F.lit(0))
    if max((int(h.max()) for h in held.values() if len(h)), default=0) > split_rows:
        posted, opened = _divide(posted, opened, counts.where((F.col("count") > split_rows) & F.col("dims").isin(*held)), top, split_rows, **fit)
    sizes = posted.groupBy(*group).count().select(*group, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    crowds = opened.groupBy(*group).count().select(*group, F.ceil(F.col("count") / query_block).cast("int").alias("crowds"))
    deal = materialize(sizes.join(crowds, group), "deal")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("key"), n).cast("int")
    left = posted.join(deal, group).select(*group, mine("blocks").alias("i"), each("crowds").alias("j"), F.lit(0).alias("kind"), "key", "ids", "v")
    right = opened.join(deal, group).select(*group, each("blocks").alias("i"), mine("crowds").alias("j"), F.lit(1).alias("kind"), "key", "ids", "v")
    group += ["i", "j"]
    met = left.unionByName(right).repartition(*group).sortWithinPartitions(*group, "kind")

    def nearest(batches):
        import pyarrow as pa

        held, last = [], None
        for b in batches:
            if not b.num_rows:
                continue
            g = [b.column(c).to_numpy() for c in group]
            cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in g], axis=0)) + 1).tolist(), b.num_rows]
            for a, z in zip(cuts, cuts[1:]):
                now = tuple(int(c[a]) for c in g)
                if held and now != last:
                    yield from _answers(pa.Table.from_batches(held), top + 1)
                    held = []
                last = now
                held.append(b.slice(a, z - a))
        if held:
            yield from _answers(pa.Table.from_batches(held), top + 1)

    hits = met.mapInArrow(frugal(nearest), "q long, entry long, ids array<long>, score double")
    by_score = Window.partitionBy("q").orderBy("score", "entry")
    best = hits.dropDuplicates(["q", "entry"]).withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= top + 1)
    named = questions.select("key", "v").join(asked, "v").select(F.col("key").alias("q"), F.col("vec_id").alias("query_id"))
    pairs = best.select("q", "score", F.explode("ids").alias("vec_id")).join(named, "q").where("vec_id <> query_id")
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= top).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _listed(batch, rows: np.ndarray, lists: np.ndarray, name: str):
    """The given rows of a batch with their list as the first column."""
    import pyarrow as pa

    t = batch.take(pa.array(rows))
    return pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), *t.columns], names=[name, *t.schema.names])


def _answers(rows, k: int, at_once: int = 64):
    """The ``k`` nearest entries of each query in a group of both; ties go to the smaller id.

    Squared distances by a matrix product tell which entries can be among them, with a margin for its rounding; only those are measured.
    """
    import pyarrow as pa

    kind, key, x = rows.column("kind").to_numpy(), rows.column("key").to_numpy(), _matrix(rows.column("v"))
    e, q = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    if not len(e) or not len(q):
        return
    e = e[np.argsort(key[e], kind="stable")]
    xe, k = np.ascontiguousarray(x[e]), min(k, len(e))
    square = (xe**2).sum(1)
    out = ([], [], [])
    for a in range(0, len(q), at_once):
        xq = x[q[a : a + at_once]]
        own = (xq**2).sum(1)
        near = own[:, None] - 2 * (xq @ xe.T) + square
        margin = 1e-9 * (own + square.max())
        limit = np.partition(near, k - 1, axis=1)[:, k - 1] + margin
        r, c = np.nonzero(~(near > limit[:, None]))
        d = np.sqrt(((xe[c] - xq[r]) ** 2).sum(1))
        order = np.lexsort((c, d, r))
        r, c, d = r[order], c[order], d[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < k
        out[0].append(key[q[a + r[keep]]])
        out[1].append(e[c[keep]])
        out[2].append(d[keep])
    at = np.concatenate(out[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(out[0])), pa.array(key[at]), rows.column("ids").combine_chunks().take(pa.array(at)), pa.array(np.concatenate(out[2]))],
        names=["q", "entry", "ids", "score"],
    )


def _divide(posted: DataFrame, opened: DataFrame, big: DataFrame, top: int, block: int, rows_a_list: int = 1_000, least_lists: int = 1, most_lists: int = 2_048, fit_rows: int = 32_768, fit_bytes: int = 128 << 20, copies: int = 3, boundary: float = 1.15, recall: float = 0.96, seed: int = 5) -> tuple[DataFrame, DataFrame]:
    """``posted`` and ``opened`` with the entries and queries of the ``big`` lists (dims, list, count) in lists of a second level, column sub.

    Each big list's index is fitted, as the first level's is, on its entries of smallest hash (partial group limits before the shuffle) and sent to the blocks of the list's entries and queries.
    """
    keys = ["dims", "list"]
    big = F.broadcast(big.select(*keys, "count"))  # some of the lists of at most indexed_lengths indexes
    wide = posted.join(big, keys).drop("sub")
    subs = F.least(F.lit(most_lists), F.ceil(F.col("count") / rows_a_list))
    most = F.least(F.lit(fit_rows), 64 * subs, F.floor(F.lit(fit_bytes) / (8 * F.col("dims"))))
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit(seed), "key"), "key")
    sample = wide.withColumn("n", F.row_number().over(order)).where(F.col("n") <= fit_rows).where(F.col("n") <= most).select(*keys, subs.alias("subs"), "v")

    def fit(pdf):
        import pandas as pd

        x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        ix = PostingIndex(x, max(1, min(int(pdf["subs"].iloc[0]), len(x) // 16)), copies, boundary, recall, seed)
        return pd.DataFrame({"dims": [pdf["dims"].iloc[0]], "list": [pdf["list"].iloc[0]], "index": [pickle.dumps(ix)]})

    indexes = materialize(sample.groupBy(*keys).applyInPandas(fit, "dims int, list int, index binary"), "sub-indexes")

    def route(rows: DataFrame, models: DataFrame) -> DataFrame:
        blocks = F.ceil(F.col("count") / block).cast("int")
        sizes = materialize(rows.groupBy(*keys).count(), "sub-sizes")
        data = rows.join(sizes, keys).select(*keys, F.pmod(F.xxhash64("key"), blocks).cast("int").alias("i"), F.lit(None).cast("binary").alias("index"), F.lit(None).cast("array<long>").alias("held"), "key", "ids", "v")
        first = models.join(sizes, keys).select(*keys, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"), "index", "held", F.lit(None).cast("long").alias("key"), F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<double>").alias("v"))
        together = data.unionByName(first).repartition(*keys, "i").sortWithinPartitions(*keys, "i", F.col("index").isNull())

        def run(batches):
            import pyarrow as pa

            ix, held = None, None
            for b in batches:
                model = np.flatnonzero(b.column("index").is_valid().to_numpy(zero_copy_only=False))
                cuts = [0, *model.tolist(), b.num_rows]
                for a, z in zip(cuts, cuts[1:]):
                    if a in model:
                        ix, held = pickle.loads(b.column("index")[a].as_py()), b.column("held")[a].as_py()
                        a += 1
                    for f in range(a, z, AT_ONCE):
                        part = b.slice(f, min(AT_ONCE, z - f)).select(["dims", "list", "key", "ids", "v"])
                        x = _matrix(part.column("v"))
                        near, ok = ix.assign(x) if held is None else ix.select(x, np.array(held, np.int64), top + 1)
                        r, c = np.nonzero(ok)
                        yield _listed(part, r, near[r, c], "sub")

        return together.mapInArrow(frugal(run), "sub int, dims int, list int, key long, ids array<long>, v array<double>")

    none = F.lit(None).cast("array<long>")
    divided = materialize(route(wide.drop("count"), indexes.withColumn("held", none)), "sub-postings")
    held = divided.groupBy(*keys, "sub").count().groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("sub", "count"))).alias("m"))  # at most most_lists entries a row
    full = F.transform(F.sequence(F.lit(0), F.lit(most_lists)), lambda s: F.coalesce(F.element_at("m", s), F.lit(0).cast("long")))
    sized = materialize(indexes.join(held, keys).select(*keys, "index", full.alias("held")), "sub-indexes")
    asked = opened.join(big, keys).drop("sub", "count")
    cols = ["dims", "list", "sub", "key", "ids", "v"]
    out = [rows.join(big, keys, "left_anti").select(*cols).unionByName(more.select(*cols)) for rows, more in ((posted, divided), (opened, route(asked, sized)))]
    return materialize(out[0], "postings"), materialize(out[1], "opened")
