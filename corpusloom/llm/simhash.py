"""SimHash near-dedup with sharded BK-trees."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.text import WORD_BYTES
from corpusloom.operators.graph import connected_components
from corpusloom.runtime import frugal, materialize, ship

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Odd constants that give further 64-bit hashes of a shingle's first.
_MIX = 0xBF58476D1CE4E5B9
_AT_ONCE = 1 << 15


def _shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all shingles in order, in blocks: memory follows the text, not its shingles."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    w = WORD_BYTES.findall(text.translate(_LOWER))
    if not w:
        return
    if len(w) < words:
        yield np.array([digest(b" ".join(w), 42)], np.uint64)
        return
    for a in range(0, len(w) - words + 1, _AT_ONCE):
        part = w[a : a + _AT_ONCE + words - 1]
        joined = b" ".join(part)
        stop = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        begin = (stop - np.fromiter(map(len, part), np.int64, len(part)) - 1).tolist()
        end = (stop - 1).tolist()
        yield np.fromiter([digest(joined[s:e], 42) for s, e in zip(begin, end[words - 1 :])], np.uint64, len(part) - words + 1)


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    blocks = [np.unique(h) for h in _shingle_hashes((text or "").encode("utf-8", "surrogatepass"), words)]
    return blocks[0] if len(blocks) == 1 else np.unique(np.concatenate(blocks)) if blocks else np.empty(0, np.uint64)


def simhash(text: str | None, words: int = 4, bits: int = 64) -> bytes:
    """Fingerprint of a text: bit k is 1 if it is set in over half of its shingles' hashes (repeats count).

    Big-endian bytes. The first 64 bits come from XXH64 with seed 42, further ones from mixes of it. No words: zero.
    """
    return _sign(_shingle_hashes((text or "").encode("utf-8", "surrogatepass"), words), bits)


def set_simhash(shingles: np.ndarray, bits: int = 256) -> bytes:
    """Fingerprint of a set of shingles, each counted once: it estimates the sets' similarity, whatever repeats in a text."""
    return _sign((shingles[a : a + _AT_ONCE] for a in range(0, len(shingles), _AT_ONCE)), bits)


def _sign(hashes: Iterator[np.ndarray], bits: int) -> bytes:
    ones, total = np.zeros(bits, np.int64), 0
    for h in hashes:
        total += len(h)
        for k in range(bits // 64):
            x = h
            if k:
                x = (h ^ (h >> np.uint64(29 + k % 7))) * np.uint64((_MIX + 2 * k) % (1 << 64))
                x = x ^ (x >> np.uint64(32))
            b = np.unpackbits(x.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones[64 * k : 64 * k + 64] += b.sum(0, dtype=np.int64)
    return np.packbits(2 * ones > total).tobytes() if total else bytes(bits // 8)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = 64) -> DataFrame:
    """(id, fp binary) of every row; a null text has no words."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            fps = [simhash(t.as_py(), words, bits) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.binary())], names=["id", "fp"])

    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(frugal(run), f"id {rows.schema['id'].dataType.simpleString()}, fp binary")


def exact_keys(bits: int, radius: int, n: int, most: int = 64) -> list[list[int]]:
    """Bit positions of the keys of which two fingerprints within ``radius`` share one at least (pigeonhole).

    The bits are cut into p > radius parts; ``radius`` flipped bits leave p - radius parts whole, so every choice of that many parts is
    a key. p grows until ``n`` evenly spread fingerprints put about ``most`` under one key.
    """
    for parts in range(radius + 1, radius + 5):
        cut = [list(map(int, x)) for x in np.array_split(np.arange(bits), parts)]
        keys = [sorted(sum(c, [])) for c in itertools.combinations(cut, parts - radius)]
        if n / 2 ** min(map(len, keys)) <= most:
            break
    return keys


def sampled_keys(bits: int, radius: int, n: int, recall: float = 0.99, most: int = 64, seed: int = 7) -> list[list[int]]:
    """Random bit positions: a pair at distance ``radius`` shares a key with probability ``recall``, nearer pairs more likely.

    For radii at which the pigeonhole keys would be too short to tell fingerprints apart.
    """
    length = max(8, min(40, math.ceil(math.log2(max(2, n) / most)) + 1))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - (1 - radius / bits) ** length))
    rng = np.random.default_rng(seed)
    return [sorted(map(int, rng.choice(bits, length, replace=False))) for _ in range(tables)]


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(1, dtype=np.int32)


class Forest:
    """BK-trees of many shards at once, in arrays.

    ``fps`` (n x words of uint64) are the items, distinct in a shard; ``shard`` (sorted) names each item's tree. A tree's root is its first
    item; an item's place is found by following, from the root, the child at its own distance. All items of a subtree
    reach its root in the same step, so that a step handles all trees at once: of the items at one node and
    distance, the first becomes the child there, the others move on to it. Edges are kept sorted by (node, distance).
    """

    def __init__(self, fps: np.ndarray, shard: np.ndarray):
        self.fps, self.bits = fps, fps.shape[1] * 64
        n = len(fps)
        self.shards, self.roots = np.unique(shard, return_index=True)
        at = np.repeat(self.roots, np.diff(np.append(self.roots, n)))
        left = np.setdiff1d(np.arange(n), self.roots, assume_unique=True)
        keys, children = [], []
        while len(left):
            slot = at[left] * (self.bits + 1) + _distance(fps[left], fps[at[left]])
            uniq, first, inverse = np.unique(slot, return_index=True, return_inverse=True)
            keys.append(uniq)
            children.append(left[first])
            stay = np.ones(len(left), bool)
            stay[first] = False
            at[left] = left[first][inverse]
            left = left[stay]
        self.edges = np.concatenate(keys) if keys else np.empty(0, np.int64)
        self.child = np.concatenate(children) if children else np.empty(0, np.int64)
        order = np.argsort(self.edges, kind="stable")
        self.edges, self.child = self.edges[order], self.child[order]

    def within(self, fps: np.ndarray, shard: np.ndarray, radius: int, at_once: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, item) pairs within ``radius`` in the query's own tree; from a node only edges within it of the query's distance are followed."""
        tree = np.searchsorted(self.shards, shard)
        known = (tree < len(self.shards)) & (self.shards[np.minimum(tree, len(self.shards) - 1)] == shard)
        stack = []
        q = np.flatnonzero(known)
        for a in range(0, len(q), at_once):
            stack.append((q[a : a + at_once], self.roots[tree[q[a : a + at_once]]]))
        while stack:
            q, node = stack.pop()
            d = _distance(fps[q], self.fps[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            base = node * (self.bits + 1)
            lo = np.searchsorted(self.edges, base + np.maximum(0, d - radius))
            hi = np.searchsorted(self.edges, base + np.minimum(self.bits, d + radius), side="right")
            n = hi - lo
            total = int(n.sum())
            if total:
                q2 = np.repeat(q, n)
                place = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                node2 = self.child[place]
                for a in range(0, total, at_once):
                    stack.append((q2[a : a + at_once], node2[a : a + at_once]))


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the links a-b."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        if (x == y).all():
            break
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while True:
            after = label[label]
            if (after == label).all():
                break
            label = after
    return label


def near_links(distinct: DataFrame, bits: int, radius: int, keys: list[list[int]], block: int = 1024, count_first: bool = False) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) such that those within ``radius`` that share a key are connected.

    Every fingerprint goes to one shard a key. A shard of up to ``block`` fingerprints is one BK-tree. A larger shard is
    dealt into blocks by hash: each block's tree is sent to all the shard's blocks of queries, one task's work a pair of
    blocks. A task answers with a spanning forest of the links it found, never with all pairs.

    With ``count_first`` the shards beyond a block are a written table (few rows, if any), and fingerprints pass one shuffle less; it pays for many keys.
    """
    words = bits // 64

    def rows(col) -> np.ndarray:
        return np.frombuffer(b"".join(col.to_pylist()), ">u8").astype(np.uint64).reshape(-1, words)

    def deal(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            fps = b.column(0)
            flat = np.unpackbits(np.frombuffer(b"".join(fps.to_pylist()), np.uint8).reshape(-1, bits // 8), axis=1)
            for t, positions in enumerate(keys):
                key = flat[:, positions].astype(np.int64) @ (1 << np.arange(len(positions), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), t, np.int32)), pa.array(key), fps], names=["t", "key", "fp"])

    dealt = distinct.select("fp").mapInArrow(frugal(deal), "t int, key long, fp binary")
    sizes = dealt.groupBy("t", "key").count()
    if count_first:
        shards = dealt.join(materialize(sizes.where(F.col("count") > block), "shards"), ["t", "key"], "left")
    else:
        shards = dealt.join(sizes.where("count > 1"), ["t", "key"])
    blocks = F.ceil(F.coalesce("count", F.lit(1)) / block).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = shards.select("t", "key", "fp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    pairs = pairs.select("t", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") <= F.col("other")).alias("item"), (F.col("mine") >= F.col("other")).alias("query"), "fp")
    group = ["t", "key", "i", "j"]
    together = pairs.repartition(*group).sortWithinPartitions(*group, "fp")

    def link(batches):
        import pyarrow as pa

        def solve(table):
            fps = rows(table.column("fp"))
            cols = [table.column(c).to_numpy() for c in group]
            new = np.any([c[1:] != c[:-1] for c in cols], axis=0)
            shard = np.concatenate([[0], np.cumsum(new)])
            item, query = table.column("item").to_numpy(zero_copy_only=False), table.column("query").to_numpy(zero_copy_only=False)
            items, queries = np.flatnonzero(item), np.flatnonzero(query)
            if not len(items) or not len(queries):
                return
            forest = Forest(fps[items], shard[items])
            label, held, size = np.arange(len(fps)), [], 0
            for q, x in forest.within(fps[queries], shard[queries], radius):
                a, b = queries[q], items[x]
                held.append((a[a != b], b[a != b]))
                size += len(a)
                if size > 1 << 20:
                    label = spanning(len(fps), *map(np.concatenate, zip(*held, (np.arange(len(fps)), label))))
                    held, size = [], 0
            if held:
                label = spanning(len(fps), *map(np.concatenate, zip(*held, (np.arange(len(fps)), label))))
            linked = np.flatnonzero(label != np.arange(len(fps)))
            if len(linked):
                col = table.column("fp").combine_chunks() if hasattr(table.column("fp"), "combine_chunks") else table.column("fp")
                yield pa.RecordBatch.from_arrays([col.take(pa.array(linked)), col.take(pa.array(label[linked]))], names=["a", "b"])

        def same(x, i, y, j):
            return all(x.column(c)[i] == y.column(c)[j] for c in group)

        held, n = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if n >= 1 << 15:  # give out all whole groups
                whole = pa.Table.from_batches(held)
                last, cut = whole.num_rows - 1, whole.num_rows
                if same(whole, last, b, 0):
                    cols = [whole.column(c).to_numpy() for c in group]
                    differs = np.flatnonzero(np.any([c != c[-1] for c in cols], axis=0))
                    cut = int(differs[-1]) + 1 if len(differs) else 0
                if cut:
                    yield from solve(whole.slice(0, cut))
                held = whole.slice(cut).to_batches()
                n = sum(x.num_rows for x in held)
            held.append(b)
            n += b.num_rows
        if held:
            yield from solve(pa.Table.from_batches(held))

    return together.mapInArrow(frugal(link), "a binary, b binary")


def near_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    bits: int = 64,
    radius: int = 4,
    recall: float | None = None,
) -> DataFrame:
    """Near-copies by SimHash alone: a row a row of ``df``: (id, fp, component).

    Fingerprints of at most ``radius`` differing bits are linked; a component is named by the smallest id in it. ``recall=None`` makes
    the search exact (pigeonhole keys), which pays for small radii; else pairs at the very radius meet with that probability and nearer
    ones more surely.

    Equal fingerprints are one node, however many rows share it. Null texts have the zero fingerprint; a component of null ids alone is named null;
    repeated rows are separate rows. An empty table gives no rows.
    """
    fps = materialize(fingerprints(df, id_col, text_col, words, bits), "simhash")
    distinct = materialize(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    n = distinct.count()
    keys = exact_keys(bits, radius, n) if recall is None else sampled_keys(bits, radius, n, recall)
    found = connected_components(near_links(distinct, bits, radius, keys))
    of = _named(distinct, found, "fp")
    return fps.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component")


def _named(nodes: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, component) of all nodes (key, least): the smallest id of those that ``found`` puts together, or a node's own."""
    rooted = nodes.join(found, nodes[key] == found["node"], "left").select(nodes[key], "least", F.coalesce("component", nodes[key]).alias("root"))
    rooted = materialize(rooted, "simhash-roots")
    named = materialize(rooted.groupBy("root").agg(F.min("least").alias("component")), "simhash-names")  # a shuffle of its own, so that a large component can be split
    return rooted.join(named, "root").select(key, "component")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two ascending arrays of distinct hashes; two empty ones are alike."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(not len(b))
    both = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))
    return both / (len(a) + len(b) - both)


def alike(fps: np.ndarray, sets: list[np.ndarray], items: np.ndarray, queries: np.ndarray, radius: int, similarity: float, at_once: int = 256) -> np.ndarray:
    """For each set the first of those it is connected with by query-item pairs of exact Jaccard ``similarity`` and more.

    Pairs within ``radius`` are compared, nearest first; those connected already need no comparison.
    """
    size = np.array([len(s) for s in sets])
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(0, len(queries), at_once):
        q = queries[a : a + at_once]
        d = np.bitwise_count(fps[q][:, None] ^ fps[items][None]).sum(2, dtype=np.int32)
        least, most = np.minimum(size[q][:, None], size[items]), np.maximum(size[q][:, None], size[items])
        x, y = np.nonzero((d <= radius) & (least / np.maximum(most, 1) >= similarity * (most > 0)) & (q[:, None] != items))
        order = np.argsort(d[x, y], kind="stable")
        for i, j in zip(q[x[order]].tolist(), items[y[order]].tolist()):
            i0, j0 = root(i), root(j)
            if i0 != j0 and jaccard(sets[i], sets[j]) >= similarity:
                parent[max(i0, j0)] = min(i0, j0)
    return np.array([root(x) for x in range(len(sets))], np.int64)


def similar_links(sets: DataFrame, similarity: float, radius: int, block: int = 1024, block_bytes: int = 32 << 20) -> DataFrame:
    """Links (a, b) between nodes such that those of exact Jaccard ``similarity`` within ``radius`` in a candidate group are connected.

    ``sets`` has root, count and bytes (of the root's group), node, fp and shingles. Groups beyond a block are dealt into blocks as
    in ``near_links``; a task answers with a spanning forest.
    """
    blocks = F.greatest(F.ceil(F.col("count") / block), F.ceil(F.col("bytes") / block_bytes), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = sets.select("root", "node", "fp", "shingles", mine.alias("mine"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select("root", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") <= F.col("other")).alias("item"), (F.col("mine") >= F.col("other")).alias("query"), "node", "fp", "shingles")
    group = ["root", "i", "j"]
    together = dealt.repartition(*group).sortWithinPartitions(*group, "node")

    def link(batches):
        import pyarrow as pa

        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in (*group, "item", "query", "node", "fp", "shingles"))))
        for _, members in itertools.groupby(rows, key=lambda r: r[:3]):
            item, query, node, fp, shingles = zip(*(r[3:] for r in members))
            fps = np.frombuffer(b"".join(fp), ">u8").astype(np.uint64).reshape(len(fp), -1)
            label = alike(fps, [np.frombuffer(x, "<u8") for x in shingles], np.flatnonzero(item), np.flatnonzero(query), radius, similarity)
            linked = np.flatnonzero(label != np.arange(len(label))).tolist()
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array([node[x] for x in linked], pa.binary()), pa.array([node[label[x]] for x in linked], pa.binary())], names=["a", "b"])

    return together.mapInArrow(frugal(link), "a binary, b binary")


def similar_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity: float = 0.8,
    bits: int = 256,
    radius: int | None = None,
    meet: int | None = None,
    recall: float = 0.99,
) -> DataFrame:
    """Near-copies by the exact Jaccard similarity of their shingle sets: a row a row of ``df``: (id, fp, component).

    SimHash over the sets finds the candidates: components of fingerprints of at most ``radius`` differing bits. Pairs at ``similarity`` differ in
    bits * acos(2J / (1 + J)) / pi bits on average, with a binomial spread: without ``radius`` and ``meet`` the former is six standard deviations beyond
    (three and more for the smallest sets, which scatter most), the latter, the distance at which pairs share a key with probability ``recall``, two and a half; nearer ones meet more surely.
    Among candidates, sets of exact Jaccard ``similarity`` and more are linked. A component of such links is named by its smallest id.

    Shingles are compared by their 64-bit hashes. Equal sets are one node, however many rows share it; texts without words are alike. A component of null ids alone is named
    null; repeated rows are separate rows. An empty table gives no rows.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    spread = math.sqrt(bits * share * (1 - share))
    radius = int(bits * share + 6 * spread) if radius is None else radius
    meet = min(radius, math.ceil(bits * share + 2.5 * spread)) if meet is None else meet
    ship(df.sparkSession)
    texts = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))

    def sign(batches):
        import pyarrow as pa
        import xxhash

        for b in batches:
            node, fp, size = [], [], []
            for t in b.column(2):
                s = shingle_set(t.as_py(), words)
                node.append(xxhash.xxh3_128_digest(s.tobytes()))
                fp.append(set_simhash(s, bits))
                size.append(len(s))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node, pa.binary()), pa.array(fp, pa.binary()), pa.array(size, pa.int64())], names=["id", "hash", "node", "fp", "size"])

    def collect(batches):
        import pyarrow as pa

        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingle_set(t.as_py(), words).astype("<u8").tobytes() for t in part.column(1)], pa.binary())], names=["node", "shingles"])

    rows = materialize(texts.mapInArrow(frugal(sign), f"id {texts.schema['id'].dataType.simpleString()}, hash long, node binary, fp binary, size long"), "simhash")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("hash").alias("hash")))
    nodes = materialize(rows.groupBy("node", "fp", "size").agg(first.alias("first")).select("node", "fp", "size", F.col("first.id").alias("least"), F.col("first.hash").alias("hash")), "simhash-nodes")
    distinct = materialize(nodes.select("fp").distinct(), "simhash-distinct")
    keys = sampled_keys(bits, meet, distinct.count(), recall)
    found = connected_components(near_links(distinct, bits, radius, keys, count_first=True)).toDF("at", "component")
    rooted = materialize(nodes.join(found, nodes["fp"] == found["at"], "left").select("node", "fp", "size", "least", "hash", F.coalesce("component", "fp").alias("root")), "simhash-roots")
    several = materialize(rooted.groupBy("root").agg(F.count(F.lit(1)).alias("count"), (F.sum("size") * 8).alias("bytes")).where("count > 1"), "candidates")
    members = materialize(rooted.join(several, "root"), "candidates")
    wanted = members.select(F.col("node"), F.col("least"), F.col("hash").alias("thash"))
    met = texts.join(wanted, texts["id"].eqNullSafe(wanted["least"]) & (texts["hash"] == wanted["thash"])).select("node", "text")
    sets = materialize(met.mapInArrow(frugal(collect), "node binary, shingles binary"), "shingles").dropDuplicates(["node"])
    links = similar_links(members.select("root", "count", "bytes", "node", "fp").join(sets, "node"), similarity, radius)
    of = _named(nodes.select("node", "least"), connected_components(links), "node")
    return rows.join(of, "node").select(F.col("id").alias(id_col), "fp", "component")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """The rows of which one stays per component, that of the smallest id, with all their columns. Rows of null id all stay."""
    groups = similar_groups(df, id_col, text_col, **kwargs)
    gone = groups.where(F.col(id_col) != F.col("component")).select(F.col(id_col).alias("gone_id")).distinct()
    return df.join(gone, F.col(id_col) == F.col("gone_id"), "left_anti")
