"""Candidate pairs by weighted record linkage: postings, idf, blocking, scores, ranking.

Documents carry keys of several signals. Keys that few documents share propose pairs; every shared key then scores them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.vectors import dot, norm
from corpusloom.operators import meetings
from corpusloom.runtime import discard, frugal, materialize, ship, shuffle_partitions

SIGNALS = ("node", "ayah", "ravi", "bab", "kitab", "vector")
#: Signals fit in so many values: a place is position * RANKS + rank of the signal, so that positions stay below 2^59.
RANKS = 8
#: Pairs that a task groups at a time (with vectors), those that a task works out where they meet, and the documents' keys that meet there.
PAIRS_A_TASK = 1_000_000
PAIRS_TO_MEET = 8_000_000
KEYS_TO_MEET = 500_000


@dataclass(frozen=True)
class LinkOptions:
    """Caps and weights. A key blocks if 2 <= df <= max_members and, from min_docs documents on, df / N <= max_ratio."""

    max_ratio: float = 0.02
    max_members: int = 400
    min_docs: int = 200
    weights: dict[str, float] = field(default_factory=lambda: {"node": 1.0, "ayah": 1.4, "bab": 0.8, "kitab": 0.15, "ravi": 0.3, "vector": 1.2})
    never_block: tuple[str, ...] = ("kitab",)


def postings(docs: DataFrame, signals: dict[str, Column], doc_col: str = "doc_id", pos_col: str = "pos", distinct: bool = True) -> DataFrame:
    """Distinct (doc, pos, signal, key). ``signals`` maps a signal's name to an array or scalar column; null and empty keys carry nothing.

    Where each document is known to be one row, its keys are distinct as they are (``distinct=False`` saves the shuffle).
    """
    types = docs.select(*[c.alias(s) for s, c in signals.items()]).schema

    def keys_of(signal: str, c: Column) -> Column:
        c = c if types[signal].dataType.typeName() == "array" else F.array(c)
        return F.transform(F.array_distinct(F.coalesce(c.cast("array<string>"), F.array().cast("array<string>"))), lambda k: F.struct(F.lit(signal).alias("signal"), k.alias("key")))

    keys = [keys_of(s, c) for s, c in signals.items()]
    rows = docs.select(F.col(doc_col).alias("doc"), F.col(pos_col).alias("pos"), F.explode(F.concat(*keys)).alias("k"))
    rows = rows.select("doc", "pos", "k.signal", "k.key").where("key is not null and key <> ''")
    return rows.distinct() if distinct else rows


def idf(posts: DataFrame, n_docs: int) -> DataFrame:
    """(signal, key, df, first_pos, idf): idf = ln(1 + N / df)."""
    n = F.lit(float(max(n_docs, 1)))
    keys = posts.groupBy("signal", "key").agg(F.count(F.lit(1)).alias("df"), F.min("pos").alias("first_pos"))
    return keys.withColumn("idf", F.log1p(n / F.col("df")))


def blocks(n_docs: int, options: LinkOptions = LinkOptions()) -> Column:
    """Whether a key (signal, df) may propose pairs. The caps come before the self-join: they bound its size at caps x keys."""
    small = (F.col("df") >= 2) & (F.col("df") <= options.max_members)
    rare = F.lit(n_docs < options.min_docs) | (F.col("df") / F.lit(float(max(n_docs, 1))) <= options.max_ratio)
    return ~F.col("signal").isin(*options.never_block) & small & rare


def members(posts: DataFrame, keys: DataFrame, n_docs: int, ranks: list[int], options: LinkOptions = LinkOptions()) -> DataFrame:
    """(kid, place, rank, share, doc, and c, k, m, n for each of ``ranks``): a row for every document at every key that blocks.

    ``share`` is what the key adds to a pair's score, ``place`` says which key came first (its first document, then the order of signals). The document's keys that
    several documents have but that don't block travel with it, once a posting, so that a pair needs no second look at either side: by rank, c<rank> (kid, share), k<rank> the kids alone, and two masks with a bit for each
    key: sets of keys whose masks have no bit in common have no key in common.
    """
    rank = F.coalesce(*[F.when(F.col("signal") == s, F.lit(i)) for i, s in enumerate(SIGNALS)], F.lit(len(SIGNALS)))
    weight = F.coalesce(*[F.when(F.col("signal") == s, F.lit(float(x))) for s, x in options.weights.items()], F.lit(0.0))
    k = keys.select("signal", "key", "kid", rank.alias("rank"), (F.col("first_pos").cast("long") * RANKS + rank).alias("place"), (F.col("idf") * weight).alias("share"), blocks(n_docs, options).alias("blocks")).where(keys["df"] > 1)
    met = posts.select("doc", "signal", "key").join(k, ["signal", "key"])
    item = F.struct("kid", "place", "rank", "share", "blocks")
    docs = met.groupBy("doc").agg(F.array_sort(F.collect_list(item)).alias("items"))
    bit = lambda seed, k: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.lit(seed), k), F.lit(64)).cast("int"))
    for r in ranks:
        docs = docs.withColumn(f"c{r}", F.transform(F.filter("items", lambda x: ~x["blocks"] & (x["rank"] == r)), lambda x: F.struct(x["kid"].alias("kid"), x["share"].alias("share"))))  # noqa: B023
        docs = docs.withColumn(f"k{r}", F.transform(f"c{r}", lambda x: x["kid"]))
        docs = docs.withColumns({f"{name}{r}": F.aggregate(f"k{r}", F.lit(0).cast("long"), lambda m, k: m.bitwiseOR(bit(seed, k))) for seed, name in ((1, "m"), (2, "n"))})  # noqa: B023
    common = [f"{c}{r}" for r in ranks for c in "ckmn"]
    rows = docs.select("doc", *common, F.explode(F.filter("items", lambda x: x["blocks"])).alias("b"))
    return rows.select("b.kid", "b.place", "b.rank", "b.share", "doc", *common)


def pair_up(rows: DataFrame, n_pairs: int, blocking: list[int], common: list[int], vectors: DataFrame | None = None, weight: float = 0.0) -> DataFrame:
    """(left, right, place, share_<rank> ...) of all pairs of ``members`` that share a blocking key, each once.

    One self-join on the key (at most ``max_members`` rows a key) and one shuffle of narrow pairs into tasks of about ``PAIRS_A_TASK``, as ``n_pairs`` (from the keys' counts) asks for. Shares of blocking keys
    are summed; those of common keys are worked out where a pair meets, and are the same wherever it does.
    """
    if vectors is not None:
        unit = vectors.toDF("doc", "v").withColumn("n", norm(F.col("v"))).where("n > 0").select("doc", F.transform("v", lambda x: x / F.col("n")).alias("v"))
        rows = materialize(rows.join(unit, "doc", "left"), "members")
    v = ["v"] if vectors is not None else []
    left = rows.select("kid", "place", "rank", "share", F.col("doc").alias("left"), *[F.col(c).alias(f"l_{c}") for r in common for c in (f"c{r}", f"m{r}", f"n{r}")], *[F.col(c).alias("l_v") for c in v])
    right = rows.select("kid", F.col("doc").alias("right"), *[F.col(c).alias(f"r_{c}") for r in common for c in (f"k{r}", f"m{r}", f"n{r}")], *[F.col(c).alias("r_v") for c in v])
    met = left.join(right, "kid").where(F.col("left") < F.col("right"))

    def shared(r: int) -> Column:
        total = F.aggregate(f"l_c{r}", F.lit(0.0), lambda t, x: F.when(F.array_contains(f"r_k{r}", x["kid"]), t + x["share"]).otherwise(t))
        maybe = (F.col(f"l_m{r}").bitwiseAND(F.col(f"r_m{r}")) != 0) & (F.col(f"l_n{r}").bitwiseAND(F.col(f"r_n{r}")) != 0)
        return F.when(maybe, total).otherwise(F.lit(0.0))

    more = [shared(r).alias(f"c{r}") for r in common]
    if vectors is not None:
        more.append(F.coalesce(F.greatest(F.lit(0.0), dot(F.col("l_v"), F.col("r_v")) * weight), F.lit(0.0)).alias("vector"))
    pairs = met.select("left", "right", "place", "rank", "share", *more)
    parts = max(shuffle_partitions(rows.sparkSession), -(-n_pairs // PAIRS_A_TASK))
    sums = [F.sum(F.when(F.col("rank") == r, F.col("share")).otherwise(F.lit(0.0))).alias(f"b{r}") for r in blocking]
    extra = [F.max(f"c{r}").alias(f"c{r}") for r in common] + ([F.max("vector").alias("vector")] if vectors is not None else [])
    g = pairs.repartition(parts, "left", "right").groupBy("left", "right").agg(F.min("place").alias("place"), *sums, *extra)
    both = [sum((F.col(c) for c in (f"b{r}", f"c{r}") if c in g.columns), F.lit(0.0)).alias(f"share_{r}") for r in sorted({*blocking, *common})]
    return g.select("left", "right", "place", *both, *([F.col("vector").alias(f"share_{SIGNALS.index('vector')}")] if vectors is not None else []))


def numbered(keys: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``keys`` with ``kid``, their number from 0 in ``order``, and how many they are. Written, so that a key keeps its number; what is collected is a count a partition."""
    t = materialize(keys.orderBy(*order, "signal", "key").withColumn("kid", F.monotonically_increasing_id()), "keys", drop_shuffles=True)
    part = F.shiftright("kid", 33).cast("int")
    sizes = {r["part"]: r["n"] for r in t.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, n = [], 0
    for i in range(max(sizes, default=-1) + 1):
        starts.append(n)
        n += sizes.get(i, 0)
    if not n:
        return t, 0
    return t.withColumn("kid", F.col("kid").bitwiseAND(F.lit((1 << 33) - 1)) + F.element_at(F.lit(starts).cast("array<bigint>"), part + 1)), n


def meet(posts: dict[str, DataFrame], keys: DataFrame, n_docs: int, options: LinkOptions = LinkOptions(), shares: bool = True, used_up: tuple[DataFrame, ...] = ()) -> DataFrame:
    """(left, right, first, and share_<rank> ..., or their sum score) of all pairs that share a blocking key, each once; no pair is shuffled.

    ``posts`` has (doc, pos, signal, key) of each signal, every document's key once; ``keys`` is their ``idf``, as a written table. Documents get the numbers of their keys signal by signal, so that the shuffles
    of one are gone before the next begins; then every document goes to the tasks that hold one of its blocking keys (``meetings``). ``used_up``: written tables that nothing needs once the numbers are in place.
    """
    import numpy as np

    spark = keys.sparkSession
    order = {s: i for i, s in enumerate(SIGNALS)}
    rank = F.coalesce(*[F.when(F.col("signal") == s, F.lit(i)) for s, i in order.items()], F.lit(len(SIGNALS)))
    k = keys.where("df > 1").select("signal", "key", "df", rank.alias("rank"), (F.col("first_pos").cast("long") * RANKS + rank).alias("place"), blocks(n_docs, options).alias("blocks"))
    block, n_block = numbered(k.where("blocks"), "place")
    other, n_other = numbered(k.where("not blocks"), "rank", "df")
    width = min(options.max_members, n_docs) + 1
    codes = 8 * width
    weights = np.zeros(RANKS)
    for s in posts:
        weights[order.get(s, len(SIGNALS))] = options.weights.get(s, 0.0)
    n = float(max(n_docs, 1))

    def idf_share(rank, df):
        return np.log1p(n / df) * weights[rank]

    groups = other.groupBy("rank", "df").agg(F.min("kid").alias("first")).orderBy("first").collect()  # distinct counts: at most about the square root of twice the postings, for each signal
    common = np.array([r["first"] for r in groups], np.int64), np.array([r["rank"] for r in groups], np.int64), idf_share(np.array([r["rank"] for r in groups], np.int64), np.array([r["df"] for r in groups], np.float64))
    met = block.agg(F.sum("df").alias("keys"), F.sum(F.col("df") * (F.col("df") - 1) / 2).cast("long").alias("pairs")).first()
    ranks = sorted({r["rank"] for r in block.select("rank").distinct().collect()} | {r["rank"] for r in groups})
    items = block.select("signal", "key", (F.col("kid") * codes + F.col("rank") * width + F.col("df")).alias("item")).unionByName(other.select("signal", "key", (-1 - F.col("kid")).alias("item")))
    lists = []
    for s, p in posts.items():
        mine = items.where(F.col("signal") == s).select("key", "item").hint("shuffle_hash")
        lists.append(materialize(p.select("doc", "key").where("doc is not null").join(mine, "key").groupBy("doc").agg(F.collect_list("item").alias("items")), "link-keys", drop_shuffles=True))
    for t in used_up:
        discard(t)
    union = lists[0]
    for t in lists[1:]:
        union = union.unionByName(t)
    docs = materialize(union.groupBy("doc").agg(F.flatten(F.collect_list("items")).alias("items")), "link-items", drop_shuffles=True) if len(lists) > 1 else union
    for t in lists if len(lists) > 1 else ():
        discard(t)
    ship(spark)
    tasks = max(shuffle_partitions(spark), -(-(met["pairs"] or 0) // PAIRS_TO_MEET), -(-(met["keys"] or 0) // KEYS_TO_MEET))
    dealt = docs.mapInArrow(frugal(meetings.deal(tasks, codes)), "task int, block binary").repartitionById(tasks, "task")
    kind = docs.schema["doc"].dataType.simpleString()
    columns = [f"share_{r}" for r in ranks] if shares else ["score"]
    schema = f"`left` {kind}, `right` {kind}, first int, " + ", ".join(f"{c} double" for c in columns) if columns else f"`left` {kind}, `right` {kind}, first int"
    return dealt.mapInArrow(frugal(meetings.meet(tasks, codes, ranks, idf_share, n_block, common, n_other, shares)), schema)


def rank(scored: DataFrame, min_score: float = 0.0, limit: int | None = None, judged: DataFrame | Column | None = None) -> DataFrame:
    """Best pairs first. Pairs already judged leave before the limit, so that reruns go on down the list: those of a table (left, right), or those for which a column is true, which takes no join."""
    out = scored.where(F.col("score") >= min_score)
    if isinstance(judged, Column):
        out = out.where(~F.coalesce(judged, F.lit(False)))
    elif judged is not None:
        out = out.join(judged.select("left", "right"), ["left", "right"], "left_anti")
    out = out.orderBy(F.desc("score"), "left", "right")
    return out.limit(limit) if limit else out


def candidates(docs: DataFrame, signals: dict[str, Column], doc_col: str = "doc_id", pos_col: str = "pos", options: LinkOptions = LinkOptions(), vectors: DataFrame | None = None, reasons: str | None = "map") -> DataFrame:
    """(left, right, blocked_by, score, reasons) of the pairs of ``docs`` that share a blocking key, not yet ranked.

    All shared keys count, also those too common to block. blocked_by is the signal of the blocking key that came first; reasons maps signals to their shares (``reasons="columns"``: share_<signal> instead, null or 0 if it has none; None: neither). ``vectors`` (doc, v) adds
    the cosine of both documents' vectors where it is positive; such pairs are grouped by a shuffle (``pair_up``), all others are returned where they meet (``meet``). ``pos_col`` is an integer below 2^59.
    Documents, postings and keys are written tables: each input is read once, whatever the planner reuses.
    """
    names = list(signals)
    rows = materialize(docs.select(F.col(doc_col).alias("doc"), F.col(pos_col).alias("pos"), *[c.alias(f"s_{s}") for s, c in signals.items()]), "link-docs", drop_shuffles=True)
    size = rows.agg(F.count_distinct("doc").alias("n"), F.count("doc").alias("rows")).first()
    n, once = size["n"], size["n"] == size["rows"]
    posts = postings(rows, {s: F.col(f"s_{s}") for s in names}, "doc", "pos", distinct=not once)
    if not once:
        posts = posts if vectors is not None else posts.groupBy("doc", "signal", "key").agg(F.min("pos").alias("pos"))
        posts = materialize(posts, "postings")
    place = {s: i for i, s in enumerate(SIGNALS)}
    if vectors is None:
        keys = materialize(idf(posts, n).where("df > 1"), "keys", drop_shuffles=True)
        by_signal = {s: postings(rows, {s: F.col(f"s_{s}")}, "doc", "pos", distinct=False) if once else posts.where(F.col("signal") == s) for s in names}
        pairs = meet(by_signal, keys, n, options, reasons is not None, (rows,) if once else (rows, posts))
        rank = F.col("first")
    else:
        keys = materialize(idf(posts, n).withColumn("kid", F.monotonically_increasing_id()), "keys")  # written, so that a key keeps its number
        by = keys.where("df > 1").groupBy("signal", blocks(n, options).alias("blocks")).agg(F.sum(F.col("df") * (F.col("df") - 1) / 2).cast("long").alias("pairs")).collect()  # two rows a signal
        numbers = {b: sorted({place.get(r["signal"], len(SIGNALS)) for r in by if r["blocks"] == b}) for b in (True, False)}
        rows = materialize(members(posts, keys, n, numbers[False], options), "members")
        pairs = pair_up(rows, sum(r["pairs"] for r in by if r["blocks"]), numbers[True], numbers[False], vectors, options.weights.get("vector", 0.0))
        rank = F.col("place") % RANKS
    first = F.element_at(F.lit([*SIGNALS, "other"]), (rank + 1).cast("int")).alias("blocked_by")
    if vectors is None and reasons is None:
        return pairs.select("left", "right", first, "score")
    ranks = [int(c.split("_")[1]) for c in pairs.columns if c.startswith("share_")]
    name = lambda r: SIGNALS[r] if r < len(SIGNALS) else "other"
    score = sum((F.col(f"share_{r}") for r in ranks), F.lit(0.0)).alias("score")
    if reasons is None:
        return pairs.select("left", "right", first, score)
    if reasons == "columns":
        return pairs.select("left", "right", first, score, *[F.col(f"share_{r}").alias(f"share_{name(r)}") for r in ranks])
    parts = F.filter(F.array(*[F.struct(F.lit(name(r)).alias("signal"), F.col(f"share_{r}").alias("share")) for r in ranks]), lambda x: x["share"] > 0) if ranks else None
    why = F.map_from_entries(parts) if ranks else F.create_map().cast("map<string,double>")
    return pairs.select("left", "right", first, score, why.alias("reasons"))


def report(scored: DataFrame) -> DataFrame:
    """(kind, signal, pairs): how many pairs each signal proposed, and scored, by their map of reasons or by columns of shares."""
    signals = [*SIGNALS, "other"]
    scores = {s: F.element_at("reasons", s).isNotNull() if "reasons" in scored.columns else F.col(f"share_{s}") > 0 if f"share_{s}" in scored.columns else F.lit(False) for s in signals}
    counts = scored.agg(*[F.count_if(F.col("blocked_by") == s).alias(f"blocked_by {s}") for s in signals], *[F.count_if(scores[s]).alias(f"reason {s}") for s in signals])
    rows = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(s).alias("signal"), F.col(f"`{kind} {s}`").alias("pairs")) for kind in ("blocked_by", "reason") for s in signals])
    return counts.select(F.explode(rows).alias("r")).select("r.*").where("pairs > 0")


def buckets(posts: DataFrame, n_docs: int, max_ratio: float = 0.15, min_docs: int = 20) -> DataFrame:
    """(key, df, doc): an inverted index, a row a posting, without keys of extreme document frequency; keys of one document stay.

    A key's documents may be many (``max_ratio`` of all), so they are rows, not an array: no task has to hold them.
    """
    once = posts.select("key", "doc").distinct()
    sizes = once.groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    if n_docs >= min_docs:
        sizes = sizes.where(F.col("df") / F.lit(float(n_docs)) <= max_ratio)
    return once.join(sizes, "key").select("key", "df", "doc")


def carrying_all(posts: DataFrame, keys: list[str]) -> DataFrame:
    """Documents that carry every one of ``keys``."""
    hit = posts.where(F.col("key").isin(*keys)).groupBy("doc").agg(F.count_distinct("key").alias("n"))
    return hit.where(F.col("n") == len(set(keys))).select("doc")


def capped_groups(posts: DataFrame, most: int = 200) -> DataFrame:
    """(key, doc, n) of the first ``most`` documents (by pos) of each key: groups as an older judge took them, whole, in one call. The cut is its feature; ``candidates`` has none."""
    from corpusloom.operators.topk import top_per

    return top_per(posts.select("key", "doc", "pos").distinct(), ["key"], ["pos", "doc"], most, "n").select("key", "doc", "n")
