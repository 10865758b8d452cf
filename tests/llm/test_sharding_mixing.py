import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import mixing, sharding
from corpusloom.llm.queries import op1_sharding, op7_mixing

from .conftest import ROWS, words


def placed(rows, shards):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 20])
def test_odd_rows_each_get_a_slot(odd, bucket_bytes):
    out = sharding.shard_documents(odd("shard"), shards=3, bucket_bytes=bucket_bytes)
    assert out.columns == ["doc_id", "text", "source", "shard", "slot"]
    rows = out.collect()
    placed(rows, 3)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in ROWS)


@pytest.mark.parametrize("broadcast", [0, 4_000_000])
def test_partitions_of_several_buckets(spark, monkeypatch, broadcast):
    monkeypatch.setattr(sharding, "BROADCAST_BUCKETS", broadcast)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    runs = [sharding.shard_documents(df.repartition(n), 7, bucket_bytes=2000, most_partitions=3).collect() for n in (2, 5)]
    for rows in runs:
        placed(rows, 7)
        assert {r.doc_id for r in rows} == set(range(3000))
    assert sorted(runs[0]) == sorted(runs[1])
    plan = sharding.shard_documents(df, 7, bucket_bytes=2000, most_partitions=3)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan, "a bucket's array at a time"


def test_hot_repeated_rows_fill_many_buckets(spark):
    rows = [(None, None, {"k": 1})] * 700 + [(5, "x" * 30, None)] * 400 + [(i, "y" * 30, {"k": i}) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>").repartition(4)
    plan = sharding.shard_documents(df, 4, bucket_bytes=1500)
    out = plan.collect()
    placed(out, 4)
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    assert min(Counter(r.shard for r in out if r.doc_id is None).values()) > 100, "copies are spread"
    again = {(r.shard, r.slot): r.doc_id for r in sharding.shard_documents(df.repartition(3), 4, bucket_bytes=1500).collect()}
    assert again == {(r.shard, r.slot): r.doc_id for r in out}


def test_fewer_rows_than_shards_and_none(odd):
    assert sharding.shard_documents(odd(empty=True)).count() == 0
    rows = sharding.shard_documents(odd(), shards=40).collect()
    assert len(rows) == len(ROWS) and {r.slot for r in rows} == {0}


def test_order_is_random_but_repeats(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    runs = [{r.doc_id: (r.shard, r.slot) for r in sharding.shard_documents(df, 4, bucket_bytes=4000).collect()} for _ in range(2)]
    assert runs[0] == runs[1]
    order = sorted(runs[0], key=runs[0].get)
    rises = sum(a < b for a, b in zip(order, order[1:]))
    assert 900 < rises < 1100
    # near rows of the input don't stay together
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 20


def test_query(spark, sf):
    rows = op1_sharding(spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    placed(rows, 40)
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw) and r.law == "rows" and r.grown_shard is None


SEED = 11


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, budget = {}, set(order), share * sum(sizes.values())
    while True:
        left = budget - sum(target.values())
        level = left / sum(w[s] for s in free) if free else 0
        above = {s for s in free if level * w[s] > most * sizes[s]}
        if not above:
            return target | {s: level * w[s] for s in free}
        for s in above:
            target[s] = most * sizes[s]
        free -= above


@pytest.mark.parametrize("rows_per_bin", [7, 50_000])
def test_mix_meets_targets(spark, sf, rows_per_bin):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.when(F.col("source") != "src3", F.col("source")).alias("source"))
    rows = mixing.mix_sources(docs, rows_per_bin=rows_per_bin).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    sizes = defaultdict(int)
    for r in texts.values():
        sizes[r.source] += len(words(r.text))
    want = brute_targets(dict(sizes))
    taken = defaultdict(int)
    for r in rows:
        assert r.size == len(words(texts[r.doc_id].text)) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert taken[s] == round(want[s]), s
    again = mixing.mix_sources(docs.repartition(5), rows_per_bin=rows_per_bin).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_mix_odd_rows(odd):
    assert mixing.mix_sources(odd(empty=True)).count() == 0
    rows = mixing.mix_sources(odd("size")).collect()
    assert len(rows) == len(ROWS)
    assert all(r.taken == 0 for r in rows if not r.size)
    whole = mixing.repeat_documents(odd("copies"))
    assert whole.columns == ["doc_id", "text", "source", "copies"]
    copies = Counter((r.doc_id, r.text) for r in whole.collect())
    assert all(words(t) for _, t in copies) and copies[(6, ROWS[5][1])] in (1, 2)


def test_repeated_rows_share_their_copies(spark):
    """Three equal rows, two that differ in another column, one other; the target of 24 words allows no more than it says."""
    rows = [(1, "a b c d", "s", 1)] * 3 + [(2, "e f g h", "s", 1), (2, "e f g h", "s", 2)] + [(3, "i j k l", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").repartition(3)
    for share in (0.0, 0.4, 1.0, 1.5, 1.9, 2.0):
        taken = mixing.mix_sources(df, share=share, cut="document").collect()
        want = Counter()
        for r in taken:
            want[r.doc_id] += r.copies
        got = Counter(r.doc_id for r in mixing.repeat_documents(df, share=share).collect())
        assert got == +want
        assert 4 * sum(got.values()) == pytest.approx(24 * share, abs=2)


@pytest.mark.parametrize("rows_per_bin", [3, 10])
def test_ranges_of_bins(spark, rows_per_bin):
    """More bins than a range holds: places are those of one running sum."""
    df = spark.createDataFrame([(i, "w " * (i % 7 + 1), "ab"[i % 3 == 0]) for i in range(900)], "doc_id long, text string, source string")
    key = lambda rows: sorted((r.doc_id, r.taken) for r in rows)
    assert key(mixing.mix_sources(df, rows_per_bin=rows_per_bin).collect()) == key(mixing.mix_sources(df, rows_per_bin=100_000).collect())


def test_op7(spark, sf):
    assert op7_mixing(spark, sf).columns == ["doc_id", "size", "source_size", "target", "taken"]


@pytest.mark.parametrize("rows_per_bin", [20, 100_000])
def test_documents_are_taken_in_key_order(spark, rows_per_bin):
    """However many bins the table's rows ask for, a partial epoch takes the rows of smallest key."""
    df = spark.createDataFrame([(i, f"w{i} x y z", "a") for i in range(400)], "doc_id long, text string, source string")
    keys = {r[0]: r[1] for r in df.select("doc_id", F.xxhash64(F.lit(SEED), "doc_id", "text")).collect()}
    rows = mixing.mix_sources(df, share=0.5, seed=SEED, rows_per_bin=rows_per_bin).collect()
    took = [r.taken for r in sorted(rows, key=lambda r: keys[r.doc_id])]
    assert sum(took) == round(rows[0].target) and took == sorted(took, reverse=True)
