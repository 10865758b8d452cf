import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from corpusloom.llm import fingerprints, simhash
from corpusloom.llm.queries import op4_exact_dedup, op6_simhash

from .conftest import LONG, ROWS, words


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute_exact(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[norm(t)].append(d)
    out = []
    for t, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        left = True
        for d in sorted(ids, key=lambda d: (d is None, d or 0)):
            out.append((d, keep, len(ids), d == keep and left, hashlib.sha256(t.encode()).hexdigest()))
            left = left and d != keep
    return sorted(out, key=str)


def test_polynomial_hash_composes():
    raw = bytes(np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8))
    for a, b in ((0, 5000), (1, 4999), (1024, 3976), (2500, 2500), (4095, 905)):
        h = fingerprints.hash_segments([raw[:a], raw[a:], raw])
        for k, (base, p) in enumerate(zip(fingerprints.BASES, fingerprints.PRIMES), 1):
            want = 0
            for x in raw:
                want = (want * base + x) % p
            assert h[f"h{k}"][2] == want
            assert (h[f"h{k}"][0] * h[f"p{k}"][1] + h[f"h{k}"][1]) % p == want


def test_exact_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(map(tuple, op4_exact_dedup(spark, sf).collect()), key=str)
    assert got == brute_exact(docs)


@pytest.mark.parametrize("primes", [fingerprints.PRIMES, (2, 1)])
def test_exact_odd_rows_and_collisions(odd, primes):
    """With primes of 2 and 1 texts of one length collide all the time: only the comparison keeps them apart."""
    got = sorted(map(tuple, fingerprints.exact_groups(odd("kept"), primes=primes).collect()), key=str)
    assert got == brute_exact([r[:2] for r in ROWS])


def test_exact_long_texts_by_segments(spark):
    a, b = LONG * 3, LONG * 3 + "!"
    rows = [(1, b), (2, a), (3, a.replace(" ", "  ")), (4, b[:-1] + "?")]
    got = fingerprints.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), primes=(2, 1))
    assert sorted(map(tuple, got.collect()), key=str) == brute_exact(rows)


def test_exact_empty_and_kept_rows(odd):
    assert fingerprints.exact_groups(odd(empty=True)).count() == 0
    kept = fingerprints.drop_exact_copies(odd("norm"))
    assert kept.columns == ["doc_id", "text", "source", "norm"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 5, 6, 7, None, 9], key=str)


def brute_simhash(text, k, bits=64):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lower)
    if not w:
        return 0
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius):
    """fps: list of (id, int)."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i][1] ^ fps[j][1]).count("1") <= radius:
            parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(fps):
        least[root(i)].append(d)
    return [(d, min((x for x in least[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(fps)]


def test_simhash_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    fps = [(d, brute_simhash(t, 4)) for d, t in docs]
    want = sorted((d, f"{f:016x}", c) for (d, f), (_, c) in zip(fps, brute_components(fps, 4)))
    assert sorted(map(tuple, op6_simhash(spark, sf).collect())) == want


def test_simhash_odd_rows(odd):
    got = simhash.near_groups(odd("component"), words=4, bits=64, radius=4, recall=None).collect()
    fps = [(r[0], brute_simhash(r[1], 4)) for r in ROWS]
    want = sorted(((d, f.to_bytes(8, "big"), c) for (d, f), (_, c) in zip(fps, brute_components(fps, 4))), key=str)
    assert sorted(((r[0], bytes(r[1]), r[2]) for r in got), key=str) == want
    assert simhash.near_groups(odd(empty=True)).count() == 0


@pytest.mark.parametrize("block", [16, 1024])
def test_links_lose_nothing(spark, block):
    """Clusters of near fingerprints, in shards larger and smaller than a block, against all pairs."""
    rng = random.Random(block)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 7)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(bytearray(f.to_bytes(8, "big")),) for f in fps], "fp binary")
    keys = simhash.exact_keys(64, 4, len(fps))
    links = [(int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big")) for r in simhash.near_links(df, 64, 4, keys, block).collect()]
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    got = defaultdict(set)
    for f in fps:
        got[root(f)].add(f)
    want = defaultdict(set)
    for f, (_, c) in zip(fps, brute_components([(f, f) for f in fps], 4)):
        want[c].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("n,parts", [(100, 5), (10**7, 6), (5 * 10**9, 7)])
def test_keys_cover_the_radius(n, parts):
    keys = simhash.exact_keys(64, 4, n)
    assert len(keys) == {5: 5, 6: 15, 7: 35}[parts]
    rng = random.Random(n)
    for _ in range(300):
        flipped = set(rng.sample(range(64), 4))
        assert any(not flipped & set(k) for k in keys)


def test_near_copies_at_five_words(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(3000)]
    docs, near = [], []
    for i in range(60):
        w = [rng.choice(vocab) for _ in range(300)]
        docs.append((2 * i, " ".join(w)))
        if i % 2:
            for p in rng.sample(range(300), 4):
                w[p] = rng.choice(vocab)
            docs.append((2 * i + 1, " ".join(w)))
            near.append(2 * i + 1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = {r.doc_id for r in simhash.drop_near_copies(df).collect()}
    assert {2 * i for i in range(60)} <= left
    assert len(left & set(near)) <= 1


def test_repeated_passages_count_once(spark):
    """A shared passage repeated many times doesn't make near copies of other bodies, nor repeats other texts of a copy."""
    rng = random.Random(5)
    make = lambda n: " ".join(rng.choice("abcdefghijkl") + str(rng.randrange(5000)) for _ in range(n))
    docs, passage = [], make(24)
    for i in range(0, 20, 2):
        docs += [(i, make(100) + f" {passage}" * 30), (i + 1, make(100) + f" {passage}" * 30)]
    for i in range(20, 40, 2):
        body, own = make(100), make(24)
        docs += [(i, f"{body} {own} {own}"), (i + 1, f"{body}" + f" {own}" * 30)]
    left = {r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert left == set(range(20)) | set(range(20, 40, 2))


def brute_similar(docs, similarity):
    """Components of five-word shingle sets by all pairs: (id, smallest id)."""

    def shingles(t):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or ({" ".join(w)} if w else set())

    sets, label = [shingles(t) for _, t in docs], list(range(len(docs)))
    for i, j in itertools.combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if (len(a & b) / len(a | b) if a or b else 1) >= similarity and label[i] != label[j]:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    ids = defaultdict(list)
    for x, (d, _) in zip(label, docs):
        ids[x].append(d)
    return [(d, min((x for x in ids[c] if x is not None), default=None)) for c, (d, _) in zip(label, docs)]


def near_pairs(seed, n, sizes, similarities):
    """Pairs of texts around the given similarities: the second has other words at its end."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        size, s = rng.choice(sizes), rng.choice(similarities)
        w = [f"w{rng.randrange(10**6)}" for _ in range(size + 4)]
        changed = max(1, int(np.ceil(size * (1 - s) / (1 + s))))
        docs += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:-changed] + [f"x{rng.randrange(10**6)}" for _ in range(changed)]))]
    return docs


def test_below_the_limit_all_stay(spark):
    """Pairs of similarity 0.6 to 0.78 are candidates by their fingerprints; none may go."""
    docs = near_pairs(3, 60, [12, 30, 100, 300], [0.6, 0.7, 0.75, 0.78])
    want = sorted(brute_similar(docs, 0.8))
    assert all(d == c for d, c in want)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((r.doc_id, r.component) for r in simhash.similar_groups(df).collect()) == want


def test_similar_odd_rows(odd):
    got = sorted(((r[0], r[2]) for r in simhash.similar_groups(odd("component")).collect()), key=str)
    assert got == sorted(brute_similar([r[:2] for r in ROWS], 0.8), key=str)
    assert simhash.similar_groups(odd(empty=True)).count() == 0


@pytest.mark.parametrize("block", [8, 1024])
def test_similar_links_in_blocks(spark, block):
    """One candidate group of chains of copies, in one block and in many, against all pairs."""
    rng = random.Random(block)
    docs = []
    for c in range(4):
        w = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for k in range(12):
            docs.append((12 * c + k, " ".join(w)))
            w[10 * k % 120 : 10 * k % 120 + 6] = [f"w{rng.randrange(10**6)}" for _ in range(6)]
    sets = [simhash.shingle_set(t) for _, t in docs]
    rows = [(b"r", len(docs), 8 * sum(map(len, sets)), d.to_bytes(4, "big"), simhash.set_simhash(s), s.tobytes()) for (d, _), s in zip(docs, sets)]
    df = spark.createDataFrame([tuple(bytearray(x) if isinstance(x, bytes) else x for x in r) for r in rows], "root binary, count long, bytes long, node binary, fp binary, shingles binary")
    links = simhash.similar_links(df, 0.8, 256, block).collect()
    label = simhash.spanning(len(docs), *(np.array([int.from_bytes(r[k], "big") for r in links]) for k in (0, 1)))
    assert list(enumerate(label.tolist())) == brute_similar(docs, 0.8)


def test_pairs_at_the_limit_are_found(spark):
    """Isolated pairs of similarity 0.8 to 0.85, short ones too: a radius of 46 bits loses a tenth of those."""
    docs = near_pairs(4, 400, [9, 18, 90, 270, 540], [0.8, 0.81, 0.82, 0.85])
    docs = [p for a, b in zip(docs[::2], docs[1::2]) if simhash.jaccard(*(simhash.shingle_set(t) for _, t in (a, b))) >= 0.8 for p in (a, b)]
    assert len(docs) > 300
    lost = sum(d % 2 and d == c for d, c in ((r.doc_id, r.component) for r in simhash.similar_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()))
    assert lost <= 1


@pytest.mark.parametrize("block", [4, 1024])
def test_links_counted_first(spark, block):
    rng = random.Random(block)
    fps = {rng.getrandbits(64) for _ in range(40)}
    fps = sorted(fps | {f ^ (1 << b) for f in list(fps)[:10] for b in rng.sample(range(64), 6)})
    df = spark.createDataFrame([(bytearray(f.to_bytes(8, "big")),) for f in fps], "fp binary")
    keys = simhash.exact_keys(64, 4, len(fps))
    at = {f: i for i, f in enumerate(fps)}
    links = [simhash.near_links(df, 64, 4, keys, block, first).collect() for first in (False, True)]
    a, b = (simhash.spanning(len(fps), *(np.array([at[int.from_bytes(r[k], "big")] for r in x]) for k in (0, 1))).tolist() for x in links)
    assert a == b and len(set(a)) == 40
