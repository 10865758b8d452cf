import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import ann, chat, quality, urls
from corpusloom.llm.queries import RULES, op2_ann, op5_chat, op9_quality, op10_urls


def brute_chat(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        sha = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        out[c] = (len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    bad = "</s>[INST] ok [/INST]"
    want = brute_chat(rows + [(-7, 0, "user", bad), (-7, 1, "assistant", bad)])
    got = {r.conv_id: tuple(r)[1:5] for r in op5_chat(spark, sf).collect()}
    assert got == want


HOSTILE = ["<|turn|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "&lt;", "&amp;", "&", "&nl;", "\n", "<", "|>", "é", "中", ""]


def test_chat_hostile_texts_round_trip(spark):
    rng = random.Random(2)
    rows = [(i % 7 if i % 11 else None, rng.choice([0, 1, 2, None]), rng.choice(["user", "assistant", None, "a\nb<|end|>"]), "".join(rng.choices(HOSTILE, k=rng.randint(0, 9))) or None) for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = chat.format_chat(df).select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    want = brute_chat(rows)
    for r in out.collect():
        # ties of (turn, role) are ordered by the escaped text
        assert r.formatted.count("<|turn|>") == r.formatted.count("<|end|>") == len(r.turns) == want[r.conv_id][0]
        assert not re.search(r"</?s>|\[/?INST\]", r.formatted)
        assert sorted((t.role, t.text) for t in r.turns) == sorted((x[2] or "", x[3] or "") for x in rows if x[0] == r.conv_id)
        assert r.loss == "".join(t.text for t in r.turns if t.role == "assistant")


def test_chat_typed_parts(spark):
    part = chat.PART
    rows = [
        (1, 0, "user", [("text", "look <|image|>", None, None, None, None, None), ("IMAGE", None, "i.png", 28, 15, None, None), None, ("audio", None, "a.wav", None, None, 2.0, None)]),
        (1, 1, "assistant", [("text", "ok", None, None, None, None, None), ("document", None, "d.pdf", None, None, None, 3), ("video!", None, None, None, None, None, None)]),
        (2, 0, "user", None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    one, two = chat.format_chat(df, parts_col="parts").orderBy("conv_id").collect()
    assert one.formatted == "<|turn|>user\nlook &lt;|image|><|image|><|audio|><|end|><|turn|>assistant\nok<|document|><|video_|><|end|>"
    assert [(a.turn_no, a.part_no, a.type, a.ref, a.tokens) for a in one.attachments] == [(0, 1, "image", "i.png", 4), (0, 3, "audio", "a.wav", 25), (1, 1, "document", "d.pdf", 768), (1, 2, "video!", None, 1)]
    assert one.attachment_tokens == 798 and two.formatted == "<|turn|>user\n<|end|>" and two.attachments == []
    assert chat.format_chat(df.limit(0), parts_col="parts").count() == 0


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"(/[^?#]*)?", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.verdict if best else "allow"


ODD_URLS = [None, "", "no scheme", "://", "http://ORG/x", "http://org", "http://org/", "http://a.b.org/q?x#y", "http://evilorg/", "http://x.org.evil/", "http://e.com/x.org/", "http://example.org/es/1", "http://example.org/es", "http://notexample.org/es/", "http://example.org/en/1", "http://example.org/en/12", "http://a.example.org/en/2", "http://x.com/fr/", "http://x.com/fr", "HTTP://X.com/de/?q", "http://x.com?/fr/", "http://x.com#/fr/", "http://ü.com/de/ü\n/z", "a://b://c.org/x", "http://.org/", "http://org./x", "http://" + "a." * 500 + "org/" + "y" * 5000, "\0http://\0.org/"]


def test_urls_against_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(ODD_URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("clash"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, RULES).collect()}
    assert got == {i: brute_url(u) for i, u in rows}
    assert urls.judge_urls(df.limit(0), RULES).count() == 0
    assert {r.verdict for r in urls.judge_urls(df, [], default="block").collect()} == {"block"}


def test_url_query(spark, sf):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in op10_urls(spark, sf).collect()}
    assert got == {i: brute_url(u) for i, u in pages.items()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab*?.", min_size=1, max_size=6), st.text("xy*?/", max_size=6)), min_size=1, max_size=40), st.lists(st.tuples(st.text("ab.", max_size=8), st.text("xy/", max_size=8)), min_size=1, max_size=8))
def test_globs_of_many_words_of_bits(rules, pairs):
    rules = [urls.Rule(h, "/" + p, "block") for h, p in rules]
    fits = urls.ShiftAnd(rules).matches([f"\0.{h}/{p}".encode() for h, p in pairs])

    def to_regex(glob, any_one):
        return "".join({"*": any_one + "*", "?": any_one}.get(c, re.escape(c)) for c in glob)

    for i, (h, p) in enumerate(pairs):
        for j, r in enumerate(rules):
            want = re.match(rf"(?s)(.*\.)?{to_regex(r.host, '[^/]')}\Z", h) and re.match("(?s)" + to_regex(r.path, "."), "/" + p)
            assert fits[i, j] == bool(want), (h, p, r)


def test_quality_query_holds_out_and_tells_apart(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op9_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) > 0.93
    assert np.mean([p for p, y in held if y == 1]) > 0.95


def test_quality_odd_rows(odd):
    good, bad = ["the cat sat on the mat " * 5] * 30, ["BUY!! NOW!! $$$ " * 6] * 30
    model = quality.train(good, bad)
    rows = quality.score_quality(odd("score"), model).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if not r.text}
    assert len(empty) == 1
    for g, b in ((good, []), ([], bad), ([], []), (good[:1], bad[:1])):
        s = quality.train(g, b).scores(["x", None])
        assert ((0 <= s) & (s <= 1)).all()


def brute_nearest(vecs, queries, top=10):
    out = {}
    for q in queries:
        d = sorted((float(np.sqrt(((vecs[q] - v) ** 2).sum())), i) for i, v in vecs.items() if i != q)
        out[q] = d[:top]
    return out


def test_ann_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = op2_ann(spark, "/root/testdata/sf0.1").collect()
    vecs = {r.vec_id: np.array(r.embedding, np.float64) for r in df.collect()}
    want = brute_nearest(vecs, [i for i in vecs if i % 100 == 0])
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r)
        assert r.score == pytest.approx(float(np.sqrt(((vecs[r.query_id] - vecs[r.vec_id]) ** 2).sum())), abs=1e-12)
    assert set(got) == set(want)
    hits = 0
    for q, rs in got.items():
        assert [r.rank for r in rs] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in rs] == sorted((r.score, r.vec_id) for r in rs)
        hits += len({r.vec_id for r in rs} & {i for _, i in want[q]})
    assert hits / (10 * len(want)) >= 0.9


def test_ann_odd_vectors_and_copies(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(30, 4)).round(2).tolist()
    rows = [(i, v[i % 30]) for i in range(90)] + [(i, v[0]) for i in range(200, 260)]
    rows += [(0, v[0]), (100, None), (300, [0.0] * 4), (400, [1.0, float("nan"), 0.0, 0.0]), (500, [1.0, None, 0.0, 0.0]), (700, [float("inf"), 0.0, 0.0, 0.0]), (800, []), (None, v[3])]
    two = {i: rng.normal(size=2).round(1).tolist() for i in range(900, 930)}
    one = {i: [float(i)] for i in (1000, 1001, 1002)}
    rows += [*two.items(), *one.items(), (1100, [1.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))
    kinds = [{i: np.array(x) for i, x in rows[:150]}, {i: np.array(x) for i, x in two.items()}, {i: np.array(x) for i, x in one.items()}]
    want = brute_nearest(kinds[0], [0, 200]) | brute_nearest(kinds[1], [900]) | brute_nearest(kinds[2], [1000])
    for lengths in (1, 2, 16):  # the other lengths are searched whole
        got = defaultdict(list)
        for r in ann.search(df, F.col("vec_id") % 100 == 0, recall=1.0, indexed_lengths=lengths).collect():
            got[r.query_id].append((r.rank, r.vec_id, r.score))
        assert set(got) == set(want), "of one length alone 1100 has no neighbour"
        for q, rs in got.items():
            assert [(pytest.approx(s, abs=1e-12), i) for _, i, s in sorted(rs)] == want[q]
    assert ann.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(TypeError):
        ann.search(df.withColumn("vec_id", F.col("vec_id").cast("string")), F.lit(True))


def test_ann_divides_long_lists(spark):
    """Few lists allowed: they are divided again, recall holds and every query has its ten."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(40, 8)) * 3
    x = centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = ann.search(df, F.col("vec_id") % 100 == 0, least_lists=1, most_lists=4, rows_a_list=50, split_rows=300).collect()
    got = defaultdict(dict)
    for r in rows:
        got[r.query_id][r.rank] = r.vec_id
    want = brute_nearest(dict(enumerate(x)), range(0, 6000, 100))
    assert set(got) == set(want) and all(sorted(g) == list(range(1, 11)) for g in got.values())
    assert sum(len(set(got[q].values()) & {i for _, i in want[q]}) for q in want) / 600 >= 0.85


def test_ann_always_finds_enough(spark):
    """Ten tight clusters of 12 and a query far from all: lists beyond the ratio are opened until there are ten candidates."""
    rng = np.random.default_rng(9)
    rows = [(1000 * c + i, (np.eye(12)[c] * 50 + rng.normal(size=12) * 1e-3).tolist()) for c in range(10) for i in range(1, 13)]
    rows.append((0, [-30.0] * 12))
    rows += [(100_000 + i, (np.eye(12)[11] * 70).tolist()) for i in (0, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.search(df, F.col("vec_id").isin(0, 100_000), least_lists=64, recall=0.5, copies=1).collect():
        got[r.query_id].append(r.vec_id)
    assert len(got[0]) == len(got[100_000]) == 10 and 100_001 in got[100_000]


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(1)
    c, x = rng.normal(size=(128, 16)), rng.normal(size=(200, 16))
    near, dist = ann.CentroidGraph(c).search(x, 24)
    full = np.sqrt(((x[:, None] - c[None]) ** 2).sum(2))
    best = np.argsort(full, 1)[:, :4]
    assert np.mean([len(set(a[:4]) & set(b)) / 4 for a, b in zip(near, best)]) > 0.95
    assert np.allclose(np.take_along_axis(full, near, 1), dist)
