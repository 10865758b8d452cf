"""Operators on small fixtures of our own, against plain statements of what they promise."""

import json
import math
import os
import random
import zipfile
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.morphology import root_of_folded, signatures
from corpusloom.operators import assembly, audit, catalog, citations, harvest, linkage, models, pages, resolver, similarity, state
from corpusloom.operators.graph import connected_components
from corpusloom.sources import files
from corpusloom.streaming.records import stream_records


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr.alias("y")).first().y


# --- folds and roots


@pytest.mark.parametrize(
    "raw,want",
    [("الْعَقْلُ", "العقل"), ("أُمَّة", "امه"), ("مُؤْمِنٌ", "مومن"), ("a ب!  ج", "ب ج"), ("ـــ", ""), (None, "")],
)
def test_fold(spark, raw, want):
    assert one(spark, raw, tx.fold("x")) == want


def test_folds_differ_on_the_superscript_alef(spark):
    word = "ٱلْأَبْصَٰرِ"
    assert one(spark, word, tx.fold_citation("x")) == "الابصار"
    assert one(spark, word, tx.fold("x")) == "الابصر"


@pytest.mark.parametrize(
    "raw,want", [("أبي عبد الله (ع)", "ابو عبد الله"), ("القضاء و الأحكام", "قضاء والاحكام"), ("الحج", "حج"), ("ال", "ال"), ("محمد صلى الله عليه وآله وسلم", "محمد")]
)
def test_fold_label(spark, raw, want):
    assert one(spark, raw, tx.fold_label("x")) == want


def test_name_tokens_cut_the_genealogy(spark):
    assert one(spark, "زرارة بن أعين", tx.name_tokens("x")) == ["زراره"]
    assert one(spark, "غزوة بدر الكبرى", tx.name_tokens("x")) == ["بدر", "الكبري"]


def test_word_families_share_a_root(spark):
    for family, want in ((("العقل", "عقول", "عاقل", "معقول"), "عقل"), (("حساب", "الحساب"), "حسب")):
        assert {root_of_folded(w) for w in family} == {want}
    df = spark.createDataFrame([(1, "اجتهاد المجتهدين"), (2, "كمال العقل"), (3, "")], "id long, t string")
    got = {r.id: r for r in signatures(df, "id", "t").collect()}
    assert got[1].tautology and not got[2].tautology and 3 not in got and len(got[2].signature) == 2


def test_contains_and_threshold(spark):
    assert one(spark, "قَالَ الصَّبْرُ نِصْفُ", tx.contains_folded("x", F.lit("الصبر نصف")))
    assert not one(spark, "x", tx.contains_folded("x", F.lit("")))
    got = spark.createDataFrame([(n,) for n in (0, 100, 5000, 8333, 15000, 100000)], "n long").select(tx.compound_threshold(F.col("n")).alias("t")).collect()
    assert [r.t for r in got] == [2, 2, 2, 2, 4, 30]


# --- sources


def test_banner_files_epub_and_html(spark, tmp_path):
    (tmp_path / "a.txt").write_text("lost\n---[p 1]---\n body one \n---[p 2]---\n  \n---[p 3]---\nthree", encoding="utf-8")
    (tmp_path / "b.txt").write_text(" no banner ", encoding="utf-8")
    rows = files.read_units(spark, str(tmp_path / "a.txt"), str(tmp_path / "b.txt")).orderBy("source_path", "unit_seq").collect()
    assert [(r.locator, r.text) for r in rows] == [("p 1", "body one"), ("p 3", "three"), ("b", "no banner")]
    with zipfile.ZipFile(tmp_path / "c.epub", "w") as z:
        z.writestr("1.xhtml", "<html><script>x</script><h2>Title <b>one</b></h2><p>A &amp; B</p></html>")
        z.writestr("2.xhtml", "<p> </p>")
        z.writestr("3.xhtml", "<p>plain</p>")
    (tmp_path / "bad.epub").write_bytes(b"not a zip")
    rows = files.read_units(spark, str(tmp_path / "c.epub"), str(tmp_path / "bad.epub")).orderBy("unit_seq").collect()
    assert [(r.unit_seq, r.locator) for r in rows] == [(0, "Title one"), (2, "3.xhtml")] and rows[0].text.endswith("A & B") and "x" not in rows[0].text.split()


def test_resolve_book(spark, tmp_path):
    for n in ("b.txt", "a.txt", "c.pdf"):
        (tmp_path / n).write_text("x")
    registry = {"k": {"globs": ["b*", "*"]}, "none": {"globs": ["z*"]}}
    assert [p.rsplit("/", 1)[1] for p in files.resolve_book(spark, registry, "k", str(tmp_path))] == ["b.txt", "a.txt"]
    with pytest.raises(KeyError):
        files.resolve_book(spark, registry, "q", str(tmp_path))
    with pytest.raises(FileNotFoundError):
        files.resolve_book(spark, registry, "none", str(tmp_path))


def test_payload_shapes(spark, tmp_path):
    shapes = {
        "a": {"mentions": [{"text": "x", "type": "concept", "salience": 7}, {"text": "y", "salience": "bad"}]},
        "b": {"events": [{"mentions": [{"text": "e", "type": "event", "salience": 0.3}]}, {"characters_involved": ["p"], "historical_concepts": ["h"]}]},
        "c": {"semantic_nodes": [{"node": "n", "type": "concept", "role": "primary"}], "core_concepts": ["k"]},
    }
    (tmp_path / "sub").mkdir()
    for k, v in shapes.items():
        (tmp_path / "sub" / f"{k}.json").write_text(json.dumps(v))
    (tmp_path / "nodes.json").write_text("{}")
    (tmp_path / "broken.json").write_text("{ nope")
    (tmp_path / "list.json").write_text("[1]")
    p = files.read_payloads(spark, str(tmp_path))
    assert p.count() == 3
    rows = files.mentions_of(p).select(F.regexp_extract("doc", r"(\w)\.json$", 1).alias("d"), "pos", "text", "type", "salience").orderBy("d", "pos").collect()
    assert [tuple(r)[2:] for r in rows] == [("x", "concept", 1.0), ("y", "concept", 0.5), ("e", "event", 0.3), ("p", "person", 0.6), ("h", "concept", 0.6), ("n", "concept", 0.9), ("k", "concept", 0.6)]


# --- pages


def test_notes_end_where_the_body_resumes(spark):
    page = "1- قال\n[1] أي كذا «مِنْ شَرِّ\n\nشرح الْوَسْواسِ الْخَنَّاسِ\nالَّذِي يُوَسْوِسُ»\nوَالْعَقْلُ نُورٌ مِنَ اللَّهِ\n2 - متن [2] آخر"
    roles = [(r, n) for _, r, n in pages.line_roles(page)]
    assert roles == [("body", None), ("note", "1"), ("note", "1"), ("note", "1"), ("note", "1"), ("body", None), ("body", None)]
    body = applied(spark, page, pages.strip_notes)
    assert "[2]" not in body and "شرح" not in body


def applied(spark, value, f):
    return one(spark, value, f(F.col("x")))


def test_headings_and_topics(spark):
    page = "كتاب العقل والجهل\n\nباب صفة العلم\nو فضله\n1- حديث\nكتاب جليل و إذا فيه\n١ ـ باب وجوب الصلاة :"
    assert [tuple(h) for h in applied(spark, page, pages.headings)] == [("book", "كتاب العقل والجهل"), ("chapter", "باب صفة العلم و فضله"), ("chapter", "١ باب وجوب الصلاة :")]
    assert applied(spark, "١ ـ باب وجوب الصلاة :", pages.heading_topic) == "وجوب الصلاة"
    assert applied(spark, "كتاب الصلاة القسم الثالث", pages.heading_topic) == "الصلاة" and applied(spark, "كتاب الفرائض و", pages.heading_topic) == "الفرائض"


def test_page_parts_and_sections(spark):
    df = spark.createDataFrame([("f", 0, "pre\n1- one\n2 - two"), ("f", 1, "كتاب العلم\nباب الفقه\n1- go on"), ("f", 2, "x"), ("f", 3, "كتاب الحج\n1- x"), ("g", 0, "y")], "source_path string, unit_seq int, text string")
    parts = df.where("source_path = 'f' and unit_seq = 0").select(pages.page_parts(F.col("text")).alias("p")).first().p
    assert parts.leading == "pre" and [(s.token, s.body) for s in parts.starts] == [("1-", "1- one"), ("2 -", "2 - two")]
    got = pages.attach_sections(df).orderBy("source_path", "unit_seq").select("kitab", "bab").collect()
    assert [tuple(r) for r in got] == [("", ""), ("كتاب العلم", "باب الفقه"), ("كتاب العلم", "باب الفقه"), ("كتاب الحج", ""), ("", "")]


def naive_records(texts, kept):
    import re

    def parts(t):
        m = list(re.finditer(r"^[0-9]+\s*[-–—]", t, re.M))
        if not m:
            return t.strip(), []
        ends = [x.start() for x in m[1:]] + [len(t)]
        return t[: m[0].start()].strip(), [t[x.start() : e].strip() for x, e in zip(m, ends)]

    out, open_ = [], None
    for i, t in enumerate(texts):
        if not kept[i]:
            continue
        lead, starts = parts(t)
        if open_ is not None and lead:
            open_.append(lead)
        for s in starts:
            if open_ is not None:
                out.append("\n".join(open_))
            open_ = [s]
        nxt = texts[i + 1] if i + 1 < len(texts) else ""
        goes = bool(nxt.strip()) and (not parts(nxt)[1] or bool(parts(nxt)[0]))
        if open_ is not None and not goes:
            out.append("\n".join(open_))
            open_ = None
    if open_ is not None:
        out.append("\n".join(open_))
    return out


def random_pages(seed, n=12):
    rng = random.Random(seed)
    bits = ["lead a", "1- one", "2- two", "", "more"]
    return ["\n".join(x for x in rng.sample(bits, rng.randint(0, 3)) if x) for _ in range(n)]


def test_assembly_equals_a_plain_loop(spark):
    volumes = {f"v{s}": random_pages(s) for s in range(40)}
    rng = random.Random(1)
    kept = {v: [rng.random() > 0.2 for _ in t] for v, t in volumes.items()}
    rows = [(v, i, f"p{i}", t, kept[v][i]) for v, ts in volumes.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "source_path string, unit_seq int, locator string, text string, keep boolean")
    got = assembly.assemble_pages(df, F.col("keep")).orderBy("source_path", "session", "record_no").collect()
    for v, ts in volumes.items():
        assert [r.text for r in got if r.source_path == v] == naive_records(ts, kept[v]), v


def test_stream_of_pages_equals_the_batch(spark, tmp_path):
    volumes = {f"v{s}": random_pages(s + 100, 6) for s in range(6)}
    schema = "source_path string, unit_seq int, locator string, text string, end boolean"
    src = tmp_path / "in"
    q = (
        stream_records(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src)))
        if src.mkdir() is None
        else None
    )
    for i in range(6):
        rows = [{"source_path": v, "unit_seq": i, "locator": f"p{i}", "text": t[i], "end": i == 5} for v, t in volumes.items()]
        (src / f"{i}.json").write_text("\n".join(map(json.dumps, rows)))
        os.utime(src / f"{i}.json", (i, i))  # the source takes files by age
    run = q.writeStream.format("memory").queryName("records").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").start()
    run.processAllAvailable()
    run.stop()
    got = spark.table("records").collect()
    for v, ts in volumes.items():
        assert sorted(r.text for r in got if r.source_path == v) == sorted(naive_records(ts, [True] * 6)), v


def test_packs_merge(spark):
    df = spark.createDataFrame([("a", i, f"p{i}", "x" * n) for i, n in enumerate([5, 5, 1, 20, 1])], "k string, seq int, locator string, text string")
    packed = assembly.pack_greedy(df, ["k"], ["seq"], "text", 2, 12)
    got = assembly.merge_packs(packed, ["k"], "seq", "text", "locator").orderBy("pack_no").collect()
    assert [(r.locator, len(r.text)) for r in got] == [("p0 … p1", 12), ("p2", 1), ("p3", 20), ("p4", 1)]


# --- catalog, resolution, linkage


def concepts(spark):
    rows = [("عقل", "العقل", ["العقول"], 0), ("حساب", "الحساب", [], 1), ("صلاة", "الصلاة", None, 2)]
    return catalog.concept_forms(spark.createDataFrame(rows, "id string, pref string, aliases array<string>, ord int"))


def entities(spark):
    rows = [("person", "صادق", "الإمام الصادق", ["أبو عبد الله"], False, 0), ("person", "x", "أبو محمد", [], True, 1), ("group", "شيعة", "الشيعة", [], False, 2)]
    return catalog.entity_forms(spark.createDataFrame(rows, "type string, id string, pref string, aliases array<string>, ambiguous boolean, ord int"))


def test_resolution(spark):
    m = [(1, "d1", "العقل", "concept", 0.9), (2, "d1", "كمال العقل", "concept", 0.5), (3, "d2", "أبي عبد الله", "person", 0.4), (4, "d2", "زرارة", "person", 0.7), (5, "d3", "زرارة بن أعين", "person", 0.7), (6, "d3", "اجتهاد المجتهدين", "concept", 0.7), (7, "d3", "", "concept", 0.7), (8, "d3", "العقل", "concept", 0.2)]
    mentions = spark.createDataFrame(m, "mention_seq long, doc_id string, text string, type string, salience double")
    nodes, assigned = resolver.resolve(mentions, concepts(spark), entities(spark))
    n = {r.key: r for r in nodes.collect()}
    a = {(r.mention_seq, r.key) for r in assigned.collect()}
    assert (1, "concept:عقل") in a and (2, "concept:عقل") in a and n["concept:عقل"].df == 2 and n["concept:عقل"].curated
    assert n["person:امام الصادق"].label == "الإمام الصادق"
    assert {k for s, k in a if s in (4, 5)} == {min(k for s, k in a if s in (4, 5))}
    assert not {s for s, _ in a} & {6, 7}
    docs = {r.doc_id: [(x.key, x.weight) for x in r.nodes] for r in resolver.doc_nodes(assigned, mentions, nodes).collect()}
    assert docs["d1"][0] == ("concept:عقل", 0.9)
    s = resolver.summary(nodes, mentions).first()
    assert s.documents == 3 and s.mentions == 8


def test_orphans_and_node_resolution(spark):
    m = spark.createDataFrame([(1, "الغيبة", "concept", "p1"), (2, "الغيبة", "concept", "p2"), (3, "حساب العباد", "concept", "p1"), (4, "شخص", "person", "p1")], "mention_seq long, text string, type string, locator string")
    (o,) = resolver.orphans(m, concepts(spark)).collect()
    assert (o.label, o["count"], o.examples) == ("الغيبة", 2, ["p1", "p2"])
    rows = [("d", 0, "العقول", "concept", "primary"), ("d", 1, "حساب العباد", "concept", "secondary"), ("d", 2, "كذا وكذا", "concept", "primary"), ("d", 3, "فضل محمد", "person", "primary"), ("d", 4, "مكة", "place", "primary"), ("d", 5, "2:255", "ayah", "primary"), ("d", 6, "العقل", "person", "primary"), ("d", 7, "x", "nonsense", "primary")]
    n = catalog.resolve_nodes(spark.createDataFrame(rows, "doc string, pos int, node string, type string, role string"), concepts(spark), entities(spark))
    got = {r.pos: (r.node, r.type, r.curated, r.repaired) for r in n.collect()}
    assert got[0] == ("العقل", "concept", True, False) and got[1] == ("الحساب", "concept", False, True) and got[6][:2] == ("العقل", "concept")
    assert 2 not in got and 3 not in got and got[4][:2] == ("مكة", "place") and got[5][:2] == ("2:255", "ayah") and 7 not in got


def test_catalog_merge_and_aliases(spark):
    rows = [{"id": "a", "pref": "X"}, {"id": "a", "pref": "Y"}, {"id": "b", "pref": "x"}, {"id": "c", "pref": "Y"}, {"id": "d"}]
    assert [r["id"] for r in catalog.merge_catalogs(rows, str.lower)] == ["a", "c", "d"]
    c = spark.createDataFrame([("الحج", ["حجة"])], "pref string, aliases array<string>")
    a = spark.createDataFrame([("حج", "الحَجّ"), ("الحج", "حجة"), ("الحج", "المناسك")], "pref string, alias string")
    assert catalog.attach_aliases(c, a).first().aliases == ["حجة", "المناسك"]


def test_closure_cuts_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("d", "d"), ("x", None)], "c string, p string")
    got = {(r.child, r.ancestor): r.depth for r in catalog.closure(e).collect()}
    assert got == {("a", "b"): 1, ("a", "d"): 1, ("a", "c"): 2, ("b", "c"): 1, ("b", "a"): 2, ("b", "d"): 3, ("c", "a"): 1, ("c", "b"): 2, ("c", "d"): 2}


def test_linkage_caps_and_reasons(spark):
    docs = spark.createDataFrame([(f"d{i}", i, ["rare"] if i < 2 else [], "b" if i % 2 else "") for i in range(20)], "doc_id string, pos int, nodes array<string>, bab string")
    sig = {"node": F.col("nodes"), "bab": F.col("bab"), "kitab": F.lit("k")}
    got = {(r.left, r.right): r for r in linkage.candidates(docs, sig).collect()}
    assert len(got) == 46 and got["d0", "d1"].blocked_by == "node" and set(got["d0", "d1"].reasons) == {"node", "kitab"}
    capped = linkage.candidates(docs, sig, options=linkage.LinkOptions(min_docs=10, max_ratio=0.1)).collect()
    assert [(r.left, r.right) for r in capped] == [("d0", "d1")]


def _links(docs, n, weights):
    """Brute force over pairs: (blocked_by, score, signals)."""
    posts = {(s, k): [] for _, _, keys in docs for s, k in keys}
    for d, pos, keys in docs:
        for x in keys:
            posts[x].append((pos, d))
    rank = {s: i for i, s in enumerate(linkage.SIGNALS)}
    got = {}
    for a, _, x in docs:
        for b, _, y in docs:
            both = x & y
            block = [k for k in both if k[0] != "kitab" and 2 <= len(posts[k]) <= 12]
            if a < b and block:
                first = min(block, key=lambda k: (min(posts[k])[0], rank[k[0]]))
                got[a, b] = (first[0], sum(math.log1p(n / len(posts[k])) * weights[k[0]] for k in both), {k[0] for k in both})
    return got


@pytest.mark.parametrize("seed,tasks", [(1, None), (2, 40)])
def test_linkage_returns_each_pair_once_where_it_first_meets(spark, seed, tasks, monkeypatch):
    from corpusloom.operators import meetings

    monkeypatch.setattr(meetings, "PAIRS_A_STEP", 64)
    if tasks:
        monkeypatch.setattr(linkage, "KEYS_TO_MEET", 40)
    rng = random.Random(seed)
    docs = [(str(i), 1000 - i, {("node", f"n{rng.randrange(60)}") for _ in range(rng.choice([0, 2, 90]))} | {("ayah", f"a{rng.randrange(90)}") for _ in range(4)} | {("kitab", f"k{i % 3}")}) for i in range(150)]
    keys = lambda x, s: sorted(k for t, k in x if t == s)
    df = spark.createDataFrame([(d, p, keys(x, "node"), keys(x, "ayah"), keys(x, "kitab")[0]) for d, p, x in docs], "doc_id string, pos int, nodes array<string>, ayahs array<string>, kitab string")
    options = linkage.LinkOptions(max_members=12)
    found = linkage.candidates(df, {"node": F.col("nodes"), "ayah": F.col("ayahs"), "kitab": F.col("kitab")}, options=options)
    rows, want = found.collect(), _links(docs, 150, options.weights)
    got = {(r.left, r.right): r for r in rows}
    assert len(got) == len(rows) and set(got) == set(want)
    for k, (first, score, signals) in want.items():
        assert got[k].blocked_by == first and got[k].score == pytest.approx(score) and set(got[k].reasons) == signals


def test_linkage_shuffles_no_pairs(spark):
    docs = spark.createDataFrame([(f"d{i}", i, ["a", f"b{i // 2}"]) for i in range(30)], "doc_id string, pos int, nodes array<string>")
    for reasons in ("map", "columns", None):
        found = linkage.candidates(docs, {"node": F.col("nodes")}, reasons=reasons)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 435 and "hashpartitioning(left" not in plan and "Join" not in plan
    none = linkage.candidates(docs.where("pos < 0"), {"node": F.col("nodes")})
    assert none.collect() == []


def test_judged_pairs_leave_before_the_limit_by_table_or_column(spark):
    scored = spark.createDataFrame([("a", "b", 3.0), ("a", "c", 2.0), ("b", "c", 1.0)], "left string, right string, score double")
    table = linkage.rank(scored, limit=1, judged=scored.where("right = 'b'")).collect()
    by_column = linkage.rank(scored, limit=1, judged=F.col("right") == "b")
    assert [(r.left, r.right) for r in table] == [(r.left, r.right) for r in by_column.collect()] == [("a", "c")]
    assert "Join" not in by_column._jdf.queryExecution().executedPlan().toString()


def test_prefixes_of_copied_names_make_no_pairs(spark):
    rows = [("1", ["red", "bolt"]), ("2", ["red"]), ("3", ["red", "bolt", "big"]), ("4", ["red", "bolt", "old"]), ("5", ["red"]), ("6", ["red", "bolt"])]
    nodes = spark.createDataFrame([(k, "t", t, 50 if k in "56" else 1, False) for k, t in rows] + [("7", "u", ["red"], 1, False), ("8", "u", ["red"], 1, True), ("9", "u", [], 1, True)], "key string, type string, tokens array<string>, df int, curated boolean")
    found = resolver.prefix_merge(nodes)
    assert {r.key: r.target for r in found.collect()} == {"1": "3", "2": "3", "8": "7"}
    many = spark.range(3000).select(F.col("id").cast("string").alias("key"), F.lit("t").alias("type"), F.when(F.col("id") % 2 == 0, F.array(F.lit("red"))).otherwise(F.array(F.lit("red"), F.lit("bolt"))).alias("tokens"), F.lit(1).alias("df"), F.lit(False).alias("curated"))
    got = resolver.prefix_merge(many)
    assert got.groupBy("target").count().orderBy("count").collect() == [("1", 2999)]
    assert "slice(long" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_vectors_add_to_scores(spark):
    docs = spark.createDataFrame([("a", 0, ["k"]), ("b", 1, ["k"])], "doc_id string, pos int, nodes array<string>")
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0])], "doc string, v array<double>")
    (r,) = linkage.candidates(docs, {"node": F.col("nodes")}, vectors=v).collect()
    assert r.reasons["vector"] == pytest.approx(1.2 / 2**0.5)


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similarity_edges(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", [0.0, 1.0]), ("z", [0.0, 0.0]), ("n", None)], "id string, v array<double>")
    assert [(r.left, r.right) for r in similarity.cosine_pairs(v, "id", "v", 0.5).collect()] == [("a", "b")]
    assert [(r.left, r.right) for r in similarity.cosine_pairs(v, "id", "v", 0.5, blocks=3).collect()] == [("a", "b")]
    assert {tuple(r) for r in similarity.duplicate_clusters(v, "id", "v").collect()} == {("a", "a"), ("b", "a")}


# --- citations, harvest, audit


def verses(spark):
    rows = [(1, 1, "بسم الله الرحمن الرحيم والحمد لله"), (2, 255, "الله لا اله الا هو الحي القيوم لا تاخذه سنة"), (3, 2, "الله لا اله الا هو الحي القيوم"), ("x", 1, "bad")]
    return files.read_verses(spark.createDataFrame([tuple(map(str, r)) for r in rows], "surah_number string, ayah_number string, arabic_text string"))


def test_verse_matching(spark):
    t = spark.createDataFrame([(1, "قال اللهُ لا إلهَ إلا هو الحيُّ القيوم فقط"), (2, "كلام عادي لا يشبه شيئا من ذلك ابدا"), (3, "قصير")], "id long, text string")
    got = {r.id: r.refs for r in citations.match_verses(t, verses(spark)).collect()}
    assert got[1] == ["2:255", "3:2"] and 3 not in got


def test_note_references(spark):
    suras = spark.createDataFrame([("البقرة", 2, 286), ("الرعد", 13, 43), ("ص", 38, 88)], "name string, number int, verses int")
    notes = ["[2] البقرة: 269 و فيها", "الرعد 41.", "سورة البقرة، 3", "البقرة: 999", "قد مر ص 321", "و يأتي في ج 5 ص 87", "فهو يعلم"]
    got = citations.note_refs(spark.createDataFrame(list(enumerate(notes)), "i int, body string"), suras).orderBy("i").collect()
    assert [r.ref for r in got] == ["2:269", "13:41", "2:3", None, None, None, None]


def test_page_references(spark):
    lines = spark.createDataFrame([("p", "1-", 0, "text [2] and [1]"), ("p", "continuation", 0, "none")], "page string, segment string, pos int, text string")
    notes = spark.createDataFrame([("p", "1", "2:1"), ("p", "2", "3:1"), ("p", "9", None)], "page string, num string, ref string")
    matches = spark.createDataFrame([("p", "1-", ["3:1", "4:1"])], "page string, segment string, refs array<string>")
    (r,) = citations.page_refs(lines, notes, matches).collect()
    assert (r.segment, r.refs) == ("1-", ["3:1", "2:1", "4:1"])


def test_terms(spark):
    topics = {"الطهارة": True, "طلب العلم": True, "أن الأرض لا تخلو": False, "ترك": False, "الرجل يقتل": False, "الثاء ثابت": False, "وجوبها": False, "ab": False, "abc": False, "چهارم": False, "الطلاق عنوان الباب": False, "الحج": True, "": False}
    got = spark.createDataFrame([(t,) for t in topics], "t string").select("t", harvest.is_term(F.col("t")).alias("ok")).collect()
    assert {r.t: r.ok for r in got} == topics
    assert one(spark, "صفة فضل العلماء", harvest.strip_meta_head(F.col("x"))) == "العلماء"


def test_votes_settle_parents(spark):
    v = [("الطواف", "الحج", 9), ("الطواف", "الصلاة", 1)] + [("القبر", f"ك{i}", 1) for i in range(5)] + [("الصيام", "الحج", 3), ("مفرد", "الحج", 3), ("x", "", 4), ("سهم", "الفرائض", 3), ("سهم", "المواريث", 3), ("سهم", "الحج", 2)]
    votes = spark.createDataFrame(v, "term string, kitab string, n long")
    books = spark.createDataFrame([("الصوم",), ("الحج",)], "kitab string")
    alone = votes.where("term <> 'مفرد'").select("term").distinct()
    got = {r.term: (r.outcome, r.parent) for r in harvest.settle_parents(votes, books, alone).collect()}
    assert got["الطواف"] == ("settled", "الحج") and got["القبر"][0] == "cross_cutting" and got["الصيام"][0] == "is_a_book" and got["مفرد"][0] == "never_a_chapter" and got["x"][0] == "no_evidence"
    assert got["سهم"][0] == "settled"


def test_seams(spark):
    spans = {1: [1] * 30 + [0] * 60, 2: [1, 0] * 45, 3: [1] * 50 + [0] * 8}
    df = spark.createDataFrame([(s, i, f) for s, fs in spans.items() for i, f in enumerate(fs)], "span int, pos int, flag int")
    assert {r.span: r.cut for r in harvest.seam(df, ["span"], ["pos"], F.col("flag") == 1).collect()} == {1: 30}


def test_equal_falls_of_a_seam_go_to_the_first_cut(spark):
    """Falls that are equal as fractions and differ as doubles."""
    bits = ['01011000000101100000', '11111101101000000001', '010010110011001000010000010']
    spans = {i: [int(x) for x in b] for i, b in enumerate(bits)}
    df = spark.createDataFrame([(s, i, f) for s, fs in spans.items() for i, f in enumerate(fs)], "span int, pos int, flag int")
    floors = dict(min_span=20, min_prefix=5, min_hits=2, min_rate=0.25, max_suffix_rate=0.2, min_suffix=5, min_suffix_share=0.2)
    want = {}
    for s, f in spans.items():
        falls = {c: Fraction(sum(f[:c]), c) - Fraction(sum(f[c:]), len(f) - c) for c in range(1, len(f)) if c >= 5 and len(f) - c >= max(5, 0.2 * len(f)) and sum(f[:c]) >= 2 and sum(f[:c]) >= 0.25 * c and sum(f[c:]) <= 0.2 * (len(f) - c)}
        want[s] = min(falls, key=lambda c: (-falls[c], c))
    assert {r.span: r.cut for r in harvest.seam(df, ["span"], ["pos"], F.col("flag") == 1, **floors).collect()} == want


def test_audits(spark):
    m = spark.createDataFrame([("a", 0, "كمال العقل", 0.9), ("a", 1, "x", 0.2), ("b", 0, "كمال العقل", 0.9), ("b", 1, "العلم", 0.9)], "doc string, pos int, folded string, salience double")
    assert [r.doc for r in audit.framing_top(m).collect()] == ["a"]
    few = spark.createDataFrame([("a", 0, 10), ("b", 1, 10), ("c", 1, 60), ("d", 2, 90)], "doc string, n_mentions int, n_words int")
    assert {r.doc for r in audit.few_mentions(few).collect()} == {"a", "c"}
    c = spark.createDataFrame([("a", "طلب العلم خير من جمع المال".split(), ["طلب", "علم", "", "", "جمع", "مال"], ["مال"]), ("b", "طلب العلم خير من جمع المال".split(), ["طلب", "علم", "", "", "جمع", "مال"], ["مال", "طلب", "علم"])], "doc string, words array<string>, roots array<string>, mention_roots array<string>")
    assert [r.doc for r in audit.contrast_foil(c, (("خير", "من"),)).collect()] == ["a"]
    h = spark.createDataFrame([("a", "عالم ينتفع بعلمه".split(), [("العالم علم", 0.9)]), ("b", "عالم ينتفع بعلمه".split(), [("انتفاع العلم", 0.9), ("نفع", 0.1)])], "doc string, words array<string>, mentions array<struct<folded:string,salience:double>>")
    assert [r.doc for r in audit.predicate_hinge(h).collect()] == ["a"]
    bodies = spark.createDataFrame([("a", "عقول " * 5 + "حساب " * 6)], "doc string, body string")
    ment = spark.createDataFrame([("a", "الحساب")], "doc string, text string")
    stop = spark.createDataFrame([("قول",)], "root string")
    (r,) = audit.repeated_roots(bodies, ment, stop).collect()
    assert r.detail == "عقل x5"
    risks = audit.risk([audit.few_mentions(few), audit.few_mentions(few)]).collect()
    assert {(r.doc, r.risk) for r in risks} == {("a", 3), ("c", 3)}
    with pytest.raises(ValueError):
        audit.codes(only=("nope",))


# --- state and models


def test_state_tables(spark, tmp_path):
    store = state.TableStore(spark, f"file://{tmp_path}/s")
    assert store.read("t", "id long, v string").count() == 0
    t = store.write("t", spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    t = store.write("t", state.insert_if_absent(t, spark.createDataFrame([(2, "x"), (3, "c"), (3, "d")], "id long, v string"), ["id"]))
    assert sorted(map(tuple, t.collect())) == [(1, "a"), (2, "b"), (3, "c")]
    t = store.write("t", state.merge(t, spark.createDataFrame([(1, None), (4, "n")], "id long, v string"), ["id"]))
    assert sorted(map(tuple, t.collect())) == [(1, "a"), (2, "b"), (3, "c"), (4, "n")]
    t = state.merge(t, spark.createDataFrame([(1, None)], "id long, v string"), ["id"], overwrite=("v",))
    assert dict(map(tuple, t.collect()))[1] is None


def test_key_pool_cools_and_locks():
    now = [0.0]
    pool = models.KeyPool(["a", "b"], clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert [pool.acquire(), pool.acquire(), pool.acquire()] == ["a", "b", "a"]
    pool.fail("a", "rate")
    assert pool.acquire() == "b" and pool.acquire() == "b"
    pool.fail("b", "rate", retry_after=60)
    assert pool.acquire() == "a" and now[0] == 30
    pool.fail("a", "other")
    assert pool.acquire() == "a", "what isn't the key's fault cools nothing"
    pool.fail("a", "rate")
    pool.fail("a", "rate")
    assert pool.until["a"] == 90 and pool.strikes["a"] == 2, "a second strike while it cools doubles the pause"
    now[0] = 95
    pool.fail("a", "server")
    assert pool.until["a"] == 125 and pool.strikes["a"] == 1, "strikes lapse once it has cooled"
    kept = models.KeyPool(["a", "b"], clock=lambda: 0.0).restore(pool.rows())
    assert (kept.until, kept.reason) == (pool.until, pool.reason)
    pool.fail("a", "daily_quota")
    pool.fail("b", "invalid_key")
    assert pool.until == {"a": 8 * 3600, "b": 95 + 4 * 86_400}, "midnight in Los Angeles is eight hours after the epoch"
    with pytest.raises(models.QuotaExhausted):
        pool.acquire()
    now[0] = 8 * 3600
    assert pool.acquire() == "a"


@pytest.mark.parametrize("message, status, want", [
    ("Please retry in 12.5 s", 429, ("rate", 13.0)), ("RESOURCE_EXHAUSTED: Resource exhausted", None, ("rate", None)), ("limit: requests_per_day", 429, ("daily_quota", None)), ("GenerateRequestsPerDay exceeded, rate", None, ("daily_quota", None)),
    ("permission denied", None, ("invalid_key", None)), ("x", 403, ("invalid_key", None)), ("API key not valid", 400, ("invalid_key", None)), ("x", 404, ("server", None)), ("model is no longer available", None, ("server", None)),
    ("Service Unavailable, retry-after: 3", None, ("server", 3.5)), ("request timed out", None, ("timeout", None)), ("bad schema", None, ("other", None)),
])
def test_provider_errors(message, status, want):
    assert models.classify_error(message, status) == want


def test_pooled_backend_turns_keys_and_spaces_calls():
    now, seen = [0.0], []

    def call(key, prompt, system):
        seen.append((key, now[0]))
        if key == "a":
            raise models.ProviderError("quota: requests per day", 429)
        return prompt.upper()

    pool = models.KeyPool(["a", "b"], clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert models.PooledBackend(call, pool, spacing=20).complete(["x", "y"], "") == ["X", "Y"]
    assert seen == [("a", 0.0), ("b", 20.0), ("b", 40.0)]
    pool.fail("b", "invalid_key")
    with pytest.raises(models.QuotaExhausted):
        models.PooledBackend(call, pool).complete(["z"], "")


@pytest.mark.parametrize("html, want", [
    ("a&#1740;b&zwnj;c&mdash;d", "aیb\u200cc—d"), ("&#x6CC;&amp;lt;&apos;&quot;", "ی&lt;'\""), ("&unknown; & &#0; &#xD800; &#9999999;", "&unknown; & \ufffd \ufffd \ufffd"),
    ("<p>x&nbsp;y&nbsp;</p><script>&lt;</script>&copy;&#8217;", "x\u00a0y\n©’"), (None, None), ("", ""),
])
def test_character_references(spark, html, want):
    assert applied(spark, html, files.strip_html) == want


def test_page_locators(spark):
    loc = "جلد 1 - صفحه 30"
    cases = [(loc, "30", None, True), (loc, 30, 1, True), (loc, loc, None, True), (loc, "300", None, False), (loc, 30, 2, False), ("جلد 1 - صفحه 3", "30", None, False), ("جلد 2، صفحه 5", 2, None, False), ("صفحه 301", 30, None, False), (None, 1, None, False), (loc, "", None, False)]
    for locator, page, volume, want in cases:
        assert applied(spark, locator, lambda c: pages.page_locator_matches(c, page, volume)) is want, (locator, page, volume)  # noqa: B023


def test_model_calls(spark):
    prompts = spark.createDataFrame([(i, t) for i, t in enumerate(["good", "bad json", "late", "boom"])], "id long, prompt string")

    def answer(p):
        if p.startswith("boom"):
            raise RuntimeError("down")
        if p.startswith("bad"):
            return "{"
        return json.dumps({"v": "refused" if p == "late" else p[:4]})

    out = models.complete(prompts, models.StubBackend(answer), "v string", validate=lambda d: "no" if d["v"] == "refused" else None)
    got = {r.id: (r.answer and r.answer.v, r.error) for r in out.collect()}
    assert got[0] == ("good", None) and got[2] == ("late", None) and got[1][0] is None and "JSON" in got[1][1] and "down" in got[3][1]
    cache = spark.createDataFrame([(0,)], "id long")
    assert [r.id for r in models.complete_cached(prompts, cache, models.StubBackend(answer), "v string", limit=1).collect()] == [1]
    vecs = models.embed(prompts.select("id", F.col("prompt").alias("text")), lambda ts: [[float(len(t))] for t in ts], cache=cache)
    assert {r.id: r.vector for r in vecs.collect()} == {1: [8.0], 2: [4.0], 3: [4.0]}


def test_record_views(spark):
    from corpusloom.operators import payloads as pl

    node = "struct<key:string,label:string,type:string,weight:double,parent:string,broader:array<string>>"
    rows = [(1, [("concept:a", "a", "concept", 0.9, "concept:p", ["concept:g"]), ("concept:a", "again", "concept", 0.1, None, None), ("person:z", "z", "person", 0.5, None, None), ("", "blank", "concept", 1.0, None, None)], "كتاب العلم", "باب النوادر"),
            (2, [], "كتاب العلم", "باب الفقه")]
    df = spark.createDataFrame(rows, f"id int, nodes array<{node}>, kitab string, bab string")
    got = {r.id: r for r in df.select("id", pl.resolved_nodes(F.col("nodes")).alias("n"), pl.bucket_keys(F.col("nodes"), F.col("kitab"), F.col("bab")).alias("k")).collect()}
    assert [(n.key, n.label, n.role) for n in got[1].n] == [("concept:a", "a", "primary"), ("person:z", "z", "secondary")]
    assert got[1].k == ["concept:a", "concept:p", "concept:g"] and got[2].k == ["bab:باب الفقه"]
    t = spark.createDataFrame([("hadith", "raw", ["x", ""], None), ("hadith", "raw", [], None), ("tafsir", "raw", None, "c"), ("history", "raw", None, None)], "p string, t string, b array<string>, c string")
    e = pl.embed_text(F.col("p"), F.col("t"), F.col("b"), F.col("c"), F.lit(None), F.array(F.lit("t1"), F.lit("t2")))
    assert [r.e for r in t.select(e.alias("e")).collect()] == ["x", "raw", "c", "t1\nt2"]
    n = spark.createDataFrame([("p1", "p1", "whole.", 2, 1), ("p1", "p2", "whole.", 2, 1), ("p1", "p1", "cut ...", 2, 1), ("p1", "p1", "w", 1, 1), ("p1", "p1", "w", 2, 0)], "a string, b string, t string, n int, r int")
    assert [r.x for r in n.select(pl.needs_enrichment(F.col("a"), F.col("b"), F.col("t"), F.col("n"), F.col("r")).alias("x")).collect()] == [False, True, True, True, True]


def test_equal_vectors_are_one_node(spark):
    """50,000 rows of one vector cost one node, not their pairs."""
    df = spark.range(50_000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("v")).union(spark.createDataFrame([(60_000, [1.0, 2.001]), (60_001, [-1.0, 5.0])], "id long, v array<double>"))
    got = similarity.duplicate_clusters(df, "id", "v").groupBy("cluster").count().collect()
    assert [tuple(r) for r in got] == [(0, 50_001)]


def test_letter_windows_by_halves(spark):
    """The windows that the index has, all of them, as plain windows would find them."""
    rng = random.Random(8)
    verses = [(f"1:{k}", 1, k, "".join(rng.choice("abcd ") for _ in range(rng.randint(14, 60)))) for k in range(12)]
    texts = [(i, "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 700))) + rng.choice(verses)[3] + "".join(rng.choice("abcd") for _ in range(rng.randint(0, 30)))) for i in range(60)]
    v = spark.createDataFrame(verses, "ref string, sura int, ayah int, text string")
    t = spark.createDataFrame(texts, "id int, text string")
    for n in (6, 16):
        index = citations.gram_index(v, n, tx.fold_latin)
        plain = citations.letter_grams(t, "id", "text", n, tx.fold_latin).select("id", "gram").join(index.select("gram").distinct(), "gram", "left_semi")
        found = citations.letter_hits(t, "id", "text", index, n, tx.fold_latin).join(index.select("gram").distinct(), "gram", "left_semi")
        key = lambda df: sorted((r.id, r.gram) for r in df.select("id", "gram").collect())
        assert key(found) == key(plain) and (n == 6 or key(plain))
