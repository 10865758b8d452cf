"""The whole life of a small invented corpus, with stub models."""

import json

from pyspark.sql import functions as F

from corpusloom.operators import catalog, models
from corpusloom.operators.state import TableStore
from corpusloom.plans import jobs
from corpusloom.sources.files import read_units

BOOK = """---[p 1]---
كتاب العلم
باب طلب العلم
1- قال زرارة العقل نور والعلم ضياء في القلوب الطاهرة
---[p 2]---
ومن طلب العلم نال الخير الكثير
2- قال محمد العقل حجة الله على العباد في الدنيا والاخرة
---[p 3]---
3- الصلاة عمود الدين وهي معراج المؤمن كل يوم وليلة
"""
REGISTRY = {"kafi": {"pipeline": "hadith", "globs": ["kafi*.txt"]}, "tarikh": {"pipeline": "history", "globs": ["t*.txt"]}}


def answer(prompt):
    if prompt.startswith("label:"):
        return json.dumps({"verdict": "alias", "target": "العلم"})
    if prompt.startswith("concept:"):
        return json.dumps({"aliases": ["المعرفة", " "]})
    if prompt.startswith("A:"):
        return json.dumps({"relation": "SUPPORTS"})
    mentions = [{"text": w, "type": "concept", "salience": 0.9, "evidence": ""} for w in ("العقل", "الصلاة", "العلم", "غائب") if w in prompt or w == "غائب"]
    return json.dumps({"mentions": mentions, "ravis": ["زرارة"] if "زرارة" in prompt else [], "proposed_nodes": ["طلب العلم"]})


def test_a_corpus_from_files_to_graph(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "kafi1.txt").write_text(BOOK, encoding="utf-8")
    (raw / "t.txt").write_text("---[a]---\n" + "وقعة " * 20 + "\n---[b]---\n" + "يوم " * 20, encoding="utf-8")
    store = TableStore(spark, f"file://{tmp_path}/store")
    assert jobs.ingest(spark, store, REGISTRY, "kafi", str(raw)).count() == 3
    jobs.ingest(spark, store, REGISTRY, "tarikh", str(raw))
    assert jobs.ingest(spark, store, REGISTRY, "kafi", str(raw)).count() == 0
    chunks = store.read("chunks").where("book_id = 'kafi'").orderBy("unit_seq").collect()
    assert [c.marker for c in chunks] == ["1-", "2-", "3-"] and chunks[0].locator == "p 1 … p 2" and chunks[0].bab == "باب طلب العلم"
    assert {r.status: r.n for r in jobs.status(store).collect()} == {"PENDING": 4}
    jobs.extract(store, models.StubBackend(answer))
    assert {r.status: r.n for r in jobs.status(store, "kafi").collect()} == {"PROCESSED_PHASE1": 3}

    forms = catalog.concept_forms(spark.createDataFrame([("العقل", "العقل", None, 0), ("العلم", "العلم", None, 1)], "id string, pref string, aliases array<string>, ord int"))
    ents = catalog.entity_forms(spark.createDataFrame([("person", "z", "زرارة", None, False, 0)], "type string, id string, pref string, aliases array<string>, ambiguous boolean, ord int"))
    summary = jobs.resolve(store, forms, ents).first()
    labels = {r.label for r in store.read("nodes").collect()}
    assert summary.documents == 3 and {"العقل", "العلم", "الصلاة"} <= labels and "غائب" not in labels

    jobs.embed(store, lambda ts: [[float(len(t)), 1.0] for t in ts])
    ranked = jobs.link(store, models.StubBackend(answer))
    assert ranked.count() >= 1 and store.read("edges").where("relation = 'SUPPORTS'").count() == ranked.count()
    assert jobs.link(store).count() == 0  # all judged
    nodes, edges = jobs.export_store(store, f"file://{tmp_path}/graph")
    kinds = {r.kind for r in edges.select("kind").distinct().collect()}
    assert {"HAS_CONCEPT", "IN_BOOK", "NARRATED_BY", "SUPPORTS"} <= kinds
    from corpusloom.operators.export import dangling

    assert dangling(edges, nodes).count() == 0 and spark.read.json(f"{tmp_path}/graph/nodes").count() == nodes.count()
    plan = jobs.proposals(store, forms, 2).collect()
    assert [(p.term, p.df, p.action) for p in plan] == [("طلب العلم", 4, "promote")]
    terms = jobs.harvest_book_headings(read_units(spark, str(raw / "kafi1.txt"))).collect()
    assert [(t.topic, t.kitab, t.is_term) for t in terms] == [("طلب العلم", "العلم", True)]
    plan = jobs.adjudicate(store, forms, models.StubBackend(answer)).collect()
    assert {(p.label, p.action, p.target) for p in plan} == {("الصلاة", "alias", "العلم"), ("غائب", "alias", "العلم")}
    assert jobs.adjudicate(store, forms, models.StubBackend(lambda p: 1 / 0)).count() == 2  # nothing is asked twice
    got = jobs.propose_aliases(store, forms, models.StubBackend(answer))
    assert {(r.concept, r.alias) for r in got.collect()} == {("العقل", "المعرفة"), ("العلم", "المعرفة")}
    jobs.verify_duplicates(store, models.StubBackend(lambda p: json.dumps({"duplicate": False})), 0.9)
    assert store.read("chunks").where("canonical_id <> id").count() == 0
    jobs.deduplicate(store, 0.9)
    assert store.read("chunks").where("canonical_id <> id").count() > 0
    jobs.reset(store, "kafi")
    assert store.read("chunks").select("book_id").distinct().count() == 1 and store.read("edges").count() == 0


def test_the_demo_and_the_command_line(spark, tmp_path, capsys):
    from corpusloom.__main__ import main
    from corpusloom.plans import demo

    store = TableStore(spark, f"file://{tmp_path}/store")
    made = demo.run(spark, store)
    assert made["chunks"] == 3 and made["nodes"] >= 3 and made["pairs"] >= 1 and made["cites"] == 1
    assert (tmp_path / "store" / "graph" / "import.cypher").exists()
    assert main(["--store", f"file://{tmp_path}/store", "status"]) == 0
    (tmp_path / "books.json").write_text(json.dumps(REGISTRY))
    assert main(["--store", f"file://{tmp_path}/s2", "list-books", "--registry", f"{tmp_path}/books.json"]) == 0
    (tmp_path / "raw" / "deep").mkdir(parents=True)
    (tmp_path / "raw" / "deep" / "kafi1.txt").write_text(BOOK, encoding="utf-8")
    registry = {"kafi": {"pipeline": "hadith", "globs": ["**/kafi*.txt"]}}
    (tmp_path / "books.json").write_text(json.dumps(registry))
    where = ["--registry", f"{tmp_path}/books.json", "--root", f"{tmp_path}/raw"]
    s2 = ["--store", f"file://{tmp_path}/s2"]
    assert main([*s2, "ingest", *where, "kafi"]) == 0 and "3 chunks new" in capsys.readouterr().out
    assert main([*s2, "harvest-ontology", *where, "--out", f"{tmp_path}/derived.yaml", "kafi"]) == 0
    assert "طلب العلم" in (tmp_path / "derived.yaml").read_text(encoding="utf-8")
    assert main([*s2, "audit-mentions"]) == 0
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"x": 1}')
    assert main([*s2, "json-to-markdown", f"{tmp_path}/j", f"{tmp_path}/all.md"]) == 0 and (tmp_path / "all.md").read_text() == '[ a.json ]\n{\n  "x": 1\n}\n'


def test_catalogs_are_parsed_promoted_and_replaced(spark, tmp_path):
    raw = ["العقل", {"id": "c1", "pref": "الصلاة", "aliases": ["صلاة", " "], "broader": "العبادة"}, {"pref": "", "id": ""}, 7, {"id": "c2", "broader": ["a", "b"]}]
    rows = catalog.parse_concepts(raw)
    assert [(r["pref"], r["aliases"], r["broader"]) for r in rows] == [("العقل", [], []), ("الصلاة", ["صلاة"], ["العبادة"]), ("c2", [], ["a", "b"])]
    (tmp_path / "base.json").write_text(json.dumps({"concepts": raw}))
    (tmp_path / "more.json").write_text(json.dumps({"concepts": ["العَقل", "الحج"]}))
    table = jobs.load_catalogs(spark, f"{tmp_path}/base.json", f"{tmp_path}/more.json", f"{tmp_path}/missing.json")
    assert [r.pref for r in table.orderBy("ord").collect()] == ["العقل", "الصلاة", "c2", "الحج"]
    plan = spark.createDataFrame([("الزكاة", "promote"), ("العقل", "promote"), ("x", "drop")], "term string, action string")
    assert [r.pref for r in catalog.apply_promotions(table, plan).orderBy("ord").collect()][-1] == "الزكاة" and catalog.apply_promotions(table, plan).count() == 5
    with_origin = table.withColumn("origin", F.lit("hand"))
    new = table.limit(1)
    once = catalog.replace_section(with_origin, new, "adjudicated")
    assert once.count() == 5 and catalog.replace_section(once, new, "adjudicated").count() == 5
    gazetteer = catalog.parse_entities({"persons": [{"id": "z", "pref": "زرارة"}, {"id": "z", "pref": "other"}], "groups": [{"pref": "الشيعة", "ambiguous": True}, "bad"]})
    assert [(e["type"], e["pref"], e["ambiguous"]) for e in gazetteer] == [("person", "زرارة", False), ("group", "الشيعة", True)]
    assert catalog.vocabulary_block(["a", "b"], ["g"], 14) == "CONCEPTS: a · "


def test_node_policy_as_one(spark):
    forms = catalog.concept_forms(spark.createDataFrame([("العقل", "العقل", None, 0), ("الصبر", "الصبر", None, 1)], "id string, pref string, aliases array<string>, ord int"))
    ents = catalog.entity_forms(catalog.entity_table(spark, [{"type": "person", "id": "z", "pref": "زرارة", "aliases": [], "ambiguous": False}]))
    raw = [("d", 0, "العَقْل", "concept", "primary"), ("d", 1, "زرارة", "person", "primary"), ("d", 2, "محض الصبر", "concept", "primary"), ("d", 3, "لا شيء", "concept", "primary"), ("d", 4, "فضيلة محمد", "person", "primary"), ("d", 5, "العقل", "concept", "secondary")]
    nodes = spark.createDataFrame(raw, "doc string, pos int, node string, type string, role string")
    docs = spark.createDataFrame([("d", ["زرارة"])], "doc string, ravis array<string>")
    got = catalog.node_policy(nodes, forms, ents, docs).orderBy("pos").collect()
    assert [(r.node, r.role, r.repaired) for r in got] == [("العقل", "primary", False), ("الصبر", "primary", True)]
    stored = spark.createDataFrame([("d", [("العَقْل", "concept", "primary")], ["زرارة"], False), ("e", [("العقل", "concept", "primary")], None, False), ("f", [("x", "concept", "primary")], None, True)], "id string, semantic_nodes array<struct<node:string,type:string,role:string>>, ravis array<string>, resolved boolean")
    assert [(r.id, [n.node for n in r.semantic_nodes]) for r in catalog.remap_payloads(stored, forms, ents).collect()] == [("d", ["العقل"])]


def test_a_vote_loses_the_book_beyond_its_seam(spark):
    heads = [("f", 0, 0, "book", "الصيام", "الصيام")] + [("f", 1 + i, 0, "chapter", "الصيام المندوب" if i < 33 else "الحج المندوب", "صيام" if i < 33 else "حج") for i in range(99)]
    df = spark.createDataFrame(heads, "file string, seq int, pos int, level string, topic string, page string")
    from corpusloom.operators import harvest

    rows = harvest.scan_headings(df, F.col("page")).groupBy("topic", "kitab").count().collect()
    assert {(r.topic, r.kitab): r["count"] for r in rows} == {("الصيام المندوب", "الصيام"): 33, ("الحج المندوب", ""): 66}


def _store(spark, tmp_path):
    (tmp_path / "raw").mkdir(exist_ok=True)
    (tmp_path / "raw" / "kafi1.txt").write_text(BOOK, encoding="utf-8")
    store = TableStore(spark, f"file://{tmp_path}/store")
    jobs.ingest(spark, store, {"kafi": REGISTRY["kafi"]}, "kafi", f"{tmp_path}/raw")
    return store


def _payload(store, marker):
    return json.loads(store.read("chunks").where(F.col("marker") == marker).first().payload)


def test_unify_fills_gaps_and_merges(spark, tmp_path):
    store = _store(spark, tmp_path)
    first = {"1-": {"mentions": [{"text": "العقل", "type": "concept", "salience": 0.4, "evidence": ""}], "ravis": ["زرارة"], "translation": "it goes on ..."}}
    whole = {"mentions": [{"text": t, "type": "concept", "salience": 0.5, "evidence": t} for t in ("الصلاة", "المؤمن")], "ravis": ["a"], "translation": "done.", "quran_refs": ["1:1"]}
    jobs.extract(store, models.StubBackend(lambda p: json.dumps(first["1-"] if "زرارة" in p else whole)))
    asked = str(tmp_path / "asked")

    def more(prompt):
        with open(asked, "a") as f:  # the stub runs in another process
            f.write("x")
        return json.dumps({"mentions": [{"text": "العقل", "type": "concept", "salience": 0.9, "evidence": "العقل نور"}, {"text": "العلم", "type": "concept", "salience": 0.6, "evidence": ""}], "ravis": [], "translation": "whole.", "quran_refs": ["2:2"], "proposed_nodes": ["x"]})

    jobs.unify(store, models.StubBackend(more))
    got = _payload(store, "1-")
    assert [(m["text"], float(m["salience"]), m["evidence"]) for m in got["mentions"]] == [("العقل", 0.9, "العقل نور"), ("العلم", 0.6, "")]
    assert got["ravis"] == ["زرارة"] and got["translation"] == "whole." and got["quran_refs"] == ["2:2"] and got["proposed_nodes"] == ["x"]
    assert _payload(store, "3-")["quran_refs"] == ["1:1"] and len(_payload(store, "3-")["mentions"]) == 2  # lacks nothing and wasn't asked about
    with open(asked) as f:
        assert len(f.read()) == 1 + (_payload(store, "2-")["quran_refs"] != ["1:1"])


def test_a_refused_or_failed_unify_leaves_the_record(spark, tmp_path):
    store = _store(spark, tmp_path)
    jobs.extract(store, models.StubBackend(answer))
    before = {r.id: r.payload for r in store.read("chunks").collect()}
    jobs.unify(store, models.StubBackend(lambda p: "no JSON"))
    assert {r.id: r.payload for r in store.read("chunks").collect()} == before


def test_aliases_are_kept_if_the_corpus_attests_them(spark, tmp_path):
    store = _store(spark, tmp_path)
    forms = catalog.concept_forms(spark.createDataFrame([("العقل", "العقل", None, 0), ("العلم", "العلم", None, 1)], "id string, pref string, aliases array<string>, ord int"))
    units = spark.createDataFrame([("k1", i, "العقل والحجة في البيت") for i in range(6)] + [("k2", i, "العلم والفهم") for i in range(6)], "source_path string, unit_seq int, text string")
    proposed = spark.createDataFrame([("العقل", 0, "الحجة"), ("العقل", 1, "الفهم"), ("العقل", 2, "العلم"), ("العقل", 3, "غائب"), ("العلم", 0, "الفهم"), ("العلم", 1, "عِلم")], "concept string, pos int, alias string")
    out = {(r.concept, r.alias): r.outcome for r in jobs.enrich_aliases(store, forms, units, proposed).collect()}
    assert out == {("العقل", "الحجة"): "kept", ("العقل", "الفهم"): "different_context", ("العقل", "العلم"): "already_a_concept", ("العقل", "غائب"): "not_in_corpus", ("العلم", "الفهم"): "kept", ("العلم", "عِلم"): "same_as_concept"}
    assert {(r.pref, r.alias) for r in store.read("derived_aliases").collect()} == {("العقل", "الحجة"), ("العلم", "الفهم")}


def test_a_model_dismisses_issues_of_an_audit(spark, tmp_path):
    store = _store(spark, tmp_path)
    jobs.extract(store, models.StubBackend(answer))
    ents = catalog.entity_forms(catalog.entity_table(spark, []))
    found = jobs.audit_mentions(store, ents, path=f"file://{tmp_path}/audit.md")
    issues = found.select("doc", F.explode("issues").alias("i")).select("doc", "i.code", "i.detail").collect()
    lost = [i for i in issues if i.code == "ungrounded_mention"]
    assert len(lost) == 3 and all(i.detail.startswith("غائب") for i in lost)

    def judge(prompt):
        if "زرارة" in prompt:
            return json.dumps({"keep": False})
        return "?" if "الصلاة" in prompt else json.dumps({"keep": True})

    kept = jobs.filter_audit(store, found, models.StubBackend(judge), f"file://{tmp_path}/review.md").collect()
    told = {r.id: r.text for r in store.read("chunks").collect()}
    assert {(k.doc, k.code) for k in kept} == {(i.doc, i.code) for i in issues if "زرارة" not in told[i.doc]}  # an unreadable answer keeps the issue
    review, dropped = (tmp_path / "review.md").read_text(encoding="utf-8"), len(issues) - len(kept)
    assert dropped >= 1 and "| ungrounded_mention | 2 | 1 |" in review and "غائب" in review and "غائب" in (tmp_path / "audit.md").read_text(encoding="utf-8")


class Stub(models.StubBackend):
    """A backend with vectors, as commands make one."""

    def __init__(self):
        super().__init__(answer)

    def embed(self, texts):
        return [[float(len(t)), 1.0] for t in texts]


def test_commands_that_ask_a_model(spark, tmp_path, capsys):
    from corpusloom.__main__ import main

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "kafi1.txt").write_text(BOOK, encoding="utf-8")
    (tmp_path / "books.json").write_text(json.dumps({"kafi": REGISTRY["kafi"]}))
    (tmp_path / "concepts.json").write_text(json.dumps({"concepts": ["العقل", "العلم"]}))
    (tmp_path / "entities.json").write_text(json.dumps({"persons": [{"id": "z", "pref": "زرارة"}]}))
    s, where = ["--store", f"file://{tmp_path}/store"], ["--registry", f"{tmp_path}/books.json", "--root", f"{tmp_path}/raw"]
    concepts, entities, backend = ["--concepts", f"{tmp_path}/concepts.json"], ["--entities", f"{tmp_path}/entities.json"], ["--backend", "tests.test_jobs:Stub"]
    assert main([*s, "run-phase1", *where, *backend, "kafi"]) == 0 and "PROCESSED_PHASE1" in capsys.readouterr().out
    assert main([*s, "resolve-nodes", *concepts, *entities]) == 0
    assert main([*s, "run-phase2", *backend]) == 0
    store = TableStore(spark, f"file://{tmp_path}/store")
    assert store.read("vectors").count() == 3 and store.read("edges").where("relation = 'SUPPORTS'").count() >= 1
    assert main([*s, "adjudicate", *concepts, *backend]) == 0 and store.read("verdicts").count() == 2
    assert main([*s, "enrich-aliases", *where, *concepts, *backend, "kafi"]) == 0 and store.read("aliases").count() == 2
    assert main([*s, "proposals", *concepts, "--threshold", "2"]) == 0 and "promote" in capsys.readouterr().out
    assert main([*s, "filter-audit", *entities, *backend, "--out", f"file://{tmp_path}/review.md"]) == 0 and (tmp_path / "review.md").exists()
    assert main([*s, "export", f"file://{tmp_path}/graph"]) == 0 and main([*s, "reset-book", "kafi"]) == 0
    assert store.read("chunks").count() == 0 and store.read("edges").count() == 0
