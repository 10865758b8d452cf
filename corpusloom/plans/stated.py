"""Queries over rows stated here, with what must come out stated in the SQL, and a few over whole tables: state, reports, payloads, pages, citations, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import morphology, text
from corpusloom.functions.text import fold_latin
from corpusloom.operators import assembly, audit, catalog, citations, harvest, linkage, models, pages, payloads, resolver, state
from corpusloom.plans.queries import _digest, _given, _Tables, query
from corpusloom.runtime import ship
from corpusloom.sources.files import mentions_of

# --- state -------------------------------------------------------------------------------------------------------------


@query("""select o_orderkey as id, case o_orderstatus when 'O' then 'PENDING' else 'ERROR' end as status, o_clerk from (select *, 'clerk ' || o_custkey as o_clerk from orders) where o_orderpriority = '1-URGENT' and o_orderstatus in ('O', 'P')""")
def listed_chunks(spark, sf_dir):
    """Orders as chunks, their priority as book: those of one book that wait or failed."""
    status = F.when(F.col("o_orderstatus") == "O", "PENDING").when(F.col("o_orderstatus") == "P", "ERROR").otherwise("EMBEDDED")
    o = _Tables(spark, sf_dir).orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("book_id"), status.alias("status"), F.concat(F.lit("clerk "), "o_custkey").alias("source_path"), F.col("o_orderkey").alias("unit_seq"))
    return state.list_chunks(o, book="1-URGENT", statuses=("PENDING", "ERROR")).select("id", "status", F.col("source_path").alias("o_clerk"))


@query("""select vec_id as chunk_id, 'a' as model, cast(embedding[1] as double) as first from embeddings where vec_id in (select doc_id from documents)
union all select vec_id, 'b', case when vec_id in (select doc_id from documents) then 100 else 0 end + cast(embedding[1] as double) from embeddings""")
def stored_vectors(spark, sf_dir):
    """Two models' vectors of each chunk; the second model's are replaced where a document has the chunk's id. Looked up by model, once by ids too."""
    t = _Tables(spark, sf_dir)
    first = F.col("embedding")[0].cast("double")
    of = lambda model, plus=0: t.embeddings.select(F.col("vec_id").alias("chunk_id"), F.lit(model).alias("model"), F.array(first + F.lit(plus)).alias("vector"))
    ids = t.documents.select(F.col("doc_id").alias("id"))
    new = of("b", 100).join(ids.withColumnRenamed("id", "chunk_id"), "chunk_id", "left_semi")
    table = state.upsert_embeddings(of("a").unionByName(of("b")), new)
    found = state.embeddings_of(table, "a", ids).unionByName(state.embeddings_of(table, "b"))
    return found.select("chunk_id", "model", F.col("vector")[0].alias("first"))


@query("""select * from (values ('j1', 'extract', 'done', '3 chunks', '10:00', '11:30'), ('j2', 'link', 'running', null, '12:00', null)) v(job_id, kind, status, detail, began, ended)""")
def job_log(spark, sf_dir):
    at = lambda clock: F.to_timestamp(F.lit(f"2024-05-01 {clock}:00"))
    log = _given(spark, "job_id string, kind string, started timestamp, finished timestamp, status string, detail string", [])
    log = state.start_job(state.start_job(log, "j1", "extract", at("10:00")), "j2", "link", at("12:00"))
    log = state.finish_job(log, "j1", "done", "3 chunks", at("11:30"))
    return log.select("job_id", "kind", "status", "detail", F.date_format("started", "HH:mm").alias("began"), F.date_format("finished", "HH:mm").alias("ended"))


@query("""select * from (values ('b', 'f1', 'p 5'), ('b', 'f2', 'p 1'), ('c', 'f1', 'p 2')) v(book_id, source_path, locator)""")
def reading_progress(spark, sf_dir):
    schema = "book_id string, source_path string, locator string"
    return state.set_progress(_given(spark, schema, [("b", "f1", "p 3"), ("b", "f2", "p 1")]), _given(spark, schema, [("b", "f1", "p 5"), ("c", "f1", "p 2")]))


@query("""select o_custkey as key, o_orderkey as doc, cast(row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as integer) as n from orders qualify n <= 3""")
def capped_groups(spark, sf_dir):
    o = _Tables(spark, sf_dir).orders.select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("doc"), F.col("o_orderdate").alias("pos"))
    return linkage.capped_groups(o, 3)


# --- model answers kept ------------------------------------------------------------------------------------------------


@query("""select doc_id, md5(coalesce(text, '')) as digest from documents where doc_id not in (select doc_id from labels)""")
def unasked_prompts(spark, sf_dir):
    """Documents are prompts, labelled ones are answered already: none of them is asked again."""
    t = _Tables(spark, sf_dir)
    prompts = t.documents.select("doc_id", F.coalesce("text", F.lit("")).alias("prompt"))
    return models.complete_cached(prompts, t.labels.select("doc_id"), models.StubBackend(_digest), "digest string", key="doc_id").select("doc_id", "answer.digest")


@query("""select doc_id, cast(length(coalesce(text, '')) as double) as chars from documents where doc_id not in (select doc_id from labels)""")
def unembedded_texts(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    new = models.embed(t.documents.select("doc_id", "text"), _lengths, key="doc_id", cache=t.labels.select("doc_id"))
    return new.select("doc_id", F.col("vector")[0].alias("chars"))


def _lengths(texts: list[str]) -> list[list[float]]:
    return [[float(len(t))] for t in texts]


# --- reports of proposals and harvests ---------------------------------------------------------------------------------


@query("""select c_mktsegment as source, count(distinct n_name) as terms from customer join nation on c_nationkey = n_nationkey group by 1""")
def proposals_by_source(spark, sf_dir):
    t = _Tables(spark, sf_dir)
    told = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("term"), F.col("c_mktsegment").alias("source"))
    return harvest.proposals_per_source(told, fold_latin)


@query("select o_orderpriority as verdict, count(*) as n from orders group by 1")
def verdict_tally(spark, sf_dir):
    return harvest.verdict_counts(_Tables(spark, sf_dir).orders.withColumnRenamed("o_orderpriority", "verdict"))


@query("""select * from (values ('vote', 'الهلال', 'الصيام', 2), ('vote', 'الصيام', '', 1), ('promoted', 'العدل', null, 3), ('derived', 'الهلال', 'الصيام', 3), ('derived', 'الصوم', null, 2), ('repair', 'كمال العدل', 'العدل', null)) v(step, term, other, n)""")
def harvest_steps(spark, sf_dir):
    """Votes of chapters (one named as its book abstains), nodes that become concepts, the catalog written (one spelling a term, none its own parent), proposals repaired."""
    chapters = _given(spark, "topic string, kitab string, is_term boolean", [("الهلال", "الصيام", True), ("الهلال", "الصيام", True), ("الصيام", "الصيام", True), ("كلام طويل", "الصيام", False)])
    votes = harvest.vote(chapters).select(F.lit("vote").alias("step"), "term", F.col("kitab").alias("other"), F.col("n").cast("int"))
    nodes = _given(spark, "label string, type string, curated boolean, df int", [("العدل", "concept", False, 3), ("الظلم", "concept", False, 1), ("الحق", "concept", True, 5), ("زرارة", "person", False, 9), ("الصبر", "concept", False, 4)])
    promoted = harvest.promote(nodes, _given(spark, "folded string", [("صبر",)])).select(F.lit("promoted"), "label", F.lit(None).cast("string"), "df")
    terms = _given(spark, "term string, n int, broader string", [("الهلال", 3, "الصيام"), ("هلال", 1, None), ("الصوم", 2, "صوم")])
    derived = harvest.derived_catalog(terms).select(F.lit("derived"), "pref", "broader", "n")
    plan = _given(spark, "term string, action string, anchor string", [("كمال العدل", "repair", "العدل"), ("العدل", "promote", None), ("x", "drop", None)])
    repaired = harvest.repair_map(plan).select(F.lit("repair"), "term", "anchor", F.lit(None).cast("int"))
    return votes.union(promoted).union(derived).union(repaired)


@query("""select * from (values ('ا'), ('ب')) v(pref)""")
def known_concepts(spark, sf_dir):
    """The two concepts that share most roots with what is asked about; ties by name."""
    rows = _given(spark, "pref string, roots array<string>", [("ج", ["عقل"]), ("ب", ["عقل", "نور"]), ("ا", ["نور", "عقل", "صبر"]), ("د", [])])
    return harvest.known_sample(rows, F.col("roots"), F.array(F.lit("عقل"), F.lit("نور")), 2).select("pref")


# --- payloads ----------------------------------------------------------------------------------------------------------


@query("""select * from (values ('d1', 0, 'العقل', 'concept', 0.7::double, 'ev'), ('d1', 1, 'بدر', 'event', 0.5, ''), ('d2', 0, 'زرارة', 'person', 0.6, ''), ('d2', 1, 'الصبر', 'concept', 0.6, ''),
('d3', 0, 'A', 'person', 0.9, ''), ('d3', 1, 'B', 'concept', 0.4, ''), ('d3', 2, 'C', 'concept', 0.6, ''), ('d4', 1, 'D', 'concept', 1.0, '')) v(doc, pos, text, type, salience, evidence)""")
def payload_mentions(spark, sf_dir):
    """Mentions at the top and in events; characters and concepts of an event without any; older fields of a payload without any; a salience that can't be read, and one beyond 1."""
    m = "array<struct<text:string,type:string,salience:string,evidence:string>>"
    rows = _given(spark, f"path string, mentions {m}, events array<struct<mentions:{m},characters_involved:array<string>,historical_concepts:array<string>>>, semantic_nodes array<struct<node:string,type:string,role:string>>, core_concepts array<string>", [
        ("d1", [("العقل", "concept", "0.7", "ev")], [([("بدر", "event", "x", None)], ["z"], [])], [("old", "concept", "primary")], None),
        ("d2", None, [([], ["زرارة"], ["الصبر"])], None, None),
        ("d3", None, None, [("A", "person", "primary"), ("B", None, "secondary")], ["C"]),
        ("d4", [(" ", "concept", "0.9", ""), ("D", None, "2", None)], None, None, None),
        ("d5", None, None, None, None),
    ])
    return mentions_of(rows)


@query("""select * from (values (1, 'concept:a=primary,person:z=secondary,person:y=primary', 'concept:a,concept:p,concept:q,person:y,bab:باب العلم', 'A,Z,Y', 'kitab,bab'),
(2, '', 'bab:باب العلم', 'L', 'bab'), (3, '', '', 'L', 'kitab'), (4, '', '', 'L', '')) v(n, resolved, keys, graph, sections)""")
def payload_nodes(spark, sf_dir):
    """A record's nodes (each key once, primary from 0.6 on), the keys it is compared by (secondary persons and book titles aside), its nodes in the graph, its sections (empty topics aside)."""
    node = "array<struct<key:string,label:string,type:string,weight:double,role:string,parent:string,broader:array<string>>>"
    full = [("concept:a", "A", "concept", 0.7, "", "concept:p", ["concept:q"]), ("concept:a", "A2", "concept", 0.2, "", None, None), ("person:z", "Z", "person", 0.5, "", None, None), ("person:y", "Y", "person", 0.6, "", None, None), (" ", "W", "concept", 0.9, "", None, None)]
    rows = _given(spark, f"n int, nodes {node}, kitab string, bab string", [(1, full, "كتاب العلم", "باب العلم"), (2, [], None, "باب العلم"), (3, [], "كتاب العلم", "باب النوادر"), (4, [], "", None)])
    legacy = F.array(F.struct(F.lit("person").alias("type"), F.lit("L").alias("node"), F.lit("primary").alias("role")))
    return rows.select(
        "n", F.array_join(F.transform(payloads.resolved_nodes(F.col("nodes")), lambda x: F.concat_ws("=", x["key"], x["role"])), ",").alias("resolved"),
        F.array_join(payloads.bucket_keys(F.col("nodes"), F.col("kitab"), F.col("bab")), ",").alias("keys"),
        F.array_join(F.transform(payloads.graph_nodes(F.col("nodes"), legacy), lambda x: x["node"]), ",").alias("graph"),
        F.array_join(F.transform(pages.section_nodes(F.col("kitab"), F.col("bab")), lambda x: x["type"]), ",").alias("sections"),
    )


@query("""select * from (values (1, 'hadith', 'a' || chr(10) || chr(10) || 'b', false, true), (2, 'tafsir', 'comment', true, true), (3, 'tafsir', 'summary', true, true), (4, 'history', 't1' || chr(10) || 't2', true, false), (5, 'history', 'raw', true, true), (6, 'plain', 'raw', true, true)) v(n, pipeline, body, lacking, embeddable)""")
def payload_texts(spark, sf_dir):
    """The text to embed by pipeline, with the raw text where a record gives none; what a record still lacks; older page arrays aside."""
    rows = _given(spark, "n int, pipeline string, bodies array<string>, tafsir string, summary string, titles array<string>, first string, last string, translation string, topics int, narrators int, page string, listed boolean, page_start string", [
        (1, "hadith", ["a", "", "b"], None, None, None, "p 1", "p 1", "the end.", 2, 1, None, True, None),
        (2, "tafsir", None, "comment", "summary", None, "p 1", "p 2", "the end.", 2, 1, "p 1", False, None),
        (3, "tafsir", None, "", "summary", None, "p 1", "p 1", "and so ...", 2, 1, "p 1", True, "p 1"),
        (4, "history", None, None, None, ["t1", None, "t2"], "p 1", "p 1", "the end.", 1, 1, "p 1", True, ""),
        (5, "history", None, None, None, [], "p 1", "p 1", "the end.", 2, 0, "", True, None),
        (6, "plain", ["a"], "t", "s", ["x"], "p 1", "p 1", "", 5, 5, None, False, None),
    ])
    body = payloads.embed_text(F.col("pipeline"), F.lit("raw"), F.col("bodies"), F.col("tafsir"), F.col("summary"), F.col("titles"))
    items = F.when(F.col("listed"), F.array(F.lit(1)))
    return rows.select("n", "pipeline", body.alias("body"), payloads.needs_enrichment(F.col("first"), F.col("last"), F.col("translation"), F.col("topics"), F.col("narrators")).alias("lacking"), payloads.embeddable(F.col("page"), F.col("page_start"), items).alias("embeddable"))


# --- paged text --------------------------------------------------------------------------------------------------------


@query("""select * from (values (1, 'تتمة', '1-,2-', true, false), (2, '', '1-', false, false), (3, 'نص فقط', '', true, false), (4, '', '', false, true), (5, '[1] a' || chr(10) || '[2] b' || chr(10) || 'c', '', true, true), (6, '', '', false, true)) v(n, before, starts, goes_on, notes)""")
def page_flow(spark, sf_dir):
    """What stands before a page's first numbered start, its starts, whether it goes on with the page before, whether it holds notes alone."""
    given = ["تتمة\n1- قال\n2- روى", "1- قال", "نص فقط", "  ", "[1] a\n[2] b\nc", None]
    rows = _given(spark, "n int, page string", list(enumerate(given, 1)))
    p = pages.page_parts(F.col("page"))
    return rows.select("n", p["leading"].alias("before"), F.array_join(F.transform(p["starts"], lambda s: s["token"]), ",").alias("starts"), pages.continues(F.col("page")).alias("goes_on"), pages.is_note_page(F.col("page")).alias("notes"))


@query("""select * from (values ('f', 1), ('f', 3), ('g', 0)) v(source_path, unit_seq)""")
def pages_read(spark, sf_dir):
    """Pages with narrations: not what precedes the first, not notes, not a short page without a start, nor a start without a text."""
    given = [("f", 0, "مقدمة طويلة جدا قبل بداية النص كله"), ("f", 1, "1- قال رسول الله صلى الله عليه"), ("f", 2, "قصير"), ("f", 3, "نص طويل يكمل الحديث السابق إلى آخره"), ("f", 4, "[1] a\n[2] b"), ("f", 5, " "), ("g", 0, "تتمة\n2- وعنه قال العلم نور القلوب كلها"), ("h", 0, "1- قال")]
    return pages.narration_pages(_given(spark, "source_path string, unit_seq int, text string", given)).select("source_path", "unit_seq")


@query("""select * from (values ('f', '2:255'), ('g', 'p 1'), ('g', 'p 2')) v(source_path, locator)""")
def verse_pages(spark, sf_dir):
    rows = _given(spark, "source_path string, locator string", [("f", "2:255"), ("f", "p 1"), ("g", "p 1"), ("g", "p 2")])
    return pages.prefer_verse_units(rows, F.col("locator").rlike(r"^\d+:\d+"))


@query("""select * from (values ('f', '1-', 'p 2', 'قال' || chr(10) || 'تتمة'), ('g', '2-', 'p 9', 'x'), ('h', '3-', 'p 1', 'y')) v(source_path, marker, page_end, text)""")
def closed_by_page(spark, sf_dir):
    """Open records take the leading text of their file's next page: one has some, one has no next page, one's begins with a start."""
    held = _given(spark, "source_path string, marker string, page_start string, page_end string, text string", [("f", "1-", "p 1", "p 1", "قال"), ("g", "2-", "p 9", "p 9", "x"), ("h", "3-", "p 1", "p 1", "y")])
    page = _given(spark, "source_path string, locator string, text string", [("f", "p 2", "تتمة\n2- روى"), ("h", "p 2", "4- روى")])
    return assembly.close_with_page(held, page).select("source_path", "marker", "page_end", "text")


@query("""select * from (values (1, 'الصبر', 2), (2, '', 0)) v(record_no, kept, quotes)""")
def grounded_records(spark, sf_dir):
    """Mentions that a record's whole text supports: not its narrator (known by another name), not what its text lacks, not what it quotes."""
    schema = "source_path string, session int, record_no int, hadith string, ravis array<string>, quotes array<struct<text:string,kind:string>>, mentions array<struct<text:string,type:string,salience:double,evidence:string>>"
    said = [("الصبر", "concept", 0.9, ""), ("الحج", "concept", 0.5, ""), ("زرارة", "person", 0.6, ""), ("نصف الايمان", "concept", 0.7, "")]
    rows = _given(spark, schema, [("f", 0, 1, "قال زرارة الصبر نصف الايمان", ["ابن اعين"], [("الصبر نصف الايمان", "q"), ("x", "q")], said), ("f", 0, 2, "نص", [], [], [])])
    names = _given(spark, "type string, folded string, pref string", [("person", "ابن اعين", "زرارة")])
    got = assembly.ground_records(rows, text.fold, names)
    return got.select("record_no", F.array_join(F.transform("mentions", lambda m: m["text"]), ",").alias("kept"), F.size("quotes").alias("quotes"))


@query("""select * from (values (1, 'a'), (2, null), (3, 'b'), (4, 'a'), (5, null)) v(n, body)""")
def model_items(spark, sf_dir):
    """The model's item for a piece: that of its marker, whatever blanks it has; text without a marker takes the item that goes on, else the first."""
    three = [("1 -", "a"), ("continuation", "b"), ("2-", "c")]
    rows = _given(spark, "n int, token string, items array<struct<marker:string,body:string>>", [(1, "1-", three), (2, "3-", three), (3, None, three), (4, None, three[:1]), (5, None, [])])
    return rows.select("n", assembly.item_of(F.col("items"), F.col("token"))["body"].alias("body"))


# --- citations ---------------------------------------------------------------------------------------------------------


@query("""select * from (values (1, '2:255'), (2, '2:255'), (3, null), (4, null), (5, '1:7'), (6, null), (7, null)) v(n, ref)""")
def note_citations(spark, sf_dir):
    """Notes that open with a chapter's name and a verse it has."""
    suras = _given(spark, "name string, number int, verses int", [("البقرة", 2, 286), ("الفاتحة", 1, 7), ("الحمد", 1, 7)])
    given = ["[1] البقرة: 255", "سورة البقرة 255", "البقرة 287", "كتاب 5", "الحمد ، 7", "انظر 3 البقرة 5", None]
    return citations.note_refs(_given(spark, "n int, body string", list(enumerate(given, 1))), suras).select("n", "ref")


@query("""select * from (values ('1-', '1:1,2:255,3:3'), ('3-', '4:4')) v(segment, refs)""")
def page_citations(spark, sf_dir):
    """Verses of the notes that a narration's markers name, in order, then matched ones, each once; a marker of another page's note or of one without a verse gives none."""
    lines = _given(spark, "page int, segment string, pos int, text string", [(1, "1-", 0, "قال [2] ثم [1]"), (1, "2-", 1, "x [9] [5]")])
    notes = _given(spark, "page int, num string, ref string", [(1, "1", "2:255"), (1, "2", "1:1"), (1, "9", None), (2, "5", "5:5")])
    found = _given(spark, "page int, segment string, refs array<string>", [(1, "1-", ["1:1", "3:3"]), (1, "3-", ["4:4"])])
    return citations.page_refs(lines, notes, found).select("segment", F.array_join("refs", ",").alias("refs"))


@query("""select * from (values (1, '1:1'), (2, '1:1'), (4, '1:2,1:1')) v(id, refs)""")
def verse_matches(spark, sf_dir):
    """Verses quoted by their roots in other forms, word for word, not at all, and both: what is verbatim comes first."""
    verses = _given(spark, "ref string, sura int, ayah int, text string", [("1:1", 1, 1, "العقل الحساب عاقل حساب"), ("1:2", 1, 2, "الصلاة عمود الدين وهي معراج المؤمن")])
    texts = _given(spark, "id int, text string", [(1, "معقول الحساب عقول حساب"), (2, "الْعَقْلُ الحساب عاقل حساب"), (3, "قال محمد"), (4, "معقول الحساب عقول حساب الصلاة عمود الدين وهي")])
    return citations.match_verses(texts, verses).select("id", F.array_join("refs", ",").alias("refs"))


# --- audits ------------------------------------------------------------------------------------------------------------


@query("""select * from (values (1, 'framing_only_top', 'كمال العقل', 4), (4, 'too_few_mentions', '0', 3), (5, 'too_few_mentions', '1', 3), (8, 'high_salience_not_in_text', 'نور', 2), (11, 'contrast_foil_without_elevated', 'خير من', 6),
(13, 'predicate_hinge_missing', 'نفع', 6), (15, 'repeated_root_uncovered', 'عقل x5', 2), (17, 'ungrounded_mention', 'x: evidence not in text', 5), (19, 'truncated_translation', 'translation', 4)) v(doc, code, detail, weight)""")
def audit_checks(spark, sf_dir):
    """Each check on a record that it finds and on records that it must not."""
    tops = [(1, 0, "كمال العقل", 0.9), (1, 1, "نور", 0.5), (2, 0, "كمال العقل", 0.9), (2, 1, "نور", 0.85), (3, 0, "كمال", 0.9)]
    found = audit.framing_top(_given(spark, "doc int, pos int, folded string, salience double", tops))
    found = found.union(audit.few_mentions(_given(spark, "doc int, n_mentions int, n_words int", [(4, 0, 10), (5, 1, 60), (6, 1, 59), (7, 2, 100)])))
    found = found.union(audit.salient_not_in_text(_given(spark, "doc int, text string, salience double, roots array<string>, text_roots array<string>", [(8, "نور", 0.9, ["نور"], ["عقل"]), (9, "نور", 0.89, ["نور"], ["عقل"]), (10, "عقل", 0.95, ["عقل"], ["عقل"])])))
    words, roots = ["العلم", "خير", "من", "المال", "الكثير"], ["علم", "", "", "مال", "كثر"]
    contrast = _given(spark, "doc int, words array<string>, roots array<string>, mention_roots array<string>", [(11, words, roots, ["مال"]), (12, words, roots, ["مال", "علم"])])
    found = found.union(audit.contrast_foil(contrast, (("خير", "من"),)))
    hinge = _given(spark, "doc int, words array<string>, mentions array<struct<folded:string,salience:double>>", [(13, ["علم", "لا", "نفع", "فيه"], [("علم", 0.9)]), (14, ["علم", "لا", "نفع", "فيه"], [("علم", 0.9), ("نفع", 0.3)])])
    found = found.union(audit.predicate_hinge(hinge))
    bodies = _given(spark, "doc int, body string", [(15, "العقل عاقل معقول عقول العقل"), (16, "العقل عاقل معقول عقول العقل")])
    found = found.union(audit.repeated_roots(bodies, _given(spark, "doc int, text string", [(15, "الصلاة"), (16, "عاقل")]), _given(spark, "root string", [])))
    found = found.union(audit.ungrounded(_given(spark, "doc int, text string, reason string", [(17, "x", "evidence not in text"), (18, "y", None)])))
    return found.union(audit.truncated_translations(_given(spark, "doc int, translation string", [(19, "it goes on ..."), (20, "the end.")])))


@query("""select 1 as n, 'قال العلم نور' as body, 'عن زراره قال العلم نور' as excerpt union all select 2, 'يقول نص', repeat('ا', 20) || ' يقول نص' union all select 3, repeat('x', 1801), repeat('x', 1800) || chr(10) || '…' union all select 4, '', ''""")
def audit_texts(spark, sf_dir):
    """A narration from its first "said" on; the excerpt shown to a judge begins a little earlier and is cut at 1,800 characters."""
    given = ["عن زراره قال العلم نور", "ا" * 30 + " يقول نص", "x" * 1801, ""]
    rows = _given(spark, "n int, raw string", list(enumerate(given, 1)))
    return rows.select("n", audit.body_of(F.col("raw")).alias("body"), audit.excerpt(F.col("raw"), F.col("raw")).alias("excerpt"))


# --- identities --------------------------------------------------------------------------------------------------------


def _forms(spark, *prefs: str):
    return catalog.concept_forms(_given(spark, "id string, pref string, aliases array<string>, ord int", [(p, p, None, i) for i, p in enumerate(prefs)]))


_MENTIONS = [(1, "d1", "العقل", "concept", 0.9), (2, "d1", "الْعَقْل", "concept", 0.4), (3, "d2", "زرارة", "person", 0.7), (4, "d2", "زرارة بن أعين", "person", 0.6), (5, "d3", "الصبر", "concept", 0.5), (6, "d3", "العقل", "concept", 0.2), (7, "d3", " ", "concept", 0.9)]


@query("""select * from (values ('العقل', 'concept', 2, true, 'd1=0.9,d3=0.2', 7, 3), ('زرارة', 'person', 1, true, 'd2=0.7', 7, 3), ('الصبر', 'concept', 1, true, 'd3=0.5', 7, 3)) v(label, type, df, curated, documents, all_mentions, all_nodes)""")
def resolved_corpus(spark, sf_dir):
    """Mentions with corpus-wide identities: spellings meet, a name and its genealogy are one, a document's weight is its greatest salience."""
    ship(spark)
    m = _given(spark, "mention_seq long, doc_id string, text string, type string, salience double", _MENTIONS)
    entities = catalog.entity_forms(_given(spark, "type string, id string, pref string, aliases array<string>, ambiguous boolean, ord int", [("person", "z", "زرارة", None, False, 0)]))
    nodes, assigned = resolver.resolve(m, _forms(spark, "العقل", "الصبر"), entities)
    report, total = resolver.node_report(nodes), resolver.summary(nodes, m).select(F.col("mentions").cast("int").alias("all_mentions"), F.col("nodes").cast("int").alias("all_nodes"))
    held = resolver.doc_nodes(assigned, m, nodes).select("doc_id", F.explode("nodes").alias("x")).groupBy(F.col("x.label").alias("label"))
    at = held.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "doc_id", F.col("x.weight").cast("string")))), ",").alias("documents"))
    return report.join(at, "label").join(F.broadcast(total), F.lit(True)).select("label", "type", F.col("df").cast("int").alias("df"), "curated", "documents", "all_mentions", "all_nodes")


@query("""select 'صلاه' as folded, 'الصلاة' as label, 2 as n, 'p1,p2' as examples""")
def orphan_labels(spark, sf_dir):
    """Concept mentions that name no concept: not by their words either, and not by repeating a root; persons aside."""
    given = [(1, "العقل", "concept", "p1"), (2, "الصلاة", "concept", "p2"), (3, "الصَّلاة", "concept", "p1"), (4, "كمال العقل", "concept", "p1"), (5, "اجتهاد المجتهدين", "concept", "p1"), (6, "زرارة", "person", "p1"), (7, None, "concept", "p1")]
    found = resolver.orphans(_given(spark, "mention_seq long, text string, type string, locator string", given), _forms(spark, "العقل"))
    return found.select("folded", "label", F.col("count").cast("int").alias("n"), F.array_join("examples", ",").alias("examples"))


@query("""select * from (values (1, true), (2, false), (3, false), (4, false)) v(n, shared)""")
def shared_roots(spark, sf_dir):
    rows = _given(spark, "n int, a array<string>, b array<string>", [(1, ["عقل", "نور"], ["نور"]), (2, ["عقل"], ["نور"]), (3, ["", "عقل"], [""]), (4, None, ["نور"])])
    return rows.select("n", morphology.shares_root(F.col("a"), F.col("b")).alias("shared"))


@query("""select * from (values (1, '2023-12-31 08:00'), (2, '2024-01-01 08:00'), (3, '2024-07-01 07:00'), (4, '2024-06-30 07:00'), (5, null)) v(n, day_start)""")
def pacific_days(spark, sf_dir):
    """The start of a provider's day, in UTC: winter and summer, a second before and at midnight."""
    rows = _given(spark, "n int, ts string", list(enumerate(["2024-01-01 07:59:59", "2024-01-01 08:00:00", "2024-07-01 07:00:00", "2024-07-01 06:59:59", None], 1)))
    return rows.select("n", F.date_format(text.pacific_day_start(F.to_timestamp("ts")), "yyyy-MM-dd HH:mm").alias("day_start"))
