"""The engine's jobs over stored tables: ingest, extract, resolve, embed, link, export, harvest, proposals, status, reset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.keys import chunk_id, pair_id
from corpusloom.functions.text import fold, fold_label, match_key, should_skip, translation_incomplete
from corpusloom.operators import assembly, audit, catalog, citations, export, harvest, linkage, models, pages, resolver, similarity, state
from corpusloom.operators.payloads import PRIMARY_WEIGHT, embed_text, needs_enrichment
from corpusloom.operators.state import TableStore
from corpusloom.runtime import materialize, write_text
from corpusloom.sources.files import mentions_of, read_document, read_units, resolve_book, salience

CHUNKS = (
    "id string, book_id string, pipeline string, source_path string, unit_seq int, locator string, marker string, text string, kitab string, bab string,"
    " status string, payload string, error string, attempts int, canonical_id string, anchor string"
)
PAYLOAD = "mentions array<struct<text:string,type:string,salience:string,evidence:string>>, quotes array<string>, ravis array<string>, quran_refs array<string>, proposed_nodes array<string>, translation string"
EDGES = "pair_id string, left_id string, right_id string, relation string, score double"
VECTORS = "id string, vector array<double>"
DOC_NODES = "id string, key string, label string, type string, weight double, parent string"
VERSE_LOCATOR = r"^\d{1,3}:\d{1,3}"


def prepare(units: DataFrame, pipeline: str, pages_per_call: int = 4, max_chars: int = 6000) -> DataFrame:
    """Units of a book as work items (source_path, unit_seq, locator, marker, text, kitab, bab, anchor), by the book's pipeline.

    hadith: narrations assembled over pages; tafsir: verse units; history: consecutive pages packed; others: units as they are.
    """
    none = F.lit(None).cast("string")
    if pipeline == "hadith":
        kept = pages.narration_pages(units)
        recs = assembly.assemble_pages(kept)
        at = kept.select("source_path", F.col("locator").alias("page_start"), "unit_seq", "kitab", "bab")
        recs = recs.join(at, ["source_path", "page_start"])
        order = F.row_number().over(_by("source_path", "unit_seq", "session", "record_no"))
        return recs.select("source_path", order.alias("unit_seq"), F.when(F.col("page_start") == F.col("page_end"), F.col("page_start")).otherwise(F.concat_ws(" … ", "page_start", "page_end")).alias("locator"), "marker", "text", "kitab", "bab", none.alias("anchor"))
    if pipeline == "tafsir":
        units = pages.prefer_verse_units(units, F.col("locator").rlike(VERSE_LOCATOR))
        anchor = F.regexp_extract("locator", VERSE_LOCATOR, 0)
        return units.select("source_path", "unit_seq", "locator", none.alias("marker"), "text", none.alias("kitab"), none.alias("bab"), F.nullif(anchor, F.lit("")).alias("anchor"))
    if pipeline == "history":
        packed = assembly.pack_greedy(units, ["source_path"], ["unit_seq"], "text", pages_per_call, max_chars)
        m = assembly.merge_packs(packed, ["source_path"], "unit_seq", "text", "locator")
        return m.select("source_path", F.col("pack_no").alias("unit_seq"), "locator", none.alias("marker"), "text", none.alias("kitab"), none.alias("bab"), none.alias("anchor"))
    return units.select("source_path", "unit_seq", "locator", none.alias("marker"), "text", none.alias("kitab"), none.alias("bab"), none.alias("anchor"))


def _by(part: str, *order: str):
    from pyspark.sql.window import Window

    return Window.partitionBy(part).orderBy(*order)


def ingest(spark: SparkSession, store: TableStore, registry: dict[str, dict], book_id: str, root: str, limit: int | None = None, page: str | None = None, volume: str | None = None) -> DataFrame:
    """Add a book's work items that aren't stored yet; short and contents pages are marked SKIPPED. ``page`` (and ``volume``) take the items of one printed page alone. Returns the new rows."""
    files = resolve_book(spark, registry, book_id, root)
    return ingest_units(store, read_units(spark, *files), book_id, registry[book_id].get("pipeline", "plain"), limit, page, volume)


def ingest_units(store: TableStore, units: DataFrame, book_id: str, pipeline: str, limit: int | None = None, page: str | None = None, volume: str | None = None) -> DataFrame:
    """As ``ingest``, of units that are read already. New rows are appended: no stored book is written again."""
    items = prepare(units, pipeline)
    if page:
        items = items.where(pages.page_locator_matches(F.col("locator"), page, volume))
    if limit:
        items = items.orderBy("source_path", "unit_seq").limit(limit)
    marked = F.when(F.col("marker").isNotNull(), F.concat_ws("|", "marker", "locator")).otherwise(F.col("locator"))
    rows = items.select(
        chunk_id(F.lit(book_id), marked, F.col("text")).alias("id"), F.lit(book_id).alias("book_id"), F.lit(pipeline).alias("pipeline"), "source_path", F.col("unit_seq").cast("int"), "locator", "marker", "text", "kitab", "bab",
        F.when(should_skip(F.col("text")), "SKIPPED").otherwise("PENDING").alias("status"), F.lit(None).cast("string").alias("payload"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("canonical_id"), "anchor",
    )
    old = store.read("chunks", CHUNKS)
    fresh = materialize(state.insert_if_absent(old.limit(0), rows.join(old.select("id"), "id", "left_anti").select(*old.columns), ["id"], ["source_path", "unit_seq"]), "fresh")
    store.append("chunks", fresh)
    return fresh


def _answers(asked: DataFrame) -> DataFrame:
    """What a model said, written before it is used: neither a second use nor a lost shuffle asks again."""
    return materialize(asked, "answers")


def extract(store: TableStore, backend: models.ModelBackend, prompt: Callable[[str], str] = lambda t: t, limit: int | None = None) -> DataFrame:
    """Ask the model for the payload of pending chunks and store answers and errors; what has an answer is never asked again."""
    chunks = store.read("chunks", CHUNKS)
    todo = chunks.where(F.col("status").isin("PENDING", "ERROR")).orderBy("source_path", "unit_seq")
    todo = todo.limit(limit) if limit else todo
    head = prompt("\0").split("\0")
    asked = todo.select("id", F.concat(F.lit(head[0]), "text", F.lit(head[-1])).alias("prompt"))
    got = _answers(models.complete(asked, backend, PAYLOAD, key="id"))
    done = got.select("id", F.to_json("answer").alias("payload"), "error", F.when(F.col("error").isNull(), "PROCESSED_PHASE1").otherwise("ERROR").alias("status"))
    done = done.join(chunks.select("id", (F.col("attempts") + 1).alias("attempts")), "id")
    return store.write("chunks", state.merge(chunks, done, ["id"], overwrite=("error",)))


def _payloads(chunks: DataFrame) -> DataFrame:
    return chunks.where("payload is not null").select("*", F.from_json("payload", PAYLOAD).alias("p"))


def _mentions(chunks: DataFrame) -> DataFrame:
    p = _payloads(chunks).select("id", "p.mentions", F.lit(None).cast("array<struct<mentions:array<struct<text:string,type:string,salience:string,evidence:string>>,characters_involved:array<string>,historical_concepts:array<string>>>").alias("events"),
                                 F.lit(None).cast("array<struct<node:string,type:string,role:string>>").alias("semantic_nodes"), F.lit(None).cast("array<string>").alias("core_concepts"))
    return mentions_of(p, "id")


def judged_mentions(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """Mentions of stored payloads with the reason why their own text doesn't support them (null: it does); narrators are no mentions."""
    m = _mentions(chunks).join(_payloads(chunks).select(F.col("id").alias("doc"), F.col("text").alias("body"), "p.quotes", "p.ravis"), "doc")
    told = catalog.narrator_identities(_payloads(chunks).select(F.col("id").alias("doc"), F.coalesce("p.ravis", F.array().cast("array<string>")).alias("ravis")), entities)
    own = m.select("doc", "pos", fold_label("text").alias("folded"))
    known = own.join(entities, "folded").select("doc", "pos", fold_label("pref").alias("folded"))
    narr = own.union(known).join(told, ["doc", "folded"], "left_semi").select("doc", "pos").distinct().withColumn("is_narrator", F.lit(True))
    return resolver.ground(m.join(narr, ["doc", "pos"], "left"), fold)


def grounded_mentions(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """Mentions of stored payloads that their own text supports and that aren't its narrators."""
    return judged_mentions(chunks, entities).where("reason is null").drop("reason")


def resolve(store: TableStore, concepts: DataFrame, entities: DataFrame) -> DataFrame:
    """Corpus-wide identity of all stored mentions: tables nodes and doc_nodes. Returns a one-row summary."""
    m = grounded_mentions(store.read("chunks", CHUNKS), entities)
    m = m.select(F.xxhash64("doc", "pos").alias("mention_seq"), F.col("doc").alias("doc_id"), "text", "type", "salience")
    nodes, assigned = resolver.resolve(m, concepts, entities)
    nodes = store.write("nodes", nodes)
    docs = resolver.doc_nodes(assigned, m, nodes)
    store.write("doc_nodes", docs.select(F.col("doc_id").alias("id"), F.explode("nodes").alias("n")).select("id", "n.*"))
    return resolver.summary(nodes, m)


def embed(store: TableStore, embedder: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """Vectors of the chunks that have none."""
    chunks, old = store.read("chunks", CHUNKS), store.read("vectors", VECTORS)
    none = F.lit(None).cast("string")
    body = embed_text(F.col("pipeline"), F.col("text"), F.lit(None).cast("array<string>"), none, none, F.lit(None).cast("array<string>"))
    new = materialize(models.embed(chunks.where("status <> 'SKIPPED'").select("id", body.alias("text")), embedder, cache=old), "vectors")
    done = new.select("id", F.lit("EMBEDDED").alias("status")).join(chunks.where("status = 'PROCESSED_PHASE1'").select("id"), "id", "left_semi")
    vectors = store.append("vectors", new)
    store.write("chunks", state.merge(chunks, done, ["id"]))
    return vectors


def deduplicate(store: TableStore, cut: float = 0.92) -> DataFrame:
    """Canonical ids of chunks whose vectors are nearly equal: the longest text of a cluster stands for the others."""
    chunks = store.read("chunks", CHUNKS)
    clusters = similarity.duplicate_clusters(store.read("vectors", VECTORS), "id", "vector", cut)
    found = similarity.canonical_ids(clusters.join(chunks.select("id", "text"), "id"), "cluster", "id", F.col("text"))
    return store.write("chunks", similarity.apply_canonical(chunks, found).select(*chunks.columns))


def verify_duplicates(store: TableStore, backend: models.ModelBackend, cut: float = 0.92) -> DataFrame:
    """As ``deduplicate``, but each other record of a cluster becomes a copy only if the model says so."""
    chunks = store.read("chunks", CHUNKS)
    clusters = similarity.duplicate_clusters(store.read("vectors", VECTORS), "id", "vector", cut)
    found = similarity.canonical_ids(clusters.join(chunks.select("id", "text"), "id"), "cluster", "id", F.col("text"))
    text = chunks.select("id", F.substring("text", 1, 4000).alias("t"))
    both = found.join(text.toDF("child_id", "b"), "child_id").join(text.toDF("canonical_id", "a"), "canonical_id")
    asked = both.select(F.col("child_id").alias("id"), F.concat(F.lit("A:\n"), "a", F.lit("\n\nB:\n"), "b").alias("prompt"))
    said = _answers(models.complete(asked, backend, "duplicate boolean", key="id")).where("answer.duplicate").select(F.col("id").alias("child_id"))
    return store.write("chunks", similarity.apply_canonical(chunks, found.join(said, "child_id")).select(*chunks.columns))


def adjudicate(store: TableStore, concepts: DataFrame, backend: models.ModelBackend, limit: int = 400) -> DataFrame:
    """Ask the model about labels that name no concept, most frequent first, each once ever; returns the plan of all verdicts so far."""
    chunks = store.read("chunks", CHUNKS)
    m = _mentions(chunks).join(chunks.select(F.col("id").alias("doc"), "locator"), "doc")
    lost = resolver.orphans(m.select(F.xxhash64("doc", "pos").alias("mention_seq"), "text", "type", "locator"), concepts)
    old = store.read("verdicts", "folded string, label string, verdict string, target string, count long")
    asked = lost.select("folded", "label", "count", F.concat_ws(" ", F.lit("label:"), "label", F.lit("seen:"), F.col("count").cast("string")).alias("prompt"))
    got = _answers(models.complete_cached(asked, old, backend, "verdict string, target string", key="folded", limit=limit, order=[F.desc("count"), "folded"])).where("error is null")
    new = got.join(lost, "folded").select("folded", "label", "answer.verdict", "answer.target", "count")
    return harvest.plan_adjudication(store.write("verdicts", old.unionByName(new)), concepts)


def propose_aliases(store: TableStore, concepts: DataFrame, backend: models.ModelBackend, limit: int | None = None) -> DataFrame:
    """Ask the model for wordings of the concepts (pref) that weren't asked about yet; returns (concept, pos, alias) of all answers so far."""
    old = store.read("aliases", "concept string, aliases array<string>")
    asked = concepts.where("pref is not null and trim(pref) <> ''").select(F.col("pref").alias("concept"), F.concat(F.lit("concept: "), "pref").alias("prompt")).distinct()
    got = _answers(models.complete_cached(asked, old, backend, "aliases array<string>", key="concept", limit=limit)).where("error is null")
    both = store.write("aliases", old.unionByName(got.select("concept", "answer.aliases")))
    return both.select("concept", F.posexplode("aliases").alias("pos", "alias")).where("trim(alias) <> ''")


def linker_documents(store: TableStore, broader: DataFrame | None = None) -> DataFrame:
    """(doc_id, pos, nodes, ayahs, ravis, bab, kitab): resolved nodes with their parents and, from a closure (child, ancestor), all broader ones."""
    chunks, nodes = store.read("chunks", CHUNKS), store.read("doc_nodes", DOC_NODES)
    keys = nodes.select("id", "key").union(nodes.where("parent is not null").select("id", "parent"))
    if broader is not None:
        keys = keys.union(keys.join(broader, keys["key"] == broader["child"]).select("id", "ancestor"))
    g = keys.groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("nodes"))
    p = chunks.where("status <> 'SKIPPED'").select("id", "unit_seq", "source_path", "kitab", "bab", F.from_json("payload", PAYLOAD).alias("p"))
    pos = F.xxhash64("source_path").bitwiseAND(F.lit(0xFFFFFF)) * F.lit(1 << 32) + F.col("unit_seq")
    return p.join(g, "id", "left").select(F.col("id").alias("doc_id"), pos.alias("pos"), "nodes", F.col("p.quran_refs").alias("ayahs"), F.col("p.ravis").alias("ravis"), "bab", "kitab")


def link(store: TableStore, backend: models.ModelBackend | None = None, budget: int = 5_000, broader: DataFrame | None = None, options: linkage.LinkOptions = linkage.LinkOptions()) -> DataFrame:
    """Rank candidate pairs, best first and not judged yet; with a backend, judge the best ``budget`` of them and store the edges. Returns the ranking."""
    docs = linker_documents(store, broader)
    signals = {"node": F.col("nodes"), "ayah": F.col("ayahs"), "ravi": F.col("ravis"), "bab": F.col("bab"), "kitab": F.col("kitab")}
    vectors = store.read("vectors", VECTORS).toDF("doc", "v")
    edges = store.read("edges", EDGES)
    scored = linkage.candidates(docs, signals, options=options, vectors=vectors)
    ranked = linkage.rank(scored, judged=edges.select(F.col("left_id").alias("left"), F.col("right_id").alias("right")), limit=budget)
    if backend is None:
        return ranked
    ranked = store.write("ranking", ranked)
    text = store.read("chunks", CHUNKS).select("id", F.substring("text", 1, 4000).alias("t"))
    both = ranked.join(text.toDF("left", "a"), "left").join(text.toDF("right", "b"), "right").withColumn("pair_id", pair_id(F.col("left"), F.col("right")))
    asked = both.select("pair_id", F.concat(F.lit("A:\n"), "a", F.lit("\n\nB:\n"), "b").alias("prompt"))
    got = _answers(models.complete(asked, backend, "relation string", key="pair_id", validate=_relation)).where("error is null")
    new = got.join(both.select("pair_id", "left", "right", "score"), "pair_id").select("pair_id", F.col("left").alias("left_id"), F.col("right").alias("right_id"), "answer.relation", "score")
    store.write("edges", state.merge(edges, new, ["pair_id"]))
    return ranked


def _relation(answer: dict) -> str | None:
    return None if answer.get("relation") in ("SUPPORTS", "CONTRADICTS", "EXCEPTS", "UNRELATED") else "unknown relation"


def export_store(store: TableStore, path: str) -> tuple[DataFrame, DataFrame]:
    """Write the property graph of all stored tables as JSON lines."""
    chunks = store.read("chunks", CHUNKS).where("status <> 'SKIPPED'")
    told = _payloads(chunks).select("id", F.explode("p.ravis").alias("name")).where("name is not null and name <> ''").distinct()
    edges = store.read("edges", EDGES)
    cited = _payloads(chunks).select("id", F.explode("p.quran_refs").alias("ref")).distinct()
    doc_nodes = store.read("doc_nodes", DOC_NODES).withColumn("role", F.when(F.col("weight") >= PRIMARY_WEIGHT, "primary").otherwise("secondary"))
    nodes, links = export.export_graph(chunks, doc_nodes, edges, told, cited)
    export.write_graph(nodes, links, path)
    return nodes, links


def headings_of(units: DataFrame) -> DataFrame:
    """(file, seq, pos, level, topic, text): the headings of paged units that name a subject, with their page."""
    from corpusloom.functions.text import plain
    from corpusloom.runtime import ship

    ship(units.sparkSession)
    heads = units.select(F.col("source_path").alias("file"), F.col("unit_seq").alias("seq"), "text", F.posexplode(pages.headings(F.col("text"))).alias("pos", "h"))
    heads = heads.select("file", "seq", "pos", "h.level", plain(pages.heading_topic(F.col("h.title"))).alias("topic"), "text")
    return heads.where((F.col("topic") != "") & ~F.col("topic").rlike("|".join(pages.EMPTY_TOPICS)))


def harvest_book_headings(units: DataFrame) -> DataFrame:
    """Chapters (file, seq, pos, topic, kitab, is_term) of paged units."""
    return harvest.scan_headings(headings_of(units))


def harvest_vocabulary(store: TableStore, units: DataFrame, base: DataFrame, path: str | None = None, min_sources: int = 1, min_df: int = 2) -> tuple[DataFrame, DataFrame]:
    """Mine the headings of ``units`` and, if nodes were resolved, recurring labels that no chapter has, against the hand-written catalog (``base``: folded, pref) alone, never an earlier harvest.

    Stores the table derived, writes it as a catalog file to ``path`` and returns it with the outcomes of the parents' vote.
    """
    terms, outcomes = harvest.harvest(headings_of(units), base, F.col("text"))
    if store.exists("nodes"):
        have = terms.select(fold_label("term").alias("folded"))
        more = harvest.promote(store.read("nodes"), base.select("folded").union(have), min_df)
        terms = terms.unionByName(more.select(F.col("label").alias("term"), F.col("df").alias("n"), F.lit(None).cast("string").alias("broader")))
    derived = store.write("derived", harvest.derived_catalog(terms, min_sources))
    if path:
        write_text(units.sparkSession, path, harvest.catalog_yaml([r.asDict() for r in derived.orderBy("id").toLocalIterator()]))
    return derived, outcomes


def load_catalogs(spark: SparkSession, *paths: str) -> DataFrame:
    """Concept catalogs in order of precedence as one table (id, pref, aliases, broader, group, ord); files that don't exist are empty."""
    rows = []
    for path in paths:
        found = read_document(spark, path)
        rows += catalog.parse_concepts(found.get("concepts") if isinstance(found, dict) else found)
    keys = {r["pref"]: k for k, r in zip(_folded(spark, [r["pref"] for r in rows]), rows)}
    return catalog.concept_table(spark, catalog.merge_catalogs(rows, lambda label: keys.get(label, label)))


def _folded(spark: SparkSession, labels: list[str]) -> list[str]:
    """The catalog keys of labels (a catalog's: few), by the same fold as everywhere."""
    if not labels:
        return []
    df = spark.createDataFrame(list(enumerate(labels)), "i int, label string").select("i", fold_label("label").alias("key"))
    return [r["key"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def load_entities(spark: SparkSession, path: str) -> DataFrame:
    found = read_document(spark, path)
    return catalog.entity_table(spark, catalog.parse_entities(found if isinstance(found, dict) else {}))


def enrich_aliases(store: TableStore, concepts: DataFrame, units: DataFrame, proposed: DataFrame, min_pages: int = 5, min_overlap: float = 0.2) -> DataFrame:
    """(concept, pos, alias, outcome) of proposed wordings, judged by the pages of the corpus; the kept ones become the table derived_aliases (pref, alias)."""
    words = F.filter(F.split(match_key("text"), " "), lambda w: w != "")
    names = proposed.select(F.col("concept").alias("candidate")).union(proposed.select("alias")).distinct()
    pages_ = units.select(F.xxhash64("source_path", "unit_seq").alias("page_id"), F.col("source_path").alias("kitab"), "text")
    attested = harvest.attest(names, pages_, words, match_key("candidate"))
    out = materialize(harvest.ground_aliases(proposed, concepts, attested, min_pages, min_overlap), "aliases")
    store.write("derived_aliases", out.where("outcome = 'kept'").select(F.col("concept").alias("pref"), "alias"))
    return out


def unify(store: TableStore, backend: models.ModelBackend, head: int = 8_000) -> DataFrame:
    """Ask the model to complete records that lack something (several pages, an unfinished translation, under two topics, no narrators); what it gives fills gaps and is merged with what is there."""
    chunks = store.read("chunks", CHUNKS)
    p = _payloads(chunks).where("pipeline = 'hadith'").select("id", "locator", "text", "p")
    ends = F.split("locator", " … ")
    lacking = needs_enrichment(ends[0], F.element_at(ends, -1), F.coalesce("p.translation", F.lit("")), F.coalesce(F.size("p.mentions"), F.lit(0)), F.coalesce(F.size("p.ravis"), F.lit(0)))
    todo = p.where(lacking).select("id", F.concat(F.lit("complete:\n"), F.substring("text", 1, head)).alias("prompt"))
    got = _answers(models.complete(todo, backend, PAYLOAD, key="id")).where("error is null").select("id", F.col("answer").alias("a"))
    both = got.join(p.select("id", "p"), "id")
    none = F.array().cast("array<struct<text:string,type:string,salience:string,evidence:string>>")
    number = lambda m: F.struct(m["text"].alias("text"), m["type"].alias("type"), salience(m["salience"]).alias("salience"), m["evidence"].alias("evidence"))
    mentions = assembly.union_mentions(F.transform(F.concat(F.coalesce("p.mentions", none), F.coalesce("a.mentions", none)), number))
    strings = F.array().cast("array<string>")
    merged = F.struct(
        F.transform(mentions, lambda m: m.withField("salience", m["salience"].cast("string"))).alias("mentions"), F.coalesce("p.quotes", "a.quotes").alias("quotes"),
        F.when(F.size(F.coalesce("a.ravis", strings)) > 0, F.col("a.ravis")).otherwise(F.col("p.ravis")).alias("ravis"),
        F.array_distinct(F.concat(F.coalesce("p.quran_refs", strings), F.coalesce("a.quran_refs", strings))).alias("quran_refs"),
        F.array_distinct(F.concat(F.coalesce("p.proposed_nodes", strings), F.coalesce("a.proposed_nodes", strings))).alias("proposed_nodes"),
        F.when(translation_incomplete(F.coalesce("p.translation", F.lit(""))), F.coalesce(F.nullif("a.translation", F.lit("")), "p.translation")).otherwise(F.col("p.translation")).alias("translation"),
    )
    done = both.select("id", F.to_json(merged).alias("payload"))
    return store.write("chunks", state.merge(chunks, done, ["id"]))


def audit_mentions(store: TableStore, entities: DataFrame, top: int | None = None, path: str | None = None) -> DataFrame:
    """Records by risk: unsupported mentions, broken translations, too few mentions. Written as a report to ``path``."""
    chunks = store.read("chunks", CHUNKS)
    p = _payloads(chunks)
    judged = judged_mentions(chunks, entities)
    few = p.select(F.col("id").alias("doc"), F.coalesce(F.size("p.mentions"), F.lit(0)).alias("n_mentions"), F.size(F.split("text", r"\s+")).alias("n_words"))
    cut = p.where("p.translation is not null").select(F.col("id").alias("doc"), F.col("p.translation").alias("translation"))
    found = audit.risk([audit.ungrounded(judged), audit.few_mentions(few), audit.truncated_translations(cut)], top=top)
    if path:
        write_text(store.spark, path, audit.to_markdown(found, "Mentions to review", ["doc", "risk", "issues"]))
    return found


def filter_audit(store: TableStore, found: DataFrame, backend: models.ModelBackend, path: str | None = None) -> DataFrame:
    """The issues of an audit that a model, shown the record's excerpt, doesn't dismiss. Written as a review to ``path``."""
    rows = materialize(found.select("doc", F.explode("issues").alias("i")).select("doc", "i.code", "i.detail", "i.weight"), "issues")
    text = store.read("chunks", CHUNKS).select(F.col("id").alias("doc"), audit.excerpt(F.col("text"), fold("text")).alias("text"))
    verdicts = materialize(audit.review_issues(rows, text, backend), "reviews")
    kept = audit.filter_by_verdicts(rows, verdicts)
    if path:
        gone = rows.join(verdicts.where("verdict = 'drop'"), ["doc", "code"], "left_semi")
        write_text(store.spark, path, audit.review_report(kept, gone))
    return kept


def proposals(store: TableStore, known: DataFrame, threshold: int | None = None) -> DataFrame:
    """Plan for terms that the model proposed: promote, repair or drop."""
    chunks = store.read("chunks", CHUNKS)
    rows = _payloads(chunks).select(F.xxhash64("id").alias("doc"), "id", F.posexplode("p.proposed_nodes").alias("n", "term"))
    grouped = harvest.group_proposals(rows.select(F.struct("doc", "n").alias("seq"), "term", F.col("id").alias("source")), known)
    parts = catalog.decompose(grouped.select("folded", F.col("term").alias("text")), known, ["folded"])
    anchors = parts.groupBy("folded").agg(F.min_by("pref", "word_pos").alias("anchor"))
    from corpusloom.functions.text import compound_threshold

    n = chunks.select("id").distinct().count()
    return harvest.plan_proposals(grouped, anchors, F.lit(threshold) if threshold else compound_threshold(F.lit(n)))


def cite(store: TableStore, verses: DataFrame) -> DataFrame:
    """(id, refs): verses that stored texts quote, verbatim or by roots."""
    return citations.match_verses(store.read("chunks", CHUNKS).where("status <> 'SKIPPED'"), verses, "id", "text")


def status(store: TableStore, book: str | None = None) -> DataFrame:
    chunks = store.read("chunks", CHUNKS)
    return state.status_counts(chunks.where(F.col("book_id") == book) if book else chunks)


def reset(store: TableStore, book: str) -> None:
    """Forget a book: its chunks, vectors, nodes and edges."""
    chunks = store.read("chunks", CHUNKS)
    gone = chunks.where(F.col("book_id") == book).select(F.col("id").alias("gone"))
    tables = {"vectors": (store.read("vectors", VECTORS), ["id"]), "doc_nodes": (store.read("doc_nodes", DOC_NODES), ["id"]), "edges": (store.read("edges", EDGES), ["left_id", "right_id"])}
    for name, (df, ends) in tables.items():
        for end in ends:
            df = df.join(gone, F.col(end) == F.col("gone"), "left_anti")
        store.write(name, df)
    store.write("chunks", chunks.where(F.col("book_id") != book))
