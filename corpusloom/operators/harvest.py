"""Vocabulary harvesting: votes of headings, majority parents, seams, promotion, attestation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.text import fold_label
from corpusloom.operators.catalog import decompose
from corpusloom.operators.similarity import sparse_cosine
from corpusloom.runtime import materialize

# Printed titles of one and the same book, by folded title.
BOOK_ALIASES = {
    "صوم": "الصيام", "صيام": "الصيام", "وصيه": "الوصية", "وصايا": "الوصية", "حدود": "الحدود", "حدود والتعزيرات": "الحدود",
    "قضاء": "القضاء", "قضاء و الاحكام": "القضاء", "قضايا والاحكام": "القضاء", "فرايض": "المواريث", "مواريث": "المواريث",
    "فرايض و المواريث": "المواريث", "فرايض والمواريث": "المواريث", "عتق": "العتق", "عتق وكيفيته": "العتق",
}
# Word classes that make a heading no term.
PROPOSITIONAL = r"^(?:أن|أنّ|ان|إن|أنه|أنها|انه|انها|ما|من|في|فيمن|فيما|إذا|اذا|كيف|هل|لا|كم|متى|حكم من|قول)(?![؀-ۿ])"
LETTER_INDEX = r"^ال(?:ألف|الف|باء|تاء|ثاء|جيم|حاء|خاء|دال|ذال|راء|زاي|سين|شين|صاد|ضاد|طاء|ظاء|عين|غين|فاء|قاف|كاف|لام|ميم|نون|هاء|واو|ياء)\s+\S+$"
PERSIAN = "[پچژگ]"
FURNITURE = r"[()\[\]{}«»<>0-9٠-٩|]"
GENERIC = ("ترك", "إتيان", "اتيان", "كون", "كيفية", "إخراج", "اخراج", "عمل", "إعطاء", "اعطاء", "إعادة", "اعادة", "حضور", "طلب", "دخول", "خروج", "طول", "طرح", "مقدار", "وضع", "رفع", "أخذ", "اخذ", "جعل", "نقل", "بيع", "شراء", "قطع", "منع", "دفع", "رد", "صرف", "قدر")
YA_NOUNS = ("يوم", "يقين", "يد", "يمين", "يتيم", "يهود", "يونس", "يس")
META_HEADS = ("صفة", "صفات", "فضل", "فضائل", "ثواب", "عقاب", "أحكام", "حكم", "آداب", "أبواب", "جملة", "ذكر", "بيان", "معنى", "تفسير", "نوادر", "وجوب", "استحباب", "كراهة", "تحريم", "جواز", "عدم", "اشتراط", "بطلان")
EDITORIAL = ("عنوان", "الباب", "باب", "أبواب", "الأبواب", "كتاب", "الكتاب")
FUNCTION_WORDS = ("أحدهما", "أحدهم", "هو", "هي", "هم", "هن", "هذا", "هذه", "ذلك", "تلك", "الذي", "التي", "الذين", "أخذ", "قال", "قوله", "غير", "سائر", "بعض", "كل", "أول", "آخر", "شيء", "أشياء", "أمر", "أمور", "وجه", "وجوه", "باب", "أبواب", "كتاب", "كتب", "جملة", "عدة", "نحو", "مثل", "معه")


def _folded(words: tuple[str, ...]) -> Column:
    return F.array_distinct(F.transform(F.lit(list(words)), fold_label))


def strip_meta_head(topic: Column) -> Column:
    """Without its leading descriptive words."""
    words = F.filter(F.split(topic, r"\s+"), lambda w: w != "")
    kept = F.aggregate(words, F.array().cast("array<string>"), lambda s, w: F.when((F.size(s) == 0) & F.array_contains(_folded(META_HEADS), fold_label(w)), s).otherwise(F.concat(s, F.array(w))))
    return F.array_join(kept, " ")


def is_term(topic: Column, max_words: int = 3, min_chars: int = 3) -> Column:
    """A heading that can be a concept: a short noun phrase in Arabic script, no clause, index letter, bare verbal noun or back-reference."""
    words = F.split(F.coalesce(topic, F.lit("")), " ")
    folded = F.transform(words, fold_label)
    single = F.size(words) == 1
    verb = F.exists(F.slice(folded, 2, 99), lambda w: w.rlike(r"^ي\S{3,}$") & ~F.array_contains(_folded(YA_NOUNS), w))
    refused = (
        topic.rlike(PROPOSITIONAL)
        | topic.rlike(FURNITURE)
        | ~topic.rlike("[؀-ۿ]")
        | topic.rlike(LETTER_INDEX)
        | topic.rlike(PERSIAN)
        | F.array_contains(_folded(FUNCTION_WORDS), folded[0])
        | F.arrays_overlap(_folded(EDITORIAL), folded)
        | verb
        | (single & F.array_contains(_folded(GENERIC), folded[0]))
        | (single & ~topic.startswith("ال") & topic.rlike("(?:ه|ها|هم|هن|هما)$"))
    )
    return F.coalesce((F.length(topic) >= min_chars) & (F.size(words) <= max_words) & ~refused, F.lit(False))


def book_key(book: Column, aliases: dict[str, str] | None = None, folding=fold_label) -> Column:
    """Key under which a book's printed titles meet."""
    f = folding(book)
    if aliases is None:
        aliases = BOOK_ALIASES
    return F.coalesce(*[F.when(f == folding(F.lit(k)), folding(F.lit(v))) for k, v in aliases.items()], f)


def settle_parents(votes: DataFrame, books: DataFrame, standalone: DataFrame, majority: float = 0.65, key=book_key) -> DataFrame:
    """(term, outcome, parent): the parent of each term by a majority of its printings.

    ``votes``: term, kitab, n; ``books``: kitab of every book seen; ``standalone``: terms that were a chapter of their own. Outcomes in
    order: is_a_book, never_a_chapter, no_evidence (votes without a book abstain), cross_cutting (below the majority, or itself), settled.
    Ties go to the smallest key. A parent is spelled as printed most often (ties: the smallest spelling).
    """
    v = votes.where("kitab is not null and kitab <> ''").withColumn("book", key("kitab"))
    by_book = v.groupBy("term", "book").agg(F.sum("n").alias("n"))
    tally = by_book.groupBy("term").agg(F.sum("n").alias("total"), F.max(F.struct("n", F.col("book"))).alias("_"), F.min_by("book", F.struct(-F.col("n"), "book")).alias("top"), F.max("n").alias("top_n")).drop("_")
    spell = v.groupBy("book", "kitab").agg(F.sum("n").alias("n")).groupBy("book").agg(F.min_by("kitab", F.struct(-F.col("n"), "kitab")).alias("spelling"))
    terms = votes.select("term").distinct().withColumn("own", key("term"))
    t = (
        terms.join(tally, "term", "left")
        .join(books.select(key("kitab").alias("own")).distinct().withColumn("is_book", F.lit(True)), "own", "left")
        .join(standalone.select("term").distinct().withColumn("alone", F.lit(True)), "term", "left")
        .join(spell.withColumnRenamed("book", "top"), "top", "left")
    )
    outcome = (
        F.when(F.col("is_book"), "is_a_book")
        .when(F.col("alone").isNull(), "never_a_chapter")
        .when(F.col("total").isNull(), "no_evidence")
        .when((F.col("top_n") / F.col("total") < majority) | (F.col("own") == F.col("top")), "cross_cutting")
        .otherwise("settled")
    )
    return t.select("term", outcome.alias("outcome"), F.when(outcome == "settled", F.col("spelling")).alias("parent"))


def seam(flags: DataFrame, keys: list[str], order: list[str], flag: Column, min_span: int = 50, min_prefix: int = 15, min_hits: int = 8, min_rate: float = 0.35, max_suffix_rate: float = 0.06, min_suffix: int = 25, min_suffix_share: float = 0.4) -> DataFrame:
    """(keys, cut): where a span stops being about its subject: the cut with the greatest fall of the flag's rate, if it meets all floors; the first of equals.

    Rates are doubles, so falls that are equal as fractions may differ in their last digits. A fall is measured in millionths less a millionth of a millionth a place: differences below 1e-12 a place don't count, and the earlier cut wins.
    """
    w = Window.partitionBy(*keys)
    placed = w.orderBy(*[F.asc_nulls_last(c) for c in order])
    so_far = placed.rowsBetween(Window.unboundedPreceding, 0)
    f = flags.select(*keys, F.row_number().over(placed).alias("cut"), F.count(F.lit(1)).over(w).alias("total"), F.sum(flag.cast("int")).over(so_far).alias("hits"), F.sum(flag.cast("int")).over(w).alias("seen"))
    tail = F.col("total") - F.col("cut")
    before, after = F.col("hits") / F.col("cut"), (F.col("seen") - F.col("hits")) / tail
    ok = (F.col("total") >= min_span) & (tail > 0) & (F.col("cut") >= min_prefix) & (F.col("hits") >= min_hits) & (tail >= min_suffix) & (tail >= min_suffix_share * F.col("total")) & (before >= min_rate) & (after <= max_suffix_rate)
    return f.where(ok).groupBy(*keys).agg(F.max_by("cut", F.struct((before - after) * 1e6 - F.col("cut") * 1e-6, -F.col("cut"))).alias("cut"))


def scan_headings(heads: DataFrame, page_text: Column | None = None, **seam_floors) -> DataFrame:
    """Chapter headings (file, seq, pos, level, topic, and what ``page_text`` reads) as rows (file, seq, pos, topic, kitab, is_term): each with its book.

    A book heading that is no term clears the book in force: chapters after it have none, rather than the wrong one. With ``page_text``, chapters whose pages stop naming their book lose it from the
    seam on (``seam``), as an unmarked change of book is likelier there than a digression.
    """
    order = Window.partitionBy("file").orderBy("seq", "pos").rowsBetween(Window.unboundedPreceding, 0)
    is_book = F.col("level") == "book"
    book = F.coalesce(F.nullif(strip_meta_head(F.col("topic")), F.lit("")), "topic")
    named = heads.where("topic <> ''").where(~F.col("topic").rlike(PROPOSITIONAL)).withColumn("_book", F.when(is_book, F.when(is_term(book), book).otherwise("")))
    h = named.withColumn("kitab", F.coalesce(F.last("_book", ignorenulls=True).over(order), F.lit(""))).withColumn("span", F.sum(is_book.cast("int")).over(order))
    h = h.where("level = 'chapter'").withColumn("topic", strip_meta_head(F.col("topic"))).where("topic <> ''").withColumn("is_term", is_term(F.col("topic")))
    if page_text is not None:
        head = F.split_part(fold_label("kitab"), F.lit(" "), F.lit(1))
        h = h.withColumn("about", (head != "") & F.contains(fold_label(page_text), head))
        cuts = seam(h.where("kitab <> ''"), ["file", "span"], ["seq", "pos"], F.col("about"), **seam_floors)
        place = F.row_number().over(Window.partitionBy("file", "span").orderBy("seq", "pos"))
        h = h.withColumn("_n", place).join(cuts, ["file", "span"], "left").withColumn("kitab", F.when(F.col("_n") > F.col("cut"), "").otherwise(F.col("kitab")))
    return h.select("file", "seq", "pos", "topic", "kitab", "is_term")


def books_of(heads: DataFrame) -> DataFrame:
    """(kitab, n): the books that headings name, and how often."""
    book = F.coalesce(F.nullif(strip_meta_head(F.col("topic")), F.lit("")), "topic")
    named = heads.where("level = 'book' and topic <> ''").where(~F.col("topic").rlike(PROPOSITIONAL)).select(book.alias("kitab")).where(is_term(F.col("kitab")))
    return named.groupBy("kitab").agg(F.count(F.lit(1)).alias("n"))


def vote(chapters: DataFrame) -> DataFrame:
    """(term, kitab, n) of the chapters that are terms; a chapter named as its book abstains."""
    own = F.when(F.col("topic") == F.col("kitab"), F.lit("")).otherwise(F.col("kitab"))
    return chapters.where("is_term").groupBy(F.col("topic").alias("term"), own.alias("kitab")).agg(F.count(F.lit(1)).alias("n"))


def harvest(heads: DataFrame, base: DataFrame, page_text: Column | None = None, rounds: int = 3, folding=fold_label, **seam_floors) -> tuple[DataFrame, DataFrame]:
    """(terms, outcomes): the vocabulary that headings carry. Terms: term, n, broader; outcomes: outcome, terms.

    Chapters that are terms vote for their books; long titles are mined for the concepts of ``base`` (folded, pref) and of the terms found so far, again while that finds new ones (``rounds`` at most), each
    title voting once, by the last round; a majority settles each term's parent.
    """
    chapters = materialize(scan_headings(heads, page_text, **seam_floors), "chapters")
    books = materialize(books_of(heads), "books")
    own, long = vote(chapters), chapters.where("not is_term").select(F.xxhash64("file", "seq", "pos").alias("title_id"), F.col("topic").alias("title"), "kitab")
    words = base.select("folded", "pref").unionByName(own.select(F.col("term").alias("pref")).union(books.select("kitab")).distinct().select(folding("pref").alias("folded"), "pref"))
    forms, size, mined = None, -1, None
    for _ in range(rounds):
        forms = materialize(words.where("folded <> ''").groupBy("folded").agg(F.min("pref").alias("pref")), "forms")
        now = forms.count()
        if now == size:
            break
        size = now
        mined = materialize(mine_long_titles(long, forms, folding), "mined")
        words = forms.unionByName(mined.select("term").distinct().select(folding("term").alias("folded"), F.col("term").alias("pref")))
    abstain = F.when(F.col("term") == F.col("kitab"), F.lit("")).otherwise(F.col("kitab"))
    votes = materialize(own.unionByName(mined.select("term", abstain.alias("kitab"), "n")).groupBy("term", "kitab").agg(F.sum("n").alias("n")), "votes")
    parents = materialize(settle_parents(votes, books, own.select("term")), "parents")
    counts = votes.groupBy("term").agg(F.sum("n").alias("n")).unionByName(books.select(F.col("kitab").alias("term"), "n")).groupBy("term").agg(F.sum("n").alias("n"))
    terms = counts.join(parents.select("term", F.col("parent").alias("broader")), "term", "left").select("term", "n", "broader")
    return terms, parents.groupBy("outcome").agg(F.count(F.lit(1)).alias("terms"))


def derived_catalog(terms: DataFrame, min_sources: int = 1, folding=fold_label) -> DataFrame:
    """Rows (id, pref, broader, n) of the catalog that a harvest writes: of terms with one folded form the smallest, with enough sources, none its own parent."""
    t = terms.where(F.col("n") >= min_sources).withColumn("folded", folding("term")).where("folded <> ''")
    first = t.groupBy("folded").agg(F.min(F.struct("term", "broader", "n")).alias("x")).select("folded", "x.*")
    parent = F.when(folding("broader") != F.col("folded"), F.nullif("broader", F.lit("")))
    return first.select(F.col("term").alias("id"), F.col("term").alias("pref"), parent.alias("broader"), "n")


def catalog_yaml(rows: list[dict]) -> str:
    """A catalog file of rows (id, pref, broader, n); text is quoted and escaped as YAML's double-quoted style (JSON strings are) wants."""
    import json

    quoted = lambda x: json.dumps(x, ensure_ascii=False)
    lines = [f"  - {{id: {quoted(r['id'])}, pref: {quoted(r['pref'])}" + (f", broader: {quoted(r['broader'])}" if r.get("broader") else "") + "}" + (f"  # x{r['n']}" if r.get("n") else "") for r in rows]
    return "concepts:\n" + "\n".join(lines) + "\n" if lines else "concepts: []\n"


def mine_long_titles(titles: DataFrame, forms: DataFrame, folding=fold_label) -> DataFrame:
    """(term, kitab, n): votes of titles (title_id, title, kitab) for the concepts among their words, one a title."""
    found = decompose(titles.select("title_id", "kitab", F.col("title").alias("text")), forms, ["title_id", "kitab"], "text", folding)
    return found.groupBy(F.col("pref").alias("term"), "kitab").agg(F.count(F.lit(1)).alias("n"))


def promote(nodes: DataFrame, existing: DataFrame, min_df: int = 2, term_ok: Column | None = None, folding=fold_label) -> DataFrame:
    """Nodes (label, type, curated, df) that recur and become concepts: concepts, not curated, df >= min_df, a valid term, not present."""
    ok = is_term(F.col("label")) if term_ok is None else term_ok
    n = nodes.where((F.col("type") == "concept") & ~F.col("curated") & (F.col("df") >= min_df) & ok).withColumn("folded", folding("label"))
    return n.join(existing.select("folded").distinct(), "folded", "left_anti")


def group_proposals(proposals: DataFrame, known: DataFrame, folding=fold_label) -> DataFrame:
    """(folded, term, df, variants) of proposed terms (seq, term, source) that no catalog has; the first spelling names the group."""
    p = proposals.withColumn("folded", folding("term")).where("folded <> ''").join(known.select("folded").distinct(), "folded", "left_anti")
    return p.groupBy("folded").agg(F.min_by("term", "seq").alias("term"), F.count_distinct("source").alias("df"), F.array_sort(F.collect_set("term")).alias("variants"))


def proposals_per_source(proposals: DataFrame, folding=fold_label) -> DataFrame:
    """(source, terms): how many different terms each source proposed."""
    return proposals.withColumn("folded", folding("term")).where("folded <> ''").groupBy("source").agg(F.count_distinct("folded").alias("terms"))


def repair_map(plan: DataFrame) -> DataFrame:
    """(term, anchor) of the proposals that the plan repairs."""
    return plan.where("action = 'repair'").select("term", "anchor")


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def plan_proposals(grouped: DataFrame, anchors: DataFrame, threshold: Column) -> DataFrame:
    """``grouped`` with action: promote (df reaches the threshold), repair (``anchors``: folded, anchor), drop."""
    g = grouped.join(anchors, "folded", "left")
    action = F.when(F.col("df") >= threshold, "promote").when(F.col("anchor").isNotNull(), "repair").otherwise("drop")
    return g.select("folded", "term", "df", action.alias("action"), F.when(action == "repair", F.col("anchor")).alias("anchor"))


def attest(candidates: DataFrame, pages: DataFrame, words: Column, key: Column, longest: int = 4) -> DataFrame:
    """(candidate, kitab, pages): on how many pages of each book a wording occurs.

    ``candidates``: candidate (its ``key`` is an expression over it); ``pages``: page_id, kitab and an array of word keys (``words``). Every n-gram up to
    ``longest`` words meets the candidates by an equi-join; of candidates with one key the smallest stands.
    """
    c = candidates.select("candidate", key.alias("key")).where("key <> ''").groupBy("key").agg(F.min("candidate").alias("candidate"))
    p = pages.select("page_id", "kitab", words.alias("w")).where(F.size("w") > 0)
    at = p.select("page_id", "kitab", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i"))
    here = [F.when(F.col("i") + n - 1 <= F.size("w"), F.array_join(F.slice("w", F.col("i"), n), " ")) for n in range(1, longest + 1)]
    grams = at.select("page_id", "kitab", F.explode(F.array(*here)).alias("key")).where("key is not null")
    hits = grams.join(c, "key").select("candidate", "kitab", "page_id").distinct()
    return hits.groupBy("candidate", "kitab").agg(F.count(F.lit(1)).alias("pages"))


def ground_aliases(proposed: DataFrame, taken: DataFrame, attested: DataFrame, min_pages: int = 5, min_overlap: float = 0.2, folding=fold_label) -> DataFrame:
    """``proposed`` (concept, pos, alias) with outcome.

    In order: same_as_concept, already_a_concept, not_in_corpus (fewer than ``min_pages``), different_context (overlap of the pages' books below
    ``min_overlap``), contested (an earlier concept claimed it), kept.
    """
    attested = materialize(attested.select("candidate", "kitab", "pages"), "attested")
    p = proposed.withColumn("folded", folding("alias")).withColumn("own", folding("concept"))
    total = attested.groupBy(F.col("candidate").alias("alias")).agg(F.sum("pages").alias("pages"))
    over = sparse_cosine(attested, attested, proposed.select(F.col("concept").alias("a"), F.col("alias").alias("b"))).toDF("concept", "alias", "overlap")
    known = taken.select("folded").distinct().withColumn("is_taken", F.lit(True))
    p = p.join(known, "folded", "left").join(total, "alias", "left").join(over, ["concept", "alias"], "left")
    early = (
        F.when((F.col("folded") == "") | (F.col("folded") == F.col("own")), "same_as_concept")
        .when(F.col("is_taken"), "already_a_concept")
        .when(F.coalesce("pages", F.lit(0)) < min_pages, "not_in_corpus")
        .when(F.coalesce("overlap", F.lit(0.0)) < min_overlap, "different_context")
    )
    p = p.withColumn("early", early)
    claim = F.row_number().over(Window.partitionBy("folded", F.col("early").isNull()).orderBy("concept", "pos"))
    return p.select("concept", "pos", "alias", F.coalesce("early", F.when(claim > 1, "contested").otherwise("kept")).alias("outcome"))


def plan_adjudication(verdicts: DataFrame, live: DataFrame, folding=fold_label) -> DataFrame:
    """``verdicts`` (label, verdict, target) with action alias, new or drop: an alias without a live target becomes a new concept."""
    v = verdicts.withColumn("key", folding("target")).join(live.select(F.col("folded").alias("key"), F.col("pref").alias("live")), "key", "left")
    action = F.when((F.col("verdict") == "alias") & F.col("live").isNotNull(), "alias").when(F.col("verdict").isin("alias", "new"), "new").otherwise("drop")
    return v.select("label", "verdict", action.alias("action"), F.when(action == "alias", F.col("live")).alias("target"))


def known_sample(concepts: DataFrame, roots: Column, wanted: Column, k: int = 220) -> DataFrame:
    """The ``k`` concepts that share most roots with ``wanted``."""
    return concepts.withColumn("shared", F.size(F.array_intersect(roots, wanted))).orderBy(F.desc("shared"), "pref").limit(k)
