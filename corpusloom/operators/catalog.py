"""Catalogs of concepts and entities: precedence, lookups, decomposition, hierarchy, node policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.text import fold_label
from corpusloom.operators.topk import keep_first, top_per
from corpusloom.runtime import materialize

ENTITY_TYPES = ("person", "place", "group", "event", "work")
NODE_TYPES = ("concept", *ENTITY_TYPES, "ayah")
MAX_NODES, MAX_PRIMARY = 6, 2
# Words that measure or frame and never name a constituent; heads that make a label descriptive.
MEASURES = ("قدر", "مقدار", "حد", "حدود", "عدد", "نحو", "مثل", "بعض", "سائر", "جملة", "وجه", "باب", "أبواب", "كتاب", "وقت", "أوقات", "كيفية", "صفة", "صفات", "معنى", "أنواع", "نوع", "قسم", "أقسام")
BANNED_HEADS = ("أهمية", "فضيلة", "فضل", "تعريف", "حقيقة", "ماهية", "بيان", "كيفية", "آثار", "ثمرات", "علة", "أسباب", "ارتباط", "مراتب")


def merge_catalogs(rows: list[dict], fold) -> list[dict]:
    """Concepts in order of precedence: a row goes if its id or its folded label is already taken by an accepted row.

    Whether a row is accepted depends on all before it, so the rows (a catalog file, small) are folded over on the driver.
    """
    ids, labels, out = set(), set(), []
    for r in rows:
        pref = r.get("pref") or r["id"]
        if r["id"] in ids or fold(pref) in labels:
            continue
        ids.add(r["id"])
        labels.add(fold(pref))
        out.append({**r, "pref": pref})
    return out


SECTIONS = {"persons": "person", "places": "place", "groups": "group", "events": "event", "works": "work"}


def _texts(x) -> list[str]:
    return [str(v).strip() for v in (x if isinstance(x, (list, tuple)) else [] if x is None else [x]) if str(v).strip()]


def parse_concepts(raw: list) -> list[dict]:
    """Rows (id, pref, aliases, broader, group) of a catalog's entries: plain labels or mappings; ``broader`` is one parent or several; entries without a label go."""
    out = []
    for entry in raw or []:
        e = {"id": entry} if isinstance(entry, str) else entry
        if not isinstance(e, dict):
            continue
        pref = str(e.get("pref") or e.get("id") or "").strip()
        if pref:
            out.append({"id": str(e.get("id") or pref).strip(), "pref": pref, "aliases": _texts(e.get("aliases")), "broader": _texts(e.get("broader")), "group": bool(e.get("group"))})
    return out


def parse_entities(raw: dict, sections: dict[str, str] = SECTIONS) -> list[dict]:
    """Rows (type, id, pref, aliases, ambiguous) of a gazetteer, section by section; of entries with one type and id the first counts."""
    out: dict[tuple[str, str], dict] = {}
    for section, kind in sections.items():
        for e in (raw or {}).get(section) or []:
            pref = str(e.get("pref") or e.get("id") or "").strip() if isinstance(e, dict) else ""
            if pref:
                row = {"type": kind, "id": str(e.get("id") or pref).strip(), "pref": pref, "aliases": _texts(e.get("aliases")), "ambiguous": bool(e.get("ambiguous"))}
                out.setdefault((kind, row["id"]), row)
    return list(out.values())


def concept_table(spark, rows: list[dict]) -> DataFrame:
    """Concepts in order as a table (id, pref, aliases, broader, group, ord)."""
    return spark.createDataFrame([(r["id"], r["pref"], r["aliases"], r["broader"], r["group"], i) for i, r in enumerate(rows)], "id string, pref string, aliases array<string>, broader array<string>, group boolean, ord int")


def entity_table(spark, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([(r["type"], r["id"], r["pref"], r["aliases"], r["ambiguous"], i) for i, r in enumerate(rows)], "type string, id string, pref string, aliases array<string>, ambiguous boolean, ord int")


def broader_edges(concepts: DataFrame) -> DataFrame:
    """(child, parent) by label of a concept table."""
    return concepts.select(F.col("pref").alias("child"), F.explode("broader").alias("parent"))


def apply_promotions(concepts: DataFrame, plan: DataFrame, folding=fold_label) -> DataFrame:
    """``concepts`` (id, pref, aliases, broader, group, ord) and the terms that ``plan`` promotes, after them, but those whose folded label is there already."""
    last = concepts.agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("last"))
    have = concepts.select(folding("pref").alias("folded")).distinct()
    new = plan.where("action = 'promote'").withColumn("folded", folding("term")).where("folded <> ''").groupBy("folded").agg(F.min("term").alias("term")).join(have, "folded", "left_anti")
    numbered = new.withColumn("n", F.row_number().over(Window.orderBy("term"))).join(F.broadcast(last))  # one row
    none = F.array().cast("array<string>")
    return concepts.unionByName(numbered.select(F.col("term").alias("id"), F.col("term").alias("pref"), none.alias("aliases"), none.alias("broader"), F.lit(False).alias("group"), (F.col("last") + F.col("n")).cast("int").alias("ord")), allowMissingColumns=True)


def replace_section(concepts: DataFrame, rows: DataFrame, origin: str) -> DataFrame:
    """``concepts`` (with a column origin) where ``rows`` take the place of all rows of that origin: applied twice it changes nothing."""
    return concepts.where(~F.col("origin").eqNullSafe(F.lit(origin))).unionByName(rows.withColumn("origin", F.lit(origin)), allowMissingColumns=True)


def vocabulary_block(concepts: list[str], groups: list[str], max_chars: int = 8000) -> str:
    """The catalog's labels for a prompt, cut at ``max_chars``."""
    lines = ["CONCEPTS: " + " · ".join(concepts)] + (["GROUPS: " + " · ".join(groups)] if groups else [])
    return "\n".join(lines)[:max_chars]


def concept_forms(concepts: DataFrame, folding=fold_label) -> DataFrame:
    """(folded, pref, ord): every id, label and alias. On collisions the earliest concept wins."""
    forms = F.explode(F.array_distinct(F.concat(F.array("id", "pref"), F.coalesce("aliases", F.array().cast("array<string>")))))
    rows = concepts.select("pref", "ord", forms.alias("form")).select(folding("form").alias("folded"), "pref", "ord").where("folded <> ''")
    return rows.groupBy("folded").agg(F.min_by("pref", "ord").alias("pref"), F.min("ord").alias("ord"))


def entity_forms(entities: DataFrame, folding=fold_label, honour_ambiguous: bool = True) -> DataFrame:
    """(type, folded, pref); ambiguous entities seed nothing unless asked."""
    e = entities.where(~F.coalesce("ambiguous", F.lit(False))) if honour_ambiguous else entities
    forms = F.explode(F.array_distinct(F.concat(F.array("id", "pref"), F.coalesce("aliases", F.array().cast("array<string>")))))
    rows = e.select("type", "pref", "ord", forms.alias("form")).select("type", folding("form").alias("folded"), "pref", "ord").where("folded <> ''")
    return rows.groupBy("type", "folded").agg(F.min_by("pref", "ord").alias("pref"))


def attach_aliases(concepts: DataFrame, aliases: DataFrame, folding=fold_label) -> DataFrame:
    """Add derived aliases (pref, alias) to their concepts, but those whose folded form the concept has already."""
    a = aliases.select(folding("pref").alias("key"), "alias", folding("alias").alias("fa")).groupBy("key").agg(F.array_sort(F.collect_set(F.struct("fa", "alias"))).alias("new"))
    c = concepts.withColumn("key", folding("pref")).join(a, "key", "left")
    forms = F.concat(F.array("pref"), F.coalesce("aliases", F.array().cast("array<string>")))
    own = F.transform(forms, folding)
    more = F.transform(F.filter(F.coalesce("new", F.array().cast("array<struct<fa:string,alias:string>>")), lambda x: ~F.array_contains(own, x["fa"])), lambda x: x["alias"])
    return c.withColumn("aliases", F.concat(F.coalesce("aliases", F.array().cast("array<string>")), more)).drop("key", "new")


def seeds(forms: DataFrame, entities: DataFrame) -> DataFrame:
    """One lookup table for both catalogs: (folded, type, pref, kind_rank). Entity types rank in fixed order after concepts."""
    rank = F.coalesce(*[F.when(F.col("type") == t, F.lit(i + 1)) for i, t in enumerate(ENTITY_TYPES)], F.lit(9))
    return forms.select("folded", F.lit("concept").alias("type"), "pref", F.lit(0).alias("kind_rank")).unionByName(
        entities.select("folded", "type", "pref", rank.alias("kind_rank"))
    )


def seed_lookup(labels: DataFrame, table: DataFrame, id_cols: list[str], folding=fold_label) -> DataFrame:
    """Best catalog entry for each label (columns ``id_cols``, text, type): the declared entity type, then concepts, then other types."""
    asked = labels.select(*id_cols, F.col("type").alias("_declared"), folding("text").alias("folded"))
    hits = asked.join(table, "folded")
    first = F.when((F.col("type") == F.col("_declared")) & (F.col("type") != "concept"), F.lit(-1)).otherwise(F.col("kind_rank"))
    best = hits.groupBy(*id_cols).agg(F.min(F.struct(first.alias("p"), "type", "pref")).alias("b"))
    return best.select(*id_cols, F.concat(F.col("b.type"), F.lit(":"), folding(F.col("b.pref"))).alias("key"), F.col("b.pref").alias("label"), F.col("b.type").alias("type"))


def decompose(labels: DataFrame, forms: DataFrame, id_cols: list[str], text_col: str = "text", folding=fold_label, measures: tuple[str, ...] = MEASURES, conjunction: str = "و") -> DataFrame:
    """Concepts named by single words of a label: (id_cols, word_pos, key, pref), each key once, in order.

    A word is tried as it stands, then without a leading conjunction; measure words name nothing.
    """
    words = labels.select(*id_cols, F.posexplode(F.split(F.coalesce(text_col, F.lit("")), r"(?U)\s+")).alias("word_pos", "word")).where("word <> ''")
    stops = labels.sparkSession.createDataFrame([(m,) for m in measures] or [("",)], "m string").select(folding("m").alias("wf")).distinct()
    words = words.withColumn("wf", folding("word")).join(F.broadcast(stops), "wf", "left_anti")
    bare = F.when(F.col("word").startswith(conjunction) & (F.length("word") > 1), F.substring("word", 2, 1 << 30))
    tried = words.select(*id_cols, "word_pos", F.posexplode(F.array_compact(F.array("word", bare))).alias("form_no", "form")).withColumn("folded", folding("form"))
    hits = tried.join(forms.select("folded", "pref"), "folded")
    per_word = hits.groupBy(*id_cols, "word_pos").agg(F.min_by("pref", "form_no").alias("pref"))
    keyed = per_word.withColumn("key", F.concat(F.lit("concept:"), folding("pref")))
    return keep_first(keyed, [*id_cols, "key"], ["word_pos"]).select(*id_cols, "word_pos", "key", "pref")


def closure(broader: DataFrame, max_depth: int = 50) -> DataFrame:
    """(child, ancestor, depth): all ancestors of a multi-parent hierarchy, nearest first, cycles cut, none its own.

    Each round joins the frontier with the edges, and keeps pairs not seen; rounds are as many as the hierarchy is deep, and each is written so that the plan stays short.
    """
    edges = broader.toDF("child", "parent").where("child is not null and parent is not null and child <> parent").distinct()
    edges = materialize(edges, "broader")
    seen = frontier = materialize(edges.select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("depth")), "closure")
    step = edges.toDF("ancestor", "next")
    for depth in range(2, max_depth + 1):
        far = frontier.join(step, "ancestor").select("child", F.col("next").alias("ancestor")).where("child <> ancestor").distinct()
        frontier = materialize(far.join(seen, ["child", "ancestor"], "left_anti").withColumn("depth", F.lit(depth)), "closure")
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
    raise RuntimeError(f"hierarchy deeper than {max_depth}")


def narrator_identities(docs: DataFrame, entities: DataFrame, folding=fold_label) -> DataFrame:
    """(doc, folded): the surface of every narrator and the gazetteer names it stands for."""
    names = docs.select("doc", F.explode("ravis").alias("name")).select("doc", folding("name").alias("folded")).where("folded <> ''")
    known = names.join(entities.where(F.col("type").isin("person", "group")), "folded").select("doc", folding("pref").alias("folded"))
    return names.union(known).distinct()


def assign_roles(nodes: DataFrame, doc: str = "doc", max_nodes: int = MAX_NODES, max_primary: int = MAX_PRIMARY) -> DataFrame:
    """Node policy for rows (doc, pos, node, type, role, curated): each (node, type) once, the first ``max_nodes`` of a document, roles anew.

    Curated concepts win primary slots before other concepts, own marks break ties; without a concept marked entities hold them, else the first ones.
    """
    once = keep_first(nodes, [doc, "node", "type"], ["pos"])
    few = top_per(once, [doc], ["pos"], max_nodes, "n").drop("n")
    w = Window.partitionBy(doc)
    concept, marked = F.col("type") == "concept", F.col("role") == "primary"
    has = F.max(concept.cast("int")).over(w) == 1
    any_marked = F.max((marked & ~concept).cast("int")).over(w) == 1
    kind = F.when(concept & F.col("curated"), 0).when(concept, 1).otherwise(2)
    eligible = F.when(has, concept).when(any_marked, marked).otherwise(F.lit(True))
    ranked = few.withColumn("eligible", eligible).withColumn("k", kind).withColumn("m", F.when(marked, 0).otherwise(1))
    place = F.row_number().over(Window.partitionBy(doc, "eligible").orderBy("k", "m", "pos"))
    return ranked.withColumn("place", place).select(doc, "pos", "node", "type", F.when(F.col("eligible") & (F.col("place") <= max_primary), "primary").otherwise("secondary").alias("role"))


def resolve_nodes(nodes: DataFrame, forms: DataFrame, entities: DataFrame, strict: bool = True, folding=fold_label) -> DataFrame:
    """Rows (doc, pos, node, type, role) on catalog labels, with ``curated`` and ``repaired``; what names nothing goes.

    A catalog hit gives its label. Of labels that hit nothing, closed types (concept, group) are repaired to the first concept among their one to three words
    unless a later word is conjoined; open types stay if they are as short and their head isn't descriptive. A verse must read sura:number.
    """
    ids = ["doc", "pos"]
    n = nodes.select(*ids, F.trim(F.regexp_replace(F.coalesce("node", F.lit("")), r"(?U)\s+", " ")).alias("node"), "type", "role").where(F.col("node") != "").where(F.col("type").isin(*NODE_TYPES))
    n = n.withColumn("folded", folding("node"))
    concept = forms.select("folded", F.col("pref").alias("concept"))
    entity = entities.select("folded", "type", F.col("pref").alias("entity"))
    by_type = entities.groupBy("folded").agg(F.min(F.struct("type", "pref")).alias("other"))
    n = n.join(concept, "folded", "left").join(entity, ["folded", "type"], "left").join(by_type, "folded", "left")
    # the catalog overrides the declared type both ways
    kind = (
        F.when((F.col("type") == "concept") & F.col("concept").isNull() & F.col("other").isNotNull(), F.col("other.type"))
        .when(F.col("type").isin(*ENTITY_TYPES) & F.col("entity").isNull() & F.col("concept").isNotNull(), F.lit("concept"))
        .otherwise(F.col("type"))
    )
    n = n.withColumn("kind", kind)
    hit = F.when(F.col("kind") == "concept", F.col("concept")).when(F.col("kind") == F.col("type"), F.col("entity")).otherwise(F.col("other.pref"))
    words = F.split("node", " ")
    shaped = (F.size(words) <= 3) & ~F.exists(F.slice(words, 2, 99), lambda w: w.startswith("و"))
    n = n.withColumn("hit", hit).withColumn("shaped", shaped).withColumn("head", words[0]).withColumn("several", F.size(words) > 1)
    parts = decompose(n.where("hit is null and shaped and several"), forms, ids, "node", folding, conjunction="\0")
    return _with_repairs(n, parts, ids, strict)


def _with_repairs(n: DataFrame, parts: DataFrame, ids: list[str], strict: bool) -> DataFrame:
    closed = F.col("kind").isin("concept", "group") & F.lit(strict)
    open_ok = F.col("shaped") & ~F.col("head").isin(*BANNED_HEADS)
    label = (
        F.when(F.col("kind") == "ayah", F.when(F.col("node").rlike(r"^\d{1,3}:\d{1,3}$"), F.col("node")))
        .when(F.col("hit").isNotNull(), F.col("hit"))
        .when(closed, F.col("repair"))
        .when(open_ok, F.col("node"))
    )
    first = parts.groupBy(*ids).agg(F.min_by("pref", "word_pos").alias("repair"))
    out = n.join(first, ids, "left").withColumn("label", label).where("label is not null")
    return out.select(*ids, F.col("label").alias("node"), F.col("kind").alias("type"), "role", (F.col("hit").isNotNull() & (F.col("kind") == "concept")).alias("curated"), (F.col("hit").isNull() & closed).alias("repaired"))


def node_policy(nodes: DataFrame, forms: DataFrame, entities: DataFrame, docs: DataFrame | None = None, strict: bool = True, folding=fold_label) -> DataFrame:
    """Raw nodes (doc, pos, node, type, role) as records may keep them: (doc, pos, node, type, role, repaired).

    In order: known types alone; catalog labels or repairs (``resolve_nodes``); narrators of the record (``docs``: doc, ravis) go; each (label, type) once; the first six; roles anew, two primaries at most (``assign_roles``).
    """
    n = resolve_nodes(nodes, forms, entities, strict, folding)
    if docs is not None:
        told = narrator_identities(docs, entities, folding)
        n = n.withColumn("folded", folding("node")).join(told, ["doc", "folded"], "left_anti").drop("folded")
    policy = assign_roles(n)
    return policy.join(n.select("doc", "pos", "repaired"), ["doc", "pos"])


def remap_payloads(payloads: DataFrame, forms: DataFrame, entities: DataFrame, folding=fold_label) -> DataFrame:
    """(id, semantic_nodes) of the stored payloads (id, semantic_nodes, ravis, resolved) that the policy changes; resolved ones are left alone."""
    todo = payloads.where(~F.coalesce("resolved", F.lit(False)))
    raw = todo.select(F.col("id").alias("doc"), F.posexplode("semantic_nodes").alias("pos", "n")).select("doc", "pos", "n.node", "n.type", "n.role")
    kept = node_policy(raw, forms, entities, todo.select(F.col("id").alias("doc"), F.coalesce("ravis", F.array().cast("array<string>")).alias("ravis")), folding=folding)
    new = kept.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "node", "type", "role"))), lambda x: x.dropFields("pos")).alias("new"))  # six nodes at most
    none = F.array().cast("array<struct<node:string,type:string,role:string>>")
    both = todo.join(new, todo["id"] == new["doc"], "left").select("id", F.coalesce("semantic_nodes", none).alias("old"), F.coalesce("new", none).alias("semantic_nodes"))
    return both.where(F.to_json("old") != F.to_json("semantic_nodes")).select("id", "semantic_nodes")
