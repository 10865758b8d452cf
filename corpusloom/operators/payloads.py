"""Views of one extracted record: its items, text to embed, nodes and bucket keys, and what it still lacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import translation_incomplete
from corpusloom.operators.pages import section_nodes

PRIMARY_WEIGHT = 0.6


def _strings() -> Column:
    return F.array().cast("array<string>")


def embeddable(page: Column, page_start: Column, items: Column) -> Column:
    """A flushed record, not an older page array."""
    return ~((F.coalesce(page, F.lit("")) != "") & items.isNotNull() & (F.coalesce(page_start, F.lit("")) == ""))


def embed_text(pipeline: Column, text: Column, bodies: Column, tafsir: Column, summary: Column, event_titles: Column) -> Column:
    """Text to embed, by pipeline: the narrations' bodies, the comment or its summary, the events' titles; the raw text where these are empty."""

    def joined(items: Column, sep: str) -> Column:
        return F.array_join(F.filter(F.coalesce(items, _strings()), lambda x: F.coalesce(x, F.lit("")) != ""), sep)

    own = (
        F.when(pipeline == "hadith", joined(bodies, "\n\n"))
        .when(pipeline == "tafsir", F.coalesce(F.nullif(tafsir, F.lit("")), summary, F.lit("")))
        .when(pipeline == "history", joined(event_titles, "\n"))
        .otherwise(F.lit(""))
    )
    return F.coalesce(F.nullif(own, F.lit("")), text)


def preview(text: Column, chars: int = 4000) -> Column:
    return F.substring(text, 1, chars)


def needs_enrichment(page_start: Column, page_end: Column, translation: Column, n_topics: Column, n_narrators: Column) -> Column:
    """A record over several pages, with an unfinished translation, fewer than two topics or no narrators."""
    return (page_start != page_end) | translation_incomplete(translation) | (n_topics < 2) | (n_narrators == 0)


def resolved_nodes(nodes: Column) -> Column:
    """array<struct<key, label, type, weight, role, parent, broader>>: each key once, primary from a weight of 0.6 on."""
    named = F.filter(nodes, lambda n: F.coalesce(F.trim(n["key"]), F.lit("")) != "")
    keys = F.transform(named, lambda n: n["key"])
    first = F.filter(named, lambda n, i: F.array_position(keys, n["key"]) == i + 1)
    return F.transform(first, lambda n: n.withField("role", F.when(n["weight"] >= PRIMARY_WEIGHT, "primary").otherwise("secondary")))


def graph_nodes(nodes: Column, legacy: Column) -> Column:
    """Resolved nodes if there are any, else the older fields' (struct<type, node, role>)."""
    slim = F.transform(resolved_nodes(nodes), lambda n: F.struct(n["type"].alias("type"), n["label"].alias("node"), n["role"].alias("role")))
    return F.when(F.size(nodes) > 0, slim).otherwise(legacy)


def bucket_eligible(kind: Column, role: Column) -> Column:
    """Concepts always, entities only as primaries."""
    return (kind == "concept") | (role == "primary")


def bucket_keys(nodes: Column, kitab: Column, bab: Column) -> Column:
    """Keys under which records are compared: node, parent and broader keys, and the chapter, never the book; each once, in order."""
    n = resolved_nodes(nodes)
    own = F.flatten(F.transform(F.filter(n, lambda x: bucket_eligible(x["type"], x["role"])), lambda x: F.array_compact(F.concat(F.array(x["key"], x["parent"]), F.coalesce(x["broader"], _strings())))))
    chapter = F.transform(F.filter(section_nodes(kitab, bab), lambda s: s["type"] == "bab"), lambda s: F.concat(F.lit("bab:"), s["node"]))
    return F.array_distinct(F.concat(F.coalesce(own, _strings()), chapter))
