"""Property-graph export: typed node and edge tables, without duplicates and without dangling ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.pages import section_nodes
from corpusloom.runtime import write_text

EDGE_OF_TYPE = {"concept": "HAS_CONCEPT", "ayah": "CITES", "kitab": "IN_KITAB", "bab": "IN_BAB"}


def node(df: DataFrame, label: str, id_col: Column, name: Column) -> DataFrame:
    return df.select(id_col.cast("string").alias("id"), F.lit(label).alias("label"), name.cast("string").alias("name"))


def edge(df: DataFrame, kind: str | Column, src: Column, dst: Column, score: Column | None = None, role: Column | None = None, locator: Column | None = None, book: Column | None = None) -> DataFrame:
    """Edges with the properties that their kind has; the others are null."""
    k = F.lit(kind) if isinstance(kind, str) else kind
    own = lambda c, t: (F.lit(None) if c is None else c).cast(t)
    return df.select(src.cast("string").alias("src"), k.alias("kind"), dst.cast("string").alias("dst"), own(score, "double").alias("score"), own(role, "string").alias("role"), own(locator, "string").alias("locator"), own(book, "string").alias("book_id"))


def union_distinct(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union with one row a key; of equal keys the smallest remaining columns, so that the choice is defined."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    rest = [c for c in out.columns if c not in keys]
    g = out.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("x")) if rest else out.distinct()
    return g.select(*keys, *[F.col(f"x.{c}").alias(c) for c in rest]) if rest else g


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of which an end has no node."""
    ends = edges.select("src", "kind", "dst", F.explode(F.array("src", "dst")).alias("end"))
    return ends.join(nodes.select(F.col("id").alias("end")), "end", "left_anti").select("src", "kind", "dst", "end")


def export_graph(chunks: DataFrame, doc_nodes: DataFrame, verdicts: DataFrame, narrators: DataFrame | None = None, citations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the property graph.

    ``chunks``: id, book_id, locator, pipeline, canonical_id, anchor and, where known, kitab and bab; ``doc_nodes``: id, key, label, type and, where known, role; ``verdicts``: left_id, right_id, relation,
    score; ``narrators``: id, name; ``citations``: id, ref. A narration that repeats another appears in its place (APPEARS_IN, with the place's locator and book); commentary hangs on its verse;
    sections that name no subject make no node.
    """
    for c in ("kitab", "bab"):
        chunks = chunks if c in chunks.columns else chunks.withColumn(c, F.lit(None).cast("string"))
    doc_nodes = doc_nodes if "role" in doc_nodes.columns else doc_nodes.withColumn("role", F.lit(None).cast("string"))
    typed = doc_nodes.select("id", "type", "label", "role", F.concat_ws(":", "type", "label").alias("node_id"))
    kind = F.coalesce(*[F.when(F.col("type") == t, F.lit(k)) for t, k in EDGE_OF_TYPE.items()], F.lit("MENTIONS"))
    dup = chunks.where("pipeline = 'hadith' and canonical_id is not null and canonical_id <> id")
    anchored = chunks.where("pipeline = 'tafsir' and anchor is not null and anchor <> ''")
    sections = chunks.select("id", F.explode(section_nodes(F.col("kitab"), F.col("bab"))).alias("s")).select("id", "s.type", "s.node", F.concat_ws(":", "s.type", "s.node").alias("node_id"))
    book, verse = F.concat(F.lit("book:"), F.col("book_id")), F.concat(F.lit("ayah:"), F.col("anchor"))
    nodes = [
        node(chunks, "Chunk", F.col("id"), F.col("locator")),
        node(chunks, "Book", book, F.col("book_id")),
        typed.select(F.col("node_id").alias("id"), F.initcap("type").alias("label"), F.col("label").alias("name")),
        sections.select(F.col("node_id").alias("id"), F.initcap("type").alias("label"), F.col("node").alias("name")),
        node(anchored, "Ayah", verse, F.col("anchor")),
    ]
    edges = [
        edge(typed, kind, F.col("id"), F.col("node_id"), role=F.col("role")),
        edge(sections, F.when(F.col("type") == "kitab", "IN_KITAB").otherwise("IN_BAB"), F.col("id"), F.col("node_id")),
        edge(chunks, "IN_BOOK", F.col("id"), book),
        edge(anchored, "COMMENTS_ON", F.col("id"), verse),
        edge(dup, "APPEARS_IN", F.col("canonical_id"), F.col("id"), locator=F.col("locator"), book=F.col("book_id")),
        edge(verdicts.where("relation <> 'UNRELATED'"), F.col("relation"), F.col("left_id"), F.col("right_id"), F.col("score")),
    ]
    if citations is not None:
        cited = citations.where("ref is not null and ref <> ''")
        ref = F.concat(F.lit("ayah:"), F.col("ref"))
        nodes.append(node(cited, "Ayah", ref, F.col("ref")))
        edges.append(edge(cited, "CITES", F.col("id"), ref))
    if narrators is not None:
        who = F.concat(F.lit("narrator:"), F.col("name"))
        nodes.append(node(narrators, "Narrator", who, F.col("name")))
        edges.append(edge(narrators, "NARRATED_BY", F.col("id"), who))
    return union_distinct(nodes, ["id"]), union_distinct(edges, ["src", "kind", "dst"])


# Fixed text: statements that load the two tables into a property-graph store.
IMPORT_SCRIPT = """// nodes and edges are folders of JSON lines; load each file in turn
CREATE CONSTRAINT node_id IF NOT EXISTS FOR (n:Node) REQUIRE n.id IS UNIQUE;
CALL apoc.periodic.iterate('CALL apoc.load.json($nodes) YIELD value', 'MERGE (n:Node {id: value.id}) SET n.name = value.name WITH n, value CALL apoc.create.addLabels(n, [value.label]) YIELD node RETURN count(*)', {params: {nodes: $nodes}, batchSize: 10000});
CALL apoc.periodic.iterate('CALL apoc.load.json($edges) YIELD value', 'MATCH (a:Node {id: value.src}), (b:Node {id: value.dst}) CALL apoc.merge.relationship(a, value.kind, {}, {score: value.score, role: value.role, locator: value.locator, book_id: value.book_id}, b, {}) YIELD rel RETURN count(*)', {params: {edges: $edges}, batchSize: 10000});
"""


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Folders nodes and edges of JSON lines, and import.cypher."""
    nodes.write.json(f"{path}/nodes")
    edges.write.json(f"{path}/edges")
    write_text(nodes.sparkSession, f"{path}/import.cypher", IMPORT_SCRIPT)
