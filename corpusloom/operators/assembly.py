"""Ordered assembly: records that run over pages, and greedy packing of neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.text import norm_marker, span_locator
from corpusloom.operators import resolver
from corpusloom.operators.pages import continues, page_parts
from corpusloom.runtime import ship


def accumulate(fragments: DataFrame, keys: list[str], order: list[str], is_start: Column, closes: Column | None = None) -> DataFrame:
    """``fragments`` with session and record numbers: a start opens a record, what follows belongs to it, ``closes`` ends a session after its row.

    Fragments of a session before its first start belong to no record (record_no 0) and are dropped.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    closed = F.lit(0) if closes is None else closes.cast("int")
    f = fragments.withColumn("_start", is_start.cast("int")).withColumn("_closes", closed)
    f = f.withColumn("session", F.sum(F.coalesce(F.lag("_closes").over(w), F.lit(0))).over(so_far))
    inside = Window.partitionBy(*keys, "session").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return f.withColumn("record_no", F.sum("_start").over(inside)).where("record_no > 0").drop("_start", "_closes")


def numbered_pieces(pages: DataFrame, keep: Column | None = None, file: str = "source_path", seq: str = "unit_seq") -> DataFrame:
    """Pieces (file, seq, pos, piece struct<token, body>, locator) of paged text with session and record_no.

    Leading text of a page goes to the record that is open; a numbered start closes it and opens the next; the last one stays open only if the
    next page goes on. Pages that ``keep`` leaves out are still looked at as next pages.
    """
    w = Window.partitionBy(file).orderBy(seq)
    p = pages.withColumn("_next", F.coalesce(continues(F.lead("text").over(w)), F.lit(False)))
    p = p.where(keep) if keep is not None else p
    p = p.withColumn("_parts", page_parts(F.col("text")))
    leading = F.filter(F.array(F.struct(F.lit(None).cast("string").alias("token"), F.col("_parts.leading").alias("body"))), lambda x: x["body"] != "")
    starts = F.transform("_parts.starts", lambda s: F.struct(s["token"].alias("token"), s["body"].alias("body")))
    pieces = p.withColumn("_pieces", F.concat(leading, starts))
    last = F.size("_pieces") - 1
    f = pieces.select(file, seq, "locator", "_next", last.alias("_last"), F.posexplode_outer("_pieces").alias("pos", "piece"))
    f = f.withColumn("_end", ~F.col("_next") & ((F.col("pos") == F.col("_last")) | F.col("pos").isNull()))
    f = f.withColumn("pos", F.coalesce("pos", F.lit(0)))
    return accumulate(f, [file], [seq, "pos"], F.col("piece.token").isNotNull(), F.col("_end")).where("piece is not null")


def assemble_pages(pages: DataFrame, keep: Column | None = None, file: str = "source_path", seq: str = "unit_seq") -> DataFrame:
    """Narrations of paged text: (file, session, record_no, marker, page_start, page_end, text)."""
    numbered = numbered_pieces(pages, keep, file, seq)
    parts = F.array_sort(F.collect_list(F.struct(seq, "pos", F.col("piece.body").alias("body"), "locator")))
    g = numbered.groupBy(file, "session", "record_no").agg(F.max("piece.token").alias("marker"), parts.alias("parts"))
    return g.select(
        file, "session", "record_no", "marker",
        F.col("parts")[0]["locator"].alias("page_start"), F.element_at("parts", -1)["locator"].alias("page_end"),
        F.array_join(F.transform("parts", lambda x: x["body"]), "\n").alias("text"),
    )


#: What a model gives for one numbered piece of a page.
ITEM = (
    "marker string, hadith string, hadith_fa string, hadith_en string, ravis array<string>, proposed_nodes array<string>,"
    " mentions array<struct<text:string,type:string,salience:double,evidence:string>>, quotes array<struct<text:string,kind:string>>"
)


def item_of(items: Column, token: Column) -> Column:
    """The model's item for a piece: that of its marker; text without a marker goes on with an item that says so, else with the page's first; null if there is none."""
    marker = lambda x: norm_marker(x["marker"])
    goes_on = F.filter(items, lambda x: marker(x).isin("", "continuation"))
    same = F.filter(items, lambda x: marker(x) == norm_marker(token))
    return F.when(token.isNull(), F.coalesce(F.get(goes_on, F.lit(0)), F.get(items, F.lit(0)))).otherwise(F.get(same, F.lit(0)))


def union_mentions(mentions: Column) -> Column:
    """Each (text, type) once, in order: the greatest salience and the first evidence that isn't empty."""
    kind = lambda m: F.coalesce(m["type"], F.lit("concept"))
    named = lambda m: F.struct(F.coalesce(m["text"], F.lit("")).alias("text"), kind(m).alias("type"))

    def merged(k: Column) -> Column:
        own = F.filter(mentions, lambda m: named(m) == k)
        said = F.filter(F.transform(own, lambda m: m["evidence"]), lambda e: F.coalesce(e, F.lit("")) != "")
        return F.struct(k["text"].alias("text"), k["type"].alias("type"), F.array_max(F.transform(own, lambda m: m["salience"])).alias("salience"), F.coalesce(F.get(said, F.lit(0)), F.lit("")).alias("evidence"))

    return F.transform(F.array_distinct(F.transform(mentions, named)), merged)


def assemble_records(pages: DataFrame, items: DataFrame, refs: DataFrame | None = None, keep: Column | None = None, file: str = "source_path", seq: str = "unit_seq") -> DataFrame:
    """Narrations with what a model said of their pages, over all pages that they run through.

    ``items``: (file, seq, item_no and the columns of ``ITEM``); ``refs``: (file, seq, pos, refs array), verses cited by the pieces. One row a record: marker, locator, page_start, page_end, hadith,
    hadith_fa, hadith_en, ravis (the first page's that has any), quran_refs and proposed_nodes (each once, in order), mentions (``union_mentions``) and quotes (by text). A piece without text takes its item's.
    """
    numbered = numbered_pieces(pages, keep, file, seq)
    cols = [c.split()[0] for c in ITEM.split(", ")]
    by_page = items.groupBy(file, seq).agg(F.array_sort(F.collect_list(F.struct("item_no", *cols))).alias("items"))  # the items of one page
    met = numbered.join(by_page, [file, seq], "left").withColumn("item", item_of(F.col("items"), F.col("piece.token")))
    met = met.join(refs.select(file, seq, "pos", "refs"), [file, seq, "pos"], "left") if refs is not None else met.withColumn("refs", F.lit(None).cast("array<string>"))
    body = F.coalesce(F.nullif("piece.body", F.lit("")), "item.hadith", F.lit(""))
    parts = F.array_sort(F.collect_list(F.struct(seq, "pos", body.alias("body"), "locator", "item", "refs")))  # one record's pieces
    g = met.groupBy(file, "session", "record_no").agg(F.max("piece.token").alias("marker"), parts.alias("p"))

    def joined(pick) -> Column:
        return F.trim(F.array_join(F.filter(F.transform("p", pick), lambda x: F.coalesce(x, F.lit("")) != ""), "\n"))

    def flat(pick, kind: str) -> Column:
        return F.flatten(F.transform("p", lambda x: F.coalesce(pick(x), F.array().cast(kind))))

    strings, quotes = "array<string>", flat(lambda x: x["item"]["quotes"], "array<struct<text:string,kind:string>>")
    said = F.array_distinct(F.transform(quotes, lambda q: q["text"]))
    told = F.filter(F.transform("p", lambda x: x["item"]["ravis"]), lambda r: F.size(r) > 0)
    g = g.withColumns({"page_start": F.col("p")[0]["locator"], "page_end": F.element_at("p", -1)["locator"], "all": flat(lambda x: x["item"]["mentions"], "array<struct<text:string,type:string,salience:double,evidence:string>>"), "said": quotes})
    return g.select(
        file, "session", "record_no", "marker", span_locator(F.col("page_start"), F.col("page_end")).alias("locator"), "page_start", "page_end",
        joined(lambda x: x["body"]).alias("hadith"), joined(lambda x: x["item"]["hadith_fa"]).alias("hadith_fa"), joined(lambda x: x["item"]["hadith_en"]).alias("hadith_en"),
        F.coalesce(F.get(told, F.lit(0)), F.array().cast(strings)).alias("ravis"),
        F.array_distinct(flat(lambda x: x["refs"], strings)).alias("quran_refs"),
        F.array_distinct(F.filter(flat(lambda x: x["item"]["proposed_nodes"], strings), lambda t: F.coalesce(F.trim(t), F.lit("")) != "")).alias("proposed_nodes"),
        union_mentions(F.col("all")).alias("mentions"),
        F.transform(said, lambda t: F.get(F.filter("said", lambda q: q["text"] == t), F.lit(0))).alias("quotes"),
    )


def ground_records(records: DataFrame, folding, entities: DataFrame | None = None, file: str = "source_path") -> DataFrame:
    """``records`` with the mentions that their whole text supports: a narration over two pages is judged by both. Narrators, by their own names or those that ``entities`` (type, folded, pref) gives them, are no mentions."""
    key = [file, "session", "record_no"]
    at = records.select(*key, F.xxhash64(*key).alias("doc"), F.col("hadith").alias("body"), F.transform("quotes", lambda q: q["text"]).alias("quotes"), "ravis", F.posexplode("mentions").alias("pos", "m"))
    m = at.select(*key, "doc", "pos", "body", "quotes", "m.*")
    names = records.select(F.xxhash64(*key).alias("doc"), F.explode("ravis").alias("name")).select("doc", folding("name").alias("folded")).where("folded <> ''")
    if entities is not None:
        known = names.join(entities.where(F.col("type").isin("person", "group")), "folded").select("doc", folding("pref").alias("folded"))
        names = names.union(known)
    told = names.distinct().withColumn("is_narrator", F.lit(True))
    m = m.withColumn("folded", folding("text")).join(told, ["doc", "folded"], "left")
    kept = resolver.ground(m, folding).where("reason is null").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "text", "type", "salience", "evidence"))).alias("_kept"))
    none = F.array().cast("array<struct<text:string,type:string,salience:double,evidence:string>>")
    left = F.coalesce(F.transform("_kept", lambda x: x.dropFields("pos")), none)
    return records.join(kept, key, "left").withColumn("mentions", left).drop("_kept")


def close_with_page(open_records: DataFrame, page: DataFrame, file: str = "source_path") -> DataFrame:
    """Records left open (file, marker, page_start, page_end, text), each ended by the leading text of its file's next page (file, locator, text), whatever follows there."""
    nxt = page.select(file, F.col("locator").alias("_at"), page_parts(F.col("text"))["leading"].alias("_more"))
    both = open_records.join(nxt, file, "left").withColumn("_goes", F.coalesce(F.col("_more"), F.lit("")) != "")
    return both.withColumns({"text": F.when(F.col("_goes"), F.concat_ws("\n", "text", "_more")).otherwise(F.col("text")), "page_end": F.when(F.col("_goes"), F.col("_at")).otherwise(F.col("page_end"))}).drop("_at", "_more", "_goes")


def pack_greedy(units: DataFrame, keys: list[str], order: list[str], text_col: str, max_items: int, max_chars: int, locator_col: str | None = None) -> DataFrame:
    """``units`` with pack_no: consecutive units share a pack until it holds ``max_items`` or the next would pass ``max_chars``.

    Sequential by nature, within a key. A sorted partition is walked once with constant state; a key never leaves its task, and no key is gathered in memory.
    """
    ship(units.sparkSession)
    fields = list(units.columns)
    at = {c: fields.index(c) for c in [*keys, text_col]}
    ordered = units.repartition(*keys).sortWithinPartitions(*keys, *order)
    schema = units.schema.simpleString()[7:-1] + ", pack_no:int"

    def walk(batches):
        import pyarrow as pa

        key, pack, n, size = None, 0, 0, 0
        for b in batches:
            packs = []
            cols = [b.column(at[k]).to_pylist() for k in keys]
            lengths = [len(t or "") for t in b.column(at[text_col]).to_pylist()]
            for i, length in enumerate(lengths):
                now = tuple(c[i] for c in cols)
                if now != key:
                    key, pack, n, size = now, 0, 0, 0
                elif n >= max_items or size + length > max_chars:
                    pack, n, size = pack + 1, 0, 0
                n, size = n + 1, size + length
                packs.append(pack)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(packs, pa.int32())], names=[*b.schema.names, "pack_no"])

    return ordered.mapInArrow(walk, schema)


def merge_packs(packed: DataFrame, keys: list[str], order: str, text_col: str, locator_col: str) -> DataFrame:
    """One row a pack: texts joined by blank lines, locator ``first … last``."""
    items = F.array_sort(F.collect_list(F.struct(order, F.col(locator_col).alias("l"), F.col(text_col).alias("t"))))
    g = packed.groupBy(*keys, "pack_no").agg(items.alias("i"))
    return g.select(*keys, "pack_no", span_locator(F.col("i")[0]["l"], F.element_at("i", -1)["l"]).alias("locator"), F.array_join(F.transform("i", lambda x: x["t"]), "\n\n").alias("text"))
