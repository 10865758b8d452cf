"""Citations: inverted joins on letter and root n-grams, and footnote references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.morphology import words_with_roots
from corpusloom.functions.text import fold_citation
from corpusloom.runtime import materialize

#: Letters of a block that windows are cut from.
BLOCK = 256


def letter_grams(df: DataFrame, id_col: str, text_col: str, n: int = 16, folding=fold_citation) -> DataFrame:
    """(id, pos, gram) for every window of ``n`` letters of the folded text without spaces."""
    t = df.select(F.col(id_col).alias("id"), F.replace(folding(text_col), F.lit(" "), F.lit("")).alias("t")).where(F.length("t") >= n)
    # a substring is found by walking from the start: cut blocks first, so that long texts aren't walked for every window
    cut = t.select("id", "t", F.explode(F.sequence(F.lit(1), F.length("t") - n + 1, F.lit(BLOCK))).alias("from"))
    b = cut.select("id", "from", F.col("t").substr(F.col("from"), F.lit(BLOCK + n - 1)).alias("b"))
    at = b.select("id", "from", "b", F.explode(F.sequence(F.lit(1), F.length("b") - n + 1)).alias("i"))
    return at.select("id", (F.col("from") + F.col("i") - 1).alias("pos"), F.col("b").substr(F.col("i"), F.lit(n)).alias("gram"))


def letter_hits(df: DataFrame, id_col: str, text_col: str, index: DataFrame, n: int = 16, folding=fold_citation) -> DataFrame:
    """(id, gram) for the windows of ``n`` letters that may be in ``index`` (gram, ...): all that are, and few others.

    Any window holds one whole half-window that begins at a multiple of ``n`` - n/2 + 1 letters. So only every such half-window is cut from the text, with the letters around it, and
    looked up among the index's half-windows; the windows about those that are there are cut next. A text is passed on as 24 letters for every 9, not as 16 for every one.
    """
    half = n // 2
    step, reach = n - half + 1, 2 * n - half
    pad, block = " " * (n - half), step * 28
    t = df.select(F.col(id_col).alias("id"), F.replace(folding(text_col), F.lit(" "), F.lit("")).alias("t")).where(F.length("t") >= n)
    t = t.select("id", F.concat(F.lit(pad), "t", F.lit(" " * reach)).alias("t"))  # no gram has a space
    cut = t.select("id", "t", F.explode(F.sequence(F.lit(1), F.length("t") - reach, F.lit(block))).alias("from"))
    b = cut.select("id", F.col("t").substr(F.col("from"), F.lit(block + reach - step)).alias("b"))
    at = b.select("id", "b", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("b") - reach + 1), F.lit(step))).alias("i"))
    near = at.select("id", F.col("b").substr(F.col("i"), F.lit(reach)).alias("near")).withColumn("half", F.col("near").substr(n - half + 1, half))
    halves = index.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(n - half + 1)), lambda i: F.col("gram").substr(i, F.lit(half)))).alias("half")).distinct()
    hit = near.join(halves, "half", "left_semi")
    grams = F.transform(F.sequence(F.lit(1), F.lit(step)), lambda i: F.col("near").substr(i, F.lit(n)))
    return hit.select("id", F.explode(grams).alias("gram")).where(~F.contains("gram", F.lit(" ")) & (F.length("gram") == n))


def sequence_grams(df: DataFrame, id_col: str, items: Column, n: int = 4) -> DataFrame:
    """(id, pos, gram) for every window of ``n`` items of an array."""
    t = df.select(F.col(id_col).alias("id"), items.alias("x")).where(F.size("x") >= n)
    at = t.select("id", "x", F.explode(F.sequence(F.lit(1), F.size("x") - n + 1)).alias("pos"))
    return at.select("id", "pos", F.array_join(F.slice("x", F.col("pos"), n), " ").alias("gram"))


def best_matches(grams: DataFrame, index: DataFrame, most: int = 3) -> DataFrame:
    """(id, ref, weight): for each text the references with most matching windows; ties all count, ``most`` at most, in order of (sura, ayah).

    ``index``: distinct (gram, ref, sura, ayah). The join is on the gram: texts that share none never meet.
    """
    hits = grams.join(index, "gram").groupBy("id", "ref", "sura", "ayah").agg(F.count(F.lit(1)).alias("weight"))
    w = Window.partitionBy("id")
    top = hits.withColumn("best", F.max("weight").over(w)).where("weight = best")
    order = Window.partitionBy("id").orderBy("sura", "ayah", "ref")
    return top.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most).select("id", "ref", "weight", "n")


def gram_index(verses: DataFrame, n: int = 16, folding=fold_citation) -> DataFrame:
    """Distinct (gram, ref, sura, ayah) of a verse table (ref, sura, ayah, text)."""
    g = letter_grams(verses, "ref", "text", n, folding).select(F.col("id").alias("ref"), "gram").distinct()
    return g.join(verses.select("ref", "sura", "ayah"), "ref")


def _root_grams(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    words = words_with_roots(df, id_col, text_col).where(F.length("root") >= 2)
    seq = words.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "root"))), lambda x: x["root"]).alias("roots"))
    return sequence_grams(seq, "id", F.col("roots"), n)


def root_index(verses: DataFrame, n: int = 4) -> DataFrame:
    g = _root_grams(verses, "ref", "text", n).select(F.col("id").alias("ref"), "gram").distinct()
    return g.join(verses.select("ref", "sura", "ayah"), "ref")


def match_verses(texts: DataFrame, verses: DataFrame, id_col: str = "id", text_col: str = "text", letters: int = 16, roots: int = 4) -> DataFrame:
    """(id, refs): verbatim matches first, then matches by roots, each once."""
    index = materialize(gram_index(verses, letters), "gram-index")
    a = best_matches(letter_hits(texts, id_col, text_col, index, letters), index).withColumn("tier", F.lit(0))
    b = best_matches(_root_grams(texts, id_col, text_col, roots), root_index(verses, roots)).withColumn("tier", F.lit(1))
    both = a.unionByName(b).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("tier", "n", "ref"))).alias("x"))
    return both.select("id", F.array_distinct(F.transform("x", lambda r: r["ref"])).alias("refs"))


#: Fixed pattern: a note that opens with a name and a verse number.
NOTE_REF = r"^\s*(?:\[\d{1,3}\]\s*)?([؀-ۿ][؀-ۿ\s]{0,24}?)\s*[:：،,\-]?\s*(\d{1,3})(?!\d)"


def note_refs(notes: DataFrame, suras: DataFrame, body_col: str = "body") -> DataFrame:
    """``notes`` with ref ``sura:ayah`` where the note opens with a known chapter name and a verse that the chapter has; else null.

    ``suras``: name, number, verses; several names may share a number.
    """
    names = suras.select(fold_citation("name").alias("folded"), "number", "verses").groupBy("folded").agg(F.min(F.struct("number", "verses")).alias("s"))
    name = fold_citation(F.regexp_replace(F.regexp_extract(body_col, NOTE_REF, 1), r"^(?:سورة|سوره|سورهٔ)\s+", ""))
    n = notes.withColumn("folded", name).withColumn("_ayah", F.expr("try_cast(regexp_extract(" + body_col + ", r'" + NOTE_REF.replace("'", "\\'") + "', 2) as int)"))
    ok = F.col("_ayah").between(F.lit(1), F.col("s.verses"))
    return n.join(names, "folded", "left").withColumn("ref", F.when(ok, F.concat_ws(":", "s.number", "_ayah"))).drop("folded", "_ayah", "s")


def page_refs(lines: DataFrame, notes: DataFrame, matches: DataFrame) -> DataFrame:
    """(page, segment, refs): the references of each narration on a page: those of its inline markers' notes first, then matched ones.

    ``lines``: page, segment, pos, text of the body; ``notes``: page, num, ref; ``matches``: page, segment, refs in order.
    """
    marks = lines.select("page", "segment", "pos", F.posexplode(F.regexp_extract_all("text", F.lit(r"\[(\d{1,3})\]"), F.lit(1))).alias("k", "num"))
    cited = marks.join(notes.where("ref is not null"), ["page", "num"]).groupBy("page", "segment").agg(F.array_sort(F.collect_list(F.struct("pos", "k", "ref"))).alias("x"))
    none = F.array().cast("array<string>")
    both = cited.select("page", "segment", F.transform("x", lambda r: r["ref"]).alias("a")).join(matches, ["page", "segment"], "full")
    refs = F.array_distinct(F.concat(F.coalesce("a", none), F.coalesce("refs", none)))
    return both.select("page", "segment", refs.alias("refs")).where(F.size("refs") > 0)
