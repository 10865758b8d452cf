"""File sources. Every reader returns rows with explicit order columns (source_path, unit_seq)."""

from __future__ import annotations

import html.entities
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import squeeze
from corpusloom.runtime import ship, write_text

UNIT = "source_path string, unit_seq int, locator string, text string"
#: Superset of the payload shapes that extraction has written over time.
PAYLOAD = (
    "page string, marker string, locator string, page_start string, page_end string, hadith string, hadith_fa string, hadith_en string,"
    " mentions array<struct<text:string,type:string,salience:string,evidence:string>>, quotes array<struct<text:string,kind:string>>,"
    " nodes array<struct<key:string,label:string,type:string,weight:double,parent:string,broader:array<string>>>,"
    " ravis array<string>, quran_refs array<string>, proposed_nodes array<string>, kitab string, bab string,"
    " semantic_nodes array<struct<node:string,type:string,role:string>>, ayah_anchor string, core_concepts array<string>, tafsir_chunk string, summary_fa string,"
    " events array<struct<event_title:string,mentions:array<struct<text:string,type:string,salience:string,evidence:string>>,characters_involved:array<string>,historical_concepts:array<string>,historical_chunk:string>>"
)


def split_banners(text: Column) -> Column:
    """array<struct<locator, text>> of the parts of a text after each ``---[locator]---`` line; blank parts go, what stands before the first banner too."""
    parts = F.split(text, r"---\[")
    sections = F.transform(
        F.filter(F.slice(parts, 2, 1 << 30), lambda p: F.contains(p, F.lit("]---"))),
        lambda p: F.struct(
            squeeze(F.substring_index(p, "]---", 1)).alias("locator"),
            F.regexp_replace(F.regexp_replace(p, r"(?s)^.*?\]---", ""), r"(?U)^\s+|\s+$", "").alias("text"),
        ),
    )
    return F.filter(sections, lambda s: s["text"] != "")


def units_of_texts(files: DataFrame, path_col: str = "path", text_col: str = "content") -> DataFrame:
    """Units of whole text files. A file without banners is one unit named after the file."""
    stem = F.regexp_replace(F.substring_index(F.col(path_col), "/", -1), r"\.[^.]*$", "")
    body = F.regexp_replace(F.coalesce(text_col, F.lit("")), r"(?U)^\s+|\s+$", "")
    whole = F.filter(F.array(F.struct(stem.alias("locator"), body.alias("text"))), lambda s: s["text"] != "")
    has = F.coalesce(F.col(text_col), F.lit("")).rlike(r"---\[[^\]]*\]---")
    units = F.when(has, split_banners(F.col(text_col))).otherwise(whole)
    rows = files.select(F.col(path_col).alias("source_path"), F.posexplode(units).alias("unit_seq", "u"))
    return rows.select("source_path", "unit_seq", "u.locator", "u.text")


def read_texts(spark: SparkSession, *paths: str) -> DataFrame:
    files = spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    return units_of_texts(files)


def decode_entities(c: Column) -> Column:
    """Character references, named, decimal or hexadecimal, as their characters, each once; unknown names stay, impossible code points become U+FFFD."""
    # HTML 4 names, by the standard library; the five of markup are among them but for the apostrophe
    names = F.create_map(*[F.lit(x) for name, point in sorted((html.entities.name2codepoint | {"apos": 39}).items()) for x in (name, chr(point))])
    reference = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"

    def char(r: Column) -> Column:
        number = F.when(r.rlike("^#[xX]"), F.conv(F.substring(r, 3, 9), 16, 10)).when(r.startswith("#"), F.substring(r, 2, 9)).try_cast("int")
        real = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        point = F.decode(F.unhex(F.lpad(F.hex(F.when(real, number).otherwise(F.lit(0xFFFD)).cast("long")), 8, "0")), "UTF-32")
        return F.when(r.startswith("#"), point).otherwise(F.coalesce(F.try_element_at(names, r), F.concat(F.lit("&"), r, F.lit(";"))))

    found = F.transform(F.regexp_extract_all(c, F.lit(reference), F.lit(1)), char)
    both = F.arrays_zip(F.split(c, reference, -1).alias("t"), F.concat(found, F.array(F.lit(""))).alias("e"))
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(both, lambda x: F.concat(x["t"], x["e"])), "")).otherwise(c)


def strip_html(c: Column) -> Column:
    """Text of HTML: scripts and styles go, tags become line breaks, lines are trimmed and blank ones dropped, character references decoded."""
    t = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>", "")
    t = decode_entities(F.regexp_replace(t, r"(?s)<!--.*?-->|<[^>]*>", "\n"))
    lines = F.filter(F.transform(F.split(t, r"\r?\n"), lambda x: F.regexp_replace(x, r"(?U)^[\s\u00a0]+|[\s\u00a0]+$", "")), lambda x: x != "")
    return F.array_join(lines, "\n")


def html_heading(c: Column) -> Column:
    """Text of the first h1, h2 or h3; empty if there is none."""
    h = F.regexp_extract(c, r"(?is)<h([123])\b[^>]*>(.*?)</h\1\s*>", 2)
    return squeeze(F.replace(strip_html(h), F.lit("\n"), F.lit(" ")))


def read_epubs(spark: SparkSession, *paths: str) -> DataFrame:
    """One unit per XHTML document of each EPUB, in the order of the archive; the locator is its first heading, else its name. Files that aren't archives give no units."""
    ship(spark)
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")

    def unzip(batches):
        import io
        import zipfile

        import pandas as pd

        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue
                names = [n for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm"))]
                out += [(path, i, n, z.read(n).decode("utf-8", "replace")) for i, n in enumerate(names)]
            yield pd.DataFrame(out, columns=["source_path", "item", "name", "html"])

    items = files.mapInPandas(unzip, "source_path string, item int, name string, html string")
    heading, body = html_heading(F.col("html")), strip_html(F.col("html"))
    kept = items.select("source_path", "item", F.coalesce(F.nullif(heading, F.lit("")), "name").alias("locator"), body.alias("text")).where("text <> ''")
    return kept.select("source_path", F.col("item").alias("unit_seq"), "locator", "text")


def read_units(spark: SparkSession, *paths: str) -> DataFrame:
    """Dispatch by suffix."""
    epubs = [p for p in paths if p.lower().endswith(".epub")]
    texts = [p for p in paths if p not in epubs]
    parts = ([read_texts(spark, *texts)] if texts else []) + ([read_epubs(spark, *epubs)] if epubs else [])
    if not parts:
        return spark.createDataFrame([], UNIT)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_document(spark: SparkSession, path: str) -> dict | list:
    """A small JSON or YAML file (a registry, a catalog) from any file system that Spark reads; a missing or empty one is an empty dict."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return {}
    text = spark.read.text(path, wholetext=True).first()
    if text is None or not (text[0] or "").strip():
        return {}
    if path.lower().endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML files need the yaml module; JSON files don't") from e
        return yaml.safe_load(text[0]) or {}
    return json.loads(text[0])


def _glob_regex(pattern: str) -> re.Pattern:
    parts = re.split(r"(\*\*/|\*\*|\*|\?)", pattern)
    wild = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    return re.compile("".join(wild.get(p, re.escape(p)) for p in parts))


def resolve_book(spark: SparkSession, registry: dict[str, dict], book_id: str, root: str) -> list[str]:
    """Files of a registered book: its globs (``**`` for folders at any depth) below ``root`` in order, each sorted, .txt and .epub only, each file once. Listed through Hadoop's file systems."""
    if book_id not in registry:
        raise KeyError(book_id)
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = fs.makeQualified(base)
    paths, listed = [], fs.listFiles(base, True) if fs.exists(base) else None
    while listed is not None and listed.hasNext():
        paths.append(listed.next().getPath().toString())
    names = {p: p[len(base.toString()) :].lstrip("/") for p in sorted(paths)}
    found: dict[str, None] = {}
    for pattern in registry[book_id].get("globs", []):
        expr = _glob_regex(pattern)
        found |= dict.fromkeys(p for p, name in names.items() if expr.fullmatch(name) and name.lower().endswith((".txt", ".epub")))
    if not found:
        raise FileNotFoundError(f"{book_id}: no files")
    return list(found)


def read_payloads(spark: SparkSession, path: str, skip: str = "nodes.json") -> DataFrame:
    """All JSON payloads below ``path``, each a row with its ``path``; unreadable files and non-objects are left out, as are node tables."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    rows = raw.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("p"), F.trim("value").alias("value"))
    ok = rows.where(F.col("value").startswith("{") & F.col("p").isNotNull() & (F.substring_index("path", "/", -1) != skip) & F.expr("try_parse_json(value) is not null"))
    return ok.select("path", "p.*")


def read_audit_payloads(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_payloads``, but those alone that hold a narration or mentions, whatever is in them."""
    return read_payloads(spark, path).where("hadith is not null or mentions is not null")


def payload_at(payloads: DataFrame, path: str) -> DataFrame:
    """The payload of one file."""
    return payloads.where(F.col("path") == path)


def payload_items(p: Column, items: Column) -> Column:
    """The narrations of a payload: those it lists, or itself as the one."""
    return F.when(F.size(items) > 0, items).otherwise(F.array(p))


def verse_corpus_place(spark: SparkSession, *places: str) -> str:
    """The first of ``places`` that exists: a copy of one's own before a shared one."""
    jvm = spark.sparkContext._jvm
    for place in places:
        p = jvm.org.apache.hadoop.fs.Path(place)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return place
    raise FileNotFoundError(", ".join(places))


def json_to_markdown(spark: SparkSession, folder: str, path: str) -> int:
    """All JSON files of a folder, by name, indented and under their names, in one text file; returns how many. The report is put together on the driver, as it is for reading."""
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value").orderBy("name")
    blocks = [f"[ {r['name']} ]\n{json.dumps(json.loads(r['value']), ensure_ascii=False, indent=2)}" for r in files.toLocalIterator()]
    if not blocks:
        raise FileNotFoundError(f"no JSON files in {folder}")
    write_text(spark, path, "\n\n".join(blocks) + "\n")
    return len(blocks)


def read_verses(rows: DataFrame) -> DataFrame:
    """(ref, sura, ayah, text) of a verse corpus (surah_number, ayah_number, arabic_text); rows that don't parse are skipped."""
    sura, ayah = F.expr("try_cast(surah_number as int)"), F.expr("try_cast(ayah_number as int)")
    v = rows.select(sura.alias("sura"), ayah.alias("ayah"), F.col("arabic_text").alias("text")).where("sura is not null and ayah is not null and text is not null")
    return v.select(F.concat_ws(":", "sura", "ayah").alias("ref"), "sura", "ayah", "text")


def salience(c: Column) -> Column:
    """A salience of any shape as a number from 0 to 1; 0.5 where it can't be read."""
    v = F.coalesce(c.try_cast("double"), F.lit(0.5))
    return F.when(F.isnan(v), 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)))


def mentions_of(payloads: DataFrame, id_col: str = "path") -> DataFrame:
    """(doc, pos, text, type, salience, evidence) of every payload shape.

    Mentions stand at the top or in events; an event without mentions gives its characters (persons) and concepts; a payload
    in which none were found gives its older fields: semantic nodes (primary 0.9, secondary 0.4) or core concepts (0.6).
    """

    def mention(text: Column, kind: Column, weight: Column, evidence: Column) -> Column:
        return F.struct(text.alias("text"), kind.alias("type"), weight.cast("double").alias("salience"), evidence.alias("evidence"))

    def plain(arr: Column, kind: str, weight: float) -> Column:
        return F.transform(F.coalesce(arr, F.array().cast("array<string>")), lambda t: mention(t, F.lit(kind), F.lit(weight), F.lit("")))

    none = F.array().cast("array<struct<text:string,type:string,salience:double,evidence:string>>")

    def read(arr: Column) -> Column:
        return F.coalesce(F.transform(arr, lambda m: mention(m["text"], F.coalesce(m["type"], F.lit("concept")), salience(m["salience"]), F.coalesce(m["evidence"], F.lit("")))), none)

    def event(e: Column) -> Column:
        own = read(e["mentions"])
        return F.when(F.size(own) > 0, own).otherwise(F.concat(plain(e["characters_involved"], "person", 0.6), plain(e["historical_concepts"], "concept", 0.6)))

    found = F.concat(read(F.col("mentions")), F.coalesce(F.flatten(F.transform("events", event)), none))
    old = F.coalesce(
        F.transform("semantic_nodes", lambda n: mention(n["node"], F.coalesce(n["type"], F.lit("concept")), F.when(n["role"] == "primary", 0.9).otherwise(0.4), F.lit(""))), none
    )
    old = F.concat(old, plain(F.col("core_concepts"), "concept", 0.6))
    rows = payloads.select(F.col(id_col).alias("doc"), found.alias("found"), old.alias("old"))
    picked = rows.select("doc", F.posexplode(F.when(F.size("found") > 0, F.col("found")).otherwise(F.col("old"))).alias("pos", "m"))
    return picked.select("doc", "pos", "m.*").where("text is not null and trim(text) <> ''")
