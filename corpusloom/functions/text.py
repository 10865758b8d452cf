"""Text folds and scalar predicates, as built-in column expressions.

Three folds exist and differ on purpose: ``fold`` (word roots), ``fold_citation`` (verse matching) and ``fold_label``
(catalog labels). All take null as an empty string and never return null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that the folds delete, map or keep.
SUPERSCRIPT_ALEF = "ٰ"
VOWELS = "ً-ٟۖ-ۭـ"
LETTERS_FROM = "آأإٱىةؤئ"
LETTERS_TO = "اااايهوي"
HONORIFICS = (
    r"\(\s*(?:ع|ص|عج|س|ره|عليه السلام)\s*\)"
    r"|(?:عليه|عليها|عليهم|عليهما)\s+السلام"
    r"|صلى\s+الله\s+عليه\s+و?\s*آله?(?:\s+و\s*سلم)?"
    r"|رضوان\s+الله\s+عليه"
    r"|(?<![؀-ۿ])(?:ع|ص|عج)(?![؀-ۿ])"
)
ENTITY_HEADS = ("واقعة", "وقعة", "يوم", "غزوة", "معركة", "سرية", "مدينة", "بلاد", "أرض", "كتاب")
NASAB = ("بن", "ابن", "بنت")
CLITIC_HEAD = r"^و?(?:[بلكف]?ال|لل|[بلكف])?"


def text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def squeeze(c: Column) -> Column:
    """White space runs, of any script, as one space; none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", "")


def _letters(c: Column) -> Column:
    return F.translate(c, LETTERS_FROM, LETTERS_TO)


def fold(c: Column | str) -> Column:
    c = F.regexp_replace(text(c), f"[{VOWELS}{SUPERSCRIPT_ALEF}]", "")
    return squeeze(F.regexp_replace(_letters(c), "[^ء-ي ]", " "))


def fold_citation(c: Column | str) -> Column:
    c = F.regexp_replace(F.translate(text(c), SUPERSCRIPT_ALEF, "ا"), f"[{VOWELS}]", "")
    return squeeze(F.regexp_replace(_letters(c), "[^؀-ۿ ]", " "))


def fold_label(c: Column | str) -> Column:
    """Key of a catalog label: marks, honorifics, letter shapes, case of a kunya, loose conjunction and leading article are folded in this order."""
    c = F.regexp_replace(F.translate(text(c), SUPERSCRIPT_ALEF, "ا"), f"[{VOWELS}]", "")
    c = _letters(squeeze(F.regexp_replace(c, f"(?U){HONORIFICS}", " ")))
    c = F.regexp_replace(c, r"^(?:ابي|ابا)(?=\s)", "ابو")
    c = F.regexp_replace(c, r"(?U)\s+و\s+", " و")
    return F.trim(F.when(c.startswith("ال") & (F.length(c) > 3), F.substring(c, 3, 1 << 30)).otherwise(c))


def plain(c: Column | str) -> Column:
    """Without vowel marks, white space squeezed."""
    return squeeze(F.regexp_replace(text(c), f"[{VOWELS}]", ""))


def fold_latin(c: Column | str) -> Column:
    """Words of letters and digits of any script in lower case, one space between: the fold for corpora in Latin script."""
    return squeeze(F.lower(F.regexp_replace(text(c), r"[^\p{L}\p{N}]+", " ")))


def match_key(c: Column | str) -> Column:
    """``fold_label`` with optional clitics off every word; a word of which fewer than three letters would remain stays whole."""
    words = F.filter(F.split(fold_label(c), " "), lambda w: w != "")

    def bare(w: Column) -> Column:
        b = F.regexp_replace(w, CLITIC_HEAD, "")
        return F.when(F.length(b) >= 3, b).otherwise(w)

    return F.array_join(F.transform(words, bare), " ")


def quote_key(c: Column | str) -> Column:
    """``fold`` without spaces; an alef after a word-final waw is spelling only."""
    return F.replace(F.regexp_replace(fold(c), r"وا(?=\s|$)", "و"), F.lit(" "), F.lit(""))


def name_tokens(c: Column | str) -> Column:
    """Tokens of a name: one generic head dropped, cut before the first genealogy particle."""
    heads = "|".join(ENTITY_HEADS).translate(str.maketrans(LETTERS_FROM, LETTERS_TO))
    name = F.regexp_replace(fold_label(c), f"^(?:{heads}) ", "")
    for particle in NASAB:
        cut = F.locate(f" {particle} ", name)
        name = F.when(cut > 1, F.substring(name, F.lit(1), cut - 1)).otherwise(name)
    return F.filter(F.split(name, " "), lambda t: t != "")


def contains_folded(haystack: Column | str, needle: Column | str, folding=fold) -> Column:
    """Containment regardless of marks and spaces; an empty needle is in nothing."""
    n = F.replace(folding(needle), F.lit(" "), F.lit(""))
    return (n != "") & F.contains(F.replace(folding(haystack), F.lit(" "), F.lit("")), n)


def vowel_marks(c: Column | str) -> Column:
    return F.regexp_count(text(c), F.lit("[ً-ْ]"))


def quote_depth(c: Column | str) -> Column:
    return F.regexp_count(text(c), F.lit("«")) - F.regexp_count(text(c), F.lit("»"))


def norm_marker(c: Column | str) -> Column:
    return F.regexp_replace(text(c), r"(?U)\s+", "")


def should_skip(c: Column | str, min_chars: int = 40, contents_marker: str = "فهرس") -> Column:
    """A page not worth a model call: short, or a table of contents."""
    t = F.trim(text(c))
    return (F.length(t) < min_chars) | F.contains(t, F.lit(contents_marker))


def translation_incomplete(c: Column | str, phrases: tuple[str, ...] = ("to be continued", "ادامه دارد")) -> Column:
    t = F.trim(text(c))
    pattern = "(?i)(\\.\\.\\.|…)\\s*$" + "".join(f"|{p}" for p in phrases)
    return (t == "") | t.rlike(pattern)


def span_locator(first: Column, last: Column) -> Column:
    return F.when(first == last, first).otherwise(F.concat(first, F.lit(" … "), last))


def compound_threshold(n_docs: Column, base: int = 2, per_10k: int = 3) -> Column:
    """Documents that must share a compound for it to keep an identity: grows with the corpus, rounds half to even."""
    return F.greatest(F.lit(base), F.bround(n_docs * F.lit(per_10k) / F.lit(10_000)).cast("int"))


def pacific_day_start(ts: Column) -> Column:
    """Start, in UTC, of the day in Los Angeles that holds ``ts``."""
    zone = "America/Los_Angeles"
    return F.to_utc_timestamp(F.date_trunc("day", F.from_utc_timestamp(ts, zone)), zone)
