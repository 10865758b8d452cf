"""Quality audits: weighted checks over records and their mentions, summed to a risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.morphology import words_with_roots
from corpusloom.functions.text import translation_incomplete

# Weights of the checks, and the sets that are on by default.
WEIGHTS = {"truncated_translation": 4, "too_few_mentions": 3, "ungrounded_mention": 5, "contrast_foil_without_elevated": 6, "framing_only_top": 4, "repeated_root_uncovered": 2, "high_salience_not_in_text": 2, "predicate_hinge_missing": 6}
PRECISE = ("contrast_foil_without_elevated", "predicate_hinge_missing", "framing_only_top", "ungrounded_mention", "truncated_translation")
NOISY = ("repeated_root_uncovered", "too_few_mentions")
FRAMING_HEADS = ("كمال", "صفه", "باب", "فضل", "صفت", "وجوب", "فرض")


def codes(include_noisy: bool = False, only: tuple[str, ...] | None = None) -> tuple[str, ...]:
    if only:
        if unknown := set(only) - set(WEIGHTS):
            raise ValueError(f"unknown checks: {sorted(unknown)}")
        return only
    return PRECISE + NOISY if include_noisy else PRECISE


def issue(doc: Column, code: str, detail: Column, weight: int | None = None) -> list[Column]:
    return [doc.alias("doc"), F.lit(code).alias("code"), detail.cast("string").alias("detail"), F.lit(WEIGHTS[code] if weight is None else weight).alias("weight")]


def risk(issues: list[DataFrame], min_risk: int = 1, top: int | None = None) -> DataFrame:
    """(doc, risk, issues): each (code, detail) of a document once, weights summed; documents without issues have no row."""
    rows = issues[0]
    for i in issues[1:]:
        rows = rows.unionByName(i)
    once = rows.dropDuplicates(["doc", "code", "detail"])
    out = once.groupBy("doc").agg(F.sum("weight").alias("risk"), F.array_sort(F.collect_list(F.struct("code", "detail", "weight"))).alias("issues"))
    out = out.where(F.col("risk") >= min_risk)
    return out.orderBy(F.desc("risk"), "doc").limit(top) if top else out


def body_of(folded: Column) -> Column:
    """A narration from its first "said" on; all of it where there is none."""
    cut = F.locate(" قال ", folded)
    cut = F.when(cut > 0, cut).otherwise(F.locate(" يقول ", folded))
    return F.when(cut > 0, folded.substr(cut + 1, F.length(folded))).otherwise(folded)


def repeated_roots(bodies: DataFrame, mentions: DataFrame, stop_roots: DataFrame, at_least: int = 5, most: int = 3) -> DataFrame:
    """Issues for roots that recur in a body (doc, body) and that no mention (doc, text) has; the ``most`` frequent of each document."""
    from corpusloom.operators.topk import top_per

    words = words_with_roots(bodies, "doc", "body").where("length(word) >= 3 and length(root) >= 3")
    counts = words.join(stop_roots.select("root").distinct(), "root", "left_anti").groupBy("id", "root").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first")).where(F.col("n") >= at_least)
    covered = words_with_roots(mentions.groupBy("doc").agg(F.concat_ws(" ", F.collect_list("text")).alias("t")), "doc", "t").select("id", "root").distinct()
    left = top_per(counts.join(covered, ["id", "root"], "left_anti"), ["id"], [F.desc("n"), "first"], most)
    return left.select(*issue(F.col("id"), "repeated_root_uncovered", F.concat_ws(" x", "root", "n")))


def few_mentions(docs: DataFrame, long_words: int = 60) -> DataFrame:
    """Issues for documents (doc, n_mentions, n_words) without mentions, or with one on a long text."""
    none, one = F.col("n_mentions") == 0, (F.col("n_mentions") == 1) & (F.col("n_words") >= long_words)
    return docs.where(none | one).select(*issue(F.col("doc"), "too_few_mentions", F.col("n_mentions")))


def framing_top(mentions: DataFrame, cut: float = 0.85, heads: tuple[str, ...] = FRAMING_HEADS) -> DataFrame:
    """Issues where a document's (doc, pos, folded, salience) one highly salient mention is a compound under a framing head."""
    g = mentions.groupBy("doc").agg(F.max_by(F.struct("folded", "salience"), F.struct("salience", -F.col("pos"))).alias("top"), F.count_if(F.col("salience") >= cut).alias("high"))
    words = F.split("top.folded", " ")
    return g.where((F.col("high") == 1) & (F.size(words) > 1) & words[0].isin(*heads)).select(*issue(F.col("doc"), "framing_only_top", F.col("top.folded")))


def salient_not_in_text(mentions: DataFrame, cut: float = 0.9) -> DataFrame:
    """Issues for salient mentions (doc, text, salience, roots, text_roots) none of whose roots stands in the text."""
    bad = (F.col("salience") >= cut) & (F.size("roots") > 0) & ~F.arrays_overlap("roots", "text_roots")
    return mentions.where(bad).select(*issue(F.col("doc"), "high_salience_not_in_text", F.col("text")))


def contrast_foil(docs: DataFrame, markers: tuple[tuple[str, ...], ...]) -> DataFrame:
    """Issues where only the lower side of a contrast is mentioned.

    ``docs``: doc, words (array), roots (array of the same length, '' for stop roots), mention_roots (array). Two words before a marker are the elevated side, three after it the foil.
    """
    out = None
    for marker in markers:
        n = len(marker)
        at = F.filter(F.sequence(F.lit(1), F.size("words")), lambda i: F.slice("words", i, n) == F.array(*[F.lit(m) for m in marker]))
        hit = docs.withColumn("i", F.explode(at))
        pick = lambda start, length: F.transform(F.filter(F.arrays_zip(F.slice("words", start, length).alias("w"), F.slice("roots", start, length).alias("r")), lambda x: F.length(x["w"]) >= 3), lambda x: x["r"])
        before = F.greatest(F.lit(1), F.col("i") - 4)
        left = pick(before, F.col("i") - before)
        left = F.when(F.size(left) > 2, F.slice(left, -2, 2)).otherwise(left)
        right = pick(F.col("i") + n, F.lit(3))
        real = lambda a: F.filter(a, lambda r: r != "")
        bad = (F.size(real(left)) > 0) & (F.size(right) > 0) & (F.size(F.array_except(real(left), "mention_roots")) > 0) & F.arrays_overlap(real(right), "mention_roots")
        rows = hit.where(bad).select(*issue(F.col("doc"), "contrast_foil_without_elevated", F.lit(" ".join(marker))))
        out = rows if out is None else out.unionByName(rows)
    return out


def predicate_hinge(docs: DataFrame, stem: str = "نفع", inflected: str = "نتفع", subject: str = "علم") -> DataFrame:
    """Issues where a body turns on a predicate near its subject while the mentions keep the bare subject.

    ``docs``: doc, words, mentions array<struct<folded, salience>>. The predicate stands within three words of the subject.
    """
    is_stem = lambda w: F.contains(w, F.lit(stem)) | F.contains(w, F.lit(inflected))
    near = F.exists(F.sequence(F.lit(1), F.size("words")), lambda i: is_stem(F.element_at("words", i)) & F.exists(F.slice("words", F.greatest(F.lit(1), i - 3), 7), lambda x: F.contains(x, F.lit(subject))))
    covered = F.exists("mentions", lambda m: is_stem(m["folded"]))
    typed = F.exists("mentions", lambda m: (m["salience"] >= 0.8) & F.contains(m["folded"], F.lit(subject)))
    return docs.where((F.size("words") > 0) & near & ~covered & typed).select(*issue(F.col("doc"), "predicate_hinge_missing", F.lit(stem)))


def excerpt(raw: Column, folded: Column, limit: int = 1800, before: int = 20) -> Column:
    """The raw text from about the first "said" of its folded form on, ``limit`` characters at most. The place is the folded text's, so that marks shift it: a little is kept before."""
    at = F.greatest(F.locate(" قال ", folded), F.lit(0))
    at = F.when(at > 0, at).otherwise(F.locate(" يقول ", folded))
    cut = F.trim(F.when(at > 0, F.substring(raw, F.greatest(at - before, F.lit(1)), F.length(raw))).otherwise(raw))
    return F.when(F.length(cut) <= limit, cut).otherwise(F.concat(F.substring(cut, F.lit(1), F.lit(limit)), F.lit("\n…")))


def ungrounded(mentions: DataFrame) -> DataFrame:
    """Issues for mentions (doc, text, reason) that their record's text doesn't support."""
    return mentions.where(F.col("reason").isNotNull()).select(*issue(F.col("doc"), "ungrounded_mention", F.concat_ws(": ", "text", "reason")))


def truncated_translations(docs: DataFrame) -> DataFrame:
    """Issues for records (doc, translation) whose translation breaks off."""
    return docs.where(translation_incomplete(F.col("translation"))).select(*issue(F.col("doc"), "truncated_translation", F.lit("translation")))


def review_issues(issues: DataFrame, texts: DataFrame, backend, batch: int = 40) -> DataFrame:
    """(doc, code, verdict) of a model's view of each issue on the excerpt (doc, text) it was found in; an unreadable answer keeps the issue."""
    from corpusloom.operators.models import complete

    asked = issues.join(texts, "doc").select(F.to_json(F.struct("doc", "code", "detail")).alias("id"), F.concat(F.lit("issue: "), "code", F.lit("\ndetail: "), F.coalesce("detail", F.lit("")), F.lit("\ntext: "), F.coalesce("text", F.lit(""))).alias("prompt")).distinct()
    said = complete(asked, backend, "keep boolean", key="id", batch=batch)
    at = said.select(F.from_json("id", issues.select("doc", "code", "detail").schema).alias("i"), F.when(F.coalesce("answer.keep", F.lit(True)), "keep").otherwise("drop").alias("verdict"))
    return at.select("i.doc", "i.code", "verdict").groupBy("doc", "code").agg(F.max("verdict").alias("verdict"))


def review_report(kept: DataFrame, dropped: DataFrame, title: str = "Review", limit: int = 200) -> str:
    """A person's report: counts by check, then the kept issues, most risky records first, then what was dismissed."""
    by = lambda df: {r["code"]: r["n"] for r in df.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    k, d = by(kept), by(dropped)
    out = [f"# {title}", "", "| check | kept | dismissed |", "|-|-|-|"] + [f"| {c} | {k.get(c, 0)} | {d.get(c, 0)} |" for c in sorted({*k, *d})] + [""]
    for r in risk([kept], top=limit).collect() if k else []:
        out += [f"## {r['doc']} (risk {r['risk']})", *[f"- {i['code']}: {i['detail']}" for i in r["issues"]]]
    return "\n".join(out) + "\n"


def filter_by_verdicts(issues: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Issues that a reviewer (doc, code, verdict) didn't dismiss; what wasn't reviewed stays."""
    v = issues.join(verdicts, ["doc", "code"], "left")
    return v.where(F.coalesce("verdict", F.lit("keep")) != "drop").drop("verdict")


def to_markdown(rows: DataFrame, title: str, columns: list[str], limit: int = 25) -> str:
    """A report of the first rows; formatting happens on the driver, after the limit."""
    out = [f"# {title}", ""]
    for n, r in enumerate(rows.limit(limit).collect(), 1):
        out.append(f"## {n}. {r[columns[0]]}")
        out += [f"- {c}: {r[c]}" for c in columns[1:]]
    return "\n".join(out) + "\n"
