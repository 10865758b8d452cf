"""Resumable assembly of records from a stream of pages, and windowed counts of events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import ship

STATE = "marker string, first string, last string, body string, held_locator string, held_text string, held int"
OUT = "source_path string, marker string, page_start string, page_end string, text string"


def _parts(text: str) -> tuple[str, list[tuple[str, str]]]:
    import re

    from corpusloom.operators.pages import START

    found = list(re.finditer(rf"^{START}", text, re.M))
    if not found:
        return text.strip(), []
    ends = [m.start() for m in found[1:]] + [len(text)]
    return text[: found[0].start()].strip(), [(m[0].strip(), text[m.start() : e].strip()) for m, e in zip(found, ends)]


def consume(state: tuple, locator: str, text: str, next_text: str | None) -> tuple[tuple, list[tuple]]:
    """(open record, finished records) after a page: state is (marker, first, last, body) or empty strings."""
    marker, first, last, body = state
    done = []
    leading, starts = _parts(text)
    if marker and leading:
        body, last = f"{body}\n{leading}", locator
    for token, piece in starts:
        if marker:
            done.append((marker, first, last, body))
        marker, first, last, body = token, locator, locator, piece
    nxt = _parts(next_text) if next_text and next_text.strip() else None
    goes_on = nxt is not None and (not nxt[1] or bool(nxt[0]))
    if marker and not goes_on:
        done.append((marker, first, last, body))
        marker = first = last = body = ""
    return (marker, first, last, body), done


def stream_records(pages: DataFrame) -> DataFrame:
    """Records of a stream of pages (source_path, unit_seq, locator, text, end boolean).

    State is kept by file: the open record and one held page, since a page can only be closed when the next is known. A page with ``end`` (its text may be
    empty) flushes the file. Batches must deliver a file's pages in order; within a batch they are sorted by unit_seq.
    """
    ship(pages.sparkSession)

    def step(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(pdfs)).sort_values("unit_seq")
        s = state.get if state.exists else ("", "", "", "", "", "", 0)
        rec, held = tuple(s[:4]), (s[4], s[5]) if s[6] else None
        out = []
        for locator, text, end in zip(rows["locator"], rows["text"], rows["end"]):
            text = text or ""
            if held:
                rec, done = consume(rec, *held, text)
                out += done
            held = (locator, text) if text.strip() else None
            if end:
                if held:
                    rec, done = consume(rec, *held, None)
                    out += done
                elif rec[0]:
                    out.append(rec)
                rec, held = ("", "", "", ""), None
        state.update((*rec, *(held or ("", "")), int(held is not None)))
        yield pd.DataFrame([(key[0], *r) for r in out], columns=["source_path", "marker", "page_start", "page_end", "text"])

    return pages.groupBy("source_path").applyInPandasWithState(step, OUT, STATE, "append", "NoTimeout")


def windowed_counts(events: DataFrame, ts: str = "ts", keys: tuple[str, ...] = ("event_type",), value: str = "value", size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by event-time window; state older than the watermark is dropped."""
    e = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return e.groupBy(F.window("_ts", size), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")
