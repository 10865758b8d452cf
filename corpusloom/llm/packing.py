"""Order-preserving packing by dynamic programming."""

from __future__ import annotations

import math
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tokens import AT_ONCE, encoder
from corpusloom.runtime import frugal, ship, text_bytes, without

#: Kinds of a place where a window may end: end of a document, end of a sentence, any token.
DOCUMENT, SENTENCE, INSIDE = 0, 1, 2


def cut_windows(ends: np.ndarray, kinds: np.ndarray, window: int, penalties: tuple[float, float, float]) -> np.ndarray:
    """The cheapest windows of at most ``window`` tokens over a stream.

    ``ends`` are the places where a window may end (token counts from the stream's start, rising, the last one the
    stream's end), no two further apart than ``window``. A window costs its padding plus ``penalties[kind]`` of its
    end: cost(j) = min over i of cost(i) + window - (ends[j] - ends[i]) + penalty(j), with i at most ``window`` tokens
    back. As cost(i) + ends[i] doesn't depend on j, a monotone queue over the sliding window finds the minimum in
    constant time a place. Ties go to the longer window. Returns the indices of the chosen ends.
    """
    at, pay = ends.tolist(), np.asarray(penalties, np.float64)[kinds].tolist()
    back = [0] * len(at)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, -1)])  # (cost + place, place, index), rising costs
    push, pop, popleft = queue.append, queue.pop, queue.popleft
    for j, here in enumerate(at):
        low = here - window
        while queue[0][1] < low:
            popleft()
        head = queue[0]
        back[j] = head[2]
        value = head[0] + window + pay[j]  # = cost(j) + here
        while queue and queue[-1][0] > value:
            pop()
        push((value, here, j))
    chosen, j = [], len(at) - 1
    while j >= 0:
        chosen.append(j)
        j = back[j]
    return np.array(chosen[::-1], np.int64)


class _Stream:
    """Documents of one partition in order, packed in blocks of bounded size."""

    def __init__(self, window: int, penalties: tuple[float, float, float], base: int):
        self.window, self.penalties, self.next_sequence = window, penalties, base
        self.clear()

    def clear(self) -> None:
        self.ids: list[np.ndarray] = []
        self.rows: list[int] = []
        self.starts: list[int] = []
        self.ends: list[np.ndarray] = []
        self.kinds: list[np.ndarray] = []
        self.size = 0

    def add(self, row: int, start: int, ids: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> None:
        self.ids.append(ids)
        self.rows.append(row)
        self.starts.append(start)
        self.ends.append(ends + self.size)
        self.kinds.append(kinds)
        self.size += len(ids)

    def pack(self) -> list[tuple[int, int, int, int, int, int]]:
        """(row, start, length, crc32, sequence, offset) of every piece."""
        if not self.size:
            return []
        ends, kinds = np.concatenate(self.ends), np.concatenate(self.kinds)
        cuts = ends[cut_windows(ends, kinds, self.window, self.penalties)]
        out, place, k = [], 0, 0
        begin = 0
        for row, start, ids in zip(self.rows, self.starts, self.ids):
            at = 0
            while at < len(ids):
                n = min(len(ids) - at, int(cuts[k]) - place)
                piece = ids[at : at + n].astype("<u4", copy=False)
                out.append((row, start + at, n, zlib.crc32(memoryview(np.ascontiguousarray(piece)).cast("B")), self.next_sequence, place - begin))
                at += n
                place += n
                if place == cuts[k]:
                    begin, k = place, k + 1
                    self.next_sequence += 1
        self.clear()
        return out


@lru_cache(maxsize=2)
def _sentence_tables(tokenizer: str, most_parts: int, at_once: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By id: closes a sentence, begins with white space, holds a line break."""
    texts = encoder(tokenizer, most_parts, at_once).strings()
    stops = np.array([t.rstrip(" \t").endswith((".", "!", "?", "…", "\n", '."', ".”", ".)")) for t in texts])
    return stops, np.array([t[:1].isspace() for t in texts]), np.array(["\n" in t for t in texts])


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 2048,
    end_id: int = 1,
    penalties: tuple[float, float, float] = (0.0, 24.0, 96.0),
    partition_bytes: int = 24 << 20,
    most_partitions: int = 50_000,
    block_tokens: int = 1 << 20,
    most_parts: int = 240_000,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """Cut the documents, in order of (id, text), into windows of at most ``window`` tokens.

    Rows are range-sorted by (id, text hash); a partition tokenises its rows and runs ``cut_windows`` over blocks of about
    ``block_tokens`` tokens, whose last windows alone are cut early; a longer document is fed in by parts of that size, so
    that memory stays bounded whatever a partition holds (about ``partition_bytes``, more where that would make over ``most_partitions``). Windows may end after documents (free), after sentences or, inside a sentence longer than a window,
    every ``window`` / 64 tokens (``penalties`` in tokens of padding).

    ``most_parts`` bounds a worker's tables of known words, ``at_once`` the bytes of text whose words it looks up together: more of either takes less time and more memory, and changes nothing else.

    Returns a row a piece: the columns of ``df`` except the text and those named like these: ``start``,
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset`` (all long). Sequence ids rise in order of
    the documents, with gaps between partitions. A null text is empty: its one piece is the end id. Null ids come
    first; repeated rows are separate documents; an empty table gives no rows.
    """
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    own = [c for c in without(df, *names) if c.lower() != text_col.lower()]
    ship(df.sparkSession)
    _, size = text_bytes(df, text_col)
    parts = min(most_partitions, max(1, math.ceil(size / partition_bytes)))
    rows = df.select(F.struct(*[F.col(c) for c in own]).alias("row"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    keys = [F.col("row")[id_col], F.col("tie")]
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("row", "text")
    schema = "row " + df.select(F.struct(*[F.col(c) for c in own])).schema[0].dataType.simpleString() + ", " + ", ".join(f"{n} long" for n in names)

    def pack(batches):
        import pyarrow as pa

        e = encoder(tokenizer, most_parts, at_once)
        stops, opens, lines = _sentence_tables(tokenizer, most_parts, at_once)
        stream = _Stream(window, penalties, TaskContext.get().partitionId() << 40)

        def places(ids: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
            """Where a part of a document may be cut; sentences longer than a window also inside."""
            n = len(ids)
            ends = np.flatnonzero((stops[ids[:-1]] & opens[ids[1:]]) | lines[ids[:-1]]) + 1 if n > 1 else np.empty(0, np.int64)
            bounds = np.concatenate([[0], ends, [n]])
            long = np.flatnonzero(np.diff(bounds) > window)
            more = [np.arange(bounds[i] + window // 64, bounds[i + 1], window // 64) for i in long]
            inside = np.concatenate(more) if more else np.empty(0, np.int64)
            at = np.concatenate([ends, inside, [n]])
            kind = np.concatenate([np.full(len(ends), SENTENCE), np.full(len(inside), INSIDE), [DOCUMENT if last else INSIDE]])
            order = np.argsort(at, kind="stable")
            return at[order].astype(np.int64), kind[order].astype(np.int8)

        for batch in batches:
            held = batch.column(0)
            n_rows, doc_tokens, found = batch.num_rows, np.zeros(batch.num_rows, np.int64), []
            for r, ids in enumerate(e.encode_column(batch.column(1))):
                ids = np.append(ids, np.uint32(end_id))
                doc_tokens[r] = len(ids)
                for a in range(0, len(ids), block_tokens):
                    part = ids[a : a + block_tokens]
                    stream.add(r, a, part, *places(part, a + block_tokens >= len(ids)))
                    if stream.size >= block_tokens:
                        found += stream.pack()
            found += stream.pack()
            if n_rows:
                cols = list(zip(*found))
                r = np.array(cols[0], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [held.take(pa.array(r)), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(doc_tokens[r]), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64())],
                    names=["row", *names],
                )

    packed = ordered.mapInArrow(frugal(pack), schema)
    return packed.select("row.*", *names)
