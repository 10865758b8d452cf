"""Pairs of documents that share keys, worked out where they first meet, without a shuffle of pairs.

A key's documents meet in one task, each with all of its numbered keys. Blocking keys are numbered in the order in which they propose, so that the smallest shared number is
the one place where a pair is returned, once and with all its shares. What travels is a row a document and task, in compressed blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Documents that are dealt out at a time, and pairs that are worked out at a time.
DOCS_A_BLOCK = 1 << 17
PAIRS_A_STEP = 1 << 17


def task_of(kids: np.ndarray, tasks: int) -> np.ndarray:
    return ((kids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(tasks)


def deal(tasks: int, codes: int):
    """(doc, items) to (task, block): each document goes, once, to every task that holds one of its blocking keys.

    An item is number * ``codes`` + code of a key that blocks, or -1 - number of one that doesn't. A block is an Arrow stream of documents.
    """

    def blocks(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        items = t["items"].combine_chunks()
        n = pc.list_value_length(items).to_numpy(zero_copy_only=False).astype(np.int64)
        values = items.flatten().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(n)), n)
        hit = values >= 0
        pairs = np.unique(task_of(values[hit] // codes, tasks).astype(np.int64) * len(n) + doc[hit]) if hit.any() else np.zeros(0, np.int64)
        at, rows = pairs // max(len(n), 1), pairs % max(len(n), 1)
        ends = np.flatnonzero(np.diff(at, append=-1)) + 1
        out, start = [], 0
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for end in ends:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=options) as w:
                w.write_table(t.take(pa.array(rows[start:end])))
            out.append((int(at[start]), sink.getvalue().to_pybytes()))
            start = end
        for k in range(0, len(out), 64):
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out[k : k + 64]], pa.int32()), pa.array([x[1] for x in out[k : k + 64]], pa.binary())], names=["task", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= DOCS_A_BLOCK:
                yield from blocks(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield from blocks(pa.Table.from_batches(held))

    return run


class _Lists:
    """Numbers of each row, sorted within it: exact look-up and masks that tell most rows without a common number apart."""

    def __init__(self, row: np.ndarray, kid: np.ndarray, share: np.ndarray, rank: np.ndarray, rows: int, kids: int):
        order = np.lexsort((kid, row))
        self.row, self.kid, self.share, self.rank, self.kids = row[order], kid[order], share[order], rank[order], max(kids, 1)
        self.key = self.row * self.kids + self.kid
        self.n = np.bincount(self.row, minlength=rows)
        self.start = np.cumsum(self.n) - self.n
        self.bits = [(((kid + 1).astype(np.uint64) * np.uint64(m)) >> np.uint64(58)).astype(np.int64)[order] for m in (0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
        self.masks, self.twice = zip(*(self._masks(b, rows) for b in self.bits), strict=True)

    def _masks(self, bits: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row, the bits of its numbers, and those that several of them have."""
        both = [np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)]
        place, times = np.unique(self.row * 64 + bits, return_counts=True)
        for mask, u in zip(both, (place, place[times > 1]), strict=True):
            if len(u):
                row = u // 64
                first = np.flatnonzero(np.diff(row, prepend=-1))
                mask[row[first]] = np.bitwise_or.reduceat(np.uint64(1) << (u % 64).astype(np.uint64), first)
        return both[0], both[1]

    def shared(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which pair, which entry) of the numbers that both rows of a pair have."""
        n = self.n[left]
        pair = np.repeat(np.arange(len(left)), n)
        entry = np.arange(len(pair)) + np.repeat(self.start[left] - (np.cumsum(n) - n), n)
        kid, row = self.kid[entry], right[pair]
        want = row * self.kids + kid
        hit = self.key[np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)] == want
        return pair[hit], entry[hit]


def meet(tasks: int, codes: int, ranks: list[int], idf_share, n_kids: int, common: tuple[np.ndarray, np.ndarray, np.ndarray], n_common: int, shares: bool):
    """(task, block) to pairs (left, right, first, share_<rank> ... or score); ``first`` is the rank of the key that proposed the pair.

    ``idf_share(rank, df)`` is what a key adds; a blocking key's code is rank * (codes / 8) + df. ``common`` has for the other keys, numbered by rank and df: the first number of each such group, its rank and its share.
    """
    width = codes // 8

    def pairs_of(task: int, t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.take(pc.sort_indices(t, sort_keys=[("doc", "ascending")])).combine_chunks()
        docs, items = t["doc"].combine_chunks(), t["items"].combine_chunks()
        rows = len(docs)
        row = np.repeat(np.arange(rows), pc.list_value_length(items).to_numpy(zero_copy_only=False).astype(np.int64))
        values = items.flatten().to_numpy(zero_copy_only=False)
        hit = values >= 0
        kid, code = values[hit] // codes, values[hit] % codes
        own = _Lists(row[hit], kid, idf_share(code // width, code % width), code // width, rows, n_kids)
        starts, c_rank, c_share = common
        c_row, c_kid = row[~hit], -1 - values[~hit]
        group = np.searchsorted(starts, c_kid, side="right") - 1
        other = {}
        for r in np.unique(c_rank[group]) if len(group) else ():
            of = c_rank[group] == r
            other[int(r)] = _Lists(c_row[of], c_kid[of], c_share[group[of]], c_rank[group[of]], rows, n_common)
        here = np.flatnonzero(task_of(own.kid, tasks) == task)
        here = here[np.argsort(own.kid[here], kind="stable")]  # by key, then document
        m_row, m_kid, m_rank, m_share = own.row[here], own.kid[here], own.rank[here], own.share[here]
        # the bits of a document's other keys: what this key alone has set goes
        rest = [(m[m_row] & ~(np.uint64(1) << b[here].astype(np.uint64))) | w[m_row] for m, w, b in zip(own.masks, own.twice, own.bits, strict=True)]
        theirs = {r: [m[m_row] for m in x.masks] for r, x in other.items()}  # in the order of meetings, as is all that every pair looks at
        m_docs = docs.take(pa.array(m_row))
        last = np.searchsorted(m_kid, m_kid, side="right")
        n = last - np.arange(len(m_kid)) - 1
        total = np.cumsum(n)
        at = 0
        while at < len(n):
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + PAIRS_A_STEP, side="right")))
            cnt = n[at:to]
            size = int(cnt.sum())
            i = np.repeat(np.arange(at, to), cnt)
            j = np.arange(size) + np.repeat(np.arange(at, to) + 1 - (np.cumsum(cnt) - cnt), cnt)
            at = to
            if not size:
                continue
            rank = m_rank[i]
            if shares:
                add = {r: np.where(rank == r, m_share[i], 0.0) for r in ranks}
            else:
                score = m_share[i]
                add = dict.fromkeys(ranks, score)  # all shares go to one sum
            s = np.flatnonzero(rest[0][i] & rest[0][j])
            s = s[(rest[1][i[s]] & rest[1][j[s]]) != 0]
            keep = np.ones(size, bool)
            if len(s):
                p, e = own.shared(m_row[i[s]], m_row[j[s]])
                k, met = own.kid[e], m_kid[i[s]][p]
                keep[s[p[k < met]]] = False  # they met at that key
                later = k > met
                for r in ranks:
                    of = later & (own.rank[e] == r)
                    if of.any():
                        add[r][s] += np.bincount(p[of], own.share[e[of]], len(s))
            for r, x in other.items():
                one, two = theirs[r]
                s = np.flatnonzero(one[i] & one[j])
                s = s[(two[i[s]] & two[j[s]]) != 0]
                if len(s):
                    p, e = x.shared(m_row[i[s]], m_row[j[s]])
                    add[r][s] += np.bincount(p, x.share[e], len(s))
            cols = {f"share_{r}": add[r] for r in ranks} if shares else {"score": score}
            if not keep.all():
                i, j, rank, cols = i[keep], j[keep], rank[keep], {c: x[keep] for c, x in cols.items()}
            yield pa.RecordBatch.from_arrays([m_docs.take(pa.array(i)), m_docs.take(pa.array(j)), pa.array(rank.astype(np.int32)), *[pa.array(x) for x in cols.values()]], names=["left", "right", "first", *cols])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.Table]] = {}
        for b in batches:
            for task, block in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                held.setdefault(task, []).append(pa.ipc.open_stream(block.as_buffer()).read_all())
        while held:
            task, tables = held.popitem()
            yield from pairs_of(task, pa.concat_tables(tables))

    return run
