"""Byte-level BPE with the tokenizers library, each distinct word once."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LETTERS = "0-9A-Za-zÀ-ÖØ-öø-ʯЀ-ҁҊ-ԯ"
#: White space other than single spaces and line breaks inside: a cut at a space or line break might be no border of pieces.
_WHOLE = r"[\x00-\x09\x0B-\x1F\x7F-\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{2060}\x{3000}\x{FEFF}]|[ \n][ \n]|\A[ \n]|[ \n]\z"
#: Commas and full stops that don't stand after a letter or digit and before one, a space or a line break.
_STUCK = rf"\A[,.]|[^{_LETTERS}][,.]|[,.][^\n {_LETTERS}]"
#: Where letters or digits end and ASCII signs begin, pieces do too.
_SIGNS = rf"([{_LETTERS}])([!-/:-@\[-`{{-~])"
#: Bytes of text that are cut into parts at a time, unless said otherwise.
AT_ONCE = 4 << 20


class Encoder:
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    A byte-level tokenizer merges inside pieces only. In a text that ``_WHOLE`` doesn't match each space opens a piece and a line break is
    one, and so do commas and full stops, or, where some are ``_STUCK``, all signs after letters; the text's ids are those of its parts in a row. Parts are told apart by a dictionary encoding of a batch; the
    library encodes the distinct ones that the tables don't know, in one call. There are two tables: when the one being filled is full it replaces the other, so
    that parts in use stay known and memory is bounded. All other texts go to the library whole, and so do those that hold the string of an added token: as the
    library does, such a string becomes its one id.
    """

    def __init__(self, path: str, most_parts: int = 240_000, at_once: int = AT_ONCE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([_WHOLE, *(r"\Q" + t + r"\E" for t in added if t)])
        self.most_parts, self.at_once = most_parts, at_once
        self.table: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        (self.newline,) = self._ids("\n").tolist()
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(self.tokenizer.get_vocab_size())])  # Ġ: a space

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, new: list[str]) -> None:
        table = self.table
        spaced = [p for p in new if p[0] == " "]
        bare = [p for p in new if p[0] not in " \n"]
        if "\n" in new:
            table["\n"] = np.uint32(self.newline).tobytes()
        for parts, text, skip in ((spaced, "".join(spaced), 0), (bare, "\n" + "\n".join(bare), 1)):
            if not parts:
                continue
            ids = self._ids(text)
            cuts = np.flatnonzero(ids == self.newline if skip else self.opens[ids])
            if len(cuts) != len(parts):
                raise AssertionError("parts and their ids don't meet")
            raw, at = ids.tobytes(), (4 * np.append(cuts, len(ids))).tolist()
            for p, a, b in zip(parts, at, at[1:]):
                table[p] = raw[a + 4 * skip : b]

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts, as bytes."""
        if len(self.table) > self.most_parts:
            self.before, self.table = self.table, {}
        table, before = self.table, self.before
        missing = [p for p in parts if p not in table]
        new = []
        for p in missing:
            if p in before:
                table[p] = before[p]
            else:
                new.append(p)
        if new:
            self._learn(new)
        return list(map(table.__getitem__, parts))

    def _by_parts(self, texts: pa.Array, stuck: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of texts that may be cut."""
        if stuck:
            texts = pc.replace_substring_regex(texts, _SIGNS, "\\1\0\\2")
        for a, b in ((",", "\0,"), (".", "\0."))[: 0 if stuck else 2] + (("\n", "\0\n\0"), (" ", "\0 ")):
            texts = pc.replace_substring(texts, a, b)
        lists = pc.split_pattern(texts, "\0")
        coded = lists.flatten().dictionary_encode()
        raw = self._of_parts(coded.dictionary.to_pylist())
        known = np.frombuffer(b"".join(raw), np.uint32)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        which = coded.indices.to_numpy()
        n = size[which]
        upto = np.cumsum(n)
        first = (np.cumsum(size) - size)[which] - (upto - n)
        ids = known[np.repeat(first, n) + np.arange(upto[-1])]
        offsets = lists.offsets.to_numpy()
        return ids, upto[offsets[1:] - offsets[0] - 1]

    def encode_texts(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text; null and empty texts have none."""
        texts = texts.cast(pa.large_string()).fill_null("")
        size = pc.binary_length(texts).to_numpy()
        whole = pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        for i in np.flatnonzero(whole & (size > 0)).tolist():
            out[i] = self._ids(texts[i].as_py())
        stuck = pc.match_substring_regex(texts, _STUCK).to_numpy(zero_copy_only=False)
        for kind in (False, True):
            cut = np.flatnonzero(~whole & (stuck == kind) & (size > 0))
            group = np.cumsum(size[cut]) // self.at_once
            for rows in np.split(cut, np.flatnonzero(np.diff(group)) + 1) if len(cut) else []:
                ids, ends = self._by_parts(texts.take(pa.array(rows)), kind)
                for i, part in zip(rows.tolist(), np.split(ids, ends[:-1])):
                    out[i] = part
        return out

    def encode_column(self, texts: pa.Array, at_once: int = 8 << 20) -> Iterator[np.ndarray]:
        """The ids of every text in order; few texts' ids are in memory at a time."""
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + at_once)))
            yield from self.encode_texts(texts.slice(a, b - a))
            a = b

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_texts(pa.array([text], pa.string()))[0]

    def strings(self) -> list[str]:
        """The text of every id, for tables by id."""
        return self.tokenizer.decode_batch([[i] for i in range(self.tokenizer.get_vocab_size())])


@lru_cache(maxsize=2)
def encoder(path: str, most_parts: int = 240_000, at_once: int = AT_ONCE) -> Encoder:
    """One per Python worker, file and use of memory."""
    return Encoder(path, most_parts, at_once)
