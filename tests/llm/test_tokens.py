import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import bitplanes, packing
from corpusloom.llm.queries import op3_packing, op8_token_files, tokenizer_path
from corpusloom.llm.tokens import Encoder, encoder

from .conftest import ROWS


def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab .,'\n\t1é“s<|>\x1c\x85 ", max_size=80) | st.lists(st.sampled_from(["the", "a.b", "x,", "'s", "it's", "%%%", "4.0", "é", "end.", "\n", "A\nB", "!!", "m@x.org", "<|endoftext|>", "<|endoftext|", "x<|endoftext|>."]), max_size=30).map(" ".join))
def test_encoder_equals_the_library(text):
    assert encoder(tokenizer_path()).encode(text).tolist() == plain()(text)


def test_strings_of_special_tokens_become_their_id():
    assert encoder(tokenizer_path()).encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275] == plain()("a <|endoftext|> b")


def test_encoder_table_is_bounded():
    e = Encoder(tokenizer_path(), most_parts=50)
    for k in range(30):
        text = " ".join(f"w{k}x{i}" for i in range(10))
        assert e.encode(text).tolist() == plain()(text) and len(e.table) <= 62 and len(e.before) <= 62


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_pieces(rows, docs, window=2048, end=1):
    """docs: list of (doc_id, text)."""
    enc, found, sequences = plain(), defaultdict(list), defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for seq in sequences.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    want = defaultdict(list)
    for d, t in docs:
        want[d].append(enc(t) + [end])
    assert set(found) == set(want)
    for d, lists in want.items():
        if len(lists) == 1:
            ids, at = lists[0], 0
            for r in sorted(found[d], key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids))
                assert r.ids_crc32 == crc(ids[at : at + r.length])
                at += r.length
            assert at == len(ids)
        else:
            assert sum(r.length for r in found[d]) == sum(map(len, lists))
    return 1 - sum(r.length for r in rows) / (window * len(sequences))


def test_packing_query_has_little_padding(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert check_pieces(op3_packing(spark, sf).collect(), docs) < 0.03


@pytest.mark.parametrize("block_tokens", [3000, 1 << 20])
def test_packing_odd_rows(odd, block_tokens):
    out = packing.pack_documents(odd("start"), tokenizer_path(), block_tokens=block_tokens)
    assert out.columns[:2] == ["doc_id", "source"]
    check_pieces(out.collect(), [r[:2] for r in ROWS])
    assert packing.pack_documents(odd(empty=True), tokenizer_path()).count() == 0


def test_windows_are_optimal():
    rng = random.Random(4)
    for _ in range(200):
        window, pay = rng.randint(4, 30), (0.0, 2.0, 5.0)
        ends = np.cumsum([rng.randint(1, window) for _ in range(rng.randint(1, 25))])
        kinds = np.array([rng.randint(0, 2) for _ in ends])
        cuts = packing.cut_windows(ends, kinds, window, pay)
        places, costs = [0, *ends.tolist()], [0.0]
        for j in range(1, len(places)):
            costs.append(min(costs[i] + window - (places[j] - places[i]) + pay[kinds[j - 1]] for i in range(j) if places[j] - places[i] <= window))
        got = [0, *ends[cuts].tolist()]
        assert got[-1] == ends[-1] and all(b - a <= window for a, b in zip(got, got[1:]))
        assert sum(window - (b - a) for a, b in zip(got, got[1:])) + sum(pay[kinds[c]] for c in cuts) == pytest.approx(costs[-1])


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 65535, 65536, 65537, 200_000])
def test_blocks_round_trip(n):
    ids = np.random.default_rng(n).integers(0, 2**32 if n % 2 else 50257, n, dtype=np.uint64).astype(np.uint32)
    pieces = list(bitplanes.encode_file([(5, ids[: n // 3]), (None, ids[n // 3 :])]))
    data = pieces[-1] + b"".join(pieces[:-1])
    (a, x), (b, y) = bitplanes.decode_file(data)
    assert (a, b) == (5, None) and np.array_equal(np.concatenate([x, y]), ids)


def test_planes_are_smaller_than_ids():
    ids = np.random.default_rng(0).zipf(1.4, 65536).clip(max=50256).astype(np.uint32)
    assert len(bitplanes.shuffle_block(ids)[1]) < 0.4 * ids.nbytes


def brute_ids(docs):
    enc, at, out = plain(), 0, []
    for d, t in docs:
        ids = enc(t) + [2]
        out.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def test_token_files_query(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(map(tuple, op8_token_files(spark, sf).collect())) == brute_ids(docs)


def test_token_files_odd_rows(odd, tmp_path):
    out = bitplanes.round_trip(odd("path"), tokenizer_path(), path=f"file://{tmp_path}/x", partition_bytes=1000, file_ids=40)
    assert len(list((tmp_path / "x").glob("*.clbp"))) > 3
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in ROWS), key=lambda d: (d is not None, d))
    assert sorted((r.n_tokens, r.ids_crc32) for r in rows) == sorted(x[2:] for x in brute_ids([r[:2] for r in ROWS]))
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    assert bitplanes.round_trip(odd(empty=True), tokenizer_path()).count() == 0


def test_token_files_paths_and_ids(spark, odd, tmp_path):
    out = bitplanes.round_trip(odd(), tokenizer_path(), path=f"{tmp_path}/plain")  # no scheme
    assert out.count() == len(ROWS) and list((tmp_path / "plain").glob("*.clbp"))
    with pytest.raises(TypeError):
        bitplanes.write_token_files(odd().selectExpr("cast(doc_id as string) doc_id", "text"), f"{tmp_path}/no", tokenizer_path())
