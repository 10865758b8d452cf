"""The stages of corpus_pipeline against brute force, each on its own input, and the run as a whole."""

import itertools
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import quality
from corpusloom.runtime import written

from .conftest import LONG, words
from .test_sharding_mixing import brute_targets
from .test_tokens import check_pieces

STAGE = dict(corpus_pipeline.STAGES)
#: Extra columns under names that the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, score double, n long, rows string, fp string, component long, node string, copies int, start long, row string"


def body(k, n=40):
    return " ".join(f"w{k}x{i}" for i in range(n))


def odd_rows():
    def row(i, text, source="a"):
        return (i, text, "en", source, len(text or ""), "x", 0.5, 1, "r", "f", i, None, 1, 2, "q")

    near = body(5).split()
    near[20] = "other"
    rows = [row(i, body(i)) for i in range(12)]
    rows += [row(100, body(3)), row(101, "  " + body(3).replace(" ", "\t\n ")), row(102, " ".join(near) + " " + body(5, 40)), row(103, body(5) + " " + body(5, 40))]
    rows += [row(110, ""), row(111, None), row(112, "   "), row(None, body(40)), row(None, None, None), row(113, "one", None), row(114, LONG, "b")]
    rows += [row(115, body(50), "b")] * 3 + [row(116, body(51), "c"), row(117, "Ünï <|endoftext|> 中文 " + body(52), "c")]
    return rows


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("odd")
    spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (999, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base)


@pytest.fixture(scope="module")
def none_dir(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("none")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base)


def docs_of(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def brute_exact(rows):
    """rows: list of (id, text, ...). The row of smallest id of each class, null ids last, of equal rows one."""
    classes = defaultdict(list)
    for r in rows:
        classes[" ".join(words("." + (r[1] or "") + "."))].append(r)
    return Counter({min(rs, key=lambda r: (r[0] is None, r[0] or 0, str(r)))[:2]: 1 for rs in classes.values()})


def shingles(text, n=5):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute_near(rows, cut=0.8):
    """The rows that stay: of what links of Jaccard ``cut`` connect, those of the smallest id; null ids all."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a == b or (a and b and min(len(a), len(b)) / max(len(a), len(b)) >= cut and len(a & b) / len(a | b) >= cut):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return Counter(tuple(r) for i, r in enumerate(rows) if r[0] is None or r[0] == least[root(i)])


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_quality_keeps_what_the_model_keeps(spark, odd_dir, sf, where):
    folder = odd_dir if where == "odd" else sf
    docs = docs_of(spark, folder)
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    order = {r[0]: r[1] for r in spark.createDataFrame([(r.doc_id,) for r in labels], "i long").select("i", F.xxhash64("i")).collect()}

    def learned(value):
        ids = sorted({r.doc_id for r in labels if r.quality == value and r.doc_id in texts and texts[r.doc_id] is not None})
        assert len(order) < 2000
        return [texts[i] for i in ids]

    model = quality.train(learned(1), learned(0))
    want = Counter(tuple(r) for r in docs.collect() if model.scores([r.text])[0] >= 0.5)
    out = STAGE["quality"](spark, docs, folder)
    assert out.columns == docs.columns and rows_of(out) == want


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_exact_dedup(spark, odd_dir, sf, where):
    docs = docs_of(spark, odd_dir if where == "odd" else sf)
    out = STAGE["exact_dedup"](spark, docs, "")
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == brute_exact([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_near_dedup(spark, odd_dir, sf, where):
    docs = docs_of(spark, odd_dir if where == "odd" else sf)
    out = STAGE["near_dedup"](spark, docs, "")
    assert out.columns == docs.columns
    want = brute_near([tuple(r) for r in docs.collect()])
    assert rows_of(out) == want
    if where == "odd":
        assert {5, 102, 103} & {r[0] for r in want} == {5}


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_mix(spark, odd_dir, sf, where):
    docs = docs_of(spark, odd_dir if where == "odd" else sf)
    out = STAGE["mix"](spark, docs, "")
    assert out.columns == docs.columns
    rows, got = docs.collect(), rows_of(out)
    assert set(got) <= {tuple(r) for r in rows}
    sizes, took, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += len(words(r.text))
        largest[r.source] = max(largest[r.source], len(words(r.text)))
    times = Counter(tuple(r) for r in rows)
    for r, n in got.items():
        took[r[3]] += n * len(words(r[1]))
        assert words(r[1]) and n <= 2 * times[r]
    for s, target in brute_targets(dict(sizes)).items():
        assert abs(took[s] - target) <= largest[s] / 2 + 1, s
        epochs = round(target) // sizes[s] if sizes[s] else 0
        assert all(got[tuple(r)] >= epochs * times[tuple(r)] for r in rows if r.source == s and words(r.text))


@pytest.mark.parametrize("where", ["odd", "sf"])
def test_pack(spark, odd_dir, sf, where):
    docs = docs_of(spark, odd_dir if where == "odd" else sf)
    out = STAGE["pack"](spark, docs, "")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check_pieces(out.collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_run_is_its_stages_and_leaves_one_table(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "pack"]
    before = written(spark)
    out = corpus_pipeline.run(spark, sf)
    assert set(written(spark)) - set(before) == {out._corpusloom_path}
    docs = docs_of(spark, sf)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert rows_of(out) == rows_of(docs) and out.count() > 100


def test_run_on_odd_rows_and_empty_tables(spark, odd_dir, none_dir):
    pieces = corpus_pipeline.run(spark, odd_dir).collect()
    ids = {r.doc_id for r in pieces}
    assert 114 in ids and not ids & {100, 101, 102, 103, 110, 111, 112}
    assert corpus_pipeline.run(spark, none_dir).collect() == []
