"""Every query that has SQL against DuckDB over the same tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF

TABLES = [p.stem for p in SF.glob("*.parquet")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(name, spark, sf, duck):
    df = entry.queries()[name](spark, sf)
    found = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(found.columns)
    got, want = rows(df.columns, map(tuple, df.collect())), rows(found.columns, found.fetchall())
    assert len(got) == len(want)
    assert got == want
    assert want, "the query says nothing about these tables"


def test_entry_and_names(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(5).count() == 5


def test_no_import_of_the_llm_subpackage():
    root = Path(entry.__file__).parent / "corpusloom"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "corpusloom.llm" not in f.read_text(), f
