import re

import pytest

LONG = "word " * 200_000 + "end"
#: Rows that every operator must bear: nulls, empty and long texts, ties, repeats, columns of clashing names.
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "a", "x"),
    (2, "alpha  beta\tgamma delta epsilon zeta", "a", "x"),
    (3, "", "b", "x"),
    (4, None, None, None),
    (5, "one", "b", "y"),
    (6, LONG, "c", "y"),
    (7, "Ünï çödé “quoted” text 中文 <|endoftext|> \x1c odd", "c", "y"),
    (7, "Ünï çödé “quoted” text 中文 <|endoftext|> \x1c odd", "c", "y"),
    (None, "no id here", None, "z"),
    (9, "   ", "b", "z"),
]
SCHEMA = "doc_id long, text string, source string, {0} string"


@pytest.fixture(scope="session")
def odd(spark):
    def make(extra: str = "extra", empty: bool = False):
        return spark.createDataFrame([] if empty else ROWS, SCHEMA.format(extra)).repartition(3)

    return make


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
