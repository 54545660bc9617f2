"""Small tables with every odd case: nulls, empty and very long texts, ties, repeats, clashing columns."""

import pytest

from parcelflow.llm.common import ship

SF_DIR = "/root/testdata/sf0.001"
# Names that operators use inside.
CLASHING = ["keep_id", "digest", "n", "mark", "size", "row", "_id", "score", "end", "ids", "h", "__own", "_text", "target"]
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHING)

LONG = "lorem ipsum dolor sit amet " * 60_000
GOOD = "The old house by the river was sold in spring, and its new owners\nare going to plant trees.\nThen they rest."
TEXTS = [
    (1, GOOD), (2, GOOD), (3, GOOD.replace(" ", "\t")), (4, None), (5, ""), (6, " \n "), (7, " "), (8, "one"), (9, "one two"),
    (10, LONG), (11, LONG + "x"), (12, "BUY NOW!!! ### $$$ %%% &&&"), (12, "BUY NOW!!! ### $$$ %%% &&&"), (13, "été\x00naïve 漢字 😀 don't"),
    (None, "no id here at all"), (None, "no id here at all"), (None, GOOD), (14, "a  b\r\nc\x0bd\x0ce f"), (15, "A a A a A a"),
    (16, "Released under the MIT License."),
]


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(llm):
    rows = [
        (i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"src{k % 3}", None if t is None else len(t), *[None] * len(CLASHING))
        for k, (i, t) in enumerate(TEXTS)
    ]
    return llm.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def docs(llm):
    return llm.read.parquet(f"{SF_DIR}/documents.parquet")
