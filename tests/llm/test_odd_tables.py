"""Every text operator bears nulls in any column, empty, blank and very long texts, repeated rows, empty tables and extra columns whose names clash with its own."""

import pytest
from pyspark.sql import functions as F

from trailgrain.llm import boilerplate, encoding, language, neardup, packing, pii, residue, tokenizer

LONG = "Stir the oats into the water, then wait ten minutes. " * 4000
PAGES = [(1, "Soup", "Stir the oats. Wait.", "a.example", 20), (1, "Soup", "Stir the oats. Wait.", "a.example", 20), (2, None, None, None, None), (None, "x", "", None, 0), (4, " ", " \n\t ", "", 3), (5, "Long", LONG, "b.example", len(LONG)), (6, "\x00퟿￿", "?" * 50 + "\n" + "Ã" * 50 + "\n" + "http://" + "a" * 500, "é", -1), (7, None, LONG, None, None)]
DOCS = [(1, "Signed, Ada Marl. a@b.example", "en"), (1, "Signed, Ada Marl. a@b.example", "en"), (2, None, None), (None, "", ""), (4, "  \n", "xx"), (5, LONG, "English"), (6, None, "en"), (7, "+" * 3000 + "1" * 3000, None)]
CLASH = "key class band row prefix lang word names tokens text_a cell place group size n_tokens title_a part".split()


def clashing(df):
    return df.withColumns({c: F.lit(None).cast("string") for c in CLASH if c not in df.columns})


@pytest.fixture(scope="module")
def pages(spark):
    return clashing(spark.createDataFrame(PAGES, "page_id long, title string, text string, domain string, chars int"))


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(DOCS, "doc_id long, text string, lang string"))


OPERATORS = {
    "garbled": lambda p, d: encoding.find_garbled(p),
    "languages": lambda p, d: language.page_languages(p, d),
    "segments": lambda p, d: language.page_segments(p, d),
    "furniture": lambda p, d: boilerplate.find_furniture(p),
    "main content": lambda p, d: boilerplate.main_content(p),
    "pairs": lambda p, d: neardup.similar_pairs(p),
    "groups": lambda p, d: neardup.groups(p),
    "residue": lambda p, d: residue.find_residue(p),
    "ids": lambda p, d: tokenizer.encode_column(d),
    "containers": lambda p, d: packing.pack_texts(d),
    "personal": lambda p, d: pii.find_pii(d),
    "redacted": lambda p, d: pii.redact(d),
    "surrogates": lambda p, d: pii.redact(d, secret="k"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(pages, docs, name):
    whole = name in ("main content", "ids", "redacted", "surrogates")
    rows = OPERATORS[name](pages, docs).collect()
    key = rows[0].__fields__[0] if rows else None
    if whole:
        assert len(rows) == len(PAGES)
    if name == "groups":
        assert {r["page_id"] for r in rows} == {r[0] for r in PAGES} and len(rows) == 7
    if name == "pairs":
        assert {tuple(r) for r in rows} == {(5, 7)}
    assert key in (None, "page_id", "page_a", "doc_id", "container")


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(pages, docs, name):
    assert OPERATORS[name](pages.where("false"), docs.where("false")).count() == 0
