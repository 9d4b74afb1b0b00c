"""Whole queries on empty tables, and on rows with nulls, repeats, very long texts and columns of clashing names."""

import os
import random

import pytest
from pyspark.sql import functions as F

from spillway.llm.catalog import QUERIES

KINDS = {
    "documents": "doc_id long, text string, lang string, source string",
    "labels": "doc_id long, toxic int, quality int",
    "benchmark": "item_id long, text string",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn int, role string, text string",
}
#: Names that operators use for columns of their own.
CLASH = "id row score lang_pred key words n base spans body digest size refers_to ids decoded value runs collapsed n_words h w g a p part k t formatted starts ends loss kept _part _pos _row".split()
NUMBERED = sorted(n for n in QUERIES if n.startswith("op"))
PER_DOCUMENT = [n for n in NUMBERED if int(n[2:n.index("_")]) in (1, 2, 3, 4, 5, 6, 8, 9, 11, 13)]


def tables():
    r = random.Random(12)
    words = "river stone light paper garden window market yellow friend letter simple answer".split()
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs = [(k, line(r.randrange(3, 60)), r.choice(["en", "de", None]), "s") for k in range(40)]
    docs += [(40, None, "en", None), (41, "", None, "s"), (42, " \t\n", "en", "s"), (43, line(20_000), "de", "s"), (44, "x" * 10_000, "en", "s")]
    docs += [(45, "Mail a.b@example.org now", "en", "s")] * 3 + [(0, *docs[0][1:])] + [(None, "no id", "en", "s"), (1, None, "en", "s")]
    pages = [(k, None, "<p>" + line(300) + "</p>") for k in range(4)]
    pages += [(5, "u", pages[0][2]), (6, "u", pages[0][2]), (7, "u", None), (8, None, ""), (9, "u", line(50_000)), (9, "u", "<b>")]
    talk = [(c, t, ("user", "assistant")[t % 2], line(5)) for c in range(5) for t in range(3)]
    talk += [(1, 1, "user", None), (2, None, None, "x"), (2, None, None, "x"), (3, 9, "user", line(20_000)), (None, 0, "user", "y")]
    return {
        "documents": docs, "pages": pages, "conversations": talk,
        "labels": [(k, k % 2, k % 3 % 2) for k in range(45)] + [(0, 0, 0), (None, 1, 1), (3, None, None), (40, 1, 1)],
        "benchmark": [(1, docs[3][1]), (2, None), (3, ""), (1, docs[3][1])],
    }


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for case in ("empty", "plain", "clash"):
        out[case] = str(tmp_path_factory.mktemp(case))
        for name, rows in tables().items():
            df = spark.createDataFrame([] if case == "empty" else rows, KINDS[name])
            if case == "clash":
                df = df.select("*", *[F.lit(f"own-{c}").alias(c) for c in CLASH if c not in df.columns])
            df.coalesce(2).write.parquet(os.path.join(out[case], f"{name}.parquet"))
    return out


def found(spark, name, folder):
    df = QUERIES[name](spark, folder)
    return df.columns, sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", NUMBERED)
def test_empty_tables(spark, folders, name):
    # The template of op10 is tried on a conversation of its own.
    assert len(found(spark, name, folders["empty"])[1]) == (1 if name.startswith("op10") else 0)


@pytest.mark.parametrize("name", NUMBERED)
def test_odd_rows_and_clashing_columns(spark, folders, name):
    columns, rows = found(spark, name, folders["plain"])
    assert (columns, rows) == found(spark, name, folders["clash"])
    if name in PER_DOCUMENT:
        assert len(rows) == len(tables()["documents"])
    if name.startswith("op7"):
        assert len(rows) == len(tables()["pages"])
