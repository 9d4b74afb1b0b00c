"""Ids that recur with different texts."""

from spillway.llm.near_dedup import near_dedup

DOCS = "doc_id long, text string"


def text(name, n=60, end=""):
    return " ".join(f"{name}{i}" for i in range(n)) + end


def test_an_id_with_two_texts(spark):
    docs = [(1, text("a")), (1, text("b")), (2, text("a", end=" x")), (3, text("b", end=" y")), (4, text("c")), (5, text("d")), (6, text("c", end=" z")), (6, text("d", end=" z"))]
    got = near_dedup(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 4), (6, 4)]
