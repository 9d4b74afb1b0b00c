"""A training corpus from raw documents: language, exact copies, near copies, benchmark leaks, pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spillway.llm.catalog import TOKENIZERS
from spillway.llm.common import sieve, table
from spillway.llm.decontaminate import decontaminate
from spillway.llm.exact_dedup import drop_copies
from spillway.llm.language import UNDETERMINED, identify, train_on
from spillway.llm.near_dedup import near_dedup
from spillway.llm.pieces import encode_and_decode
from spillway.session import materialise

#: Documents whose language is less sure than this are rejected.
SURE = 0.5


def row_key(doc_id: Column, text: Column, kind: str) -> Column:
    """Names a row by doc_id and text, never null, in the order of doc_id; rows without one come last.

    Rows that agree in both share a key, and every stage decides alike on them. Whole numbers go by value, other ids as text.
    """
    if kind in ("tinyint", "smallint", "int", "bigint"):
        place = F.lpad((doc_id.cast("decimal(20,0)") + F.expr("9223372036854775808BD")).cast("decimal(20,0)").cast("string"), 20, "0")
    else:
        place = doc_id.cast("string")
    named = F.when(doc_id.isNull(), "1").otherwise(F.concat(F.lit("0"), place))
    return F.concat(named, F.lit("\0"), F.md5(F.coalesce(text, F.lit(""))), text.isNull().cast("string"))


def plain(docs: DataFrame) -> tuple[DataFrame, list[Column], str]:
    """``docs`` under names of our own, so that no column of theirs clashes; the way back; the text's name."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    back = [F.col(n).alias(c) for n, c in zip(names, docs.columns)]
    return docs.toDF(*names), back, names[docs.columns.index("text")]


def with_key(docs: DataFrame) -> tuple[DataFrame, list[Column], str]:
    rows, back, text = plain(docs)
    k = docs.columns.index("doc_id")
    return rows.withColumn("key", row_key(F.col(f"c{k}"), F.col(text), docs.dtypes[k][1])), back, text


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` whose key is not among those of ``gone``. Whole rows move only where a sieve lets their key pass."""
    gone = materialise(gone.select("key"), "gone")
    rows = rows.withColumn("may", sieve(gone, "key")(F.col("key")))
    return rows.where("NOT may").unionByName(rows.where("may").join(gone, "key", "left_anti"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a learnt language; the model learns from the labelled ones among them.

    Null and empty texts, and those without a letter, have no language and go. Rows are judged one by one,
    so repeated ones alike; an empty table stays empty. All columns are kept, whatever their names.
    """
    rows, back, text = plain(docs)
    told = identify(rows, train_on(docs), text_col=text, name="lang", score="score")
    return told.where((F.col("lang") != UNDETERMINED) & (F.col("score") >= SURE)).select(*back)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays.

    Null texts count as empty; of rows that agree in doc_id too, any one stays, whatever else they hold.
    An empty table stays empty. All columns are kept, whatever their names.
    """
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents (five-word shingles, similarity 0.8 or more) the one with the smallest doc_id stays.

    Texts without words are linked with nothing and stay. Rows that agree in doc_id and text stay or go together.
    An empty table stays empty. All columns are kept, whatever their names.
    """
    rows, back, text = with_key(docs)
    gone = near_dedup(rows, id_col="key", text_col=text, size=5, threshold=80).where("NOT kept")
    return without(rows, gone).select(*back)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go.

    Texts without words, null ones too, stay, as does all without a benchmark. Rows that agree in doc_id and
    text stay or go together. An empty table stays empty. All columns are kept, whatever their names.
    """
    rows, back, text = with_key(docs)
    gone = decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col="key", text_col=text).where("contaminated")
    return without(rows, gone).select(*back)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back.

    A null text has null ids (``n_pieces`` -1 or null) and is the same; an empty one has none. A row per row.
    """
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    back = encode_and_decode(docs.select("doc_id", "text"), model)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("same"))


STAGES = [("language", language), ("exact", exact), ("near", near), ("leaks", leaks), ("pieces", pieces)]

#: A trained model can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


query = run
