"""One query per operator, over whole given tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from spillway.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Where the public tokenizers' files are.
TOKENIZERS = "/opt/tokenizers"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@query("op2_decontaminate", r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + least(len(w), 10) - 1) AS win
  FROM bw, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT len(win) AS n FROM windows
), places AS (
  SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS win
  FROM dw, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS s) WHERE len(w) >= n
), found AS (SELECT p.doc_id, p.s, p.n, x.item_id FROM places p JOIN windows x ON p.win = x.win
), hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS k FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op2(spark, sf_dir):
    from spillway.llm.decontaminate import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op6_exact_dedup", """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
""")
def op6(spark, sf_dir):
    from spillway.llm.exact_dedup import dedup_exact

    return dedup_exact(table(spark, sf_dir, "documents"))


@query("op7_warc", """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM f
""")
def op7(spark, sf_dir):
    from spillway.llm.warc import read_archives, with_revisits, write_archives
    from spillway.session import materialise

    archives = materialise(write_archives(with_revisits(table(spark, sf_dir, "pages"))), "warc")
    read = read_archives(archives)
    return every_page(read)


def every_page(read):
    """One row per record; a damaged one ends the query, as its page would be missing."""
    number = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).try_cast("long")
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("damaged record: "), "error")).cast("long")).otherwise(F.col("payload_bytes"))
    return read.select(
        number("record_id").alias("page_id"), sound.alias("payload_bytes"), "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


@query("op10_chat", r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), e AS (
  SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS n FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n + length('<|im|>') + length('<|say|>') + length('<|end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op10(spark, sf_dir):
    from spillway.llm.chat import digests, format_chat

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)
    return digests(format_chat(rows.unionByName(extra), f"{TOKENIZERS}/byte_bpe_50k.json"))


@query("op1_substring_dedup")
def op1(spark, sf_dir):
    from spillway.llm.substring_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


@query("op3_near_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(list_slice(w, k, k + 2)) AS h
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS via FROM documents
  UNION SELECT r.node, CASE WHEN l.a = r.via THEN l.b ELSE l.a END FROM reach r JOIN links l ON r.via IN (l.a, l.b)
), c AS (SELECT node AS doc_id, min(via) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
""")
def op3(spark, sf_dir):
    from spillway.llm.near_dedup import near_dedup

    return near_dedup(table(spark, sf_dir, "documents")).drop("class_id")


@query("op9_sentencepiece")
def op9(spark, sf_dir):
    from spillway.llm.pieces import encode_and_decode

    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = encode_and_decode(docs, model)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("same"),
    )


@query("op4_language")
def op4(spark, sf_dir):
    from spillway.llm.language import identify, remainder, train_on

    docs = table(spark, sf_dir, "documents")
    said = identify(docs.select("doc_id", "text"), train_on(docs))
    return said.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op8_toxicity")
def op8(spark, sf_dir):
    from spillway.llm.language import remainder
    from spillway.llm.toxicity import THRESHOLD, score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    network = train(docs.withColumnRenamed("doc_id", "id"), labels.select(F.col("doc_id").alias("id"), "toxic"))
    scored = score(docs, network)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@query("op5_pii")
def op5(spark, sf_dir):
    from spillway.llm.pii import KINDS, find, labelled_table, train

    found = find(table(spark, sf_dir, "documents"), train(labelled_table()))
    said = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(said("base"), 256).alias("base_sha256"), said("spans").alias("spans"))


@query("op11_quality")
def op11(spark, sf_dir):
    from spillway.llm.language import remainder
    from spillway.llm.quality import THRESHOLD, score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    network = train(docs.withColumnRenamed("doc_id", "id"), labels.select(F.col("doc_id").alias("id"), "quality"))
    scored = score(docs, network)
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@query("op12_turn_trie", r"""
WITH RECURSIVE crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS r FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT conv_id, s, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(r, CAST(ascii(substr(s, k // 8 + 1, 1)) AS BIGINT)) ELSE r END AS x FROM crc WHERE k < 8 * length(s))
), heads AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(r, 4294967295) % 4 AS h FROM crc WHERE k = 8 * length(s)
), turns AS (
  SELECT conv_id, t, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) - 1 AS pos
  FROM (SELECT conv_id, turn, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS t, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
        FROM conversations WHERE conv_id IS NOT NULL)
), sizes AS (SELECT conv_id AS base, count(*) AS n FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT heads.conv_id, pos, t, w FROM heads JOIN turns ON turns.conv_id = base AND pos < h
  UNION ALL
  SELECT conv_id, pos - h + least(h, coalesce(n, 0)), t, w FROM heads JOIN turns USING (conv_id) LEFT JOIN sizes USING (base) WHERE pos >= h
), paths AS (
  SELECT conv_id, pos + 1 AS depth, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY pos) AS path, w FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 0 FROM heads
), nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, min(w) AS w FROM paths GROUP BY depth, path
), lasts AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id
), ends AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM paths JOIN lasts USING (conv_id, depth) GROUP BY path
), kids AS (SELECT left(path, CAST(32 * (depth - 1) AS BIGINT)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), subtrees AS (
  SELECT left(path, CAST(32 * d AS BIGINT)) AS path, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * w) AS saved
  FROM (SELECT path, n_convs, w, n_children, unnest(range(0, depth + 1)) AS d FROM nodes LEFT JOIN kids USING (path)) GROUP BY 1
)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes a JOIN subtrees s USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes p ON a.depth > 0 AND p.path = left(a.path, CAST(32 * (a.depth - 1) AS BIGINT))
""")
def op12(spark, sf_dir):
    from spillway.llm.turn_trie import numbered_turns, prefix_trie, reopened
    from spillway.session import materialise

    turns = materialise(numbered_turns(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie(*reopened(turns))


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    from spillway.llm.periodic import find_runs

    found = find_runs(rewritten(table(spark, sf_dir, "documents").select("doc_id", "text")))
    # The longest run; of equal ones that of the smallest start, then period.
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS n, r.start, r.period)))")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.n")).alias("length"), F.col("top.period").alias("period"),
        F.expr("1000 * -top.n div top.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def rewritten(docs):
    """Where h = crc32(doc_id) is a multiple of 10, the words from word a on become a repetition of p words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w != '')")
    told = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    told = told.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    told = told.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    told = told.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(sequence(0, n - 1), i -> w[CAST(IF(i < a, i, a + (i - a) % p) AS INT)]), ' ')")
    return told.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))
