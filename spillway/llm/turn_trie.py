"""The trie of conversation prefixes, built as burst tries over Spark shards.

A node stands for a distinct sequence of first turns. Rows stay narrow: a turn is the
16-byte digest of its role and text and a word count.

1. Equal conversations form a class; only one conversation of a class goes on, with the
   number of its members (``classes``).
2. All suffixes start in one container under the root. A container with more than
   ``limit`` turns bursts: its head becomes a node and its suffixes go to containers
   under the head's children, by their next turn id. This repeats until no container is
   oversized (``burst``); each round is a grouped count, a join and a join with one turn.
3. Shards hold what is left, many containers each. A container's suffixes are sorted
   and swept into nodes, those with a common prefix side by side (``sweep``). A suffix that
   is alone in its container is a chain: one without copies is read off its rows
   without a shuffle, one with copies is streamed, so neither needs room for its length.
4. Leaves and saved words of burst heads are summed from their children, deepest first.

No step holds more than ``limit`` turns of a group, however many conversations share
a beginning and however long they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map
from spillway.operators.ordering import number_rows, stage
from spillway.session import materialise

#: Turns of a container that doesn't burst.
LIMIT = 4096
#: Bytes of an id list that travel in one row.
PIECE = 1 << 20
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, under binary"


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(``conv``, ``pos``, ``t``, ``words``) of rows (conv_id, turn, role, text).

    ``pos`` counts a conversation's rows from 0 by turn (null first), ties by the turn's digest; repeated rows
    count each. ``t`` is a digest of role and text, null being empty; ``words`` counts the text's words. Rows
    without a conv_id belong to no conversation and are left out. No task sees a conversation as a whole.
    """
    filled = lambda c: F.coalesce(F.col(c), F.lit(""))
    narrow = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.unhex(F.md5(F.concat(F.md5(filled("role")), F.md5(filled("text"))))).alias("t"),
        F.regexp_count(filled("text"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    return number_rows(stage(narrow, ["conv"], ["turn", "t"]), ["conv"], "pos").select("conv", "pos", "t", "words")


def reopened(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, len) and their turns, with beginnings taken from the first of each family.

    Conversation c starts with the first h turns of conversation c - c % ``family`` (all if it has fewer, none
    if there is none) and goes on with its own turns after its first h; h is the crc32 of c modulo ``most``.
    """
    sizes = materialise(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "sizes")
    heads = sizes.select("conv", "n", (F.col("conv") - F.col("conv") % family).alias("base"), F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most)).alias("h"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("there"))
    heads = heads.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    heads = materialise(heads, "heads")
    first = turns.where(F.col("pos") < most - 1).withColumnRenamed("conv", "base")
    opening = heads.select("conv", "base", "h").join(first, "base").where("pos < h").select("conv", "pos", "t", "words")
    own = turns.join(heads.select("conv", "h", "taken"), "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "t", "words")
    return heads.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), opening.unionByName(own)


def classes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Classes of equal conversations: ``cls`` (smallest member), ``n`` members, ``len`` turns, ``sha`` of the members' ids."""
    marks = turns.groupBy("conv").agg(F.expr("bit_xor(xxhash64(pos, t))").alias("a"), F.expr("bit_xor(xxhash64(t, pos, 7))").alias("b"))
    zero = F.lit(0).cast("long")
    told = materialise(convs.join(marks, "conv", "left").select("conv", "len", F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b")), "marks")
    found = materialise(told.groupBy("len", "a", "b").agg(F.min("conv").alias("cls"), F.count(F.lit(1)).alias("n")), "classes")
    members = told.join(found.where("n > 1"), ["len", "a", "b"]).select("cls", "conv")
    many = found.where("n > 1").join(member_digests(members), "cls").select("cls", "n", "len", "sha")
    return found.where("n = 1").select("cls", "n", "len", F.sha2(F.col("cls").cast("string"), 256).alias("sha")).unionByName(many)


def member_digests(members: DataFrame) -> DataFrame:
    """(``cls``, ``sha``): SHA-256 of each class's ids (cls, conv) in ascending order, joined by commas.

    Ids are joined where a range of (cls, conv) lies, so a large class is joined by many tasks; only
    the pieces of text, 1 MB each, meet in the task that hashes them one after the other.
    """
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(batches):
        key, held, first, size = None, [], 0, 0
        for b in batches:
            cls, conv = b.column("cls").to_numpy(), b.column("conv").to_numpy()
            cuts = np.r_[0, np.nonzero(np.diff(cls))[0] + 1, len(cls)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if hi > lo and (cls[lo] != key or size > PIECE):
                    if held:
                        yield piece(key, first, held)
                    key, held, first, size = int(cls[lo]), [], int(conv[lo]), 0
                if hi > lo:
                    held.append(",".join(map(str, conv[lo:hi].tolist())))
                    size += len(held[-1])
        if held:
            yield piece(key, first, held)

    def piece(key, first, held):
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([first]), pa.array([",".join(held).encode()], pa.binary())], ["cls", "first", "ids"])

    def digest(batches):
        key, sha = None, None
        for b in batches:
            out = []
            for cls, ids in zip(b.column("cls").to_pylist(), b.column("ids").to_pylist()):
                if cls != key:
                    if sha:
                        out.append((key, sha.hexdigest()))
                    key, sha = cls, hashlib.sha256(ids)
                else:
                    sha.update(b"," + ids)
            if out:
                yield digests(out)
        if sha:
            yield digests([(key, sha.hexdigest())])

    def digests(out):
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([x for _, x in out])], ["cls", "sha"])

    placed = members.repartitionByRange(n, "cls", "conv").sortWithinPartitions("cls", "conv")
    pieces = arrow_map(placed, join, "cls long, first long, ids binary")
    return arrow_map(pieces.repartition("cls").sortWithinPartitions("cls", "first"), digest, "cls long, sha string")


def burst(found: DataFrame, turns: DataFrame, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """Bursts oversized containers by next turn id, round by round.

    Returns what settled (a row per class: its container ``head`` at ``depth``, ``up`` and ``under`` of the burst
    head above) and the burst heads of each round.
    """
    null = lambda kind: F.lit(None).cast(kind)
    at = found.select("cls", "n", "len", "sha", "head", null("long").alias("up"), null("binary").alias("under"), F.lit(0).cast("long").alias("words"))
    settled, rounds, depth = [], [], 0
    while True:
        ends = F.col("len") == depth
        heads = at.groupBy("head").agg(
            F.count(F.lit(1)).alias("classes"), F.sum(F.col("len") - depth).alias("turns"), F.sum("n").alias("n_convs"), F.min("cls").alias("conv_id"),
            F.max("up").alias("up"), F.max("under").alias("under"), F.max("words").alias("words"), F.max(F.when(ends, F.col("sha"))).alias("sha"),
        )
        heavy = materialise(heads.where((F.col("classes") > 1) & (F.col("turns") > limit)), "burst")
        if heavy.isEmpty():
            settled.append(at.withColumn("depth", F.lit(depth).cast("long")))
            return materialise(settled[0] if len(settled) == 1 else _union(settled), "settled"), rounds
        settled.append(at.join(heavy.select("head"), "head", "left_anti").withColumn("depth", F.lit(depth).cast("long")))
        going = at.where(~ends).join(heavy.select("head", "conv_id"), "head").select("cls", "n", "len", "sha", "head", F.col("conv_id").alias("up"))
        following = turns.where(F.col("pos") == depth).select(F.col("conv").alias("cls"), "t", "words")
        at = going.join(following, "cls").select("cls", "n", "len", "sha", F.unhex(F.md5(F.concat("head", "t"))).alias("below"), "up", F.col("head").alias("under"), "words")
        at = materialise(at.withColumnRenamed("below", "head"), "containers")
        rounds.append(heavy)
        depth += 1


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def swept(depth: int, up: int | None, words: int, suffixes: list[tuple[list[bytes], list[int], int, int, str]]) -> list[tuple]:
    """Nodes of a container whose head has ``depth`` turns, the head first.

    A suffix is (turn ids, words of each, class, members, digest of their ids). Sorted, suffixes with a common
    prefix stand side by side: each adds the nodes below what it shares with the one before.
    """
    parent, level, size, end = [-1], [depth], [words], [EMPTY]
    convs, least = [0], [None]
    path, before = [0], []
    for turns, counts, cls, n, sha in sorted(suffixes, key=lambda s: s[0]):
        k = 0
        while k < len(before) and k < len(turns) and before[k] == turns[k]:
            k += 1
        del path[k + 1 :]
        for j in range(k, len(turns)):
            parent.append(path[-1])
            path.append(len(level))
            level.append(depth + j + 1)
            size.append(counts[j])
            end.append(EMPTY)
            convs.append(0)
            least.append(None)
        convs[path[-1]], least[path[-1]], end[path[-1]] = n, cls, sha
        before = turns
    children, leaves, saved = [0] * len(level), [0] * len(level), [0] * len(level)
    for i in range(len(level) - 1, -1, -1):  # children come after their parents
        leaves[i] = leaves[i] or 1
        saved[i] += (convs[i] - 1) * size[i]
        p = parent[i]
        if p >= 0:
            convs[p] += convs[i]
            least[p] = least[i] if least[p] is None else min(least[p], least[i])
            children[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    return [(least[i], level[i], least[parent[i]] if i else up, convs[i], children[i], leaves[i], saved[i], end[i]) for i in range(len(level))]


def sweep(shards: DataFrame) -> DataFrame:
    """Nodes of the containers of a shard; rows come sorted by (head, cls, pos), a class's own row (pos -1) first."""
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
    names = [c.split()[0] for c in NODE.split(", ")]

    def batch(nodes):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*nodes), kinds)], names)

    def run(batches):
        out, head, suffixes, top, alone = [], None, [], None, None
        for b in batches:
            for h, cls, pos, t, words, n, length, sha, depth, up, under, classes_, total in zip(*(c.to_pylist() for c in b.columns)):
                if h != head:
                    if suffixes:
                        nodes = swept(*top[:3], suffixes)
                        out += [(*nodes[0], top[3]), *((*x, None) for x in nodes[1:])]
                    head, suffixes, top, alone = h, [], (depth, up, words, under), None
                    if classes_ == 1:  # a chain, streamed
                        alone = [cls, n, length, sha, (n - 1) * (total + words)]
                        out.append((cls, depth, up, n, int(depth < length), 1, alone[4], sha if depth == length else EMPTY, under))
                        alone[4] -= (n - 1) * words
                        continue
                if alone:
                    out.append((cls, pos + 1, cls, alone[1], int(pos + 1 < alone[2]), 1, alone[4], alone[3] if pos + 1 == alone[2] else EMPTY, None))
                    alone[4] -= (alone[1] - 1) * words
                elif pos < 0:
                    suffixes.append(([], [], cls, n, sha))
                else:
                    suffixes[-1][0].append(t)
                    suffixes[-1][1].append(words)
                if len(out) > 1 << 12:
                    yield batch(out)
                    out = []
        if suffixes:
            nodes = swept(*top[:3], suffixes)
            out += [(*nodes[0], top[3]), *((*x, None) for x in nodes[1:])]
        if out:
            yield batch(out)

    return arrow_map(shards.repartition("head").sortWithinPartitions("head", "cls", "pos"), run, NODE)


def prefix_trie(convs: DataFrame, turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row per node of the trie of conversations (conv, len) with ``turns`` (conv, pos, t, words; pos from 0 without gaps).

    ``conv_id`` (smallest member) and ``depth`` name a node; ``parent_conv_id`` is the parent's conv_id (root: null),
    ``n_convs`` the members, ``n_children`` and ``n_leaves`` (childless nodes of the subtree, itself included) its
    shape, ``saved_tokens`` the subtree's sum of (n_convs - 1) * words of the last turn, ``ends_sha256`` the digest
    of the ids, ascending and comma-joined, of members with ``depth`` turns. A conversation without turns is a
    member of the root; without conversations there is no node.
    """
    turns = materialise(turns, "turns")
    # The root's head is stored: joined as a constant it would be no key.
    found = materialise(classes(convs, turns).withColumn("head", F.unhex(F.md5(F.lit("")))), "classes")
    suffixes = materialise(turns.join(found.select(F.col("cls").alias("conv")), "conv", "left_semi"), "suffixes")
    settled, rounds = burst(found, suffixes, limit)

    sizes = settled.groupBy("head").agg(F.count(F.lit(1)).alias("classes"))
    settled = materialise(settled.join(materialise(sizes, "containers"), "head"), "settled")
    below = suffixes.withColumnRenamed("conv", "cls")
    single = settled.where("classes = 1 AND n = 1")
    end = lambda depth: F.when(depth == F.col("len"), F.col("sha")).otherwise(F.lit(EMPTY))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def chain(rows, depth, parent, under):
        child = (depth < F.col("len")).cast("long")
        return rows.select(F.col("cls").alias("conv_id"), depth.alias("depth"), parent.alias("parent_conv_id"), one.alias("n_convs"), child.alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"), end(depth).alias("ends_sha256"), under.alias("under"))

    tops = chain(single, F.col("depth"), F.col("up"), F.col("under"))
    rest = chain(below.drop("words", "t").join(single.select("cls", "len", "sha", "depth"), "cls").where("pos >= depth"), F.col("pos") + 1, F.col("cls"), F.lit(None).cast("binary"))

    shared = settled.where("NOT (classes = 1 AND n = 1)")
    turns_of = below.join(shared.select("cls", "head", "depth"), "cls").where("pos >= depth").select("head", "cls", "pos", "t", "words")
    totals = turns_of.groupBy("cls").agg(F.sum("words").alias("total"))
    own = shared.join(totals, "cls", "left").select("head", "cls", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("t"), "words", "n", "len", "sha", "depth", "up", "under", "classes", F.coalesce("total", zero).alias("total"))
    nodes = materialise(sweep(own.unionByName(turns_of, allowMissingColumns=True)), "swept")

    out = [nodes, tops, rest]
    children = _union([x.where("under IS NOT NULL").select("under", "n_leaves", "saved_tokens") for x in (nodes, tops)])
    for depth in range(len(rounds) - 1, -1, -1):
        sums = children.groupBy(F.col("under").alias("head")).agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        heads = rounds[depth].join(sums, "head").select(
            "conv_id", F.lit(depth).cast("long").alias("depth"), F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            (F.col("below") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256"), "under",
        )
        heads = materialise(heads, "heads")
        out.append(heads)
        children = children.unionByName(heads.where("under IS NOT NULL").select("under", "n_leaves", "saved_tokens"))
    return _union(out).drop("under")
