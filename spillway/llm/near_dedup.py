"""MinHash near-dedup with sequential Bayesian verification.

1. Documents with the same shingle set form a class; one of it goes on.
2. Bands of MinHash values put classes into buckets. They are as long as leaves a pair
   at the threshold without a common bucket ``UNSEEN`` times at most; at 0.85 that is 32
   bands of 7 and (1 - 0.85 ** 7) ** 32, 4 in a million. Buckets that hold the same classes as another are dropped.
3. Pairs of a bucket are compared a few signature values at a time. With a uniform prior the
   posterior of the similarity after m of n matches is Beta(m + 1, n - m + 1); a pair
   goes once its chance to reach the threshold is below ``MISS``. Only signatures travel here. What the
   survivors connect is a *family*; a bucket of more than ``BLOCK`` classes is one as it is.
4. Full sets are made for families of several classes alone (texts of others do not move, but for a few in 100) and move once, to a block of their family (``BLOCK`` classes
   or ``BYTES`` of sets at most). Surviving pairs of a block are verified exactly, most similar
   first; pairs that are already connected need no check.
5. In a family of several blocks, one class of each connected part meets those of the other blocks. Only if it still
   falls into parts, all that is outside its largest part meets every block (``across``). So near copies of
   one text cost in proportion to their number, and no link is lost.
6. Components by alternating large and small stars, where links are no stars yet; those of blocks and of their heads are, and take no round.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, functions as F

from spillway.llm.common import arrow_map, sieve, utf8
from spillway.session import materialise

HASHES = 224
UNSEEN = 2e-5
BATCH = 32
MISS = 1e-5
#: Classes of a block, and bytes of their sets.
BLOCK, BYTES = 1024, 1 << 25

_RANDOM = np.random.default_rng(85)
_TIMES = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2)
_WORD: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_WORD) > 1 << 17:
        _WORD.clear()
    get = _WORD.get
    out = [get(w) for w in words]
    if None in out:
        for i, x in enumerate(out):
            if x is None:
                out[i] = _WORD.setdefault(words[i], xxhash.xxh3_64_intdigest(words[i]))
    return np.array(out, np.uint64)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle, one without words has none."""
    h = word_hashes((text or b"").lower().split())
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    with np.errstate(over="ignore"):
        x = np.full(n, min(len(h), size), np.uint64)
        for k in range(min(size, len(h))):
            x = (x ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(32)
    return np.unique(x)


def minhashes(s: np.ndarray) -> np.ndarray:
    out = np.full(len(_TIMES), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 512):
            out = np.minimum(out, (s[at : at + 512, None] * _TIMES + _PLUS).min(axis=0))
    return out


def band_length(threshold: int) -> int:
    """The longest bands that find pairs at the threshold."""
    return max([1, *(r for r in range(1, 33) if (1 - (threshold / 100) ** r) ** (HASHES // r) <= UNSEEN)])


def features(own: DataFrame, kind: str, size: int, length: int) -> DataFrame:
    """Per row: id, n_shingles, a key of the whole set, band keys, one byte of each MinHash."""

    bands = HASHES // length

    def run(batches):
        for b in batches:
            cols = [[], [], [], []]
            for text in utf8(b.column("text")):
                s = shingles(text, size)
                m = minhashes(s)
                with np.errstate(over="ignore"):
                    key = m[: bands * length].reshape(bands, length)
                    band = np.arange(bands, dtype=np.uint64)
                    for k in range(length):
                        band = (band ^ key[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
                        band ^= band >> np.uint64(31)
                for c, v in zip(cols, (len(s), xxhash.xxh3_128_digest(s.tobytes()), band.view(np.int64), (m >> np.uint64(24)).astype(np.uint8).tobytes())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())))], ["id", "n_shingles", "set_key", "bands", "sig"]
            )

    return arrow_map(own.select("id", "text"), run, f"id {kind}, n_shingles long, set_key binary, bands array<long>, sig binary")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, threshold: int = 85) -> DataFrame:
    """Per row: id, ``n_shingles``, ``class_id``, ``component_id``, ``kept``.

    Words are separated by ASCII white space, A-Z lower-cased. Rows are linked when
    100 * |intersection| >= threshold * |union| of their sets of distinct ``size``-word
    shingles. ``class_id`` is the smallest id with the same set, ``component_id`` the smallest
    reachable, ``kept`` whether it is the row's own. Null or empty texts have no shingle and are
    linked with nothing. Rows that repeat an id with different texts are linked through it; a
    row without an id is kept and not linked. An empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    seen = materialise(features(own, kind, size, band_length(threshold)), "minhash")
    with_sets = seen.where("n_shingles > 0 AND id IS NOT NULL")
    classes = with_sets.groupBy("set_key").agg(F.min("id").alias("class_id"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes = materialise(classes, "classes")

    families = materialise(families_of(classes, threshold), "families")
    # A text is found by its class's id and told from others of that id by the key of its set.
    wanted = classes.where(sieve(families, "set_key")(F.col("set_key"))).select("set_key", "class_id", "size", "sig")
    wanted = materialise(families.join(wanted, "set_key"), "wanted")
    texts = own.where(sieve(wanted, "class_id")(F.col("id"))).withColumnRenamed("id", "class_id").join(wanted, "class_id").dropDuplicates(["class_id", "set_key", "text"])
    sets = materialise(sets_of(texts, size), "sets")
    links = within(sets.withColumn("g", F.xxhash64("family", "block")), threshold)
    found, more = across(sets, materialise(links, "links"), threshold)

    # An id with several sets links their classes.
    key = F.xxhash64("set_key")
    recurring = with_sets.groupBy("id").agg(F.min(key).alias("least"), F.max(key).alias("most"), F.min("set_key").alias("low")).where("least != most").select("id", "low")
    recurring = materialise(recurring, "recurring")
    if not recurring.isEmpty():
        again = with_sets.join(recurring, "id").select("low", F.col("set_key").alias("high")).where("low != high").distinct()
        more = again if more is None else more.unionByName(again)
    if more is not None:
        stars = found.where("set_key != part").select(F.col("part").alias("low"), F.col("set_key").alias("high"))
        found = components(materialise(stars.unionByName(more), "links")).toDF("set_key", "part")

    keyed = materialise(classes.select("set_key", "class_id").join(found.select("set_key", "part"), "set_key", "left"), "keyed")
    linked = keyed.where("part IS NOT NULL")
    first = materialise(linked.groupBy("part").agg(F.min("class_id").alias("component_id")), "components")
    named = linked.join(first, "part").select("set_key", "class_id", "component_id")
    named = named.unionByName(keyed.where("part IS NULL").select("set_key", "class_id", F.col("class_id").alias("component_id")))
    alone = F.col("n_shingles") == 0
    joined = seen.select("id", "n_shingles", "set_key").join(materialise(named, "named"), "set_key", "left")
    return joined.select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(alone | F.col("id").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone | F.col("id").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(alone | F.col("id").isNull() | (F.col("id") == F.col("component_id")), F.lit(True)).alias("kept"),
    )


def families_of(classes: DataFrame, threshold: int) -> DataFrame:
    """(``set_key``, ``family``, ``block``, ``blocks``) of the classes that signatures connect with another."""
    # Here all bands of all classes move, so a class goes by a number; only those of the buckets that count move again. Classes of one number only meet too often.
    named = classes.select(F.xxhash64("set_key").alias("class"), "set_key", "size", "sig")
    members = classes.select(F.xxhash64("set_key").alias("class"), F.posexplode("bands").alias("band", "bucket"))
    who = F.bit_xor("class").alias("who")
    buckets = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), who, F.min("band").alias("band")).where("n > 1")
    buckets = materialise(buckets.groupBy("n", "who").agg(F.min_by("bucket", "band").alias("bucket")), "buckets")
    members = members.select("class", "bucket").where(sieve(buckets, "bucket")(F.col("bucket")))
    members = materialise(members.join(buckets.select("bucket", "n"), "bucket"), "members")

    crowds = members.where(F.col("n") > BLOCK).join(named.select("class", "set_key"), "class")
    firsts = materialise(crowds.groupBy("bucket").agg(F.min("set_key").alias("first")), "firsts")
    large = crowds.join(firsts, "bucket").where("first != set_key").select(F.col("first").alias("low"), F.col("set_key").alias("high"))
    small = members.where(F.col("n") <= BLOCK).select("class", F.col("bucket").alias("g")).join(named.where(sieve(members, "class")(F.col("class"))), "class").drop("class")
    edges = within(small, threshold).unionByName(large).distinct()
    found = components(materialise(edges, "candidates")).toDF("set_key", "family")
    sizes = found.join(classes.select("set_key", "size"), "set_key").groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") * 8 / BYTES)).cast("int")
    sizes = materialise(sizes.select("family", blocks.alias("blocks")), "sizes")
    return found.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("set_key"), "blocks").cast("int"))


def sets_of(texts: DataFrame, size: int) -> DataFrame:
    """Rows whose text has the set of their key, with that set in place of the text."""
    kept = ["set_key", "family", "block", "blocks", "size", "sig"]

    def run(batches):
        for b in batches:
            sets = [shingles(t, size).tobytes() for t in utf8(b.column("text"))]
            own = pa.array([xxhash.xxh3_128_digest(s) == k for s, k in zip(sets, b.column("set_key").to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(sets, pa.binary())], [*kept, "shingles"]).filter(own)

    return arrow_map(texts.select(*kept, "text"), run, "set_key binary, family binary, block int, blocks int, size long, sig binary, shingles binary")


@cache
def least_matches(threshold: int, total: int) -> tuple[tuple[int, int], ...]:
    """After n values: how many must match for the posterior chance of the threshold to be ``MISS`` or more."""
    grid = (np.arange(20000) + 0.5) / 20000
    # Only one byte of each value is compared: unequal values agree in it once in 256.
    p = np.log(grid + (1 - grid) / 256), np.log((1 - grid) * 255 / 256)
    high, out = grid >= threshold / 100, []
    for n in range(BATCH, total + 1, BATCH):
        for m in range(n + 1):
            w = m * p[0] + (n - m) * p[1]
            w = np.exp(w - w.max())
            if w[high].sum() >= MISS * w.sum():
                break
        out.append((n, m))
    return tuple(out)


class Forest:
    """Union-find over 0 .. n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def connected(rows: pa.Table, threshold: int) -> list[tuple[bytes, bytes]]:
    """Links that connect what is linked among rows (set_key, size, sig); exact where there are ``shingles``.

    With ``guest`` and ``part`` only guests are compared, with rows that are no guests and belong to another part.
    """
    keys = rows["set_key"].to_pylist()
    first = {k: i for i, k in reversed(list(enumerate(keys)))}
    guest = rows["guest"].to_numpy() if "guest" in rows.column_names else None
    if guest is None and len(first) < len(keys):
        rows = rows.take(sorted(first.values()))
        keys = rows["set_key"].to_pylist()
    size = rows["size"].to_numpy()
    sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint8).reshape(len(keys), -1)
    sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()] if "shingles" in rows.column_names else None
    part = rows["part"].to_pylist() if guest is not None else None
    rules, held = least_matches(threshold, sig.shape[1]), []
    names = np.unique(np.array([p.hex() for p in part]), return_inverse=True)[1] if part else None
    for i in np.nonzero(guest)[0].tolist() if guest is not None else range(len(keys) - 1):
        j = np.nonzero(~guest & (names != names[i]))[0] if guest is not None else np.arange(i + 1, len(keys))
        # The sizes alone bound the similarity.
        j = j[100 * np.minimum(size[j], size[i]) >= threshold * np.maximum(size[j], size[i])]
        n0, m = 0, np.zeros(len(j), np.int64)
        for n, least in rules:
            if not len(j):
                break
            m = m + (sig[j, n0:n] == sig[i, n0:n]).sum(axis=1)
            n0, keep = n, m >= least
            j, m = j[keep], m[keep]
        if len(j):
            held.append((np.full(len(j), i), j, m))
    if not held:
        return []
    forest = Forest(len(keys))
    a, b, m = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(-m, kind="stable")
    at = np.array([first[k] for k in keys]) if guest is not None else np.arange(len(keys))  # rows of one class are one
    for x, y in zip(a[order].tolist(), b[order].tolist()):
        rx, ry = forest.root(int(at[x])), forest.root(int(at[y]))
        if rx == ry:
            continue
        if sets is not None:
            both = np.concatenate([sets[x], sets[y]])
            both.sort()
            same = int((both[1:] == both[:-1]).sum())
            if 100 * same < threshold * (len(both) - same):
                continue
        forest.up[ry] = rx
    # What is connected, as links of all with the smallest: few rounds of stars will do.
    roots = [forest.root(i) for i in at.tolist()]
    least: dict[int, bytes] = {}
    for k, root in zip(keys, roots):
        least[root] = min(k, least.get(root, k))
    return list({(least[root], k) for k, root in zip(keys, roots) if least[root] != k})


def within(rows: DataFrame, threshold: int) -> DataFrame:
    """Links (low, high) of each group ``g`` of rows; see ``connected``."""
    kept = [c for c in ("g", "set_key", "size", "sig", "shingles", "guest", "part") if c in rows.columns]

    def run(batches):
        held, out = [], []
        for b in batches:
            g = b.column("g").to_numpy()
            cuts = np.r_[0, np.nonzero(np.diff(g))[0] + 1, len(g)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if held and hi > lo and held[-1].column("g")[0].as_py() != g[lo]:
                    out += connected(pa.Table.from_batches(held), threshold)
                    held = []
                if hi > lo:
                    held.append(b.slice(lo, hi - lo))
            if len(out) > 1000:
                yield links(out)
                out = []
        if held:
            out += connected(pa.Table.from_batches(held), threshold)
        yield links(out)

    def links(out):
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["low", "high"])

    return arrow_map(rows.select(*kept).repartition("g").sortWithinPartitions("g"), run, "low binary, high binary")


def across(sets: DataFrame, links: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame | None]:
    """(``set_key``, ``part``) of all classes of families: the smallest that is reached by ``links`` within blocks and by
    those of one class of each part with others; and further links, where families still fall into parts."""
    # A class has one block, where it is linked with the smallest of its part alone: no rounds are needed.
    parts = links.select(F.col("high").alias("set_key"), F.col("low").alias("part"))
    now = sets.select("set_key", "family", "block", "blocks").join(parts, "set_key", "left")
    now = materialise(now.withColumn("part", F.coalesce("part", "set_key")).distinct(), "parted")
    if now.where("blocks > 1").isEmpty():
        return now, None

    # That smallest class of each part of a block stands for it, in one group.
    heads = now.where("blocks > 1 AND set_key = part").select("family", "set_key")
    many = materialise(heads.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n")), "heads")
    heads = heads.join(many, "family").select("set_key", F.xxhash64("family", F.pmod(F.xxhash64("set_key"), "n")).alias("g"))
    data = sets.where("blocks > 1").select("set_key", "size", "sig", "shingles")
    tops = materialise(within(data.join(heads, "set_key"), threshold), "tops").select(F.col("high").alias("part"), F.col("low").alias("top"))
    now = now.join(tops, "part", "left").select("set_key", "family", "block", "blocks", F.coalesce("top", "part").alias("part"))
    now = materialise(now, "parted")
    counts = now.where("blocks > 1").groupBy("family", "part").agg(F.count(F.lit(1)).alias("n"))
    split = counts.groupBy("family").agg(F.max_by("part", F.struct("n", "part")).alias("top"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("all"), F.max("n").alias("most")).where("parts > 1")
    split = materialise(split.select("family", "top", F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("guests")), "split")
    if split.isEmpty():
        return now, None
    rows = now.join(split, "family")
    own = F.pmod(F.xxhash64("set_key"), "guests").cast("int")
    guests = rows.where("part != top").withColumn("at", own).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("guest", F.lit(True))
    hosts = rows.withColumn("at", F.explode(F.expr("sequence(0, guests - 1)"))).withColumn("guest", F.lit(False))
    meet = guests.unionByName(hosts, allowMissingColumns=True).select("set_key", "part", "guest", F.xxhash64("family", "at", "block").alias("g"))
    return now, within(data.join(meet, "set_key"), threshold).distinct()


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) of every linked node: the smallest node that it reaches, itself included."""
    edges = links.select(F.col("high").alias("u"), F.col("low").alias("v")).where("u != v")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The aggregates are stored, so that the joins deal the edges out anew and can split a node of many.
        ends, seen = both.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most")), Observation()
        # All are stars around their smallest nodes once none with a smaller neighbour has a second one.
        ends = ends.observe(seen, F.count_if((F.col("least") < F.col("u")) & (F.col("least") != F.col("most"))).alias("loose"))
        least = materialise(ends.select("u", F.least("least", "u").alias("m")), "least")
        if not seen.get["loose"]:
            return least.toDF("node", "component")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u")
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = materialise(small, "edges")
