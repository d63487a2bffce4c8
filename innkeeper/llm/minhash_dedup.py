"""Near-duplicate documents by MinHash with tensored banding.

A document's set: its distinct 5-word shingles after lower-casing A-Z (words
``[^\\x20\\x09-\\x0D]+``); with fewer words the whole sequence is the one shingle. Two
documents are linked when 100 * intersection >= 75 * union, and ``component_id`` is the
smallest key reachable over links.

Tensored banding: instead of 144 tables of 4 independent minhashes each (576 hashes), there
are two collections of 12 half keys of 2 minhashes (48 hashes), and table (i, j) is keyed by
the pair (first[i], second[j]). A pair at similarity s shares a table with probability
(1 - (1 - s^2)^12)^2: 0.9999 at 0.75, 0.99999 at 0.8. A half key that nobody else has cannot
be part of a shared table key, so the product is formed from shared half keys only.

Finding links without comparing all pairs of a bucket:
  1. Documents with equal sets form a class; one document (the smallest) stands for it.
  2. Every half key names its most central class (the one whose half keys are the most
     shared), and every class is compared to the class that most of its half keys name. That
     alone ties nearly all copies of a text together.
  3. Half keys, then table keys, that lie within one component need no more comparisons. For
     the classes that are left, shingles that no other of them has are counted. A class whose
     common shingles (with any other) are too few for a link is done, exactly.
  4. In the buckets that still hold several components, all pairs of different components are
     to be judged: classes outside a bucket's largest component against the rest of it. A pair
     is taken up in the first table alone that both have, so it costs one row however many
     tables it shares, and only if an exact upper bound of its intersection (``most_common``)
     allows a link, for which step 2 has kept what each class lacks of the class it was compared
     to. Then the sketches are compared (one byte of each minhash; a pair at 0.75 is lost here
     with a probability of 3e-6).
Every comparison that makes a link is between full sets, recomputed from the texts. There is one
join of buckets, without rounds; Spark splits a large bucket's rows over tasks (skew join).

Edge cases: null or empty texts have the empty set, are linked with nothing and are kept;
rows with equal keys are one document; rows with a null key are linked with nothing, have a
null component and are kept; equal rows each get their row; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_hexdigest

from .common import U64, WORD_HASHES, appended, mixed, python_ready, relieved, text_bytes
from .components import absorb, stored

SHINGLE = 5
BANDS = 12  # half keys in each of the two collections
ROWS = 2  # minhashes of a half key
HASHES = 2 * BANDS * ROWS
SKETCH_LEAST = 22  # of 48; a pair at similarity 0.75 has 36, with a standard deviation of 3
SHARED_LEAST = 4  # half keys shared with the class that step 2 compares to
MISSING = [f"missing{k}" for k in range(4)]  # columns of 64 fields of 4 bits
CHUNK = 64  # classes compared to one class in one group
BLOCK = 1 << 17  # shingles hashed at once

_rng = np.random.default_rng(20240229)
FACTORS = _rng.integers(0, 1 << 64, HASHES, dtype=U64) | U64(1)
TERMS = _rng.integers(0, 1 << 64, HASHES, dtype=U64)
STEP = U64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = WORD_HASHES.of(text.lower().split())  # bytes.lower changes A-Z only
    n = len(words)
    if n == 0:
        return words
    width = min(n, size)
    h = words[:n - width + 1].copy()
    for k in range(1, width):
        h *= STEP
        h += words[k:n - width + 1 + k]
    return np.unique(mixed(h + U64(width)))


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES x len(sets); all sets must have a member."""
    out = np.empty((HASHES, len(sets)), U64)
    at = 0
    while at < len(sets):
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= BLOCK):
            total += len(sets[end])
            end += 1
        x = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *map(len, sets[at:end - 1])])
        for i in range(HASHES):
            out[i, at:end] = np.minimum.reduceat(x * FACTORS[i] + TERMS[i], starts)
        at = end
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            b = whole.slice(at, 500)
            sets = [shingle_set(t) for t in text_bytes(b.column(1))]
            some = [k for k, s in enumerate(sets) if len(s)]
            halves = np.zeros((len(sets), 2 * BANDS), np.int64)
            sketches = [None] * len(sets)
            if some:
                low = minhashes([sets[k] for k in some])
                for slot in range(2 * BANDS):
                    h = np.full(len(some), slot, U64)
                    for r in range(ROWS):
                        h = mixed(h * STEP + low[slot * ROWS + r])
                    halves[some, slot] = h.view(np.int64)
                packed = np.ascontiguousarray((mixed(low) >> U64(56)).astype(np.uint8).T)
                for k, row in zip(some, packed):
                    sketches[k] = row.tobytes()
            offsets = np.arange(len(sets) + 1, dtype=np.int32) * (2 * BANDS)
            yield appended(b.select([0]), {
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "set_id": pa.array([xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string()),
                "halves": pa.ListArray.from_arrays(offsets, pa.array(halves.ravel())),
                "sketch": pa.array(sketches, pa.binary())})


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    python_ready(docs.sparkSession)
    narrow = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(relieved(_sign), f"id {kind}, n_shingles long, set_id string, halves array<long>, sketch binary")


def missing_counts(hub: np.ndarray, own: np.ndarray) -> list[int | None]:
    """How many shingles of hub a set lacks, by 64 ranges of the hash, as unary numbers of 4 bits; all null
    if a range has more than 4. The AND of two of them has as many bits as the smaller count."""
    counts = np.bincount((np.setdiff1d(hub, own, assume_unique=True) >> U64(58)).astype(np.int64), minlength=64)
    if counts.max() > 4:
        return [None] * 4
    unary = ((1 << counts) - 1).astype(U64).reshape(4, 16) << (4 * np.arange(16)).astype(U64)
    return np.bitwise_or.reduce(unary, 1).view(np.int64).tolist()


def _compare(threshold: int):
    """Group of one leader (rows of its own text) and classes to compare it to -> their intersections."""

    def run(group: pa.Table) -> pa.Table:
        leader, ids = group.column("leader")[0].as_py(), group.column("id").to_pylist()
        sets = [shingle_set(t) for t in text_bytes(group.column("text").combine_chunks())]
        own = [s for i, s in zip(ids, sets) if i == leader]
        shared, linked, lacks = {}, {}, {}
        for i, s in zip(ids, sets):
            for o in own if i != leader and len(s) else ():
                both = len(np.intersect1d(s, o, assume_unique=True))
                # Two texts of one key: only the weaker of the bounds holds for them.
                lacks[i] = [None] * 4 if i in shared or len(own) > 1 else missing_counts(o, s)
                shared[i] = max(shared.get(i, 0), both)
                linked[i] = linked.get(i, False) or 100 * both >= threshold * (len(s) + len(o) - both)
        of = sorted(shared)
        columns = {"a": pa.array(of, group.schema.field("id").type),
                   "b": pa.array([leader] * len(of), group.schema.field("leader").type),
                   "both": pa.array([shared[i] for i in of], pa.int64()),
                   "linked": pa.array([linked[i] for i in of], pa.bool_()),
                   "hub_n": pa.array([max(map(len, own), default=0)] * len(of), pa.int64())}
        return pa.table(columns | {m: pa.array([lacks[i][k] for i in of], pa.int64()) for k, m in enumerate(MISSING)})

    return run


def most_common() -> Column:
    """An upper bound of the intersection of two classes x and y (columns with and without l_).

    At most the smaller number of common shingles. With the same hub H it is what both have of H, plus
    at most the smaller number of common shingles outside H. Both have of H at most the smaller of
    what each has; and exactly |x & H| + |y & H| - |H| + what both lack, for which ``missing`` gives a bound.
    """
    least = lambda c: F.least(F.col(c), F.col(f"l_{c}"))
    lack = sum((F.bit_count(F.col(m).bitwiseAND(F.col(f"l_{m}"))) for m in MISSING), F.lit(0))
    # F.least passes over a null, as the third is where a range had too many.
    in_hub = F.least("in_hub", "l_in_hub", F.col("in_hub") + F.col("l_in_hub") - F.col("hub_n") + lack)
    outside = F.least(F.col("common") - F.col("in_hub"), F.col("l_common") - F.col("l_in_hub"))
    return F.when(F.col("hub") == F.col("l_hub"), F.least(in_hub + outside, least("common"))).otherwise(least("common"))


def compared(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Of stored pairs (leader, id): a (the id), b (the leader), both (size of the intersection of the
    full sets), linked, hub_n (size of the leader's set) and what a lacks of it. texts: stored (id, text)."""
    kind = pairs.schema["id"].dataType.simpleString()
    many = stored(pairs.groupBy("leader").count().where(F.col("count") > CHUNK)
                  .select("leader", F.ceil(F.col("count") / CHUNK).alias("chunks")), "chunks")
    cut = pairs.join(many, "leader", "left").select(
        "leader", F.pmod(F.xxhash64("id"), F.coalesce("chunks", F.lit(1))).alias("chunk"), "id")
    rows = cut.union(cut.select("leader", "chunk", F.col("leader")).distinct())
    group = rows.join(texts, "id").select("leader", "chunk", "id", "text")
    return stored(group.groupBy("leader", "chunk").applyInArrow(_compare(threshold), f"a {kind}, b {kind}, both long, linked boolean, "
        "hub_n long, " + ", ".join(f"{m} long" for m in MISSING)), "compared")


def rooted(df: DataFrame, labels: DataFrame | None) -> DataFrame:
    """df with the component (root) of its id."""
    if labels is None:
        return df.withColumn("root", F.col("id"))
    to = labels.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return df.join(to, F.col("id") == F.col("_node"), "left").withColumn("root", F.coalesce("_root", "id")).drop("_node", "_root")


def _mixed_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys that lie in two components or more."""
    ends = rows.groupBy(key).agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"))
    return ends.where("_lo <> _hi").select(key)


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            b = whole.slice(at, 200)
            sets = [shingle_set(t) for t in text_bytes(b.column("text"))]
            which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(which)), pa.array(np.concatenate(sets).view(np.int64))], names=["id", "shingle"])


def common_sizes(texts: DataFrame) -> DataFrame:
    """(id, own): how many shingles of a text no other of the texts (id, text) has."""
    kind = texts.schema["id"].dataType.simpleString()
    each = texts.mapInArrow(_shingles, f"id {kind}, shingle long")
    alone = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    return alone.groupBy("id").agg(F.count("*").alias("own"))


def first_shared() -> Column:
    """Whether the row's table, of the half keys in slots i and j, is the first one that x and y share (halves,
    l_halves). Components differ, so no half key that they share was left out before."""
    same = F.zip_with("halves", "l_halves", lambda x, y: x == y)
    place = lambda start: F.array_position(F.slice(same, start + 1, BANDS), True) + start - 1
    return (place(0) == F.col("i")) & (place(BANDS) == F.col("j"))


def _judge_buckets(buckets: DataFrame, texts: DataFrame, labels: DataFrame | None, threshold: int) -> DataFrame | None:
    """Compares pairs of a bucket that lie in different components. Columns: table, i, j, id, root, n, common, sketch,
    halves, hub (the class that step 2 compared to, or null), its hub_n, in_hub (the intersection) and missing."""
    parts = buckets.groupBy("table", "root").agg(F.count("*").alias("k"))
    sides = stored(parts.groupBy("table").agg(F.max_by("root", F.struct("k", "root")).alias("largest")), "sides")
    leads = stored(buckets.join(sides, "table").where("root <> largest").select(
        "table", *[F.col(c).alias(f"l_{c}") for c in ("id", "root", "n", "common", "sketch", "halves", "hub", "in_hub", *MISSING)]), "leads")
    pairs = leads.join(buckets, "table").where("l_root <> root")
    pairs = pairs.where((100 + threshold) * most_common() >= threshold * (F.col("n") + F.col("l_n"))).where(first_shared())
    pairs = pairs.groupBy(F.least("id", "l_id").alias("leader"), F.greatest("id", "l_id").alias("id")).agg(
        F.first("sketch").alias("x"), F.first("l_sketch").alias("y"))
    pairs = stored(pairs.where(agreeing("x", "y") >= SKETCH_LEAST).select("leader", "id"), "pairs")
    return labels if pairs.isEmpty() else absorb(labels, compared(pairs, texts, threshold).where("linked").select("a", "b"))


def near_duplicates(docs: DataFrame, threshold: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id and kept (key = component_id), one row for each row of docs."""
    signed = stored(signatures(docs, key, text), "signatures")
    classes = stored(signed.where("n_shingles > 0 AND id IS NOT NULL").groupBy("set_id").agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("halves").alias("halves"),
        F.first("sketch").alias("sketch")), "classes")

    halves = classes.select("id", F.posexplode("halves").alias("slot", "half"))
    shared = stored(halves.groupBy("half").agg(F.count("*").alias("k")).where("k > 1"), "shared")
    members = stored(halves.join(shared, "half").select("half", "slot", "id", "k"), "members")

    # Step 2: each class and the one class that most of its half keys name.
    central = stored(members.groupBy("id").agg(F.sum("k").alias("weight")), "central")
    weighed = members.join(central, "id")
    names = stored(weighed.groupBy("half").agg(
        F.max(F.struct("weight", "id"))["id"].alias("leader")), "names")
    counts = members.join(names, "half").where("id <> leader").groupBy("id", "leader").agg(F.count("*").alias("k"))
    best = counts.groupBy("id").agg(F.max(F.struct("k", "leader")).alias("b")).where(F.col("b.k") >= SHARED_LEAST)
    first = stored(best.select(F.col("b.leader").alias("leader"), "id"), "pairs")
    texts = stored(docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(central, "id", "left_semi")
                   .dropDuplicates(["id", "text"]), "texts")
    judged = compared(first, texts, threshold)
    labels = absorb(None, judged.where("linked").select("a", "b"))

    # Step 3: half keys, then table keys, in two components or more; classes that can have a link.
    open_ = stored(rooted(members.select("half", "slot", "id"), labels), "rooted")
    keys = stored(_mixed_keys(open_, "half"), "open-halves")
    left = open_.join(keys, "half", "left_semi").groupBy("id", "root").agg(F.collect_set(F.struct("slot", "half")).alias("h"))
    side = lambda cond: F.filter("h", cond)
    tables = stored(left.select("id", "root", F.inline(F.flatten(F.transform(
        side(lambda x: x["slot"] < BANDS), lambda a: F.transform(side(lambda x: x["slot"] >= BANDS), lambda b: F.struct(
            F.xxhash64(a["half"], b["half"]).alias("table"), a["slot"].alias("i"), b["slot"].alias("j"))))))), "tables")
    near = stored(tables.join(stored(_mixed_keys(tables, "table"), "open-tables"), "table", "left_semi"), "near")
    if not near.isEmpty():
        wanted = near.select("id").distinct()
        hubs = judged.select(F.col("a").alias("id"), F.col("b").alias("hub"), F.col("both").alias("in_hub"), "hub_n", *MISSING)
        wanted = stored(wanted.join(hubs, "id", "left"), "wanted")
        # With the hubs among the texts, all that a text has of its hub is common.
        among = wanted.select("id").union(wanted.where("hub IS NOT NULL").select("hub")).distinct()
        own = stored(common_sizes(texts.join(among, "id", "left_semi")), "own")
        able = wanted.join(classes.select("id", "n", "sketch", "halves"), "id").join(own, "id", "left").withColumn(
            "common", F.col("n") - F.coalesce("own", F.lit(0))).where(100 * F.col("common") >= threshold * F.col("n"))
        near = stored(near.join(stored(able.drop("own"), "able"), "id"), "near")
        buckets = stored(near.join(stored(_mixed_keys(near, "table"), "open-tables"), "table", "left_semi"), "buckets")
        if not buckets.isEmpty():
            labels = _judge_buckets(buckets, texts, labels, threshold)

    grouped = stored(rooted(classes.select("set_id", "id"), labels).select("set_id", "root"), "grouped")
    out = signed.select("id", "n_shingles", "set_id").join(grouped, "set_id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def agreeing(a: str, b: str):
    """Number of equal bytes of two sketches."""
    x, y = F.hex(a), F.hex(b)
    return F.aggregate(F.sequence(F.lit(0), F.lit(HASHES - 1)), F.lit(0), lambda s, i: s + (
        F.substr(x, 2 * i + 1, F.lit(2)) == F.substr(y, 2 * i + 1, F.lit(2))).cast("int"))
