"""Source divergence audit: how far each source's terms lie from those of the other sources of its language.

Terms are counted by sorting pointers. A shard of texts is one Arrow buffer; a pointer is the place
where a word starts in it. The pointers are sorted by multikey quicksort, eight bytes of the word a
step: a slice is split at a pivot into smaller, equal and larger, the equal part goes on with the next
eight bytes of its words. A run of pointers that end up equal is one term; its pointers give its
occurrences and, by the rows they lie in, its documents, for each language and source. The tables
of a task's shards are added up, then those of all tasks by Spark.

Terms are matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased. A language keeps its terms
that are in at least ``LEAST`` of its documents: V terms. A group (language, source) or a language gives
a kept term, with ``count`` occurrences in it, p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N the sum of its
counts of kept terms. Two shares p and q differ by floor((p - q)^2 / (p + q)). Integers throughout.

  pair  for each source of a language, every other one: the sum over all kept terms
  term  for each source, its terms above the language's share: the ``TOP`` largest

Pairs: a language's kept terms are dealt into parts. A part meets the language's sources, lays the shares
out as a matrix of terms by sources (in slices of ``MATRIX`` numbers) and adds up each source's distances to
all others; parts are summed by Spark. The result itself has a row for each pair of sources.

Edge cases: null text, language or source is ''; a group without terms has its rows; without kept terms
(V = 0) pairs are 0 and there are no terms; equal rows are documents of their own; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, python_ready
from .components import stored

LEAST = 10
TOP = 10
SHARD_BYTES = 4 << 20
SMALL = 1 << 16  # slices that are sorted at once
HELD_ROWS = 400_000
PART_TERMS = 4096  # terms whose shares in all sources are compared in one group, about
MATRIX = 1 << 21  # shares compared at once
UNIT = 1_000_000_000
# Bytes of a term, A-Z lower-cased; 0 for all others.
LETTER = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0 for c in range(256)], np.uint8)


KEEP = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], np.uint64)  # the first k of eight bytes


def _eight(text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Eight bytes from the pointers on as numbers, the first byte highest; 0 behind a word's end.
    The text has eight bytes more than its words."""
    every = np.ndarray((len(text) - 7,), ">u8", buffer=text, strides=(1,))
    return every[start].astype(np.uint64) & KEEP[np.clip(length, 0, 8)]


def _places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [a, b)."""
    sizes = b - a
    return np.repeat(a - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def multikey_sort(text: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the words at the pointers and where runs of equal words begin in it.

    Slices of one depth are handled together: those beyond ``SMALL`` are split at pivots, then the small ones
    are sorted at once.
    """
    order = np.arange(len(start))
    key = np.empty(len(start), np.uint64)
    heads = np.zeros(len(start), bool)
    a, b, depth = np.array([0]), np.array([len(start)]), 0
    while (b > a).any():
        at = _places(a, b)
        key[at] = _eight(text, start[order[at]] + depth, length[order[at]] - depth)
        stack, equal = [(int(x), int(y)) for x, y in zip(a[b - a > SMALL], b[b - a > SMALL])], []
        small = [(a[b - a <= SMALL], b[b - a <= SMALL])]
        while stack:
            x, y = stack.pop()
            if y - x <= SMALL:
                small.append((np.array([x]), np.array([y])))
                continue
            mine, keys = order[x:y].copy(), key[x:y].copy()
            pivot = np.sort(keys[np.linspace(0, y - x - 1, 31).astype(np.int64)])[15]
            less, more = keys < pivot, keys > pivot
            same = ~(less | more)
            x_, y_ = x + int(less.sum()), y - int(more.sum())
            order[x:y] = np.concatenate([mine[less], mine[same], mine[more]])
            key[x:y] = np.concatenate([keys[less], keys[same], keys[more]])
            equal.append(x_)
            stack += [(x, x_), (y_, y)]
            equal.append(y_)
        low, high = (np.concatenate(z) for z in zip(*small))
        at, of = _places(low, high), np.repeat(np.arange(len(low)), high - low)
        by = np.lexsort((key[at], of))
        order[at], key[at] = order[at[by]], key[at[by]]
        first = np.concatenate([[True], (np.diff(of) != 0) | (np.diff(key[at]) != 0)])[:len(at)]
        cuts = np.flatnonzero(first)
        a = np.concatenate([at[cuts], np.array(equal[0::2], np.int64)])
        b = np.concatenate([at[cuts] + np.diff(np.append(cuts, len(at))), np.array(equal[1::2], np.int64)])
        # A zero byte at the end: the words of the part end here, and they are equal.
        over = (b - a == 1) | (key[np.minimum(a, len(key) - 1)] & np.uint64(255) == 0)
        heads[a[over & (b > a)]] = True
        a, b, depth = a[~over], b[~over], depth + 8
    return order, np.flatnonzero(heads)


def _shard_terms(rows: list[pa.RecordBatch]) -> pa.Table | None:
    """Per language, source and term of a shard: occurrences and documents."""
    table = pa.Table.from_batches(rows).combine_chunks()
    texts = table.column("text").combine_chunks()
    wide = np.int32 if texts.type == pa.binary() else np.int64
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    if buffer is None or offsets[0] == offsets[-1]:
        return None
    n = int(offsets[-1] - offsets[0])
    text = np.zeros(n + 8, np.uint8)
    np.take(LETTER, np.frombuffer(buffer, np.uint8)[offsets[0]:offsets[-1]], out=text[:n])
    offsets -= offsets[0]
    # A word starts behind another byte or with its text, and ends likewise.
    inside = text[:n] != 0
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    start = np.flatnonzero(inside & (border[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (border[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    if not len(start):
        return None
    order, heads = multikey_sort(text, start, end - start)
    langs, sources = (table.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    n_sources, n_rows = len(sources.dictionary), table.num_rows
    group_of_row = langs.indices.to_numpy().astype(np.int64) * n_sources + sources.indices.to_numpy()
    n_groups = int(group_of_row.max()) + 1
    # Pointers by run and row: a run of equal pairs is a term in a document.
    row = np.searchsorted(offsets, start, "right") - 1
    run = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    pairs = np.sort(run * n_rows + row[order])
    first = np.flatnonzero(np.concatenate([[True], np.diff(pairs) != 0]))
    times = np.diff(np.append(first, len(pairs)))
    pairs = pairs[first]
    by_group = pairs // n_rows * n_groups + group_of_row[pairs % n_rows]
    by = np.argsort(by_group, kind="stable")
    by_group = by_group[by]
    first = np.flatnonzero(np.concatenate([[True], np.diff(by_group) != 0]))
    group = by_group[first] % n_groups
    word = [text[x:y].tobytes() for x, y in zip(start[order[heads]].tolist(), end[order[heads]].tolist())]
    return pa.table({
        "lang": langs.dictionary.take(pa.array(group // n_sources)), "source": sources.dictionary.take(pa.array(group % n_sources)),
        "term": pa.array(word, pa.binary()).cast(pa.string()).take(pa.array(by_group[first] // n_groups)),
        "n": np.add.reduceat(times[by], first), "docs": np.diff(np.append(first, len(by)))})


def _added(tables: list[pa.Table]) -> pa.Table:
    one = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return one.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Rows in shards of up to ``SHARD_BYTES`` of text, or of one row."""
    waiting, size = [], 0
    for whole in batches:
        at = 0
        while at < whole.num_rows:
            sizes = np.cumsum(whole.column("size").slice(at).to_numpy())
            rows = max(1, int(np.searchsorted(sizes, SHARD_BYTES - size, "right")))
            if size and size + int(sizes[rows - 1]) > SHARD_BYTES:  # the next text begins a shard
                rows = 0
            if rows:
                waiting.append(whole.slice(at, rows))
                size += int(sizes[rows - 1])
                at += rows
            if rows == 0 or size >= SHARD_BYTES:
                yield waiting
                waiting, size = [], 0
    if waiting:
        yield waiting


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tables of shards, added up until they have ``HELD_ROWS`` rows."""
    held = []
    for rows in _shards(batches):
        if (terms := _shard_terms(rows)) is not None:
            held.append(terms)
        give_back()
        if sum(t.num_rows for t in held) > HELD_ROWS:
            held = [_added(held)]
            if held[0].num_rows > HELD_ROWS // 2:
                yield from held.pop().to_batches(max_chunksize=50_000)
    if held:
        yield from (_added(held) if len(held) > 1 else held[0]).to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs of (text, lang, source), no nulls."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col("text").cast("binary").alias("text"), "lang", "source",
                       F.octet_length("text").cast("long").alias("size"))
    shards = rows.mapInArrow(_terms, "lang string, source string, term string, n long, docs long")
    return shards.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    up = (wide(count) + F.lit(2)) * F.lit(UNIT).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", up.cast("decimal(38,0)"), (wide(total) + wide(kept) * F.lit(2)).cast("decimal(38,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank; see the module."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    groups = stored(rows.select("lang", "source").distinct(), "groups")
    counts = stored(term_counts(rows), "terms")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d")).where(F.col("d") >= least).drop("d")
    kept = stored(counts.select("lang", "source", "term", "n").join(of_lang, ["lang", "term"]), "kept")

    sizes = kept.groupBy("lang").agg(F.count_distinct("term").alias("v"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    groups = stored(groups.join(sizes, "lang", "left").join(totals, ["lang", "source"], "left").select(
        "lang", "source", zero("v"), zero("lang_total"), zero("total")), "groups")

    # Shares: of a term in its source and in the language, and of a term that a source lacks.
    empty = share(F.lit(0), F.col("total"), F.col("v"))
    groups = groups.withColumn("p0", F.when(F.col("v") > 0, empty))
    shares = stored(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "v", share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")), "shares")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         distance(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    pairs = _pairs(shares, groups).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank"]
    return pairs.select(*columns).union(terms.select(*columns))


def _part_pairs(shares: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums over the terms of a part: source, other, value."""
    names = sources.column("name").to_pylist()
    number = {name: k for k, name in enumerate(names)}
    empty = sources.column("p0").to_numpy()
    total = np.zeros((len(names), len(names)), np.int64)
    if shares.num_rows:
        terms = shares.column("term").combine_chunks().dictionary_encode()
        which = terms.indices.to_numpy().astype(np.int64)
        of = np.array([number[x] for x in shares.column("source").to_pylist()], np.int64)
        p = shares.column("p").to_numpy()
        step = max(1, MATRIX // len(names))
        for low in range(0, len(terms.dictionary), step):
            here = (which >= low) & (which < low + step)
            m = np.tile(empty, (min(step, len(terms.dictionary) - low), 1))
            m[which[here] - low, of[here]] = p[here]
            for k in range(len(names)):
                d = m[:, k + 1:] - m[:, k:k + 1]
                total[k, k + 1:] += (d * d // (m[:, k + 1:] + m[:, k:k + 1])).sum(0)
    total += total.T
    k, j = np.nonzero(~np.eye(len(names), dtype=bool))
    name = pa.array(names, pa.string())
    lang = pa.array([sources.column("lang")[0].as_py()] * len(k), pa.string())
    return pa.table({"lang": lang, "source": name.take(pa.array(k)), "other": name.take(pa.array(j)), "value": pa.array(total[k, j])})


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Both directions of each pair of sources of a language."""
    parts = F.ceil((F.col("v") + 1) / PART_TERMS)
    dealt = shares.select(F.col("lang").alias("of_lang"), F.pmod(F.xxhash64("term"), parts).alias("of_part"), "term", "source", "p")
    every = groups.select("lang", F.col("source").alias("name"), F.coalesce("p0", F.lit(0)).cast("long").alias("p0"),
                          F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    sums = every.groupBy("lang", "part").cogroup(dealt.groupBy("of_lang", "of_part")).applyInArrow(
        lambda sources, shares: _part_pairs(shares, sources), "lang string, source string, other string, value long")
    return sums.groupBy("lang", "source", "other").agg(F.sum("value").alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
