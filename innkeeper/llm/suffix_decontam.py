"""Benchmark decontamination by suffix arrays over shards of the training documents.

Words: A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A benchmark window is
13 consecutive words of an item (the whole item if it has fewer, but not none). A document
word inside any occurrence of a window is hit.

Each batch of documents in a task is a shard. Its words become integers (0 for a word that
no item has, and between documents); a suffix that leaves the benchmark's vocabulary before
the shortest window is over can match nothing and is left out. The suffix array of what
remains is built by prefix doubling, and every test suffix is binary-searched in it: the
range of its window gives all locations, and the match is extended word by word to its
full length. Documents are never shuffled and no task holds more than a shard.

The benchmark is sent to the executors in blocks of at most ``block_chars`` characters
(a single item may be longer); the documents pass through the blocks one after another,
written in between, so a task holds one block however large the benchmark is.

Edge cases: null or empty texts have no words; items without words have no window; equal
items are searched once and all their ids reported; a null item id is reported as "null";
an empty benchmark hits nothing; equal rows stay separate rows; further columns pass
through, and the added names are drawn so that they clash with none (``Added``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import appended, free_name, python_ready, relieved, text_bytes
from .components import stored

WINDOW = 13
BLOCK_CHARS = 16 << 20
PAIRS_AT_ONCE = 1 << 20
TO_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
                 for c in range(256))


class Added:
    """The names of the columns added to docs: n_words, n_hit, spans, items, longest and longest_start, led by underscores."""

    def __init__(self, columns: list[str]):
        self.n_words, self.hits, self.spans, self.items, self.longest, self.longest_start, self.n_hit = (
            free_name(columns, f"_{c}") for c in ("n_words", "hits", "spans", "items", "longest", "longest_start", "n_hit"))
        self.scanned = [self.n_words, self.hits, self.spans, self.items, self.longest, self.longest_start]

    def contaminated(self) -> Column:
        return contaminated(self.n_hit, self.n_words)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class TestSuffixes:
    """The items of one block: their words as integers, and where each window starts."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.ids: dict[bytes, int] = {}
        of: dict[tuple[bytes, ...], list[str]] = {}
        for item, text in items:
            if words := words_of(text):
                of.setdefault(tuple(words), []).append(item)
        self.items = [sorted(set(v)) for v in of.values()]
        coded = [np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in ws], np.int32) for ws in of]
        # 0 after each item, and enough of it at the end to gather a window from any position.
        self.words = np.concatenate([np.append(c, 0) for c in coded] + [np.zeros(window, np.int32)]).astype(np.int32)
        lengths = [len(c) for c in coded]
        firsts = np.cumsum([0, *[n + 1 for n in lengths]])[:-1]
        windows = [max(1, n - window + 1) for n in lengths]
        empty = [np.zeros(0, np.int64)]
        self.start = np.concatenate([f + np.arange(k) for f, k in zip(firsts, windows)] or empty)
        self.item = np.repeat(np.arange(len(coded)), windows)
        self.length = np.repeat(np.minimum(lengths, window), windows) if coded else empty[0]
        self.least = int(self.length.min()) if coded else 0
        self.longest = max(lengths, default=0)


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Positions of s in the order of their suffixes, compared over ``depth`` words at least."""
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    reach = 1
    while reach < depth and len(s):
        after = np.zeros(len(s), np.int64)
        after[:-reach or None] = rank[reach:] + 1 if reach < len(s) else 0
        values, again = np.unique(rank * (len(s) + 2) + after, return_inverse=True)
        rank = again.astype(np.int64)
        reach *= 2
        if len(values) == len(s):
            break
    return np.argsort(rank, kind="stable")


def ranges(s: np.ndarray, order: np.ndarray, query: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 place in the suffix array of suffixes that begin with query[i, :length[i]].

    All queries are bisected together. s must be padded with a window of zeros.
    """
    steps = np.arange(query.shape[1])
    inside = steps < length[:, None]

    def bisect(after_equal: bool) -> np.ndarray:
        low, high = np.zeros(len(query), np.int64), np.full(len(query), len(order), np.int64)
        while (open_ := low < high).any():
            at = np.flatnonzero(open_)
            mid = (low[at] + high[at]) // 2
            other = s[order[mid][:, None] + steps]
            differs = (other != query[at]) & inside[at]
            first = differs.argmax(1)
            rows = np.arange(len(at))
            some = differs[rows, first]
            less = np.where(some, other[rows, first] < query[at, first], after_equal)
            low[at[less]] = mid[less] + 1
            high[at[~less]] = mid[~less]
        return low

    return bisect(False), bisect(True)


def search(test: TestSuffixes, docs: list[list[bytes]], window: int):
    """(hit words as a bool array over all docs' words, {doc: item numbers}, longest match of each doc and
    the first word at which one of that length starts, -1 for none)."""
    counts = np.array([len(d) for d in docs], np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    hit = np.zeros(first[-1], bool)
    items: dict[int, set[int]] = {}
    longest, start = np.zeros(len(docs), np.int64), np.full(len(docs), -1, np.int64)
    get = test.ids.get
    coded = np.zeros(first[-1] + 1, np.int32)
    run = np.zeros(first[-1] + 1, bool)  # words inside a long enough run of known words
    for d, words in enumerate(docs):
        lo, hi = first[d], first[d + 1]
        coded[lo:hi] = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        known = np.flatnonzero(np.diff(np.concatenate([[0], coded[lo:hi] != 0, [0]]).astype(np.int8)))
        for a, b in known.reshape(-1, 2):
            if b - a >= test.least:
                run[lo + a:lo + b] = True
    at = np.flatnonzero(run)
    if not len(at) or not test.least:
        return hit, items, longest, start
    # Runs of one document may touch the next one's: a 0 goes wherever positions or documents break.
    doc_of = np.searchsorted(first, at, "right") - 1
    gap = np.concatenate([[False], (np.diff(at) > 1) | (np.diff(doc_of) > 0)])
    place = np.arange(len(at)) + np.cumsum(gap)
    s = np.zeros(place[-1] + 1 + window, np.int32)
    s[place] = coded[at]
    back = np.full(len(s), -1, np.int64)  # place in s -> word of the shard
    back[place] = at
    order = suffix_array(s[:place[-1] + 1], max(window, test.longest))
    query = test.words[test.start[:, None] + np.arange(window)]
    low, high = ranges(s, order, query, test.length)
    found = np.flatnonzero(high > low)
    if not len(found):
        return hit, items, longest, start
    # Test suffixes with the same window have the same range: it is marked once.
    cover = np.zeros(first[-1] + 1, np.int32)
    seen = {}
    for q in found:
        seen.setdefault((low[q], high[q], test.length[q]), []).append(q)
    for (lo, hi, n), same in seen.items():
        spots = order[lo:hi]
        words = back[spots]
        np.add.at(cover, words, 1)
        np.add.at(cover, words + n, -1)
        owners = np.searchsorted(first, words, "right") - 1
        its = {int(test.item[q]) for q in same}
        for d in np.unique(owners):
            items.setdefault(int(d), set()).update(its)
        for q in same:
            for k in range(0, len(spots), PAIRS_AT_ONCE):
                part, whose = spots[k:k + PAIRS_AT_ONCE], owners[k:k + PAIRS_AT_ONCE]
                begins = words[k:k + PAIRS_AT_ONCE] - first[whose]
                length = np.full(len(part), n)
                going = np.arange(len(part))
                step = int(n)
                while len(going) and (word := test.words[test.start[q] + step]):
                    inside = part[going] + step < len(s)
                    going = going[inside]
                    going = going[s[part[going] + step] == word]
                    step += 1
                    length[going] = step
                # Of each document the longest match, and of equal ones the first.
                by = np.lexsort((begins, -length, whose))
                by = by[np.concatenate([[True], np.diff(whose[by]) > 0])]
                d, n_, b_ = whose[by], length[by], begins[by]
                better = (n_ > longest[d]) | ((n_ == longest[d]) & (b_ < start[d]))
                longest[d[better]], start[d[better]] = n_[better], b_[better]
    hit[:] = np.cumsum(cover)[:-1] > 0
    return hit, items, longest, start


def _scan(sent, text_at: int, window: int, first_block: bool, added: Added):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = sent.value
        for b in batches:
            kept = b if first_block else b.select(list(range(b.num_columns - len(added.scanned))))
            docs = [words_of(t) for t in text_bytes(b.column(text_at))]
            hit, items, longest, start = search(test, docs, window)
            cuts = np.cumsum([len(d) for d in docs])[:-1] if docs else []
            hits = np.split(hit, cuts) if docs else []
            names = [{n for k in items.get(d, ()) for n in test.items[k]} for d in range(len(docs))]
            if not first_block:
                earlier = (added.hits, added.items, added.longest, added.longest_start)
                for d, (bits, before, far, at) in enumerate(zip(*[b.column(c).to_pylist() for c in earlier])):
                    if bits:
                        hits[d] = hits[d] | np.unpackbits(np.frombuffer(bits, np.uint8), count=len(hits[d])).astype(bool)
                    names[d].update(before)
                    if (far, -at) > (longest[d], -start[d]):
                        longest[d], start[d] = far, at
            yield appended(kept, {
                added.n_words: pa.array([len(d) for d in docs], pa.int64()),
                added.hits: pa.array([np.packbits(h).tobytes() if h.any() else b"" for h in hits], pa.binary()),
                added.spans: pa.array([_spans(h) for h in hits], SPANS),
                added.items: pa.array([sorted(x) for x in names], pa.list_(pa.string())),
                added.longest: pa.array(longest, pa.int64()), added.longest_start: pa.array(start, pa.int64())})

    return relieved(run)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _spans(hit: np.ndarray) -> list[dict]:
    """Maximal runs of hit words, end exclusive."""
    if not hit.any():
        return []
    edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0)).tolist()
    return [{"start": a, "end": b} for a, b in zip(edges[0::2], edges[1::2])]


def blocks_of(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's (item id, text), collected block by block."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"),
                             F.coalesce("text", F.lit("")).alias("t"))
    chars = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, math.ceil(chars / block_chars))
    for k in range(n):
        rows = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r["i"], r["t"].encode()) for r in rows.toLocalIterator()]


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS,
                 text: str = "text") -> DataFrame:
    """The rows of docs with ``_n_words``, ``_n_hit``, ``_spans`` (maximal runs of hit words), ``_items`` (ids of items with
    occurring windows), ``_longest`` (words of the longest verbatim match that holds a window) and ``_longest_start`` (where
    the first such match starts, -1 for none); by other names where docs has these (``Added``)."""
    spark = docs.sparkSession
    python_ready(spark)
    added = Added(docs.columns)
    out, schema = docs, T.StructType([
        *docs.schema.fields, T.StructField(added.n_words, T.LongType()), T.StructField(added.hits, T.BinaryType()),
        T.StructField(added.spans, T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField(added.items, T.ArrayType(T.StringType())), T.StructField(added.longest, T.LongType()),
        T.StructField(added.longest_start, T.LongType())])
    for k, items in enumerate(blocks_of(benchmark, block_chars)):
        sent = spark.sparkContext.broadcast(TestSuffixes(items, window))
        out = (out if k == 0 else stored(out, "scanned")).mapInArrow(
            _scan(sent, docs.columns.index(text), window, k == 0, added), schema)
    return out.withColumn(added.n_hit, _ones(added.hits)).drop(added.hits)


def _ones(column: str):
    """Set bits of a binary column: the 1 digits of its bytes in base 2, counted in hex."""
    digits = F.hex(column)
    weights = {1: "1248", 2: "3569AC", 3: "7BDE", 4: "F"}
    return sum(((F.length(digits) - F.length(F.translate(digits, chars, ""))) * n for n, chars in weights.items()),
               F.lit(0)).cast("long")


def contaminated(n_hit="_n_hit", n_words="_n_words"):
    """At least one word is hit, and at least a twentieth of the words are."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    return find_matches(docs, benchmark, **how).where(~Added(docs.columns).contaminated()).select(docs.columns)
