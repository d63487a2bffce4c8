"""Exact substring dedup: repeated fixed-length word windows are removed.

A window is ``size`` consecutive words (``[^\\x20\\x09-\\x0D]+``) of one document. Every
window gets a Rabin-Karp hash; a window whose hash occurs anywhere else (also in the same
document) is repeated, and repeated windows merge into maximal removal intervals. All
windows are judged on the input, so every copy of a repeated passage goes.

How it runs: documents are dealt into blocks by a hash of their content (rows equal in key and
text by the partition that they are read in, too). A block hashes its
windows in numpy and sends its distinct hashes, sorted and cut into buckets of the hash
space, as packed arrays: 8 bytes a window cross the network, and a passage that a third of
all documents share is sent once by each block. A bucket finds the hashes that two blocks or
more hold and answers each block with one bit a hash; repeats inside a block are seen by
the block itself. The block, read again from the same shuffle of the texts, joins the bits
to its windows. Blocks and buckets grow in number with the text, not in size.

Hashes are 64 bits over well-mixed word hashes: among n windows about n^2 / 2^65 pairs of
different windows agree by chance (2 in the 9 billion windows of 50 GB of text).

Edge cases: null or empty texts and those of fewer than ``size`` words keep all words; equal
rows are repeats of each other; an empty table gives an empty result; further columns are
not read.
"""

from __future__ import annotations

import hashlib
import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, WORD_HASHES, powers, python_ready, shuffle_partitions, text_bytes, text_size, trimmed

SIZE = 35
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20  # text of a block
BUCKET_BYTES = 16 << 20  # hashes of a bucket
HASH_BYTES_A_TEXT_BYTE = 2  # 8 bytes a window; words are 4 bytes with their space, or longer

def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """sum(words[i + k] * BASE^(size - 1 - k)) mod 2^64 for every window start i, rolled by prefix sums."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    scaled = np.concatenate([np.zeros(1, U64), np.cumsum(words * powers(INVERSE, len(words)), dtype=U64)])
    return (scaled[size:] - scaled[:n]) * powers(BASE, n + size - 1)[size - 1:]


class Block:
    """The documents of a block: their words, and the hashes of windows that lie in one document."""

    def __init__(self, texts: list[bytes], size: int):
        self.words = [t.split() for t in texts]
        counts = np.array([len(w) for w in self.words], np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        hashes = [window_hashes(WORD_HASHES.of(w), size) for w in self.words]
        # Window starts, as places in the words of all documents one after another.
        self.start = np.concatenate([f + np.arange(len(h)) for f, h in zip(self.first, hashes)]
                                    or [np.zeros(0, np.int64)])
        self.hash, self.which, self.count = np.unique(
            np.concatenate(hashes or [np.zeros(0, U64)]), return_inverse=True, return_counts=True)

    def cuts(self, buckets: int) -> np.ndarray:
        """Where each bucket begins in the sorted hashes, and the end."""
        step = (1 << 64) // buckets + 1
        bounds = np.array([k * step for k in range(buckets)], dtype=U64)
        return np.append(np.searchsorted(self.hash, bounds), len(self.hash))


def _hash_block(buckets: int, size: int):
    def run(docs: pa.Table) -> pa.Table:
        block = Block(text_bytes(docs.column("text").combine_chunks()), size)
        cuts = block.cuts(buckets)
        some = np.flatnonzero(np.diff(cuts))
        packed = memoryview(block.hash.astype("<u8").tobytes())
        return pa.table({
            "block": pa.array(np.full(len(some), docs.column("block")[0].as_py()), pa.int64()),
            "bucket": pa.array(some, pa.int64()),
            "hashes": pa.array([packed[8 * cuts[k]:8 * cuts[k + 1]] for k in some], pa.binary())})

    return trimmed(run)


def _answer(bucket: pa.Table) -> pa.Table:
    """For each block's hashes: a bit, 1 where another block has the hash."""
    blobs = bucket.column("hashes").to_pylist()
    hashes = np.frombuffer(b"".join(blobs), "<u8")
    ends = np.cumsum([len(b) // 8 for b in blobs])
    order = np.argsort(hashes, kind="stable")
    same = np.diff(hashes[order]) == 0
    shared = np.zeros(len(hashes), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    parts = np.split(shared, ends[:-1])
    some = [k for k, p in enumerate(parts) if p.any()]
    return pa.table({
        "block": bucket.column("block").take(pa.array(some, pa.int64())),
        "bucket": bucket.column("bucket").take(pa.array(some, pa.int64())),
        "bits": pa.array([np.packbits(parts[k]).tobytes() for k in some], pa.binary())})


def _cut(buckets: int, size: int, with_text: bool):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(text_bytes(docs.column("text").combine_chunks()), size)
        cuts, repeated = block.cuts(buckets), block.count > 1
        for k, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()):
            n = cuts[k + 1] - cuts[k]
            repeated[cuts[k]:cuts[k + 1]] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
        change = np.zeros(block.first[-1] + size + 1, np.int32)
        starts = block.start[repeated[block.which]] if len(block.start) else block.start
        change[starts] += 1
        change[starts + size] -= 1
        keep = np.cumsum(change)[:block.first[-1]] == 0
        out = {c: [] for c in ("n_words", "n_removed", "starts", "ends", "sha", "kept")}
        for words, a, b in zip(block.words, block.first, block.first[1:]):
            here = keep[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate([[1], here, [1]]).astype(np.int8)))
            kept = b" ".join(words if len(edges) == 0 else compress(words, here.tolist()))
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - int(here.sum()))
            out["starts"].append(edges[0::2])
            out["ends"].append(edges[1::2])
            out["sha"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept if with_text else None)
        lists = pa.list_(pa.int64())
        columns = {
            "key": docs.column("key").combine_chunks(),
            "n_words": pa.array(out["n_words"], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()),
            "removed_starts": pa.array(out["starts"], lists), "removed_ends": pa.array(out["ends"], lists),
            "kept_sha256": pa.array(out["sha"], pa.string())}
        if with_text:
            columns["kept_text"] = pa.array(out["kept"], pa.binary()).cast(pa.string())
        return pa.table(columns)

    return trimmed(run)


def remove_repeats(docs: DataFrame, size: int = SIZE, key: str = "doc_id", text: str = "text",
                   with_text: bool = False) -> DataFrame:
    """key, n_words, n_removed, removed_starts and removed_ends (word indices of the maximal
    removal intervals, end exclusive), kept_sha256, and kept_text if asked for."""
    spark = docs.sparkSession
    python_ready(spark)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    total, least = text_size(narrow), shuffle_partitions(spark)
    blocks = max(least, math.ceil(total / BLOCK_BYTES))
    buckets = max(least, math.ceil(total * HASH_BYTES_A_TEXT_BYTE / BUCKET_BYTES))
    kind = narrow.schema["key"].dataType.simpleString()
    dealt = narrow.select(F.pmod(F.xxhash64("key", "text", F.spark_partition_id()), F.lit(blocks)).alias("block"), "key", "text")
    hashed = dealt.groupBy("block").applyInArrow(
        _hash_block(buckets, size), "block long, bucket long, hashes binary")
    answers = hashed.groupBy("bucket").applyInArrow(trimmed(_answer), "block long, bucket long, bits binary")
    schema = (f"key {kind}, n_words long, n_removed long, removed_starts array<long>, removed_ends array<long>, "
              "kept_sha256 string") + (", kept_text string" if with_text else "")
    # The same deal of the texts feeds both sides, so Spark shuffles them once.
    cut = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _cut(buckets, size, with_text), schema)
    return cut.withColumnRenamed("key", key)
