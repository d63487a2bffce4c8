"""Suffix-array dedup: every byte covered by a string of ``SIZE`` bytes that also starts elsewhere is removed.

Texts are UTF-8 bytes, a match never crosses documents, and strings are judged on the input. Repeats
are found by sorting suffixes (``induced_sort``: induced sorting in external memory, with common
prefixes): a window is repeated if its suffix shares ``SIZE`` bytes with a neighbour in order.

Shards. The suffixes of equal windows have to meet in one sorted shard, so shards are cut by content,
not by document:
  1. Each window is named by the smallest-hash 16 bytes in it, its anchor. Neighbouring windows mostly
     have the same one, and equal windows have equal ones at the same place. The windows of an anchor,
     in two halves by their place, form a cell; all of them share the bytes around the anchor (at least
     108), whose hash is the cell's key. Its string is the text that its windows cover, at most 292 bytes.
  2. Blocks of documents send (key, hash of the string) of their cells, each once, to buckets of the
     keys. A key that occurs once in the corpus ends there: its windows cannot be repeated. Equal strings
     of a key are one string with a count; it goes on once, if its key has other strings, too.
  3. The strings go to shards by key, all strings of a key to one, and each shard is sorted as one text. A
     string with a count, or a window in a neighbourhood of 200 shared bytes, is repeated.
  4. The bits of the windows go back to the documents that wait for them.
A key with more than ``HOT`` different strings (a passage that very many documents share, at its ends) is
not gathered: its windows are counted one by one by 128-bit hashes, as a Spark aggregation.

Bounds: a block has ``BLOCK_BYTES`` of text or one document; a shard's sort uses ``MEMORY`` bytes for its
queues and maps larger arrays to files. Hashes of keys only choose who meets; two strings count as equal
by 64 bits within one key of at most ``HOT`` strings.

Edge cases: null is empty; texts below ``SIZE`` bytes keep all; equal rows are repeats of each other, null
keys too; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .common import U64, mixed, powers, python_ready, shuffle_partitions, text_bytes, text_size, trimmed
from .components import stored
from .induced_sort import Disk, suffix_array

SIZE = 200
GRAM = 16
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
SYMBOLS = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=U64)
PIECE = 1 << 18  # bytes hashed at once
PLACE = U64((1 << 20) - 1)  # a place in a piece, below the bits of its hash
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
SHARD_BYTES = 4 << 20
MEMORY = 64 << 20
HOT = 4096
SINGLE, REPEATED, FIRST, CUT = 1, 2, 3, 4  # what a bucket says of a cell; 0: its key occurs once


def _cells(parts: list[np.ndarray], size: int):
    """Cells of some texts: text, first window, number of windows, key, hash of the string."""
    text = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    n, places = len(text), size - GRAM + 1
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(SYMBOLS[text] * powers(INVERSE, n), dtype=U64)])
    up = powers(BASE, n + 1)
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * up[GRAM - 1:n])
    least = (grams & ~PLACE) | np.arange(len(grams), dtype=U64)  # of equal ones the first
    step = 1
    while 2 * step <= places:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < places:
        least = np.minimum(least[:len(least) - (places - step)], least[places - step:])
    anchor = (least & PLACE).astype(np.int64)
    windows = np.arange(len(anchor))
    which = np.searchsorted(ends, windows, "right")
    inside = windows + size <= ends[which]
    half = (places + 1) // 2
    cell = np.where(inside, 2 * anchor + (anchor - windows >= half), -1)
    edges = np.flatnonzero(np.diff(cell, prepend=-2, append=-2))
    first, last = edges[:-1], edges[1:] - 1
    real = cell[first] >= 0
    first, last = first[real], last[real]
    place, part = cell[first] >> 1, cell[first] & 1
    low = part * half
    start, end = place - low, place - np.minimum(low + half - 1, places - 1) + size
    span = lambda a, b: (sums[b] - sums[a]) * up[b - 1]
    key = mixed(span(start, end) + part.astype(U64))
    # Equal strings with their windows at the same places.
    string = mixed(mixed(span(first, last + size)) + ((place - first) * 512 + last - first).astype(U64))
    text_of = which[first]
    begins = ends - [len(p) for p in parts]
    return text_of, first - begins[text_of], last - first + 1, key, string


class Block:
    """Different texts of a block and their cells; ``own`` are the different (key, string) pairs in order."""

    def __init__(self, texts: list[bytes], size: int):
        copies: dict[bytes, int] = {}
        for t in texts:
            copies[t] = copies.get(t, 0) + 1
        self.texts, self.size = list(copies), size
        self.copies = np.array(list(copies.values()), np.int64)
        self.ids = [xxh3_128_digest(t) for t in self.texts]
        found, parts, total = [], [], 0

        def flush():
            if parts:
                of, first, *rest = _cells([p for _, _, p in parts], size)
                found.append((np.array([k for k, _, _ in parts])[of], first + np.array([a for _, a, _ in parts])[of], *rest))
                parts.clear()

        for k, t in enumerate(self.texts):
            raw = np.frombuffer(t, np.uint8)
            for a in range(0, len(t) - size + 1, PIECE):  # pieces of a long text share what a window needs
                p = raw[a:a + PIECE + size - 1]
                if total + len(p) > PIECE + size and parts:
                    flush()
                    total = 0
                parts.append((k, a, p))
                total += len(p)
        flush()
        none = np.zeros(0, np.int64)
        self.text, self.first, self.count, key, string = (
            (np.concatenate(x) for x in zip(*found)) if found else (none, none, none, none.astype(U64), none.astype(U64)))
        order = np.lexsort((string, key))
        new = np.concatenate([[True], (np.diff(key[order]) != 0) | (np.diff(string[order]) != 0)])[:len(order)]
        group = np.cumsum(new) - 1
        self.which = np.empty(len(order), np.int64)
        self.which[order] = group
        at = order[new]
        self.example = at
        self.key = key[at]
        many = np.bincount(self.which, self.copies[self.text], minlength=len(at)) > 1
        self.string = (string[at] & ~U64(1)) | many.astype(U64)

    def cuts(self, buckets: int) -> np.ndarray:
        step = (1 << 64) // buckets + 1
        return np.append(np.searchsorted(self.key, np.array([k * step for k in range(buckets)], dtype=U64)), len(self.key))


def _block_cells(buckets: int, size: int):
    def run(docs: pa.Table) -> pa.Table:
        block = Block(text_bytes(docs.column("text").combine_chunks()), size)
        cuts = block.cuts(buckets)
        some = np.flatnonzero(np.diff(cuts))
        blob = [block.key[cuts[k]:cuts[k + 1]].astype("<u8").tobytes() + block.string[cuts[k]:cuts[k + 1]].astype("<u8").tobytes()
                for k in some]
        return pa.table({"block": pa.array(np.full(len(some), docs.column("block")[0].as_py()), pa.int64()),
                         "bucket": pa.array(some, pa.int64()), "cells": pa.array(blob, pa.binary())})

    return trimmed(run)


def _judge(bucket: pa.Table) -> pa.Table:
    """For each block's cells of the bucket what becomes of them."""
    blobs = [np.frombuffer(b, "<u8").reshape(2, -1) for b in bucket.column("cells").to_pylist()]
    key, string = np.concatenate(blobs, axis=1)
    many, string = (string & U64(1)).astype(np.int64), string >> U64(1)
    order = np.lexsort((string, key))
    new_key = np.concatenate([[True], np.diff(key[order]) != 0])
    new = new_key | np.concatenate([[True], np.diff(string[order]) != 0])
    group, of_key = np.cumsum(new) - 1, np.cumsum(new_key) - 1
    times = np.bincount(group, 1 + many[order])
    total = np.bincount(of_key, 1 + many[order])[of_key]
    strings = np.bincount(of_key, new)[of_key]
    # The only string of its key has no other to be compared to.
    counted = np.where(new & (strings > 1), FIRST, REPEATED)
    says = np.where(total == 1, 0, np.where(strings > HOT, CUT, np.where(times[group] == 1, SINGLE, counted)))
    out = np.empty(len(order), np.uint8)
    out[order] = says
    parts = np.split(out, np.cumsum([b.shape[1] for b in blobs])[:-1])
    some = [k for k, p in enumerate(parts) if p.any()]
    return pa.table({"block": bucket.column("block").take(pa.array(some, pa.int64())),
                     "bucket": bucket.column("bucket").take(pa.array(some, pa.int64())),
                     "says": pa.array([parts[k].tobytes() for k in some], pa.binary())})


def cut(text: bytes, windows: np.ndarray, size: int) -> dict:
    """The text without what the windows that start at ``windows`` cover."""
    if not len(windows):
        return {"n_bytes": len(text), "n_removed": 0, "removed_starts": [], "removed_ends": [],
                "kept_sha256": hashlib.sha256(text).hexdigest(), "kept": text}
    begun = np.zeros(len(text), np.int32)
    begun[windows] = 1
    begun = np.cumsum(begun, dtype=np.int32)
    keep = begun == 0
    keep[size:] = begun[size:] == begun[:-size]  # no window starts in the last ``size`` places
    edges = np.flatnonzero(np.diff(keep.astype(np.int8), prepend=1, append=1))
    kept = np.frombuffer(text, np.uint8)[keep].tobytes()
    return {"n_bytes": len(text), "n_removed": len(text) - len(kept), "removed_starts": edges[0::2].tolist(),
            "removed_ends": edges[1::2].tolist(), "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept}


RESULT = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "removed_starts": pa.list_(pa.int64()),
          "removed_ends": pa.list_(pa.int64()), "kept_sha256": pa.string()}
RESULT_SCHEMA = "n_bytes long, n_removed long, removed_starts array<long>, removed_ends array<long>, kept_sha256 string"
WINDOWS = "block long, id binary, first long, n long, bits binary"  # of n windows from ``first``, one bit each
STEP_SCHEMA = f"kind string, {WINDOWS}, part long, string binary, counted boolean, text binary, kept binary, {RESULT_SCHEMA}"


def _spread(buckets: int, size: int, with_text: bool):
    """Rows of four kinds: done (a document's result), waits (a document with its text), windows (bits known to
    be repeated), string (one to be sorted) and single (windows to be counted one by one: their hashes)."""
    fixed = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("id", pa.binary()), ("first", pa.int64()), ("n", pa.int64()),
                        ("bits", pa.binary()), ("part", pa.int64()), ("string", pa.binary()), ("counted", pa.bool_()),
                        ("text", pa.binary()), ("kept", pa.binary()), *RESULT.items()])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        texts = text_bytes(docs.column("text").combine_chunks())
        schema = fixed.append(docs.schema.field("key"))
        if not texts:
            return schema.empty_table()
        number = docs.column("block")[0].as_py()
        block = Block(texts, size)
        cuts = block.cuts(buckets)
        says = np.zeros(len(block.key), np.uint8)
        for k, blob in zip(answers.column("bucket").to_pylist(), answers.column("says").to_pylist()):
            says[cuts[k]:cuts[k + 1]] = np.frombuffer(blob, np.uint8)
        columns = lambda kind, size, **given: pa.table([
            pa.array([kind] * size, f.type) if f.name == "kind" else pa.array(np.full(size, number), f.type) if f.name == "block" else
            pa.array(given[f.name], f.type) if f.name in given else pa.nulls(size, f.type) for f in schema], schema=schema)
        ids = lambda cells: [block.ids[k] for k in block.text[cells].tolist()]
        where = lambda cells: zip(block.text[cells].tolist(), block.first[cells].tolist(), block.count[cells].tolist())
        of_cell = says[block.which]
        sent = np.flatnonzero((says == SINGLE) | (says == FIRST))
        c = block.example[sent]
        out = [columns("string", len(c), id=ids(c), first=block.first[c], n=block.count[c], part=block.key[sent].view(np.int64),
                       string=[block.texts[k][a:a + n + size - 1] for k, a, n in where(c)], counted=says[sent] == FIRST)]
        c = np.flatnonzero(of_cell == CUT)
        out.append(columns("single", len(c), id=ids(c), first=block.first[c], n=block.count[c], counted=block.copies[block.text[c]] > 1,
                           string=[b"".join(xxh3_128_digest(block.texts[k][a + i:a + i + size]) for i in range(n)) for k, a, n in where(c)]))
        by_text = np.argsort(block.text, kind="stable")
        bounds = np.searchsorted(block.text[by_text], np.arange(len(block.texts) + 1)).tolist()
        done, known = {}, []
        for k, t in enumerate(block.texts):
            mine = by_text[bounds[k]:bounds[k + 1]]
            said = of_cell[mine]
            repeated = mine[(said == REPEATED) | (said == FIRST)]
            n_windows = max(0, len(t) - size + 1)
            if block.copies[k] > 1:
                starts = np.arange(n_windows)
            else:
                counts = block.count[repeated]
                starts = np.repeat(block.first[repeated] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            if len(starts) < n_windows and ((said == SINGLE) | (said == CUT)).any():
                if len(starts):
                    bits = np.zeros(n_windows, bool)
                    bits[starts] = True
                    known.append((block.ids[k], n_windows, np.packbits(bits).tobytes()))
            else:
                done[t] = cut(t, starts, size)
        out.append(columns("windows", len(known), id=[i for i, _, _ in known], first=[0] * len(known), n=[n for _, n, _ in known],
                           bits=[x for _, _, x in known]))
        ready = np.array([t in done for t in texts])
        keys = docs.column("key").combine_chunks()
        results = [done[t] for t in texts if t in done]
        names = [*RESULT, "kept"] if with_text else RESULT
        out.append(columns("done", len(results), key=keys.filter(pa.array(ready)), **{c: [r[c] for r in results] for c in names}))
        waiting = [t for t in texts if t not in done]
        out.append(columns("waits", len(waiting), key=keys.filter(pa.array(~ready)), text=waiting, id=[xxh3_128_digest(t) for t in waiting]))
        return pa.concat_tables(out)

    return trimmed(run)


def _sort_shard(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorts the suffixes of all strings of the shard; gives the bits of the windows of each uncounted one."""
        disk = Disk(MEMORY)
        rows, lengths, counted, spool = [], [], [], disk.spool()
        for b in batches:
            strings = b.column("string").to_pylist()
            for s in strings:
                spool.write(s)
                spool.write(b"\xff")  # not a byte of UTF-8, so it ends a string
            lengths += map(len, strings)
            counted.append(b.column("counted").to_numpy(zero_copy_only=False))
            rows.append(b.select(["block", "id", "first", "n"]))
        if not lengths:
            return
        text = disk.mapped(spool)
        used = np.bincount(text, minlength=256) > 0
        used[255] = False
        symbol = (np.cumsum(used) + 1).astype(np.uint8)  # 0 ends all, 1 a string
        symbol[255] = 1
        x = disk.array(len(text) + 1, np.uint8)
        for a in range(0, len(text), 1 << 20):
            x[a:min(a + (1 << 20), len(text))] = symbol[text[a:a + (1 << 20)]]
        x[-1] = 0
        order, lcp = suffix_array(x, int(used.sum()) + 2, disk)
        repeated = disk.array(len(x), np.bool_)
        repeated[:] = False
        for a in range(0, len(order), 1 << 20):
            high = np.concatenate([lcp[a:a + (1 << 20)], lcp[a + (1 << 20):a + (1 << 20) + 1], [0]])[:len(order[a:a + (1 << 20)]) + 1]
            high = high >= size
            repeated[order[a:a + (1 << 20)][high[:-1] | high[1:]]] = True
        starts = np.concatenate([[0], np.cumsum(np.array(lengths) + 1)])
        at = 0
        for b, done in zip(rows, counted):
            bits, some = [], []
            for k, n in enumerate(b.column("n").to_pylist()):
                mine = repeated[starts[at]:starts[at] + n]
                at += 1
                if not done[k] and mine.any():
                    some.append(k)
                    bits.append(np.packbits(mine).tobytes())
            out = b.take(pa.array(some, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(bits, pa.binary())], names=["block", "id", "first", "n", "bits"])

    return run


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        blobs = b.column("string").to_pylist()
        counts = np.array([len(x) // 16 for x in blobs], np.int64)
        which = pa.array(np.repeat(np.arange(len(blobs)), counts))
        halves = np.frombuffer(b"".join(blobs), "<i8").reshape(-1, 2)
        first = np.repeat(b.column("first").to_numpy(), counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        times = 1 + b.column("counted").cast(pa.int8()).take(which).to_numpy().astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column("block").take(which), b.column("id").take(which), pa.array(first, pa.int64()),
             pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(times)],
            names=["block", "id", "first", "h1", "h2", "times"])


def _finish(size: int, with_text: bool):
    def run(docs: pa.Table, windows: pa.Table) -> pa.Table:
        known: dict[bytes, list] = {}
        for i, first, n, bits in zip(*(windows.column(c).to_pylist() for c in ("id", "first", "n", "bits"))):
            marks = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
            known.setdefault(i, []).append(np.flatnonzero(marks) + first)
        results: dict[bytes, dict] = {}
        out = []
        for i, t in zip(docs.column("text_id").to_pylist(), docs.column("text").to_pylist()):
            if i not in results:
                results[i] = cut(t, np.concatenate(known.get(i, [np.zeros(0, np.int64)])), size)
            out.append(results[i])
        columns = {"key": docs.column("key").combine_chunks()} | {c: pa.array([r[c] for r in out], t) for c, t in RESULT.items()}
        if with_text:
            columns["kept"] = pa.array([r["kept"] for r in out], pa.binary())
        return pa.table(columns)

    return trimmed(run)


def remove_repeats(docs: DataFrame, size: int = SIZE, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, removed_starts and removed_ends (byte spans, end exclusive), kept_sha256, and the
    remaining bytes (kept) if asked for. size: from 33 to 255."""
    if not 2 * GRAM < size <= 255:
        raise ValueError("size must be from 33 to 255")
    spark = docs.sparkSession
    python_ready(spark)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    total, least = text_size(narrow), shuffle_partitions(spark)
    blocks = max(least, math.ceil(total / BLOCK_BYTES))
    buckets = max(least, math.ceil(total / 3 / BUCKET_BYTES))  # about 16 bytes of cells for 50 of text
    kind = narrow.schema["key"].dataType.simpleString()
    # Rows equal in key and text are spread by the partition they are read in.
    dealt = narrow.select(F.pmod(F.xxhash64("key", "text", F.spark_partition_id()), F.lit(blocks)).alias("block"), "key", "text")
    cells = dealt.groupBy("block").applyInArrow(_block_cells(buckets, size), "block long, bucket long, cells binary")
    answers = cells.groupBy("bucket").applyInArrow(trimmed(_judge), "block long, bucket long, says binary")
    spread = stored(dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _spread(buckets, size, with_text), f"{STEP_SCHEMA}, key {kind}"), "spread")

    strings = spread.where("kind = 'string'").select("part", "block", "id", "first", "n", "string", "counted")
    shards = max(least, math.ceil(strings.agg(F.coalesce(F.sum(F.octet_length("string")), F.lit(0)).alias("n")).first()["n"] / SHARD_BYTES))
    # All strings of a key in one shard, which streams through its task.
    sorted_ = strings.repartition(shards, "part").mapInArrow(_sort_shard(size), WINDOWS)
    single = spread.where("kind = 'single'").select("block", "id", "first", "string", "counted").mapInArrow(
        _single_windows, "block long, id binary, first long, h1 long, h2 long, times long")
    twice = single.groupBy("h1", "h2").agg(F.sum("times").alias("times")).where("times > 1").select("h1", "h2")
    counted = single.join(twice, ["h1", "h2"], "left_semi").select(
        "block", "id", "first", F.lit(1).cast("long").alias("n"), F.lit(b"\x80").alias("bits"))
    names = ["block", "id", "first", "n", "bits"]
    windows = spread.where("kind = 'windows'").select(*names).union(sorted_).union(counted)

    more = ", kept binary" if with_text else ""
    waits = spread.where("kind = 'waits'").select(F.col("block").alias("of"), F.col("id").alias("text_id"), "key", "text")
    finished = waits.groupBy("of").cogroup(windows.groupBy("block")).applyInArrow(
        _finish(size, with_text), f"key {kind}, {RESULT_SCHEMA}{more}")
    columns = ["key", *RESULT, *(["kept"] if with_text else [])]
    return spread.where("kind = 'done'").select(*columns).union(finished.select(*columns)).withColumnRenamed("key", key)

