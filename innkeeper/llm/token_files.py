"""Token-ID files: documents encoded to ids in Parquet list columns.

A file row is one document: key, n_tokens, its ids (list<int>, the end id last), the part
(file) it is in and how many ids of that part come before it. Rows are in ascending key
order over all files. Ids are dictionary-encoded (delta-encoded where a column chunk has
too many values for a dictionary, Parquet format 2), row groups and pages are kept small,
and page indexes let a reader open only the pages of the keys it asks for, or the
metadata without the ids.

Texts are range-partitioned by key before they are encoded: a text is smaller than its ids.
The tokenizer removes white space before it looks at anything else and no piece of its
pre-tokenizer spans white space, so words can be encoded on their own (``independent_words``
checks the tokenizer file for that; other files are encoded text by text). Texts of plain
Latin characters are cut in numpy where the pre-tokenizer cuts them (letter runs, single
digits, runs of the rest). The ids of pieces are remembered by a 64-bit hash, and new pieces
are encoded many in one call: each ends with its first id whose token carries the
end-of-word suffix. Other texts go word by word.

Edge cases: a null text is an empty text (one id, the end id); a null key sorts first; equal
keys are ordered by text; an empty table writes one empty file; further columns are not
written.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, mixed, powers, python_ready, relieved, shuffle_partitions, text_bytes, text_size

END_ID = 2
FILE_FORMAT = {
    "parquet.block.size": str(16 << 20),  # row group
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "200",
    "parquet.dictionary.page.size": str(2 << 20),
    "parquet.writer.version": "PARQUET_2_0",
    "compression": "zstd",
}
MOST_REMEMBERED = 1_000_000  # pieces, in tables of 12 bytes a slot and their ids
SLOTS = 1 << 21
TEXT_AT_ONCE = 1 << 19
BATCH_ROWS = 250
FILE_TEXT_BYTES = 64 << 20  # text of a file, about; its rows are encoded and written by one task


def independent_words(file: str) -> bool:
    """True if white space is removed before splitting and no split pattern or special token holds any."""
    with open(file, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    cuts = any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")
               and r"[^\s\p{L}\p{N}]" in s["pattern"].get("Regex", "") and " " not in s["pattern"]["Regex"] for s in steps)
    alike = {"NFC", "Replace", "Lowercase"}  # these change a text the same way on either side of white space
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    return cuts and all(s["type"] in alike for s in steps) and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]]
                            for t in spec.get("added_tokens", []))


# Characters of plain texts: printable ASCII but the apostrophe (the pre-tokenizer has contractions) and
# the letters of Latin-1, which have one lower-case letter each and no other form under NFC.
PLAIN_ASCII = bytes([*range(9, 14), *range(0x20, 0x27), *range(0x28, 0x7F)])
PLAIN_OTHER = re.compile(rb"(?:\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])*")
# Class of a byte of a plain lower-case text: white space 0, letter 1 (all beyond ASCII are), digit 2, other 3.
CLASS = np.array([0 if c in b" \t\n\x0b\x0c\r" else 1 if 97 <= c <= 122 or c >= 128 else 2 if 48 <= c <= 57 else 3
                  for c in range(256)], np.uint8)
PIECES_A_CALL = 100
BASE = 0xD1342543DE82EF95  # odd


class Remembered:
    """64-bit key -> number, by open addressing; keys are never 0."""

    def __init__(self):
        self.keys = np.zeros(SLOTS, U64)
        self.numbers = np.zeros(SLOTS, np.int32)
        self.count = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> U64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers, -1 for keys that are not there."""
        out, slots, open_ = np.full(len(keys), -1, np.int32), self._slots(keys), np.arange(len(keys))
        while len(open_):
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.numbers[slots[open_[hit]]]
            open_ = open_[~hit & (there != 0)]
            slots[open_] = (slots[open_] + 1) % SLOTS
        return out

    def add(self, keys: np.ndarray) -> None:
        """Numbers distinct new keys from ``count`` on."""
        slots, open_ = self._slots(keys), np.arange(len(keys))
        while len(open_):
            free = open_[self.keys[slots[open_]] == 0]
            self.keys[slots[free]] = keys[free]
            won = free[self.keys[slots[free]] == keys[free]]  # of several for one slot, the last
            self.numbers[slots[won]] = self.count + won
            open_ = np.setdiff1d(open_, won, assume_unique=True)
            slots[open_] = (slots[open_] + 1) % SLOTS
        self.count += len(keys)


class Encoder:
    """Ids of texts. Pieces met so far are remembered, and forgotten all at once when there are too many."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.by_word = independent_words(file) and bool(suffix)
        if self.by_word:
            self.ends_piece = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends_piece[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
            self.forget()

    def forget(self) -> None:
        self.table, self.ids, self.used = Remembered(), np.zeros(1 << 16, np.int32), 0
        self.start, self.length = np.zeros(MOST_REMEMBERED, np.int64), np.zeros(MOST_REMEMBERED, np.int32)
        self.words: dict[bytes, np.ndarray] = {}

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.int32)

    def learn(self, pieces: list[bytes], keys: np.ndarray) -> None:
        parts = [pieces[at:at + PIECES_A_CALL] for at in range(0, len(pieces), PIECES_A_CALL)]
        encoded = self.tokenizer.encode_batch_fast([b" ".join(p).decode() for p in parts], add_special_tokens=False)
        new, lengths = [], []
        for part, e in zip(parts, encoded):
            ids = np.array(e.ids, np.int32)
            ends = np.flatnonzero(self.ends_piece[ids]) + 1
            if len(ends) == len(part):
                new.append(ids)
                lengths.append(np.diff(ends, prepend=0))
            else:  # not cut where expected: one by one
                each = [self.whole(p) for p in part]
                new += each
                lengths.append(np.array([len(x) for x in each], np.int64))
        ids, lengths = np.concatenate(new), np.concatenate(lengths)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        at = self.table.count
        self.start[at:at + len(keys)] = self.used + np.cumsum(lengths) - lengths
        self.length[at:at + len(keys)] = lengths
        self.used += len(ids)
        self.table.add(keys)

    def plain(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain lower-case texts one after another, and how many each has."""
        data = b"\n".join([*texts, b""])
        text = np.frombuffer(data, np.uint8)
        kind = CLASS[text]
        begins = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == 2)])
        at = np.append(np.flatnonzero(begins), len(text))
        word = kind[at[:-1]] != 0
        start, end = at[:-1][word], at[1:][word]
        # sum(byte * INVERSE^(i - start)) mod 2^64 over a piece, by prefix sums
        sums = np.concatenate([np.zeros(1, U64), np.cumsum((text + U64(1)) * powers(pow(BASE, -1, 1 << 64), len(text)), dtype=U64)])
        keys = mixed((sums[end] - sums[start]) * powers(BASE, len(text))[start] + (end - start).astype(U64)) | U64(1)
        number = self.table.find(keys)
        if (missing := np.flatnonzero(number < 0)).size:
            new, first = np.unique(keys[missing], return_index=True)
            which = missing[first]
            if self.table.count + len(new) > MOST_REMEMBERED:
                self.forget()
                return self.plain(texts)
            self.learn([data[a:b] for a, b in zip(start[which].tolist(), end[which].tolist())], new)
            number = self.table.find(keys)
        length = self.length[number].astype(np.int64)
        before = np.cumsum(length) - length
        ids = self.ids[np.repeat(self.start[number] - before, length) + np.arange(length.sum())]
        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        owner = np.searchsorted(firsts, start, "right") - 1
        return ids, np.bincount(owner, weights=length, minlength=len(texts)).astype(np.int64)

    def by_words(self, text: bytes) -> np.ndarray:
        out = []
        for w in text.split():
            ids = self.words.get(w)
            if ids is None:
                if len(self.words) > MOST_REMEMBERED // 20:
                    self.words.clear()
                ids = self.words[w] = self.whole(w)
            out.append(ids)
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_word:
            return [self.whole(t) for t in texts]
        out: list = [None] * len(texts)
        easy = [k for k, t in enumerate(texts)
                if PLAIN_OTHER.fullmatch(t.translate(None, PLAIN_ASCII)) and b"<|" not in t]  # as special tokens begin
        # Many texts at once, but no more than their pieces can be remembered, were they all different.
        at = 0
        while at < len(easy):
            part, size = [], 0
            while at < len(easy) and (not part or size + len(texts[easy[at]]) <= TEXT_AT_ONCE):
                part.append(easy[at])
                size += len(texts[easy[at]])
                at += 1
            if size > MOST_REMEMBERED:
                out[part[0]] = self.by_words(texts[part[0]])
                continue
            lower = [texts[k].lower() if texts[k].isascii() else texts[k].decode().lower().encode() for k in part]
            ids, counts = self.plain(lower)
            for k, x in zip(part, np.split(ids, np.cumsum(counts)[:-1])):
                out[k] = x
        return [self.by_words(t) if x is None else x for t, x in zip(texts, out)]


_encoders: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    if file not in _encoders:
        _encoders[file] = Encoder(file)
    return _encoders[file]


def _encode(file: str, end_id: int):
    end = np.array([end_id], np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        enc = encoder(file)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):  # ids of at most so many documents at once
                b = whole.slice(at, BATCH_ROWS)
                each = [x for ids in enc.encode(text_bytes(b.column(1))) for x in (ids, end)]
                ends = np.cumsum([len(x) + 1 for x in each[::2]])
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                ids = pa.array(np.concatenate(each))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(offsets, ids),
                     pa.array(np.full(b.num_rows, part, np.int32)), pa.array(before + offsets[:-1].astype(np.int64))],
                    names=["key", "n_tokens", "ids", "part", "before"])
                before += int(ends[-1])

    return relieved(run)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, key: str = "doc_id",
                 text: str = "text") -> None:
    """Encodes docs into Parquet files under ``path``."""
    python_ready(docs.sparkSession)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    parts = max(shuffle_partitions(docs.sparkSession), math.ceil(text_size(narrow) / FILE_TEXT_BYTES))
    ordered = narrow.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    tokens = ordered.mapInArrow(_encode(tokenizer, end_id),
                                f"key {kind}, n_tokens long, ids array<int>, part int, before long")
    tokens.write.options(**FILE_FORMAT).mode("errorifexists").parquet(path)


def read_tokens(spark: SparkSession, path: str, condition=None, ids: bool = True) -> DataFrame:
    """key, start (ids of all documents before it), n_tokens and, if asked for, ids.

    ``condition`` on ``key`` reaches the files' page indexes; without ids only metadata pages are read.
    """
    rows = spark.read.parquet(path)
    # One number a file; running totals over them give where each file begins. The begins are handed back
    # as a local table, whose size Spark knows: it is broadcast while it is small, and no ids are shuffled.
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    begins, total = [], 0
    for r in parts:
        begins.append((r["part"], total))
        total += r["n"]
    table = pa.table({"part": pa.array([p for p, _ in begins], pa.int32()), "begin": pa.array([b for _, b in begins], pa.int64())})
    if condition is not None:
        rows = rows.where(condition)
    out = rows.join(spark.createDataFrame(table), "part")
    return out.select("key", (F.col("begin") + F.col("before")).alias("start"), "n_tokens", *(["ids"] if ids else []))


def checksums(tokens: DataFrame) -> DataFrame:
    """ids replaced by ids_crc32: unsigned CRC-32 of the ids as little-endian 32-bit integers."""
    python_ready(tokens.sparkSession)
    kept = [c for c in tokens.columns if c != "ids"]
    at = tokens.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(at)
            flat, cuts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:z].astype("<u4").tobytes()) for a, z in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(crc, pa.int64())],
                                             names=[*kept, "ids_crc32"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*kept).schema)
    return tokens.mapInArrow(run, fields + ", ids_crc32 long")
