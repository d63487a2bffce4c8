"""Quality rules as a bitmask ledger.

``ledger`` measures every document once and evaluates every rule once: a row holds the
measurements and ``failed`` (long), bit k set when rule k fails. Policies are versioned
bit masks over that ledger, so a new policy, or what each of its rules does, needs no
second look at the texts: ``apply_policy`` and ``ablations`` work on the bits alone.

Words are ``[^\\x20\\x09-\\x0D]+``. Edge cases: a null or empty text has no words and all
measurements 0 (it fails ``few_words``); equal rows stay separate rows; texts of any
length are measured whole; further columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import appended, python_ready, text_bytes

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words"]


def measure(text: bytes) -> tuple[int, ...]:
    words = text.split()
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = {w for w, k in Counter(windows).items() if k > 1}
        reach = 0  # words before this index are counted already
        for i, w in enumerate(windows):
            if w in often:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return (n, len(text.translate(None, WHITE + CONTINUATION)), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated, sum(map(bytes.isupper, words)))


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: Column


def _c(name: str) -> Column:
    return F.col(name)


def rules() -> list[Rule]:
    """Bits are never reused: a changed threshold becomes a rule with a new bit."""
    return [
        Rule(0, "few_words", _c("n_words") < 50),
        Rule(1, "repeated_words", 100 * _c("n_repeat_words") > 50 * _c("n_words")),
        Rule(2, "symbols", 10 * _c("n_symbols") > _c("n_words")),
        Rule(3, "repeated_lines", 100 * _c("n_dup_lines") > 40 * _c("n_lines")),
        Rule(4, "word_length", (_c("word_chars") < 2 * _c("n_words")) | (_c("word_chars") > 15 * _c("n_words"))),
        Rule(5, "upper_case", 2 * _c("n_upper_words") > _c("n_words")),
    ]


# version -> names of the rules that reject
POLICIES = {
    "base-1": ["few_words", "repeated_words"],
    "web-1": ["few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "upper_case"],
}


def mask_of(policy: str) -> int:
    bits = {r.name: r.bit for r in rules()}
    return sum(1 << bits[name] for name in POLICIES[policy])


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the measurements, and ``failed``: one bit for each rule."""
    python_ready(docs.sparkSession)
    narrow = docs.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t) for t in text_bytes(b.column(1))]
            columns = zip(*rows) if rows else [()] * len(MEASURES)
            yield appended(b.select([0]), {m: pa.array(v, pa.int64()) for m, v in zip(MEASURES, columns)})

    kind = narrow.schema[key].dataType.simpleString()
    measured = narrow.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    failed = F.lit(0).cast("long")
    for r in rules():
        failed = failed.bitwiseOR(F.when(r.fails, F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed", failed)


def apply_policy(rows: DataFrame, policy: str) -> DataFrame:
    """Adds ``kept`` and ``sole_rule``: the rule without which a rejected row would be kept."""
    hits = F.col("failed").bitwiseAND(F.lit(mask_of(policy)).cast("long"))
    sole = F.lit(None).cast("string")
    for r in rules():
        sole = F.when(hits == (1 << r.bit), r.name).otherwise(sole)
    return rows.withColumn("kept", hits == 0).withColumn("sole_rule", sole)


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """rule, rejected (rows that fail it), sole (rows that only it rejects), kept_without.

    Rows are first folded to their bit patterns (at most 2^rules of them, combined before
    the shuffle); the rest are bit operations on the patterns.
    """
    mask = mask_of(policy)
    patterns = (rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
                .agg(F.count("*").alias("n")))
    used = [r for r in rules() if mask >> r.bit & 1]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                               for r in used])).alias("r")
    one = patterns.select("bits", "n", each).select("bits", "n", "r.*")
    has = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return one.groupBy("rule").agg(total(has).alias("rejected"), total(alone).alias("sole"),
                                   total(alone | (F.col("bits") == 0)).alias("kept_without"))
