"""Secret scan: known credential forms, and entropy of sliding windows over candidate strings.

Base kinds, each leftmost and non-overlapping, failing matches dropped:
  assign  (password|passwd|secret|token|api_?key)["']? [:=] ["']?value, value of 6+ characters
  access  AKIA[A-Z0-9]+ of 20+ characters
  hex     [0-9a-f]+ of 24+ characters
Entropy kinds add spans, never remove base ones. Candidates are maximal runs of a character
class; over each run a window slides and the Shannon entropy of its characters is kept up
by counts: a character that enters or leaves changes one term of sum(c log2 c). Terms are
integers (millionths), so the result does not depend on the order of additions. A window
is flagged when its entropy reaches the class's limit, and the span runs from the first
flagged window's start to the last one's end:
  entropy_hex     [0-9A-Fa-f], window 24, at least 3.0 bits
  entropy_base64  [A-Za-z0-9+/_=-], window 24, at least 3.9 bits
A candidate on the allow list (``ALLOWED``: plain words, numbers, UUIDs, path-like or
hyphenated words) is suppressed. A candidate is scanned in pieces of ``PIECE`` windows, so that a
run of any length costs time in proportion and a bounded piece of memory.

Spans count code points, end exclusive. All work is DataFrame functions. Texts without any
candidate carry one empty row through the shuffle, so every row of the input is returned.

Edge cases: a null or empty text has no spans; equal rows stay separate rows; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the same matches as AKIA[A-Z0-9]+ with the shorter ones dropped
HEX = r"[0-9a-f]{24,}"
HEX_DIGITS = "0123456789abcdefABCDEF"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW_SIZE = 24
PIECE = 4096  # windows of a candidate judged in one row
UNIT = 1_000_000
# kind -> (candidate pattern, characters counted, limit in bits); kinds are listed in this order
ENTROPY = {
    "entropy_hex": (r"[0-9A-Fa-f]{24,}", HEX_DIGITS, 3.0),
    "entropy_base64": (r"[A-Za-z0-9+/_=-]{24,}", BASE64, 3.9),
}
KINDS = ["assign", "access", "hex", *ENTROPY]
ALLOWED = [
    r"^[A-Za-z]+$",
    r"^[0-9]+$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    # Possessive, as no part can give way to another; the JVM runs such a repetition as a loop, not as a recursion.
    r"^[a-z0-9]++(?:[/_-][a-z]++){2,}+[/_-]?$",
]


def term(count: int) -> int:
    return round(UNIT * count * math.log2(count)) if count else 0


def most_terms(bits: float, size: int = WINDOW_SIZE) -> int:
    """Entropy >= bits exactly when the sum of terms is at most this: H = log2(n) - sum / n."""
    return math.floor(UNIT * size * (math.log2(size) - bits))


def hits(text: Column, pattern: str, kind: int, keep=lambda match, value: F.lit(True), value: int = 0) -> Column:
    """array<struct> of the pattern's matches in order: code points before it since the last match's
    end, its length, whether it is kept, and its text. NULL-free and empty without a match."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if value == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    found = F.transform(F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("p"), matches.alias("m"), values.alias("v")),
                        lambda x: F.struct(F.lit(kind).alias("kind"), F.length(x["p"]).alias("gap"),
                                           F.length(x["m"]).alias("len"), keep(x["m"], x["v"]).alias("keep"),
                                           x["m"].alias("string")))
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(
        F.array().cast("array<struct<kind:int,gap:int,len:int,keep:boolean,string:string>>"))


def flagged(candidate: Column, alphabet: str, bits: float, size: int = WINDOW_SIZE) -> Column:
    """struct(first, last): starts of the first and the last flagged window (0-based), -1 for none."""
    terms = F.array(*[F.lit(term(c)).cast("long") for c in range(size + 1)])
    blank = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0).cast("long").alias("sum"),
                     F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def moved(state: Column, at: Column, by: int) -> Column:
        """One character more (by 1) or less (by -1) at position ``at`` of the alphabet."""
        now = F.element_at(state["counts"], at)
        total = state["sum"] + F.element_at(terms, now + (by + 1)) - F.element_at(terms, now + 1)
        counts = F.transform(state["counts"], lambda c, k: F.when(k == at - 1, c + by).otherwise(c))
        return F.struct(counts.alias("counts"), total.alias("sum"), state["first"].alias("first"), state["last"].alias("last"))

    def judge(state: Column, i: Column) -> Column:
        hit = (i >= size) & (state["sum"] <= most_terms(bits, size))
        start = i - size
        return F.struct(state["counts"].alias("counts"), state["sum"].alias("sum"),
                        F.when(hit & (state["first"] < 0), start).otherwise(state["first"]).alias("first"),
                        F.when(hit, start).otherwise(state["last"]).alias("last"))

    # Leave, enter and judge are three folds of one step, so that each state is computed once.
    steps = F.array(F.lit(0), F.lit(1), F.lit(2))
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(alphabet), c))  # 1-based; 0: none leaves yet
    both = F.arrays_zip(codes.alias("enters"), F.slice(F.concat(F.array_repeat(F.lit(0), size), codes), F.lit(1),
                                                       F.length(candidate)).alias("leaves"))
    acts = F.flatten(F.transform(both, lambda x, k: F.transform(steps, lambda s: F.struct(
        (k + 1).alias("i"), s.alias("s"), x["enters"].alias("enters"), x["leaves"].alias("leaves")))))
    end = F.aggregate(acts, blank, lambda st, a: F.when(a["s"] == 2, judge(st, a["i"])).when(
        a["s"] == 1, moved(st, a["enters"], 1)).when(a["leaves"] > 0, moved(st, a["leaves"], -1)).otherwise(st))
    return F.struct(end["first"].alias("first"), end["last"].alias("last"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, and ``spans``: array<struct(start, kind_no, kind, end)> in order of start, then kind."""
    rows = docs.select(F.monotonically_increasing_id().alias("_id"), F.col(key).alias("_key"),
                       F.coalesce(F.col(text), F.lit("")).alias("_text"))
    t = F.col("_text")
    listed = [
        hits(t, ASSIGN, 0, lambda m, v: F.length(v) >= ASSIGN_VALUE_LEAST, value=2),
        hits(t, ACCESS, 1), hits(t, HEX, 2),
        *[hits(t, pattern, 3 + k, lambda m, v: ~_any(m, ALLOWED)) for k, (pattern, _, _) in enumerate(ENTROPY.values())]]
    found = rows.select("_id", "_key", F.posexplode_outer(F.concat(*listed)).alias("_n", "_h")).select(
        "_id", "_key", "_n", "_h.*").repartition("_id")
    # A match starts after all gaps up to its own and all matches before it, of its kind.
    upto = Window.partitionBy("_id", "kind").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    at = found.withColumn("start", (F.sum(F.col("gap") + F.col("len")).over(upto) - F.col("len")).cast("int"))
    # A piece has the windows that start at from to from + PIECE - 1. Rows stay where they are: all are dealt by _id.
    piece = lambda s: F.struct(s.alias("from"), F.substr("string", s + 1, F.lit(PIECE + WINDOW_SIZE - 1)).alias("part"))
    pieces = F.when((F.col("kind") >= 3) & F.col("keep"), F.transform(
        F.sequence(F.lit(0), F.col("len") - WINDOW_SIZE, F.lit(PIECE)), piece))
    at = at.select("_id", "_key", "_n", "kind", "len", "keep", "start", F.explode_outer(pieces).alias("_p"))
    judged = F.when(F.col("kind") < 3, F.struct(F.lit(0).alias("first"), (F.col("len") - WINDOW_SIZE).alias("last")))
    for k, (_, alphabet, bits) in enumerate(ENTROPY.values()):
        judged = judged.when((F.col("kind") == 3 + k) & F.col("keep"), flagged(F.col("_p.part"), alphabet, bits))
    at = at.withColumn("_w", judged)
    begun, shift = F.col("_w.first") >= 0, F.coalesce("_p.from", F.lit(0))
    at = at.groupBy("_id", "_key", "_n").agg(
        *[F.first(c).alias(c) for c in ("kind", "keep", "start")],
        F.struct(F.coalesce(F.min(F.when(begun | (F.col("kind") < 3), F.col("_w.first") + shift)), F.lit(-1)).alias("first"),
                 F.max(F.when(begun | (F.col("kind") < 3), F.col("_w.last") + shift)).alias("last")).alias("_w"))
    names = F.array(*[F.lit(k) for k in KINDS])
    span = F.when(F.col("keep") & (F.col("_w.first") >= 0),
                  F.struct((F.col("start") + F.col("_w.first")).alias("start"), F.col("kind").alias("kind_no"),
                           F.get(names, "kind").alias("kind"),
                           (F.col("start") + F.col("_w.last") + WINDOW_SIZE).alias("end")))
    return at.groupBy("_id", "_key").agg(F.array_sort(F.collect_list(span)).alias("spans")).select(
        F.col("_key").alias(key), "spans")


def _any(c: Column, patterns: list[str]) -> Column:
    return F.rlike(c, F.lit("|".join(f"(?:{p})" for p in patterns)))


def text_of(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")
