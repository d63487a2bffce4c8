"""One word of a million characters, and an empty table of pages."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from innkeeper.llm import (curriculum, minhash_dedup, quality_rules, queries, source_audit, substring_dedup, suffix_decontam, suffix_dedup,
                           token_files, url_rules)
from innkeeper.session import scratch_path

N = 1_000_000


@pytest.fixture(scope="module")
def runs(spark):
    texts = ["x" * N, "x" * N, "ab-" * (N // 3), "short text", None]
    return spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_words_of_a_million_characters(spark, runs):
    assert by_id(quality_rules.ledger(runs), "n_words", "word_chars") == {0: (1, N), 1: (1, N), 2: (1, N - 1), 3: (2, 9), 4: (0, 0)}
    assert by_id(minhash_dedup.near_duplicates(runs), "component_id") == {0: (0,), 1: (0,), 2: (2,), 3: (3,), 4: (4,)}
    assert by_id(curriculum.sized(runs, "doc_id"), "size") == {0: (1,), 1: (1,), 2: (1,), 3: (2,), 4: (0,)}
    assert by_id(substring_dedup.remove_repeats(runs), "n_words", "n_removed") == {0: (1, 0), 1: (1, 0), 2: (1, 0), 3: (2, 0), 4: (0, 0)}
    assert by_id(suffix_dedup.remove_repeats(runs), "n_bytes", "n_removed") == {
        0: (N, N), 1: (N, N), 2: (N - 1, N - 1), 3: (10, 0), 4: (0, 0)}
    bench = spark.createDataFrame([(1, "x" * N)], "item_id long, text string")
    assert by_id(suffix_decontam.find_matches(runs, bench), "_n_hit") == {0: (1,), 1: (1,), 2: (0,), 3: (0,), 4: (0,)}
    assert source_audit.audit(runs, least=1).where(F.length("item") == N).count() == 0  # one source has no larger share than its language
    path = scratch_path(spark, "long-tokens")
    token_files.write_tokens(runs.where("doc_id > 1"), path, public_tokenizers.path("word_bpe_49k.json"))
    assert token_files.read_tokens(spark, path).count() == 3


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, url_rules.RULE_SCHEMA)
    assert url_rules.judge_urls(pages, rules).collect() == []
