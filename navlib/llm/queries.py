"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from navlib.llm import dart_minhash, decontaminate, exact_packing, hard_negatives, html_content, kneser_ney, licenses, line_dedup, order_minhash, packing, periodic, sharding, substring
from navlib.llm._frames import table

#: the packing vocabularies, two of the public tokenizer files
VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"
SMALL_SHARD = 100_000


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": lambda s, d: decontaminate.contamination(table(s, d, "documents"), table(s, d, "benchmark")),
    "op2_order_minhash": lambda s, d: order_minhash.edits(table(s, d, "documents")),
    "op3_near_duplicates": lambda s, d: dart_minhash.near_duplicates(table(s, d, "documents")),
    "op4_license_scan": lambda s, d: licenses.scan(table(s, d, "documents")),
    "op5_substring_dedup": lambda s, d: substring.removals(table(s, d, "documents")),
    "op6_sharding": lambda s, d: sharding.shards(table(s, d, "documents")),
    "op7_line_dedup": lambda s, d: line_dedup.dropped_lines(table(s, d, "documents")),
    "op8_pack": lambda s, d: packing.pack(table(s, d, "documents"), vocabulary()),
    "op9_quality_classifier": lambda s, d: kneser_ney.classified(table(s, d, "documents"), table(s, d, "labels")),
    "op10_html_content": lambda s, d: html_content.main_text(table(s, d, "pages"), table(s, d, "documents")),
    "op11_exact_packing": lambda s, d: exact_packing.pack_exactly(table(s, d, "documents"), vocabulary(WORD_VOCABULARY)),
    "op12_hard_negatives": lambda s, d: hard_negatives.mined(table(s, d, "embeddings")),
    # small shards, so that buckets split at every size of the tables
    "shards_of_100_kb": lambda s, d: sharding.shards(table(s, d, "documents"), SMALL_SHARD),
    "op13_periodic_runs": lambda s, d: periodic.run_digests(table(s, d, "documents")),
}

ORACLES: dict[str, str] = {
    "op4_license_scan": licenses.oracle(),
    "op6_sharding": sharding.oracle(),
    "shards_of_100_kb": sharding.oracle(SMALL_SHARD),
    "op7_line_dedup": line_dedup.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
