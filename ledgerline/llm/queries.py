"""Named queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (byte_bpe, chat_grammar, fm_classifier, host_rules, license_rules, merkle, minhash_join, mixing, pivot_index, prefix_trie,
               projected_knn, pyp_lm, recompression)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fm_classifier": fm_classifier.query,
    "op2_license_rules": license_rules.query,
    "op3_mixing": mixing.query,
    "op4_byte_bpe": byte_bpe.query,
    "op5_pyp_lm": pyp_lm.query,
    "op6_host_rules": host_rules.query,
    "op7_pivot_index": pivot_index.query,
    "op8_recompression": recompression.query,
    "op9_chat_grammar": chat_grammar.query,
    "op10_minhash_join": minhash_join.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_merkle": merkle.query,
    "op13_projected_knn": projected_knn.query,
}

ORACLES: dict[str, str] = {
    "op2_license_rules": license_rules.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op6_host_rules": host_rules.ORACLE,
    "op7_pivot_index": pivot_index.ORACLE,
    "op8_recompression": recompression.ORACLE,
    "op9_chat_grammar": chat_grammar.ORACLE,
    "op10_minhash_join": minhash_join.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_merkle": merkle.ORACLE,
}
