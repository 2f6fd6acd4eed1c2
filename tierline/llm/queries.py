"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from tierline.llm import (
    bfd_sharding, bpe_tree, ctw_scoring, decontaminate, feast_whitening, language_id, line_dedup, ptolemaic_kmeans,
    quality_ledger, secret_scan, simhash_bktree, suffix_dedup, token_counts)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_quality_ledger": quality_ledger.op2_quality_ledger,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_language_id": language_id.op5_language_id,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_ctw_scoring": ctw_scoring.op7_ctw_scoring,
    "op8_simhash_bktree": simhash_bktree.op8_simhash_bktree,
    "op9_bpe_tree": bpe_tree.op9_bpe_tree,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op11_feast_whitening": feast_whitening.op11_feast_whitening,
    "op12_bfd_sharding": bfd_sharding.op12_bfd_sharding,
    "op13_ptolemaic_kmeans": ptolemaic_kmeans.op13_ptolemaic_kmeans,
}

ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op2_quality_ledger": quality_ledger.ORACLE,
    "op3_line_dedup": line_dedup.ORACLE,
    "op13_ptolemaic_kmeans": ptolemaic_kmeans.ORACLE,
}
