"""The registered query of each operator and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carrymark.llm import sql
from carrymark.llm.byte_bpe import op7_byte_bpe
from carrymark.llm.common import documents
from carrymark.llm.exact import op8_exact_dedup
from carrymark.llm.fill_middle import op13_fill_middle
from carrymark.llm.language import op1_language_id
from carrymark.llm.line_dedup import op11_line_dedup
from carrymark.llm.packing import op5_best_fit_packing
from carrymark.llm.personal import op6_personal_data
from carrymark.llm.prefix_trie import op12_prefix_trie
from carrymark.llm.quality import op4_quality_rules
from carrymark.llm.secret_scan import op9_secret_scan
from carrymark.llm.simhash import op10_simhash_neardup
from carrymark.llm.token_files import op2_token_files
from carrymark.llm.toxicity import op3_toxicity


def _on_documents(operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": _on_documents(op1_language_id),
    "op2_token_files": _on_documents(op2_token_files),
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": _on_documents(op4_quality_rules),
    "op5_best_fit_packing": _on_documents(op5_best_fit_packing),
    "op6_personal_data": _on_documents(op6_personal_data),
    "op7_byte_bpe": _on_documents(op7_byte_bpe),
    "op8_exact_dedup": _on_documents(op8_exact_dedup),
    "op9_secret_scan": _on_documents(op9_secret_scan),
    "op10_simhash_neardup": _on_documents(op10_simhash_neardup),
    "op11_line_dedup": _on_documents(op11_line_dedup),
    "op12_prefix_trie": lambda spark, sf_dir: op12_prefix_trie(
        spark.read.parquet(f"{sf_dir}/conversations.parquet")),
    "op13_fill_middle": _on_documents(op13_fill_middle),
}

ORACLES: dict[str, str] = {
    "op4_quality_rules": sql.QUALITY_RULES,
    "op8_exact_dedup": sql.EXACT_DEDUP,
    "op11_line_dedup": sql.LINE_DEDUP,
    "op12_prefix_trie": sql.PREFIX_TRIE,
    "op13_fill_middle": sql.FILL_MIDDLE,
}
