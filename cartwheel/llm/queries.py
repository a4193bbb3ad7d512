"""The operators' queries over the given tables, and their DuckDB SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm.binary import op2_binary_output
from cartwheel.llm.common import with_package
from cartwheel.llm.encoding import op6_sentencepiece
from cartwheel.llm.gram_join import op11_gram_join
from cartwheel.llm.imatch import op7_fingerprints
from cartwheel.llm.language import op8_language_id
from cartwheel.llm.mixing import op3_mix_sources
from cartwheel.llm.near_dup import op10_near_dedup
from cartwheel.llm.oracle import OP5, OP10, OP11, OP12, OP13
from cartwheel.llm.product_codes import op12_vector_codes
from cartwheel.llm.quality import op5_quality_rules
from cartwheel.llm.sharding import op9_sharding
from cartwheel.llm.token_counts import op4_token_counts
from cartwheel.llm.toxicity import op1_toxicity
from cartwheel.llm.trie import op13_prefix_trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: with_package(query) for query in (
        op1_toxicity,
        op2_binary_output,
        op3_mix_sources,
        op4_token_counts,
        op5_quality_rules,
        op6_sentencepiece,
        op7_fingerprints,
        op8_language_id,
        op9_sharding,
        op10_near_dedup,
        op11_gram_join,
        op12_vector_codes,
        op13_prefix_trie,
    )
}

ORACLE_SQL: dict[str, str] = {"op5_quality_rules": OP5, "op10_near_dedup": OP10, "op11_gram_join": OP11, "op12_vector_codes": OP12, "op13_prefix_trie": OP13}
