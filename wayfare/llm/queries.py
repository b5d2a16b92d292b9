"""The registered query of each operator, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import alignment, bpe, html_text, language, lines, mixing, mtree, near_dup
from wayfare.llm import perplexity, spelling, substrings, toxicity, url_filter
from wayfare.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]


def _over(operator: Callable[..., DataFrame], *names: str) -> Query:
    """A query that applies ``operator`` to whole tables."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(*[table(spark, sf_dir, name) for name in names])

    return query


def ranks_path() -> str:
    """The multilingual rank file: given by a variable, or that of the installed package."""
    if found := os.environ.get("WAYFARE_BPE_RANKS"):
        return found
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def tokenizer_path(name: str) -> str:
    """A file of the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def aligned_digests(docs: DataFrame) -> DataFrame:
    first, second = map(tokenizer_path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.digests(docs, first, second)


def queries() -> dict[str, Query]:
    return {
        "op1_html_extraction": _over(html_text.extract, "pages"),
        "op2_exact_top_k": _over(mtree.top_k, "embeddings"),
        "op3_toxicity": _over(toxicity.predictions, "documents", "labels"),
        "op4_quality_rules": _over(lines.verdicts, "documents", "labels"),
        "op5_url_filters": _over(url_filter.verdicts, "pages", "labels"),
        "op6_byte_bpe": _over(lambda docs: bpe.digests(docs, ranks_path()), "documents"),
        "op7_quality_classifier": _over(perplexity.judge, "documents", "labels"),
        "op8_source_mixing": _over(mixing.positions, "documents"),
        "op9_language_id": _over(language.predictions, "documents"),
        "op10_minhash_near_dedup": _over(near_dup.query, "documents"),
        "op11_spelling_variants": _over(spelling.variants, "documents"),
        "op12_substring_dedup": _over(substrings.digests, "documents"),
        "op13_token_alignment": _over(aligned_digests, "documents"),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_top_k": mtree.TOP_K_SQL,
        "op5_url_filters": url_filter.VERDICTS_SQL,
        "op12_substring_dedup": substrings.DIGESTS_SQL,
    }
