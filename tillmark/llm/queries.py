"""The operators as queries over the given tables, and SQL for those that SQL can express.

Without SQL, because it has no such primitive: encoding and decoding (1), token counts (7),
fingerprints and their groups (3), learned scores and spans (5, 6, 8). Components of linked
vectors (2) and benchmark windows in whole documents (4) are too slow in SQL on whole tables.
Main text (11) needs a parser, misspelt words (13) a checksum that SQL lacks. 1 to 4, 7, 11 and
13 are tested against brute force or the tokenizer library in ``tests/llm``, 5 and 6 too for
their base spans; learned scores and spans (5, 6, 8) against held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillmark.llm import phrases, preferences, url_filter
from tillmark.llm.bpe import encoding_digests
from tillmark.llm.decontaminate import contamination_digests
from tillmark.llm.embeddings import near_duplicates
from tillmark.llm.main_text import page_texts
from tillmark.llm.pii import personal_data
from tillmark.llm.quality import quality_scores
from tillmark.llm.secrets import secret_findings
from tillmark.llm.simhash import fingerprint_groups
from tillmark.llm.spelling import spelling_groups
from tillmark.llm.token_counts import document_counts


def over(operator: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query that applies an operator to whole tables."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in tables))

    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": over(encoding_digests, "documents"),
    "op2_embedding_dedup": over(near_duplicates, "embeddings"),
    "op3_simhash_dedup": over(fingerprint_groups, "documents"),
    "op4_decontamination": over(contamination_digests, "documents", "benchmark"),
    "op5_pii": over(personal_data, "documents"),
    "op6_secrets": over(secret_findings, "documents"),
    "op7_token_counts": over(document_counts, "documents"),
    "op8_quality": over(quality_scores, "documents", "labels"),
    "op9_url_filter": over(url_filter.judged_urls, "pages", "labels"),
    "op10_preferences": over(preferences.preference_pairs, "conversations"),
    "op11_main_text": over(page_texts, "pages"),
    "op12_collocations": over(phrases.collocations, "documents"),
    "op13_spelling": over(spelling_groups, "documents"),
}

SQL = {
    "op9_url_filter": url_filter.SQL,
    "op10_preferences": preferences.SQL,
    "op12_collocations": phrases.SQL,
}
