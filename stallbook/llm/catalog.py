"""The numbered operators as queries, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stallbook.llm.decontam import op10_decontaminate
from stallbook.llm.exact import op5_exact
from stallbook.llm.language import op7_language
from stallbook.llm.page_text import op2_main_text
from stallbook.llm.packing import op8_packing
from stallbook.llm.quality import op9_quality
from stallbook.llm.ranked_search import SQL as RANKED_SEARCH_SQL
from stallbook.llm.ranked_search import op11_ranked_search
from stallbook.llm.secret_scan import op4_secrets
from stallbook.llm.shards import op1_shards
from stallbook.llm.simhash import op3_simhash
from stallbook.llm.spelling import SQL as SPELLING_SQL
from stallbook.llm.spelling import op13_spelling
from stallbook.llm.token_counts import op6_token_counts
from stallbook.llm.url_filter import SQL as URL_FILTER_SQL
from stallbook.llm.url_filter import op12_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shards": op1_shards,
    "op2_main_text": op2_main_text,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_exact": op5_exact,
    "op6_token_counts": op6_token_counts,
    "op7_language": op7_language,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_decontaminate": op10_decontaminate,
}

#: Operators beyond the first ten.
FURTHER: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op11_ranked_search": op11_ranked_search,
    "op12_url_filter": op12_url_filter,
    "op13_spelling": op13_spelling,
}

SQL: dict[str, str] = {
    "op5_exact": r"""
        WITH bodies AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept,
               sha256(body) AS text_sha256
        FROM bodies
        WINDOW same AS (PARTITION BY body)
    """,
    "op11_ranked_search": RANKED_SEARCH_SQL,
    "op12_url_filter": URL_FILTER_SQL,
    "op13_spelling": SPELLING_SQL,
}
