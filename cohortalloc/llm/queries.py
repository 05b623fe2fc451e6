"""Registered queries of the operators, and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortalloc.llm.bit_sliced_search import OP3_SQL, op3_bit_sliced_search
from cohortalloc.llm.bpe_chunks import op9_bpe_chunks
from cohortalloc.llm.chat_format import op7_chat_format
from cohortalloc.llm.fingerprint import op1_fingerprint
from cohortalloc.llm.html_blocks import op6_html_blocks
from cohortalloc.llm.iceberg_audit import OP12_SQL, op12_iceberg_audit
from cohortalloc.llm.language_id import op10_language_id
from cohortalloc.llm.multi_index_hashing import op13_multi_index_hashing
from cohortalloc.llm.order_minhash import op4_order_minhash
from cohortalloc.llm.phrase_mining import OP11_SQL, op11_phrase_mining
from cohortalloc.llm.secret_scan import op2_secret_scan
from cohortalloc.llm.soft_mixing import op8_soft_mixing
from cohortalloc.llm.token_file import op5_token_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprint": op1_fingerprint,
    "op2_secret_scan": op2_secret_scan,
    "op3_bit_sliced_search": op3_bit_sliced_search,
    "op4_order_minhash": op4_order_minhash,
    "op5_token_file": op5_token_file,
    "op6_html_blocks": op6_html_blocks,
    "op7_chat_format": op7_chat_format,
    "op8_soft_mixing": op8_soft_mixing,
    "op9_bpe_chunks": op9_bpe_chunks,
    "op10_language_id": op10_language_id,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_iceberg_audit": op12_iceberg_audit,
    "op13_multi_index_hashing": op13_multi_index_hashing,
}

ORACLE_SQL: dict[str, str] = {
    "op3_bit_sliced_search": OP3_SQL,
    "op11_phrase_mining": OP11_SQL,
    "op12_iceberg_audit": OP12_SQL,
}
