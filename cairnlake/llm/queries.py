"""The queries of this subpackage and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cairnlake.llm.conversation_trie import OP11_SQL, op11_conversation_trie
from cairnlake.llm.decontamination import op8_decontamination
from cairnlake.llm.language_id import op6_language_id
from cairnlake.llm.markov_model import op2_markov_score
from cairnlake.llm.minhash import OP4_SQL, op4_minhash
from cairnlake.llm.packing import op3_packing
from cairnlake.llm.pseudonyms import op7_pii
from cairnlake.llm.token_counts import op1_token_counts
from cairnlake.llm.toxicity import op5_toxicity
from cairnlake.llm.url_filter import op9_url_filter
from cairnlake.llm.vector_codes import OP13_SQL, op13_vector_codes
from cairnlake.llm.vector_links import OP10_SQL, op10_vector_links
from cairnlake.llm.vector_search import OP12_SQL, op12_vector_search

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_markov_score": op2_markov_score,
    "op3_packing": op3_packing,
    "op4_minhash": op4_minhash,
    "op5_toxicity": op5_toxicity,
    "op6_language_id": op6_language_id,
    "op7_pii": op7_pii,
    "op8_decontamination": op8_decontamination,
    "op9_url_filter": op9_url_filter,
    "op10_vector_links": op10_vector_links,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_vector_search": op12_vector_search,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op4_minhash": OP4_SQL,
    "op10_vector_links": OP10_SQL,
    "op11_conversation_trie": OP11_SQL,
    "op12_vector_search": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
