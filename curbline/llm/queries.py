"""Queries ``opN_<name>`` of this subpackage and their SQL, for the driver's registry."""

from curbline.llm import exact_dedup, ngram_join, ngram_trie, packing, sentencepiece_codec, suffix_dedup, tool_calls, toxicity, transport_stream, url_filter

QUERIES = {
    "op1_sentencepiece": sentencepiece_codec.query,
    "op2_tool_calls": tool_calls.query,
    "op3_ngram_trie": ngram_trie.query,
    "op4_url_filters": url_filter.query,
    "op5_exact_dedup": exact_dedup.query,
    "op6_toxicity": toxicity.query,
    "op7_transport_stream": transport_stream.query,
    "op8_harmonic_packing": packing.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_ngram_join": ngram_join.query,
}
ORACLES = {"op2_tool_calls": tool_calls.ORACLE, "op4_url_filters": url_filter.ORACLE, "op5_exact_dedup": exact_dedup.ORACLE, "op10_ngram_join": ngram_join.ORACLE}
