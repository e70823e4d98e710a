"""Registered queries of this subpackage: name -> callable(spark, sf_dir), and their SQL."""

from __future__ import annotations

from actiflow.llm.mixing import OP9_SQL, op9_mixing
from actiflow.llm.quality_rules import OP10_SQL, op10_quality_rules
from actiflow.llm.fp_search import OP13_SQL, op13_lexical_search
from actiflow.llm.neighbours import op4_neighbours
from actiflow.llm.paragraphs import op5_paragraphs, op5_passages
from actiflow.llm.pieces import op1_sentencepiece
from actiflow.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from actiflow.llm.quotes import op2_quotes
from actiflow.llm.ring import op11_ring
from actiflow.llm.secrets import op6_secrets
from actiflow.llm.simhash import op8_simhash
from actiflow.llm.token_files import op7_token_files
from actiflow.llm.topk import OP3_SQL, op3_topk

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quotes": op2_quotes,
    "op3_topk": op3_topk,
    "op4_neighbours": op4_neighbours,
    "op5_paragraphs": op5_paragraphs,
    "op5_passages": op5_passages,
    "op6_secrets": op6_secrets,
    "op7_token_files": op7_token_files,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op11_ring": op11_ring,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES = {
    "op3_topk": OP3_SQL,
    "op9_mixing": OP9_SQL,
    "op10_quality_rules": OP10_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
