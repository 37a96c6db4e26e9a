"""Queries of this subpackage, by registered name, and their DuckDB equivalents where SQL can express them."""

from __future__ import annotations

from .bpe import op5_bpe
from .chat import OP7_SQL, op7_chat
from .lexical import OP11_SQL, op11_lexical
from .metric_join import op4_embeddings
from .mixing import op10_mixing
from .sharding import op9_sharding
from .simhash import op3_simhash
from .suffixes import op2_suffixes
from .toxicity import op8_toxicity
from .trie import OP12_SQL, op12_trie
from .urls import OP1_SQL, op1_urls
from .vptree import op6_nearest
from .warc import OP13_SQL, op13_warc

QUERIES = {
    "op1_urls": op1_urls,
    "op2_suffixes": op2_suffixes,
    "op3_simhash": op3_simhash,
    "op4_embeddings": op4_embeddings,
    "op5_bpe": op5_bpe,
    "op6_nearest": op6_nearest,
    "op7_chat": op7_chat,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_mixing": op10_mixing,
    "op11_lexical": op11_lexical,
    "op12_trie": op12_trie,
    "op13_warc": op13_warc,
}

ORACLE_SQL = {
    "op1_urls": OP1_SQL,
    "op7_chat": OP7_SQL,
    "op11_lexical": OP11_SQL,
    "op12_trie": OP12_SQL,
    "op13_warc": OP13_SQL,
}
