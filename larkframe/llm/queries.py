"""Importing this registers the queries of all operators."""

from larkframe.llm import (  # noqa: F401
    bag_minhash, bpe_automaton, cosine_dedup, cover_search, language_crf, line_dedup, merkle_manifest, packing, rare_windows, repair, suffix_dedup, warc, whitening,
)
from larkframe.llm.registry import ORACLES, QUERIES  # noqa: F401
