"""All queries of this package: importing the operators registers them."""

from __future__ import annotations

from fillbook.llm import (bitpack, hamming_search, langid, merkle, mixing, packing, pii, prefix_trie,  # noqa: F401
                          quality, simhash, token_counts, toxicity, urls)
from fillbook.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
