"""Operators of a training-data pipeline; ``QUERIES`` has their registered queries."""

from . import bpe, conversations, language, line_dedup, main_text, mixing, near_dups, neighbours, outliers
from . import quality, search, substrings, warc

QUERIES = {}
_MODULES = (mixing, neighbours, outliers, quality, bpe, substrings, near_dups, line_dedup, language, warc)
for _module in (*_MODULES, conversations, main_text, search):
    QUERIES.update(_module.QUERIES)
