"""All queries of the subpackage; importing the operators registers theirs."""

import corpus_pipeline  # noqa: F401
from pixelframe.llm import byte_pairs, decontamination, html_text, jaccard, language, lexical, merkle, mixing, secrets, substrings, urls, vectors, warc  # noqa: F401
from pixelframe.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
