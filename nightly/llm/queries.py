"""All registered queries of the text operators and their SQL."""

from __future__ import annotations

from nightly.llm import (  # noqa: F401
    conversations, decontaminate, fingerprints, jaccard, language, lexical, mixing, quality, substrings, token_counts, token_files, toxicity, warc,
)
from nightly.llm.common import ORACLES, QUERIES  # noqa: F401
