"""Registers every query of the subpackage."""

import terrace.llm.bytepair  # noqa: F401
import terrace.llm.forest  # noqa: F401
import terrace.llm.jaccard  # noqa: F401
import terrace.llm.language  # noqa: F401
import terrace.llm.manifest  # noqa: F401
import terrace.llm.mergerounds  # noqa: F401
import terrace.llm.negatives  # noqa: F401
import terrace.llm.packing  # noqa: F401
import terrace.llm.scoring  # noqa: F401
import terrace.llm.substrings  # noqa: F401
import terrace.llm.toxicity  # noqa: F401
import terrace.llm.vamana  # noqa: F401
import terrace.llm.warc  # noqa: F401
from terrace.llm.registry import ORACLES, QUERIES  # noqa: F401
