"""All queries of this subpackage, registered by importing their modules."""

from __future__ import annotations

from kerbflow.llm import alignment, classifier, decontaminate, exact, licenses, packing, phrases, quality_rules, simhash, spelling, suffixes, toxicity, url_filter  # noqa: F401
from kerbflow.llm.registry import ORACLES, QUERIES  # noqa: F401
