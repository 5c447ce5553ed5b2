"""Queries over the driver's tables, one for each operator or family of them."""

from sieveline.plans import corpus, domain, extract, inventory, matching, merging, passes, reports, retrieval, sequences, sourcing, texts, values  # noqa: F401
from sieveline.plans.registry import QUERIES, SQL  # noqa: F401
