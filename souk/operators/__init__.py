"""Reusable DataFrame operators: size-bounded broadcast, skew-safe duplicate
flagging, and row-level data-quality rules."""

from .dedupe import flag_duplicates
from .joins import bounded_broadcast
from .rules import Rule, rule_counts, validate_flags, validate_message
from .topk import top_k_per_group

__all__ = ["bounded_broadcast", "flag_duplicates", "Rule", "rule_counts",
           "top_k_per_group", "validate_flags", "validate_message"]
