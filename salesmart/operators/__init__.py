"""Relational operators: code lists, lookups, rollups, existence tests."""

from .codelist import code_list, explode_list, split_list
from .joins import exists_any, role, semi_join
from .lookups import attach, enforce_single, guarded_lookup, rollup
from .returns import returns_rollup

__all__ = [
    "attach", "code_list", "enforce_single", "exists_any", "explode_list", "guarded_lookup",
    "returns_rollup", "role", "rollup", "semi_join", "split_list",
]
