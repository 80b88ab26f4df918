"""What the engine answers yes to. Names outside the table are answered with no."""

from __future__ import annotations

SUPPORTED = frozenset({
    "read", "create", "update", "upsert", "destroy", "bulk_create", "bulk_upsert", "update_query", "destroy_query", "update_many", "transact", "async_engine", "multitenancy",
    "filter", "boolean_filter", "nested_expressions", "expression_calculation", "expression_calculation_sort", "sort", "limit", "offset", "distinct", "distinct_sort",
    "keyset", "combine:base", "combine:union", "combine:union_all", "combine:intersect", "combine:except", "filter_relationship",
    "aggregate:count", "aggregate:sum", "aggregate:avg", "aggregate:min", "aggregate:max", "aggregate:first", "aggregate:list", "aggregate:exists", "aggregate_filter", "aggregate_relationship",
    "traverse", "vector:dense", "vector:sparse", "vector:hybrid", "cdc", "atomic:create", "atomic:update", "atomic:upsert",
    *(f"op:{x}" for x in ("==", "!=", "<", ">", "<=", ">=", "in", "is_nil", "and", "or", "not", "+", "-", "*", "/", "<>", "if", "contains", "string_starts_with", "string_ends_with", "string_downcase", "string_length", "string_trim", "length", "round", "type")),
})
REFUSED = frozenset({"join", "lateral_join", "lock", "select", "aggregate:custom", "op:like", "op:ilike", "op:ago", "partial_bulk", "ddl"})


def can(feature: str) -> bool:
    return feature in SUPPORTED
