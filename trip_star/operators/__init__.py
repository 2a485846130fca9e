"""DataFrame operators: first-seen keys, null-safe joins, dedupe, aggregates."""

from trip_star.operators.aggregates import (
    column_profile,
    non_null_counts,
    top_k,
    value_counts,
)
from trip_star.operators.dedupe import bounded_key, distinct_rows, duplicate_count, duplicate_positions, duplicate_rows
from trip_star.operators.joins import attach_id, hot_keys, lookup_columns, null_safe_equal
from trip_star.operators.keys import (
    DEFAULT_BUCKET_ROWS,
    FIRST,
    ROWS,
    counted_checkpoint,
    first_seen_by_sets,
    first_seen_ids,
    first_seen_index,
    number_checkpointed,
    number_first_seen,
    row_id,
)

__all__ = [
    "DEFAULT_BUCKET_ROWS",
    "FIRST",
    "ROWS",
    "attach_id",
    "bounded_key",
    "column_profile",
    "distinct_rows",
    "duplicate_count",
    "duplicate_positions",
    "duplicate_rows",
    "counted_checkpoint",
    "first_seen_by_sets",
    "first_seen_ids",
    "first_seen_index",
    "hot_keys",
    "lookup_columns",
    "non_null_counts",
    "null_safe_equal",
    "number_checkpointed",
    "number_first_seen",
    "row_id",
    "top_k",
    "value_counts",
]
