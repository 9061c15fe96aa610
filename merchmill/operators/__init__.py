"""DataFrame building blocks, each safe when one key holds a large share of the rows."""

from merchmill.operators.batches import day_rows, draw_order, head_rows, other_rows, restamp, take_batch, top_up
from merchmill.operators.keys import first_per_key, known_keys, matching_keys, without_keys
from merchmill.operators.ordered import (
    approx_median, exact_median, median_of_counts, rank_descending, running_counts, value_counts,
)
from merchmill.operators.rules import first_failed

__all__ = [
    "approx_median", "day_rows", "draw_order", "exact_median", "first_failed", "first_per_key", "head_rows", "known_keys",
    "matching_keys", "median_of_counts", "other_rows", "rank_descending", "restamp", "running_counts", "take_batch",
    "top_up", "value_counts", "without_keys",
]
