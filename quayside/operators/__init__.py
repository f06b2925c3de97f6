"""Relational operators the feeds are built from.  Each is a composition of
DataFrame operations, so Catalyst and AQE plan them."""

from quayside.operators.account import accounting, balance, counted
from quayside.operators.lookup import conflicts, difference, dimension, heavy_hitters, lookup, broadcast_if_small, prove_small
from quayside.operators.interval import interval_lookup, code_list, code_lists, validity_flag
from quayside.operators.periods import code_periods, latest_at
from quayside.operators.open_spans import latest_open
from quayside.operators.bloom import bloom_filter, bloom_filters, may_contain, only_possible
from quayside.operators.membership import membership_flag, ordered_membership
from quayside.operators.window import cut_by_range, lag_within
from quayside.operators.maintenance import (
    Rank, backfill, fill_defaults, materialize, purge, ranked_backfill, ranked_lookup, union_by_name, typed_nulls,
)

__all__ = [
    "accounting", "balance", "counted",
    "conflicts", "difference", "dimension", "heavy_hitters", "lookup", "broadcast_if_small", "prove_small", "interval_lookup", "code_list", "code_lists", "validity_flag",
    "code_periods", "latest_at", "latest_open", "bloom_filter", "bloom_filters", "may_contain", "only_possible",
    "membership_flag", "ordered_membership", "cut_by_range", "lag_within", "Rank", "backfill", "ranked_backfill", "ranked_lookup",
    "fill_defaults", "materialize", "purge", "union_by_name", "typed_nulls",
]
