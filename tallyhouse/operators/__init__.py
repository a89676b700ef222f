from tallyhouse.operators.joins import (
    count_matches, exclude, excluded_values, left_join_many, left_join_sparse, restrict_to_keys,
    unmatched,
)
from tallyhouse.operators.keyed import (
    enrich, first_per_key, latest_values, typed_insert, wide_key_distinct,
)
from tallyhouse.operators.ledger import aging_buckets, credit_negative, credit_positive, nonzero_sum

__all__ = [
    "aging_buckets", "count_matches", "credit_negative", "credit_positive", "enrich", "exclude", "excluded_values",
    "first_per_key", "latest_values", "left_join_many", "left_join_sparse", "nonzero_sum", "restrict_to_keys",
    "typed_insert", "unmatched", "wide_key_distinct",
]
