"""Relational building blocks of the unification pipelines."""

from marketloom.operators.consolidate import consolidate
from marketloom.operators.exchange import (
    attach_exchange_rate,
    convert_amounts,
    one_rate_per_day,
    without_exchange_rate,
)
from marketloom.operators.latest import latest, without_copies
from marketloom.operators.nested import (
    computed,
    first_of_path,
    prune_type,
    quoted,
    read_json,
    split_products,
    unnest,
    unnest_path,
    unnest_variant,
    with_elements,
)
from marketloom.operators.skew import hot_keys, key_condition, with_hot_salt
from marketloom.operators.timezone import shift_timezone

__all__ = [
    "attach_exchange_rate",
    "computed",
    "consolidate",
    "convert_amounts",
    "first_of_path",
    "hot_keys",
    "key_condition",
    "latest",
    "one_rate_per_day",
    "prune_type",
    "quoted",
    "read_json",
    "shift_timezone",
    "split_products",
    "unnest",
    "unnest_path",
    "unnest_variant",
    "with_elements",
    "with_hot_salt",
    "without_copies",
    "without_exchange_rate",
]
