from tidefeed.functions.exprs import (
    as_number,
    as_text,
    col,
    fmt6,
    fold_case,
    island_code,
    island_key,
    join_or,
    norm_key,
    null_like,
    null_tokens,
    only_digits,
    type_of,
)

__all__ = [
    "as_number",
    "as_text",
    "col",
    "fmt6",
    "fold_case",
    "island_code",
    "island_key",
    "join_or",
    "norm_key",
    "null_like",
    "null_tokens",
    "only_digits",
    "type_of",
]
