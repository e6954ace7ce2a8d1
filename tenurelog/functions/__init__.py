from .columns import (
    OPEN_END,
    asc,
    desc,
    hash_key,
    null_safe_equal,
    open_end,
    order_struct,
    round_half_up,
    text_key,
)

__all__ = [
    "OPEN_END",
    "asc",
    "desc",
    "hash_key",
    "null_safe_equal",
    "open_end",
    "order_struct",
    "round_half_up",
    "text_key",
]
