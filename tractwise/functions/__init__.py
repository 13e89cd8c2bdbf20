"""Column expressions."""

from tractwise.functions.arithmetic import (
    clamp_at_zero, hash_uniform, round_int, row_sum, safe_divide,
)
from tractwise.functions.population import prime_age_raw

__all__ = [
    "clamp_at_zero", "hash_uniform", "prime_age_raw", "round_int", "row_sum", "safe_divide",
]
