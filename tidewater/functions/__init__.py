"""Column helpers shared by all plans."""

from .expr import (  # noqa: F401
    between_labels,
    date_key,
    floor_round,
    month_label,
    safe_divide,
    sample_std,
    stable_round,
    sum_when,
    tier,
    z_score,
)
