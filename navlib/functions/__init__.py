"""Column-expression helpers shared by the operators."""

from navlib.functions.stats import (
    ANNUAL_SQRT,
    bias_corrected_kurtosis,
    bias_corrected_skewness,
    half_up,
    growth_percent,
    sqrt_days,
)
from navlib.functions.ranking import global_ranks, global_row_number

__all__ = [
    "ANNUAL_SQRT",
    "bias_corrected_kurtosis",
    "bias_corrected_skewness",
    "global_ranks",
    "global_row_number",
    "half_up",
    "growth_percent",
    "sqrt_days",
]
