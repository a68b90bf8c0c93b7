"""Column-level helpers (pure Spark expressions, codegen friendly)."""

from candlewick.functions.numeric import (
    exact_parts,
    parse_number,
    round_away,
    safe_corr,
    safe_pct,
)
from candlewick.functions.calendar import (
    date_id,
    is_weekend,
    season,
)

__all__ = [
    "exact_parts",
    "parse_number",
    "round_away",
    "safe_corr",
    "safe_pct",
    "date_id",
    "is_weekend",
    "season",
]
