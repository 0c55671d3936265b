"""Reusable DataFrame -> DataFrame operators."""

from strata.operators.dedup import dedup_latest  # noqa: F401
from strata.operators.ranking import (  # noqa: F401
    global_ntile, global_rank, global_row_number, next_in_sequence, surrogate_key,
)
from strata.operators.scd2 import scd2_end_dates  # noqa: F401
