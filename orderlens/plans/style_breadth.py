"""How broad are the styles that cover large sizes, per month and state?"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import variety
from ..sources import require_columns, style_rows
from ..sources.contract import STYLE_COLUMNS


def median_by_month_state(raw: DataFrame, smallest: str = "XXL") -> DataFrame:
    """month, state, median, style_count."""
    return variety.median_variety(variety.style_variety(style_rows(require_columns(raw, STYLE_COLUMNS), smallest)))
