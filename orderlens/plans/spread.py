"""How do order values spread among the most promoted orders, approximately and exactly?"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..functions.numbers import SCALE
from ..operators import percentiles
from ..operators.quality import beside_ids, guarded, require_amounts, require_unique, unique_fault
from ..sources import require_columns, require_width, spread_rows
from ..sources.contract import SPREAD_COLUMNS
from .checks import IN_PLAN


def promotion_spread(
    raw: DataFrame,
    fractions: Mapping[str, float] = percentiles.FRACTIONS,
    check: bool | str = True,
    scale: int = SCALE,
) -> DataFrame:
    """Both summaries per (sku, month) with their differences, from one pass over the orders.

    `check` looks for repeated row ids and for amounts that `scale` decimals cannot keep as they are: True before anything
    else, in jobs of their own; `IN_PLAN` while the result is read, the ids in the same pass and shuffle as the
    histogram, the amounts where they are used.
    """
    orders = spread_rows(require_columns(require_width(raw), SPREAD_COLUMNS), scale, check == IN_PLAN)
    if check == IN_PLAN:
        histogram, words = beside_ids(orders, percentiles.BIN, percentiles.histogram_measures(scale))
        return guarded(percentiles.summaries_of(histogram, fractions, scale), unique_fault(words))
    if check:
        require_amounts(raw, scale)
        require_unique(orders)
    return percentiles.both_summaries(orders, fractions, scale)
