"""Which size sold best in the days before each date, per state?"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.numbers import SCALE
from ..once import keep_whole
from ..operators import trailing
from ..operators.quality import empty_fault, guarded, require_amounts, require_nonempty
from ..sources import require_columns, window_rows
from ..sources.contract import WINDOW_COLUMNS
from .checks import IN_PLAN


def _totals(
    raw: DataFrame, cutoff: int, short: int, long: int, check: bool | str, scale: int
) -> tuple[DataFrame, list[DataFrame]]:
    """Totals of every candidate size, and the faults to guard the result with.

    The grid serves the window lengths and the windows themselves, so the input
    is read and shuffled once; with checks in the plan too.
    """
    rows = window_rows(require_columns(raw, WINDOW_COLUMNS), scale=scale, checked=check == IN_PLAN)
    if check and check != IN_PLAN:
        require_amounts(raw, scale)
        require_nonempty(trailing.bought(rows), "window length")
    daily = keep_whole(trailing.daily_stats(rows, scale))
    lengths = trailing.window_lengths(trailing.grid_counts(daily), cutoff, short, long)
    faults = [empty_fault(lengths, "window length")] if check == IN_PLAN else []
    return trailing.trailing_totals(trailing.with_lengths(daily, lengths)), faults


def size_totals(
    raw: DataFrame,
    cutoff: int = trailing.CUTOFF,
    short: int = trailing.SHORT_DAYS,
    long: int = trailing.LONG_DAYS,
    check: bool | str = True,
    scale: int = SCALE,
) -> DataFrame:
    """Trailing frequencies and sums of every candidate size."""
    totals, faults = _totals(raw, cutoff, short, long, check, scale)
    return guarded(totals, *faults)


def size_stats(
    raw: DataFrame,
    cutoff: int = trailing.CUTOFF,
    short: int = trailing.SHORT_DAYS,
    long: int = trailing.LONG_DAYS,
    check: bool | str = True,
    scale: int = SCALE,
) -> DataFrame:
    """Trailing statistics of every candidate size; see `best_sizes`."""
    totals, faults = _totals(raw, cutoff, short, long, check, scale)
    return guarded(trailing.with_variance(totals, scale), *faults)


def best_sizes(
    raw: DataFrame,
    cutoff: int = trailing.CUTOFF,
    short: int = trailing.SHORT_DAYS,
    long: int = trailing.LONG_DAYS,
    check: bool | str = True,
    scale: int = SCALE,
) -> DataFrame:
    """state, window_date, size, frequency, variance, amount_count, window_days.

    `check` looks for amounts that `scale` decimals cannot keep as they are and for a lookup of window lengths without
    rows: True before anything else, in jobs of their own; `IN_PLAN` while the result is read, in the amounts that it uses.
    """
    totals, faults = _totals(raw, cutoff, short, long, check, scale)
    return guarded(trailing.winners(totals, scale), *faults)
