"""The four composed questions, raw text columns in, answers out."""

from .checks import IN_PLAN
from .cancellations import qualified_by_city
from .look_back import best_sizes
from .spread import promotion_spread
from .style_breadth import median_by_month_state

__all__ = ["IN_PLAN", "best_sizes", "median_by_month_state", "promotion_spread", "qualified_by_city"]
