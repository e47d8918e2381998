"""tickforge: market and macro time-series analytics as Spark DataFrame jobs.

Layers: sources (landed payloads, series rows, config lists) -> bronze
(typed, cleaned) -> silver (renamed, checked) -> gold (equity performance,
macro dashboard). Every operator is a ``DataFrame -> DataFrame`` function.

The most used entry points are re-exported here; everything else lives in
``tickforge.operators``, ``tickforge.sources`` and ``tickforge.plans``.
"""

__version__ = "0.1.0"

from tickforge.operators.equity import daily_returns, equity_performance, monthly_returns  # noqa: E402
from tickforge.operators.macro import macro_dashboard, macro_summary  # noqa: E402
from tickforge.session import get_session  # noqa: E402

__all__ = [
    "daily_returns", "equity_performance", "monthly_returns",
    "macro_dashboard", "macro_summary", "get_session",
]
