from tidefeed.streaming.accumulate import (
    accumulated,
    group_totals,
    pooled_stats,
    totals_so_far,
)
from tidefeed.streaming.rounds import (
    accumulating_round,
    last_round,
    round_output,
    run_timed,
    start_rounds,
    weekly_round,
)

__all__ = [
    "accumulated",
    "accumulating_round",
    "group_totals",
    "last_round",
    "pooled_stats",
    "round_output",
    "run_timed",
    "start_rounds",
    "totals_so_far",
    "weekly_round",
]
