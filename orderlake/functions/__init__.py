"""Column helpers shared by the operators (all JVM-side built-ins)."""

from orderlake.functions.numeric import avg_round, ratio_round, round_double, to_double
from orderlake.functions.dates import month_start, whole_days
from orderlake.functions.hashing import md5_uniform

__all__ = [
    "avg_round", "ratio_round", "round_double", "to_double",
    "month_start", "whole_days", "md5_uniform",
]
