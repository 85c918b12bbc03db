from brindle.functions.exact import DIGITS, exact, exact_sum, fixed_point, scaled
from brindle.functions.timeline import from_micros, interval_micros, micros

__all__ = [
    "DIGITS",
    "exact",
    "exact_sum",
    "fixed_point",
    "from_micros",
    "interval_micros",
    "micros",
    "scaled",
]
