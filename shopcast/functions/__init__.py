"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from shopcast.functions.exact import (  # noqa: F401
    idiv, round_ratio, cents_to_units, ratio_to_units, dec, moment_std)
from shopcast.functions.calendar import (  # noqa: F401
    day_of_week, is_weekend, calendar_columns, calendar_dict, date_range)
from shopcast.functions.bands import distance_band, DISTANCE_BANDS  # noqa: F401
