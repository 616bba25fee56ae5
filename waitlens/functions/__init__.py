"""Column-level helpers. Every helper returns a ``Column`` built from built-in
Spark functions, so it stays inside whole-stage code generation."""

from waitlens.functions.dates import (  # noqa: F401
    completed_years, days_between, month_start, parse_date,
)
from waitlens.functions.nulls import (  # noqa: F401
    keep_null_not_rlike, lenient_sum, strict_mean, strict_sum,
)
from waitlens.functions.numeric import mean_of_rounded, round_half_even, safe_ratio  # noqa: F401
from waitlens.functions.text import clean_name, clean_names, split_code_label, strip_last_char  # noqa: F401
