"""Column -> Column expressions: keys, numbers, text, maps and JSON envelopes."""

from civiclake.functions.keys import (  # noqa: F401
    KEY, discover_key_column, discover_measure_column, mun_code, mun_code_of,
    prefix6_join, rename_first, resolve_column, standardise_key, valid_key, zfill7,
)
from civiclake.functions.numbers import (  # noqa: F401
    lenient_double, locale_count, locale_double, rate, round2, sum_or_zero,
    thousands, value_text,
)
from civiclake.functions.text import (  # noqa: F401
    iso_stamp, latest_year_key, run_stamp, truthy_number, truthy_text,
    unwrap_envelope, upper_matches, year_used, year_value,
)
