"""Column -> Column building blocks (JVM-side, whole-stage codegen)."""

from laketide.functions.text import (  # noqa: F401
    clean_string, title_case, upper_case, lower_case, full_name,
)
from laketide.functions.decode import decode_map, marital_status, gender  # noqa: F401
from laketide.functions.hashing import (  # noqa: F401
    null_to_empty, hash_columns, row_hash, surrogate_key, json_row_hash,
)
from laketide.functions.dates import (  # noqa: F401
    to_day, day_text, days_between, minutes_between, epoch_seconds,
    parse_timestamp, parse_date, parse_double, run_date,
)
from laketide.functions.names import normalize_name, normalize_columns, recast_for_export  # noqa: F401
