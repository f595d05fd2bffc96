"""Column expressions (JVM-side, codegen-friendly) and planning-time name rules."""

from tidemark.functions.coerce import (  # noqa: F401
    nan_to_null, to_double, to_datetime_fixed, to_datetime_inferred, to_datetime_strict,
)
from tidemark.functions.dates import date_str, month_str  # noqa: F401
