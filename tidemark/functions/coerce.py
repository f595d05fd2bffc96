"""Text -> typed value coercion with "bad value becomes null" semantics (Q6-Q9).

Spark's ``try_cast`` is close to a lenient numeric parse but also accepts the
Java float suffixes ``d``/``f`` (``'1d'`` -> 1.0); those are rejected here so
that a value like ``1d`` is treated as garbage, like other unparseable text.
NaN is folded into null right after coercion because Spark, unlike null,
orders NaN above every number (``NaN > 0`` is true, ``max`` returns NaN).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# date/time patterns tried, in order, when no format is given (Q8).
INFERRED_DATETIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> null for a double column."""
    c = _col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


# The accepted shape of a number in text - optional sign,
# digits with an optional point (or a leading point), optional exponent - and
# the words inf / infinity / nan in any case.
NUMBER_PATTERN = r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))$"


def to_double(c, source_type: T.DataType | None = None) -> Column:
    """Lenient text -> double (Q6): bad text, NaN and empty become null.

    Accepts surrounding blanks, exponents, a leading sign, ``.5``, ``5.`` and
    the words inf/infinity/nan; rejects thousands separators and the Java
    ``d``/``f`` suffixes. Text is matched against ``NUMBER_PATTERN`` before
    the cast, so garbage never reaches the (exception-raising) parser.
    """
    c = _col(c)
    if source_type is not None and isinstance(source_type, T.NumericType):
        return nan_to_null(c.cast("double"))
    s = F.trim(c.cast("string"))
    parsed = F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))
    return nan_to_null(parsed)


# Pattern letters -> a superset of the text they can match (digit runs; the
# parser still checks widths and ranges), for the pre-check of
# ``format_shape``; a pattern with any other letter gets no pre-check.
_SHAPE = {"yyyy": "[+-]?[0-9]+", "MM": "[0-9]+", "dd": "[0-9]+", "HH": "[0-9]+",
          "mm": "[0-9]+", "ss": "[0-9]+", "SSSSSS": "[0-9]+", "SSS": "[0-9]+"}


def format_shape(fmt: str) -> str | None:
    """A regex that every text parseable with ``fmt`` matches (digits and
    separators only), or None when the pattern has other letters. Used to
    reject garbage before the parser, which signals failure by exception."""
    out, i = "^", 0
    while i < len(fmt):
        if fmt[i] == "'":
            j = fmt.index("'", i + 1)
            out += "".join("\\" + ch if not ch.isalnum() else ch for ch in fmt[i + 1:j])
            i = j + 1
            continue
        for tok in sorted(_SHAPE, key=len, reverse=True):
            if fmt.startswith(tok, i):
                out += _SHAPE[tok]
                i += len(tok)
                break
        else:
            ch = fmt[i]
            if ch.isalpha():
                return None
            out += "\\" + ch
            i += 1
    return out + "$"


def _parse(s: Column, fmt: str) -> Column:
    shape = format_shape(fmt)
    parsed = F.try_to_timestamp(s, F.lit(fmt))
    return parsed if shape is None else F.when(s.rlike(shape), parsed)


def to_datetime_fixed(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> timestamp_ntz with one exact format, bad -> null (Q7)."""
    return _parse(_col(c).cast("string"), fmt).cast("timestamp_ntz")


def to_datetime_inferred(c, formats=INFERRED_DATETIME_FORMATS) -> Column:
    """Text -> timestamp_ntz trying each listed format, bad -> null (Q8)."""
    s = _col(c).cast("string")
    return F.coalesce(*[_parse(s, f) for f in formats]).cast("timestamp_ntz")


def to_datetime_strict(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> timestamp_ntz that fails the job on a bad value (Q9, ANSI on)."""
    return F.to_timestamp(_col(c).cast("string"), fmt).cast("timestamp_ntz")


def coerce_columns(df, numeric: list[str] = (), datetime: dict | None = None):
    """Apply Q6 to ``numeric`` columns and Q7/Q8 to ``datetime`` ({col: fmt|None})."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out = df
    for c in numeric:
        out = out.withColumn(c, to_double(c, types.get(c)))
    for c, fmt in (datetime or {}).items():
        if isinstance(types.get(c), (T.TimestampType, T.TimestampNTZType)):
            out = out.withColumn(c, F.col(c).cast("timestamp_ntz"))
        elif fmt:
            out = out.withColumn(c, to_datetime_fixed(c, fmt))
        else:
            out = out.withColumn(c, to_datetime_inferred(c))
    return out
