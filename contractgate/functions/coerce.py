"""Expressions that coerce raw values the way the contract rules need.

Every builder takes a Spark SQL expression (text) for a column plus the Spark
``DataType`` the column has in the scanned data, and returns Spark SQL
expression text. The rule compiler wraps the final predicate once with
``F.expr``: one parse per rule instead of one driver round-trip per operator,
which keeps plan construction cheap for wide contracts. All of it is plain
Catalyst (regex, ``try_cast``, ``CASE``), so it stays in whole-stage codegen and
never fails a job on a bad value: Spark 4 runs with ANSI on, so only ``try_*``
casts are used.

The same builders feed validation (counting what does not parse) and staging
(casting what does), which keeps the two in agreement by construction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values ------------------------------------------------------------
# Text accepted as a number: optional sign, digits with an optional fraction
# (either side of the point may be empty, not both), optional exponent; or a
# spelled infinity. Surrounding whitespace is allowed. Anything else (hex, "5d",
# "nan", thousands separators) does not parse.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITY_TEXT = r"(?i)^\s*[+-]?(inf|infinity)\s*$"
WHITE_SPACE = " \t\n\x0b\f\r"  # what \s matches
PLAIN_INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
# Tokens a boolean column may hold when validated, and the staging map.
BOOLEAN_TEXT_TOKENS = ["True", "False", "true", "false", "0", "1"]
STAGE_TRUE = ["true", "1"]
STAGE_FALSE = ["false", "0"]
# Date / time formats tried after the ISO-8601 cast, in this order.
DATETIME_FORMATS = [
    "yyyyMMdd",
    "yyyy/M/d",
    "yyyy/M/d H:m:s",
    "M/d/yyyy",
    "d/M/yyyy",
    "M/d/yyyy H:m:s",
    "yyyy.M.d",
    "d.M.yyyy",
    "MMM d yyyy",
    "MMM d, yyyy",
    "MMMM d yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
]
# ISO-8601: a date of four-digit year, alone or with a time of day. Anything
# shorter, longer or without a date (a bare time of day) is not cast.
ISO_DATE = r"^[0-9]{4}(-[0-9]{1,2}(-[0-9]{1,2}([T ].*)?)?)?$"
# A date and a time of day with a trailing UTC offset or "Z".
OFFSET_SUFFIX = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?\s*(Z|[+-][0-9]{2}(:?[0-9]{2})?)\s*$"
# -----------------------------------------------------------------------------

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_INF = "CAST('Infinity' AS DOUBLE)"


def lit(text: str) -> str:
    """A Spark SQL string literal (backslash and quote escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    """A quoted column reference."""
    return "`" + name.replace("`", "``") + "`"


def num_lit(value) -> str:
    return f"CAST({lit(repr(float(value)))} AS DOUBLE)"


def col(name: str) -> Column:
    return F.col(ident(name))


def is_integral(dt: T.DataType) -> bool:
    return isinstance(dt, _INTEGRAL)


def is_floating(dt: T.DataType) -> bool:
    return isinstance(dt, _FLOATING)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, (*_INTEGRAL, *_FLOATING, T.DecimalType))


def is_datetime(dt: T.DataType) -> bool:
    return isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType))


def is_missing(c: str, dt: T.DataType) -> str:
    """Null, or NaN for a floating column: what counts as "no value"."""
    if is_floating(dt):
        return f"({c} IS NULL OR isnan({c}))"
    return f"({c} IS NULL)"


def present(c: str, dt: T.DataType) -> str:
    return f"(NOT {is_missing(c, dt)})"


def _trimmed(c: str) -> str:
    return f"trim(BOTH {lit(WHITE_SPACE)} FROM {c})"


def number_from_text(c: str) -> str:
    """Parse text as a double; null when it does not parse.

    A bare ``try_cast`` is too loose (it takes ``5d``, ``nan``) and turns an
    overflow such as ``1e400`` into infinity; both count as unparseable here.
    """
    parsed = f"try_cast({_trimmed(c)} AS DOUBLE)"
    return (
        f"(CASE WHEN {c} RLIKE {lit(INFINITY_TEXT)} THEN {parsed} "
        f"WHEN {c} RLIKE {lit(NUMBER_TEXT)} AND abs({parsed}) != {_INF} THEN {parsed} END)"
    )


def to_number(c: str, dt: T.DataType) -> str:
    """Numeric view of a value (double), null when it is not a number.

    NaN becomes null so that it never compares above a maximum.
    """
    if is_numeric(dt):
        d = f"CAST({c} AS DOUBLE)"
        return f"(CASE WHEN NOT isnan({d}) THEN {d} END)"
    if isinstance(dt, T.BooleanType):
        return f"CAST({c} AS DOUBLE)"
    if isinstance(dt, T.StringType):
        return number_from_text(c)
    return number_from_text(f"CAST({c} AS STRING)")


def not_whole(d: str) -> str:
    """True for a number with a fraction; infinity counts as not whole."""
    return f"(({d}) % 1.0D != 0.0D)"


def _utc_wall_clock(ltz: str) -> str:
    """An instant rendered as a UTC wall-clock timestamp_ntz, whatever the
    session time zone is."""
    return f"convert_timezone(current_timezone(), 'UTC', CAST({ltz} AS TIMESTAMP_NTZ))"


def timestamp_from_text(c: str) -> str:
    """Parse text as a timestamp_ntz; null when it does not parse.

    ISO-8601 first (date, date-time, optional fraction). A value with a UTC
    offset is converted to UTC wall-clock time. Then a fixed ladder of common
    layouts. Clock-relative words ("now", a bare time of day) never parse.
    """
    core = _trimmed(c)
    with_offset = f"CASE WHEN {core} RLIKE {lit(OFFSET_SUFFIX)} THEN {_utc_wall_clock(f'try_cast({core} AS TIMESTAMP)')} END"
    ladder = [f"CAST(try_to_timestamp({core}, {lit(fmt)}) AS TIMESTAMP_NTZ)" for fmt in DATETIME_FORMATS]
    iso = f"CASE WHEN {core} RLIKE {lit(ISO_DATE)} THEN try_cast({core} AS TIMESTAMP_NTZ) END"
    return f"coalesce({with_offset}, {iso}, {', '.join(ladder)})"


def timestamp_from_number(c: str) -> str:
    """A number read as nanoseconds since the epoch (microseconds are kept);
    null outside the 64-bit range, and for NaN."""
    nanos = f"try_cast({c} AS DECIMAL(38, 9))"
    micros = f"CAST(floor({nanos} / 1000) AS BIGINT)"
    in_range = f"{nanos} BETWEEN -9223372036854775808 AND 9223372036854775807"
    return f"(CASE WHEN {in_range} THEN {_utc_wall_clock(f'timestamp_micros({micros})')} END)"


def to_timestamp(c: str, dt: T.DataType) -> str:
    if isinstance(dt, T.TimestampNTZType):
        return c
    if isinstance(dt, T.TimestampType):
        return _utc_wall_clock(c)
    if isinstance(dt, T.DateType):
        return f"CAST({c} AS TIMESTAMP_NTZ)"
    if is_numeric(dt):
        return timestamp_from_number(c)
    if isinstance(dt, T.StringType):
        return timestamp_from_text(c)
    return timestamp_from_text(f"CAST({c} AS STRING)")


def datetime_parses(c: str, dt: T.DataType) -> str:
    """True when a present value parses as a date/time."""
    if is_datetime(dt):  # already an instant
        return "true"
    return f"({to_timestamp(c, dt)} IS NOT NULL)"


def _in(c: str, values: list[str]) -> str:
    return f"({c} IN ({', '.join(lit(v) for v in values)}))"


def boolean_token_ok(c: str, dt: T.DataType) -> str:
    """True for a value the boolean type rule accepts."""
    if isinstance(dt, T.BooleanType):
        return "true"
    if is_numeric(dt):
        return f"(CAST({c} AS DOUBLE) IN (0.0D, 1.0D))"
    return _in(f"CAST({c} AS STRING)", BOOLEAN_TEXT_TOKENS)


def to_boolean(c: str, dt: T.DataType) -> str:
    """Staging map: true/false/1/0 after lower-casing, else null. Numeric 0/1
    stage to false/true."""
    if isinstance(dt, T.BooleanType):
        return c
    if is_numeric(dt):
        d = f"CAST({c} AS DOUBLE)"
        return f"(CASE WHEN {d} = 1.0D THEN true WHEN {d} = 0.0D THEN false END)"
    low = f"lower(CAST({c} AS STRING))"
    return f"(CASE WHEN {_in(low, STAGE_TRUE)} THEN true WHEN {_in(low, STAGE_FALSE)} THEN false END)"


def to_bigint_strict(c: str, dt: T.DataType, column_name: str) -> str:
    """Staging cast to a nullable bigint.

    Plain digits are parsed as bigint directly, keeping precision above 2**53.
    Other numbers must be whole; a fraction fails the job, as a lossy cast
    must never pass in silence.
    """
    if is_integral(dt):
        return f"CAST({c} AS BIGINT)"
    if isinstance(dt, T.StringType):
        exact = f"CASE WHEN {c} RLIKE {lit(PLAIN_INTEGER_TEXT)} THEN try_cast({_trimmed(c)} AS BIGINT) END"
    else:
        exact = "CAST(NULL AS BIGINT)"
    d = to_number(c, dt)
    message = lit(f"cannot cast non-whole value to integer in column {column_name}: ")
    fractional = f"CAST(raise_error(concat({message}, CAST({c} AS STRING))) AS BIGINT)"
    return (
        f"coalesce({exact}, CASE WHEN {d} IS NULL THEN CAST(NULL AS BIGINT) "
        f"WHEN {not_whole(d)} THEN {fractional} ELSE try_cast({d} AS BIGINT) END)"
    )


def python_text(c: str, dt: T.DataType) -> str:
    """Text rendering used by the allowed-set and pattern rules.

    Strings are used as they are. Booleans render as True/False and whole
    doubles keep a ".0", as the text form of the value would.
    """
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, T.BooleanType):
        return f"(CASE WHEN {c} THEN 'True' ELSE 'False' END)"
    if is_floating(dt):
        d = f"CAST({c} AS DOUBLE)"
        return (f"(CASE WHEN {d} % 1.0D = 0.0D AND abs({d}) < 1e16D THEN format_string('%.1f', {d}) "
                f"ELSE CAST({d} AS STRING) END)")
    return f"CAST({c} AS STRING)"
