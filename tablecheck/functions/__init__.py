"""Column factories: the row predicates and scalar helpers the operators share.

Everything here returns a ``pyspark.sql.Column`` built from Spark built-ins,
so it stays inside whole-stage codegen.  No Python runs per row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour (kept together, as text).
# ---------------------------------------------------------------------------
# plain decimal number, optional leading minus; accepts "1." and ".5"
NUMBER_REGEX_SIGNED = r"^-?(\d+(\.\d*)?|\.\d+)$"
NUMBER_REGEX_UNSIGNED = r"^(\d+(\.\d*)?|\.\d+)$"
# default date text: four-digit year not starting with 0, dot separated
DATE_REGEX_DEFAULT = r"^[1-9]\d{3}\.\d{2}\.\d{2}$"
DATE_FORMAT_DEFAULT = "yyyy.MM.dd"
# characters that may not appear in a checked text column: ^ ; , |
FORBIDDEN_CHARS = ["^", ";", ",", "|"]
FORBIDDEN_CHARS_REGEX = r"[\^;,|]"
# a cell equal to this marks the row for deletion
ROW_TO_DELETE_MARKER = "row_to_delete"
# separators used in report values
PAIR_VALUE_SEP = " | "
COMPOSITE_VALUE_SEP = " / "


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(df, name: str) -> Column:
    """Microseconds of a timestamp column since 1970.  A TIMESTAMP_NTZ is taken apart into its
    date and time of day, so the session's time zone (and its missing or repeated hours)
    never moves it."""
    c = F.col(name)
    if df.schema[name].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp"))
    day = F.unix_date(c.cast("date")).cast("long")
    seconds = (day * 24 + F.hour(c)) * 3600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def is_blank(c) -> Column:
    """Null or the empty string (a value of any type is compared as text)."""
    c = col_of(c)
    return c.isNull() | (c.cast("string") == F.lit(""))


def is_number_text(c, allow_negative: bool = False) -> Column:
    """Text is a plain decimal number (no exponent, no grouping, no spaces)."""
    regex = NUMBER_REGEX_SIGNED if allow_negative else NUMBER_REGEX_UNSIGNED
    return col_of(c).cast("string").rlike(regex)


def safe_date(c, fmt: str = DATE_FORMAT_DEFAULT) -> Column:
    """Parse text to DATE; unparseable text gives null (never throws under ANSI)."""
    return F.try_to_date(col_of(c).cast("string"), fmt)


def is_date_text(c, fmt: str = DATE_FORMAT_DEFAULT, regex: str | None = DATE_REGEX_DEFAULT) -> Column:
    """Text matches the date shape (if a regex is given) and parses with ``fmt``."""
    s = col_of(c).cast("string")
    parsed_ok = safe_date(s, fmt).isNotNull()
    if regex:
        return s.rlike(regex) & parsed_ok
    return parsed_ok


def has_forbidden_chars(c, chars: list[str] | None = None) -> Column:
    if chars is None:
        regex = FORBIDDEN_CHARS_REGEX
    else:
        regex = "[" + "".join("\\" + ch for ch in chars) + "]"
    return col_of(c).cast("string").rlike(regex)


def matches_pattern(c, pattern: str) -> Column:
    """True where the regex is found anywhere in the value (null stays null)."""
    return F.regexp_instr(col_of(c).cast("string"), F.lit(pattern)) > 0


def any_cell_equals(df_columns: list[tuple[str, str]], marker: str = ROW_TO_DELETE_MARKER) -> Column:
    """True if any *string* column equals ``marker``.

    Non-string columns can never equal a text marker, so they are skipped
    instead of cast (a cast of every column would defeat pruning and ANSI
    would throw on ``int == 'text'``).
    """
    tests = [F.col(name) == F.lit(marker) for name, dtype in df_columns if dtype == "string"]
    if not tests:
        return F.lit(False)
    return F.coalesce(reduce(or_, tests), F.lit(False))


def pct_change(cur, prev, scale: int = 2) -> Column:
    """Percent change, null when the previous value is 0 or null (ANSI-safe)."""
    return F.round(F.try_divide((col_of(cur) - col_of(prev)) * F.lit(100.0), col_of(prev)), scale)


def deterministic_salt(key_cols: list, n: int) -> Column:
    """A salt in [0, n) that is a pure function of the row's columns.

    ``rand()`` salts give different assignments when a task is retried;
    hashing keeps recomputation (executor loss) consistent.
    """
    return F.pmod(F.xxhash64(*[col_of(c) for c in key_cols]), F.lit(n)).cast("int")


def morton_key(cols: list, bits: int = 16) -> Column:
    """Z-order key: interleave the low ``bits`` bits of each integer column.

    Built from shiftleft / bitwise ops only, so it is a codegen expression.
    """
    k = len(cols)
    if k * bits > 63:
        raise ValueError("too many bits for a 63-bit Morton key")
    parts = []
    for i, c in enumerate(cols):
        v = col_of(c).cast("long")
        for b in range(bits):
            bit = F.shiftright(v, b).bitwiseAND(F.lit(1))
            parts.append(F.shiftleft(bit, b * k + i))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def sha256_masked(c, salt: str = "") -> Column:
    """SHA-256 hex of salt || value (null stays null)."""
    return F.sha2(F.concat(F.lit(salt), col_of(c).cast("string")), 256)


def summand(value: Column, scale: int | None = None) -> Column:
    """What a sum adds up: the value in its own type (a double stays a double, a decimal is exact), or, where the
    caller names a ``scale``, the value as a decimal with so many places, which makes the sum exact and
    independent of the order of rows."""
    return value if scale is None else value.cast(f"decimal(38,{scale})")
