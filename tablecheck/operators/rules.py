"""Row rules (Q01, Q06, Q10–Q18, Q22) as data: a predicate plus report metadata.

A ``Rule`` never touches a DataFrame by itself; the evaluator
(``tablecheck.operators.evaluate``) fuses any number of rules into one
projection over one scan.  Set-level rules (duplicates, lookups) first add a
boolean marker column and then become row rules on that marker.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablecheck import functions as tf

# ---------------------------------------------------------------------------
# Rule flags written to the report's ``check_passed`` column and
# the severities, as the reference names them.
# ---------------------------------------------------------------------------
FLAG_NULLS = "check_nulls"
FLAG_NULLS_WARNING = "check_nulls_warning"
FLAG_DUPLICATES = "check_duplicates"
FLAG_ISIN = "check_isin_value"
FLAG_NUMBER = "check_is_number"
FLAG_DATE = "check_is_date"
FLAG_CHARS = "check_funny_characters"
FLAG_PATTERN = "check_correct_pattern"
FLAG_DATE_RANGE = "check_date_range"
FLAG_DATE_PAIR = "check_date_pair"
FLAG_MASTER = "check_master_filters"
FLAG_ROW_DELETE = "check_row_to_delete"
CRITICAL = "CRITICAL"
WARNING = "WARNING"

# What a violation does to the row.
BLOCK = "block"      # row leaves the OK output and is reported
REPORT = "report"    # row is reported but stays in OK (warning / keep_in_successful_output)
DROP = "drop"        # row leaves OK silently (expect_or_drop); counted, not reported


@dataclass(frozen=True)
class Rule:
    flag: str                      # check_passed
    column: str                    # check_column_name
    bad: Column                    # True where the row violates the rule
    value: Column                  # report value (cast to string by the evaluator)
    error_type: str = CRITICAL
    action: str = BLOCK
    fixes: tuple = field(default_factory=tuple)   # ((column, Column -> Column), ...) applied to OK rows
    needs: tuple = field(default_factory=tuple)   # columns the rule reads
    marker: str | None = None      # helper column the rule reads; it leaves with the evaluation

    def with_action(self, action: str) -> "Rule":
        return replace(self, action=action)


def _sev(is_warning: bool) -> str:
    return WARNING if is_warning else CRITICAL


def null_check(column: str, is_warning: bool = False, dummy: str = "") -> Rule:
    """Q01. FAIL if null or ''.  Warning mode: rows stay in OK with the blank
    replaced by ``dummy``; the violations are still reported as WARNING."""
    bad = tf.is_blank(column)
    if is_warning:
        fix = ((column, lambda c: F.when(bad, F.lit(dummy)).otherwise(c.cast("string"))),)
        return Rule(FLAG_NULLS_WARNING, column, bad, F.col(column), WARNING, REPORT, fix, (column,))
    return Rule(FLAG_NULLS, column, bad, F.col(column), CRITICAL, BLOCK, (), (column,))


def isin_check(column: str, values: list, is_warning: bool = False,
               keep_in_successful_output: bool = False) -> Rule:
    """Q06/Q10. Allowed values from a literal list; null FAILs."""
    c = F.col(column)
    ok = c.isNotNull() & c.isin(list(values))
    action = REPORT if keep_in_successful_output else BLOCK
    return Rule(FLAG_ISIN, column, ~F.coalesce(ok, F.lit(False)), c, _sev(is_warning), action, (), (column,))


def marker_rule(flag: str, column: str, marker_col: str, value: Column | None = None,
                is_warning: bool = False, keep_in_successful_output: bool = False) -> Rule:
    """Row rule over a boolean marker added by a set-level step (lookup, dedup)."""
    action = REPORT if keep_in_successful_output else BLOCK
    bad = ~F.coalesce(F.col(marker_col), F.lit(False))
    return Rule(flag, column, bad, value if value is not None else F.col(column),
                _sev(is_warning), action, (), (marker_col,), marker_col)


def number_check(column: str, nullable: bool = True, allow_negative: bool = False) -> Rule:
    """Q11. Plain decimal text; blank passes only when nullable."""
    blank = tf.is_blank(column)
    good = tf.is_number_text(column, allow_negative)
    bad = ~blank & ~F.coalesce(good, F.lit(False))
    if not nullable:
        bad = blank | bad
    return Rule(FLAG_NUMBER, column, bad, F.col(column), CRITICAL, BLOCK, (), (column,))


def date_check(column: str, nullable: bool = True, fmt: str = tf.DATE_FORMAT_DEFAULT,
               regex: str | None = None) -> Rule:
    """Q12. Date text = shape regex AND parseable; blank passes only when nullable.

    The format and the shape regex are separate arguments (a format string is
    not a regex).  With the default format the default shape regex applies.
    """
    if regex is None and fmt == tf.DATE_FORMAT_DEFAULT:
        regex = tf.DATE_REGEX_DEFAULT
    blank = tf.is_blank(column)
    good = tf.is_date_text(column, fmt, regex)
    bad = ~blank & ~F.coalesce(good, F.lit(False))
    if not nullable:
        bad = blank | bad
    return Rule(FLAG_DATE, column, bad, F.col(column), CRITICAL, BLOCK, (), (column,))


def chars_check(column: str, chars: list[str] | None = None) -> Rule:
    """Q13. Forbidden characters; null passes."""
    bad = F.coalesce(tf.has_forbidden_chars(column, chars), F.lit(False))
    return Rule(FLAG_CHARS, column, bad, F.col(column), CRITICAL, BLOCK, (), (column,))


def pattern_check(column: str, pattern: str, mode: str = "match_correct",
                  remove_marker: bool = False) -> Rule:
    """Q14/Q15. ``match_correct``: a match is good; ``match_incorrect``: a match is bad.
    Null: FAIL in match_correct, OK in match_incorrect.  ``remove_marker`` replaces
    the match by group 1 in the OK output and in the reported value (once)."""
    if mode not in ("match_correct", "match_incorrect"):
        raise ValueError("mode must be 'match_correct' or 'match_incorrect'")
    hit = F.coalesce(tf.matches_pattern(column, pattern), F.lit(False))
    bad = ~hit if mode == "match_correct" else hit
    value = F.col(column)
    fixes = ()
    if remove_marker:
        def clean(c: Column) -> Column:
            return F.regexp_replace(c.cast("string"), F.lit(pattern), F.lit("$1"))
        value = clean(F.col(column))
        fixes = ((column, clean),)
    return Rule(FLAG_PATTERN, column, bad, value, CRITICAL, BLOCK, fixes, (column,))


def date_single_check(column: str, months: int = 36, fmt: str = tf.DATE_FORMAT_DEFAULT,
                      as_of: _dt.date | str | None = None) -> Rule:
    """Q16. Parsed date <= as_of + months (as_of defaults to current_date()).
    Unparseable or null fails."""
    base = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    d = tf.safe_date(column, fmt)
    good = d.isNotNull() & (d <= F.add_months(base, months))
    return Rule(FLAG_DATE_RANGE, column, ~F.coalesce(good, F.lit(False)), F.col(column),
                CRITICAL, BLOCK, (), (column,))


def date_pair_check(start_col: str, end_col: str, fmt: str = tf.DATE_FORMAT_DEFAULT) -> Rule:
    """Q17. start <= end, both parseable; value shown as 'start | end'."""
    s, e = tf.safe_date(start_col, fmt), tf.safe_date(end_col, fmt)
    good = s.isNotNull() & e.isNotNull() & (s <= e)
    value = F.concat_ws(tf.PAIR_VALUE_SEP, F.col(start_col).cast("string"), F.col(end_col).cast("string"))
    return Rule(FLAG_DATE_PAIR, f"{start_col} <= {end_col}", ~F.coalesce(good, F.lit(False)), value,
                CRITICAL, BLOCK, (), (start_col, end_col))


def row_to_delete_rule(dtypes: list[tuple[str, str]], marker: str = tf.ROW_TO_DELETE_MARKER) -> Rule:
    """Q22 as a rule: any string cell equals the marker."""
    return Rule(FLAG_ROW_DELETE, "*", tf.any_cell_equals(dtypes, marker), F.lit(marker),
                CRITICAL, BLOCK, (), tuple(n for n, _ in dtypes))


def expectation(name: str, condition: Column | str, action: str = REPORT) -> Rule:
    """Q28/T13. A named expectation: ``condition`` must hold (null counts as not holding).
    action REPORT = warn, DROP = drop silently, BLOCK = fail into the report."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return Rule(name, name, ~F.coalesce(cond, F.lit(False)), F.lit(None).cast("string"),
                WARNING if action == REPORT else CRITICAL, action)
