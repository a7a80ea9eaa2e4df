"""Governance as data jobs.

Masking, role views and row filters are projections/filters (codegen, no
shuffle); the PII scan and column statistics are single wide aggregates
unpivoted with ``stack``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.functions import sha256_masked

# PII patterns for the column scan (Java-regex and RE2 compatible).
PII_PATTERNS = {
    # one local-part character is enough to decide "contains an e-mail address"
    # (same rows as a "+" local part, without quadratic backtracking)
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
    "ipv4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "card_number": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "secret_assignment": r"(?i)(api[_-]?key|secret|password|token)[ ]*[:=]",
}
# Necessary conditions of the patterns above (a match cannot exist without
# them): literal characters of which one must occur, and whether a digit must.
# Checked first with a byte search, so the regex runs only on candidate texts.
PII_HINTS = {
    "email": (["@"], False),
    "phone": ([], True),
    "ipv4": (["."], True),
    "card_number": ([], True),
    "secret_assignment": ([":", "="], False),
}


def mask_columns(df: DataFrame, columns: list[str], salt: str = "", drop: list[str] | None = None) -> DataFrame:
    """Replace PII columns by SHA-256(salt || value); optionally drop
    columns that must not reach the gold layer."""
    out = df.select(*[sha256_masked(c, salt).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])
    return out.drop(*(drop or []))


def role_view(df: DataFrame, role: str, grants: dict[str, list[str]], view_name: str | None = None) -> DataFrame:
    """The columns a role may see (a projection; unknown role -> error)."""
    if role not in grants:
        raise PermissionError(f"role {role!r} has no grant")
    out = df.select(*[F.col(f"`{c}`") for c in grants[role]])
    if view_name:
        out.createOrReplaceTempView(view_name)
    return out


def masked_view(df: DataFrame, role: str, unmasked_roles: set[str], masked: list[str],
                row_filter: Column | str | None = None, filtered_roles: set[str] | None = None) -> DataFrame:
    """Column masks (``mask``: letters -> X/x, digits -> n) for roles not in
    ``unmasked_roles``, and a row filter for roles in ``filtered_roles``."""
    out = df
    if role not in unmasked_roles:
        out = out.select(*[F.mask(F.col(c).cast("string")).alias(c) if c in masked else F.col(f"`{c}`")
                           for c in out.columns])
    if row_filter is not None and (filtered_roles is None or role in filtered_roles):
        out = out.filter(F.expr(row_filter) if isinstance(row_filter, str) else row_filter)
    return out


def pii_scan(df: DataFrame, columns: list[str] | None = None, patterns: dict[str, str] | None = None) -> DataFrame:
    """Per (column, pattern): rows matching and hit rate — one scan,
    one aggregate, whole values (never a prefix)."""
    hints = PII_HINTS if patterns is None else {}
    patterns = patterns or PII_PATTERNS
    columns = columns or [n for n, t in df.dtypes if t == "string"]
    aggs, labels = [F.count(F.lit(1)).alias("__n")], []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`")
        has_digit = x.rlike("[0-9]")
        for j, (name, rx) in enumerate(patterns.items()):
            hit = x.rlike(rx)
            if name in hints:
                lits, digit = hints[name]
                pre = F.lit(True)
                if lits:
                    pre = pre & reduce(lambda a, b: a | b, [F.instr(x, ch) > 0 for ch in lits])
                if digit:
                    pre = pre & has_digit
                hit = F.when(pre, hit).otherwise(F.lit(False))
            aggs.append(F.sum(F.coalesce(hit, F.lit(False)).cast("long")).alias(f"h{i}_{j}"))
            labels.append((c, name, f"h{i}_{j}"))
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', '{p}', {h}" for c, p, h in labels)
    return wide.selectExpr(f"stack({len(labels)}, {parts}) AS (column_name, pattern, n_hits)", "__n") \
        .select("column_name", "pattern", "n_hits", F.round(F.col("n_hits") / F.col("__n"), 6).alias("hit_rate"))


def luhn_valid(value: Column) -> Column:
    """Whether a text of 12 to 19 digits (spaces and dashes aside) has a valid Luhn check digit."""
    digits = F.regexp_replace(value, "[ -]", "")
    each = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)), lambda x, i: x.cast("int") * (1 + i % 2))
    total = F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return F.when(digits.rlike("^[0-9]{12,19}$"), total % 10 == 0).otherwise(F.lit(False))


def mod97_valid(value: Column) -> Column:
    """Whether a text is an account number of two letters, two check digits and 11 to 30 letters or digits whose
    rest modulo 97 is 1."""
    text = F.upper(F.regexp_replace(value, " ", ""))
    turned = F.concat(F.substring(text, 5, 40), F.substring(text, 1, 4))
    codes = F.transform(F.regexp_extract_all(turned, F.lit("[0-9A-Z]"), F.lit(0)), lambda x: F.when(x.rlike("[0-9]"), F.ascii(x) - 48).otherwise(F.ascii(x) - 55))
    rest = F.aggregate(codes, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97)
    return F.when(text.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), rest == 1).otherwise(F.lit(False))


#: Column classes in order of preference: name, kind, and what makes a whole value one.
COLUMN_CLASSES: list[tuple[str, str, Callable[[Column], Column]]] = [
    ("email", "PII", lambda v: v.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$")),
    ("iban", "financial", mod97_valid),
    ("card_number", "financial", luhn_valid),
    ("ssn", "PII", lambda v: v.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")),
    ("phone", "PII", lambda v: v.rlike(r"^\+?[0-9][0-9 ().-]{5,18}[0-9]$") & (F.length(F.regexp_replace(v, "[^0-9]", "")).between(7, 15))),
    ("ip_address", "PII", lambda v: v.rlike(r"^((25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.|$)){4}$")),
]


def classify_columns(df: DataFrame, columns: list[str] | None = None, least_share: float = 0.8,
                     classes: list[tuple[str, str, Callable[[Column], Column]]] | None = None) -> DataFrame:
    """One row for each column: ``(column_name, n_values, class, kind, share)``.

    The class is that with the largest share of the column's non-blank values (ties: the earlier one), if it has at
    least ``least_share`` of them; otherwise class and kind are null and ``share`` is the best one's.  Check digits decide
    between numbers that look alike.  Custom classifiers are further ``(name, kind, test)``.  One scan and one aggregate over all
    rows; columns other than strings are tested as text."""
    classes = classes if classes is not None else COLUMN_CLASSES
    columns = columns or [n for n, t in df.dtypes if t == "string"]
    aggs = []
    for i, c in enumerate(columns):
        v = F.trim(F.col(f"`{c}`").cast("string"))
        full = v.isNotNull() & (v != "")
        aggs.append(F.count(F.when(full, 1)).alias(f"n{i}"))
        aggs += [F.count(F.when(full & test(v), 1)).alias(f"h{i}_{j}") for j, (_, _, test) in enumerate(classes)]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_values"), F.array(*[
        F.struct(F.col(f"h{i}_{j}").alias("hits"), F.lit(-j).alias("order"), F.lit(name).alias("class"), F.lit(kind).alias("kind"))
        for j, (name, kind, _) in enumerate(classes)]).alias("found")) for i, c in enumerate(columns)]
    each = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.column_name", "r.n_values", F.array_max("r.found").alias("best"))
    share = F.coalesce(F.try_divide(F.col("best.hits"), F.col("n_values")), F.lit(0.0))
    sure = (share >= least_share) & (F.col("n_values") > 0)
    return each.select("column_name", "n_values", F.when(sure, F.col("best.class")).alias("class"), F.when(sure, F.col("best.kind")).alias("kind"), F.round(share, 6).alias("share"))


def add_lineage(df: DataFrame, pipeline: str, run_id: str, processed_at: _dt.datetime | None = None,
                with_file: bool = True) -> DataFrame:
    """Lineage columns per row: source file (from the scan's hidden
    ``_metadata``), pipeline, run id, processing time."""
    out = df
    if with_file:
        out = out.withColumn("_source_file", F.col("_metadata.file_path"))
    ts = F.lit(processed_at).cast("timestamp") if processed_at else F.current_timestamp()
    return out.withColumn("_pipeline", F.lit(pipeline)).withColumn("_run_id", F.lit(run_id)) \
        .withColumn("_processed_at", ts)


def column_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: non-null count, null count, distinct count, min, max
    (as text) — what ``ANALYZE TABLE ... FOR COLUMNS`` collects.

    One narrow aggregate per column: rows are first counted per value (combined on the map side), and the
    statistics are read off those counts.  The scan reads that column only, and
    no row is copied once per column as several distinct counts in one aggregate would."""
    parts = []
    for c in columns or df.columns:
        values = df.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        known = F.col("v").isNotNull()
        total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
        parts.append(values.agg(total(known).alias("n_non_null"), total(~known).alias("n_null"),
                                F.count("v").alias("n_distinct"), F.min("v").cast("string").alias("min_value"),
                                F.max("v").cast("string").alias("max_value"))
                     .select(F.lit(c).alias("column_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def analyze_table(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """Column statistics in the catalog, where the planner reads them (``spark.sql.cbo.enabled``), and as rows:
    ``(column_name, n_rows, n_null, n_distinct, min_value, max_value)``.  Distinct counts are the catalog's estimates."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}")
    total = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").select(F.regexp_extract("data_type", "([0-9]+) rows", 1).cast("long").alias("n_rows"))
    parts = []
    for c in columns:
        rows = spark.sql(f"DESCRIBE EXTENDED {name} `{c}`").select("info_name", "info_value")
        pick = lambda n: F.max(F.when(F.col("info_name") == n, F.col("info_value")))
        parts.append(rows.agg(pick("num_nulls").cast("long").alias("n_null"), pick("distinct_count").cast("long").alias("n_distinct"), pick("min").alias("min_value"), pick("max").alias("max_value")).select(F.lit(c).alias("column_name"), "*"))
    return reduce(DataFrame.unionByName, parts).select("column_name", total.scalar().alias("n_rows"), "n_null", "n_distinct", "min_value", "max_value")
