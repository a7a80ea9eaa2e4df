"""Row-level change patterns without a row-level table format.

``MERGE INTO`` needs a V2 table with row-level operations; on plain Parquet
every pattern here is a keyed join producing the *new* table state, which the
caller publishes as a new version (``sources.versions.VersionedTable``).

All joins are on the business keys (hash-partitioned shuffles; AQE handles
skew).  "Latest change per key" is an aggregation (max of a struct), which is
partially aggregated per map task — a key with a huge change history does not
land whole in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# CDC operation codes.
OP_INSERT = "I"
OP_UPDATE = "U"
OP_DELETE = "D"


def assert_unique_keys(df: DataFrame, keys: list[str], what: str = "source") -> None:
    """MERGE semantics: a target row may match at most one source row."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    if not dup.isEmpty():
        raise ValueError(f"{what} has duplicate keys {keys}; merge would be ambiguous")


def upsert(target: DataFrame, staging: DataFrame, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """Delete matching keys from the target, insert the staging rows.  A key that repeats in
    the staging rows is an error, or with ``order_cols`` its newest row wins."""
    if order_cols:
        staging = latest_per_key(staging, keys, order_cols)
    else:
        assert_unique_keys(staging, keys, "staging")
    return target.join(staging.select(*keys).distinct(), keys, "left_anti") \
        .unionByName(staging.select(*target.columns))


def merge(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str] | None = None,
          insert: bool = True, delete_missing: bool = False, check_unique: bool = True) -> DataFrame:
    """New table state after MERGE.

    * matched           -> ``update_cols`` from source (all non-key columns by default), rest from target;
    * source only       -> inserted when ``insert``;
    * target only       -> deleted when ``delete_missing`` (WHEN NOT MATCHED BY SOURCE DELETE), else kept.
    """
    if check_unique:
        assert_unique_keys(source, keys)
    cols = target.columns
    non_key = [c for c in cols if c not in keys]
    upd = set(non_key if update_cols is None else update_cols)
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in cols], F.lit(True).alias("__t"))
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("__s"))
    cond = reduce(lambda x, y: x & y, [F.col(f"t__{k}") == F.col(f"s__{k}") for k in keys])
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    keep = (in_t & in_s) | (in_t & ~in_s & F.lit(not delete_missing)) | (~in_t & in_s & F.lit(insert))
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(F.col(f"t__{c}"), F.col(f"s__{c}")).alias(c))
        elif c in upd:
            out.append(F.when(in_s, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c))
        else:
            out.append(F.when(in_t, F.col(f"t__{c}")).otherwise(F.col(f"s__{c}")).alias(c))
    return j.filter(keep).select(*out)


def latest_per_key(changes: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The newest change per key by ``order_cols`` (e.g. timestamp, sequence),
    as an aggregation: max(struct(order..., row...)) per key."""
    payload = [c for c in changes.columns]
    best = changes.groupBy(*keys).agg(
        F.max(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_cols)],
                       F.struct(*payload).alias("__row"))).alias("__b"))
    return best.select("__b.__row.*")


def flatten_cdc(records: DataFrame, key: str, meta_col: str = "metadata", before: str = "before-image",
                after: str = "after-image") -> DataFrame:
    """C11 records (metadata{operation,timestamp}, before-image, after-image) ->
    flat rows: op, change_ts, and the after image (before image for deletes)."""
    image = F.when(F.col(f"`{meta_col}`.operation") == OP_DELETE, F.col(f"`{before}`")).otherwise(F.col(f"`{after}`"))
    return records.select(F.col(f"`{meta_col}`.operation").alias("op"),
                          F.col(f"`{meta_col}`.timestamp").alias("change_ts"), image.alias("__img")) \
        .select("op", "change_ts", "__img.*")


def cdc_apply(target: DataFrame, changes: DataFrame, keys: list[str], op_col: str = "op",
              order_cols: list[str] | None = None) -> DataFrame:
    """Apply a change feed: latest change per key; D deletes, I/U upsert
    (full row image)."""
    latest = latest_per_key(changes, keys, order_cols or ["change_ts"])
    survivors = target.join(latest.select(*keys), keys, "left_anti")
    upserts = latest.filter(F.col(op_col) != OP_DELETE).select(*target.columns)
    return survivors.unionByName(upserts)


def row_hash(cols: list[str]) -> Column:
    """Change-detection hash: SHA-256 of the JSON of the tracked columns
    (null-safe and unambiguous, unlike concatenation)."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}), 256)


def scd2(dim: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str], load_ts,
         close_missing: bool = False) -> DataFrame:
    """M05 type 2. A key may occur once in ``snapshot``.  ``dim`` has keys + tracked + effective_from, effective_to,
    is_current.  Changed keys: the current row is closed at ``load_ts`` and a
    new current row opens; new keys open a row; unchanged rows stay."""
    assert_unique_keys(snapshot, keys, "snapshot")
    ts = F.lit(load_ts).cast(dim.schema["effective_from"].dataType)
    hist = dim.filter(~F.col("is_current"))
    cur = dim.filter(F.col("is_current")).withColumn("__h", row_hash(tracked))
    inc = snapshot.select(*keys, *tracked).withColumn("__h", row_hash(tracked))
    c = cur.select(*[F.col(x).alias(f"c__{x}") for x in cur.columns])
    i = inc.select(*[F.col(x).alias(f"i__{x}") for x in inc.columns])
    j = c.join(i, reduce(lambda a, b: a & b, [F.col(f"c__{k}") == F.col(f"i__{k}") for k in keys]), "full_outer")
    in_c, in_i = F.col("c____h").isNotNull(), F.col("i____h").isNotNull()
    changed = in_c & in_i & (F.col("c____h") != F.col("i____h"))
    dim_cols = keys + tracked
    # 1) existing current rows: kept, or closed when changed (or missing and close_missing)
    close = changed | (in_c & ~in_i & F.lit(close_missing))
    old = j.filter(in_c).select(*[F.col(f"c__{x}").alias(x) for x in dim_cols],
                                F.col("c__effective_from").alias("effective_from"),
                                F.when(close, ts).otherwise(F.col("c__effective_to")).alias("effective_to"),
                                (~close).alias("is_current"))
    # 2) new current rows for changed and new keys
    opened = j.filter(changed | (~in_c & in_i)).select(
        *[F.col(f"i__{x}").alias(x) for x in dim_cols], ts.alias("effective_from"),
        F.lit(None).cast(dim.schema["effective_to"].dataType).alias("effective_to"), F.lit(True).alias("is_current"))
    cols = dim_cols + ["effective_from", "effective_to", "is_current"]
    return hist.select(*cols).unionByName(old.select(*cols)).unionByName(opened.select(*cols))


def scd3(dim: DataFrame, updates: DataFrame, keys: list[str], column: str, previous_column: str) -> DataFrame:
    """M05 type 3: keep the previous value in ``previous_column`` when ``column`` changes."""
    u = updates.select(*keys, F.col(column).alias("__new"))
    j = dim.join(u, keys, "left")
    changed = F.col("__new").isNotNull() & ~F.col(column).eqNullSafe(F.col("__new"))
    out = j.withColumn(previous_column, F.when(changed, F.col(column)).otherwise(F.col(previous_column))) \
        .withColumn(column, F.when(changed, F.col("__new")).otherwise(F.col(column)))
    return out.select(*dim.columns)


def lambda_view(batch: DataFrame, speed: DataFrame, ts_col: str, cut) -> DataFrame:
    """Serving view = batch layer up to ``cut`` ∪ speed layer after it."""
    c = F.lit(cut).cast(batch.schema[ts_col].dataType)
    return batch.filter(F.col(ts_col) <= c).unionByName(speed.filter(F.col(ts_col) > c),
                                                        allowMissingColumns=True)
