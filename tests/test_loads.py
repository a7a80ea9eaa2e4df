"""Landing on padded months (S01, S18, M12), incremental loads (M06, S22), modified files (M07), widened files (M11),
versions: log, retention and schema change (M09, G03, M11), column classes (G10), catalog statistics (G04), split skew joins (J07),
master filters by markers (Q20) and dotted key names (Q02)."""
import datetime as dt
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from tablecheck.operators import govern as G
from tablecheck.operators import patterns as P
from tablecheck.operators.dedup import check_duplicates, dedup_keep, duplicate_keys
from tablecheck.operators.evaluate import CheckContext
from tablecheck.operators.lookup import master_filters
from tablecheck.sources import ingest as I
from tablecheck.sources.readers import read_month_range
from tablecheck.sources.versions import VersionedTable


def _months(spark, months, n=5):
    return spark.range(n * len(months)).selectExpr("id", "2024 AS year", f"element_at(array({','.join(map(str, months))}), cast(id % {len(months)} AS int) + 1) AS month")


@pytest.mark.parametrize("padded", [True, False])
def test_padded_and_plain_months_are_read_and_replaced(spark, tmp_dir, padded):
    root = os.path.join(tmp_dir, "landed")
    for m in (1, 2, 11):
        name = f"{m:02d}" if padded else m
        spark.range(5).write.parquet(f"{root}/year=2024/month={name}")
    back = read_month_range(spark, root, [(2024, 1), (2024, 2), (2024, 3), (2024, 11)])
    assert sorted(r["month"] for r in back.collect()) == [1] * 5 + [2] * 5 + [11] * 5
    I.land(_months(spark, [1, 2]), root, months=[(2024, 1), (2024, 2), (2024, 11)])  # November has no rows any more
    assert sorted(r["month"] for r in spark.read.parquet(root).collect()) == [1] * 5 + [2] * 5
    assert {d for d in os.listdir(f"{root}/year=2024") if d.startswith("month")} == ({"month=01", "month=02", "month=11"} if padded else {"month=1", "month=2", "month=11"})


def test_a_month_in_two_folders_is_an_error(spark, tmp_dir):
    root = os.path.join(tmp_dir, "landed")
    for name in ("1", "01"):
        spark.range(5).write.parquet(f"{root}/year=2024/month={name}")
    with pytest.raises(ValueError, match="twice"):
        read_month_range(spark, root, [(2024, 1)])
    with pytest.raises(ValueError, match="twice"):
        I.land(_months(spark, [1]), root)


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["before_write", "after_write", "after_commit"])
def test_a_load_that_crashes_neither_loses_nor_repeats_rows(spark, tmp_dir, monkeypatch, step):
    """Rows keep arriving; the second of four loads crashes at one of its steps."""
    source = spark.range(100).selectExpr("id", "timestamp_seconds(1700000000 + id * 10) AS updated_at")
    load = I.IncrementalLoad(spark, os.path.join(tmp_dir, "t"), "updated_at")
    assert load.load(source.filter("id < 20")) == 0
    real = I.create_file
    if step == "before_write":
        monkeypatch.setattr(I, "incremental_since", lambda *a: (_ for _ in ()).throw(Crash()))
    elif step == "after_write":
        monkeypatch.setattr(I, "create_file", lambda *a: (_ for _ in ()).throw(Crash()))
    else:
        monkeypatch.setattr(I, "create_file", lambda *a: (real(*a), (_ for _ in ()).throw(Crash())))
    with pytest.raises(Crash):
        load.load(source.filter("id < 50"))
    monkeypatch.undo()
    assert load.read().count() == (50 if step == "after_commit" else 20)
    assert load.load(source.filter("id < 70")) == (2 if step == "after_commit" else 1)
    assert load.load(source.filter("id < 70")) is None
    load.load(source, lag="100 SECONDS")
    assert sorted(r["id"] for r in load.read().collect()) == list(range(90))
    rows = load.control().orderBy("batch").collect()
    assert [r["low"] for r in rows[1:]] == [r["high"] for r in rows[:-1]] and rows[0]["low"] is None


def test_of_two_loads_at_once_one_fails(spark, tmp_dir):
    path = os.path.join(tmp_dir, "c", "x.json")
    done = []

    def write(i):
        try:
            I.create_file(spark, path, str(i))
            done.append(i)
        except FileExistsError:
            pass
    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(done) == 1 and open(path).read() == str(done[0])


def test_one_log_row_for_a_version_of_several_writers(spark, tmp_dir):
    vt = VersionedTable(spark, os.path.join(tmp_dir, "vt"))
    errors = []

    def write(i):
        try:
            vt.publish(spark.range(i + 1), version=0)
        except FileExistsError as e:
            errors.append(e)
    threads = [threading.Thread(target=write, args=(i,)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    log = vt.history().collect()
    assert len(log) == 1 and len(errors) == 2 and vt.read().count() == log[0]["row_count"]


def test_retention_keeps_the_newest_and_what_is_young(spark, tmp_dir):
    vt = VersionedTable(spark, os.path.join(tmp_dir, "vt"))
    for n in (1, 2, 3):
        vt.publish(spark.range(n))
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert vt.expire(now - dt.timedelta(hours=168)) == []
    assert vt.expire(now + dt.timedelta(hours=1), keep_last=2) == [0]
    assert vt.read(1).count() == 2 and vt.read().count() == 3
    with pytest.raises(ValueError, match="no published version"):
        vt.read(0)
    assert vt.expire(now + dt.timedelta(hours=1)) == [1] and len(os.listdir(f"{vt.root}/data")) == 1
    assert vt.expire(now + dt.timedelta(hours=1), keep_last=0) == [] and vt.read().count() == 3


def test_a_version_may_change_the_schema(spark, tmp_dir):
    vt = VersionedTable(spark, os.path.join(tmp_dir, "vt"))
    vt.publish(spark.createDataFrame([(1, 2)], "a int, b int"))
    vt.publish(spark.createDataFrame([("x", 1.5, True)], "a string, c double, d boolean"))
    assert vt.read(0).columns == ["a", "b"] and vt.read().dtypes == [("a", "string"), ("c", "double"), ("d", "boolean")]


def test_modified_files_of_equal_times_are_neither_lost_nor_repeated(spark, tmp_dir):
    root = os.path.join(tmp_dir, "in")
    spark.range(80).repartition(8).write.parquet(root)
    files = sorted(os.path.join(root, f) for f in os.listdir(root) if f.endswith(".parquet"))
    for i, f in enumerate(files):
        os.utime(f, (1_700_000_000 + i // 4 * 100, 1_700_000_000 + i // 4 * 100))
    empty = spark.createDataFrame([], I.LEDGER_SCHEMA)
    every = I.files_modified_since(spark, root, empty)
    assert every.count() == 8
    half = every.filter(F.col("path").rlike("|".join(os.path.basename(f) for f in files[:2] + files[4:6])))
    ledger = spark.createDataFrame(I.ledger_rows(half, "run-1").collect(), I.LEDGER_SCHEMA)
    seen = {os.path.basename(r["path"]) for r in I.files_modified_since(spark, root, ledger).collect()}
    assert seen == {os.path.basename(f) for f in files[6:]}  # as young as the newest one, not in the ledger
    seen = {os.path.basename(r["path"]) for r in I.files_modified_since(spark, root, ledger, 100).collect()}
    assert seen == {os.path.basename(f) for f in files[2:4] + files[6:]}
    os.utime(files[4], (1_700_000_500, 1_700_000_500))  # written again
    assert os.path.basename(files[4]) in {os.path.basename(r["path"]) for r in I.files_modified_since(spark, root, ledger).collect()}


def test_files_of_widened_columns_are_read_without_loss(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    for i, sql in enumerate(["cast(7 AS int) AS a, cast(1.5 AS float) AS b, 'x' AS c", "9007199254740993 AS a, 2 AS b", "'n/a' AS a, 2.25D AS b, 'y' AS c, date'2024-01-02' AS d"]):
        spark.sql(f"SELECT {sql}").write.parquet(f"{root}/part{i}")
    back = I.read_widened(spark, root)
    assert dict(back.dtypes) == {"a": "string", "b": "double", "c": "string", "d": "date"}
    assert sorted(tuple(r) for r in back.select("a", "b", "c").fillna("").collect()) == [("7", 1.5, "x"), ("9007199254740993", 2.0, ""), ("n/a", 2.25, "y")]
    assert I.wider_type("int", "bigint") == "bigint" and I.wider_type("bigint", "double") == "string" and I.wider_type("smallint", "float") == "double"


def _luhn(text):
    total = sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(text)))
    return total % 10 == 0


def test_check_digits(spark):
    rng = random.Random(4)
    cards = ["4111111111111111", "4111 1111 1111 1111", "4111111111111112", "79927398713", "5500-0000-0000-0004", "", "abc", None] + ["".join(rng.choices("0123456789", k=16)) for _ in range(300)]
    got = [r["ok"] for r in spark.createDataFrame([(i, c) for i, c in enumerate(cards)], "i int, c string").orderBy("i").select(G.luhn_valid(F.col("c")).alias("ok")).collect()]
    want = [c is not None and 12 <= len(d) <= 19 and d.isdigit() and _luhn(d) for c in cards for d in [(c or "").replace(" ", "").replace("-", "")]]
    assert got == want and sum(want) > 10
    ibans = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "GB82WEST12345698765433", "DE88370400440532013000", "XX00", None, "fr1420041010050500013m02606"]
    got = [r["ok"] for r in spark.createDataFrame([(i, c) for i, c in enumerate(ibans)], "i int, c string").orderBy("i").select(G.mod97_valid(F.col("c")).alias("ok")).collect()]
    assert got == [True, True, True, False, False, False, False, True]


def test_columns_get_a_class(spark):
    rng = random.Random(5)
    cards = []
    while len(cards) < 50:
        c = "".join(rng.choices("0123456789", k=16))
        cards += [c] if _luhn(c) else []
    rows = [(f"u{i}@mail.example.org", cards[i], "".join(rng.choices("0123456789", k=16)), f"+1 (555) 010-{i:04d}", f"10.0.{i}.1", f"{100 + i}-12-{3000 + i}", "DE89370400440532013000" if i % 10 else "none", "some words", None, i) for i in range(50)]
    df = spark.createDataFrame(rows, "mail string, card string, order_no string, `tel.no` string, ip string, ssn string, account string, text string, nothing string, n int")
    got = {r["column_name"]: (r["class"], r["kind"], r["n_values"]) for r in G.classify_columns(df).collect()}
    assert got == {"mail": ("email", "PII", 50), "card": ("card_number", "financial", 50), "order_no": (None, None, 50), "tel.no": ("phone", "PII", 50), "ip": ("ip_address", "PII", 50),
                   "ssn": ("ssn", "PII", 50), "account": ("iban", "financial", 50), "text": (None, None, 50), "nothing": (None, None, 0)}
    own = [("even", "custom", lambda v: v.cast("int") % 2 == 0)]
    assert G.classify_columns(df, ["n"], 0.5, own).first()["class"] == "even"
    assert G.classify_columns(df.limit(0), ["mail"]).first()["class"] is None


def test_statistics_change_the_plan(spark):
    """With statistics the planner knows that a filter leaves little, and broadcasts that side."""
    name = f"stats_{random.randrange(10**9)}"
    spark.range(60_000).selectExpr("id AS k", "id % 1000 AS v", "sha2(cast(id AS string), 256) AS pad").write.saveAsTable(name)
    keys = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "100k", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        join = lambda: spark.table(name).alias("a").join(spark.table(name).filter("v = 7").alias("b"), F.col("a.k") == F.col("b.k")).select("a.k")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in join()
        stats = {r["column_name"]: r for r in G.analyze_table(spark, name, ["k", "v"]).collect()}
        assert "BroadcastHashJoin" in join()
        assert stats["v"]["n_rows"] == 60_000 and stats["v"]["min_value"] == "0" and stats["v"]["max_value"] == "999" and stats["k"]["n_null"] == 0
        assert abs(stats["v"]["n_distinct"] - 1000) <= 100
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_skewed_join_is_split(spark):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        big = spark.range(0, 90_000, 1, 12).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k", "sha2(cast(id AS string), 256) AS pad")
        out = big.join(spark.range(90_000).withColumnRenamed("id", "k"), "k")
        with pytest.raises(ValueError):
            P.skew_joins(out)
        assert len(out.collect()) == 90_000 and P.skew_joins(out) == 1
        even = spark.range(5000).withColumnRenamed("id", "k").join(spark.range(5000).withColumnRenamed("id", "k"), "k")
        even.collect()
        assert P.skew_joins(even) == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_master_filters_one_join_for_each_master(spark):
    df = spark.createDataFrame([(i, i % 4, i % 5 if i % 7 else None, i) for i in range(200)], "id int, a int, b int, c int")
    a, b, c = (spark.createDataFrame(rows, s) for rows, s in (([(0, 1), (1, 1), (2, 0), (1, 5)], "ka int, live int"), ([(0,), (1,), (2,)], "kb int"), ([(i, i % 2) for i in range(150)], "kc int, odd int")))
    rules = [dict(filtered_column="a", master=a, curated_column="ka", where="live > 0"), dict(filtered_column="b", master=b, curated_column="kb"),
             dict(filtered_column="c", master=c, curated_column="kc", where="odd = a"), dict(filtered_column="c", master=c, curated_column="kc", where="kc > 20")]
    seen = []
    ok, fail = master_filters(df, rules, CheckContext("t"), with_json=False, extra_cols=["id"], observations=seen)
    want_ok, want_fail, entering = [], [], [0] * 4
    for i in range(200):
        va, vb, vc = i % 4, i % 5 if i % 7 else None, i
        tests = [va in (0, 1), vb in (0, 1, 2), vc < 150 and vc % 2 == va, vc < 150 and vc > 20]
        lost = next((n for n, t in enumerate(tests) if not t), None)
        for n in range(4 if lost is None else lost + 1):
            entering[n] += 1
        want_ok += [i] if lost is None else []
        want_fail += [] if lost is None else [(i, "abcc"[lost], None if (va, vb, vc, vc)[lost] is None else str((va, vb, vc, vc)[lost]))]
    assert sorted(r["id"] for r in ok.collect()) == want_ok and ok.columns == df.columns
    assert sorted((r["id"], r["check_column_name"], r["check_column_value"]) for r in fail.collect()) == want_fail
    assert [o.get["rows_in"] for o in seen] == entering
    many = [dict(filtered_column="b", master=b, curated_column="kb") for _ in range(5)]
    plan = master_filters(df, many, CheckContext("t"), with_json=False)[1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 5


def test_duplicates_on_dotted_names(spark):
    df = spark.createDataFrame([("a", 1, 10), ("A", 2, 20), ("b", 3, 30), (None, 4, 40)], "`key.part` string, `v.x` int, _timestamp int")
    ok, fail = check_duplicates(df, ["key.part"], CheckContext("t"))
    assert sorted(r["v.x"] for r in ok.collect()) == [2, 3] and fail.count() == 2
    assert check_duplicates(df, ["key.part"], CheckContext("t"), null_pk="blank", all_losers=True)[1].count() == 1
    assert dedup_keep(df, ["key.part"]).count() == 3 and duplicate_keys(df, ["key.part"], True).count() == 1
