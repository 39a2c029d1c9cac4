"""Table operators (T1-T6, S3, S4) on hand-made frames: FIXTURES.md section 4."""

import os
import threading

import pytest
from conftest import D
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.operators import storage
from tillbook.operators.storage import Table

SCHEMA = T.StructType([
    T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType()),
    T.StructField("d", T.DateType()),
])


def table(path, key="k"):
    return Table(path, "d", SCHEMA, key)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, D(d) if d else None) for k, v, d in rows], SCHEMA)


def rows(spark, t, **kw):
    return sorted((r.k, r.v, str(r.d)) for r in storage.read(spark, t, **kw).collect())


def test_create_replaces_whole_table(spark, scratch):
    t = table(scratch)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-02")]))
    storage.create(spark, t, frame(spark, [("3", 3.0, "2024-01-03")]))
    assert rows(spark, t) == [("3", 3.0, "2024-01-03")]
    assert sorted(n for n in os.listdir(scratch) if not n.startswith("_")) == ["d=2024-01-03"]


def test_replace_day_and_rerun_is_identical(spark, scratch):
    t = table(scratch, key=None)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-02")]))
    new = frame(spark, [("9", 9.0, "2024-01-02")])
    storage.replace_days(spark, t, new, ["2024-01-02"])
    first = rows(spark, t)
    storage.replace_days(spark, t, new, ["2024-01-02"])
    assert rows(spark, t) == first == [("1", 1.0, "2024-01-01"), ("9", 9.0, "2024-01-02")]


def test_replace_day_with_no_rows_removes_it(spark, scratch):
    t = table(scratch, key=None)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-02")]))
    storage.replace_days(spark, t, frame(spark, []), ["2024-01-02"])
    assert rows(spark, t) == [("1", 1.0, "2024-01-01")]
    assert not os.path.exists(f"{scratch}/d=2024-01-02")


def test_null_day_is_rejected_and_table_unchanged(spark, scratch):
    t = table(scratch, key=None)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01")]))
    with pytest.raises(Exception, match="NULL in day column"):
        storage.replace_days(spark, t, frame(spark, [("2", 2.0, None)]), ["2024-01-01"])
    assert rows(spark, t) == [("1", 1.0, "2024-01-01")]


def test_delete_days_and_predicate(spark, scratch):
    t = table(scratch, key=None)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("2", None, "2024-01-02"),
                                           ("3", 3.0, "2024-01-02")]))
    storage.delete_days(spark, t, ["2024-01-01"])
    assert rows(spark, t) == [("2", None, "2024-01-02"), ("3", 3.0, "2024-01-02")]
    # NULL never matches a delete predicate
    assert storage.delete_where(spark, t, "v > 2") == ["2024-01-02"]
    assert rows(spark, t) == [("2", None, "2024-01-02")]


def test_day_read_prunes_partitions(spark, scratch):
    t = table(scratch, key=None)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-02")]))
    df = storage.read(spark, t, days=["2024-01-02"])
    assert [f.rsplit("/", 2)[1] for f in df.inputFiles()] == ["d=2024-01-02"]
    assert [r.k for r in df.collect()] == ["2"]
    assert storage.read(spark, t, days=["2030-01-01"]).count() == 0


def test_append_schema_evolution(spark, scratch):
    t = table(scratch, key=None)
    storage.append(spark, t, frame(spark, [("1", 1.0, "2024-01-01")]))
    extra = frame(spark, [("2", 2.0, "2024-01-01")]).withColumn("canal", F.lit("web"))
    storage.append(spark, t, extra)
    missing = frame(spark, [("3", 3.0, "2024-01-02")]).drop("v")
    storage.append(spark, t, missing)
    got = sorted((r.k, r.v, r.canal) for r in storage.read(spark, t, evolved=True).collect())
    assert got == [("1", 1.0, None), ("2", 2.0, "web"), ("3", None, None)]


def test_upsert_update_and_insert(spark, scratch):
    t = table(scratch)
    storage.upsert(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-01")]))
    storage.upsert(spark, t, frame(spark, [("2", 20.0, "2024-01-01"), ("3", 30.0, "2024-01-01")]))
    assert rows(spark, t) == [("1", 1.0, "2024-01-01"), ("2", 20.0, "2024-01-01"),
                              ("3", 30.0, "2024-01-01")]


def test_upsert_moves_day_and_empties_old_day(spark, scratch):
    t = table(scratch)
    storage.create(spark, t, frame(spark, [("2", 2.0, "2024-01-01"), ("5", 5.0, "2024-01-03")]))
    touched = storage.upsert(spark, t, frame(spark, [("2", 2.5, "2024-01-02")]))
    assert touched == ["2024-01-01", "2024-01-02"]
    assert rows(spark, t) == [("2", 2.5, "2024-01-02"), ("5", 5.0, "2024-01-03")]
    assert not os.path.exists(f"{scratch}/d=2024-01-01")


def test_upsert_null_keys_never_match(spark, scratch):
    t = table(scratch)
    storage.create(spark, t, frame(spark, [(None, 1.0, "2024-01-01")]))
    storage.upsert(spark, t, frame(spark, [(None, 2.0, "2024-01-01")]))
    assert rows(spark, t) == [(None, 1.0, "2024-01-01"), (None, 2.0, "2024-01-01")]


def test_upsert_duplicate_target_key_updates_each(spark, scratch):
    t = table(scratch)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("1", 1.5, "2024-01-01")]))
    storage.upsert(spark, t, frame(spark, [("1", 9.0, "2024-01-01")]))
    assert rows(spark, t) == [("1", 9.0, "2024-01-01"), ("1", 9.0, "2024-01-01")]


def test_upsert_duplicate_source_key(spark, scratch):
    t = table(scratch)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01")]))
    with pytest.raises(ValueError, match="several source rows"):
        storage.upsert(spark, t, frame(spark, [("1", 2.0, "2024-01-01"), ("1", 3.0, "2024-01-01")]))
    assert rows(spark, t) == [("1", 1.0, "2024-01-01")]
    storage.upsert(spark, t, frame(spark, [("7", 2.0, "2024-01-01"), ("7", 3.0, "2024-01-01")]))
    assert rows(spark, t) == [("1", 1.0, "2024-01-01"), ("7", 2.0, "2024-01-01"),
                              ("7", 3.0, "2024-01-01")]


def _failing(spark, rows):
    """Rows of which the last one kills the job when it is reached."""
    return frame(spark, rows).repartition(1).sortWithinPartitions("k").withColumn(
        "v", F.when(F.col("k") == rows[-1][0], F.raise_error(F.lit("killed"))).otherwise(F.col("v")).cast("double"))


@pytest.mark.parametrize("write", [
    lambda s, t, df: storage.create(s, t, df), lambda s, t, df: storage.append(s, t, df),
    lambda s, t, df: storage.replace_days(s, t, df, ["2024-01-01", "2024-01-02"]),
    lambda s, t, df: storage.upsert(s, t, df)])
def test_a_killed_job_leaves_the_table_readable(spark, scratch, write):
    t = table(scratch)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-02")]))
    with pytest.raises(Exception, match="killed"):
        write(spark, t, _failing(spark, [("1", 5.0, "2024-01-01"), ("7", 6.0, "2024-01-03"), ("9", 0.0, "2024-01-02")]))
    assert rows(spark, t) == [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-02")]
    write(spark, t, frame(spark, [("1", 5.0, "2024-01-01")]))                # and the next write works
    assert ("1", 5.0, "2024-01-01") in rows(spark, t)


def test_what_a_dead_driver_leaves_is_no_part_of_the_table(spark, scratch):
    """A driver that dies leaves Spark's own staging folders: reads and day lists pass over them."""
    t = table(scratch)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01")]))
    part = next(f for f in os.listdir(f"{scratch}/d=2024-01-01") if f.endswith(".parquet"))
    for left in (".spark-staging-1a2b", "_temporary/0/task_1"):
        os.makedirs(f"{scratch}/{left}/d=2024-01-05")
        with open(f"{scratch}/d=2024-01-01/{part}", "rb") as a, open(f"{scratch}/{left}/d=2024-01-05/{part}", "wb") as b:
            b.write(a.read())
    assert rows(spark, t) == [("1", 1.0, "2024-01-01")]
    storage.replace_days(spark, t, frame(spark, [("2", 2.0, "2024-01-02")]), ["2024-01-02"])
    storage.delete_where(spark, t, "k = '1'")
    assert rows(spark, t) == [("2", 2.0, "2024-01-02")]


def test_rows_of_other_days_are_appended(spark, scratch):
    t = table(scratch, key=None)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-02")]))
    new = frame(spark, [("3", 3.0, "2024-01-01"), ("4", 4.0, "2024-01-02"), ("5", 5.0, "2024-01-04")])
    assert storage.replace_days(spark, t, new, ["2024-01-02", "2024-01-03"]) == [
        "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    assert rows(spark, t) == [("1", 1.0, "2024-01-01"), ("3", 3.0, "2024-01-01"), ("4", 4.0, "2024-01-02"),
                              ("5", 5.0, "2024-01-04")]


def test_writes_survive_reads_in_another_thread(spark, scratch):
    t = table(scratch, key=None)
    storage.create(spark, t, frame(spark, [("0", 0.0, "2024-01-01")]))
    stop, failures = threading.Event(), []

    def poll():
        while not stop.is_set():
            try:
                storage.added_columns(spark, t), storage.exists(spark, t)
                storage.read(spark, t, days=["2024-02-01"]).count()
            except Exception as e:  # noqa: BLE001
                failures.append(e)
    reader = threading.Thread(target=poll)
    reader.start()
    try:
        for i in range(4):
            storage.replace_days(spark, t, frame(spark, [(str(i), float(i), "2024-01-02")]), ["2024-01-02"])
    finally:
        stop.set()
        reader.join()
    assert not failures
    assert rows(spark, t) == [("0", 0.0, "2024-01-01"), ("3", 3.0, "2024-01-02")]


def test_a_table_exists_from_its_first_write(spark, scratch):
    t = table(scratch)
    with pytest.raises(Exception, match="NULL in day column"):
        storage.create(spark, t, frame(spark, [("1", 1.0, None)]))
    assert not storage.exists(spark, t)
    storage.append(spark, t, frame(spark, [("2", 2.0, "2024-01-01")]))
    assert storage.exists(spark, t) and rows(spark, t) == [("2", 2.0, "2024-01-01")]


def _evolved(spark, t):
    return sorted((r.k, r.v, r.canal, str(r.d)) for r in storage.read(spark, t, evolved=True).collect())


def test_upsert_and_delete_where_keep_added_columns(spark, scratch):
    t = table(scratch)
    web = frame(spark, [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-01"), ("3", 3.0, "2024-01-02")]) \
        .withColumn("canal", F.concat(F.lit("web"), "k"))
    storage.append(spark, t, web)
    storage.upsert(spark, t, frame(spark, [("2", 20.0, "2024-01-02"), ("4", 4.0, "2024-01-02")]))
    assert _evolved(spark, t) == [("1", 1.0, "web1", "2024-01-01"), ("2", 20.0, "web2", "2024-01-02"),
                                  ("3", 3.0, "web3", "2024-01-02"), ("4", 4.0, None, "2024-01-02")]
    # columns the batch lacks stay; an added column it has is updated
    storage.upsert(spark, t, frame(spark, [("3", 0.0, "2024-01-02")]).drop("v").withColumn("canal", F.lit("app")))
    assert _evolved(spark, t)[2] == ("3", 3.0, "app", "2024-01-02")
    storage.delete_where(spark, t, "v > 10")
    storage.delete_where(spark, t, "canal = 'web1'")
    assert _evolved(spark, t) == [("3", 3.0, "app", "2024-01-02"), ("4", 4.0, None, "2024-01-02")]


def test_an_added_column_keeps_its_type(spark, scratch):
    t = table(scratch, key=None)
    storage.append(spark, t, frame(spark, [("1", 1.0, "2024-01-01")]).withColumn("canal", F.lit("web")))
    for write in (storage.append, storage.replace_days):
        with pytest.raises(ValueError, match="canal .* is string, not int"):
            write(spark, t, frame(spark, [("2", 2.0, "2024-01-01")]).withColumn("canal", F.lit(7)))
    assert _evolved(spark, t) == [("1", 1.0, "web", "2024-01-01")]


def test_session_settings_survive_overlapping_uses(spark):
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key, None)
    one, two = (storage.session_conf(spark, storage.WRITE_CONF) for _ in range(2))
    one.__enter__(), two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(key) == "1"
    two.__exit__(None, None, None)
    assert spark.conf.get(key, None) == before


def test_pending_days_of_a_tracked_table(spark, scratch):
    t = Table(scratch, "d", SCHEMA, "k", track=True)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-01"), ("2", 2.0, "2024-01-02")]))
    storage.clear_pending(spark, t, storage.pending(spark, t))
    storage.upsert(spark, t, frame(spark, [("1", 1.5, "2024-01-03")]))
    left = storage.pending(spark, t)
    assert sorted(d for days in left.values() for d in days) == ["2024-01-01", "2024-01-03"]
    storage.clear_pending(spark, t, left)
    assert storage.pending(spark, t) == {}


def test_rows_lie_in_key_order_in_their_files(spark, scratch):
    """O1, in the files themselves: no reader sorts here."""
    import pyarrow.parquet as pq
    t = Table(scratch, "d", SCHEMA, None, ("k",))
    df = spark.range(5000).selectExpr("CAST(hash(id) AS STRING) AS k", "CAST(id AS DOUBLE) AS v",
                                      "date_add(DATE'2024-01-01', CAST(id % 7 AS INT)) AS d").repartition(6)
    storage.create(spark, t, df)
    files = [f"{scratch}/{d}/{f}" for d in os.listdir(scratch) if d.startswith("d=")
             for f in os.listdir(f"{scratch}/{d}") if f.endswith(".parquet")]
    assert len(files) >= 7
    for f in files:
        keys = pq.ParquetFile(f).read(["k"])["k"].to_pylist()
        assert keys == sorted(keys) and len(keys) > 1


def test_files_of_a_hot_day_have_disjoint_key_ranges(spark, scratch):
    """O1 of a ranged table, from the footers: one day holds most rows."""
    import pyarrow.parquet as pq
    t = Table(scratch, "d", SCHEMA, None, ("k",), ranged=True)
    df = spark.range(40_000).selectExpr(
        "CAST(hash(id) AS STRING) AS k", "CAST(id AS DOUBLE) AS v",
        "IF(id % 10 < 8, DATE'2024-01-03', date_add(DATE'2024-01-01', CAST(id % 7 AS INT))) AS d").repartition(6)
    days = storage.create(spark, t, df)
    assert len(days) == 7
    files = {d: [f"{scratch}/{d}/{f}" for f in os.listdir(f"{scratch}/{d}") if f.endswith(".parquet")]
             for d in os.listdir(scratch) if d.startswith("d=")}
    assert len(files["d=2024-01-03"]) > 2
    n = 0
    for fs in files.values():
        ranges = []
        for f in fs:
            footer = pq.ParquetFile(f).metadata
            n += footer.num_rows
            stats = [footer.row_group(g).column(0).statistics for g in range(footer.num_row_groups)]
            ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
        ranges.sort()
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert n == 40_000


def test_write_dispatch(spark, scratch):
    t = table(scratch)
    assert not storage.exists(spark, t)
    storage.write(spark, t, frame(spark, [("1", 1.0, "2024-01-01")]))      # bootstrap
    storage.write(spark, t, frame(spark, [("1", 2.0, "2024-01-01")]))      # upsert
    assert rows(spark, t) == [("1", 2.0, "2024-01-01")]


def test_malformed_day_is_rejected_before_any_job(spark, scratch):
    from tillbook.functions.days import as_date, day_range
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        as_date("2024-13-01")
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        storage.read(spark, table(scratch), days=["01/02/2024"])
    assert [str(d) for d in day_range("2024-02-28", "2024-03-01")] == \
        ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_write_conf_is_restored(spark, scratch):
    before = {k: spark.conf.get(k, None) for k in storage.WRITE_CONF}
    storage.create(spark, table(scratch), frame(spark, [("1", 1.0, "2024-01-01")]))
    assert {k: spark.conf.get(k, None) for k in storage.WRITE_CONF} == before


def test_hot_day_is_split_over_several_tasks(spark, scratch):
    """A day holding a third of all rows: rebalance lets AQE split it."""
    t = table(scratch, key=None)
    n = 30000
    df = spark.range(n).selectExpr(
        "CAST(id AS STRING) AS k", "CAST(id AS DOUBLE) AS v",
        "CASE WHEN id % 3 = 0 THEN DATE'2024-01-01' "
        "ELSE date_add(DATE'2024-01-02', CAST(id % 50 AS INT)) END AS d")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        storage.create(spark, t, df)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [f for f in os.listdir(f"{scratch}/d=2024-01-01") if f.endswith(".parquet")]
    assert len(hot) > 1                                  # split, not one task
    assert storage.read(spark, t).count() == n           # nothing dropped
    assert storage.read(spark, t, days=["2024-01-01"]).count() == n // 3


def _rows_scanned(df):
    """Rows that the scans of a plan without shuffles gave, as Spark counted them."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_upsert_of_few_random_keys_skips_row_groups_by_bloom_filter(spark, scratch):
    t = table(scratch)
    df = spark.range(60_000).selectExpr("md5(CAST(id AS STRING)) AS k", "CAST(id AS DOUBLE) AS v",
                                        "date_add(DATE'2024-01-01', CAST(id % 60 AS INT)) AS d")
    storage.create(spark, t, df)
    batch = df.filter("v IN (7, 67, 8)").withColumn("v", F.lit(-1.0)).union(frame(spark, [("new", 0.0, "2024-01-09")]))
    target = storage._among(storage.read(spark, t).select("k", "d"), "k", batch)
    with storage.session_conf(spark, {"spark.sql.parquet.pushdown.inFilterThreshold": str(storage.FEW_KEYS)}):
        assert 3 <= _rows_scanned(target) < 5_000          # 2 of 60 days hold the keys
    assert storage.upsert(spark, t, batch) == ["2024-01-08", "2024-01-09"]
    assert storage.read(spark, t).count() == 60_001 and storage.read(spark, t).filter("v = -1").count() == 3


def test_days_come_from_folders_without_a_scan(spark, scratch):
    t = table(scratch, key=None)
    storage.create(spark, t, frame(spark, [("1", 1.0, "2024-01-03"), ("2", 2.0, "2024-01-01")]))
    df = storage.days_frame(spark, t)
    assert [str(r.d) for r in df.collect()] == ["2024-01-01", "2024-01-03"]
    assert "parquet" not in df._jdf.queryExecution().toString().lower()
    storage.delete_days(spark, t, ["2024-01-01", "2024-01-03"])
    assert storage.days_frame(spark, t).agg(F.min("d")).first()[0] is None
