"""Copy-on-write versions, partition-scoped upsert, append-only insert."""

import pytest
from pyspark.sql import functions as F

from soukline.operators import upsert
from soukline.session import run_dir
from soukline.sources.tables import (append_new_keys, merge_partitions, path_exists, read_table,
                                     truncate, versions, write_version)

S = "k int, v string, p string"


def _rows(spark, root):
    return sorted(tuple(r) for r in spark.read.parquet(root).select("k", "v", "p").collect())


def test_versions_and_truncate(spark):
    root = run_dir(spark, "t-versions")
    write_version(spark.createDataFrame([(1, "a", "x")], S), root)
    # an interrupted write leaves a folder without _SUCCESS; it is skipped, not reused
    spark.createDataFrame([(9, "z", "x")], S).write.parquet(f"{root}/v000002")
    import os
    os.remove(f"{root.replace('file:', '')}/v000002/_SUCCESS")
    assert versions(spark, root) == [1]
    write_version(spark.createDataFrame([(2, "b", "y")], S), root)
    assert versions(spark, root) == [1, 3]
    assert [tuple(r) for r in read_table(spark, root).collect()] == [(2, "b", "y")]
    truncate(spark, root)
    t = read_table(spark, root)
    assert t.count() == 0 and t.columns == ["k", "v", "p"]


def test_merge_partitions_moves_a_key(spark):
    root = run_dir(spark, "t-parts")
    merge_partitions(spark.createDataFrame([(1, "a", "2024-01"), (2, "b", "2024-02"),
                                            (3, "c", "2024-03")], S), root, ["k"], "p", upsert)
    # key 1 moves from 2024-01 to 2024-02; 2024-03 is untouched
    merge_partitions(spark.createDataFrame([(1, "A", "2024-02"), (4, "d", "2024-01")], S),
                     root, ["k"], "p", upsert)
    assert _rows(spark, root) == [(1, "A", "2024-02"), (2, "b", "2024-02"),
                                  (3, "c", "2024-03"), (4, "d", "2024-01")]


def test_append_new_keys_is_idempotent(spark):
    root = run_dir(spark, "t-append")
    src = spark.createDataFrame([(1, "a", "2024-01"), (2, "b", "2024-02")], S)
    append_new_keys(src, root, ["k"], "p")
    more = spark.createDataFrame([(2, "B", "2024-05"), (3, "c", "2024-01")], S)
    append_new_keys(more, root, ["k"], "p")
    append_new_keys(more, root, ["k"], "p")      # replayed batch adds nothing
    assert _rows(spark, root) == [(1, "a", "2024-01"), (2, "b", "2024-02"), (3, "c", "2024-01")]


def _merge(spark, root, rows):
    return merge_partitions(spark.createDataFrame(rows, S), root, ["k"], "p", upsert)


def test_lone_row_moves_and_its_old_partition_goes(spark):
    root = run_dir(spark, "t-lone")
    _merge(spark, root, [(1, "a", "2024-01"), (2, "b", "2024-02")])
    _merge(spark, root, [(1, "a2", "2024-02")])
    assert _rows(spark, root) == [(1, "a2", "2024-02"), (2, "b", "2024-02")]


def test_null_partition_keeps_its_rows(spark):
    root = run_dir(spark, "t-null")
    _merge(spark, root, [(1, "a", "2024-01"), (2, "b", None)])
    _merge(spark, root, [(3, "c", None), (1, "d", None)])
    got = sorted((r.k, r.v, r.p) for r in spark.read.schema(S).parquet(root).collect())
    assert got == [(1, "d", None), (2, "b", None), (3, "c", None)]
    _merge(spark, root, [(2, "e", "2024-03"), (3, "f", "2024-03"), (1, "g", "2024-03")])
    assert _rows(spark, root) == [(1, "g", "2024-03"), (2, "e", "2024-03"), (3, "f", "2024-03")]


def test_empty_batches_write_nothing(spark):
    root = run_dir(spark, "t-empty")
    assert _merge(spark, root, []) == 0
    assert append_new_keys(spark.createDataFrame([], S), root, ["k"], "p") == 0
    assert _merge(spark, root, [(1, "a", "2024-01")]) == 1
    assert _merge(spark, root, []) == 0
    assert append_new_keys(spark.createDataFrame([(1, "z", "2024-01"), (5, "e", "2024-01")], S),
                           root, ["k"], "p", stable_keys=True) == 1
    assert _rows(spark, root) == [(1, "a", "2024-01"), (5, "e", "2024-01")]


def test_merges_leave_no_intermediate_files(spark):
    import os
    from soukline.session import shared_dir
    root = run_dir(spark, "t-clean")
    base = shared_dir(spark).replace("file:", "") + "/soukline"
    _merge(spark, root, [(1, "a", "2024-01")])
    _merge(spark, root, [(1, "b", "2024-02")])
    assert not [d for d in os.listdir(base) if d.startswith(("merge-", "append-"))]


def test_old_versions_can_be_dropped(spark):
    root = run_dir(spark, "t-keep")
    for i in range(5):
        write_version(spark.createDataFrame([(i, "a", "x")], S), root, keep=2)
    assert versions(spark, root) == [4, 5]
    assert read_table(spark, root).first().k == 4


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _months_table(spark, root, n=400):
    rows = spark.range(n).selectExpr("CAST(id AS INT) AS k", "'a' AS v",
                                     "concat('2024-', lpad(1 + id div 100, 2, '0')) AS p")
    merge_partitions(rows, root, ["k"], "p", upsert)
    return spark.read.schema(S).parquet(root)


def test_merge_reads_only_touched_partitions(spark):
    from soukline.sources.tables import in_partitions, touched_partitions
    root = run_dir(spark, "t-prune")
    table = _months_table(spark, root)
    src = spark.createDataFrame([(1, "b", "2024-03")], S)      # moves from 2024-01 to 2024-03
    touched = touched_partitions(table, src, ["k"], "p")
    assert sorted(r.p for r in touched.collect()) == ["2024-01", "2024-03"]
    target = in_partitions(table, "p", touched)
    plan = _plan(target)
    assert "p#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len({f.rsplit("/", 2)[1] for f in target.inputFiles()}) == 4   # before pruning
    files = {r[0].rsplit("/", 2)[1] for r in
             target.selectExpr("input_file_name()").distinct().collect()}
    assert files == {"p=2024-01", "p=2024-03"}


def test_key_search_pushes_the_key_range(spark):
    from soukline.sources.tables import near_keys
    table = _months_table(spark, run_dir(spark, "t-range"))
    src = spark.createDataFrame([(120, "b", "x"), (130, "c", "x")], S)
    near = near_keys(table.select("k", "p"), src, ["k"])
    plan = _plan(near)
    assert "GreaterThanOrEqual(k,120)" in plan and "LessThanOrEqual(k,130)" in plan
    assert near.count() == 11
    none = spark.createDataFrame([(None, "b", "x")], S)
    assert near_keys(table, none, ["k"]).count() == 0


def test_many_partitions_and_null_fall_back_to_a_join(spark, monkeypatch):
    from soukline.sources import tables
    root = run_dir(spark, "t-many")
    table = _months_table(spark, root)
    monkeypatch.setattr(tables, "PUSHED_VALUES", 1)
    merge_partitions(spark.createDataFrame([(1, "b", None), (150, "c", "2024-04")], S), root,
                     ["k"], "p", upsert)
    got = {r.k: (r.v, r.p) for r in spark.read.schema(S).parquet(root).collect()}
    assert len(got) == 400 and got[1] == ("b", None) and got[150] == ("c", "2024-04")
    merge_partitions(spark.createDataFrame([(1, "d", "2024-01"), (399, "e", None)], S), root,
                     ["k"], "p", upsert)
    got = {r.k: (r.v, r.p) for r in spark.read.schema(S).parquet(root).collect()}
    assert len(got) == 400 and got[1] == ("d", "2024-01") and got[399] == ("e", None)
    assert table.columns == ["k", "v", "p"]


def test_a_merge_that_died_is_completed(spark):
    """Crash after the stage was sealed and one partition folder already gone."""
    from soukline.session import drop_dir
    from soukline.sources.tables import finish_pending, path_exists, stage_partitions
    root = run_dir(spark, "t-crash")
    _merge(spark, root, [(1, "a", "2024-01"), (2, "b", "2024-02"), (3, "c", "2024-03")])
    merged = spark.createDataFrame([(1, "A", "2024-02"), (2, "b", "2024-02")], S)
    touched = spark.createDataFrame([("2024-01",), ("2024-02",)], "p string")
    stage_partitions(merged, touched, root)
    drop_dir(spark, f"{root}/p=2024-02")
    assert finish_pending(spark, root, ["k"], "p")
    want = [(1, "A", "2024-02"), (2, "b", "2024-02"), (3, "c", "2024-03")]
    assert _rows(spark, root) == want and not path_exists(spark, f"{root}/_pending")
    # a stage that was never sealed had changed nothing and is dropped
    merged.write.parquet(f"{root}/_pending/merged")
    assert not finish_pending(spark, root, ["k"], "p")
    assert _rows(spark, root) == want
    # the next merge completes it by itself
    stage_partitions(merged.filter("k = 1"), touched, root)
    _merge(spark, root, [(4, "d", "2024-04")])
    assert _rows(spark, root) == [(1, "A", "2024-02"), (3, "c", "2024-03"), (4, "d", "2024-04")]


F_S = "k int, v int, at int, p string"


def test_insert_first_does_not_depend_on_the_cut(spark):
    from soukline.operators import insert_first
    from soukline.sources.tables import insert_first_keys
    stored = [(1, 10, None, "m1"), (2, 20, None, "m1")]
    sent = [(1, 11, 3, "m2"), (3, 30, 5, "m1"), (3, 31, 4, "m2"), (None, 1, 7, "m1")]
    want = {(1, 10, None, "m1"), (2, 20, None, "m1"), (3, 31, 4, "m2"), (None, 1, 7, "m1")}
    for n, order in enumerate([sent, sent[::-1]]):
        for size in (2, 4):
            root = run_dir(spark, f"t-first-{n}-{size}")
            spark.createDataFrame(stored, F_S).write.partitionBy("p").parquet(root)
            for i in range(0, 4, size):
                part = spark.createDataFrame(order[i:i + size], F_S)
                insert_first_keys(part, root, ["k"], "p", ["at"])
            insert_first_keys(part, root, ["k"], "p", ["at"])     # a replay changes nothing
            got = spark.read.schema(F_S).parquet(root).select("k", "v", "at", "p")
            assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    for order in (sent[:3], sent[2::-1]):                # the same rule as a DataFrame
        t = spark.createDataFrame(stored, F_S)
        for r in order:
            t = insert_first(t, spark.createDataFrame([r], F_S), ["k"], ["at"])
        assert set(map(tuple, t.collect())) == want - {(None, 1, 7, "m1")}


def test_stored_history_writes_only_what_changes(spark):
    import os
    from soukline.operators import scd2
    from soukline.sources.history import merge_history, read_current, read_history
    root = run_dir(spark, "t-history")
    path = root.replace("file:", "")
    kind = "id int, name string, city string"
    snap = lambda moved, n=200: spark.createDataFrame(
        [(i, f"n{i}", "B" if i in moved else "A") for i in range(n)], kind)
    days = [("2024-01-01", snap(())), ("2024-01-02", snap((5,))), ("2024-01-03", snap((5, 6), 201)),
            ("2024-01-04", snap((6,), 201))]
    plain, files = None, {}
    for day, rows in days:
        plain = scd2(plain, rows, "id", day)
        merge_history(rows, root, "id", day, slots=8)
        got = sorted(map(str, read_history(spark, root).select(*plain.columns).collect()))
        assert got == sorted(map(str, plain.collect()))
        now = {d: os.path.getmtime(f"{path}/{d}") for d in os.listdir(path) if "=" in d}
        changed = {d for d in now if files.get(d) != now[d]}
        if files:       # the slot of the day, and the slots of one or two keys
            assert len(changed) <= 3 and f"_slot=history-{day}" in changed
        files = now
        assert merge_history(rows, root, "id", day, slots=8) == 0
    assert read_current(spark, root).count() == 201
    plan = _plan(read_current(spark, root))
    assert "StartsWith" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_first_write_goes_straight_into_the_table(spark, monkeypatch):
    root = f"{run_dir(spark, 't')}/new"

    def kept(df, path):
        raise AssertionError("the source of a new table needs no copy")

    monkeypatch.setattr("soukline.sources.tables.saved", kept)
    rows = spark.createDataFrame([(1, "a", "2024-01"), (2, "b", None), (2, "b", None)], S)
    assert merge_partitions(rows.limit(0), root, ["k"], "p", upsert) == 0
    assert not path_exists(spark, root)
    broken = rows.withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("broken")))
                             .otherwise(F.col("k")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        merge_partitions(broken, root, ["k"], "p", upsert)
    assert not path_exists(spark, root)
    assert merge_partitions(rows, root, ["k"], "p", upsert) == 1
    assert spark.read.schema(rows.schema).parquet(root).count() == 3
