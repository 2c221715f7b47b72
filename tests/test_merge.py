from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from cairnlake.operators import keyed, merge
from cairnlake.plans.silver import conform, load_batch
from cairnlake.sources.feeds import FEEDS
from tests.conftest import plan, rows
from verification import registry

SCHEMA = "k string, v int, first int, batch_id string"
UPDATED = ["v", "batch_id"]


def state(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_update_insert_and_keep(spark):
    target = state(spark, ("a", 1, 1, "2024-01"), ("b", 2, 2, "2024-03"))
    source = state(spark, ("a", 10, 10, "2024-02"), ("b", 20, 20, "2024-02"), ("c", 30, 30, "2024-02"))
    out = merge.upsert(target, source, ["k"], UPDATED, "batch_id")
    assert rows(out) == [
        ("a", 10, 1, "2024-02"),  # updated, column outside the list kept
        ("b", 2, 2, "2024-03"),  # older source: unchanged
        ("c", 30, 30, "2024-02"),  # inserted whole
    ]


def test_without_guard_latest_write_wins(spark):
    out = merge.upsert(state(spark, ("b", 2, 2, "2024-03")), state(spark, ("b", 20, 20, "2024-02")), ["k"], UPDATED)
    assert rows(out) == [("b", 20, 2, "2024-02")]


def test_null_keys(spark):
    target, source = state(spark, (None, 1, 1, "2024-01")), state(spark, (None, 2, 2, "2024-02"))
    inserted = merge.upsert(target, source, ["k"], UPDATED, "batch_id")
    assert rows(inserted, "v") == [(1,), (2,)]
    matched = merge.upsert(target, source, ["k"], UPDATED, "batch_id", null_keys="match")
    assert rows(matched) == [(None, 2, 1, "2024-02")]


def test_unknown_guard_value_does_not_update(spark):
    target = state(spark, ("a", 1, 1, None))
    out = merge.upsert(target, state(spark, ("a", 2, 2, "2024-02")), ["k"], UPDATED, "batch_id")
    assert rows(out) == [("a", 1, 1, None)]


def test_replay_changes_nothing(spark):
    target = state(spark, ("a", 1, 1, "2024-01"))
    source = state(spark, ("a", 5, 5, "2024-02"), ("z", 6, 6, "2024-02"))
    once = merge.upsert(target, source, ["k"], UPDATED, "batch_id")
    twice = merge.upsert(once, source, ["k"], UPDATED, "batch_id")
    assert rows(once) == rows(twice)


def test_guarded_order_of_arrival_does_not_matter(spark):
    one = state(spark, ("a", 1, 0, "2024-01"), ("b", 1, 0, "2024-01"))
    two = state(spark, ("a", 2, 0, "2024-02"), ("c", 2, 0, "2024-02"))
    three = state(spark, ("c", 3, 0, "2024-03"))

    def load(first, *later):
        out = first
        for part in later:
            out = merge.upsert(out, part, ["k"], UPDATED, "batch_id")
        return rows(out)

    assert load(one, two, three) == load(three, one, two) == load(two, three, one)


def test_audit_columns(spark):
    first = merge.with_audit(state(spark, ("a", 1, 1, "2024-01")), F.lit("t1"))
    second = merge.with_audit(state(spark, ("a", 2, 2, "2024-02"), ("b", 2, 2, "2024-02")), F.lit("t2"))
    out = merge.upsert(first, second, ["k"], UPDATED, "batch_id")
    assert rows(out, "k", "created_timestamp", "updated_timestamp") == [("a", "t1", "t2"), ("b", "t2", "t2")]


def test_ambiguous_keys(spark):
    source = state(spark, ("a", 1, 1, "2024-01"), ("a", 2, 2, "2024-01"), (None, 3, 3, "2024-01"), (None, 4, 4, "2024-01"))
    assert rows(merge.ambiguous_keys(source, ["k"])) == [("a", 2)]
    with pytest.raises(Exception, match="share merge key"):
        merge.require_unambiguous(source, ["k"]).collect()


def test_insert_new_is_null_safe(spark):
    target = spark.createDataFrame([("x", None), ("y", "1")], "a string, b string")
    source = spark.createDataFrame([("x", None), ("y", "2")], "a string, b string")
    assert rows(merge.insert_new(target, source, ["a", "b"])) == rows(
        spark.createDataFrame([("x", None), ("y", "1"), ("y", "2")], "a string, b string")
    )


def test_update_matched_needs_the_state(spark):
    target = spark.createDataFrame([("1", "in-progress"), ("2", "completed"), ("3", "in-progress")], "batch_id string, status string")
    source = spark.createDataFrame([("1", "done"), ("2", "done"), ("9", "done")], "batch_id string, status string")
    out = merge.update_matched(target, source, ["batch_id"], ["status"], F.col("status") == "in-progress")
    assert rows(out) == [("1", "done"), ("2", "completed"), ("3", "in-progress")]


def test_upsert_table_rewrites_only_touched_partitions(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "k string, v int, month string"
    data = [("a", 1, "2024-01"), ("b", 2, "2024-01"), ("c", 3, "2024-02")]
    merge.upsert_table(path, spark.createDataFrame(data, schema), ["k"], ["v"], "month", at=F.lit("t1"))
    before = {p.name for p in (tmp_path / "table" / "month=2024-02").glob("*.parquet")}
    source = spark.createDataFrame([("a", 10, "2024-01"), ("d", 40, "2024-03")], schema)
    for _ in range(2):
        merge.upsert_table(path, source, ["k"], ["v"], "month", at=F.lit("t2"))
    out = merge.stored(spark, path, merge.with_audit(source, F.lit("t")).schema)
    assert rows(out, "k", "v", "month", "created_timestamp", "updated_timestamp") == [
        ("a", 10, "2024-01", "t1", "t2"), ("b", 2, "2024-01", "t1", "t1"),
        ("c", 3, "2024-02", "t1", "t1"), ("d", 40, "2024-03", "t2", "t2"),
    ]
    assert {p.name for p in (tmp_path / "table" / "month=2024-02").glob("*.parquet")} == before


def test_stored_is_none_before_the_first_load(spark, tmp_path):
    assert merge.stored(spark, str(tmp_path / "absent"), state(spark, ("a", 1, 1, "x")).schema) is None


def orders(spark, *data):
    feed = FEEDS["sales_order"]
    made = [(n, None, 7, s, "EXP", 1, 2, src, b) for n, s, src, b in data]
    return spark.createDataFrame(made, feed.struct.add("batch_id", "string"))


def test_loading_batch_by_batch_equals_rebuild(spark):
    one = orders(spark, ("O1", "PENDING", None, "2024-01"), ("O2", " in  transit", "web", "2024-01"))
    two = orders(spark, ("O1", "DELIVERED", "web", "2024-02"), ("O3", "PENDING", "web", "2024-02"))
    feed = "sales_order"
    step = load_batch(load_batch(None, one, feed), two, feed)
    whole = conform(one.unionByName(two), feed)
    assert rows(step.select(*whole.columns)) == rows(whole)
    assert rows(whole, "order_number", "order_status", "order_source", "priority_code") == [
        ("O1", "Delivered", None, "Express"),
        ("O2", "In Transit", "web", "Express"),
        ("O3", "Pending", "web", "Express"),
    ]
    late = load_batch(load_batch(None, two, feed), one, feed)
    assert rows(late, "order_number", "order_status") == rows(whole, "order_number", "order_status")


P_SCHEMA = "k string, part string, v int, batch_id string"


def stored_after(spark, path, *batches, unique=False):
    for data in batches:
        merge.upsert_table(path, spark.createDataFrame(list(data), P_SCHEMA), ["k"], ["v", "batch_id"], "part", "batch_id", unique=unique)
    return rows(merge.stored(spark, path, merge.with_audit(spark.createDataFrame([], P_SCHEMA)).schema), "k", "part", "v")


def test_null_partition_keeps_its_rows(spark, tmp_path):
    first = [("a", "x", 1, "2024-01"), ("b", None, 1, "2024-01"), ("c", None, 1, "2024-01"), ("d", "", 1, "2024-01")]
    got = stored_after(spark, str(tmp_path / "t"), first, [("b", None, 2, "2024-02")])
    assert got == [("a", "x", 1), ("b", None, 2), ("c", None, 1), ("d", None, 1)]


def test_moved_key_is_not_doubled(spark, tmp_path):
    first = [("a", "x", 1, "2024-01"), ("b", "y: 1/2", 1, "2024-01"), ("c", "z", 1, "2024-01")]
    got = stored_after(spark, str(tmp_path / "t"), first, [("a", "z", 2, "2024-02"), ("b", None, 2, "2024-02")], [("c", "x", 0, "2023-12"), ("b", "x", 3, "2024-03")])
    # c is older than what is stored and stays where it is.
    assert got == [("a", "z", 2), ("b", "x", 3), ("c", "z", 1)]


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = tmp_path / "t"
    stored_after(spark, str(path), [("a", "x", 1, "2024-01"), ("b", "y", 1, "2024-01")])
    before = sorted(p.name for p in (path / "part=y").iterdir())
    stored_after(spark, str(path), [("a", "x", 2, "2024-02")])
    assert sorted(p.name for p in (path / "part=y").iterdir()) == before


@pytest.mark.parametrize("null_keys", ["insert", "match", "absent"])
def test_two_source_rows_for_one_key_fail(spark, tmp_path, null_keys):
    target, source = state(spark, ("a", 1, 1, "2024-01")), state(spark, ("a", 2, 2, "2024-02"), ("a", 3, 3, "2024-02"))
    with pytest.raises(Exception, match="share merge key k=a"):
        merge.upsert(target, source, ["k"], UPDATED, "batch_id", null_keys).collect()
    with pytest.raises(Exception, match="share merge key"):
        merge.update_matched(target, source, ["k"], ["v"]).collect()
    twice = [("a", "x", 1, "2024-01"), ("a", "x", 2, "2024-01")]
    with pytest.raises(Exception, match="share merge key"):
        stored_after(spark, str(tmp_path / "t"), twice)
    assert merge.upsert(target, source, ["k"], UPDATED, unique=True).count() == 2


def test_rows_with_null_keys_may_repeat(spark):
    source = state(spark, (None, 2, 2, "2024-02"), (None, 3, 3, "2024-02"))
    assert merge.upsert(state(spark), source, ["k"], UPDATED).count() == 2


def test_work_folder_must_be_shared(spark):
    from cairnlake.session import work_path

    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "spark://cluster:7077"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_path(Session(), "x")


@pytest.mark.parametrize("name", sorted(set(registry.BRONZE) - {"cust_master"}))
def test_two_loads_equal_the_whole(spark, name):
    """Loading early and late months one after the other leaves what all months at once leave."""
    t = registry.Tables(spark, "/root/testdata/sf0.001")
    bronze = t.bronze(name)
    if "batch_id" not in bronze.columns:
        pytest.skip("delivered once")
    months = sorted(r[0] for r in bronze.select("batch_id").distinct().collect())
    middle = months[len(months) // 2]
    early = load_batch(None, bronze.filter(F.col("batch_id") < middle), name)
    both = load_batch(early, bronze.filter(F.col("batch_id") >= middle), name)
    whole = conform(bronze, name)
    assert rows(both.select(*whole.columns)) == rows(whole)


# --- stored tables whose rows keep their partition ------------------------------------------------


KEYED = "id string, value int, parent string, batch_id string"


def keyed_rows(spark, path):
    stored = keyed.read(spark, path, T.StructType.fromDDL(KEYED))
    return sorted(map(tuple, stored.collect()), key=repr)


def load(spark, path, data, **layout):
    return keyed.upsert_keyed(path, spark.createDataFrame(data, KEYED), ["id"], ["value", "parent", "batch_id"], carried=["parent"], **layout)


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*")}


def test_rows_stay_where_they_came_and_untouched_batches_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, [("a", 1, "p", "01"), ("b", 1, "p", "01")], batch="01", guard="batch_id")
    load(spark, path, [("c", 2, "p", "02")], batch="02", guard="batch_id")
    before = files(path)
    changes = load(spark, path, [("c", 3, "q", "03"), ("d", 3, None, "03")], batch="03", guard="batch_id")
    assert keyed_rows(spark, path) == [("a", 1, "p", "01", "01"), ("b", 1, "p", "01", "01"), ("c", 3, "q", "03", "02"), ("d", 3, None, "03", "03")]
    after = files(path)
    assert {f for f in before if "_place=01" in f} == {f for f in after if "_place=01" in f}
    assert all(after[f] == before[f] for f in before if "_place=01" in f)
    assert sorted(map(tuple, changes.select("id", "_old_parent", "_new_parent").collect())) == [("c", "p", "q"), ("d", None, None)]
    assert sorted(r[0] for r in keyed.touched(changes, "parent").collect()) == ["p", "q"]


def test_an_older_batch_changes_nothing_and_rows_without_key_come_once(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, [("a", 2, "p", "02"), (None, 1, "x", "02"), (None, 2, "y", "02")], batch="02", guard="batch_id", unique=True)
    load(spark, path, [("a", 1, "q", "01")], batch="01", guard="batch_id")
    for again in ([(None, 1, "x", "02")], [(None, 1, "x", "02"), ("a", 3, "p", "02")], []):
        load(spark, path, again, batch="02", guard="batch_id", unique=True)
    assert keyed_rows(spark, path) == [("a", 3, "p", "02", "02")]


def test_buckets_replace_the_rows_of_an_entity(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(f"{p}{i}", i, p, "01") for p in "pqr" for i in range(3)]
    load(spark, path, first, buckets=["parent"])
    who = spark.createDataFrame([("p",), ("r",)], "parent string")
    load(spark, path, [("p1", 9, "p", "02"), ("p7", 7, "p", "02")], buckets=["parent"], replaces=("parent", who))
    assert [r[:3] for r in keyed_rows(spark, path)] == [("p1", 9, "p"), ("p7", 7, "p"), ("q0", 0, "q"), ("q1", 1, "q"), ("q2", 2, "q")]


def test_a_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, [(str(i), i, "p", "01") for i in range(50)], buckets=["id"])
    seen = []
    write = merge.replace_partitions
    keyed.replace_partitions = lambda df, *rest: (seen.append(df), write(df, *rest))
    try:
        load(spark, path, [("3", 33, "q", "02")], buckets=["id"])
    finally:
        keyed.replace_partitions = write
    text = plan(seen[0])
    physical = text[text.index("Physical Plan"):]
    assert "SortMergeJoin" not in physical and "BroadcastHashJoin" in physical
    assert physical.count("Exchange hashpartitioning") <= 1  # the one that deals rows to partitions' files


def test_two_rows_for_one_key_fail(spark, tmp_path):
    with pytest.raises(Exception, match="several source rows share merge key"):
        load(spark, str(tmp_path / "t"), [("a", 1, "p", "01"), ("a", 2, "p", "01")], batch="01")


def test_differing_rows(spark):
    old = spark.createDataFrame([("a", 1, "p", "01"), ("b", None, "p", "01"), (None, 1, "p", "01")], KEYED)
    fresh = spark.createDataFrame([("a", 1, "p", "02"), ("b", 2, "p", "01"), ("c", 1, "p", "01"), (None, 1, "p", "01")], KEYED)
    assert sorted(r.id for r in keyed.differing(fresh, old, ["id"], ["value"]).collect()) == ["b", "c"]
    assert sorted(r.id for r in keyed.differing(fresh, old, ["id"]).collect()) == ["a", "b", "c"]
    assert keyed.differing(fresh, None, ["id"]).count() == 4
