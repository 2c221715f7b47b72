import random

import pytest
from pyspark.sql import functions as F

from cairnlake.operators import merge, scd2
from tests.conftest import rows

SCHEMA = "id string, segment string, city string, manager string, batch_id string"
TRACKED = ["segment", "city"]
MONTHS = [f"2024-{m:02d}" for m in range(1, 8)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def stepwise(spark, data):
    by_month = sorted({d[-1] for d in data})
    out = None
    for month in by_month:
        batch = frame(spark, [d for d in data if d[-1] == month])
        if out is None:
            out = scd2.open_versions(batch, TRACKED, scd2.batch_start())
        else:
            out = scd2.merge_versions(out, batch, "id", TRACKED)
    return out


def random_feed(seed):
    rng = random.Random(seed)
    return [
        (str(i), rng.choice(["A", "B", None]), rng.choice(["x", ""]), f"m{rng.randrange(4)}", month)
        for i in range(12)
        for month in MONTHS
        if rng.random() < 0.7
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stepwise_equals_set_based_and_periods_tile(spark, seed):
    data = random_feed(seed)
    whole = scd2.history(frame(spark, data), "id", TRACKED)
    assert rows(stepwise(spark, data).select(*whole.columns)) == rows(whole)
    by_id = {}
    for r in whole.collect():
        by_id.setdefault(r.id, []).append(r)
    for versions in by_id.values():
        versions.sort(key=lambda r: r.valid_from)
        assert [v.is_current for v in versions] == [False] * (len(versions) - 1) + [True]
        assert [v.valid_to for v in versions[:-1]] == [v.valid_from for v in versions[1:]]
        assert versions[-1].valid_to is None
    assert scd2.overlapping_versions(whole, "id").isEmpty()


def test_return_to_an_earlier_value_makes_three_versions(spark):
    data = [("1", s, "x", "m", m) for s, m in zip("ABA", MONTHS)]
    assert scd2.history(frame(spark, data), "id", TRACKED).count() == 3
    assert stepwise(spark, data).count() == 3


def test_untracked_change_overwrites_in_place(spark):
    data = [("1", "A", "x", "old", "2024-01"), ("1", "A", "x", "new", "2024-03")]
    (version,) = stepwise(spark, data).collect()
    assert (version.manager, str(version.valid_from), version.is_current) == ("new", "2024-01-01", True)


def test_null_differs_from_empty_text(spark):
    data = [("1", None, "x", "m", "2024-01"), ("1", "", "x", "m", "2024-02")]
    assert scd2.history(frame(spark, data), "id", TRACKED).count() == 2


def test_running_a_batch_again(spark):
    base = stepwise(spark, [("1", "A", "x", "m", "2024-01"), ("1", "B", "x", "m", "2024-02")])
    same = frame(spark, [("1", "B", "x", "m", "2024-02")])
    assert rows(scd2.merge_versions(base, same, "id", TRACKED)) == rows(base)
    # Corrected delivery of the same month: no version of length zero appears.
    fixed = scd2.merge_versions(base, frame(spark, [("1", "C", "x", "m", "2024-02")]), "id", TRACKED)
    assert rows(fixed, "segment", "valid_from", "is_current") == rows(
        base.withColumn("segment", F.when(F.col("segment") == "B", "C").otherwise(F.col("segment"))),
        "segment", "valid_from", "is_current",
    )


def test_late_batch_and_missing_key_change_nothing(spark):
    base = stepwise(spark, [("1", "A", "x", "m", "2024-03"), ("2", "A", "x", "m", "2024-03")])
    late = frame(spark, [("1", "Z", "x", "z", "2024-01")])
    assert rows(scd2.merge_versions(base, late, "id", TRACKED)) == rows(base)


def test_overlap_is_found(spark):
    data = [("1", "2024-01-01", "2024-03-01"), ("1", "2024-02-01", None), ("2", "2024-01-01", None)]
    versions = spark.createDataFrame(data, "id string, f string, t string").select(
        "id", F.to_date("f").alias("valid_from"), F.to_date("t").alias("valid_to")
    )
    assert rows(scd2.overlapping_versions(versions, "id"), "id") == [("1",)]


def test_backfill(spark):
    out = scd2.backfill(frame(spark, [("1", "A", "x", "m", "2024-01")]), TRACKED, "2024-08-01")
    (r,) = out.collect()
    assert (str(r.valid_from), r.valid_to, r.is_current, len(r.row_hash)) == ("2024-08-01", None, True, 64)


def test_stored_history_equals_set_based(spark, tmp_path):
    data, path = random_feed(5), str(tmp_path / "versions")
    for month in [*MONTHS, MONTHS[-1]]:
        scd2.merge_stored(path, frame(spark, [d for d in data if d[-1] == month]), "id", TRACKED)
    whole = scd2.history(frame(spark, data), "id", TRACKED)
    assert rows(merge.stored(spark, path, whole.schema)) == rows(whole)


def deliveries(seed):
    """Months in order; the newest one may arrive several times, each time with other changes."""
    rng = random.Random(seed)
    for month in MONTHS:
        for _ in range(rng.choice([1, 2, 3])):
            yield [(k, rng.choice("AB"), "x", rng.choice("mn"), month) for k in "12345" if rng.random() < 0.8]


@pytest.mark.parametrize("seed", range(4))
def test_redelivered_month_stored_stepwise_and_set_based(spark, tmp_path, seed):
    path, latest, state = str(tmp_path / "versions"), {}, None
    for data in deliveries(seed):
        if not data:
            continue
        batch = frame(spark, data)
        latest |= {(d[0], d[-1]): d for d in data}
        scd2.merge_stored(path, batch, "id", TRACKED)
        if state is None:
            state = scd2.open_versions(batch, TRACKED, scd2.batch_start())
        else:
            state = spark.createDataFrame(scd2.merge_versions(state, batch, "id", TRACKED).collect(), state.schema)
    whole = scd2.history(frame(spark, list(latest.values())), "id", TRACKED)
    # A version closed by the correction may keep untracked values of the delivery it corrects.
    compared = ["id", *TRACKED, *scd2.VERSION_COLUMNS]
    assert rows(merge.stored(spark, path, whole.schema), *compared) == rows(whole, *compared)
    assert rows(state, *compared) == rows(whole, *compared)


def test_correction_keeps_versions_that_others_closed(spark, tmp_path):
    path = str(tmp_path / "versions")
    for a, b, month in (("s1", "s1", "2024-01"), ("s2", "s1", "2024-02"), ("s2", "s2", "2024-02")):
        scd2.merge_stored(path, frame(spark, [("A", a, "x", "m", month), ("B", b, "x", "m", month)]), "id", TRACKED)
    schema = scd2.open_versions(frame(spark, [("A", "s1", "x", "m", "2024-01")]), TRACKED, scd2.batch_start()).schema
    found = merge.stored(spark, path, schema)
    assert rows(found.groupBy("id").count()) == [("A", 2), ("B", 2)]


def test_key_twice_in_a_batch_fails(spark):
    batch = frame(spark, [("1", "A", "x", "m", "2024-01"), ("1", "B", "x", "m", "2024-01")])
    with pytest.raises(Exception, match="share merge key"):
        scd2.merge_versions(scd2.history(batch.limit(0), "id", TRACKED), batch, "id", TRACKED).collect()
