"""The batch log's claims and outcomes, audit counts, and what a run rewrites."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path

import pytest

from cairnlake.operators import keyed
from cairnlake.operators.batch_log import BatchLog, NotInProgress, landed_batches
from cairnlake.operators.clean import AuditTrail
from cairnlake.plans import batches
from cairnlake.plans.silver import conform, customer_batches
from cairnlake.sources.feeds import FEEDS


def statuses(log):
    return sorted(map(tuple, log.attempts().select("batch_id", "attempt", "status").collect()))


def test_one_of_many_claims_wins(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"))
    with ThreadPoolExecutor(8) as pool:
        won = [n for n in pool.map(lambda _: log.claim("2024-01"), range(8)) if n is not None]
    assert won == [1] and statuses(log) == [("2024-01", 1, "in-progress")]
    assert log.claim("2024-01") is None


def test_attempts_stay_visible_and_only_a_running_one_changes(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"))
    assert log.claim("2024-01") == 1
    log.finish_step("2024-01", 1, "bronze", {"rows": 3})
    log.fail("2024-01", 1, "no space")
    with pytest.raises(NotInProgress):
        log.complete("2024-01", 1)
    assert log.finished_steps("2024-01") == {"bronze"}
    assert log.claim("2024-01") == 2
    log.complete("2024-01", 2)
    assert statuses(log) == [("2024-01", 1, "failed"), ("2024-01", 2, "completed")]
    assert log.states().first()["error_message"] is None
    assert log.attempts().filter("attempt = 1").first()["error_message"] == "no space"
    # Done is done, unless the files were delivered again; then all steps count anew.
    assert log.claim("2024-01") is None and log.claim("2024-01", again=True) == 3
    assert log.finished_steps("2024-01") == set()


def test_next_batch_is_the_oldest_not_taken(spark, tmp_path):
    lake = batches.Lake(spark, str(tmp_path / "landing"), str(tmp_path / "lake"))
    for name in ("2024-02", "2024-01", "2024-03"):
        (Path(lake.landing) / name).mkdir(parents=True)
    assert sorted(r[0] for r in landed_batches(spark, lake.landing).collect()) == ["2024-01", "2024-02", "2024-03"]
    assert batches.next_batch(lake) == "2024-01"
    lake.log.claim("2024-01")
    assert batches.next_batch(lake) == "2024-02"
    lake.log.fail("2024-01", 1, "broken file")
    assert batches.next_batch(lake) == "2024-01"


def test_a_failed_step_is_taken_up_again_behind_the_finished_ones(spark, tmp_path, monkeypatch):
    lake = batches.Lake(spark, str(tmp_path / "landing"), str(tmp_path / "lake"))
    (Path(lake.landing) / "2024-01").mkdir(parents=True)
    ran, broken = [], [True]

    def step(name):
        def run(lake, batch, attempt, names):
            ran.append((name, attempt))
            if name == "gold" and broken.pop():
                broken.append(False)
                raise ValueError("gold broke")
            return {"n": 1}

        return name, run

    monkeypatch.setattr(batches, "STEPS", [step(n) for n in ("bronze", "silver", "gold", "checks")])
    with pytest.raises(ValueError, match="gold broke"):
        batches.run_batches(lake, ())
    assert batches.run_batches(lake, ()) == ["2024-01"]
    assert ran == [("bronze", 1), ("silver", 1), ("gold", 1), ("gold", 2), ("checks", 2)]
    assert statuses(lake.log) == [("2024-01", 1, "failed"), ("2024-01", 2, "completed")]
    assert not batches.run_batch(lake, "2024-01", ())


def bronze(spark, name, rows):
    feed = FEEDS[name]
    delivered = spark.createDataFrame(rows, feed.struct)
    return delivered.selectExpr("*", "current_timestamp() AS ingestion_timestamp", "'f' AS source_file", "'2024-01' AS batch_id")


def test_audit_counts_come_with_the_load_and_no_further_job(spark, tmp_path):
    rows = [("A1", "1", "s", "2", "p", "SHIP_TO"), ("A1", "1", "t", "2", "p", "SHIP_TO"), (None, "2", "s", "2", "p", "SHIP_TO"), ("A2", None, "s", "2", "p", "BILL_TO")]
    trail, plain = AuditTrail(), bronze(spark, "address", rows)
    tracker = spark.sparkContext.statusTracker()

    def jobs(group, df):
        spark.sparkContext.setJobGroup(group, group)
        df.write.mode("overwrite").parquet(str(tmp_path / group))
        return len(tracker.getJobIdsForGroup(group))

    counted = jobs("audited", conform(plain, "address", trail))
    assert trail.counts() == {"delivered": 4, "with_keys": 2, "kept": 1}
    assert counted == jobs("plain", conform(plain, "address"))


def test_audit_counts_of_customers(spark):
    schema = FEEDS["cust_master"].struct
    row = lambda i, day: tuple({"CUST_ID": i, "CREATED_DT": day}.get(f.name) for f in schema.fields)
    trail = AuditTrail()
    customer_batches(bronze(spark, "cust_master", [row("1", date(2020, 1, 1)), row("1", date(2021, 1, 1)), row("2", None)]), trail=trail).count()
    assert trail.counts() == {"delivered": 3, "with_keys": 2, "kept": 1}


def test_upsert_of_a_batch_asks_nothing_it_knows(spark, tmp_path):
    tracker, path = spark.sparkContext.statusTracker(), str(tmp_path / "t")

    def load(batch, rows):
        spark.sparkContext.setJobGroup(batch, batch)
        try:
            changes = keyed.upsert_keyed(path, spark.createDataFrame(rows, "k string, v int"), ["k"], ["v"], batch=batch, unique=True, carried=["v"])
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return sorted(tuple(r) for r in changes.select("k", "_old_v", "_new_v").collect()), len(tracker.getJobIdsForGroup(batch))

    assert load("upsert-1", [("a", 1), ("b", 2)])[0] == [("a", None, 1), ("b", None, 2)]
    # 16 with the question where the batch's new keys go.
    changes, jobs = load("upsert-2", [("b", 3), ("c", 4)])
    assert changes == [("b", 2, 3), ("c", None, 4)] and jobs <= 14
    stored = spark.read.parquet(path).select("k", "v", "_place").collect()
    assert sorted(tuple(r) for r in stored) == [("a", 1, "upsert-1"), ("b", 3, "upsert-1"), ("c", 4, "upsert-2")]
