import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.plans import layers as P
from tidewater.plans.etl import parse_config, run_etl
from tidewater.session import scratch_dir


def test_parse_config_splits_on_first_equals():
    assert parse_config(["a=b=c", " k = v "]) == {"a": "b=c", "k": "v"}
    with pytest.raises(ValueError):
        parse_config(["novalue"])


def test_run_etl_topics_independent(spark):
    landing = P.land_fixtures(spark, SF_SMALL, P.EVENT_TOPICS)
    out = scratch_dir(spark, "etl_out")
    written = run_etl(spark, landing, out)
    assert set(written) == {"transaction_events", "user_events"}
    tx = spark.read.parquet(written["transaction_events"])
    assert "event_date" in tx.columns and tx.count() > 0
    # a missing topic folder is skipped, the others still run
    empty_root = scratch_dir(spark, "etl_empty")
    assert run_etl(spark, empty_root, scratch_dir(spark, "etl_out2")) == {}


def _land(spark, folder, events):
    spark.createDataFrame([(json.dumps(e) if isinstance(e, dict) else e,) for e in events], "value string").coalesce(1) \
        .write.mode("append").text(folder)


def test_second_landing_of_a_day_keeps_the_first(spark):
    root = scratch_dir(spark, "etl_twice")
    for n in (1, 2):
        _land(spark, f"{root}/landing/user_events", [{"event_id": f"e{n}", "timestamp": "2024-01-02T03:04:05.000000Z"}, "{bad"])
        run_etl(spark, f"{root}/landing", f"{root}/out")
    got = spark.read.parquet(f"{root}/out/user_events")
    assert sorted(r.event_id for r in got.collect()) == ["e1", "e2"]
    assert spark.read.text(f"{root}/out/user_events/_quarantine").count() == 2


def _day(d, **more):
    return {"event_id": f"e{d}", "timestamp": f"2024-01-{d:02d}T00:00:00.000000Z", **more}


def _out(spark, root, topic="user_events"):
    return sorted(r.event_id for r in spark.read.parquet(f"{root}/out/{topic}").collect())


@pytest.mark.parametrize("archive", [False, True])
def test_a_range_keeps_every_row_once(spark, archive):
    """Ten events in one file: a run over two days, then runs without bounds."""
    root = scratch_dir(spark, "etl_range")
    options = {"archive": f"{root}/archive"} if archive else {}
    _land(spark, f"{root}/landing/user_events", [_day(d) for d in range(1, 11)])
    run_etl(spark, f"{root}/landing", f"{root}/out", start="2024-01-03", end="2024-01-04", **options)
    assert _out(spark, root) == sorted(f"e{d}" for d in range(1, 11))
    for _ in range(2):
        run_etl(spark, f"{root}/landing", f"{root}/out", **options)
    assert _out(spark, root) == sorted(f"e{d}" for d in range(1, 11))
    _land(spark, f"{root}/landing/user_events", [_day(d) for d in (3, 20)])
    run_etl(spark, f"{root}/landing", f"{root}/out", **options)
    run_etl(spark, f"{root}/landing", f"{root}/out", start="2024-01-02", **options)
    assert _out(spark, root) == sorted([*(f"e{d}" for d in range(1, 11)), "e20", "e3"])


def test_a_range_is_computed_anew_and_the_rest_stays(spark, monkeypatch):
    from tidewater.plans import etl
    root = scratch_dir(spark, "etl_again")
    _land(spark, f"{root}/landing/user_events", [_day(d) for d in range(1, 6)] + [{"event_id": "undated"}, _day(25), _day(26)])
    run_etl(spark, f"{root}/landing", f"{root}/out")
    before = etl.CLEAN["user_events"]
    monkeypatch.setitem(etl.CLEAN, "user_events", lambda df: before(df).withColumn("page", F.lit("new")).filter("event_id <> 'e4'"))
    for _ in range(2):
        run_etl(spark, f"{root}/landing", f"{root}/out", start="2024-01-03", end="2024-01-05")
    got = {r.event_id: r.page for r in spark.read.parquet(f"{root}/out/user_events").collect()}
    assert got == {"e1": None, "e2": None, "e3": "new", "e5": "new", "e25": None, "e26": None, "undated": None}
    assert _out(spark, root) == sorted(got)  # each once


def test_a_lost_range_run_is_finished_by_the_next(spark, monkeypatch):
    from tidewater.plans import etl
    root = scratch_dir(spark, "etl_lost")
    _land(spark, f"{root}/landing/user_events", [_day(d) for d in range(1, 6)])
    run_etl(spark, f"{root}/landing", f"{root}/out")
    delete = etl._delete
    monkeypatch.setattr(etl, "_delete", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):  # after the overwrite, before the emptied folder went
        run_etl(spark, f"{root}/landing", f"{root}/out", start="2024-01-01")
    monkeypatch.setattr(etl, "_delete", delete)
    run_etl(spark, f"{root}/landing", f"{root}/out", start="2024-01-01")
    assert _out(spark, root) == [f"e{d}" for d in range(1, 6)]


def test_a_broken_rule_fails_the_run(spark, monkeypatch):
    from tidewater.plans import etl
    monkeypatch.setitem(etl.CLEAN, "transaction_events", lambda df: df.withColumn("event_date", df["timestamp"].substr(1, 10).cast("date")))
    root = scratch_dir(spark, "etl_rule")
    _land(spark, f"{root}/landing/transaction_events", [{"transaction_id": "t1", "timestamp": "2024-01-02T00:00:00.000000Z"}] * 2)
    with pytest.raises(Exception, match="output validation failed"):
        run_etl(spark, f"{root}/landing", f"{root}/out")
