"""Sessions that arrive behind their vehicle's last one."""

import pytest
from pyspark.sql import functions as F

from evrange.operators import average
from evrange.operators.pairing import SESSION_ORDER
from evrange.plans import retraction
from evrange.plans.job import endurance_pairs, scored_pairs
from evrange.plans.run import latest_snapshot, run_daily
from evrange.schemas import TASK_INFO

from helpers import session, sessions, tables
from test_run import ALWAYS, _places, _result, _two_days

LATE = ("0-0", "1-2", "1-3", "late-0")   # a vehicle's first, two in the middle, one before a lone one


def _state(df):
    return sorted(tuple(r) for r in df.where("sum_run_mileage IS NOT NULL").select(average.STATE_COLUMNS).collect())


def _late(spark, dated=False):
    data, battery = _two_days(spark)
    if dated:
        data = data.withColumn("sample_date", F.to_date("start_time"))
    in_time = data.where((F.col("start_time") < "2024-01-02 12:00") & ~F.col("id").isin(*LATE))
    return data, in_time, battery, spark.createDataFrame([], TASK_INFO)


def _check(spark, places, data, battery, mode):
    assert _result(spark.read.parquet(places[0])) == _result(endurance_pairs(data, battery, mode=mode))
    state = latest_snapshot(spark, places[1], "2024-02-01")[2]
    assert _state(state) == _state(average.next_state(scored_pairs(data, battery, mode=mode), SESSION_ORDER, None, mode))


@pytest.mark.parametrize("mode, late_days", [("seed", None), ("cumulative", 1)])
def test_late_and_in_order_runs_are_equal(spark, tmp_path, mode, late_days):
    data, in_time, battery, none = _late(spark, dated=late_days is not None)
    places, options = _places(tmp_path), dict(mode=mode, late_days=late_days, retract=True, **ALWAYS)
    run_daily(in_time, battery, none, "2024-01-02", *places, **options)
    run_daily(data, battery, none, "2024-01-03", *places, **options)
    _check(spark, places, data, battery, mode)
    # from the older snapshot again, whose averages of those vehicles are stale
    run_daily(data, battery, none, "2024-01-03", *places, **options)
    _check(spark, places, data, battery, mode)
    # nothing is late any more
    run_daily(data, battery, none, "2024-01-04", *places, **options)
    _check(spark, places, data, battery, mode)


@pytest.mark.parametrize("killed", ["finish", "append_new"])
def test_a_killed_retraction_is_finished_by_the_next_run(spark, tmp_path, monkeypatch, killed):
    data, in_time, battery, none = _late(spark)
    places, options = _places(tmp_path), dict(mode="cumulative", retract=True, **ALWAYS)
    run_daily(in_time, battery, none, "2024-01-02", *places, **options)
    real = getattr(retraction, killed)
    with monkeypatch.context() as broken:
        def die(*args, **named):
            if killed == "finish" and "since" not in named:
                return real(*args, **named)
            raise KeyboardInterrupt
        broken.setattr(retraction, killed, die)
        with pytest.raises(KeyboardInterrupt):
            run_daily(data, battery, none, "2024-01-03", *places, **options)
    run_daily(data, battery, none, "2024-01-04", *places, **options)
    _check(spark, places, data, battery, "cumulative")


def test_retraction_needs_all_periods_and_is_a_choice(spark, tmp_path):
    data, in_time, battery, none = _late(spark)
    with pytest.raises(ValueError, match="all_periods"):
        run_daily(data, battery, none, "2024-01-02", *_places(tmp_path), retract=True)
    places = _places(tmp_path)
    run_daily(sessions(spark, [session("a", 0), session("c", 9, mileage=190.0)]), tables(spark), none, "2024-01-02", *places, **ALWAYS)
    three = sessions(spark, [session("a", 0), session("b", 3, mileage=150.0), session("c", 9, mileage=190.0)])
    pairs = lambda: sorted((r.last_time_record_id, r.this_time_record_id) for r in spark.read.parquet(places[0]).collect())
    run_daily(three, tables(spark), none, "2024-01-03", *places, **ALWAYS)
    assert pairs() == [("a", "c")]
    run_daily(three, tables(spark), none, "2024-01-04", *places, retract=True, **ALWAYS)
    assert pairs() == [("a", "b"), ("b", "c")]
