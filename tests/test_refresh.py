"""Idempotent refresh (W1-W5): applying twice equals applying once; in-range
deletion; undated rows survive."""

import datetime as dt

from ferrule.operators import refresh as R

D = dt.date
FACT_DDL = "discount_code string, orders bigint, revenue double, order_date date, client_name string"


def srt(items):
    return sorted(items, key=lambda t: tuple((x is None, str(x)) for x in t))


def rows(df):
    return srt(tuple(r) for r in df.collect())


def test_refresh_by_load_semantics_and_idempotency(spark):
    fact = spark.createDataFrame([
        ("a", 1, 1.0, D(2024, 1, 1), "alpha"), ("a", 1, 2.0, D(2024, 1, 2), "alpha"),
        ("a", 1, 3.0, D(2024, 1, 3), "alpha"), ("a", 1, 4.0, None, "alpha"),
        ("a", 1, 5.0, D(2024, 1, 2), "beta")], FACT_DDL)
    load = spark.createDataFrame([("a", 9, 9.0, D(2024, 1, 1), "alpha"), ("a", 9, 9.5, D(2024, 1, 3), "alpha")],
                                 FACT_DDL)
    once = R.refresh_by_load(fact, load)
    got = rows(once)
    # the in-range day 2024-01-02 without new rows is gone for alpha; beta and undated rows stay
    assert ("a", 1, 2.0, D(2024, 1, 2), "alpha") not in got
    assert ("a", 1, 4.0, None, "alpha") in got and ("a", 1, 5.0, D(2024, 1, 2), "beta") in got
    twice = R.refresh_by_load(spark.createDataFrame(once.collect(), FACT_DDL), load)
    assert rows(twice) == got


def test_refresh_survivors_is_an_equi_join_left_to_aqe(spark):
    """Joined on the client with the dates as a condition, never a nested loop, and without a hint."""
    fact = spark.createDataFrame([("a", 1, 1.0, D(2024, 1, 1), "alpha")], FACT_DDL)
    from tests.plan_utils import plan_text
    text = plan_text(R.refresh_survivors(fact, fact))
    assert "Join" in text and "NestedLoop" not in text and "Cartesian" not in text
    assert "ResolvedHint" not in plan_text(R.refresh_survivors(fact, fact), "extended")


def test_refresh_window_idempotent(spark):
    ddl = "date date, source_type string, revenue double"
    fact = spark.createDataFrame([(D(2024, 1, 1), "adscribe", 1.0), (D(2024, 1, 5), "adscribe", 2.0),
                                  (D(2024, 1, 5), "other", 3.0), (None, "adscribe", 4.0)], ddl)
    stage = spark.createDataFrame([(D(2024, 1, 5), "adscribe", 20.0), (D(2024, 2, 1), "adscribe", 99.0)], ddl)
    once = R.refresh_window(fact, stage, "adscribe", "2024-01-02", "2024-01-31")
    got = rows(once)
    assert (D(2024, 2, 1), "adscribe", 99.0) not in got            # K23: outside the window, not inserted
    assert (D(2024, 1, 5), "adscribe", 2.0) not in got
    assert (None, "adscribe", 4.0) in got
    twice = R.refresh_window(spark.createDataFrame(once.collect(), ddl), stage, "adscribe", "2024-01-02",
                             "2024-01-31")
    assert rows(twice) == got


def test_stage_replace_and_cleanup(spark):
    ddl = "x bigint, load_id string"
    staging = spark.createDataFrame([(1, "L1"), (2, "L2"), (3, None)], ddl)
    new = spark.createDataFrame([(10, "ignored")], ddl)
    once = R.stage_replace_load(staging, new, "L1")
    assert rows(once) == srt([(2, "L2"), (3, None), (10, "L1")])
    assert rows(R.stage_replace_load(spark.createDataFrame(once.collect(), ddl), new, "L1")) == rows(once)
    assert rows(R.stage_cleanup(once, "L1")) == srt([(2, "L2"), (3, None)])
