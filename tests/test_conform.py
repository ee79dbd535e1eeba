"""Final schema: values that do not fit go to quarantine, the load goes on."""

from ferrule.functions.clean import date_shape
from ferrule.operators.conform import conform_final, enforce_final_schema
from ferrule.plans.load_queries import load


def test_misfits_are_named_and_the_rest_stays(spark):
    df = spark.createDataFrame([("a", 2.9, "2024-01-02", 1.0), ("b", 1e20, "2024-01-02", 2.0), ("c", 1.0, "junk", 3.0),
                                ("d", None, None, None)], "discount_code string, orders double, date string, revenue double")
    good = enforce_final_schema(df, "alpha", "L1", "2024-01-31")
    assert sorted((r.discount_code, r.orders) for r in good.collect()) == [("a", 2), ("d", 0)]
    reasons = {r.discount_code: r.quarantine_reasons for r in conform_final(df, "alpha", "L1", "2024-01-31").collect()}
    assert reasons == {"a": [], "b": ["not_bigint:orders"], "c": ["not_date:order_date"], "d": []}


def test_a_load_has_no_misfits_of_its_own(spark, sf):
    r = load(spark, sf, "gamma")
    assert r.misfits.count() == 0 and r.processed.count() == r.aggregated.count()


def test_date_shapes():
    import re

    assert re.match(date_shape("yyyy-MM-dd"), "2024-01-31") and not re.match(date_shape("yyyy-MM-dd"), "01/31/2024")
    assert re.match(date_shape("M/d/yyyy"), "1/5/2024") and date_shape("MMM d, yyyy") is None
