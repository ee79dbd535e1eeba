"""Dashboard argument domains (F9) and metric semantics (A2-A5, L1-L4)."""

import datetime as dt

import pytest

from ferrule.operators import metrics as M

FACT_DDL = "discount_code string, orders bigint, revenue double, order_date date, client_name string"


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT_DDL)


D = dt.date


@pytest.mark.parametrize("kwargs,msg", [
    (dict(domain="nope"), "domain"),
    (dict(domain="adscribe"), "required"),
    (dict(domain="client_upload", start_date="2024-13-01"), "YYYY-MM-DD"),
    (dict(domain="client_upload", start_date="2024-02-01", end_date="2024-01-01"), "is after"),
    (dict(domain="client_upload", client="delta"), "client"),
])
def test_predicate_validation(kwargs, msg):
    with pytest.raises(M.ValidationError, match=msg):
        M.dashboard_predicate(**kwargs)


def test_other_validation():
    with pytest.raises(M.ValidationError):
        M.parse_pagination(0, 0)
    with pytest.raises(M.ValidationError):
        M.parse_pagination(501, 0)
    with pytest.raises(M.ValidationError):
        M.parse_pagination(10, -1)
    with pytest.raises(M.ValidationError):
        M.parse_top_n(0)
    with pytest.raises(M.ValidationError):
        M.parse_sort_by("bogus", "client_upload")
    with pytest.raises(M.ValidationError):
        M.parse_dimension("show", "client_upload")
    assert M.parse_dimension("show", "adscribe") == "show_name"
    assert M.parse_domain(" ASCRIBE ") == "adscribe"
    assert M.parse_pagination(None, None) == (50, 0)


def test_kpi_one_row_on_empty(spark):
    out = M.kpi(fact(spark, []), "client_upload", client="alpha").collect()
    assert [tuple(r) for r in out] == [(0.0, 0)]


def test_breakdown_unknown_and_topn(spark):
    f = fact(spark, [("a", 1, 10.0, D(2024, 1, 1), "alpha"), (None, 2, 30.0, D(2024, 1, 1), "alpha"),
                     ("b", 3, 20.0, D(2024, 1, 2), "alpha")])
    rows = [tuple(r) for r in M.breakdown(f, "client_upload", "discount_code", top_n=2).collect()]
    assert rows == [("UNKNOWN", 30.0, 2, None), ("b", 20.0, 3, None)]
    old = [tuple(r) for r in M.breakdown(f, "client_upload", "discount_code", null_label=None).collect()]
    assert old[0] == (None, 30.0, 2)


def test_details_nulls_first_on_desc_and_paging(spark):
    f = fact(spark, [("a", 1, 10.0, D(2024, 1, 1), "alpha"), ("b", 1, 11.0, None, "alpha"),
                     ("c", 1, None, D(2024, 1, 3), "alpha")])
    rows = M.details(f, "client_upload", sort_by="date", sort_order="desc", limit=2, offset=0).collect()
    assert [r.discount_code for r in rows] == ["b", "c"]
    rows = M.details(f, "client_upload", sort_by="revenue", sort_order="asc", limit=5, offset=1).collect()
    # revenue sorts by the null-as-zero output value
    assert [r.discount_code for r in rows] == ["a", "b"]


def test_monthly_label(spark):
    f = fact(spark, [("a", 1, 1.25, D(2024, 1, 31), "beta"), ("a", 1, 2.5, D(2024, 2, 1), "beta")])
    rows = [tuple(r) for r in M.revenue_monthly(f, "client_upload", client="beta").collect()]
    assert rows == [("2024-01", 1.25), ("2024-02", 2.5)]


def test_money_keeps_small_amounts_and_survives_large_ones(spark):
    small = [("a", 1, 0.004, D(2024, 1, 1), "alpha")] * 1000
    assert M.kpi(fact(spark, small), "client_upload").first().total_revenue == 4.0
    large = small + [("a", 1, 1e25, D(2024, 1, 1), "alpha"), ("a", 1, None, D(2024, 1, 1), "alpha")]
    assert M.kpi(fact(spark, large), "client_upload").first().total_revenue == 1e25
    odd = [("a", 1, float("inf"), D(2024, 1, 1), "alpha"), ("a", 1, 1.0, D(2024, 1, 1), "alpha")]
    assert M.kpi(fact(spark, odd), "client_upload").first().total_revenue == float("inf")


@pytest.mark.parametrize("sort_by", ["date", "revenue", "client"])
@pytest.mark.parametrize("order", ["asc", "desc"])
def test_pages_after_a_key_are_the_pages_by_offset(spark, sort_by, order):
    rows = [(f"c{k}", k, None if k % 7 == 0 else float(k % 5), None if k % 6 == 0 else D(2024, 1, 1 + k % 3),
             ("alpha", "beta")[k % 2]) for k in range(30)]
    f = fact(spark, rows)
    end = None
    for page in range(4):
        want = M.details(f, sort_by=sort_by, sort_order=order, limit=8, offset=8 * page).collect()
        got = M.details(f, sort_by=sort_by, sort_order=order, limit=8, after=end, keyed=True)
        rows = got.collect()
        assert got.drop("page_key").columns == list(want[0].asDict()) and [r[:-1] for r in map(tuple, rows)] == [tuple(r) for r in want]
        end = M.page_end(rows, end)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 14])
@pytest.mark.parametrize("order", ["asc", "desc"])
def test_pages_give_tied_rows_once_each(spark, size, order):
    """Six rows equal in every column, four equal in the keys alone, and others."""
    same = [("c", 1, 2.0, D(2024, 1, 2), "alpha")] * 6
    close = [("c", k, 2.0, D(2024, 1, 2), "alpha") for k in (2, 3, None)] + [("c", 1, None, D(2024, 1, 2), "alpha")]
    rows = [("b", 1, 1.0, None, "beta"), *same, *close, ("d", 1, 1.0, D(2024, 1, 3), "alpha"), ("a", 1, 9.0, D(2024, 1, 1), "beta")]
    f = fact(spark, rows).repartition(3)
    seen, end = [], None
    for _ in range(len(rows) + 1):
        page = M.details(f, sort_order=order, limit=size, after=end, keyed=True).collect()
        seen += [tuple(r)[:-1] for r in page]
        end = M.page_end(page, end)
        if len(page) < size:
            break
    assert len(seen) == len(rows)
    want = [tuple(r) for r in M.details(f, sort_order=order, limit=500).collect()]
    assert seen == want and M.page_end([], None) is None
