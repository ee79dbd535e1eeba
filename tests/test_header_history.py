"""Headers as they came, and drift against the last accepted one."""

from pyspark.sql import functions as F

from ferrule.operators import header_history as H


def _seen(spark, rows):
    return spark.createDataFrame(rows, "client_name string, day string, file string, header string")


def _drift(df):
    return {(r.client_name, r.day, tuple(r.columns)): (r.status, r.extra_columns, r.missing_columns, r.accepted, r.files) for r in df.collect()}


def test_header_lines(spark):
    lines = ['b, A ,"x, y"', '"say ""hi""",b,b,', "", " only "]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, h string").select("i", H.header_columns(F.col("h")).alias("c"))
    assert {r.i: r.c for r in got.collect()} == {0: ["a", "b", "x, y"], 1: ["b", 'say "hi"'], 2: [], 3: ["only"]}


def test_drift_is_against_the_last_accepted_header(spark):
    rows = [("a", "2024-01-01", "1", "id,v"), ("a", "2024-01-02", "2", "V,id"), ("a", "2024-01-03", "3", "id,v,extra"),
            ("a", "2024-01-04", "4", "v,extra"),                                  # lacks id: not accepted, not handed on
            ("a", "2024-01-05", "5", "id,v,extra"), ("a", "2024-01-05", "6", "id,v,extra"), ("a", "2024-01-05", "7", "id"),
            ("a", "2024-01-06", "8", "id"), ("b", "2024-01-03", "9", "z")]
    got = _drift(H.header_drift(H.fold_headers(_seen(spark, rows), {"a": ["ID "]})))
    assert got == {
        ("a", "2024-01-01", ("id", "v")): ("first", [], [], True, 1),
        ("a", "2024-01-02", ("id", "v")): ("same", [], [], True, 1),
        ("a", "2024-01-03", ("extra", "id", "v")): ("changed", ["extra"], [], True, 1),
        ("a", "2024-01-04", ("extra", "v")): ("changed", [], ["id"], False, 1),
        ("a", "2024-01-05", ("extra", "id", "v")): ("same", [], [], True, 2),
        ("a", "2024-01-05", ("id",)): ("changed", [], ["extra", "v"], True, 1),
        ("a", "2024-01-06", ("id",)): ("changed", [], ["extra", "v"], True, 1),
        ("b", "2024-01-03", ("z",)): ("first", [], [], True, 1)}


def test_a_retried_day_is_replaced(spark, tmp_path):
    path = str(tmp_path / "history")
    for rows in ([("a", "2024-01-01", "1", "id,v"), ("a", "2024-01-02", "2", "id")], [("a", "2024-01-02", "2", "id,w")]):
        H.write_headers(H.fold_headers(_seen(spark, rows), {}), path)
    assert sorted((r.day, r.columns) for r in H.read_headers(spark, path).collect()) == [("2024-01-01", ["id", "v"]), ("2024-01-02", ["id", "w"])]


def test_headers_of_files(spark, tmp_path):
    for client, day, text in (("a", "1", "x,y\n1,2\n"), ("a", "2", "x,y,z"), ("b", "1", "")):
        folder = tmp_path / f"client={client}" / f"day={day}"
        folder.mkdir(parents=True)
        (folder / "f.csv").write_text(text)
    (tmp_path / "client=a" / "stray").mkdir()
    (tmp_path / "client=a" / "stray" / "f.csv").write_text("q\n")
    seen = H.observe_headers(spark, [f"{tmp_path}/*/*"], "client=([^/]+)", "day=([^/]+)")
    assert sorted((r.client_name, r.day, r.header) for r in seen.collect()) == [("a", "1", "x,y"), ("a", "2", "x,y,z")]
    assert H.header_drift(H.fold_headers(_seen(spark, []), {})).count() == 0
