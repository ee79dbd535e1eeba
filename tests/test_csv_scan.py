"""CSV lines: good ones as columns, bad ones with text, file and reason."""

import csv
import gzip
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrule.sources import sinks as S
from ferrule.sources.folders import first_lines


def _scan(spark, path, **options):
    good, bad = S.scan_csv(spark, str(path), **options)
    return [tuple(r) for r in good.collect()], sorted((r.source_key.rsplit("/", 1)[-1], r.line, r.reason) for r in bad.collect())


def test_every_line_is_good_or_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n4,5,6\n3\n"7,8\na,"b\n"a,b",c\n"p\\"q",2\na"b,c\n\n1,2\n ,\n')
    good, bad = _scan(spark, tmp_path)
    assert sorted(good, key=str) == sorted([("a,b", "c"), ('p"q', "2"), ('a"b', "c"), ("1", "2"), (" ", None)], key=str)
    assert bad == [("a.csv", '"7,8', "broken_quote"), ("a.csv", "3", "too_few_fields"), ("a.csv", "4,5,6", "too_many_fields"),
                   ("a.csv", 'a,"b', "broken_quote")]


def test_files_have_their_own_headers_and_widths(spark, tmp_path):
    (tmp_path / "1.csv").write_text('"x, y",z\r\n1,"say ""hi"""\r\n1,2,3\r\n')
    (tmp_path / "2.csv").write_text("z\n9\nz\n8,8\n")
    with gzip.open(tmp_path / "3.csv.gz", "wt") as f:
        f.write("z,w\n5,6\n5\n")
    (tmp_path / "4.csv").write_text("")
    good, bad = S.scan_csv(spark, str(tmp_path), ["v"], quote_escape='"')
    assert set(good.columns) == {"x, y", "z", "w", "v"}
    assert sorted(str((r["x, y"], r["z"], r["w"], r["v"])) for r in good.collect()) == sorted(map(str, [
        ("1", 'say "hi"', None, None), (None, "9", None, None), (None, "5", "6", None)]))
    assert sorted((r.line, r.reason) for r in bad.collect()) == [("1,2,3", "too_many_fields"), ("5", "too_few_fields"), ("8,8", "too_many_fields")]


def test_no_files(spark, tmp_path):
    (tmp_path / "4.csv").write_text("")
    good, bad = S.scan_csv(spark, str(tmp_path), ["v"])
    assert good.columns == ["v"] and good.collect() == bad.collect() == []


def test_only_first_lines_are_read_for_headers(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f"h{k % 2},b\n" + "1,2\n" * 10)
    (tmp_path / "_SUCCESS").write_text("")
    group = "headers-only"
    spark.sparkContext.setJobGroup(group, group)
    found = S.file_headers(spark, [f"{tmp_path}/*.csv"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(f) for h, f in found.items()} == {"h0,b": 2, "h1,b": 1}
    assert first_lines(spark, [str(tmp_path)], most=2) is None


@pytest.mark.parametrize("escape", ['"', "\\"])
def test_written_lines_are_never_rejected(spark, tmp_path_factory, escape):
    """Whatever a CSV writer writes on one line is good and reads back as it was."""
    value = st.text(alphabet='ab,"\' é', max_size=8)
    rows = []

    @given(st.lists(st.tuples(value, value, value), min_size=1, max_size=20))
    @settings(max_examples=30, deadline=None)
    def gather(found):
        rows.extend(found)

    gather()
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, doublequote=escape == '"', escapechar=None if escape == '"' else "\\", lineterminator="\n")
    writer.writerows([("x", "y", "z"), *rows])
    path = tmp_path_factory.mktemp("written") / "w.csv"
    path.write_text(out.getvalue())
    good, bad = _scan(spark, path, quote_escape=escape)
    assert bad == []
    assert sorted(tuple(v or "" for v in r) for r in good) == sorted(rows)
