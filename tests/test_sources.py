import json
import os

import pandas as pd
import pytest

from checks.sources import workbook_bytes
from tabulon.sources import delimited as D
from tabulon.sources import reports
from tabulon.sources.tables import read_table, write_table
from tabulon.sources.workbook import read_workbooks

MESSY = "A;B\nñandú;1\nx;2;extra\nshort\n;4\n\"q;uoted\";5\nz;6;\nNA;abc\n\"say \"\"hi\"\"\";7\n"


@pytest.fixture()
def messy(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_bytes(MESSY.encode("latin1"))
    return str(folder)


def test_tolerant_scan(spark, messy):
    df = D.read_delimited(spark, messy, "A string, B double")
    want = {("ñandú", 1.0), ("short", None), (None, 4.0), ("q;uoted", 5.0), (None, None),
            ('say "hi"', 7.0)}
    assert {tuple(r) for r in df.collect()} == want
    # The judgement of a line does not depend on the columns a query asks for.
    assert df.count() == 6 and df.select("B").count() == 6
    assert {r["A"] for r in df.select("A").collect()} == {w[0] for w in want}
    assert df.filter("B = 5").count() == 1


def test_rejects(spark, messy):
    out = D.read_rejects(spark, messy, "A string, B double")
    assert {r["line"] for r in out.select("line").collect()} == {"x;2;extra", "z;6;"}
    assert tuple(D.scan_counts(spark, messy, "A string, B double").first()) == (6, 2)


def test_quoted_line_break(spark, tmp_path):
    (tmp_path / "m.csv").write_text('A;B\n"one\ntwo";1\nx;2;3\n')
    options = D.DelimitedOptions(multi_line=True)
    rows = D.read_delimited(spark, str(tmp_path / "m.csv"), "A string, B int", options).collect()
    assert [tuple(r) for r in rows] == [("one\ntwo", 1)]


def test_repair_and_verify(spark, messy, tmp_path):
    out = str(tmp_path / "deep" / "clean")
    clean, report = D.repair_delimited(spark, messy, "A string, B double", out)
    assert clean.count() == 6 and report.duplicates.first()["duplicate_rows"] == 0
    assert {r["column"]: r["null_count"] for r in report.nulls.collect()} == {"A": 2, "B": 2}
    checked = D.verify_delimited(spark, out, "A string, B double").first()
    assert (checked["rows"], checked["column"], checked["median"]) == (6, "B", 4.5)
    assert "ñandú" in {r["A"] for r in clean.collect()}


def test_delimiter_per_file(spark, tmp_path):
    for name, text in {"semi": "a;b\n1;2\n", "tab": "a\tb\tc\n", "pipe": "a|b,c|d\n",
                       "tie": "a,b;c\n", "none": "abc\n"}.items():
        (tmp_path / name).write_text(text)
    found = D.detect_delimiter(D.read_lines(spark, str(tmp_path))).collect()
    got = {os.path.basename(r["file"]): (r["delimiter"], r["occurrences"]) for r in found}
    assert got == {"semi": (";", 2), "tab": ("\t", 2), "pipe": ("|", 2), "tie": (";", 1),
                   "none": (";", 0)}


def test_workbooks(spark, tmp_path):
    a = pd.DataFrame({"id": [1, 2], "name": ["x & y", None], "v": [1.5, 2.0]})
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(a, ("first", "second")))
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes(pd.DataFrame(
        {"v": ["3", "text"], "id": [3, 4]})))
    (tmp_path / "c.txt").write_text("no workbook")
    schema = "id bigint, name string, v double"
    got = {tuple(r) for r in read_workbooks(spark, str(tmp_path), schema).collect()}
    assert got == {(1, "x & y", 1.5), (2, None, 2.0), (3, None, 3.0), (4, None, None)}
    one = read_workbooks(spark, str(tmp_path / "a.xlsx"), schema, "second")
    assert one.count() == 2
    with pytest.raises(Exception, match="no sheet"):
        read_workbooks(spark, str(tmp_path / "a.xlsx"), schema, "third").count()


def test_reports(spark, tmp_path):
    doc = {"project": "p", "dataset": {"rows": 5}, "models": ["ridge"]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.json").write_text(json.dumps(doc, indent=2))
    schema = "project string, dataset struct<rows: bigint>, models array<string>"
    df = reports.read_json_reports(spark, str(tmp_path / "in"), schema)
    assert df.first()["dataset"]["rows"] == 5
    reports.write_json_report(df, str(tmp_path / "out"))
    again = reports.read_json_reports(spark, str(tmp_path / "out"), schema, False)
    assert again.collect() == df.collect()
    assert json.loads(reports.as_json(df).first()["json"]) == doc


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "a int, b double")
    write_table(df, str(tmp_path / "t.parquet"))
    assert read_table(spark, str(tmp_path), "t", nan_as_null=True).filter("b is null").count() == 1


def test_a_long_sheet_is_not_held_in_memory():
    import io
    import tracemalloc
    import zipfile

    from tabulon.sources import workbook

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                      '<sheet name="s" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.'
                      'openxmlformats.org/package/2006/relationships"><Relationship Id="r1" '
                      'Target="worksheets/s.xml"/></Relationships>')
        rows = "".join(f"<row><c><v>{i}</v></c></row>" for i in range(100_000))
        book.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}'
                      "</sheetData></worksheet>")
    tracemalloc.start()
    try:
        total = sum(int(cells[0]) for cells in workbook._rows(data.getvalue(), None))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == sum(range(100_000)) and peak < 4 << 20
