"""Delimited text, workbooks and JSON reports, written from the tables and read back."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from checks.base import R, predictions, rounded, table
from tabulon.operators.compare import compare_metrics
from tabulon.operators.evaluate import evaluation_report
from tabulon.session import scratch_path
from tabulon.sources import delimited as D
from tabulon.sources import reports
from tabulon.sources.workbook import workbook_rows

SCHEMA = "id bigint, status string, price double, note string"
# Every third kind of line is odd: one field too many, an empty one too many, too short,
# a quoted separator, a text for a number, and a missing-value text.
LINES = """concat(cast(o_orderkey as string), ';', o_orderstatus,
case when o_orderkey % 13 = 5 then '' else concat(';',
  case when o_orderkey % 11 = 3 then 'n/a' when o_orderkey % 11 = 4 then 'abc'
       else cast(cast(round(o_totalprice) as bigint) as string) end, ';',
  case when o_orderkey % 5 = 0 then concat('"año ', o_orderpriority, '; x"')
       when o_orderkey % 5 = 1 then '' else o_orderpriority end,
  case when o_orderkey % 7 = 2 then ';more' when o_orderkey % 7 = 4 then ';' else '' end) end)"""


def _written(spark, sf, header: bool = True) -> str:
    """The orders as messy lines, by default with a header in every file."""
    path = scratch_path(spark, "lines")
    orders = table(spark, sf, "orders")
    lines = orders.selectExpr(f"{LINES} as value")
    (lines.selectExpr("value as `id;status;price;note`").write
     .option("header", header).option("encoding", "ISO-8859-1").option("quote", "\u0000")
     .option("sep", "\u0001").csv(path))
    return path


def csv_scan(spark, sf):
    return D.read_delimited(spark, _written(spark, sf), SCHEMA)


def csv_rejects(spark, sf):
    out = D.read_rejects(spark, _written(spark, sf), SCHEMA)
    return out.select("id", "status", "line")


def csv_scan_counts(spark, sf):
    return D.scan_counts(spark, _written(spark, sf), SCHEMA)


def csv_repair(spark, sf):
    """Scan, rewrite, read again: nulls per column of the rewritten files."""
    clean, report = D.repair_delimited(spark, _written(spark, sf), SCHEMA,
                                       scratch_path(spark, "clean"))
    return report.nulls.drop("dtype", "null_pct")


def csv_verify(spark, sf):
    out = scratch_path(spark, "clean")
    D.repair_delimited(spark, _written(spark, sf), SCHEMA, out)
    found = D.verify_delimited(spark, out, "id bigint, status string, price double, note string")
    return rounded(found.select("column", "rows", "mean", "median"), ["mean", "median"], 3)


def csv_roundtrip(spark, sf):
    """Texts with separators and quotes survive the sink and the scan."""
    docs = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.regexp_replace("text", r"[\r\n]+", " ").alias("text"))
    path = scratch_path(spark, "talk")
    D.write_delimited(docs, path)
    return D.read_delimited(spark, path, "conv_id bigint, turn bigint, text string",
                            D.DelimitedOptions(encoding="UTF-8", missing=()))


def detect_delimiter(spark, sf):
    out = D.detect_delimiter(D.read_lines(spark, _written(spark, sf, header=False)))
    return out.groupBy("delimiter").agg(F.sum("occurrences").alias("occurrences"))


def detect_delimiter_text(spark, sf):
    """Candidates counted in whole texts, grouped by source."""
    docs = table(spark, sf, "documents")
    return D.detect_delimiter(docs, "source", "text")


def field_counts(spark, sf):
    docs = table(spark, sf, "documents")
    return D.field_counts(docs, ",", "lang", "text")


def json_report_roundtrip(spark, sf):
    """One report per model written as JSON documents, read as a run history."""
    path = scratch_path(spark, "reports")
    report = evaluation_report(predictions(spark, sf))
    reports.write_json_report(report, path)
    back = reports.read_json_reports(spark, path, report.schema, multi_line=False)
    return rounded(back.select("model", "n_samples", F.col("metrics.mae").alias("mae"),
                               F.col("error_distribution.within_0_5").alias("within_0_5")),
                   ["mae"])


def json_text(spark, sf):
    return reports.as_json(table(spark, sf, "nation").select("n_nationkey", "n_name"))


def comparison_roundtrip(spark, sf):
    """The comparison table through its CSV file."""
    path = scratch_path(spark, "comparison")
    reports.write_comparison(compare_metrics(predictions(spark, sf)), path)
    return rounded(reports.read_comparison(spark, path), ["rmse", "mae", "r2", "mape", "mse",
                                                          "max_error"])


def workbook_bytes(rows: pd.DataFrame, sheets: tuple[str, ...] = ("data",)) -> bytes:
    """A minimal workbook holding the rows, texts inline."""
    def cell(v) -> str:
        if v is None or v != v:
            return "<c/>"
        if isinstance(v, str):
            return f'<c t="inlineStr"><is><t>{escape(v)}</t></is></c>'
        return f"<c><v>{v}</v></c>"

    lines = [list(rows.columns)] + rows.astype(object).values.tolist()
    body = "".join("<row>" + "".join(cell(v) for v in line) + "</row>" for line in lines)
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                   + "".join(f'<sheet name="{s}" sheetId="{i}" r:id="r{i}"/>'
                             for i, s in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{pkg}">' + "".join(
            f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i in range(1, len(sheets) + 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml",
                       f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def workbook_folder(spark, sf):
    """Customers as workbooks of some hundred rows each, read back."""
    def pack(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 400):
                part = pdf.iloc[at:at + 400]
                yield pd.DataFrame({"path": ["x"], "content": [workbook_bytes(part)]})

    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    files = customers.mapInPandas(pack, "path string, content binary")
    return workbook_rows(files, "c_custkey bigint, c_name string, c_acctbal double")


QUERIES = {f.__name__: f for f in (
    csv_scan, csv_rejects, csv_scan_counts, csv_repair, csv_verify, csv_roundtrip,
    detect_delimiter, detect_delimiter_text, field_counts, json_report_roundtrip, json_text,
    comparison_roundtrip, workbook_folder)}

_LINES = LINES.replace(" as string", " as varchar")
_ACCEPTED = """(select o_orderkey as id, o_orderstatus as status,
case when o_orderkey % 13 = 5 or o_orderkey % 11 in (3, 4) then null
     else cast(cast(round(o_totalprice) as bigint) as double) end as price,
case when o_orderkey % 13 = 5 or o_orderkey % 5 = 1 then null
     when o_orderkey % 5 = 0 then 'año ' || o_orderpriority || '; x'
     else o_orderpriority end as note
from orders where o_orderkey % 13 = 5 or o_orderkey % 7 not in (2, 4))"""
_MANY = "o_orderkey % 13 <> 5 and o_orderkey % 7 in (2, 4)"


def _pick(text: str) -> str:
    counts = [f"length({text}) - length(replace({text}, {c}, ''))"
              for c in ("';'", "','", "chr(9)", "'|'")]
    return ", ".join(f"sum({e})::bigint as n{i}" for i, e in enumerate(counts))


_WINNER = ("case greatest(n0, n1, n2, n3) when n0 then ';' when n1 then ',' when n2 then chr(9) "
           "else '|' end as delimiter, greatest(n0, n1, n2, n3) as occurrences")

SQL = {
    "csv_scan": f"select * from {_ACCEPTED}",
    "csv_rejects": "select cast(o_orderkey as varchar) as id, o_orderstatus as status, "
                   f"{_LINES} as line from orders where {_MANY}",
    "csv_scan_counts": f"select count(*) filter (not ({_MANY})) as accepted, "
                       f"count(*) filter ({_MANY}) as rejected from orders",
    "csv_repair": " union all ".join(
        f"select '{c}' as \"column\", count(*) filter ({c} is null) as null_count "
        f"from {_ACCEPTED}" for c in ("id", "status", "price", "note")),
    "csv_verify": f"select 'id' as \"column\", count(*) as \"rows\", {R('avg(id)', 3)} as mean, "
                  f"{R('quantile_cont(id, 0.5)', 3)} as median from {_ACCEPTED}",
    "csv_roundtrip": r"select conv_id, turn, regexp_replace(text, '[\r\n]+', ' ', 'g') as text "
                     "from conversations",
    "detect_delimiter": f"select ';' as delimiter, cast(sum(length(l) - "
                        f"length(replace(l, ';', ''))) as bigint) as occurrences "
                        f"from (select {_LINES} as l from orders)",
    "detect_delimiter_text": f"select source, {_WINNER} from (select source, {_pick('text')} "
                             "from documents group by source)",
    "field_counts": "select lang, length(text) - length(replace(text, ',', '')) + 1 as fields, "
                    "count(*) as lines from documents group by all",
    "json_report_roundtrip": """select model, count(*) as n_samples,
""" + R("avg(abs(y - y_pred))") + """ as mae,
count(*) filter (abs(y - y_pred) <= 0.5) as within_0_5 from {p} group by model""",
    "json_text": "select '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name "
                 "|| '\"}' as json from nation",
    "comparison_roundtrip": None,
    "workbook_folder": "select c_custkey, c_name, c_acctbal from customer",
}


def _late() -> None:
    from checks.base import PREDICTIONS
    from checks.evaluation import _G, _ranks, _round_all

    SQL["json_report_roundtrip"] = SQL["json_report_roundtrip"].format(p=PREDICTIONS)
    SQL["comparison_roundtrip"] = (
        f"with {_G} select model, "
        + _round_all(["rmse", "mae", "r2", "mape", "mse", "max_error"])
        + f", rmse_rank, mae_rank, r2_rank from (select *, {_ranks('')} from m)")


_late()
