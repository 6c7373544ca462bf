"""Writers: CSV, JSON arrays, Markdown tables, frequency lists, HTML tables and workbooks.

The single-file writers collect: they are for reports, whose rows are few by construction, and refuse more than `most`.
"""

from __future__ import annotations

import hashlib
import html
import json
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import Row

MOST = 100_000


def _rows(df: DataFrame, most: int) -> list[Row]:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows; write it as a table")
    return rows


def _text(value: object) -> str:
    return "" if value is None else "; ".join(map(str, value)) if isinstance(value, list) else str(value)


def csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with a header; arrays are joined by "; "."""
    flat = [F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def json_array(df: DataFrame, path: str, most: int = MOST) -> None:
    Path(path).write_text(json.dumps([r.asDict(recursive=True) for r in _rows(df, most)], ensure_ascii=False, indent=2, default=str), encoding="utf-8")


def markdown(df: DataFrame, most: int = MOST) -> str:
    cell = lambda x: _text(x).replace("|", "\\|").replace("\n", " ")
    lines = [df.columns, ["---"] * len(df.columns), *([cell(x) for x in r] for r in _rows(df, most))]
    return "".join(f"| {' | '.join(x)} |\n" for x in lines)


def html_table(df: DataFrame, title: str, most: int = MOST) -> str:
    line = lambda tag, cells: "<tr>" + "".join(f"<{tag}>{html.escape(_text(x))}</{tag}>" for x in cells) + "</tr>"
    return f"<table><caption>{html.escape(title)}</caption>{line('th', df.columns)}{''.join(line('td', r) for r in _rows(df, most))}</table>"


def frequencies(df: DataFrame, column: str, path: str) -> None:
    """A folder of text files: count, tab, value, by count and then value."""
    df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).select(F.concat_ws("\t", "n", column).alias("value")).write.mode("overwrite").text(path)


def workbook(df: DataFrame, path: str, by: str | None = None, most: int = MOST) -> None:
    """An .xlsx file of one sheet, rows by a column in falling order."""
    rows = [df.columns, *_rows(df.orderBy(F.desc(by)) if by else df, most)]

    def cell(value: object) -> str:
        if isinstance(value, int | float) and not isinstance(value, bool):
            return f"<c><v>{value}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{html.escape(_text(value), quote=False)}</t></is></c>'

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    kinds, rels = "http://schemas.openxmlformats.org/package/2006/content-types", "http://schemas.openxmlformats.org/package/2006/relationships"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    part = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    files = {
        "[Content_Types].xml": f'<Types xmlns="{kinds}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{part}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{part}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{rels}"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{rels}"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{"".join("<row>" + "".join(map(cell, r)) + "</row>" for r in rows)}</sheetData></worksheet>',
    }
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, body in files.items():
            out.writestr(name, body)


def page_id(url: str) -> str:
    """The name under which a page is kept in a cache."""
    return hashlib.sha256(url.encode()).hexdigest()[:16]
