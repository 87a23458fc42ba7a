"""Exports: CSV and XLSX for people, JSON records, and their guards."""

from __future__ import annotations

import io
import os
import re
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketlake.functions.text import printable, spreadsheet_literal

#: The limits of a worksheet.
MOST_ROWS, MOST_CHARS = 1_048_575, 32_767


def csv_frame(df: DataFrame) -> DataFrame:
    """Text cells and headers that no spreadsheet takes for formulas."""
    cells = [(spreadsheet_literal(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")).alias(_header(f.name)) for f in df.schema.fields]
    return df.select(*cells)


def _header(name: str) -> str:
    return f"'{name}" if re.match(r"[\t\r\n]|\s*[=+\-@]", name) else name


def write_csv(df: DataFrame, path: str) -> None:
    """Escaped CSV with a header, as one part file per task; a failed write leaves the former folder."""
    csv_frame(df).write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"').csv(path)


def export_problems(df: DataFrame) -> list[str]:
    """Why a table does not fit a worksheet, from one aggregate."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    row = df.agg(F.count("*").alias("n"), *(F.max(F.length(c)).alias(c) for c in text)).first()
    out = [f"{row['n']} rows; a worksheet has {MOST_ROWS}"] if row["n"] > MOST_ROWS else []
    return out + [f"a cell of {c} has {row[c]} characters; the limit is {MOST_CHARS}" for c in text if (row[c] or 0) > MOST_CHARS]


def write_xlsx(df: DataFrame, path: str, sheet: str = "Sheet1") -> None:
    """One worksheet at a local path, streamed row by row and put in place in one step; refuses what does not fit.

    A worksheet is bounded by its format, so the driver may write it.
    """
    if problems := export_problems(df):
        raise ValueError("; ".join(problems))
    clean = df.select(*((printable(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`").cast("string")).alias(f.name) for f in df.schema.fields))
    numeric = [isinstance(f.dataType, T.NumericType) for f in df.schema.fields]

    def row(number: int, cells) -> str:
        out = []
        for i, (x, is_number) in enumerate(zip(cells, numeric)):
            if x is None:
                continue
            at = f"{_letters(i)}{number}"
            if is_number and number > 1 and x not in ("NaN", "Infinity", "-Infinity"):
                out.append(f'<c r="{at}"><v>{x}</v></c>')
            else:
                out.append(f'<c r="{at}" t="inlineStr"{" s=" + chr(34) + "1" + chr(34) if number == 1 else ""}><is><t xml:space="preserve">{escape(str(x))}</t></is></c>')
        return f'<row r="{number}">{"".join(out)}</row>'

    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack = "http://schemas.openxmlformats.org/package/2006"
    temporary = f"{path}.part"
    with zipfile.ZipFile(temporary, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/{p}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.{k}+xml"/>' for p, k in (("workbook", "sheet.main"), ("worksheets/sheet1", "worksheet"), ("styles", "styles")))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{pack}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{pack}/relationships"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'{head}<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>')
        with z.open("xl/worksheets/sheet1.xml", "w") as raw, io.TextIOWrapper(raw, "utf-8") as f:
            f.write(f'{head}<worksheet xmlns="{main}"><sheetData>')
            f.write(row(1, clean.columns))
            for n, r in enumerate(clean.toLocalIterator(), 2):
                f.write(row(n, r))
            f.write("</sheetData></worksheet>")
    os.replace(temporary, path)


def _letters(index: int) -> str:
    out = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        out = chr(65 + rest) + out
    return out


def write_records(df: DataFrame, path: str, key: str) -> None:
    """Records as JSON lines with the digest of each, partitioned by nothing so that a reader sees whole files."""
    body = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    df.select(F.col(key), body.alias("record"), F.sha2(body, 256).alias("sha256")).write.mode("overwrite").json(path)


def append_cache(df: DataFrame, path: str) -> None:
    """Append to a cache whose later rows win when read by ``read_cache``."""
    df.write.mode("append").parquet(path)


def read_cache(spark, path: str, key: str, order: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.groupBy(key).agg(F.max_by(F.struct(*(c for c in df.columns if c != key)), order).alias("_r")).select(key, "_r.*")
