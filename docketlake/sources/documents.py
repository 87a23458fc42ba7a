"""Document readers: every format to text, without libraries outside the standard one."""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Elements whose text is no text, and elements that end a line.
SILENT = frozenset(("script", "style", "noscript", "nav", "template"))
BLOCK = frozenset((
    "address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "ol", "p", "pre", "section", "table", "tbody", "tfoot", "thead", "title", "tr", "ul",
))
#: The line between two pages of a text.
PAGE_BREAK = "\n\f\n"


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.silent, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
        elif tag in BLOCK:
            self.out.append("\n")
        elif tag in ("td", "th"):
            self.out.append("\t")

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in BLOCK:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.silent:
            self.out.append(re.sub(r"\s+", " ", data))


def html_text(html: str | None) -> str:
    """Visible text: blocks on lines, cells parted by tabs, scripts, styles and navigation left out."""
    parser = _Text()
    parser.feed(html or "")
    parser.close()
    lines = (re.sub(r"[  ]+", " ", x).strip(" \t") for x in "".join(parser.out).split("\n"))
    return "\n".join(x for x in lines if x)


class _Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links, self.href, self.text = [], None, []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and (href := dict(attrs).get("href")):
            self.href, self.text = href.strip(), []

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            self.links.append((self.href, " ".join("".join(self.text).split())))
            self.href = None

    def handle_data(self, data):
        if self.href is not None:
            self.text.append(data)


def html_links(html: str | None, base: str | None = None) -> list[tuple[str, str]]:
    """``(address, text)`` of the anchors, addresses made absolute; scripts, mail and in-page links left out."""
    from urllib.parse import urljoin

    parser = _Links()
    parser.feed(html or "")
    parser.close()
    return [(urljoin(base or "", h), t) for h, t in parser.links if not h.lower().startswith(("#", "javascript:", "mailto:", "tel:"))]


def is_header(cells: list[str]) -> bool:
    """A header row: more than one cell, all filled, different and not numbers."""
    return len(cells) > 1 and all(c.strip() for c in cells) and len({c.strip() for c in cells}) == len(cells) and not any(re.fullmatch(r"[-+$]?[\d.,]+%?", c.strip()) for c in cells)


def table_lines(rows: list[list[str]]) -> list[str]:
    """Rows as lines; below a header each filled cell carries its title."""
    rows = [[str(c) if c is not None else "" for c in r] for r in rows]
    rows = [r for r in rows if any(c.strip() for c in r)]
    if not rows:
        return []
    if not is_header(rows[0]):
        return [" | ".join(c.strip() for c in r if c.strip()) for r in rows]
    head = [c.strip() for c in rows[0]]
    return [" | ".join(f"{h}: {c.strip()}" for h, c in zip(head, r) if c.strip()) for r in rows[1:]] or [" | ".join(head)]


def json_lines(data, path: str = "") -> list[str]:
    """A JSON value as labelled lines: lists of objects are sections, nested keys are dotted, lists of lists are dropped."""
    out: list[str] = []
    if isinstance(data, list):
        if data and all(isinstance(x, dict) for x in data):
            for x in data:
                out.append(" | ".join(_pairs(x)))
                for k, v in x.items():
                    if isinstance(v, list) and v and all(isinstance(y, dict) for y in v):
                        out += json_lines(v, f"{path}.{k}".strip("."))
        elif not any(isinstance(x, (list, dict)) for x in data):
            out.append(f"{path}: {', '.join(map(str, data))}" if path else ", ".join(map(str, data)))
    elif isinstance(data, dict):
        if plain := _pairs(data):
            out.append(" | ".join(plain))
        for k, v in data.items():
            if isinstance(v, list) and v and all(isinstance(y, dict) for y in v):
                out.append(k)
                out += json_lines(v, k)
    elif data is not None:
        out.append(str(data))
    return [x for x in out if x]


def _pairs(value: dict, key: str = "") -> list[str]:
    out = []
    for k, v in value.items():
        name = f"{key}.{k}" if key else k
        if isinstance(v, dict):
            out += _pairs(v, name)
        elif isinstance(v, list):
            if v and not any(isinstance(x, (list, dict)) for x in v):
                out.append(f"{name}: {', '.join(map(str, v))}")
        elif v is not None and str(v).strip():
            out.append(f"{name}: {v}")
    return out


def decoded(content: bytes, encodings=("utf-8-sig", "cp1252", "latin-1")) -> str:
    for e in encodings:
        try:
            return content.decode(e)
        except UnicodeDecodeError:
            continue
    return content.decode("utf-8", "replace")


def xlsx_rows(content: bytes) -> list[tuple[str, list[list[str]]]]:
    """``(sheet, rows)`` of a workbook, read from its XML."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:sheets", ns)]
        out = []
        for i, name in enumerate(names, 1):
            rows = []
            for row in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{i}.xml")).iter(f"{{{ns['m']}}}row"):
                cells: list[str] = []
                for c in row.findall("m:c", ns):
                    column = 0
                    for letter in re.match(r"[A-Z]*", c.get("r", "")).group():
                        column = column * 26 + ord(letter) - 64
                    while column and len(cells) < column - 1:
                        cells.append("")
                    v = c.find("m:v", ns)
                    if c.get("t") == "inlineStr":
                        cells.append("".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t")))
                    else:
                        value = v.text if v is not None and v.text else ""
                        cells.append(shared[int(value)] if c.get("t") == "s" and value else value)
                rows.append(cells)
            out.append((name, rows))
        return out


def docx_text(content: bytes) -> str:
    """Paragraphs, then table rows, of a word-processor file."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{w}body")
    text = lambda node: "".join(t.text or "" for t in node.iter(f"{w}t"))
    lines = [text(p) for p in body.findall(f"{w}p")]
    for table in body.findall(f"{w}tbl"):
        lines += [" | ".join(text(c).strip() for c in row.findall(f"{w}tc")) for row in table.findall(f"{w}tr")]
    return "\n".join(x for x in lines if x.strip())


def document_text(name: str, content: bytes) -> tuple[str | None, str | None]:
    """``(text, error)`` of a file by its extension; formats that need an outside reader (pdf, doc, audio) give an error."""
    kind = name.lower().rsplit(".", 1)[-1]
    try:
        if kind in ("html", "htm"):
            return html_text(decoded(content)), None
        if kind == "csv":
            return "\n".join(table_lines(list(csv.reader(io.StringIO(decoded(content)))))), None
        if kind == "json":
            return "\n".join(json_lines(json.loads(decoded(content)))), None
        if kind == "xlsx":
            return "\n".join(line for sheet, rows in xlsx_rows(content) for line in [sheet, *table_lines(rows)]), None
        if kind == "docx":
            return docx_text(content), None
        if kind in ("txt", "md"):
            return decoded(content), None
        return None, f"no reader for .{kind}"
    except (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError, csv.Error, RecursionError) as e:  # a broken file is a row with an error, not a lost job
        return None, f"{type(e).__name__}: {e}"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(path, sha256, bytes, text, error)`` of all files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            read = [document_text(p, c) for p, c in zip(pdf["path"], pdf["content"])]
            yield pd.DataFrame({"path": pdf["path"], "sha256": pdf["sha256"], "bytes": pdf["length"], "text": [t for t, _ in read], "error": [e for _, e in read]})

    return files.select("path", "content", "length", F.sha2("content", 256).alias("sha256")).mapInPandas(run, "path string, sha256 string, bytes bigint, text string, error string")


def html_to_text(html: Column) -> Column:
    def run(s: pd.Series) -> pd.Series:
        return s.map(html_text, na_action="ignore")

    return F.pandas_udf(run, "string")(html)


def links_of(pages_: DataFrame, id_col: str, html_col: str, base: Column) -> DataFrame:
    """``(id, address, label)``: the anchors of pages, addresses made absolute against ``base``."""

    def run(html: pd.Series, root: pd.Series) -> pd.Series:
        return pd.Series([html_links(h, b) for h, b in zip(html, root)])

    found = F.pandas_udf(run, "array<struct<address:string,label:string>>")(F.col(html_col), base)
    return pages_.select(id_col, F.explode(found).alias("_l")).select(id_col, "_l.address", "_l.label")


def pages(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, page, page_text)``: texts cut at lines that hold only a form feed."""
    return texts.select(id_col, F.posexplode(F.split(text_col, PAGE_BREAK)).alias("_p", "page_text")).select(id_col, (F.col("_p") + 1).alias("page"), "page_text")


def page_state(chars: Column, image_share: Column, ocr_chars: Column) -> Column:
    """How a page is read: native text, OCR where there is mostly image, blank, or unreadable."""
    return F.when(chars >= 40, "native").when((image_share >= 0.3) & (ocr_chars > 0), "ocr").when((chars == 0) & (F.coalesce(image_share, F.lit(0.0)) < 0.05), "blank").when(chars > 0, "native").otherwise("unreadable")


def search_results(responses: DataFrame, body: str, query: str) -> DataFrame:
    """Saved search responses as uniform rows: organic and news results, one level of nested stories flattened."""
    item = "struct<position:int,title:string,link:string,snippet:string,stories:array<struct<title:string,link:string,snippet:string>>>"
    parsed = responses.select(query, F.from_json(body, f"struct<organic_results:array<{item}>,news_results:array<{item}>>").alias("b"))
    organic = parsed.select(query, F.posexplode("b.organic_results").alias("pos", "r")).select(query, F.lit("organic").alias("kind"), "pos", F.col("r.link").alias("url"), F.col("r.title").alias("title"), F.col("r.snippet").alias("snippet"))
    news = parsed.select(query, F.posexplode("b.news_results").alias("pos", "r"))
    own = F.array(F.struct(F.col("r.title").alias("title"), F.col("r.link").alias("link"), F.col("r.snippet").alias("snippet")))
    stories = news.select(query, "pos", F.explode(F.when(F.size("r.stories") > 0, F.col("r.stories")).otherwise(own)).alias("s")).select(query, F.lit("news").alias("kind"), "pos", F.col("s.link").alias("url"), F.col("s.title").alias("title"), F.col("s.snippet").alias("snippet"))
    return organic.unionByName(stories).where("url is not null")
