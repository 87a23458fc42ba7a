import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from docketlake.sources import documents, external, records, sinks, targets


def test_target_readers(spark, tmp_path):
    (tmp_path / "t.csv").write_text('﻿name,urls\nA,"https://x.example/a|ftp://y"\nB,\n', encoding="utf-8")
    df = targets.normalised(targets.read_targets(spark, str(tmp_path / "t.csv")))
    assert [(r["name"], list(r["urls"])) for r in df.orderBy("name").collect()] == [("A", ["https://x.example/a"]), ("B", [])]
    (tmp_path / "bad.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception):
        targets.read_targets(spark, str(tmp_path / "bad.csv")).collect()
    assert targets.inline(spark, [{"a": "1"}, {"b": "2"}]).columns == ["a", "b"]


def test_document_readers(spark, tmp_path):
    (tmp_path / "a.html").write_text("<nav>menu</nav><h1>T</h1><p>x <b>y</b></p><table><tr><td>1</td><td>2</td></tr></table><script>z</script>")
    (tmp_path / "b.csv").write_text("Fee,Days\n$5,3\n")
    (tmp_path / "c.json").write_text(json.dumps({"a": {"b": 1}, "rows": [{"k": "v"}]}))
    (tmp_path / "d.bin").write_bytes(b"\x00")
    (tmp_path / "e.xlsx").write_bytes(b"broken")
    df = spark.createDataFrame([("Fee", 5.0), (None, None)], "name string, fee double")
    sinks.write_xlsx(df, str(tmp_path / "f.xlsx"))
    got = {r["path"].rsplit("/", 1)[1]: r for r in documents.read_documents(spark, str(tmp_path)).collect()}
    assert got["a.html"]["text"].split("\n") == ["T", "x y", "1\t2"]
    assert got["b.csv"]["text"] == "Fee: $5 | Days: 3"
    assert got["c.json"]["text"].split("\n") == ["a.b: 1", "rows", "k: v"]
    assert got["d.bin"]["error"].startswith("no reader") and got["e.xlsx"]["error"]
    assert got["f.xlsx"]["text"] == "Sheet1\nname: Fee | fee: 5.0"


def test_docx_and_links():
    out = io.BytesIO()
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>")
    assert documents.document_text("x.docx", out.getvalue()) == ("Hello\na | b", None)
    assert documents.html_links('<a href="/p">P q</a><a href="#x">no</a>', "https://h.example/a/") == [("https://h.example/p", "P q")]
    assert documents.html_text(None) == "" and documents.table_lines([]) == []


def test_search_responses(spark):
    body = json.dumps({"organic_results": [{"position": 1, "title": "T", "link": "u1"}], "news_results": [{"title": "N", "link": "n", "stories": [{"title": "S", "link": "s1"}]}, {"title": "M", "link": "m"}]})
    df = spark.createDataFrame([("q", body), ("bad", "{"), ("none", None)], "query string, body string")
    assert sorted(r["url"] for r in documents.search_results(df, "body", "query").collect()) == ["m", "s1", "u1"]
    state = df.select(external.response_state(F.col("body"))).collect()
    assert [r[0] for r in state] == ["ok", "error", "error"]


def test_records(spark, tmp_path):
    (tmp_path / "_internal").mkdir()
    (tmp_path / "_internal" / "x.json").write_text("{}")
    (tmp_path / "r.json").write_text('{"a": 1}')
    read = records.read_records(spark, str(tmp_path))
    assert read.count() == 1
    row = read.first()
    admission = spark.createDataFrame([(row["path"], row["sha256"], "new")], "path string, sha256 string, disposition string")
    assert records.verified(read, admission).count() == 1
    assert records.verified(read, admission.withColumn("sha256", F.lit("0"))).count() == 0


def test_stubs_round_trip(spark):
    saved = external.Saved(spark.createDataFrame([("q1", "{}")], "query string, body string"), "query")
    asked = spark.createDataFrame([("q1",), ("q2",), ("q1",)], "query string")
    assert sorted((r["query"], r["body"]) for r in saved.search(asked).collect() if r["body"]) == [("q1", "{}")]
    model = external.CountingModel(lambda p: p.upper(), price=2.0)
    out = model.answer(spark.createDataFrame([("1", "abc")], "request_id string, prompt string")).first()
    assert out["reply"] == "ABC" and out["cost"] > 0
    assert external.chunk_starts([5.0] * 290 + [0.0] + [5.0] * 400) == [0, 290, 590]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("=1", 2), (None, None)], "`=h` string, n int")
    sinks.write_csv(df, str(tmp_path / "o"))
    text = "".join(p.read_text() for p in (tmp_path / "o").glob("part-*.csv"))
    assert text.startswith("'=h,n") and "'=1" in text
    long = spark.createDataFrame([("x" * 40_000,)], "t string")
    assert sinks.export_problems(long)
    with pytest.raises(ValueError):
        sinks.write_xlsx(long, str(tmp_path / "x.xlsx"))
    cache = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "k string, seq int, v string")
    sinks.append_cache(cache, str(tmp_path / "c"))
    assert [r["v"] for r in sinks.read_cache(spark, str(tmp_path / "c"), "k", "seq").collect()] == ["new"]
