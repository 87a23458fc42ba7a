import pytest
from pyspark.sql import functions as F

from docketlake.functions import measures, ranges, text, urls


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("value", "want"),
    [("Réview   the PERMIT_fee!", "review the permit fee"), ("hyphen-\nated", "hyphenated"), ("", ""), (None, None), ("ﬁle ½", "file 1 2"), ("a" * 50_000, "a" * 50_000)],
)
def test_evidence_form(spark, value, want):
    assert one(spark, value, text.evidence_form) == want
    assert text.fold_text(value) == want


@pytest.mark.parametrize(("quote", "source", "want"), [("the fee", "pay the fee now", True), ("he fee", "pay the fee now", False), ("pay ... now", "pay the fee now", True), ("now ... pay", "pay the fee now", False), ("", "x", False)])
def test_contains_quote(spark, quote, source, want):
    df = spark.createDataFrame([(quote, source)], "q string, s string")
    assert df.select(text.contains_quote(F.col("q"), F.col("s"))).first()[0] is want


@pytest.mark.parametrize(("value", "want"), [("1,500", "n:1500"), ("300.0", "n:300"), ("3,00", "t:3,00"), (" Yes  Sir", "t:yes sir"), ("-.5", "n:-0.5"), ("0.00", "n:0"), (None, None)])
def test_value_key(spark, value, want):
    assert one(spark, value, text.value_key) == want


def test_templates(spark):
    df = spark.createDataFrame([("Ada", None), (None, "x"), ("  ", "y")], "name string, note string")
    f = {"name": F.col("name"), "note": F.col("note")}
    assert [r[0] for r in df.select(text.render("Hi {name}  {note?}", f)).collect()] == ["Hi Ada", None, None]
    with pytest.raises(ValueError):
        text.render("{name", f)
    with pytest.raises(ValueError):
        text.render("{other}", f)


def test_urls(spark):
    u = "HTTPS://User:pw@WWW.Example.org:443/a%2Db/F.PDF?utm_source=x&id=3&token=s#top"
    df = spark.createDataFrame([(u,), (None,), ("notaurl",)], "u string")
    rows = df.select(urls.host_of(F.col("u")), urls.extension_of(F.col("u")), urls.canonical(F.col("u")), urls.redacted(F.col("u")), urls.is_http(F.col("u"))).collect()
    assert rows[0][0] == "www.example.org" and rows[0][1] == ".pdf" and "utm_" not in rows[0][2] and "#" not in rows[0][2]
    assert "pw" not in rows[0][3] and "token=REDACTED" in rows[0][3] and rows[0][4] is True
    assert rows[1][4] is False and rows[2][0] == ""
    hosts = spark.createDataFrame([("10.0.0.1",), ("localhost",), ("example.org",), ("172.20.1.1",), ("8.8.8.8",)], "h string")
    assert [r[0] for r in hosts.select(urls.public_host(F.col("h"))).collect()] == [False, False, True, False, True]


@pytest.mark.parametrize(("name", "want"), [("notice_04.15.2024.pdf", "2024-04-15"), ("plan-2024-02-30_2023.pdf", "2024-01-01"), ("Apr_2024", "2024-04-01"), ("x_2023", "2023-01-01"), ("none", None), (None, None)])
def test_name_date(spark, name, want):
    got = one(spark, name, measures.name_date)
    assert (str(got) if got else None) == want


def test_wilson(spark):
    df = spark.createDataFrame([(8, 9), (7, 27), (0, 0)], "k int, n int")
    rows = df.select(measures.wilson(F.col("k"), F.col("n"), False), measures.wilson(F.col("k"), F.col("n"), True)).collect()
    assert rows[0][0] == pytest.approx(0.565, abs=1e-3) and rows[0][1] == pytest.approx(0.980, abs=1e-3)
    assert rows[1][0] == pytest.approx(0.132, abs=1e-3) and rows[1][1] == pytest.approx(0.447, abs=1e-3)
    assert rows[2][0] is None


def test_page_ranges(spark):
    df = spark.createDataFrame([([(5, 7), (1, 2), (3, 3), (9, 8)],), ([],), (None,)], "r array<struct<start:int,end:int>>")
    rows = df.select(ranges.merged(F.col("r")).alias("m")).select(ranges.formatted(F.col("m")), ranges.page_total(F.col("m"))).collect()
    assert [tuple(r) for r in rows] == [("1-3,5-7", 6), ("", 0), ("", 0)]
    back = spark.createDataFrame([("1-3, 7,x",)], "t string").select(ranges.parsed(F.col("t"))).first()[0]
    assert [tuple(r) for r in back] == [(1, 3), (7, 7)]


def test_spreadsheet_round_trip(spark):
    for value in ("=1+1", "\t=x", "plain", "-3", "'quoted", ""):
        assert one(spark, value, lambda c: text.from_spreadsheet_literal(text.spreadsheet_literal(c))) == value


def test_small_text_functions(spark):
    assert one(spark, '```json\n{"a": 1}\n``` thanks', text.json_body) == '{"a": 1}'
    assert one(spark, "<b>a&nbsp;&amp; b</b>", text.stripped_html) == "a & b"
    assert one(spark, "The Cost of the hours", text.fuzzy_words) == "cost"
    assert one(spark, "San José County", text.county_key) == "san jos"
    assert one(spark, "new york", text.state_code) == "NY" and one(spark, "Atlantis", text.state_code) == "Atlantis"
    assert one(spark, 3671, text.clock, "int") == "[01:01:11]"
