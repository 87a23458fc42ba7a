"""Sections, markup tests, evidence paths and state evidence."""

import random

from pyspark.sql import functions as F

from docketlake.functions import markup
from docketlake.operators import sections


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_sections_by_marks_and_by_paragraphs(spark):
    texts = [(1, "intro\n\nSection 1.2 Scope\nbody one\nSEC 3 Empty\n§ 4 Last\nbody two"), (2, "Section 1 only\none mark is none"), (3, "a" * 1500 + "\n \n" + "b" * 600 + "\n\nc"), (4, " \n "), (5, None), (6, "lone")]
    got = rows(sections.text_sections(spark.createDataFrame(texts, "id int, text string"), "id", "text"))
    assert got == [
        (1, 1, "", "intro"), (1, 2, "Section 1.2 Scope", "body one"), (1, 3, "§ 4 Last", "body two"), (2, 1, "", "Section 1 only\none mark is none"),
        (3, 1, "Part 1", "a" * 1500 + "\n\n" + "b" * 600), (3, 2, "Part 2", "c"), (6, 1, "", "lone"),
    ]


def test_paragraph_parts_against_a_fold(spark):
    rng = random.Random(1)
    lists = [["x" * rng.randint(1, 90) for _ in range(rng.randint(1, 30))] for _ in range(120)]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, p array<string>").orderBy("i").select(sections.paragraph_parts(F.col("p"), 120)).collect()]
    for paragraphs, parts in zip(lists, got):
        want, now = [], []
        for p in paragraphs:
            now.append(p)
            if sum(map(len, now)) >= 120:
                want.append("\n\n".join(now))
                now = []
        assert parts == want + (["\n\n".join(now)] if now else [])


def test_labelled_lines(spark):
    table = [[["Name", "Fee"], ["A", " 5 "], [None, ""], ["B", ""]], [["Name", "5"], ["A", "6"]], [["a", "A"]], [], [["x"], ["y"]], [["H", "K"]]]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(table)], "i int, t array<array<string>>").orderBy("i").select(sections.labelled_lines(F.col("t"))).collect()]
    assert got == [["Name: A | Fee: 5", "Name: B"], ["Name | 5", "A | 6"], ["a | A"], [], ["x", "y"], ["H | K"]]


def test_evidence_nodes_and_emptiness(spark):
    data = '{"a": {"b": [{"q": "x", "n": null}, {"q": 2}, 7]}, "e": [], "f": [1]}'
    df = spark.createDataFrame([(1, data), (2, None), (3, "[]")], "id int, j string")
    assert rows(sections.evidence_nodes(df, "id", "j", ["a", "b", "*", "q"])) == [(1, "a.b[0].q", "x"), (1, "a.b[1].q", "2")]
    assert rows(sections.evidence_nodes(df, "id", "j", ["a", "b", "*", "n"])) == [(1, "a.b[0].n", None)]
    assert rows(sections.data_arrays(df, "id", "j")) == [(1, "f", 1)]
    values = [("", True), (None, True), ("null", True), ("[]", True), ('{"a": null, "b": [""]}', True), ("0", False), ("false", False), ('{"a": 0}', False), ('{"a": "x"}', False), ('{"a": "null"}', False)]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, (v, _) in enumerate(values)], "i int, v string").orderBy("i").select(sections.is_empty_json(F.col("v"))).collect()]
    assert got == [e for _, e in values]


def test_state_evidence(spark):
    texts = [
        (1, "Main St 5, TX 75001"), (2, "Name: x | State: VT | Fee: 3"), (3, "Oak County\nWA\nnext"), (4, "the rules of New Jersey and Delaware County"), (5, "Delaware Water"), (6, "Nobody\nOR\n"), (7, "estate: NV"), (8, None), (9, "as in Delaware County, Delaware applies"),
    ]
    names = spark.createDataFrame([("Oak County",), ("Delaware County",), (None,)], "name string")
    got = rows(sections.state_evidence(spark.createDataFrame(texts, "id int, text string"), "id", "text", names, "name"))
    assert got == [(1, "TX"), (2, "VT"), (3, "WA"), (4, "NJ"), (5, "DE"), (9, "DE")]


def test_field_columns():
    assert sections.field_columns(["Rate Name", "FIPS Code", "u_s_state"], ["a.rate_name", "fipsCode", "US state", "x"]) == [("a.rate_name", "Rate Name"), ("fipsCode", "FIPS Code"), ("US state", "u_s_state"), ("x", None)]


def test_markup(spark):
    pages = [('<div id="app"></div><script>' + "x" * 500 + "</script>", True), ('<div id="app">' + "word " * 60 + "</div>", False), ("<p>short</p>", False), (None, False)]
    got = [r[0] for r in spark.createDataFrame([(i, p) for i, (p, _) in enumerate(pages)], "i int, h string").orderBy("i").select(markup.is_shell(F.col("h"))).collect()]
    assert got == [w for _, w in pages]
    hosts = {"10.1.2.3": False, "8.8.8.8": True, "172.31.0.1": False, "172.32.0.1": True, "[::ffff:10.0.0.1]": False, "fd00::1": False, "2606:4700::1": True, "localhost": False, "x.local": False, "a.example": True, "": False, "300.1.1.1": True}
    got = {r[0]: r[1] for r in spark.createDataFrame([(h,) for h in hosts], "h string").select("h", markup.is_public_address(F.col("h"))).collect()}
    assert got == hosts


def test_candidate_block(spark):
    df = spark.createDataFrame([("g", 2, "b", None), ("g", 1, "a", "TX")], "g string, i int, name string, state string")
    assert sections.candidate_block(df, "g", ["state", "name"], "i", "HEAD", "TAIL").first()["block"] == 'HEAD\n{"state":"TX","name":"a"}\n{"state":null,"name":"b"}\nTAIL'
