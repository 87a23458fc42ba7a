"""Identity terms, strokes over lines, review samples, pairing and caches."""

import random

from pyspark.sql import functions as F

from docketlake.functions import text, urls
from docketlake.operators import screening
from docketlake.sources import external


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_identity_gate(spark):
    cases = [("x/oak-ville/minutes", "excluded"), ("x/oakville", "missing_required"), ("x/tx/elm", "no_identity"), ("x/TX/oak_ville.pdf", None)]
    df = spark.createDataFrame([(t, "Oak Ville", "tx", None) for t, _ in cases], "t string, name string, st string, none string")
    got = [r[0] for r in df.select(screening.identity_gate(F.col("t"), [F.col("name"), F.col("none")], [F.col("st"), F.col("none")], [F.lit("minutes")])).collect()]
    assert got == [w for _, w in cases]
    assert spark.range(1).select(screening.identity_gate(F.lit("a"), [F.lit(None).cast("string")])).first()[0] is None


def test_crossed_lines_against_all_pairs(spark):
    rng = random.Random(3)
    lines = [(d, n, 10.0, 10.0 + rng.randint(20, 300), rng.uniform(0, 400), rng.choice([0.0, 9.0, 30.0])) for d in range(8) for n in range(30)]
    marks = [(d, n, 15.0, 15.0 + rng.randint(0, 250), rng.uniform(0, 430)) for d in range(8) for n in range(40)]
    want = sorted((d, n, k) for d, n, a0, a1, y0, h in lines for e, k, b0, b1, y in marks if d == e and h > 0 and b1 > b0 and 0.35 <= (y - y0) / h <= 0.68 and (min(a1, b1) - max(a0, b0)) / (b1 - b0) >= 0.8)
    got = screening.crossed_lines(spark.createDataFrame(marks, "p int, mark_no int, x0 double, x1 double, y double"), spark.createDataFrame(lines, "p int, line_no int, x0 double, x1 double, y0 double, height double"), ["p"])
    assert rows(got) == want and want


def test_revision_state(spark):
    pages = spark.createDataFrame([(1, True, False), (2, True, True), (3, False, None), (4, True, None)], "d int, r boolean, n boolean")
    crossed = spark.createDataFrame([(1, 1, 1), (1, 2, 1)], "d int, line_no int, mark_no int")
    assert rows(screening.revision_state(pages, crossed, "d", "r", "n")) == [(1, "flagged", "strikeout"), (2, "flagged", "header"), (3, "unknown", ""), (4, "no_findings", "")]


def test_review_sample(spark):
    rng = random.Random(4)
    for _ in range(300):
        body = "".join(rng.choice("abc  \n") for _ in range(rng.randint(0, 900)))
        where = rng.randint(0, len(body))
        body = body[:where] + "Permit" + body[where:]
        most = rng.randint(20, 500)
        windows = text.sample_windows(body, most, ["permit", "fee"])
        assert len(text.SAMPLE_BREAK.join(windows)) <= max(most, 0) or len(body) <= most
        assert all(w in body for w in windows)
        share = (most - 6 * len(text.SAMPLE_BREAK)) // 5
        if len(body) > most > 200 and share <= where < len(body) - share:
            assert any("permit" in w.lower() for w in windows)
    assert text.sample_windows("", 10) == [""] and text.sample_windows("x" * 50, 10) == ["x" * 10]
    got = spark.createDataFrame([(None,), ("short",)], "t string").select(text.review_sample(F.col("t"), 30)).collect()
    assert [r[0] for r in got] == [None, "short"]


def test_cut_points(spark):
    rng = random.Random(5)
    lists = [[rng.random() for _ in range(rng.randint(0, 60))] for _ in range(50)]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(lists)), "i int, l array<double>").orderBy("i").select(external.cut_points_of(F.col("l"), 10, 3)).collect()]
    for levels, starts in zip(lists, got):
        want = [0]
        while want[-1] + 13 < len(levels):
            near = range(want[-1] + 7, min(want[-1] + 14, len(levels)))
            want.append(min(near, key=lambda i: (levels[i], abs(i - want[-1] - 10))))
        assert starts == want


def test_paired_keys_and_gates(spark):
    a = spark.createDataFrame([("k", 1), ("l", 2), ("l", 3), ("m", 4), ("n", 5)], "k string, a int")
    b = spark.createDataFrame([("k", "x"), ("l", "y"), ("n", "z"), ("n", "w")], "k string, b string")
    got = sorted(((r["k"], r["state"], r["a"], r["b"]) for r in screening.paired_keys(a, b, ["k"], "a", "b").collect()), key=str)
    assert got == [("k", "paired", 1, "x"), ("l", "ambiguous", None, None), ("m", "alone", None, None), ("n", "ambiguous", None, None)]
    gates = screening.compile_gates(spark.createDataFrame([("low",), ("medium",)], "s string"), "s", 2)
    assert rows(gates) == [("provenance", 2, True), ("suspicious_high", 0, False), ("suspicious_low", 2, True), ("suspicious_medium", 1, True)]


def test_redacted_text(spark):
    t = "go to https://u:p@x.org/a?key=1&b=2#c?token=q now, or write me@x.org"
    assert spark.range(1).select(urls.redacted_in_text(F.lit(t))).first()[0] == "go to https://REDACTED@x.org/a?key=REDACTED&b=2#c?token=REDACTED now, or write me@x.org"
