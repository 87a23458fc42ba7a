import itertools
import random

import pytest
from pyspark.sql import functions as F

from docketlake.operators import dedup, joins, ranking, shape, votes
from docketlake.plans.schema_plan import SchemaPlan, deep_merge, payload_problems, strict_problems


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_flatten_item(spark):
    df = spark.createDataFrame([(1, ("x", ("v", None), [1, None], [True])), (2, None), (3, (" ", None, None, None))], "id int, item struct<a:string,e:struct<value:string,quote:string>,n:array<int>,b:array<boolean>>")
    out = {r["id"]: r for r in shape.flatten_item(df, "item").collect()}
    assert out[1]["e_value"] == "v" and out[1]["n"] == "1, None" and out[1]["b"] == "True"
    assert out[2]["a"] == "" and out[3]["a"] == "" and out[2]["e_value"] is None
    clash = spark.createDataFrame([(1, (2,))], "a int, item struct<a:int>")
    with pytest.raises(ValueError):
        shape.flatten_item(clash, "item")


def test_item_rows_keeps_childless(spark):
    df = spark.createDataFrame([(1, [("a",), ("b",)]), (2, []), (3, None)], "id int, c array<struct<x:string>>")
    assert rows(shape.item_rows(df, "c").select("id", F.coalesce("x", F.lit("-")))) == [(1, "a"), (1, "b"), (2, "-"), (3, "-")]


def test_coerced_whole_columns(spark):
    df = spark.createDataFrame([("1", "1.5"), ("", "2"), ("x", None)], "a string, b string")
    out = shape.coerced(df, ["a", "b"])
    assert dict(out.dtypes) == {"a": "bigint", "b": "double"}
    assert [r["a"] for r in out.collect()] == [1, None, None]
    empty = shape.coerced(df.limit(0), ["a"])
    assert empty.count() == 0


def test_titles_and_conform(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert shape.conform(df, ["a", "z"]).columns == ["a", "z", "b"]
    with pytest.raises(ValueError):
        shape.titled(df, {"a": "T", "b": "T"})
    with pytest.raises(ValueError):
        shape.titled(df, {}, exclude=["q"])


def test_exact_duplicates(spark):
    data = [(1, "A ", None, None), (2, "a", "x", None), (3, "a", "y", None), (4, "b", None, 1), (5, None, "q", None), (6, "", None, None)]
    df = spark.createDataFrame(data, "pos int, k string, v string, n int")
    assert rows(dedup.exact_duplicates(df, ["k"], "pos").select("pos", "duplicates")) == [(2, 2), (4, 0), (5, 1)]
    assert dedup.exact_duplicates(df, [], "pos").count() == 6
    assert dedup.exact_duplicates(df.limit(0), ["k"], "pos").count() == 0


def brute_wildcard(data):
    """Groups by the stated walk over distinct tuples."""
    out = {}
    for req in {d[1] for d in data}:
        tuples = {}
        for pos, r, *f in sorted(data):
            if r == req:
                tuples.setdefault(tuple(f), []).append(pos)
        free = sorted(tuples, key=lambda t: tuples[t][0])
        while free:
            anchor = free[0]
            taken = [t for t in free if all(a is None or b is None or a == b for a, b in zip(anchor, t))]
            out[tuples[anchor][0]] = sum(len(tuples[t]) for t in taken)
            free = [t for t in free if t not in taken]
    return out


def test_wildcard_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    for _ in range(3):
        data = [(i, rng.choice("xy"), rng.choice([None, "a", "b"]), rng.choice([None, "c", "d"])) for i in range(1, 25)]
        df = spark.createDataFrame(data, "pos int, r string, f string, g string")
        got = {r["group_pos"]: r["members"] for r in dedup.wildcard_duplicates(df, ["r"], ["f", "g"], "pos").collect()}
        assert got == brute_wildcard(data)


def test_conflicts_redundancy_and_notes(spark):
    df = spark.createDataFrame([(1, "k", "a"), (2, "K", "b"), (3, "k", None), (4, "z", "a")], "pos int, k string, v string")
    assert rows(dedup.conflicts(df, ["k"], ["v"], "pos")) == [("k", "v", 2, "a | b")]
    f = spark.createDataFrame([(1, None, "top"), (2, None, "low"), (3, "x", "low"), (4, None, "other")], "id int, b string, f string")
    assert rows(dedup.redundant_features(f, ["b"], "f", ["top", "low"]).select("id")) == [(1,), (3,), (4,)]
    note = dedup.exact_duplicates(df, ["k"], "pos").select(dedup.merge_note(["k"], F.col("duplicates")))
    assert sorted(str(r[0]) for r in note.collect()) == ["Merged 2 duplicate(s) on: k='k'", "None"]


def test_two_key_survivors_equal_a_walk(spark):
    rng = random.Random(5)
    data = [(i, 1, rng.choice("abcd"), rng.choice("wxyz")) for i in range(30)]
    want, urls, hashes = [], set(), set()
    for i, _, u, h in data:
        if u not in urls and h not in hashes:
            want.append(i)
        urls.add(u)
        hashes.add(h)
    df = spark.createDataFrame(data, "pos int, g int, u string, h string")
    assert [r[0] for r in rows(dedup.two_key_survivors(df, ["g"], "u", "h", "pos").select("pos"))] == want


def test_gram_pairs_against_all_pairs(spark):
    rng = random.Random(7)
    sets = {i: sorted({rng.choice("abcdefghij") for _ in range(rng.randint(1, 8))}) for i in range(25)}
    df = spark.createDataFrame(list(sets.items()), "id int, g array<string>")
    want = sorted((a, b) for a, b in itertools.combinations(sets, 2) if len(set(sets[a]) & set(sets[b])) / min(len(sets[a]), len(sets[b])) >= 0.65)
    got = joins.gram_pairs(df, "id", "g", 0.65).collect()
    copies = {r["right_id"]: r["left_id"] for r in got if r["kind"] == "copy"}
    assert all(sets[a] == sets[b] and b < a for a, b in copies.items()) and len(copies) == len(sets) - len({tuple(s) for s in sets.values()})
    # classes written out again give every pair, each once
    members = {}
    for i in sets:
        members.setdefault(copies.get(i, i), []).append(i)
    out = [tuple(sorted((a, b))) for r in got if r["kind"] == "near" for a in members[r["left_id"]] for b in members[r["right_id"]]]
    out += [p for m in members.values() for p in itertools.combinations(sorted(m), 2)]
    assert sorted(out) == want


def test_gram_pairs_broadcast_nothing(spark):
    """Shuffled rows are packed: a side that looks small to the planner may not fit the driver."""
    sets = [(i, sorted({f"g{(i * k) % 23}" for k in range(1, 9)})) for i in range(60)]
    pairs = joins.gram_pairs(spark.createDataFrame(sets, "id int, g array<string>"), "id", "g", 0.65)
    assert pairs.collect()
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_dictionary_hits(spark):
    texts = spark.createDataFrame([(1, "The Oak Grove county; oak grove!"), (2, None), (3, "")], "id int, t string")
    names = spark.createDataFrame([("a", "Oak Grove"), ("b", "Grove"), ("c", "")], "n string, name string")
    assert rows(joins.dictionary_hits(texts, names, "id", "t", "n", "name")) == [(1, "a", 2), (1, "b", 2)]
    assert joins.dictionary_hits(texts, names.limit(0), "id", "t", "n", "name").count() == 0


def test_ledger_refuses_repeats(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="repeats a key"):
        joins.ledger_merge(a, b, "k").collect()


def test_islands_neighbours_paths(spark):
    p = spark.createDataFrame([(1, 1), (1, 2), (1, 4), (2, 9), (1, 2)], "g int, p int")
    assert rows(joins.islands(p, "g", "p")) == [(1, 1, 2), (1, 4, 4), (2, 9, 9)]
    f = spark.createDataFrame([("a/b",), ("a/b/c",), ("d",)], "path string")
    assert rows(joins.minimal_paths(f, "path")) == [("a/b",), ("d",)]
    assert rows(joins.overlapping_paths(f, spark.createDataFrame([("a",)], "path string"), "path")) == [("a/b",), ("a/b/c",)]


def test_cross_product(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "a string"), spark.createDataFrame([(1,), (2,), (3,)], "b int")
    assert rows(joins.cross_product([a, b]).select("a", "b")) == [(x, y) for x in "xy" for y in (1, 2, 3)]
    assert joins.cross_product([a, b], 4).count() == 4


def test_url_vote(spark):
    claims = spark.createDataFrame(
        [(1, "t", "yes", "Yes", "u1", "target", None), (2, "t", "yes", "yes", "u2", "target", "q"), (3, "c", "yes", "Yes", "u1", "shared", None), (4, "c", "yes", "Yes", "u2", "shared", None), (5, "c", "no", "No", None, "target", None), (6, "one", "a", "A", None, "shared", "q")],
        "pos int, cell string, k string, v string, u string, s string, q string",
    )
    got = {r["cell"]: (r["value"], r["support"], r["conflict"], r["confidence"]) for r in votes.url_vote(claims, ["cell"], "k", "v", "u", "s", "q", "pos").collect()}
    assert got == {"t": ("yes", 2, False, "high"), "c": ("No", 0, True, "low"), "one": ("A", 0, False, "medium")}
    assert votes.url_vote(claims.limit(0), ["cell"], "k", "v", "u", "s", "q", "pos").count() == 0


def test_categories(spark):
    pairs = spark.createDataFrame([(None, None), (None, "a"), ("a", None), ("a", "a"), ("a", "b")], "x string, base string")
    assert [r[0] for r in pairs.select(votes.category(F.col("x"), F.col("base"))).collect()] == ["both_na", "missing", "new", "agree", "changed"]
    a = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, None), (3, None)], "k int, v string")
    assert [(r["k"], r["v"]) for r in votes.strict_majority(a, ["k"], "v").orderBy("k").collect()] == [(1, "a"), (3, None)]


def test_host_cap_equals_greedy(spark):
    rng = random.Random(9)
    data = [(i, rng.choice("ab"), rng.choice("xyz")) for i in range(40)]
    want = []
    for t in "ab":
        used, n = {}, 0
        for i, g, h in data:
            if g == t and n < 5 and used.get(h, 0) < 2:
                used[h] = used.get(h, 0) + 1
                n += 1
                want.append(i)
    df = spark.createDataFrame(data, "i int, g string, h string")
    assert [r[0] for r in rows(ranking.capped_top(df, ["g"], "h", [F.col("i")], 2, 5).select("i"))] == sorted(want)


def test_packing_equals_a_walk(spark):
    rng = random.Random(11)
    data = [(i, rng.choice("ab"), rng.randint(0, 40)) for i in range(60)]
    want = {}
    for g in "ab":
        batch, items, total = 1, 0, 0
        for i, h, n in data:
            if h == g:
                if items and (items >= 5 or total + n + 1 > 80):
                    batch, items, total = batch + 1, 0, 0
                items, total = items + 1, total + n + 1
                want[i] = batch
    df = spark.createDataFrame(data, "i int, g string, n int")
    assert {r["i"]: r["batch"] for r in ranking.packed(df, "g", "n", "i", 5, 80).collect()} == want


def test_set_cover(spark):
    df = spark.createDataFrame([("t", 1, ["a"], "h", 1.0), ("t", 2, ["a", "b"], "h", 0.5), ("t", 3, ["c"], "h", 0.9), ("t", 4, ["c"], "k", 0.1), ("u", 5, None, "h", 0.2)], "g string, id int, l array<string>, h string, r double")
    got = rows(ranking.set_cover(df.withColumn("l", F.coalesce("l", F.array().cast("array<string>"))), "g", "l", "r", "h", "id", 3, 2).select("g", "id", "pick"))
    assert got == [("t", 2, 1), ("t", 3, 2), ("t", 4, 3), ("u", 5, 1)]


def test_wildcard_duplicates_against_a_plain_walk(spark):
    """A thousand made keys: anchors in order take every free row that equals them or is null wherever they are filled."""
    rng = random.Random(43)
    data, want = [], []
    for g in range(1000):
        own = [(f"k{g}", 50 * g + i, rng.choice(["a", "b", None]), rng.choice(["x", "y", None, ""]), rng.choice(["1", None])) for i in range(rng.randint(1, 8))]
        data += own
        free = list(own)
        while free:
            anchor = free[0]
            blank = lambda v: v in (None, "")
            taken = [r for r in free if all(blank(a) or blank(b) or a == b for a, b in zip(anchor[2:], r[2:]))]
            best = max(taken, key=lambda r: (sum(not blank(v) for v in r), -r[1]))
            want.append((best[1], anchor[1], len(taken)))
            free = [r for r in free if r not in taken]
    df = spark.createDataFrame(data, "k string, pos int, a string, b string, c string")
    got = dedup.wildcard_duplicates(df, ["k"], ["a", "b", "c"], "pos").select("pos", "group_pos", "members")
    assert rows(got) == sorted(want)


def test_set_cover_against_a_plain_walk(spark):
    """A thousand made groups: each pick has the most new labels, then relevance, then the smaller id, hosts capped."""
    rng = random.Random(41)
    data, want = [], []
    for g in range(1000):
        left = []
        for i in range(rng.randint(1, 9)):
            row = (f"g{g}", 100 * g + i, sorted(rng.sample("abcde", rng.randint(0, 3))), rng.choice("hk"), rng.choice([0.1, 0.5]))
            data.append(row)
            left.append(row)
        covered, used = set(), {}
        for pick in range(1, 4):
            able = [r for r in left if used.get(r[3], 0) < 2]
            if not able:
                break
            best = sorted(able, key=lambda r: (-len(set(r[2]) - covered), -r[4], r[1]))[0]
            left.remove(best)
            covered |= set(best[2])
            used[best[3]] = used.get(best[3], 0) + 1
            want.append((f"g{g}", best[1], pick))
    df = spark.createDataFrame(data, "g string, id int, l array<string>, h string, r double")
    assert rows(ranking.set_cover(df, "g", "l", "r", "h", "id", 3, 2).select("g", "id", "pick")) == sorted(want)


def test_roster_names(spark):
    df = spark.createDataFrame([(1, "Oak County", "TX"), (2, "oak county ", "MO"), (3, "Elm", None), (4, " - ", "TX"), (5, None, "TX")], "id int, name string, state string")
    assert rows(joins.roster_names(df, "id", "name", ["state"])) == [(1, "oak county", "oak", 2, 1, "state"), (2, "oak county", "oak", 2, 1, "state"), (3, "elm", "elm", 1, 0, "")]


def test_place_within(spark):
    df = spark.createDataFrame([("b", 2), ("a", 5), (None, 1), ("a", 3), ("b", 9), (None, 0)], "g string, x int")
    assert sorted((str(r["g"]), r["x"], r["place"]) for r in ranking.place_within(df, ["g"], [F.col("x")]).collect()) == [("None", 0, 1), ("None", 1, 2), ("a", 3, 1), ("a", 5, 2), ("b", 2, 1), ("b", 9, 2)]


def test_pair_agreement_against_a_count(spark):
    from docketlake.operators import votes

    rng = random.Random(42)
    data = [(i, f"s{s}", rng.choice("xyz")) for i in range(200) for s in range(12) if rng.random() < 0.5]
    df = spark.createDataFrame(data, "item int, s string, v string")
    by = {(i, s): v for i, s, v in data}
    got = {(r["a"], r["b"]): (r["common"], r["equal"]) for r in votes.pair_agreement(df.repartition(5), ["item"], "s", "v").collect()}
    for a in range(12):
        for b in range(12):
            x, y = f"s{a}", f"s{b}"
            if x < y:
                both = [i for i in range(200) if (i, x) in by and (i, y) in by]
                assert got[x, y] == (len(both), sum(by[i, x] == by[i, y] for i in both))
    assert votes.pair_agreement(df.limit(0), ["item"], "s", "v").count() == 0


def test_reach_around(spark):
    lines = [(1, n, t) for n, t in enumerate(["x" * 30, "", "y" * 300, "hit", "z" * 50, " ", "w" * 10, "v" * 90], 1)]
    df = spark.createDataFrame(lines, "d int, n int, t string")
    hits = spark.createDataFrame([(1, 4)], "d int, hit int")
    assert [r[2] for r in rows(ranking.reach_around(df, "d", "n", "t", hits, 100))] == [3, 5, 7]


def test_curation(spark):
    from docketlake.operators.policy import curation

    cases = [("reject", False, False, True, "reject", False), ("keep", True, True, False, "keep", True), (None, True, True, True, "failed", False), (None, False, True, True, "held", False), (None, None, None, True, "automatic", True), (None, None, None, None, "automatic", False)]
    df = spark.createDataFrame([c[:4] for c in cases], "h string, f boolean, w boolean, a boolean")
    assert [tuple(r) for r in df.select(*curation(F.col("h"), F.col("f"), F.col("w"), F.col("a"))).collect()] == [c[4:] for c in cases]


def test_judged_support(spark):
    from docketlake.operators import votes

    data = [("i", 1, "b", "supported", True), ("i", 2, "a", "supported", False), ("i", 3, "a", "unsupported", False), ("j", 1, "x", "supported", False)]
    got = rows(votes.judged_support(spark.createDataFrame(data, "item string, pos int, g string, s string, q boolean"), ["item"], "pos", "g", "s", "q"))
    assert got == [("i", 1, "supported", 0), ("i", 2, "unclear", 1), ("i", 3, "unclear", 1), ("j", 1, "unclear", 0)]


def test_with_place(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1)], "x int")
    assert rows(ranking.with_place(df, [F.col("x")])) == [(1, 1), (3, 2), (5, 3), (9, 4)]


def test_reachable(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("b", "a")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "page string")
    assert rows(joins.reachable(links, seeds, 2)) == [("a", 0), ("b", 1), ("c", 2)]


def test_all_empty_files_block_their_folders(spark, tmp_path):
    from docketlake.plans.q_joins import R

    data = [(1, "a/b/x.pdf", 0), (2, "c/d/x.pdf", 0), (3, "e/f/x.pdf", 0), (4, "a/b/c/y.pdf", 9), (5, "c/y.pdf", 9), (6, "g/h/y.pdf", 9), (7, None, 0), (8, "i/j/y.pdf", None)]
    spark.createDataFrame(data, "source_id bigint, original string, size bigint").write.parquet(str(tmp_path / "captured_sources.parquet"))
    folders = {o.rsplit("/", 1)[0] for _, o, _ in data if o}
    blocked = {o.rsplit("/", 1)[0] for _, o, n in data if o and n == 0}
    lies = lambda a, b: f"{a}/".startswith(f"{b}/")
    assert rows(R.queries["jn_path_overlap"](spark, str(tmp_path))) == sorted((f,) for f in folders if any(lies(f, b) or lies(b, f) for b in blocked))
    both = folders | {b.split("/")[0] for b in blocked}
    assert rows(R.queries["set_minimal_paths"](spark, str(tmp_path))) == sorted((f,) for f in both if not any(f != o and lies(f, o) for o in both))


def test_crawl_follows_all_links(spark, tmp_path):
    from docketlake.plans.q_joins import R

    pairs = [(1, 1), (1, 2), (301, 1), (9000, 2), (9000, 3), (40, 3), (1, 1)]
    spark.createDataFrame(pairs, "l_partkey bigint, l_suppkey bigint").write.parquet(str(tmp_path / "lineitem.parquet"))
    links = {(f"p{p}", f"s{s}") for p, s in pairs}
    links |= {(b, a) for a, b in links}
    want, edge = {"p1": 0}, {"p1"}
    for depth in (1, 2):
        edge = {b for a, b in links if a in edge} - set(want)
        want |= dict.fromkeys(edge, depth)
    assert {"p301", "p9000"} <= set(want)
    assert dict(rows(R.queries["src_crawl"](spark, str(tmp_path)))) == want


SCHEMA = '{"properties": {"s": {"type": "string"}, "rows": {"type": "array", "items": {"properties": {"k": {"type": "string", "title": "Key"}, "n": {"type": ["integer", "null"]}, "e": {"$ref": "#/$defs/e"}, "parts": {"type": "array", "items": {"properties": {"p": {"type": "string"}}}}}}}}, "$defs": {"e": {"type": "object", "properties": {"value": {"type": "string"}, "quote": {"type": "string"}}}}, "$metadata": {"identity": {"keys": ["k"]}}}'


def test_schema_plan_and_compile(spark):
    from docketlake.plans.pipelines import compile_rows

    plan = SchemaPlan.load(SCHEMA)
    assert plan.columns == ["s", "k", "n", "e", "p"] and plan.evidence == ["e"] and plan.numeric == ["n"] and plan.row_array == "parts"
    records = spark.createDataFrame([(1, '{"s": "x", "rows": [{"k": "a", "n": 1, "e": {"value": "v", "quote": "q"}, "parts": [{"p": "1"}]}, {"k": "A ", "parts": []}]}'), (2, None)], "id int, payload string")
    out = compile_rows(records, plan, "payload", "id").collect()
    assert [(r["s"], r["Key"], r["n"], r["e"], r["p"]) for r in out] == [("x", "a", 1, "v", "1")] and "1 duplicate" in out[0]["merge_note"]
    with pytest.raises(ValueError):
        SchemaPlan.load(SCHEMA.replace('"keys": ["k"]', '"keys": ["zz"]'))
    assert deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert strict_problems({"type": "object", "properties": {"a": {}}}) and payload_problems({"a": 1}, {"type": "object", "properties": {"a": {"type": "string"}}, "required": ["b"]}, {}) == ["$.b: missing", "$.a: not string"]
