"""Publication that survives crashes, manifests, garbage and validation lines."""

import json

import pytest

from docketlake.operators import manifests, validation
from docketlake.sources.publication import Publisher


def rows(df):
    return sorted(tuple(r) for r in df.collect())


class Crash(Exception):
    pass


def _stop_at(step):
    def after(done):
        if done == step:
            raise Crash(step)

    return after


STEPS = ["staged", "prepared", "old a", "new a", "new b", "committed"]


@pytest.mark.parametrize("fresh", [False, True])
@pytest.mark.parametrize("step", [*STEPS, "old c"])
def test_a_crash_leaves_all_old_or_all_new(spark, tmp_path, step, fresh):
    output = f"file:{tmp_path}/out"
    read = lambda name: rows(spark.read.parquet(f"{output}/{name}"))
    one, two = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "x int")
    Publisher(spark, output).publish({"a": one, "c": one})
    if step == "old c" and not fresh:
        return
    with pytest.raises(Crash):
        Publisher(spark, output, _stop_at(step)).publish({"a": two, "b": two}, fresh)
    found = Publisher(spark, output).recover()
    there = lambda name: (tmp_path / "out" / name).exists()
    if step == "committed":
        assert found and read("a") == [(2,)] and read("b") == [(2,)] and there("c") != fresh
    else:
        assert found == (step != "staged") and read("a") == [(1,)] and read("c") == [(1,)] and not there("b")
    Publisher(spark, output).publish({"a": two, "b": two}, fresh)
    assert read("a") == [(2,)] and read("b") == [(2,)] and there("c") != fresh
    assert not (tmp_path / ".out-publication.json").exists() and not Publisher(spark, output).recover()


def test_broken_manifests_are_warnings(spark, tmp_path):
    for name, text in {"a/manifest.json": '{"run_id": "r1", "cost": 1.5}', "b/manifest.json": '{"run_id": "r1", "cost": 9}', "c/manifest.json": '{"run_id": ', "d/manifest.json": '{"cost": 2}', "e/manifest.json": json.dumps({"run_id": "r2"}, indent=1)}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    runs, warnings = manifests.read_manifests(spark, str(tmp_path), "run_id string, cost double")
    assert [(r["run_id"], r["cost"]) for r in runs.orderBy("run_id").collect()] == [("r1", 1.5), ("r2", None)]
    assert sorted(r["problem"] for r in warnings.collect()) == ["no JSON", "no run_id"]


def test_receipts_come_before_manifests(spark):
    m = spark.createDataFrame([("x", "1", "p1", 2, 10, 1.0), ("x", "1", "p2", 9, 99, 9.0), ("x", "2", "p", 3, 20, 2.0), ("y", "1", "p", 1, None, None)], "stage string, run_id string, path string, calls int, tokens long, cost double")
    r = spark.createDataFrame([("x", "1", "a", 4, 0.5), ("x", "1", "a", 4, 0.5), ("x", "1", "b", 6, 0.25), ("x", "3", "c", 1, 0.1)], "stage string, run_id string, attempt_id string, tokens long, cost double")
    assert rows(manifests.pipeline_accounting(m, r)) == [("*", 4, 7, 31, 2.85, 2), ("x", 3, 6, 31, 2.85, 2), ("y", 1, 1, 0, 0.0, 0)]
    assert manifests.pipeline_accounting(m.limit(0), r.limit(0)).where("stage != '*'").count() == 0


def test_hard_links_count_once_and_not_while_linked(spark):
    files = spark.createDataFrame([("g", "p1", "i1", 10), ("g", "p2", "i1", 10), ("h", "p3", "i1", 10), ("h", "p4", "i2", 5), ("k", "p5", "i2", 5), ("h", "p6", None, 7)], "run_id string, path string, inode string, size long")
    entries = spark.createDataFrame([("k",), (None,)], "run_id string")
    assert rows(manifests.orphaned(files, entries)) == [("g", 2, 10), ("h", 3, 7)]


def test_validation_lines(spark):
    data = [
        (1, "f", "m", "primary", "Yes"), (1, "f", "a", "challenger", "No"), (1, "f", "r", "reference", "Yes"),
        (2, "f", "a", "challenger", "No"), (2, "f", "b", "challenger", "No"), (2, "f", "c", "challenger", "No"),
        (3, "f", "m", "primary", "Yes"), (4, "f", "r", "reference", "Yes"), (5, "f", "m", "primary", None), (5, "f", "r", "reference", "No"),
        (6, "f", "m", "primary", "Yes"), (6, "f", "a", "challenger", None), (6, "f", "b", "challenger", "Yes"),
    ]
    cells = spark.createDataFrame(data, "id int, field string, label string, role string, v string")
    assert rows(validation.record_lines(cells, "id", "label", "role")) == [(2, "missing_row", "high", ""), (3, "extra_row", "high", ""), (4, "missing_row", "low", "extraction")]
    got = rows(validation.cell_lines(cells, ["id", "field"], "label", "role", "v"))
    assert got == [(1, "f", "disputed", "high", ""), (3, "f", "unanimous", "low", ""), (5, "f", "reference_only", "low", "extraction"), (6, "f", "partial", "low", "")]
    lines = validation.cell_lines(cells, ["id", "field"], "label", "role", "v")
    assert [r["id"] for r in validation.in_review_order(lines.repartition(3), ["id", "field"]).orderBy("place").collect()] == [1, 3, 5, 6]


def test_read_source(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('Name,"Fee",Other\n\'=A1,NA,x\n" ",5,y\n')
    assert rows(validation.read_source(spark, str(path), {"Name": "name", "Fee": "fee"}).fillna("-")) == [("-", "5"), ("=A1", "-")]
    assert rows(validation.read_source(spark, str(path), {"Name": "name", "Fee": "fee"}, reference=True).fillna("-")) == [("-", "5"), ("=A1", "NA")]
    with pytest.raises(ValueError):
        validation.read_source(spark, str(path), {"Absent": "a"})
