import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.plans import runner
from cellweave.plans.registry import _place_relations
from cellweave.plans.store import Store
from cellweave.plans.sync import reconcile, sync
from cellweave.steps import transforms
from cellweave.steps.base import Relations, Step
from cellweave.steps.datasets import DATASETS, Dataset


def test_registries_are_in_order():
    runner.check_registry(DATASETS)
    runner.check_registry(transforms.STEPS)
    a = Dataset("a", "a", lambda c: None)
    with pytest.raises(ValueError, match="twice"):
        runner.check_registry([a, a])
    with pytest.raises(ValueError, match="before"):
        runner.check_registry([Dataset("b", "b", lambda c: None, depends_on=("a",)), a])


def test_graph_order_errors_and_results():
    seen = []

    def node(name, fail=False):
        def run(deps):
            seen.append(name)
            if fail:
                raise RuntimeError(name)
            return name + "".join(sorted(o.value or "!" for o in deps.values()))

        return run

    done = runner.run_graph({"c": (node("c"), ["a", "b"]), "a": (node("a"), []), "b": (node("b", fail=True), ["a"]), "d": (node("d"), ["c"])})
    assert seen.index("a") < seen.index("b") < seen.index("c") < seen.index("d")
    assert not done["b"].ok and done["c"].unwrap() == "c!a" and list(done) == ["c", "a", "b", "d"]
    with pytest.raises(RuntimeError):
        done["b"].unwrap()
    with pytest.raises(KeyError):
        runner.run_graph({"a": (node("a"), ["z"])})
    with pytest.raises(ValueError):
        runner.run_graph({"a": (node("a"), ["b"]), "b": (node("b"), ["a"])})


def test_extracts_cache_subset_and_failure_policy(spark, tmp_path):
    calls = []

    def make(name, fail=False):
        def extract(ctx):
            calls.append(name)
            if fail:
                raise OSError(name)
            return ctx.spark.range(2)

        return extract

    sets = [Dataset("a", "ta", make("a")), Dataset("b", "tb", make("b", True)), Dataset("c", "tc", make("c"), depends_on=("a",))]
    done = runner.run_extracts(spark, sets, tmp_path, str)
    assert done["a"].ok and not done["b"].ok and runner.complete(spark, tmp_path / "tc")
    assert done["a"].value.rows == 2 and done["a"].value.unplaced is None
    calls.clear()
    runner.run_extracts(spark, sets, tmp_path, str, only=["c"])
    assert calls == []
    runner.run_extracts(spark, sets, tmp_path, str, only=["c"], rebuild=True)
    assert calls == ["c"]
    with pytest.raises(ValueError):
        runner.run_extracts(spark, sets, tmp_path, str, only=["z"])
    with pytest.raises(OSError):
        runner.run_extracts(spark, [Dataset("b", "tb", make("b", True), optional=False)], tmp_path, str)


def test_rows_are_counted_by_the_job_that_writes_them(spark, tmp_path):
    made = spark.range(10).selectExpr("id", "case when id % 4 <> 0 then id end as place")
    sets = [Dataset("p", "p", lambda c: made.repartition(3), placed_by="place")]
    done = runner.run_extracts(spark, sets, tmp_path, str)["p"].value
    assert (done.rows, done.unplaced) == (10, 3) and "10 rows, 3 without a place" in str(done)
    assert runner.run_extracts(spark, sets, tmp_path, str)["p"].value.rows is None
    shapes = made.withColumn("geom", S.st_point(F.col("place").cast("double"), F.lit(1.0)))
    done = runner.run_extracts(spark, [Dataset("g", "g", lambda c: shapes, placed_by="geom")], tmp_path, str)["g"].value
    assert (done.rows, done.unplaced) == (10, 3)
    kept = runner.read_path(spark, tmp_path / "g")
    assert kept.columns == ["id", "place", "geom", "bbox"] and kept.where("bbox.xmin = place and bbox.ymax = 1").count() == 7


def stamp(path: Path, seconds: float) -> None:
    t = time.time() + seconds
    os.utime(path / "_SUCCESS", (t, t))


def test_fresh_steps_are_read_and_stale_ones_built(spark, tmp_path):
    extracts, out = tmp_path / "e", tmp_path / "t"
    extracts.mkdir()
    runner.write_table(spark.range(3), extracts / "bar")
    built = []

    def build(relations, resolutions):
        built.append(1)
        return {"foo": relations["bar"].withColumn("v", F.lit(len(built)))}

    step = Step("foo", build, lambda r, _: ["foo"], inputs=("bar", "missing"))
    run = lambda **k: runner.run_steps(spark, [step], extracts, out, required=("bar",), **k)["foo"].first().v
    assert run() == 1 and len(built) == 1
    stamp(extracts / "bar", -10)
    assert run() == 1 and len(built) == 1
    stamp(extracts / "bar", 10)
    assert run() == 2 and len(built) == 2
    stamp(out / "foo", 20)
    assert run(rebuild=True) == 3
    with pytest.raises(FileNotFoundError):
        runner.run_steps(spark, [step], extracts, out, required=("none",))


def test_publish_is_all_or_nothing(spark, tmp_path):
    a, b, bundle = tmp_path / "a", tmp_path / "b", tmp_path / "bundle"
    required, optional = runner.bundle_tables((8,))
    for name in required:
        runner.write_table(spark.range(1), (a if "h3" in name else b) / name)
    runner.write_table(spark.range(1), b / optional[0])
    assert runner.publish(spark, bundle, [a, b], (8,)) == sorted([*required, optional[0]])
    runner.write_table(spark.range(7), a / "crime_counts_h3_8")
    with pytest.raises(FileNotFoundError):
        runner.publish(spark, bundle, [a, b], (8,), include=["open_roads"])
    assert runner.open_bundle(spark, bundle)["crime_counts_h3_8"].count() == 1
    runner.write_table(spark.range(1), b / "open_roads")
    assert "open_roads" in runner.publish(spark, bundle, [a, b], (8,), include=["open_roads"])
    assert runner.open_bundle(spark, bundle)["crime_counts_h3_8"].count() == 7


def test_what_breaks_off_leaves_the_former_state(spark, tmp_path, monkeypatch):
    """A table whose writing fails, one whose renames are cut between, and a publication without its manifest."""
    path = tmp_path / "t"
    runner.write_table(spark.range(3), path)
    failing = spark.range(5).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        runner.write_table(failing, path)
    assert runner.read_path(spark, path).count() == 3 and [n for n in os.listdir(tmp_path) if not n.startswith(".t.crc")] == ["t"]
    rename, done = Store.rename, []

    def cut(self, place, to):
        if len(done) == 1:
            raise OSError("cut off")
        done.append(to)
        rename(self, place, to)

    monkeypatch.setattr(Store, "rename", cut)
    with pytest.raises(OSError, match="cut off"):
        runner.write_table(spark.range(9), path)
    monkeypatch.setattr(Store, "rename", rename)
    assert not path.exists() and runner.complete(spark, path) and runner.read_path(spark, path).count() == 3
    bundle, tables = f"file://{tmp_path}/other root/bundle", tmp_path / "tables"
    for name in runner.bundle_tables((8,))[0]:
        runner.write_table(spark.range(1), tables / name)
    runner.publish(spark, bundle, [tables], (8,))
    runner.write_table(spark.range(7), tables / "crime_counts_h3_8")
    monkeypatch.setattr(Store, "write", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
    with pytest.raises(OSError, match="cut off"):
        runner.publish(spark, bundle, [tables], (8,))
    monkeypatch.undo()
    assert runner.open_bundle(spark, bundle)["crime_counts_h3_8"].count() == 1
    runner.publish(spark, bundle, [tables], (8,))
    assert runner.open_bundle(spark, bundle)["crime_counts_h3_8"].count() == 7
    with pytest.raises(FileNotFoundError):
        runner.open_bundle(spark, tmp_path / "nowhere")


def test_wide_table_over_the_whole_chain(spark, tmp_path):
    relations = _place_relations(spark, "/root/testdata/sf0.001")
    for name, df in relations.items():
        runner.write_table(df, tmp_path / "e" / name)
    made = runner.run_steps(spark, transforms.STEPS, tmp_path / "e", tmp_path / "t", resolutions=(8,))
    wide = made["h3_8_geogs"]
    assert wide.columns == ["spatial_id", "cell_area", "pfa23cd", "lad24cd", "msoa21cd", "lsoa21cd", "oa21cd", "greenspace_ids", "greenspace_overlap_area", "road_ids", "road_overlap_length", "retail_centre_id", "retail_centre_distance"]
    rows = wide.collect()
    cells = made["crime_counts_h3_8"].select("spatial_id").distinct().count()
    assert rows and len(rows) <= cells and len({r.spatial_id for r in rows}) == len(rows)
    assert all(100_000 < r.cell_area < 2_000_000 and r.pfa23cd for r in rows)
    assert made["h3_8_retail_centre_lookup"].count() == cells
    other = transforms.geogs(made, (8,), base_key="lad24cd")["h3_8_geogs"]
    assert other.columns[2:4] == ["lad24cd", "pfa23cd"] and other.count() == made["h3_8_lad24cd_lookup"].count()
    assert transforms.streetlight_counts(made, (8,)) == {} and transforms.building_counts(made, (8,)) == {}


def test_counts_of_optional_points(spark):
    lights = spark.createDataFrame([("aaa",), ("aaa",), ("aaa",), ("bbb",), (None,)], "h3_9_id string")
    got = transforms.streetlight_counts(Relations({"streetlights": lights}), (9,))["streetlight_counts_h3_9"]
    assert {tuple(r) for r in got.collect()} == {("aaa", 3), ("bbb", 1)}
    buildings = spark.createDataFrame([("aaa", "Residential"), ("zzz", "Retail")], "h3_9_id string, map_simple_use string")
    counts = spark.createDataFrame([("aaa", "x")], "spatial_id string, crime_type string")
    got = transforms.building_counts(Relations({"buildings": buildings, "crime_counts_h3_9": counts}), (9,))["building_counts_h3_9"]
    assert [tuple(r) for r in got.collect()] == [("aaa", "Residential", 1)]


@pytest.mark.parametrize(("policy", "want"), [
    ("ignore", {"both": "skip", "here": "upload", "there": "skip", "new": "skip", "old": "skip", "near": "skip"}),
    ("newer", {"both": "skip", "here": "upload", "there": "download", "new": "upload", "old": "download", "near": "skip"}),
    ("different", {"both": "skip", "here": "upload", "there": "skip", "new": "upload", "old": "upload", "near": "upload"}),
    ("force", {"both": "upload", "here": "upload", "there": "skip", "new": "upload", "old": "upload", "near": "upload"}),
])
def test_sync_policies(spark, policy, want):
    local = [("both", 5000.0, "a"), ("here", 5000.0, "a"), ("new", 9000.0, "a"), ("old", 4000.0, "a"), ("near", 5004.0, "a")]
    remote = [("both", 5000.0, "a"), ("there", 5000.0, "a"), ("new", 5000.0, "b"), ("old", 5000.0, "b"), ("near", 5000.0, "b")]
    got = reconcile(spark.createDataFrame(local, "name string, mtime double, md5 string"), spark.createDataFrame(remote, "name string, mtime double, md5 string"), policy)
    assert {r["name"]: r["action"] for r in got.collect()} == want


def test_sync_moves_files_and_times(spark, tmp_path):
    here, there = tmp_path / "h", tmp_path / "t"
    here.mkdir()
    there.mkdir()
    (here / "a").write_text("mine")
    os.utime(here / "a", (5000, 5000))
    (there / "b").write_text("theirs")
    os.utime(there / "b", (6000, 6000))
    assert sync(spark, here, there, "newer") == {"a": "upload", "b": "download"}
    assert (here / "b").stat().st_mtime == 6000 and (there / "a").read_text() == "mine" and (there / "a").stat().st_mtime == 5000
    assert set(sync(spark, here, there, "newer").values()) == {"skip"}
    with pytest.raises(ValueError):
        sync(spark, here, there, "sometimes")
