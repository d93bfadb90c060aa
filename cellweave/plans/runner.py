"""Running extracts and transform steps: dependency order, concurrent jobs, freshness, failure policy, publication."""

from __future__ import annotations

import graphlib
import json
import logging
import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellweave.plans.store import Place, Store, address, name_of, under
from cellweave.sources.geoparquet import write_geoparquet
from cellweave.steps.base import RESOLUTIONS, Relations, Step
from cellweave.steps.datasets import Context, Dataset


log = logging.getLogger("cellweave")


@dataclass(frozen=True)
class Extracted:
    """Where a table is, and what its own write job counted: rows, and rows whose ``placed_by`` column is null."""

    path: Place
    rows: int | None = None
    unplaced: int | None = None

    def __str__(self) -> str:
        return f"{self.path}" + (f": {self.rows:,} rows" if self.rows is not None else " (kept)") + (f", {self.unplaced:,} without a place" if self.unplaced is not None else "")


@dataclass(frozen=True)
class Outcome:
    """A result or the error that took its place."""

    value: object = None
    error: BaseException | None = None

    @property
    def ok(self) -> bool:
        return self.error is None

    def unwrap(self):
        if self.error is not None:
            raise self.error
        return self.value


def check_registry(items: Iterable[Dataset | Step]) -> None:
    """Names are unique and dependencies come earlier."""
    seen: set[str] = set()
    for item in items:
        if item.name in seen:
            raise ValueError(f"{item.name} is registered twice")
        if missing := [d for d in item.depends_on if d not in seen]:
            raise ValueError(f"{item.name} depends on {missing}, which must be registered before it")
        seen.add(item.name)


def run_graph(nodes: Mapping[str, tuple[Callable[[dict[str, Outcome]], object], Sequence[str]]], threads: int = 4) -> dict[str, Outcome]:
    """Runs each node once its dependencies are done, whether these succeeded or not, on a few driver threads.

    A node's function gets its dependencies' outcomes. Unknown dependencies and cycles are errors before anything runs.
    """
    for name, (_, deps) in nodes.items():
        if unknown := [d for d in deps if d not in nodes]:
            raise KeyError(f"{name} depends on unknown {unknown}")
    order = graphlib.TopologicalSorter({n: deps for n, (_, deps) in nodes.items()})
    order.prepare()
    done: dict[str, Outcome] = {}
    with ThreadPoolExecutor(threads) as pool:
        running: dict[Future, str] = {}
        while order.is_active():
            for name in order.get_ready():
                f, deps = nodes[name]
                running[pool.submit(f, {d: done[d] for d in deps})] = name
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in finished:
                name = running.pop(future)
                done[name] = Outcome(error=future.exception()) if future.exception() else Outcome(future.result())
                order.done(name)
    return {n: done[n] for n in nodes}


def _aside(path: Place) -> str:
    """Where the former table lies while a new one takes its place."""
    return under(address(path).rsplit("/", 1)[0], f".{name_of(path)}.former")


def complete(spark: SparkSession, path: Place) -> bool:
    """Whether a whole table is there. One that was set aside by a run that broke off then is put back first."""
    store = Store(spark)
    if not store.exists(path) and store.exists(_aside(path)):
        store.rename(_aside(path), path)
    return store.exists(under(path, "_SUCCESS"))


def write_table(df: DataFrame, path: Place, clustered: bool = False, counted: tuple[Observation, list[Column]] | None = None) -> Place:
    """Parquet at ``path``, in place only when it is whole: written beside it, and the former table goes when the new one has its name.

    ``clustered`` writes GeoParquet along a curve, with the bounds of ``geom`` in ``bbox``. ``counted`` is observed by the write job.
    """
    store, staging = Store(df.sparkSession), under(address(path).rsplit("/", 1)[0], f".{name_of(path)}.{uuid.uuid4().hex}")
    try:
        if clustered:
            write_geoparquet(df, staging, counted=counted)
        else:
            (df.observe(counted[0], *counted[1]) if counted else df).write.parquet(staging)
        if complete(df.sparkSession, path) or store.exists(path):
            store.delete(_aside(path))
            store.rename(path, _aside(path))
        store.rename(staging, path)
        store.delete(_aside(path))
    finally:
        store.delete(staging)
    return path


def read_path(spark: SparkSession, path: Place) -> DataFrame:
    return spark.read.parquet(address(path))


def run_extracts(spark: SparkSession, datasets: Sequence[Dataset], folder: Place, source: Callable[[str], str], only: Sequence[str] = (), rebuild: bool = False, options: dict | None = None) -> dict[str, Outcome]:
    """Extracts to Parquet folders; what exists is kept unless ``rebuild``. An optional one may fail; a required one's error is raised.

    Rows are counted by the job that writes them, not by another one.
    """
    check_registry(datasets)
    if unknown := set(only) - {d.name for d in datasets}:
        raise ValueError(f"unknown dataset {sorted(unknown)}; known: {', '.join(d.name for d in datasets)}")
    chosen = [d for d in datasets if not only or d.name in only]
    names = {d.name for d in chosen}
    tables = {d.name: d.table for d in datasets}

    def node(d: Dataset):
        def run(_: dict[str, Outcome]) -> Extracted:
            path = under(folder, d.table)
            if complete(spark, path) and not rebuild:
                return Extracted(path)
            ctx = Context(spark, source, lambda n: read_path(spark, under(folder, tables[n])), (options or {}).get(d.name, {}))
            counted = Observation()
            counts = [F.count(F.lit(1)).alias("rows"), *([F.count_if(F.col(d.placed_by).isNull()).alias("unplaced")] if d.placed_by else [])]
            made = d.extract(ctx)
            write_table(made, path, clustered=d.geometry and "geom" in made.columns, counted=(counted, counts))
            done = Extracted(path, **counted.get)
            log.info("%s: %s", d.name, done)
            return done

        return run, [x for x in d.depends_on if x in names]

    done = run_graph({d.name: node(d) for d in chosen})
    for d in chosen:
        if not done[d.name].ok and not d.optional:
            done[d.name].unwrap()
    return done


def fresh(spark: SparkSession, outputs: Sequence[Place], inputs: Sequence[Place]) -> bool:
    """All outputs are whole and none is older than any input; missing inputs don't count."""
    stamp = lambda p: Store(spark).modified(under(p, "_SUCCESS"))
    if not outputs or not all(complete(spark, p) for p in outputs):
        return False
    return min(map(stamp, outputs)) >= max((stamp(p) for p in inputs if complete(spark, p)), default=0.0)


def run_steps(spark: SparkSession, steps: Sequence[Step], extracts: Place, folder: Place, required: Sequence[str] = ("crime_data",), resolutions: tuple[int, ...] = RESOLUTIONS, rebuild: bool = False) -> Relations:
    """Steps in order; a fresh one is read again, a stale one built and written. The first error by registration is raised."""
    check_registry(steps)
    relations = Relations()
    for name in Store(spark).names(extracts):
        if not name.startswith(".") and complete(spark, under(extracts, name)):
            relations.put(name, read_path(spark, under(extracts, name)))
    if missing := [r for r in required if r not in relations]:
        raise FileNotFoundError(f"required extracts are missing: {missing}")
    by_name = {s.name: s for s in steps}

    def node(step: Step):
        def run(_: dict[str, Outcome]) -> list[str]:
            outputs = [under(folder, n) for n in step.outputs(relations, resolutions)]
            inputs = [under(extracts, n) for n in step.inputs] + [under(folder, n) for d in step.depends_on for n in by_name[d].outputs(relations, resolutions)]
            if rebuild or not fresh(spark, outputs, inputs):
                for name, df in step.build(relations, resolutions).items():
                    write_table(df, under(folder, name))
            for path in outputs:
                if complete(spark, path):
                    relations.put(name_of(path), read_path(spark, path))
            return [name_of(p) for p in outputs]

        return run, [d for d in step.depends_on if d in by_name]

    for outcome in run_graph({s.name: node(s) for s in steps}).values():
        outcome.unwrap()
    return relations


def bundle_tables(resolutions: Sequence[int] = RESOLUTIONS, include: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(required, optional) relations of the minimal bundle; what is included by name is required."""
    core = [f"crime_counts_h3_{r}" for r in resolutions] + [f"h3_{r}_geogs" for r in resolutions] + ["police_force_areas", "local_authority_districts", "msoa_2021", "lsoa_2021", "output_areas_2021"]
    features = ["schools", "poi", "naptan", "food_outlets", "cctv", "imd_scores_pct", "land_cover", "oac", "oac_classification", "streetlight_counts_h3_9", "building_counts_h3_9"]
    return [*core, *(n for n in include if n not in core)], [n for n in features if n not in include]


def _manifests(spark: SparkSession, bundle: Place) -> list[str]:
    return [n for n in Store(spark).names(bundle) if re.fullmatch(r"manifest-\d{8}\.json", n)]


def publish(spark: SparkSession, bundle: Place, folders: Sequence[Place], resolutions: Sequence[int] = RESOLUTIONS, include: Sequence[str] = (), threads: int = 4) -> list[str]:
    """Copies the minimal tables into a new version, by Spark jobs, and commits it by the rename of a manifest of the next number.

    Readers take the manifest of the highest number, so they see all or nothing; whatever breaks off before leaves the former version in force.
    """
    required, optional = bundle_tables(resolutions, include)
    found: dict[str, str] = {}
    for name in [*required, *optional]:
        path = next((under(f, name) for f in folders if complete(spark, under(f, name))), None)
        if path is None and name in required:
            raise FileNotFoundError(f"{name} is in none of {', '.join(map(str, folders))}")
        if path is not None:
            found[name] = path
    version = f"v-{uuid.uuid4().hex}"
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(lambda name: read_path(spark, found[name]).write.parquet(under(bundle, version, name)), found))
    number = int(old[-1][9:17]) + 1 if (old := _manifests(spark, bundle)) else 1
    Store(spark).write(json.dumps({"version": version, "tables": sorted(found)}), under(bundle, f"manifest-{number:08}.json"))
    return sorted(found)


def open_bundle(spark: SparkSession, bundle: Place) -> Relations:
    manifests = _manifests(spark, bundle)
    if not manifests:
        raise FileNotFoundError(f"nothing is published in {bundle}")
    manifest = json.loads(Store(spark).read(under(bundle, manifests[-1])))
    return Relations({n: read_path(spark, under(bundle, manifest["version"], n)) for n in manifest["tables"]})
