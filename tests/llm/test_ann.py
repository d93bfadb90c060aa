import numpy as np

from cellweave.llm.ann import TREES, depth_for, fit_forest, nearest, op1_nearest, visits_needed


def brute(rows, queries, top=20):
    own = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in queries:
        if q in own:
            found = sorted((-float(own[q] @ v), i) for i, v in own.items() if i != q)[:top]
            out[q] = [(i, -s) for s, i in found]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def same(found, want):
    assert found.keys() == {k for k, v in want.items() if v}
    for q, near in found.items():
        assert [i for i, _ in near] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in near], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_small_table_is_exact_with_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.integers(-3, 4, 4)], k % 3) for k in range(60)]
    rows += [(100, None, 1), (101, [0.0] * 4, 1), (102, [1.0, None, 0.0, 0.0], None), (103, [float("nan"), 1.0, 0.0, 0.0], 1), (104, [float("inf"), 1.0, 0.0, 0.0], 1), (None, [1.0, 0.0, 0.0, 0.0], 1), (120, [], 0)]
    rows += [(k, [1.0, 2.0, 3.0, 4.0], 0) for k in range(200, 260)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int")
    queries = df.where("vec_id % 20 = 0")
    same(got(nearest(df, queries)), brute([(r[0], r[1]) for r in rows], range(0, 300, 20)))


def test_fewer_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert got(nearest(df, df.where("vec_id = 0"))) == {0: [(1, 4.0)]}
    assert nearest(df.limit(0), df.limit(0)).count() == 0
    assert nearest(df, df.limit(0)).count() == 0


def test_recall_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 20 == 0])
    found = got(op1_nearest(spark, sf))
    assert found.keys() == want.keys() and all(len(v) == 20 for v in found.values())
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    assert all(abs(s - vectors[q] @ vectors[i]) < 1e-12 for q, near in found.items() for i, s in near)


def test_the_queue_visits_distinct_leaves_best_first():
    x = np.random.default_rng(1).normal(size=(2000, 8))
    forest = fit_forest(x, float(np.linalg.norm(x, axis=1).max()), 4, 5)
    seen = forest.visits(x[0], 50)
    assert len(set(seen)) == 50
    own = forest.leaves(x[:1])[0]
    assert {(t, int(leaf)) for t, leaf in enumerate(own)} <= set(forest.visits(x[0], 10_000))
    assert len(forest.visits(x[0], 10_000)) == len(own) << forest.depth


def test_visits_reach_the_recall_at_any_size():
    """Even and clustered vectors: the visits that the sample asks for against brute force, and the share of the table that is scored."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(200, 64))
    even = lambda n: rng.normal(size=(n, 64))
    clustered = lambda n: centres[rng.integers(0, 200, n)] + 0.4 * rng.normal(size=(n, 64))
    for make, n, most in ((even, 2_000, 1.0), (even, 50_000, 0.75), (clustered, 50_000, 0.2), (even, 100_000, 0.7)):
        x, depth = make(n), depth_for(n)
        forest = fit_forest(x[: 32 << depth], float(np.linalg.norm(x, axis=1).max()), TREES, depth)
        assert forest.depth == depth > 3
        visits = visits_needed(forest, x[: 32 << depth])
        leaves, found, scored = forest.leaves(x), [], []
        for q in x[rng.choice(len(x), 40, replace=False)]:
            seen = np.zeros(len(x), bool)
            for t, leaf in forest.visits(q, visits):
                seen |= leaves[:, t] == leaf
            found.append(seen[np.argsort(-(x @ q))[:20]].mean())
            scored.append(seen.mean())
        print(n, visits, np.mean(found), np.mean(scored))
        assert np.mean(found) >= 0.9 and np.mean(scored) <= most


def test_pruned_search_in_spark_against_brute_force(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 8))
    x = centres[rng.integers(0, 40, 5000)] + 0.3 * rng.normal(size=(5000, 8))  # doubles, which stay doubles
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = got(nearest(df, df.where("vec_id % 100 = 0"), visits=60))
    want = brute([(k, v) for k, v in enumerate(x)], range(0, 5000, 100))
    assert found.keys() == want.keys() and all(len(v) == 20 for v in found.values())
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    assert all(abs(s - x[q] @ x[i]) < 1e-12 for q, near in found.items() for i, s in near)


def test_visits_grow_slower_than_the_table():
    """Even vectors: five times the table and its queries make under 12 times the visits."""
    visits = []
    for n in (10_000, 50_000):
        x, depth = np.random.default_rng(5).normal(size=(n, 64)), depth_for(n)
        forest = fit_forest(x[: 32 << depth], float(np.linalg.norm(x, axis=1).max()), TREES, depth)
        visits.append(visits_needed(forest, x[: 32 << depth]))
    print(visits)
    assert 5 * visits[1] < 10 * visits[0]


def test_the_queue_runs_once_a_query(spark, monkeypatch, tmp_path):
    """A visited leaf is a row of a written table; nothing computes it twice."""
    from cellweave.llm import ann

    plain = ann._visitor

    def marked(shared, visits):
        visit = plain(shared, visits)

        def run(batches):
            for batch in visit(batches):
                with open(f"{tmp_path}/rows", "a") as f:
                    f.write(f"{batch.num_rows}\n")
                yield batch

        return run

    monkeypatch.setattr(ann, "_visitor", marked)
    x = np.random.default_rng(9).normal(size=(1000, 8))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    nearest(df, df.where("vec_id % 100 = 0"), visits=20).collect()
    assert sum(map(int, (tmp_path / "rows").read_text().split())) == 10 * 20
