import zlib

import numpy as np
import pytest

from cellweave.llm.toxicity import LABEL_TRUST, LEXICON, _indexer, _terms_of, dependency_tree, fit_label_model, fit_model, op4_toxicity, toxicity_scores, without_toxic


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n1 = label.sum()
    return (order[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op4_toxicity(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    return got, labels


def test_held_out_accuracy(scored):
    got, labels = scored
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    own = [(got[i].score, y) for i, y in labels.items() if got[i].held_out]
    score, label = np.array([s for s, _ in own]), np.array([y for _, y in own])
    assert auc(score, label) > 0.93
    said = score >= 0.5
    assert (said & (label == 1)).sum() / said.sum() > 0.9 and (said & (label == 1)).sum() / label.sum() > 0.7


def test_labels_held_out_have_no_influence(spark, odd):
    labels = [(1, 0), (2, 1), (3, 0), (4, 0), (5, 0), (6, 0), (8, 1), (9, 0)]
    kept = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 5]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    flipped = [(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, y in labels]
    a, b, c = (sorted(map(str, toxicity_scores(odd, frame(x)).collect())) for x in (kept, labels, flipped))
    assert a == b == c and len(a) == odd.count()


def test_no_labels_and_empty_tables(spark, odd, none):
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    plain = spark.createDataFrame([(1, "you pathetic worthless idiot"), (2, "a calm text"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity_scores(plain, labels).collect()}
    assert got[1] > 0.5 > got[2] and got[3] < 0.5
    assert toxicity_scores(none, labels).count() == 0
    assert [r.doc_id for r in without_toxic(plain, labels).orderBy("doc_id").collect()] == [2, 3]
    assert without_toxic(odd, labels).columns == odd.columns


def test_label_model_recovers_accuracies_and_correlated_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    vote = lambda hit, miss: np.where(y, rng.random(4000) < hit, rng.random(4000) < miss)
    votes = np.stack([vote(0.8, 0.02), vote(0.6, 0.05), vote(0.7, 0.01), vote(0.5, 0.1)], axis=1)
    copy = np.where(rng.random(4000) < 0.95, votes[:, 3], ~votes[:, 3])
    votes = np.column_stack([votes, copy]).astype(np.int8)
    ones = np.ones(len(votes))
    model = fit_label_model(votes, ones, np.clip(votes[:, 0] * 0.8, 0.1, 0.9))
    assert abs(model.prior - 0.3) < 0.06
    post = model.posterior(votes)
    assert ((post > 0.5) == y).mean() > 0.9
    tree = dependency_tree(votes, ones, post)
    assert tree[4] == 3 or tree[3] == 4


def test_posterior_and_one_round_against_enumeration():
    """The posterior by multiplying out the tree's factors, the accuracies by counting weighted rows, one by one."""
    rng = np.random.default_rng(4)
    votes = (rng.random((300, 5)) < 0.4).astype(np.int8)
    votes[:, 4] = np.where(rng.random(300) < 0.9, votes[:, 2], votes[:, 4])
    rows, at, count = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    start = np.clip(rows[:, 0] * 0.7 + 0.1, 0, 1)
    model = fit_label_model(rows, count.astype(float), start, label=1, rounds=1)
    weights = start[at.reshape(-1)]
    for j in range(5):
        for y, w in ((0, 1 - weights), (1, weights)):
            overall = (sum(w[votes[:, j] == 1]) + 0.05) / (sum(w) + 1)
            for u in (0, 1):
                up = votes[:, model.parent[j]] if model.parent[j] >= 0 else np.zeros(300)
                want = (sum(w[(up == u) & (votes[:, j] == 1)]) + overall) / (sum(w[up == u]) + 1)
                want = min(want, LABEL_TRUST[0]) if (j, y) == (1, 1) else max(want, LABEL_TRUST[1]) if (j, y) == (1, 0) else want
                assert abs(model.fires[j, y, u] - np.clip(want, 1e-5, 1 - 1e-5)) < 1e-6
    assert (model.parent[4] == 2 or model.parent[2] == 4) and model.parent[1] == -1 and 1 not in model.parent
    for row, got in zip(rows, model.posterior(rows), strict=True):
        joint = [1 - model.prior, model.prior]
        for y in (0, 1):
            for j, v in enumerate(row):
                p = model.fires[j, y, row[model.parent[j]] if model.parent[j] >= 0 else 0]
                joint[y] *= p if v else 1 - p
        assert abs(got - joint[1] / sum(joint)) < 1e-5


def test_posteriors_may_disagree_with_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_model(docs, labels)
    ids = sorted(r.doc_id for r in labels.join(docs.select("doc_id"), "doc_id").select("doc_id").distinct().collect() if zlib.crc32(str(r.doc_id).encode()) % 5)
    given = {r.doc_id: r.toxic for r in labels.collect()}
    toxic = np.array([given[i] for i in ids])
    unlike = (model.posterior >= 0.5) != (toxic > 0)
    print(len(ids), toxic.sum(), unlike.sum(), np.abs(model.posterior - toxic).mean())
    assert len(model.posterior) == len(ids) and 10 <= unlike.sum() <= 0.1 * len(ids)


def test_rows_of_terms_in_both_forms():
    import pandas as pd

    class Shared:
        value = np.arange(0, 1000, 5).astype(np.uint32)

    frame = pd.DataFrame({"doc_id": [1, 2, 3], "toxic": [0, 1, 0], "patterns": [b""] * 3, "codes": [np.array([5, 6, 995]), np.arange(1000), np.array([], np.int64)]})
    got = list(_indexer(Shared)(iter([frame])))[0]["terms"]
    assert [_terms_of(x, 200).tolist() for x in got] == [[1, 199], list(range(200)), []] and max(map(len, got)) == 26


def test_lexicon_has_no_doubles():
    words = [w for line in LEXICON.values() for w in line.split()]
    assert all(w == w.lower() for w in words)
