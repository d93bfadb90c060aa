import numpy as np
import xxhash
from pyspark.sql import functions as F

from cellweave.llm import simhash
from cellweave.llm.simhash import keep_one_of_each_group, near_duplicates, near_links, segments_for


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance=4):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    own = sorted(fps)
    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= distance:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {f: find(f) for f in own}


def check(rows, found):
    fps = {(i, t): brute_fingerprint(t) for i, t in rows}
    comp = brute_components(set(fps.values()))
    low = {}
    for (i, _), f in fps.items():
        if i is not None:
            low[comp[f]] = min(low.get(comp[f], i), i)
    want = sorted(((i, f"{fps[i, t]:016x}", low.get(comp[fps[i, t]])) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == want


def test_whole_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], near_duplicates(docs).collect())


def test_odd_rows(odd, none):
    check([(r.doc_id, r.text) for r in odd.collect()], near_duplicates(odd).collect())
    assert near_duplicates(none).count() == 0


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] == np.uint64(xxhash.xxh64_intdigest(b"a b c d", 42)).astype(np.int64)


def test_one_segment_differs_by_at_most_a_bit():
    cuts = segments_for(4)
    assert sum(n for _, n in cuts) == 64
    rng = np.random.default_rng(0)
    for _ in range(2000):
        bits = rng.choice(64, 4, replace=False)
        assert min(sum(a <= b < a + n for b in bits) for a, n in cuts) <= 1


def test_links_with_crowded_buckets(spark, monkeypatch):
    """Many fingerprints around few centres, with blocks so small that buckets are split."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(1)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 4, dtype=np.int64).tolist():
        for _ in range(80):
            f = centre
            for b in rng.choice(64, rng.integers(0, 6), replace=False).tolist():
                f ^= 1 << b
            fps.add(f & ((1 << 64) - 1))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = near_links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    unsigned = lambda x: x & ((1 << 64) - 1)
    assert all((unsigned(r.a) ^ unsigned(r.b)).bit_count() <= 4 for r in links)
    want = brute_components(fps)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        a, b = find(unsigned(r.a)), find(unsigned(r.b))
        parent[max(a, b)] = min(a, b)
    assert len({find(f) for f in fps}) == len(set(want.values()))


def test_one_of_each_group_stays(odd):
    kept = keep_one_of_each_group(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 8, 9] and ids.count(None) == 1
