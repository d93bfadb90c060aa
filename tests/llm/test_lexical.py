"""Ranked search against a plain scoring of every document, the choice of blocks against all ways to cut, and odd rows."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np

from cellweave.llm.lexical import cut_blocks, rank_documents, terms_of

SCHEMA = "doc_id long, text string, item_id string, score string, rank string, terms string, n string"


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(plain_terms(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, c in counts:
            m = 100 - 25 + (25 * c.total() * n_docs) // max(n_terms, 1)
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in terms.items() if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def ranked(spark, docs, items, **settings):
    d = spark.createDataFrame([(*r, "own", "own", "own", "own", "own") for r in docs], SCHEMA)
    i = spark.createDataFrame([(*r, "own") for r in items], "item_id long, text string, doc_id string")
    got = rank_documents(d.repartition(6), i, **settings).collect()
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got), key=repr)


def test_terms():
    for text in ("Ab-C9 é_Ü\x00x", "", " \n", "中文 a😀b", "A" * 1000, "\x7f\x80"):
        assert [t.decode() for t in terms_of(text)] == plain_terms(text)


def test_blocks_have_the_least_cost():
    rng = np.random.default_rng(2)

    def cost(score, ends, fixed):
        return sum(int(score[a:b].max()) * (b - a) - int(score[a:b].sum()) + fixed for a, b in itertools.pairwise([0, *ends]))

    for n, fixed, most in [(1, 5, 4), (7, 30, 4), (9, 0, 3), (10, 100, 20), (10, 15, 10), (10, 10**6, 20)]:
        score = rng.integers(1, 100, n)
        got = cut_blocks(np.array([0, n]), score, unit=1, most=most, cost=fixed)
        ways = (list(inner) + [n] for r in range(n) for inner in itertools.combinations(range(1, n), r))
        assert cost(score, got, fixed) == min(cost(score, w, fixed) for w in ways if max(np.diff([0, *w])) <= most)
    starts = np.array([0, 0, 13, 14, 14, 40])  # several lists at once equal each alone
    score = rng.integers(1, 1000, 40)
    together = cut_blocks(starts, score, unit=2, most=3, cost=300)
    alone = [a + e for a, b in itertools.pairwise(starts) for e in cut_blocks(np.array([0, b - a]), score[a:b], unit=2, most=3, cost=300)]
    assert together.tolist() == alone and set(starts[1:]) - {0} <= set(together.tolist())


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(20_000)]
    docs = [(k * 3, " ".join(rng.choices(words, k=rng.choice([1, 5, 30, 200])))) for k in range(n)]
    docs += [(10**6 - k, docs[5][1]) for k in range(n // 3)]  # copies: ties by id
    rng.shuffle(docs)
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 3, 12, 40])))) for k in range(25)] + [(100, docs[0][1]), (101, "nowhere to be found"), (102, None)]
    return docs, items


def test_ranking_equals_brute_force_at_any_shard_and_pass_size(spark):
    docs, items = corpus(900, 4)
    want = brute(docs, items)
    assert ranked(spark, docs, items) == want
    assert ranked(spark, docs, items, shard_postings=600, pass_terms=60) == want
    assert ranked(spark, docs, items, k=3) == brute(docs, items, 3)


def test_odd_rows(spark):
    long_text = " ".join(f"word{k % 977}" for k in range(60_000))
    docs = [(1, "Some words here"), (1, "Some words here"), (None, "some WORDS"), (None, None), (2, ""), (3, None), (4, long_text), (5, "x" * 100_000), (6, "éàü 中文字 😀")]
    items = [(1, "some words"), (1, "words"), (2, ""), (3, None), (None, "中文字 word5"), (4, "words words")]
    assert ranked(spark, docs, items) == brute(docs, items)
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == []
