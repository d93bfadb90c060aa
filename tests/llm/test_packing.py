import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from cellweave.llm.packing import WordEncoder, packed_documents, plan_bins, slots

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_library(library, spark, sf):
    encode = WordEncoder(PATH)
    odd = ["a'b don't it's 'S <|endoftext|>x İstanbul ΣΣ é ́x", "\x01 a\x01b 12ab34,,,-- x　y​z", "x" * 5000 + " \U0001f600\U0001f600! A\x1cB a\x85b", "", " \n\t ", "ÉCOLE, École; école. naïve×÷ 'tis '.'s.", "<|startoftext|>,<|ENDOFTEXT|>", ",s '.d ,'s, a,'t", "a—b,—c —,d ,é é, É,É x\u0301,y ,\u0301 \x01,a a,\x01 \x7f. .\x7f", "A.B.C 3.14,15 (x)[y]{z} a_b#c @d!e?f;g:h", "<|x A,B"]
    texts = odd + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for own in (encode([t.encode() for t in texts]), encode([t.encode() for t in texts]), [encode([t.encode()])[0] for t in texts]):
        for t, ids in zip(texts, own, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_other_tokenizers_encode_whole_texts():
    path = P.path("byte_bpe_50k.json")
    other, encode = Tokenizer.from_file(path), WordEncoder(path)
    assert not encode.by_words and WordEncoder(PATH).by_words
    texts = ["Hello there,  two spaces\nand LINES", "don't <|endoftext|> x", "", "É 中文 😀"]
    for t, ids in zip(texts, encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode(t, add_special_tokens=False).ids


def test_random_texts_equal_the_library(library):
    rng = random.Random(5)
    encode, alphabet = WordEncoder(PATH), list("abcXYZ019 ,.'!-\t\n") + ["é", "É", "ß", "×", "—", "\u0301", "\x01", "\u00a0", "\u0130", "中", "<|", "|>", "'s", "'RE", "ſ"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(4000)]
    for t, ids in zip(texts, encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def check(rows, found, library):
    pieces = {}
    for r in found:
        pieces.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append((r.sequence_id, r.offset))
    want = Counter()
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            own = ids[k : k + 2048]
            want[doc, k // 2048, k, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter({k: len(v) for k, v in pieces.items()}) == want
    bins = {}
    for (_, _, _, length, _), places in pieces.items():
        for s, o in places:
            bins.setdefault(s, []).append((o, length))
    for own in bins.values():
        at = 0
        for o, length in sorted(own):
            assert o == at
            at += length
        assert at <= 2048
    return bins


def test_whole_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bins = check([(r.doc_id, r.text) for r in docs.collect()], packed_documents(docs, PATH).collect(), library)
    total = sum(length for own in bins.values() for _, length in own)
    assert len(bins) <= -(-total // 2048) * 1.05 + 1


def test_odd_rows(odd, none, library):
    check([(r.doc_id, r.text) for r in odd.collect()], packed_documents(odd, PATH).collect(), library)
    assert packed_documents(none, PATH).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    top = rng.choice([3, 20, 100, 2048])
    counts = {rng.randint(1, top): rng.randint(1, 500) for _ in range(rng.randint(1, 300))}
    plan = plan_bins(dict(counts), top)
    used = Counter()
    for pattern, n in plan:
        assert n > 0 and sum(length * times for length, times in pattern) <= top
        for length, times in pattern:
            used[length] += times * n
    assert used == Counter(counts)
    ends = {}
    for length, low, high, *_ in slots(plan):
        assert low == ends.get(length, 0)
        ends[length] = high
    assert ends == counts
    waste = sum(n for _, n in plan) - -(-sum(k * n for k, n in counts.items()) // top)
    best = sum(n for k, n in counts.items() if 2 * k > top)
    assert waste <= max(2, 0.25 * sum(n for _, n in plan)) or sum(n for _, n in plan) <= 1.25 * best


def test_exact_fills_come_first():
    plan = plan_bins({7: 3, 3: 1, 2: 1, 1: 4}, 10)
    assert sum(n for _, n in plan) == 3 and all(sum(a * b for a, b in p) == 10 for p, _ in plan)
