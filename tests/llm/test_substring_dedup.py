import random

from cellweave.llm.substring_dedup import MAX_CHUNK, MIN_CHUNK, chunk_ends, chunks, repeated_passages


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))


def test_chunks_cover_the_text_and_resist_shifts():
    rng = random.Random(0)
    text = prose(rng, 3000).encode()
    ends = chunk_ends(text)
    assert ends[-1] == len(text) and all(MIN_CHUNK <= b - a <= MAX_CHUNK for a, b in zip([0, *ends], ends[:-1], strict=False))
    shifted = b"inserted words " + text
    own = {text[a:b] for a, b in zip([0, *ends], ends, strict=False)}
    moved = chunk_ends(shifted)
    assert len(own & {shifted[a:b] for a, b in zip([0, *moved], moved, strict=False)}) > 0.97 * len(own)
    assert chunk_ends(b"") == [] and chunk_ends(b"x" * 5000)[-1] == 5000


def test_planted_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(1)
    rows, planted = [], set()
    for k in range(60):
        passage = prose(rng, 51)
        for doc in (2 * k, 2 * k + 1):
            rows.append((doc, prose(rng, rng.randint(0, 200)) + " " + passage + "  " + prose(rng, rng.randint(0, 200))))
            planted.add(doc)
    rows += [(1000 + k, prose(rng, 300)) for k in range(100)]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == planted
    text = dict(rows)
    for r in found:
        piece = text[r.doc_id].encode()[r.start : r.end].decode()
        assert piece in text[r.doc_id ^ 1] and r.is_first == (r.doc_id % 2 == 0) and r.first_doc_id == r.doc_id & ~1


def test_odd_rows(spark, odd, none):
    found = repeated_passages(odd, min_words=10).collect()
    assert {r.doc_id for r in found} == {1, 2} and repeated_passages(none).count() == 0
    own = chunks(odd).groupBy("doc_id").sum("size").collect()
    assert {r.doc_id for r in own} == {1, 2, 5, 6, 7, 8, 9}
