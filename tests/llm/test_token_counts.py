import public_tokenizers as P
import sentencepiece

from cellweave.llm import token_counts as T
from cellweave.llm.token_counts import op10_token_counts, token_counts

PATH = P.path("piece_bpe_32k.model")


def brute(rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return sorted(((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows), key=str)


def test_odd_rows_and_warm_cache(spark, odd, none, tmp_path, monkeypatch):
    cache = f"file://{tmp_path}/cache"
    want = brute([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(map(tuple, token_counts(odd, PATH, cache).collect()), key=str) == want
    assert spark.read.parquet(cache).count() == odd.na.fill("", ["text"]).select("text").distinct().count()
    before = spark.read.parquet(cache).count()
    assert sorted(map(tuple, token_counts(odd, PATH, cache).collect()), key=str) == want
    assert spark.read.parquet(cache).count() == before
    assert token_counts(none, PATH, cache).count() == 0


def test_json_tokenizer_has_its_own_version(odd, tmp_path, spark):
    cache = f"file://{tmp_path}/cache"
    token_counts(odd, PATH, cache).collect()
    token_counts(odd, P.path("byte_bpe_50k.json"), cache).collect()
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op10_token_counts(spark, sf).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == brute(rows)
    assert all(r.over_limit == (r.n_tokens > T.LIMIT) for r in got)
