import hashlib
import re

from cellweave.llm import decontaminate
from cellweave.llm.decontaminate import WuManber, contamination, op8_decontamination, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    own = words(text)
    hit, found = set(), set()
    for item, body in items:
        w = words(body)
        for k in range(max(1, len(w) - 9)) if w else []:
            window = w[k : k + 10]
            for at in range(len(own) - len(window) + 1):
                if own[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(item)
    return len(own), len(hit), sorted(found)


def compare(rows, items, got):
    want = sorted(((i, *brute(t, items)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.found_.words, sum(x.b - x.a for x in r.found_.stretches), list(r.found_.items)) for r in got), key=str) == want


ITEMS = [(1, "The quick brown fox jumps over the lazy dog today and"), (2, "A second LINE of words"), (3, None), (4, "--- ..."), (5, "short"), (6, "word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11 word12"), (7, "the quick brown fox jumps over the lazy dog today and"), (8, "中文字 😀")]


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    compare([(r.doc_id, r.text) for r in odd.collect()], ITEMS, contamination(odd, items).collect())
    assert contamination(none, items).count() == 0
    assert contamination(odd, items.limit(0)).where("size(found_.items) > 0").count() == 0


def test_several_passes_find_the_same(spark, odd, monkeypatch):
    monkeypatch.setattr(decontaminate, "_AT_ONCE", 4096)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    one = decontaminate.search_windows(odd.select("doc_id", "text"), decontaminate.benchmark_windows(items)).collect()
    more = decontaminate.search_windows(odd.select("doc_id", "text"), decontaminate.benchmark_windows(items), pass_windows=3).collect()
    assert sorted(map(str, one)) == sorted(map(str, more))


def test_query_on_the_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in op8_decontamination(spark, sf).collect()}
    for doc, text in docs:
        n, hit, found = brute(text, items)
        r = got[doc]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()


def test_overlapping_occurrences():
    search = WuManber({(b"a", b"b", b"a"): [1]})
    assert [at for at, _ in search.find(b"a b a b a c a b".split())] == [0, 2]


def test_contaminated_rows_go(spark, odd):
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    kept = without_contaminated(odd, items)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3, 4, 5, 6, 7, 8, 9]
