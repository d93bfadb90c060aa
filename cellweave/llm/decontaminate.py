"""Benchmark passages in documents, found by Wu-Manber multi-pattern search over words.

The patterns are windows of consecutive benchmark words. A table gives, for each pair of words that occurs in a
pattern, how far the scan may shift; a pair that occurs in none skips almost a whole window. Where the shift is
zero, the pair selects the few patterns that end in it, and these are compared word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, text_of, unused, written

WINDOW = 10
#: Windows that one search pass holds in memory; more are searched in further passes.
PASS_WINDOWS = 1 << 18
#: Bytes of text cut into words at once.
_AT_ONCE = 1 << 22
#: A-Z to lower case; ASCII characters but letters and digits to a space. Other bytes belong to words.
_FOLD = bytes(ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(0x80)) + bytes(range(0x80, 0x100))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _parts(text: str) -> Iterator[list[bytes]]:
    """The words of a text, some MB at a time."""
    raw = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + _AT_ONCE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


class WuManber:
    """Search for word sequences of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[int]]):
        self.m = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.skip = m - b + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.ending: dict[tuple[bytes, ...], list[tuple[list[bytes], list[int]]]] = {}
        for pattern, items in patterns.items():
            for end in range(b, m + 1):
                key = pattern[end - b : end]
                self.shift[key] = min(self.shift.get(key, self.skip), m - end)
            self.ending.setdefault(pattern[m - b :], []).append((list(pattern), items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(first word, items) of each occurrence, in order."""
        m, skip, shift, ending = self.m, self.skip, self.shift, self.ending
        at, n = m - 1, len(words)
        while at < n:
            key = (words[at - 1], words[at]) if self.block == 2 else (words[at],)
            step = shift.get(key, skip)
            if step:
                at += step
                continue
            own = words[at - m + 1 : at + 1]
            for pattern, items in ending[key]:
                if pattern == own:
                    yield at - m + 1, items
            at += 1


def _scan(text: str, searches: list[WuManber]) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Words, disjoint stretches of hit words, and items found in one whole text."""
    longest = max((s.m for s in searches), default=1)
    base, kept, total = 0, [], 0
    stretches: set[tuple[int, int]] = set()
    items: set[int] = set()
    for words in _parts(text):
        total += len(words)
        words = kept + words
        for s in searches:
            for at, found in s.find(words):
                stretches.add((base + at, base + at + s.m))
                items.update(found)
        kept = words[max(0, len(words) - longest + 1) :]
        base += len(words) - len(kept)
    return total, merged(stretches), items


def merged(stretches) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Each item's windows, a row per distinct (``item``, ``words``); an item of fewer words is one window, one of none has none."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                own = sorted({b" ".join(words[k : k + window]) for k in range(max(1, len(words) - window + 1))}) if words else []
                for at in range(0, len(own), 10_000):
                    part = own[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(part), pa.int64()), pa.array(part, pa.binary())], ["item", "words"])

    slim = benchmark.select(F.col(id_col).cast("long").alias("item"), text_of(text_col).alias("text")).where("item is not null")
    return slim.mapInArrow(windows, "item long, words binary").distinct()


def _searcher(tables, out_type: pa.Schema, words_of_text: str, own: str):
    """Adds what is found to ``own``: struct of words, stretches and items, joined to what earlier passes found."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = tables.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = []
                for text, old in zip(part.column(words_of_text), part.column(own), strict=True):
                    n, stretches, items = _scan(text.as_py() or "", searches)
                    old = old.as_py()
                    stretches = merged([*stretches, *((x["a"], x["b"]) for x in old["stretches"])])
                    found.append({"words": n, "stretches": [{"a": a, "b": b} for a, b in stretches], "items": sorted(items | set(old["items"]))})
                arrays = [pa.array(found, out_type.field(own).type) if name == own else part.column(name) for name in out_type.names]
                yield pa.RecordBatch.from_arrays(arrays, schema=out_type)

    return search


FOUND = "struct<words: long, stretches: array<struct<a: long, b: long>>, items: array<long>>"


def search_windows(docs: DataFrame, windows: DataFrame, text_col: str = "text", pass_windows: int = PASS_WINDOWS, found_col: str = "found_") -> DataFrame:
    """``docs`` with the column ``found_col``: its number of words, the disjoint stretches of hit words, the items.

    The windows are counted first. Each pass takes those of one hash class, about ``pass_windows`` of them, to
    the driver and broadcasts their tables, so both stay bounded whatever the benchmark's size. The documents are
    never shuffled; between two passes they are written, so that no task holds the tables of more than one. A column
    of ``docs`` named ``found_col`` is replaced; all others stay, whatever their names. Null texts have no words,
    repeated rows stay repeated, and an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    windows = written(windows, "windows")
    passes = max(1, -(-windows.count() // pass_windows))
    text = unused(docs, "text_")[0]
    found = docs.withColumn(text, text_of(text_col)).withColumn(found_col, F.from_json(F.lit('{"words": 0, "stretches": [], "items": []}'), FOUND))
    schema = found.schema
    arrow = to_arrow_schema(schema)
    for k in range(passes):
        by_length: dict[int, dict[tuple[bytes, ...], list[int]]] = {}
        for item, words in windows.where(F.pmod(F.xxhash64("item", "words"), F.lit(passes)) == k).collect():
            pattern = tuple(bytes(words).split(b" "))
            by_length.setdefault(len(pattern), {}).setdefault(pattern, []).append(item)
        tables = docs.sparkSession.sparkContext.broadcast([WuManber(x) for x in by_length.values()])
        found = found.mapInArrow(_searcher(tables, arrow, text, found_col), schema)
        if k < passes - 1:
            found = written(found, "windows-searched")
    return found.drop(text)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """``doc_id``, ``found_`` and a row per document; a null text has no words, repeated rows stay repeated."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return search_windows(slim, benchmark_windows(benchmark), pass_windows=pass_windows).drop("text")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) in which no benchmark window occurs; an empty table gives none."""
    found = unused(docs, "found")[0]
    return search_windows(docs, benchmark_windows(benchmark), text_col, found_col=found).where(F.size(f"{found}.stretches") == 0).drop(found)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("found_.stretches", F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"])
    names = F.array_join(F.sort_array(F.transform("found_.items", lambda x: x.cast("string"))), ",")
    return rows.select("doc_id", F.col("found_.words").alias("n_words"), hit.alias("n_hit"), F.size("found_.items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
