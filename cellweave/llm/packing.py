"""Best-fit packing of token sequences by exact-complement hashing over the histogram of lengths.

Only the counts of the lengths 1 to ``capacity`` decide how pieces go together, so the plan is made on that
bounded histogram: single, pair and triple sums of lengths are looked up to fill gaps exactly, as often as the
counts allow; what is left is packed best-fit, longest first. The pieces themselves never leave the executors:
each gets its rank among the pieces of its length, and ranges of ranks are mapped to sequences.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, text_of, written

CAPACITY = 2048
#: Words whose ids a worker remembers; longer words are encoded each time.
CACHE_WORDS, CACHE_BYTES = 3 << 17, 32
#: Bytes of text cut into words at once.
_AT_ONCE = 1 << 20
_SPACE = b" \t\n\r\x0b\x0c"


#: Runs of ASCII punctuation but apostrophes that stand between letters, digits and spaces: the tokenizer splits there.
_MARKS = re.compile(rb"(?<![\x00-\x08\x0e-\x1f!-/:-@\[-`{-~\x7f])(?:(?<![\x80-\xff])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))[!-&(-/:-@\[-`{-~]++(?![\x00-\x08\x0e-\x1f'\x7f])(?:(?![\x80-\xff])|(?=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))")
#: Lower-case words of ASCII and Latin-1 letters.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


_LETTERS = bytes(b for b in range(0x80) if chr(b).isalnum()) + _SPACE
_ASCII = bytes(range(0x80))
#: Control characters and the apostrophe, and two marks in a row, take the general pattern.
_DELICATE = set(range(0x20)) | {0x27, 0x7F}
_TWO_MARKS = re.compile(rb"[!-/:-@\[-`{-~]{2}")


def _marks_apart(run: bytes) -> bytes:
    """The text with ASCII letters in lower case and spaces around the marks that ``_MARKS`` finds."""
    low = run.lower()
    rest = low.translate(None, _LETTERS)
    marks, latin = {m for m in set(rest) if m < 0x80}, low.count(b"\xc3")
    only_letters = len(rest.translate(None, _ASCII)) == 2 * latin and not (latin and (b"\xc3\x97" in low or b"\xc3\xb7" in low))
    if not only_letters or marks & _DELICATE or _TWO_MARKS.search(low):
        return _MARKS.sub(rb" \g<0> ", low)
    for m in marks:
        low = low.replace(bytes([m]), b" %c " % m)
    return low


#: The splitter's pattern and the normalizer's steps for which texts may be encoded word by word.
_SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]


def goes_by_words(library) -> bool:
    """Whether this tokenizer gives a text's ids as its words' ids in turn: its normalizer, splitter and special strings are those that ``WordEncoder`` is made for."""
    own = json.loads(library.to_str())
    steps = (own["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    split = steps[0].get("pattern") == {"Regex": _SPLITTER} and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
    level = [x.get("type") for x in steps[1:]] == ["ByteLevel"] and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
    special = all(t["content"].startswith("<|") and not any(c.isspace() for c in t["content"]) for t in own["added_tokens"])
    return split and level and special and (own["normalizer"] or {}).get("normalizers") == _NORMALIZER and not own["post_processor"]


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit numbers, word by word with a bounded cache.

    Tokenizers for which ``goes_by_words`` doesn't hold encode whole texts. For the others, ASCII white space never meets other characters in this tokenizer: its normalizer neither composes nor
    lower-cases across it, its splitter drops it, and special strings hold none. So a text's ids are its words'
    ids in turn. ASCII letters may be lower-cased and marks set apart from letters beforehand, which leaves fewer
    distinct words, but not where a special string may stand.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.library, self.cache = Tokenizer.from_file(path), {}
        self.by_words = goes_by_words(self.library)
        self.library.no_truncation()
        self.library.no_padding()
        self.steps = self.library.normalizer, self.library.pre_tokenizer
        # Lower-case words of plain letters pass the normalizer and the splitter unchanged, so these are left out for them.
        self.plain_steps = None, Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.marks = {m: self.library.encode(m, add_special_tokens=False).ids for m in (",", "\x01")}

    def _many(self, words: list[bytes], mark: str, steps) -> list[bytes]:
        """Each word's ids, from one call of the library with a word of a single id between the words to tell them apart."""
        library = self.library
        library.normalizer, library.pre_tokenizer = steps
        sign = self.marks[mark]
        if len(sign) == 1 and len(words) > 1 and not any(mark.encode() in w for w in words):
            ids = np.array(library.encode_batch_fast([f" {mark} ".join([w.decode("utf-8") for w in words])], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == sign[0])
            if len(cuts) == len(words) - 1:  # else the mark's id comes from a word, too
                raw, ends = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
                return [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends, strict=False)]
        return [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch_fast([w.decode("utf-8") for w in words], add_special_tokens=False)]

    def _learn(self, words: set[bytes]) -> None:
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        for own, mark, steps in ((plain, ",", self.plain_steps), (list(words.difference(plain)), "\x01", self.steps)):
            for at in range(0, len(own), 1 << 14):
                part = own[at : at + (1 << 14)]
                self.cache.update(zip(part, self._many(part, mark, steps), strict=True))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text; new words of many texts are encoded together."""
        if not self.by_words:
            return [np.array(self.library.encode(t.decode("utf-8"), add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        out: list[list[bytes]] = [[] for _ in texts]
        group, held = [], 0
        for k, text in enumerate(texts):
            for run in _runs(text):
                group.append((k, run))
                held += len(run)
                if held > _AT_ONCE:
                    self._encode(group, out)
                    group, held = [], 0
        self._encode(group, out)
        return [b"".join(parts) for parts in out]

    def _encode(self, group: list[tuple[int, bytes]], out: list[list[bytes]]) -> None:
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        words = [(run if b"<|" in run else _marks_apart(run)).split() for _, run in group]
        new = set().union(*words).difference(cache)
        if new:
            self._learn(new)
        for (k, _), own in zip(group, words, strict=True):
            out[k].append(b"".join(map(cache.__getitem__, own)))
        for w in new:
            if len(w) > CACHE_BYTES:
                del cache[w]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One for each tokenizer in a Python worker, which runs many tasks in turn."""
    return WordEncoder(path)


def _runs(text: bytes) -> Iterator[bytes]:
    """The text in runs of about ``_AT_ONCE`` bytes that end at white space."""
    at = 0
    while at < len(text):
        end = at + _AT_ONCE
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end]
        at = end


def _cutter(path: str, end_id: int, capacity: int):
    last = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids", "task", "rank"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, task = encoder(path), [0] * (capacity + 1), TaskContext.get().partitionId()
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                rows, held = [], 0
                for doc, own_ids in zip(part.column(0).to_pylist(), encode([t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column(1)]), strict=True):
                    ids = own_ids + last
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        n = len(own) // 4
                        rows.append((doc, k, at // 4, n, own, task, seen[n]))
                        seen[n] += 1
                    held += len(ids)
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return cut


def cut_into_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of at most ``capacity``: the last may be shorter.

    Columns: ``doc_id, piece, start, length, ids`` (binary, little-endian), and ``task, rank``, which number the
    pieces of each length within their task.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return slim.mapInArrow(_cutter(tokenizer, end_id, capacity), "doc_id long, piece int, start long, length long, ids binary, task int, rank long")


def _exact(left: np.ndarray, gap: int) -> list[tuple[int, ...]]:
    """Available lengths that fill ``gap`` exactly: one, else two, else three; an empty list if none do.

    ``left`` holds how many pieces of each length are available.
    """
    if left[gap] > 0:
        return [(gap,)]
    have = left[: gap + 1] > 0

    def pair(total: int) -> int:
        """The largest b with b and total - b at hand (both twice if they are equal), or 0."""
        if total < 2:
            return 0
        both = have[1:total] & have[total - 1 : 0 : -1]
        if total % 2 == 0 and left[total // 2] < 2:
            both[total // 2 - 1] = False
        at = np.flatnonzero(both)
        return int(at[-1]) + 1 if len(at) else 0

    if b := pair(gap):
        return [(b, gap - b)]
    for a in np.flatnonzero(have[: gap - 1])[::-1]:
        left[a] -= 1
        have[a] = left[a] > 0
        b = pair(gap - int(a))
        left[a] += 1
        have[a] = True
        if b:
            return [(int(a), b, gap - int(a) - b)]
    return []


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """How to pack ``counts`` pieces by length into bins: ([(length, times), ...], number of such bins).

    Exact fills first, longest piece first; then best-fit decreasing, in whole classes of equal bins.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[list[tuple[int, int]], int]] = []
    if left[capacity]:
        plan.append(([(capacity, 1)], int(left[capacity])))
        left[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while left[length] > 0:
            left[length] -= 1  # the piece whose gap is to be filled
            found = _exact(left, capacity - length)
            left[length] += 1
            if not found:
                break
            use: dict[int, int] = {}
            for x in (length, *found[0]):
                use[x] = use.get(x, 0) + 1
            times = min(int(left[x]) // n for x, n in use.items())
            for x, n in use.items():
                left[x] -= n * times
            plan.append((sorted(use.items(), reverse=True), times))
    gaps: list[int] = []  # of open classes, ascending
    classes: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}

    def put(pattern: list[tuple[int, int]], times: int, gap: int) -> None:
        if times:
            if gap not in classes:
                classes[gap] = []
                insort(gaps, gap)
            classes[gap].append((pattern, times))

    for length in range(capacity - 1, 0, -1):
        n = int(left[length])
        while n:
            at = bisect_left(gaps, length)
            gap = gaps[at] if at < len(gaps) else capacity
            if at < len(gaps):
                pattern, bins = classes[gap].pop()
                if not classes[gap]:
                    del classes[gap]
                    gaps.pop(at)
            else:
                pattern, bins = [], n
            each = gap // length
            full = min(bins, n // each)
            put([*pattern, (length, each)], full, gap - each * length)
            n -= full * each
            rest = bins - full
            if rest and n:  # fewer than ``each`` are left: one more bin takes them
                put([*pattern, (length, n)], 1, gap - n * length)
                n, rest = 0, rest - 1
            if pattern:
                put(pattern, rest, gap)
    return plan + [x for group in classes.values() for x in group]


def slots(plan: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, times in a bin, first sequence, place in the bin) for ranges of ranks."""
    used: dict[int, int] = {}
    out, base = [], 0
    for pattern, bins in plan:
        place = 0
        for length, times in pattern:
            at = used.get(length, 0)
            used[length] = at + bins * times
            out.append((length, at, used[length], times, base, place))
            place += length * times
        base += bins
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written, so that ``task`` and ``rank`` stay) with ``sequence_id`` and ``offset``; ``task`` and ``rank`` go.

    What reaches the driver is a row per length, at most ``capacity`` rows; the table that is broadcast follows
    from these and has a few rows per length, however many pieces there are.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("task", "length").agg((F.max("rank") + 1).alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    first = counted.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges = spark.createDataFrame(slots(plan_bins(counts, capacity)), "length long, low long, high long, times long, base long, place long")
    ranked = pieces.join(first, ["task", "length"]).withColumn("at", F.col("first") + F.col("rank")).drop("task", "rank", "first")
    placed = ranked.join(F.broadcast(ranges), "length").where("at >= low and at < high")
    slot = F.expr("(at - low) % times")
    return placed.withColumns({"sequence_id": F.expr("base + (at - low) div times"), "offset": F.col("place") + slot * F.col("length")}).drop("at", "low", "high", "times", "base", "place")


def packed_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """All documents' pieces with the sequence and the place of each: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null text counts as empty and gives the end id alone; a null id stays null; repeated rows are packed as
    often as they come; further columns are ignored; an empty table gives no rows.
    """
    cut = cut_into_pieces(docs, tokenizer, id_col, text_col, end_id, capacity)
    slim = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "task", "rank")
    return pack(written(slim, "pieces"), capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
