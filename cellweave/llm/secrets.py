"""Secrets in texts: fixed patterns, and formats learned by grammar inference.

For each format, labelled credentials make a prefix tree whose compatible states are merged, by a statistical
test of their outgoing frequencies, into a probabilistic automaton. Every candidate string of a text is scored by
its likelihood under each automaton against a background automaton learned in the same way from strings that
are no credentials.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, text_of

KINDS = ("assign", "access", "hex", "learned")
ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_HINTS = ("passw", "secret", "token", "api")
#: Labelled credentials per format, and the longest stretch of a candidate that is scored at a time.
EXAMPLES, MAX_SCORED = 80, 512
#: The score a candidate needs: mean log-likelihood ratio a character, and its sum.
MARGIN, TOTAL = 0.4, 14.0
MIN_CANDIDATE = 16

_UP, _LOW, _DIGIT = string.ascii_uppercase, string.ascii_lowercase, string.digits
_ALNUM, _URL = _UP + _LOW + _DIGIT, _UP + _LOW + _DIGIT + "-_"
#: The public shapes of credentials, as (literal start, alphabet, length) parts.
FORMATS: dict[str, list[list[tuple[str, str, int]]]] = {
    "cloud access key": [[("AKIA", _UP + "234567", 16)], [("ASIA", _UP + "234567", 16)]],
    "repository token": [[(f"{p}_", _ALNUM, 36)] for p in ("ghp", "gho", "ghu", "ghs", "ghr")],
    "chat token": [[("xoxb-", _DIGIT, 12), ("-", _DIGIT, 12), ("-", _ALNUM, 24)], [("xoxp-", _DIGIT, 12), ("-", _DIGIT, 12), ("-", _ALNUM, 24)]],
    "payment key": [[("sk_live_", _ALNUM, 24)], [("rk_live_", _ALNUM, 24)], [("sk_test_", _ALNUM, 24)]],
    "maps key": [[("AIza", _URL, 35)]],
    "package token": [[("npm_", _ALNUM, 36)]],
    "mail key": [[("SG.", _URL, 22), (".", _URL, 43)]],
    "web token": [[("eyJ", _URL, 33), (".eyJ", _URL, 60), (".", _URL, 43)]],
    "hex digest key": [[("", "0123456789abcdef", 40)], [("", "0123456789ABCDEF", 40)], [("", "0123456789abcdef", 64)]],
}


def labelled_credentials(seed: int = 11, n: int = EXAMPLES) -> dict[str, list[str]]:
    rng = random.Random(seed)
    draw = lambda parts: "".join(start + "".join(rng.choices(alphabet, k=size)) for start, alphabet, size in parts)
    return {name: [draw(rng.choice(shapes)) for _ in range(n)] for name, shapes in FORMATS.items()}


def labelled_others(seed: int = 12, n: int = 600) -> list[str]:
    """Long strings without spaces that are no credentials: paths, names, numbers, dates, versions, ruled lines."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") + rng.choice(["", "", "n", "r", "s", "th"]) for _ in range(rng.randint(1, 4)))
    part = lambda: rng.choice(["", *"bcdfghjklmnpqrstvwxyz", "qu", "ch", "tr"]) + rng.choice([*"aeiouy", "ai", "ei", "ie", "eau", "io", "ue"]) + rng.choice(["", "", *"lmnrstx", "nt", "ll", "ng", "ch", "rk"])
    letters = lambda low=2, high=9: "".join(part() for _ in range(rng.randint(low, high)))
    number = lambda k=8: "".join(rng.choices(_DIGIT, k=rng.randint(1, k)))
    make = [
        lambda: "/".join(word() for _ in range(rng.randint(2, 6))) + rng.choice([".html", ".py", ".json", "/"]),
        lambda: "_".join(word() for _ in range(rng.randint(3, 6))) + number(3),
        lambda: "-".join(word() for _ in range(rng.randint(3, 6))) + "-" + number(4),
        lambda: "".join(word().capitalize() for _ in range(rng.randint(2, 5))) + number(3),
        lambda: ".".join(word() for _ in range(rng.randint(2, 4))) + "." + number(3),
        lambda: number(8) + "." + number(8) + rng.choice(["", "-"]) + number(8),
        lambda: "-".join(number(4) for _ in range(rng.randint(3, 6))),
        lambda: "".join(rng.choices(_DIGIT, k=rng.randint(16, 24))),
        lambda: rng.choice("=-_.") * rng.randint(16, 60),
        lambda: f"20{rng.randint(10, 30)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{number(2)}.{number(6)}",
        lambda: "".join(word() for _ in range(6)),
        lambda: letters(5, 12),
        lambda: letters(5, 12).capitalize(),
        lambda: letters(5, 12).upper(),
        lambda: "".join(letters(1, 4).capitalize() for _ in range(rng.randint(2, 5))),
        lambda: rng.choice("_-./=").join(letters(1, 4) for _ in range(rng.randint(3, 7))),
        lambda: word().upper() + "_" + word().upper() + "_" + word().upper() + number(2),
    ]
    return [rng.choice(make)() for _ in range(n)]


def symbols(text: str) -> str:
    """The first four characters as they are, the rest by class: digits, hex and other letters by case, marks as they are."""
    kind = lambda c: "0" if c in _DIGIT else "a" if c in "abcdef" else "z" if c in _LOW else "A" if c in "ABCDEF" else "Z" if c in _UP else c
    return text[:4] + "".join(map(kind, text[4:]))


@dataclass
class State:
    visits: int = 0
    ends: int = 0
    to: dict[str, int] = field(default_factory=dict)
    count: dict[str, int] = field(default_factory=dict)


class Automaton:
    """A probabilistic automaton inferred by merging prefix-tree states whose frequencies don't differ significantly."""

    def __init__(self, examples: list[str], alpha: float = 0.05):
        self.states = [State()]
        for text in examples:
            at = 0
            for c in symbols(text):
                s = self.states[at]
                s.visits += 1
                if c not in s.to:
                    s.to[c] = len(self.states)
                    self.states.append(State())
                s.count[c] = s.count.get(c, 0) + 1
                at = s.to[c]
            self.states[at].visits += 1
            self.states[at].ends += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()
        alphabet = len(set("".join(symbols(x) for x in examples))) + 8
        self.log = [{c: math.log((n + 0.05) / (s.visits + 0.05 * alphabet)) for c, n in s.count.items()} for s in self.states]
        self.other = [math.log(0.05 / (s.visits + 0.05 * alphabet)) for s in self.states]
        self.end = [math.log((s.ends + 0.05) / (s.visits + 0.05 * alphabet)) for s in self.states]

    def _differ(self, a: int, na: int, b: int, nb: int) -> bool:
        return na > 0 and nb > 0 and abs(a / na - b / nb) > self.bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))

    def _compatible(self, p: int, q: int) -> bool:
        stack = [(p, q)]
        while stack:
            p, q = stack.pop()
            a, b = self.states[p], self.states[q]
            if self._differ(a.ends, a.visits, b.ends, b.visits):
                return False
            for c in a.to.keys() | b.to.keys():
                if self._differ(a.count.get(c, 0), a.visits, b.count.get(c, 0), b.visits):
                    return False
                if c in a.to and c in b.to and a.to[c] != b.to[c]:
                    stack.append((a.to[c], b.to[c]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Adds the subtree of ``q`` to ``p``; ``q`` is still a tree, so this ends."""
        stack = [(p, q)]
        while stack:
            p, q = stack.pop()
            a, b = self.states[p], self.states[q]
            a.visits += b.visits
            a.ends += b.ends
            for c, at in b.to.items():
                a.count[c] = a.count.get(c, 0) + b.count[c]
                if c in a.to:
                    stack.append((a.to[c], at))
                else:
                    a.to[c] = at

    def _merge_all(self) -> None:
        kept = [0]
        fringe = [(0, c) for c in sorted(self.states[0].to)]
        while fringe:
            p, c = fringe.pop(0)
            q = self.states[p].to[c]
            if q in kept:
                continue
            match = next((k for k in kept if k != 0 and self._compatible(k, q)), None)
            if match is None:
                kept.append(q)
                fringe += [(q, x) for x in sorted(self.states[q].to)]
            else:
                self.states[p].to[c] = match
                self._fold(match, q)
                fringe = [(k, x) for k in kept for x in sorted(self.states[k].to) if self.states[k].to[x] not in kept]

    def log_likelihood(self, coded: str) -> float:
        at, total = 0, 0.0
        for c in coded:
            step = self.states[at].to.get(c)
            if step is None:  # never seen here: the character counts as unseen, and the state is kept for the next one
                total += self.other[at]
                continue
            total += self.log[at][c]
            at = step
        return total + self.end[at]


@lru_cache(maxsize=1)
def automata() -> tuple[dict[str, Automaton], Automaton]:
    """The formats' automata and the background; small, deterministic, and fitted once in each Python worker."""
    return {name: Automaton(own) for name, own in labelled_credentials().items()}, Automaton(labelled_others())


@lru_cache(maxsize=1 << 16)
def format_score(candidate: str) -> float:
    """The best mean log-likelihood ratio a character over all formats, or minus infinity if its sum is too small."""
    formats, background = automata()
    coded = symbols(candidate[:MAX_SCORED])
    ratio = max(a.log_likelihood(coded) for a in formats.values()) - background.log_likelihood(coded)
    return ratio / len(coded) if ratio >= TOTAL else -math.inf


#: The literal starts of the formats with the lengths their credentials have.
_LENGTHS: dict[str, set[int]] = {}
for _shapes in FORMATS.values():
    for _parts in _shapes:
        if _parts[0][0]:
            _LENGTHS.setdefault(_parts[0][0], set()).add(sum(len(start) + size for start, _, size in _parts))
_LITERAL = re.compile("(?=(" + "|".join(map(re.escape, sorted(_LENGTHS))) + "))")
#: Marks at which a run is split, the coarser first.
_SPLITS = tuple(re.compile(rf"[^{marks}]+") for marks in ("=/", "=/.", "=/.-"))


def _scored(run: str, a: int, b: int) -> Iterator[tuple[int, int]]:
    """The parts of ``run[a:b]``, less the marks at its ends, that look like a credential: it as a whole, or its stretches of ``MAX_SCORED``."""
    own = run[a:b].strip(".=-")
    if len(own) < MIN_CANDIDATE:
        return
    at = a + run[a:b].index(own)
    last = at + len(own) - min(len(own), MAX_SCORED)
    hits = [k for k in [*range(at, last, MAX_SCORED), last] if format_score(run[k : min(k + MAX_SCORED, at + len(own))]) >= MARGIN]
    while hits:
        begin = end = hits[0]
        while hits and hits[0] <= end:
            end = min(hits.pop(0) + MAX_SCORED, at + len(own))
        yield begin, end


def _learned(run: str) -> list[tuple[int, int]]:
    """Learned formats' spans in a run: from literal starts, then in pieces between marks, then in the run as a whole; none overlap."""
    found: list[tuple[int, int]] = []

    def add(pieces: Iterator[tuple[int, int]]) -> None:
        found.extend(p for p in pieces if not any(p[0] < e and s < p[1] for s, e in found))

    for m in _LITERAL.finditer(run):
        at = m.start()
        ends = {e for n in _LENGTHS[m[1]] if (e := at + n) <= len(run) and not run[e : e + 1].isalnum()}
        ends |= {split.match(run, at).end() for split in _SPLITS[:2]} if not ends else set()
        best = max(((format_score(run[at:e]), at, e) for e in ends if MIN_CANDIDATE <= e - at <= MAX_SCORED), default=(-math.inf, 0, 0))
        if best[0] >= MARGIN:
            add(iter([best[1:]]))
    for split in _SPLITS:
        for m in split.finditer(run):
            add(_scored(run, *m.span()))
    add(_scored(run, 0, len(run)))
    return found


_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[list((_ALNUM + "+/_.=-").encode())] = True


def _candidates(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of at least ``MIN_CANDIDATE`` characters that credentials may hold; code points."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    fits = np.zeros(len(raw) + 2, np.int8)
    fits[1:-1] = _CANDIDATE[raw]
    change = np.diff(fits)
    begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    long = end - begin >= MIN_CANDIDATE
    begin, end = begin[long], end[long]
    if not len(begin):
        return
    points = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    yield from zip(points[begin].tolist(), points[end].tolist(), strict=True)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _outside(a: int, b: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The stretches of a run that no fixed pattern's span covers."""
    for s, _, e in base:
        if s < b and a < e:
            if s - a >= MIN_CANDIDATE:
                yield a, s
            a = max(a, e)
    if b - a >= MIN_CANDIDATE:
        yield a, b


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The fixed patterns' spans, and these with the learned formats' spans that overlap none of them."""
    base = base_spans(text)
    more = []
    for a, b in _candidates(text):
        for s, e in _outside(a, b, base):
            more += [(s + x, 3, s + y) for x, y in _learned(text[s:e])]
    return base, sorted(base + more)


def written_spans(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            both = [spans(t.as_py()) for t in part.column(1)]
            counts = [pa.array([sum(k == kind for _, k, _ in base) for base, _ in both], pa.int64()) for kind in range(3)]
            yield pa.RecordBatch.from_arrays([part.column(0), *counts, pa.array([hashlib.sha256(written_spans(b).encode()).hexdigest() for b, _ in both]), pa.array([written_spans(x) for _, x in both])], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, a row per document, each whole text scanned in its task.

    A null text counts as empty; a null id stays null; repeated rows stay; an empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return slim.mapInArrow(_scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(read_table(spark, sf_dir, "documents"))
