"""Toxicity scores by weak supervision.

Many weak voters look at a text: terms of a fixed lexicon, terms mined from labelled texts, and patterns. A
generative label model estimates each voter's accuracy, and the correlations of voters as a tree of conditional
dependencies, by expectation maximisation that starts from what the terms and patterns say. The given label is one more
voter, of an accuracy held below one, so that others can outvote it. A linear classifier is then trained on the
posterior labels and scores every text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, text_of, written

#: Common insults in the four languages of the corpus.
LEXICON = {
    "en": "asshole bastard bitch clown creep cretin degenerate disgusting dumb fool freak garbage idiot imbecile jerk loser lunatic moron pathetic pig retard scum slut stupid trash ugly vermin whore worthless",
    "de": "abschaum arschloch blödmann dreck dummkopf idiot miststück mistkerl schlampe schwachkopf trottel versager widerlich wichser",
    "fr": "abruti bouffon connard connasse crétin débile dégueulasse imbécile minable ordure pourriture salaud salope",
    "es": "asqueroso basura cabrón escoria estúpido gilipollas idiota imbécil inútil patético payaso perdedor puta tonto zorra",
}
#: Voters that look at the text's form.
PATTERNS = {
    "address": re.compile(r"\b(?:you|your|you're|du|ihr|tu|toi|vous|usted|eres)\b[^.!?\n]{0,40}!"),
    "shouting": re.compile(r"\b[A-Z]{4,}\b[^a-z\n]{0,20}\b[A-Z]{4,}\b"),
    "masked": re.compile(r"\b[A-Za-z]{1,3}[*@#$]{2,}[A-Za-z]{0,4}\b"),
    "exclaims": re.compile(r"!{2,}"),
    "threat": re.compile(r"\b(?:kill|shut up|go to hell|hate you|drop dead)\b", re.IGNORECASE),
}
#: Labelled rows the model is fitted on, at most: those with the least hashes.
TRAIN_ROWS = 20_000
#: Terms that vote besides the lexicon, and terms of the classifier. A row's terms come to the driver as numbers of 16
#: bits or as a bit each, whichever is shorter, so that the sample takes 12 MB at most however long its texts are.
MINED_TERMS, CLASSIFIER_TERMS = 240, 4096
#: Bounds of P(labelled toxic | toxic) and P(labelled toxic | not): a label is never taken as certain.
LABEL_TRUST = (0.97, 0.01)
#: Weight of a lexicon term where the sample tells nothing about the lexicon.
LEXICON_WEIGHT = 6.0
#: Bytes of a word's beginning that is a term of its own, for insults that the sample lacks but resemble others.
STEM = 7
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(0x100))


def terms(text: str) -> set[bytes]:
    """The distinct runs of letters, in lower case, and the beginnings of long ones; all non-ASCII characters count as letters."""
    words = set(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())
    return words | {b"^" + w[:STEM] for w in words if len(w) > STEM}


def _codes(words: set[bytes]) -> np.ndarray:
    return np.unique(np.fromiter(map(zlib.crc32, words), np.uint32, len(words)))


LEXICON_CODES = np.unique([zlib.crc32(w.encode()) for line in LEXICON.values() for w in line.split()]).astype(np.uint32)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


@dataclass
class LabelModel:
    """P(y) and, for each voter, P(fires | y, its parent in the tree fires or not)."""

    prior: float
    parent: np.ndarray  # of each voter, or -1
    fires: np.ndarray  # voter x y x parent's vote

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(y = 1 | votes) of each row, some thousand rows at a time."""
        out = np.empty(len(votes))
        yes, no = np.log(self.fires), np.log1p(-self.fires)
        odds = ((yes[:, 1] - yes[:, 0]).astype(np.float32), (no[:, 1] - no[:, 0]).astype(np.float32))  # voter x parent's vote
        at = np.arange(votes.shape[1])
        for k in range(0, len(votes), 4096):
            own = votes[k : k + 4096]
            up = np.where(self.parent >= 0, own[:, np.maximum(self.parent, 0)], 0)
            total = np.where(own == 1, odds[0][at, up], odds[1][at, up]).sum(axis=1) + np.log(self.prior / (1 - self.prior))
            out[k : k + 4096] = 1 / (1 + np.exp(-np.clip(total, -50, 50)))
        return out


def dependency_tree(votes: np.ndarray, count: np.ndarray, post: np.ndarray) -> np.ndarray:
    """The maximum spanning tree over the voters' mutual information given y; voters with next to none stay roots.

    ``votes`` holds distinct rows, ``count`` how often each occurs.
    """
    n, j = count.sum(), votes.shape[1]
    info = np.zeros((j, j))
    f = votes.astype(np.float32)
    for weight in (count * post, count * (1 - post)):
        total = weight.sum() + 1
        weighted = f * weight[:, None].astype(np.float32)
        both = (weighted.T @ f).astype(np.float64) + 0.25
        one = weighted.sum(axis=0, dtype=np.float64) + 0.5
        p11, p1 = both / total, one / total
        cells = ((p11, np.outer(p1, p1)), (p1[:, None] - p11, np.outer(p1, 1 - p1)), (p1[None, :] - p11, np.outer(1 - p1, p1)), (1 - p1[:, None] - p1[None, :] + p11, np.outer(1 - p1, 1 - p1)))
        info += total / n * sum(np.maximum(p, 1e-9) * np.log(np.maximum(p, 1e-9) / np.maximum(q, 1e-9)) for p, q in cells)
    np.fill_diagonal(info, 0)
    parent, best, source = np.full(j, -1), info[0].copy(), np.zeros(j, int)
    outside = np.ones(j, bool)
    outside[0] = False
    while outside.any():
        at = int(np.argmax(np.where(outside, best, -np.inf)))
        if best[at] > 3.0 / max(n, 1):
            parent[at] = source[at]
        outside[at] = False
        closer = info[at] > best
        best[closer], source[closer] = info[at][closer], at
    return parent


def fit_label_model(votes: np.ndarray, count: np.ndarray, start: np.ndarray, label: int | None = None, rounds: int = 15) -> LabelModel:
    """Expectation maximisation from the posterior ``start`` over distinct rows of votes that occur ``count`` times.

    The tree is fitted anew in each of the first rounds. Voter ``label`` is the given label: it has no parent, and
    its accuracy stays within ``LABEL_TRUST``.
    """
    post, j = start.astype(np.float64), votes.shape[1]
    model = None
    for k in range(rounds):
        parent = dependency_tree(votes, count, post) if k < 3 or model is None else model.parent
        if label is not None:
            parent = np.where(parent == label, -1, parent)
            parent[label] = -1
        up = np.where(parent >= 0, votes[:, np.maximum(parent, 0)], 0).astype(np.int8)
        fires = np.empty((j, 2, 2))
        for y, weight in ((0, count * (1 - post)), (1, count * post)):
            overall = (weight @ votes + 0.05) / (weight.sum() + 1)
            for u in (0, 1):
                there = up == u
                fires[:, y, u] = (weight @ (there & (votes == 1)) + overall) / (weight @ there + 1)
        fires = np.clip(fires, 1e-5, 1 - 1e-5)
        if label is not None:
            fires[label, 1] = np.minimum(fires[label, 1], LABEL_TRUST[0])
            fires[label, 0] = np.maximum(fires[label, 0], LABEL_TRUST[1])
        model = LabelModel(float(np.clip(count @ post / count.sum(), 1e-3, 1 - 1e-3)), parent, fires)
        post = model.posterior(votes)
    return model


def fit_linear(index: np.ndarray, size: np.ndarray, target: np.ndarray, terms: int, rounds: int = 200, penalty: float = 0.15) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels with an L1 penalty (accelerated proximal gradient).

    Row k holds the next ``size[k]`` numbers of ``index``, each a term below ``terms``; about a million of them are
    looked at at a time.
    """
    n, ends = len(size), np.cumsum(size)
    cuts = [0]
    while cuts[-1] < n:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, ends[cuts[-1]] - size[cuts[-1]] + (1 << 20), "right"))))
    parts = [(a, b, slice(ends[a] - size[a], ends[b - 1])) for a, b in zip(cuts, cuts[1:], strict=False)]
    w, b = np.zeros(terms), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    z, zb, t = w.copy(), b, 1.0
    df = np.bincount(index, minlength=terms)
    rate = 4.0 / (np.maximum(df, 1) * max(1.0, float(size.mean()) ** 0.5))  # by coordinate: rare terms take larger steps
    for _ in range(rounds):
        step, off = np.zeros(terms), 0.0
        for first, last, own in parts:
            owner = np.repeat(np.arange(last - first), size[first:last])
            score = np.bincount(owner, weights=z[index[own]], minlength=last - first) + zb
            miss = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - target[first:last]
            step += np.bincount(index[own], weights=miss[owner], minlength=terms)
            off += float(miss.sum())
        step = z - rate * step
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty * 2, 0)
        new_b = zb - 2.0 * off / n
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if ((z - new) * (new - w)).sum() > 0:  # overshot: start the momentum anew
            after = t = 1.0
        z, zb = new + (t - 1) / after * (new - w), new_b + (t - 1) / after * (new_b - b)
        w, b, t = new, new_b, after
    return w, b


class ToxicityModel:
    """What ``fit`` learns from labelled rows: term weights and an intercept. ``score`` takes texts."""

    def __init__(self, weights: dict[int, float], intercept: float, label_model: LabelModel | None = None, posterior: np.ndarray | None = None):
        self.weights, self.intercept, self.label_model, self.posterior = weights, intercept, label_model, posterior

    @classmethod
    def of_lexicon(cls) -> ToxicityModel:
        """The model of no sample: a term of the lexicon makes a text toxic."""
        return cls({int(c): LEXICON_WEIGHT for c in LEXICON_CODES}, -LEXICON_WEIGHT / 2)

    @classmethod
    def fit(cls, vocabulary: np.ndarray, voters: np.ndarray, index: np.ndarray, size: np.ndarray, patterns: np.ndarray, toxic: np.ndarray) -> ToxicityModel:
        """``vocabulary`` holds the sorted codes of the terms, ``voters`` which of them vote; ``index`` and ``size`` the rows' terms."""
        n, p = len(size), patterns.shape[1]
        column = np.full(len(vocabulary), -1)
        column[np.flatnonzero(voters)] = np.arange(voters.sum())
        votes = np.zeros((n, int(voters.sum()) + p + 1), np.int8)
        of = column[index]
        votes[np.repeat(np.arange(n), size)[of >= 0], of[of >= 0]] = 1
        votes[:, -p - 1 : -1], votes[:, -1] = patterns, toxic
        # The start: what the best of the other voters that fire says, judged by its record on all rows but this one.
        fires = votes[:, :-1]
        n_fires, n_hits = fires.sum(axis=0, dtype=np.int64), toxic @ fires.astype(np.int64)
        start = np.array([((n_hits[own] - t) / (n_fires[own] + 1)).max(initial=0.0) for own, t in zip(map(np.flatnonzero, fires), toxic, strict=True)])
        rows, at, count = np.unique(np.packbits(votes, axis=1), axis=0, return_inverse=True, return_counts=True)
        distinct, at = np.unpackbits(rows, axis=1, count=votes.shape[1]).astype(np.int8), at.reshape(-1)
        start = np.bincount(at, weights=start) / count
        label = votes.shape[1] - 1
        model = fit_label_model(distinct, count.astype(np.float64), np.clip(start, 0.02, 0.98), label)
        post = model.posterior(distinct)[at]
        w, b = fit_linear(index, size, post, len(vocabulary))
        weights = {int(c): float(x) for c, x in zip(vocabulary, w, strict=True) if x}
        there = np.bincount(index, minlength=len(vocabulary)) > 0
        lexicon = np.isin(vocabulary, LEXICON_CODES)
        strong = float(np.median(w[lexicon & (w > 0)])) if (lexicon & (w > 0)).any() else LEXICON_WEIGHT
        weights |= {int(c): strong for c in vocabulary[lexicon & ~there]}  # lexicon terms that the sample lacks
        return cls(weights, b, model, post)

    def score(self, text: str) -> float:
        weights = self.weights
        total = self.intercept + sum([weights.get(c, 0.0) for c in map(zlib.crc32, terms(text))])
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def _features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        text = frame["text"]
        yield pd.DataFrame({"doc_id": frame["doc_id"], "toxic": frame["toxic"], "digest": frame["digest"], "codes": [_codes(terms(t)).astype(np.int64) for t in text], "patterns": [bytes(int(bool(p.search(t))) for p in PATTERNS.values()) for t in text]})


def _indexer(shared):
    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = shared.value
        for frame in frames:
            out = []
            for codes in frame["codes"]:
                codes = np.asarray(codes, np.uint32)
                at = np.searchsorted(vocabulary, codes)
                at = at[(at < len(vocabulary)) & (vocabulary[np.minimum(at, len(vocabulary) - 1)] == codes)]
                bits = np.zeros(len(vocabulary), np.uint8)
                bits[at] = 1
                out.append(min(b"n" + at.astype("<u2").tobytes(), b"b" + np.packbits(bits).tobytes(), key=len))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "toxic": frame["toxic"], "patterns": frame["patterns"], "terms": out})

    return index


def _terms_of(packed: bytes, size: int) -> np.ndarray:
    if packed[:1] == b"n":
        return np.frombuffer(packed, "<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8, offset=1), count=size)).astype(np.uint16)


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """A model fitted on at most ``train_rows`` labelled rows that aren't held out, taken by their ids' hashes.

    The sample's ids are broadcast (their number is that bound), so the texts aren't shuffled. Terms are counted
    by Spark; the driver gets the ``CLASSIFIER_TERMS`` that tell most, and each row's terms among these. Null labels
    are left out; of several labels for an id the largest counts, of several texts that with the least hash.
    """
    spark = docs.sparkSession
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic").cast("int") > 0).cast("int").alias("toxic")).where("doc_id is not null and toxic is not null").where(~held_out())
    sample = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("digest", F.xxhash64("text"))
    found = slim.join(F.broadcast(sample), "doc_id").mapInPandas(_features, "doc_id long, toxic int, digest long, codes array<long>, patterns binary")
    rows = written(found.groupBy("doc_id").agg(F.min_by(F.struct("toxic", "codes", "patterns"), "digest").alias("x")).select("doc_id", "x.*"), "toxicity-sample")
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not totals:
        return ToxicityModel.of_lexicon()
    n1, n0 = max(1, totals.get(1, 0)), max(1, totals.get(0, 0))
    counts = rows.select("toxic", F.explode("codes").alias("code")).groupBy("code").agg(F.sum("toxic").alias("pos"), F.count("*").alias("n")).where("n >= 2")
    share = n1 / (n1 + n0)
    odds = F.log((F.col("pos") + 0.05) / n1) - F.log((F.col("n") - F.col("pos") + 0.5) / n0)
    counts = written(counts.select("code", "pos", odds.alias("odds"), (F.pow(F.col("pos") - F.col("n") * F.lit(share), F.lit(2)) / F.col("n")).alias("chi")), "toxicity-terms")
    voting = counts.where((F.col("pos") >= 2) & (F.col("odds") > float(np.log(8)))).orderBy(F.desc(F.col("odds") * F.sqrt("pos")), "code").limit(MINED_TERMS)
    telling = counts.orderBy(F.desc("chi"), "code").limit(CLASSIFIER_TERMS)
    codes = lambda df: np.array([r["code"] for r in df.select("code").collect()], np.uint32)
    voters = np.union1d(LEXICON_CODES, codes(voting))
    vocabulary = np.union1d(voters, codes(telling)).astype(np.uint32)
    table = rows.mapInPandas(_indexer(spark.sparkContext.broadcast(vocabulary)), "doc_id long, toxic int, patterns binary, terms binary").toArrow()
    order = np.argsort(table.column("doc_id").to_numpy())
    each = [_terms_of(table.column("terms")[int(k)].as_py(), len(vocabulary)) for k in order]
    patterns = np.array([list(table.column("patterns")[int(k)].as_py()) for k in order], np.int8).reshape(len(order), len(PATTERNS))
    toxic = table.column("toxic").to_numpy()[order]
    del table
    return ToxicityModel.fit(vocabulary, np.isin(vocabulary, voters), np.concatenate(each), np.array([len(x) for x in each]), patterns, toxic)


def score_column(spark: SparkSession, model: ToxicityModel, text_col: str = "text") -> Column:
    shared = spark.sparkContext.broadcast(ToxicityModel(model.weights, model.intercept))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(shared.value.score)

    return score(text_of(text_col))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, a row per document.

    A null text counts as empty and gets the score of no evidence; a null id isn't held out; repeated rows stay;
    without any usable label the lexicon alone decides, each term with a fixed weight; an empty table gives no rows.
    """
    score = score_column(docs.sparkSession, fit_model(docs, labels, id_col, text_col), text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), score.alias("score"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) whose score is under ``threshold``; an empty table gives none."""
    return docs.where(score_column(docs.sparkSession, fit_model(docs, labels, id_col, text_col), text_col) < threshold)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
