"""Quality scores by Bradley-Terry pairwise ranking.

Every text becomes a short vector of surface statistics (kinds of characters,
word and line lengths, repetition of words, word triples and lines). A labelled
good text is preferred to a labelled bad one; the model learns a linear score
from such pairs by logistic loss on the difference of their features
(Newton's method, ridge penalty). The threshold is the score quantile at the
share of bad labels, and scores are mapped to 0..1 so that it lies at
``THRESHOLD``.

The fit uses a bounded sample of labelled rows, at most ``MAX_TRAIN`` per
label (those with the smallest hash of the id) and at most ``MAX_PAIRS``
pairs; class shares are counted over all labelled rows. Scoring is one pass
over the texts without a shuffle.

Defined cases: a null or empty text has a vector of its own (all 0) and a
score; texts are read whole; ids with contradicting labels and null labels
teach nothing, repeated label rows count once; without labels of both kinds
every score is ``THRESHOLD``; repeated rows are scored once each; an empty
table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from orderlens.llm.common import word_hashes

MAX_TRAIN = 10_000
MAX_PAIRS = 100_000
THRESHOLD = 0.7
RIDGE = 1e-2

#: Punctuation of plain prose; other signs count as symbols.
PROSE_SIGNS = ".,;:!?'\"()-"

_KINDS: list[np.ndarray] = []
_LOWER, _UPPER, _OTHER_LETTER, _DIGIT, _SPACE, _SIGN, _SYMBOL = range(7)


def _kinds() -> np.ndarray:
    if not _KINDS:
        table = np.full(0x110000, _SYMBOL, dtype=np.uint8)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                table[cp] = _LOWER if c.islower() else _UPPER if c.isupper() else _OTHER_LETTER
            elif c.isdigit():
                table[cp] = _DIGIT
            elif c.isspace():
                table[cp] = _SPACE
            elif c in PROSE_SIGNS:
                table[cp] = _SIGN
        _KINDS.append(table)
    return _KINDS[0]


def _repeated(x: np.ndarray) -> float:
    """Share of the values that occurred before."""
    return 1 - len(np.unique(x)) / len(x) if len(x) else 0.0


FEATURES = ("upper", "other", "digit", "space", "sign", "symbol", "word_length", "words", "lines", "line_length",
            "repeated_words", "repeated_triples", "repeated_lines", "top_word", "adjacent", "capitals", "exclaim", "bars")


def features(text: str | None) -> np.ndarray:
    out = np.zeros(len(FEATURES))
    if not text:
        return out
    n = len(text)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    count = np.bincount(_kinds()[raw], minlength=7)
    words = word_hashes(text)
    lines = text.split("\n")
    letters = max(1, count[_LOWER] + count[_UPPER] + count[_OTHER_LETTER])
    m = max(1, len(words))
    triples = words[:-2] * np.uint64(0x9E3779B97F4A7C15) + words[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + words[2:]
    _, per_word = np.unique(words, return_counts=True)
    out[:] = (
        count[_UPPER] / letters,
        count[_OTHER_LETTER] / letters,
        count[_DIGIT] / n,
        count[_SPACE] / n,
        count[_SIGN] / n,
        count[_SYMBOL] / n,
        math.log1p(letters / m),
        math.log1p(len(words)),
        math.log1p(len(lines)),
        math.log1p(n / len(lines)),
        # distinct words grow slower than texts, so against that growth
        _repeated(words) * 10 / (10 + math.log1p(m)),
        _repeated(triples),
        1 - len(set(lines)) / len(lines),
        per_word.max() / m if len(words) else 0.0,
        float(np.mean(words[1:] == words[:-1])) if len(words) > 1 else 0.0,
        math.log1p(100 * count[_UPPER] / m),
        math.log1p(100 * text.count("!") / m),
        math.log1p(100 * text.count("|") / m),
    )
    return out


class Ranker:
    """A linear score over standardised features and their squares."""

    def __init__(self, x: np.ndarray, good: np.ndarray, bad_share: float, max_pairs: int = MAX_PAIRS, seed: int = 7):
        self.mean = x.mean(axis=0)
        self.scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
        z = self.expand(x)
        self.weights = self._fit(z[good], z[~good], max_pairs, np.random.default_rng(seed))
        s = z @ self.weights
        # each label's sample stands for that label's share of all labelled rows
        weight = np.where(good, (1 - bad_share) / good.sum(), bad_share / (~good).sum())
        order = np.argsort(s, kind="stable")
        k = int(np.searchsorted(np.cumsum(weight[order]), bad_share, side="left"))
        k = min(k, len(s) - 2)
        self.cut = (s[order[k]] + s[order[k + 1]]) / 2
        self.unit = max(1e-6, (np.median(s[good]) - np.median(s[~good])) / 8)

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z], axis=1)

    @staticmethod
    def _fit(good: np.ndarray, bad: np.ndarray, max_pairs: int, rng) -> np.ndarray:
        """Logistic loss of (good - bad) over random pairs, each side's rows used equally often."""
        n = min(max_pairs, len(good) * len(bad))
        i = rng.permutation(np.arange(n) % len(good))
        j = rng.permutation(np.arange(n) % len(bad))
        d = good[i] - bad[j]
        w = np.zeros(d.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            gradient = d.T @ (1 - p) / n - RIDGE * w
            hessian = (d * (p * (1 - p))[:, None]).T @ d / n + RIDGE * np.eye(len(w))
            step = np.linalg.solve(hessian, gradient)
            w = w + step / max(1.0, np.abs(step).max())
            if np.abs(step).max() < 1e-6:
                break
        return w

    def score(self, x: np.ndarray) -> np.ndarray:
        s = (self.expand(x) @ self.weights - self.cut) / self.unit + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(s, -500, 500)))


def _vectors(texts) -> np.ndarray:
    return np.stack([features(t) for t in texts]) if len(texts) else np.zeros((0, len(FEATURES)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train: int = MAX_TRAIN,
) -> Ranker | None:
    """A ranker from the labelled ids of ``labels`` (0 bad, 1 good); None without both kinds."""
    one = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
           .groupBy(id_col).agg(F.min(label_col).alias("label"), F.max(label_col).alias("other"))
           .where("label = other").select(F.col(id_col).alias("id"), "label"))
    counts = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    order = (F.xxhash64(F.lit(1), "id"), "id")
    sample = one.where("label = 0").orderBy(*order).limit(max_train).unionByName(
        one.where("label = 1").orderBy(*order).limit(max_train))
    # at most 2 * max_train ids: small enough to send to every executor
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")

    def run(batches):
        for batch in batches:
            x = _vectors(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("label").cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))],
                names=["id", "label", "x"])

    # ids that documents repeat bring a row each: the first vector of an id counts
    got = rows.mapInArrow(run, "id string, label int, x array<double>").groupBy("id").agg(
        F.min("label").alias("label"), F.min("x").alias("x")).orderBy("id").toArrow()
    good = np.array(got.column("label").to_pylist()) == 1
    if not good.any() or good.all():
        return None
    x = np.array(got.column("x").to_pylist())
    return Ranker(x, good, counts[0] / (counts[0] + counts[1]))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    score_col: str = "score",
    max_train: int = MAX_TRAIN,
) -> DataFrame:
    """The documents with a score from 0 to 1; ``train_rows`` is a condition on the label rows."""
    if score_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has a column named {score_col}")
    ranker = train(docs, labels if train_rows is None else labels.where(train_rows), id_col, text_col, label_col, max_train)
    schema = StructType([*docs.schema.fields, StructField(score_col, DoubleType())])
    where = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            x = _vectors(batch.column(where).to_pylist())
            score = ranker.score(x) if ranker else np.full(len(x), THRESHOLD)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=schema.names)

    return docs.mapInArrow(run, schema)
