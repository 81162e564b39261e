"""Quality scores by Bradley-Terry pairwise ranking.

From labelled documents preference pairs are drawn, one document of label 1 over one of
label 0. A document's strength is linear in features of its text, and the weights
lower the logistic loss on the pairs' feature differences. The threshold is the
quantile of the training strengths at the share of label 0; strengths become scores
between 0 and 1 by a logistic curve that passes ``CUT`` at the threshold, with the
steepness that fits the training labels best.

Scale: the fit uses a bounded, repeatable sample of ``train_rows`` labelled rows; the
chosen labels (at most about as many) are joined to the documents as a broadcast. Scoring
is one pass with no shuffle over whole texts.

Defined results: null and empty texts are scored by the features of an empty text; labels
that are null are ignored; with labels of one kind only, or none, every score is that
label's (1 for none); repeated rows are each scored; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.llm import _linear
from quillmesh.llm._worker import releasing

CUT = 0.3
PROFILE_DIM = 512
#: Characters counted apart.
SYMBOLS = "#*$%&|<>"
MARKS = ".,!?:;'\"()-+=@/_"

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint32)


def text_features(text: str) -> np.ndarray:
    """Shares of kinds of characters, word and line statistics, repetition, and a small letter profile."""
    points = _linear.code_points(text)
    n = max(len(points), 1)
    low = np.bincount(np.minimum(points, 255), minlength=256)
    words = _WORD.findall(text)
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    n_words = max(len(words), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    share = lambda chars: sum(int(low[ord(c)]) for c in chars) / n
    upper = int(low[65:91].sum()) + int(low[0xC0:0xDF].sum())
    own = [
        1.0,
        np.log1p(len(words)) / 10,
        min(lengths.mean() / 20, 3.0),
        min(lengths.std() / 20, 3.0),
        min(lengths.max() / 100, 3.0),
        np.log1p(len(lines)) / 5,
        np.log1p(n_words / max(len(lines), 1)) / 5,
        len(set(words)) / n_words,
        1 - len(set(lines)) / max(len(lines), 1),
        1 - len(set(windows)) / max(len(windows), 1),
        share(SYMBOLS),
        share(MARKS),
        share("0123456789"),
        upper / n,
        float(np.isin(points, _SPACES).sum()) / n,
        *[np.sqrt(share(c)) for c in SYMBOLS + MARKS],
        sum(w[-1] in SYMBOLS + "!" for w in words) / n_words,
        sum(w.isupper() for w in words) / n_words,
        sum(w[0].isupper() for w in words) / n_words,
        sum(w[-1] in ".!?" for w in words) / n_words,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n_words,
        max(Counter(words).values(), default=0) / n_words,
        float(len(words) < 50),
        float(not words),
    ]
    profile = _linear.letter_profile(text, PROFILE_DIM, 2)
    profile = np.zeros(PROFILE_DIM, np.float32) if profile is None else profile
    return np.concatenate([np.array(own, np.float32), profile])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray | None
    mean: np.ndarray
    spread: np.ndarray
    threshold: float
    steepness: float
    only: float = 1.0  # every score if there is nothing to rank

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.only)
        strength = ((x - self.mean) / self.spread) @ self.weights
        at = self.steepness * (strength - self.threshold) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(at, -60, 60)))


def fit_pairs(x: np.ndarray, labels: np.ndarray, pairs: int = 20_000, seed: int = 11) -> Model:
    """Learns from feature rows and labels 0 or 1."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    none = np.zeros(0)
    if not len(good) or not len(bad):
        return Model(None, none, none, 0.0, 1.0, only=0.0 if len(bad) else 1.0)
    mean, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-6, spread, 1.0)
    z = (x - mean) / spread
    rng = np.random.default_rng(seed)
    preferred, other = rng.choice(good, pairs), rng.choice(bad, pairs)
    w = np.zeros(z.shape[1])
    # the pairs' differences enter through the documents, so no matrix of pairs is built
    top = np.linalg.norm(z, 2) ** 2 / len(z)
    rate, l2, before, t = 1.0 / (top + 1e-3), 1e-3, w, 1.0
    ahead = w
    for _ in range(500):
        s = z @ ahead
        pull = 1 / (1 + np.exp(np.clip(s[preferred] - s[other], -30, 30))) / pairs
        per_doc = np.bincount(preferred, pull, len(z)) - np.bincount(other, pull, len(z))
        w = ahead + rate * (z.T @ per_doc - l2 * ahead)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, before, t = w + (t - 1) / t_next * (w - before), w, t_next
    strength = z @ w
    # halfway between the strengths on both sides of the quantile
    order, k = np.sort(strength), len(bad)
    threshold = float((order[k - 1] + order[min(k, len(order) - 1)]) / 2)
    sign = np.where(labels == 1, 1.0, -1.0)
    scale = 1 / max(float(strength.std()), 1e-9)
    steep = [scale * 2.0**e for e in range(-4, 8)]
    loss = [np.logaddexp(0, -sign * (a * (strength - threshold) + np.log(CUT / (1 - CUT)))).mean() for a in steep]
    return Model(w, mean, spread, threshold, steep[int(np.argmin(loss))])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    train_rows: int = 4000,
) -> Model:
    """Learns from the documents that ``labels`` (key, label) marks 0 or 1; ``train_rows`` bounds the sample."""
    marked = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("marked"), F.col(label).cast("int").alias("label"))
    marked = marked.filter(F.col("marked").isNotNull())
    n = marked.count()
    share = F.lit(min(1.0, train_rows / n)) if n else F.lit(1.0)
    sample = marked.filter(_linear.in_sample(F.col("marked"), share))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        scratch.bounded(scratch.table(sample, "quality-sample")), F.col("key") == F.col("marked")
    )
    got, x = _linear.collect_features(rows, text_features, "label")
    return fit_pairs(x.astype(float), np.array(got))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                x = np.stack([text_features(t.as_py() or "") for t in part.column("text")])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.score(x), pa.float64())], ["doc_id", "score"])

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    scored = slim.mapInArrow(releasing(run), f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
