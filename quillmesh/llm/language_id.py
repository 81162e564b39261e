"""Language identification by error-correcting output codes.

Every language gets a codeword; a binary classifier over letter n-grams is fitted for
each bit. To predict, the losses of a text's bit margins against each codeword are
summed, each bit weighted by how well it told the training rows apart, and the
nearest codeword wins; a text whose second nearest is about as near is ambiguous.

Scale: the fit uses a bounded, repeatable sample (``train_rows`` in all, spread evenly
over languages; features are computed where the rows are, and 2 * DIM bytes a
row come to the driver). Prediction is one pass with no shuffle over whole texts; the
model is a matrix of DIM times the number of bits.

Defined results: texts that are null or have no letter are ``und`` with score 0, and so
are all if nothing can be learned; with one language, all others are that one with
score 1; repeated rows are each predicted; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import _linear
from quillmesh.llm._worker import releasing

DIM = 4096
UNDETERMINED = "und"
#: Lead in score of the nearest codeword over the second below which a text is ambiguous.
AMBIGUOUS = 0.2


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # DIM x bits
    bit_weight: np.ndarray


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 for each of k classes: all distinct splits up to 6 classes, else the best of some random codes
    by least distance between rows."""
    if k < 2:
        return np.ones((k, 0))
    if k <= 6:
        bits = range(1, 2 ** (k - 1))
        return np.array([[1 if row == 0 or not b >> (row - 1) & 1 else -1 for b in bits] for row in range(k)], float)
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (k, int(np.ceil(10 * np.log2(k)))))
        code = code[:, np.abs(code.sum(0)) < k]
        gap = ((code.shape[1] - code @ code.T) / 2 + np.eye(k) * code.shape[1]).min()
        if gap > far:
            best, far = code, gap
    return best


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", train_rows: int = 3000) -> Model:
    """Learns from rows of ``docs`` with a language; ``train_rows`` bounds the sample."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model([], np.ones((0, 0)), np.zeros((DIM, 0), np.float32), np.ones(0))
    each = train_rows / len(counts)
    share = F.create_map(*[F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1.0, each / n))])
    sample = rows.filter(_linear.in_sample(F.col("key"), share[F.col("lang")]))
    labels, x = _linear.collect_features(sample, _profile, "lang")
    languages = sorted(set(labels))
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((DIM, 0), np.float32), np.ones(0))
    at = np.array([languages.index(v) for v in labels])
    weight = (1.0 / np.bincount(at))[at] / len(languages)
    w = _linear.fit_logistic(x, code[at], weight, l2=1e-6, steps=400)
    right = ((x @ w * code[at] > 0) * weight[:, None]).sum(0)
    bit_weight = np.clip(np.log(np.clip(right, 0.5, 0.999) / np.clip(1 - right, 0.001, 0.5)), 0.05, None)
    return Model(languages, code, w, bit_weight / bit_weight.sum())


def _profile(text: str) -> np.ndarray | None:
    return _linear.letter_profile(text, DIM)


def predict_one(model: Model, text: str | None) -> tuple[str, float, bool]:
    """Language, score and whether it is ambiguous."""
    x = _profile(text or "")
    if x is None or not model.languages:
        return UNDETERMINED, 0.0, True
    if len(model.languages) == 1:
        return model.languages[0], 1.0, False
    margin = x @ model.weights
    loss = (np.logaddexp(0, -model.code * margin) * model.bit_weight).sum(1)
    odds = np.exp(-2 * len(model.bit_weight) * (loss - loss.min()))
    odds /= odds.sum()
    order = np.argsort(-odds, kind="stable")
    lead = odds[order[0]] - odds[order[1]]
    return model.languages[order[0]], float(odds[order[0]]), bool(lead < AMBIGUOUS)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [predict_one(shared.value, t.as_py()) for t in batch.column("text")]
            columns = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*got, strict=True) if got else ([], [], []), (pa.string(), pa.float64(), pa.bool_()), strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "ambiguous"])

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(releasing(run), f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")
