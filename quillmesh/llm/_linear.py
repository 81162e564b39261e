"""Bounded samples, text profiles and linear fits shared by the learned operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.llm._worker import releasing

#: Characters handled at a time, so that a very long text needs no more memory than this many.
PIECE = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 by 5; a null id is not held out (nor learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 != 0, F.lit(False))


def in_sample(key: Column, share: Column) -> Column:
    """A repeatable choice of about ``share`` of the rows by a hash of their key."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < share * float(1 << 30)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def letter_profile(text: str, dim: int, longest: int = 3) -> np.ndarray | None:
    """Hashed counts of 1- to ``longest``-grams of lower-case letters, words set apart by blanks, over the whole text,
    as square roots of shares; None without a letter."""
    counts = np.zeros(dim)
    seen = False
    before = np.array([32], np.uint32)
    shift = np.uint32(32 - int(dim).bit_length() + 1)
    for at in range(0, len(text), PIECE):
        points = code_points(text[at : at + PIECE].lower())
        alpha = _letters()[points]
        seen = seen or bool(alpha.any())
        carried = len(before)
        run = np.concatenate([before, np.where(alpha, points, np.uint32(32)), np.array([32], np.uint32)[: at + PIECE >= len(text)]])
        blank = run == 32
        run = run[~(blank & np.concatenate([[False], blank[:-1]]))]
        for n in range(1, longest + 1):
            new = run[max(0, carried - n + 1) :]  # n-grams that end in this piece
            if len(new) < n:
                continue
            h = new[: len(new) - n + 1].copy()
            for k in range(1, n):
                h = h * np.uint32(0x01000193) + new[k : len(new) - n + 1 + k]
            h = (h + np.uint32(n * 0x51ED270B)) * np.uint32(0x9E3779B1)
            counts += np.bincount((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> shift, minlength=dim)
        before = run[-(longest - 1) :] if longest > 1 else run[:0]
    return np.sqrt(counts / counts.sum()).astype(np.float32) if seen else None


def collect_features(sample: DataFrame, features: Callable[[str], np.ndarray | None], label: str) -> tuple[list, np.ndarray]:
    """Labels and feature rows of a bounded sample with columns text and ``label``; rows without features are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py() or "") for t in batch.column("text")]
            packed = [None if r is None else r.astype(np.float16).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(label), pa.array(packed, pa.binary())], [label, "x"])

    kind = sample.schema[label].dataType.simpleString()
    rows = [r for r in sample.select("text", label).mapInArrow(releasing(run), f"{label} {kind}, x binary").collect() if r["x"] is not None]
    rows.sort(key=lambda r: (str(r[label]), bytes(r["x"])))  # the same fit whatever order the rows came in
    if not rows:
        return [], np.empty((0, 0), np.float32)
    return [r[label] for r in rows], np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)


def fit_logistic(x: np.ndarray, signs: np.ndarray, weight: np.ndarray, l2: float = 1e-4, steps: int = 300) -> np.ndarray:
    """Weights, a column a target, that lower the weighted mean of log(1 + exp(-sign * x @ w)); accelerated gradient steps.
    ``signs``: +1 or -1, or 0 where a row doesn't count for a target."""
    rate = 1.0 / (0.25 * float(np.einsum("i,ij,ij->", weight, x, x)) + l2)
    w = np.zeros((x.shape[1], signs.shape[1]), np.float32)
    ahead, t = w, 1.0
    for _ in range(steps):
        margin = signs * (x @ ahead)
        pull = -signs / (1 + np.exp(np.clip(margin, -30, 30))) * weight[:, None]
        after = ahead - rate * (x.T @ pull.astype(np.float32) + l2 * ahead)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = after + (t - 1) / t_next * (after - w), after, t_next
    return w
