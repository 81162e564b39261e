"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts every text into content-defined chunks, so that
passages shared by documents are cut alike wherever they stand. A task encodes
each distinct chunk once and decodes it once. Cutting at arbitrary places is wrong
around the cuts, so the joins are repaired: a window around the cut is encoded anew, from
a place in the chunk before to a place in the chunk after it. If the new ids start with
the ids that the one chunk had next to the window's start, and end with those that the
other had next to its end, the encodings agree there and are put together; if not, the
window is widened and encoded again until they do, at the most to both chunks as a whole.
Windows start and end between a character that isn't white space and a blank: such a
place always parts two pre-tokens, whatever stands around it, so what agrees there
agrees exactly with the encoding of the whole text. Chunks with few such places are
joined with the following ones before anything is encoded.

The vocabulary is that of the given tokenizer file. Plain Latin text is encoded by
tiktoken from the same merges, everything else by the tokenizers library itself.

Scale: one pass over the documents with no shuffle; the chunks that a task remembers
are bounded in bytes, and forgetting costs time, not correctness. A row with the text of
the one before it (a mix repeats its documents) is not encoded again. Sharing chunks
beyond a task would move all texts to where their digests meet, and all ids back, which is
more than encoding them costs; ``reuse`` tells how many chunks are shared. The whole text
of a document is encoded, in output batches bounded in bytes.

Defined results: null and empty texts have no tokens and decode to the empty string;
repeated rows are each encoded; special tokens written in a text become their ids.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm._worker import releasing

#: A cut falls after a byte whose hash of the last WINDOW bytes ends in CUT_BITS zeros: chunks of 1024 bytes on average.
WINDOW, CUT_BITS = 16, 10
#: Places that a chunk has at least, unless the text has fewer, and from which a window reaches at first.
PLACES, REACH = 4, 2
#: Bytes of chunk text a task remembers, and bytes of text in an output batch.
REMEMBERED = 4 << 20
BATCH_BYTES = 2 << 20

_GEAR = np.random.default_rng(20_240_229).integers(0, 1 << 32, 256, dtype=np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
_EXOTIC = re.compile("[^\x00-\u024f]")
#: A run that could be one very long pre-token; the library's merging takes n log n steps there.
_LONG = re.compile(r"\S{1000}")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def cut_points(data: bytes) -> np.ndarray:
    """Content-defined cuts of UTF-8 text, at character starts; both ends excluded."""
    if len(data) <= WINDOW:
        return np.empty(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    h = _GEAR[raw]
    step = 1
    while step < WINDOW:  # sums over windows of 1, 2, 4, ... bytes
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(step)
        h = h + shifted
        step *= 2
    at = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + 1
    at = at[(at > WINDOW) & (at < len(data))]
    while True:  # on to the start of a character
        inside = (raw[at] & 0xC0) == 0x80
        if not inside.any():
            break
        at = at + inside
        at = at[at < len(data)]
    return np.unique(at)


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Chunk(NamedTuple):
    """The ids of a chunk, the bytes that they decode to, where each id's bytes end, and the places where windows may."""

    ids: np.ndarray
    decoded: bytes
    ends: np.ndarray
    places: np.ndarray

    def before(self, place: int) -> int | None:
        """How many ids come before a place; None if it is within one."""
        n = int(self.ends.searchsorted(place, "right"))
        return n if place == (int(self.ends[n - 1]) if n else 0) else None


def safe_places(data: bytes) -> np.ndarray:
    """Byte offsets of blanks after a character that isn't white space. (Some that follow punctuation beyond ASCII whose
    bytes begin as those of white space do are left out.)"""
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(raw == 32)
    at = at[at > 0]
    back = [raw[np.maximum(at - k, 0)] for k in (1, 2, 3)]
    space = _SPACE[back[0]]
    if not data.isascii():
        space = space | (back[1] == 0xC2) & ((back[0] == 0x85) | (back[0] == 0xA0)) | (back[2] >= 0xE1) & (back[2] <= 0xE3) & ((back[1] == 0x9A) | (back[1] == 0x80) | (back[1] == 0x81))
    return at[~space]


def pieces(data: bytes) -> list[tuple[bytes, np.ndarray]]:
    """The content-defined chunks, those with few places joined with the next ones, each with its places."""
    places = safe_places(data)
    bounds = [*cut_points(data).tolist(), len(data)]
    upto = np.searchsorted(places, bounds).tolist()  # a place at a bound is none within the chunk
    cuts, start, seen = [], 0, 0
    for y, n in zip(bounds, upto, strict=True):
        if n - seen > PLACES:
            cuts.append((start, y))
            start, seen = y, n
    if start < len(data):
        start = cuts.pop()[0] if cuts else 0
        cuts.append((start, len(data)))
    return [(data[x:y], places[np.searchsorted(places, x, "right") : np.searchsorted(places, y)] - x) for x, y in cuts]


class Codec:
    """Encodes and decodes whole texts with a tokenizer file's content."""

    def __init__(self, tokenizer_json: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        pre, added = spec["pre_tokenizer"], spec["added_tokens"]
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in added)
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"] or not plain:
            raise ValueError("a byte-level BPE without prefix space, normalizer or stripping special tokens is needed")
        self._library = Tokenizer.from_str(tokenizer_json)
        self._library.no_truncation()
        self._library.no_padding()
        letters = _byte_of_letter()
        special = {t["content"]: t["id"] for t in added}
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        merges = tiktoken.Encoding("chunks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._fast, self._ordinary = merges.encode_ordinary, merges.decode_bytes
        self._bytes = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self._length = np.zeros(max(self._bytes, default=0) + 1, np.int64)
        for i, t in self._bytes.items():
            self._length[i] = len(t)
        self._special = special
        longest_first = sorted(special, key=len, reverse=True)
        self._split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if special else lambda t: [t]
        self._chunks: dict[bytes, Chunk] = {}
        self._held = 0
        self.met = self.encoded = self.widened = 0

    def _plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens."""
        if _EXOTIC.search(text) or len(text) >= 1000 and _LONG.search(text):
            return self._library.encode(text, add_special_tokens=False).ids
        return self._fast(text)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of any ids, special ones too."""
        return b"".join(map(self._bytes.__getitem__, ids))

    def _anew(self, data: bytes, places: np.ndarray) -> Chunk:
        ids = self._plain(data.decode())
        at = np.array(ids, np.int32)
        return Chunk(at, self._ordinary(ids), self._length[at].cumsum(), places)

    def _chunk(self, data: bytes, places: np.ndarray) -> Chunk:
        self.met += 1
        known = self._chunks.get(data)
        if known is None:
            self.encoded += 1
            known = self._anew(data, places)
            if self._held > REMEMBERED:
                self.forget()
            self._chunks[data] = known
            self._held += len(data)
        return known

    def forget(self) -> None:
        self._chunks.clear()
        self._held = 0

    def _joined(self, one: Chunk, two: Chunk, since: int) -> tuple[int, list[int], int] | None:
        """(place in ``one`` at or after ``since``, ids from there on, place in ``two`` up to which they go), once both
        encodings agree with that of the window; None if no window within the chunks does."""
        reach = REACH
        while True:
            if len(one.places) < reach or len(two.places) < reach or one.places[-reach] < since:
                return None
            start, inner = one.places[-reach : len(one.places) - reach + 2].tolist()
            back, end = two.places[reach - 2 : reach].tolist()
            marks = one.before(start), one.before(inner), two.before(back), two.before(end)
            if None not in marks:
                window = self._plain((one.decoded[start:] + two.decoded[:end]).decode())
                head, tail = one.ids[marks[0] : marks[1]].tolist(), two.ids[marks[2] : marks[3]].tolist()
                if window[: len(head)] == head and window[len(window) - len(tail) :] == tail:
                    return start, window, end
            self.widened += 1
            reach *= 2

    def encode(self, text: str) -> tuple[np.ndarray, bytes]:
        """The ids of a whole text and the bytes that they decode to."""
        ids: list[np.ndarray] = []
        decoded: list[bytes] = []
        for part in self._split(text):
            if part in self._special:
                ids.append(np.array([self._special[part]], np.int32))
                decoded.append(self.decode([self._special[part]]))
            elif part:
                self._encode_plain(part.encode(), ids, decoded)
        return np.concatenate(ids) if ids else np.empty(0, np.int32), b"".join(decoded)

    def _encode_plain(self, data: bytes, ids: list[np.ndarray], decoded: list[bytes]) -> None:
        now, since = None, 0  # the last chunk, and the place up to which it is done
        for piece, places in pieces(data):
            chunk = self._chunk(piece, places)
            if now is None:
                now = chunk
                continue
            agreed = self._joined(now, chunk, since)
            if agreed is None:  # both as a whole
                whole = now.decoded[since:] + chunk.decoded
                now, since = self._anew(whole, safe_places(whole)), 0
                continue
            start, window, end = agreed
            ids += [now.ids[now.before(since) : now.before(start)], np.array(window, np.int32)]
            decoded += [now.decoded[since:start], self._ordinary(window)]
            now, since = chunk, end
        if now is not None:
            ids.append(now.ids[now.before(since) :])
            decoded.append(now.decoded[since:])


@lru_cache(maxsize=2)
def codec(tokenizer_json: str) -> Codec:
    """One per worker process; the chunks are those of a task."""
    return Codec(tokenizer_json)


def _batches(tokenizer_json: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer_json)
        coder.forget()
        for batch in batches:
            start, held, ids, texts = 0, 0, [], []
            last = got = back = None
            for k, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                if text != last:
                    last, (got, back) = text, coder.encode(text)
                ids.append(got)
                texts.append(back.decode("utf-8", "replace"))
                held += len(back)
                if held >= BATCH_BYTES or k + 1 == batch.num_rows:
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(start, len(ids)), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
                    )
                    start, held, ids, texts = k + 1, 0, [], []
        coder.forget()

    return releasing(run)


def encode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int), decoded. ``tokenizer`` is the path of a tokenizer file."""
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(_batches(content), f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what ``encode`` returns."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _chunk_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(hashlib.blake2b(x, digest_size=16).digest(), len(x)) for t in batch.column("text") for x, _ in pieces((t.as_py() or "").encode())]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.int64())], ["digest", "size"])


def reuse(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: chunks, distinct_chunks, bytes and distinct_bytes of all whole texts; null and empty texts have none."""
    each = docs.select(F.col(text).alias("text")).mapInArrow(releasing(_chunk_digests), "digest binary, size bigint")
    distinct = each.groupBy("digest").agg(F.count("*").alias("n"), F.first("size").alias("size"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return distinct.select(total("n").alias("chunks"), F.count("*").alias("distinct_chunks"), total(F.col("n") * F.col("size")).alias("bytes"), total("size").alias("distinct_bytes"))
