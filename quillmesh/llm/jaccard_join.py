"""N-gram Jaccard self-join by PartEnum signatures.

Documents are sets of word shingles. Sets are banded by size; sets of a band (and those
of the next that are small enough) whose similarity reaches the threshold differ in at
most k shingles. The shingle domain is partitioned by hash into n1 parts, and each part
into n2 cells. As n1 exceeds k / (d + 1), two such sets differ by at most d shingles in
some part, so they agree on all of its cells but d: every subset of n2 - d cells of every
part is a signature, and the two share one. What shares a signature is a candidate, and
is verified on the whole sets.

Scale. Sets that are equal are one node. Near copies share most of their signatures, so
pairs are never listed by signature. First every node is compared with the least node of
its buckets, and components are formed. Then only members of different components are
paired. Buckets of up to SMALL members become arrays of (node, component); those of one
component are left behind, and equal ones are one. Larger buckets are merged by their
least node: partners still meet, and a node is there once, however many signatures it
shares. There the members outside of the largest component are compared with a few
members drawn by hash, and, once components have grown by that, with all the members of
other components. Size and sketch, which bound the similarity from above, are compared as
a condition of the join, so that only pairs that pass become rows. Whole sets are hashed
and moved for the nodes of such pairs alone.

There are more parts than needed, by a margin. Signatures of very few shingles are left
out by sets in which no more parts than the margin have one; agreeing signatures
have the same shingles on both sides, so two partners still share another. Shingles of
a passage that very many documents share are kept out of the signatures altogether:
partners differ by no more of the other shingles than of all. A set that is left
with too few has signatures over all its shingles as well. Which shingles are frequent
is counted over all documents in blocks and handed out as a bitmap of fixed size.

The rows of one signature (16 bytes a set) meet in one task, which reads them sorted and
passes those of a big bucket on in pieces, so that none is held in memory.

The components need no pair within one of them. ``counted`` asks for every document's
number of links: all pairs of different sets of a class are then verified, in pairs of
blocks of about CLASS_BLOCK sets dealt out by hash, each a product of matrices in a
worker. A set goes out once for every block of its class, and pairs never become rows,
but the work does grow with the square of a class's different sets.

Exactness: a shingle is the 64-bit hash of its whole words, and a set is what its hashes
are: two different shingles of one table are one with a probability of their number squared
over 2^65. Ids of sets are checked for collisions by a second hash, and all is hashed
anew if one occurs.

Defined results: null and empty texts have no shingles and link with nothing; texts of
fewer words than a shingle are one shingle; repeated rows are linked to each other; null
ids never name a component unless there is no other; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache, reduce
from itertools import combinations
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.llm._worker import BATCH, releasing
from quillmesh.llm.components import components

#: Signatures of up to FEW shingles are left out where a set can.
FEW = 3
#: 64-bit words of a sketch.
SKETCH = 8
#: Members up to which a bucket is one array; members drawn of a merged one.
SMALL, DRAWN = 16, 4
#: Buckets and members of big ones that a task remembers to have given.
REMEMBERED = 300_000
#: Sets in a block, where all pairs of a class are counted, and shingles of a block counted at a time.
CLASS_BLOCK, COLUMNS = 256, 4096
#: Bytes of text hashed at a time.
PIECE = 1 << 20
#: A shingle is frequent from so many sets on, as far as blocks of BLOCK shingles show it LOCAL times or more; all
#: workers know them as a bitmap of MAP_BITS bits.
SPREAD, LOCAL, BLOCK, MAP_BITS = 100, 4, 1 << 21, 1 << 25

_U = np.uint64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Similarity:
    """Sets link when den * intersection >= num * union; shingles of ``words`` words.

    ``cells`` of a part, ``apart``, the cells of a part that a signature leaves out, and ``margin``, parts beyond the least
    number as a share of it, decide on the work, not on the links: with more cells signatures are longer, and more."""

    words: int = 5
    num: int = 8
    den: int = 10
    cells: int = 3
    apart: int = 1
    margin: float = 0.15
    seed: int = 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@lru_cache(maxsize=8)
def _tables(seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 63, 257, dtype=np.uint64) * _U(2) + _U(1)
    return odd[:256], odd[256:]


def word_hashes(text: str, seed: int) -> np.ndarray:
    """A hash of each word, A-Z lower-cased, in order."""
    data = text.encode("utf-8", "replace").translate(_LOWER)
    values, base = _tables(seed)
    out, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not _BLANK[data[end]]:  # not within a word
            end += 1
        raw = np.frombuffer(data, np.uint8, end - at, at)
        at = end
        blank = _BLANK[raw]
        place = np.flatnonzero(~blank)
        if not len(place):
            continue
        first = np.flatnonzero(np.diff(place, prepend=-2) > 1)
        length = np.diff(first, append=len(place))
        offset = np.arange(len(place)) - np.repeat(first, length)
        power = np.cumprod(np.concatenate([[_U(1)], np.repeat(base, int(length.max()))]))
        sums = np.add.reduceat(values[raw[place]] * power[offset], first)
        out.append(mix(sums + length.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(text: str | None, kind: Similarity) -> np.ndarray:
    """The distinct shingle hashes of a text in order."""
    w = word_hashes(text or "", kind.seed)
    if not len(w):
        return w
    n = min(kind.words, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        h = mix(h * _U(0xD6E8FEB86659FD93) + w[k : len(w) - n + 1 + k])
    return np.unique(h)


@lru_cache(maxsize=8)
def band_edges(num: int, den: int) -> np.ndarray:
    """Least sizes of the bands, which grow by a power of den / num near 1.25; more bands than any set needs."""
    power = max(1, round(np.log(1.25) / np.log(den / num)))
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * den**power // num**power)))
    return np.array(edges)


def bands_of(n: int, kind: Similarity) -> list[int]:
    """The band of a set of n shingles, and the one before it if a partner may be there."""
    edges = band_edges(kind.num, kind.den)
    home = int(np.searchsorted(edges, n, "right")) - 1
    least_partner = -(-n * kind.num // kind.den)
    return [home, home - 1] if home and least_partner < edges[home] else [home]


def parts_of(band: int, kind: Similarity) -> tuple[int, int]:
    """(n1, spare): parts of the band, and how many more they are than needed, which a set may do without."""
    top = int(band_edges(kind.num, kind.den)[band + 1]) - 1
    k = (top + top * kind.den // kind.num) * (kind.den - kind.num) // (kind.den + kind.num)
    needed = k // (kind.apart + 1) + 1
    spare = int(np.ceil(kind.margin * needed)) if k else 0
    return needed + spare, spare


@lru_cache(maxsize=8)
def _subsets(cells: int, apart: int) -> list[list[int]]:
    return [list(s) for s in combinations(range(cells), cells - apart)]


def signatures(h: np.ndarray, band: int, kind: Similarity, salt: int, whole: bool) -> tuple[bool, np.ndarray]:
    """(whether too many parts lack shingles, signatures) of a set in a band.

    If too many parts do, ``whole`` tells to keep all signatures, else those without any shingle are left out."""
    (n1, spare), cells = parts_of(band, kind), kind.cells
    cell = (h >> _U(32)) % _U(n1) * _U(cells) + (h & _U(0xFFFFFFFF)) % _U(cells)
    cell = cell.astype(np.int64)
    order = np.argsort(cell, kind="stable")
    counts = np.bincount(cell, minlength=n1 * cells)
    sums = np.zeros(n1 * cells, np.uint64)
    used = np.flatnonzero(counts)
    if len(used):
        sums[used] = np.add.reduceat(mix(h ^ _U(0xA0761D6478BD642F))[order], (np.cumsum(counts) - counts)[used])
    scrambled = mix(sums + np.arange(1, n1 * cells + 1, dtype=np.uint64) * _U(0xE7037ED1A0B428DB)).reshape(n1, cells)
    counts = counts.reshape(n1, cells)
    if kind.apart == 1:  # all cells but one
        value = scrambled.sum(1, dtype=np.uint64)[:, None] - scrambled
        held = counts.sum(1)[:, None] - counts
    else:
        subsets = _subsets(cells, kind.apart)
        value = np.stack([scrambled[:, s].sum(1, dtype=np.uint64) for s in subsets], 1)
        held = np.stack([counts[:, s].sum(1) for s in subsets], 1)
    # the most that the set can spare; of two partners the one that leaves out more bounds what both lose
    least = np.sort(held.min(1))
    f = int(least[spare]) - 1 if spare < len(least) else FEW  # more than ``spare`` parts have a signature of ``f`` + 1 at most
    wanting = f < 0
    if wanting:
        keep = np.ones_like(held, bool) if whole else held > 0
    else:
        keep = held > min(f, FEW)
    return wanting, mix(value + _U(2 * band + salt))[keep]


def all_signatures(h: np.ndarray, frequent: np.ndarray, kind: Similarity) -> np.ndarray:
    """The signatures of a set in its bands, over its shingles that aren't frequent; a set with too few of those has
    signatures over all its shingles as well, by which it meets others like it."""
    rare = h[~is_frequent(h, frequent)]
    out = []
    for band in bands_of(len(h), kind):
        wanting, sigs = signatures(rare, band, kind, 0, whole=False)
        out.append(sigs)
        if wanting:
            out.append(signatures(h, band, kind, 1, whole=True)[1])
    return np.concatenate(out)


def is_frequent(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = (h >> _U(20)) % _U(MAP_BITS)
    return (bitmap[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(MAP_BITS, bool)
    bits[((hashes >> _U(20)) % _U(MAP_BITS)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def sketch(h: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of 64 * SKETCH cells; sets differ by at least as many shingles as
    their sketches by bits."""
    odd = (np.bincount((h >> _U(40)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def set_ids(h: np.ndarray) -> tuple[int, int]:
    one, two = mix(h).sum(dtype=np.uint64), mix(h ^ _U(0x589965CC75374CC3)).sum(dtype=np.uint64)
    return tuple(_signed(mix(np.array([one + _U(len(h)), two]))).tolist())


_SKETCH = [f"s{k}" for k in range(SKETCH)]
_SETS = f"n bigint, node bigint, node2 bigint, {', '.join(f'{c} bigint' for c in _SKETCH)}, often array<struct<shingle:bigint,times:bigint>>"
_OFTEN = pa.list_(pa.struct([("shingle", pa.int64()), ("times", pa.int64())]))
_HASHES = "node bigint, hashes array<bigint>"


def _sets(kind: Similarity) -> Callable:
    """Ids and sizes of the sets, and in a last row of each block the shingles that came often in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        block: list[np.ndarray] = []

        def often() -> list[dict]:
            values, times = np.unique(np.concatenate(block), return_counts=True) if block else (np.empty(0, np.uint64), np.empty(0, int))
            block.clear()
            return [{"shingle": v, "times": t} for v, t in zip(_signed(values[times >= LOCAL]).tolist(), times[times >= LOCAL].tolist(), strict=True)]

        keys: list = []
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                piece = batch.slice(at, 1000)
                n, node, node2, sketches = [], [], [], np.zeros((piece.num_rows, SKETCH), np.int64)
                for k, text in enumerate(piece.column("text")):
                    h = shingles(text.as_py(), kind)
                    one, two = set_ids(h) if len(h) else (None, None)
                    n.append(len(h))
                    node.append(one)
                    node2.append(two)
                    sketches[k] = sketch(h)
                    if one is not None and one not in seen:
                        seen.add(one)
                        block.append(h)
                keys = [piece.column("doc_id"), piece.column("row")]
                yield _set_rows(keys, n, node, node2, sketches, [None] * len(n))
                if sum(map(len, block)) >= BLOCK:
                    yield _often_row(keys, often())
        if block:
            yield _often_row(keys, often())

    return releasing(run)


def _set_rows(keys: list, n: list, node: list, node2: list, sketches: np.ndarray, often: list) -> pa.RecordBatch:
    columns = [*keys, pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(node2, pa.int64())]
    columns += [pa.array(sketches[:, k]) for k in range(SKETCH)] + [pa.array(often, _OFTEN)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n", "node", "node2", *_SKETCH, "often"])


def _often_row(keys: list, often: list) -> pa.RecordBatch:
    return _set_rows([k.slice(0, 1) for k in keys], [-1], [None], [None], np.zeros((1, SKETCH), np.int64), [often])


def _signed_sets(kind: Similarity, frequent: Broadcast) -> Callable:
    """node and a signature of its set; a set goes out once from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                nodes, sigs = [], []
                for text in batch.column("text").slice(at, 200):
                    h = shingles(text.as_py(), kind)
                    one = set_ids(h)[0] if len(h) else None
                    if one is not None and one not in seen:
                        seen.add(one)
                        sigs.append(_signed(all_signatures(h, frequent.value, kind)))
                        nodes.append(np.full(len(sigs[-1]), one, np.int64))
                if nodes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sigs))], ["node", "sig"])

    return releasing(run)


def frequent_shingles(sets: DataFrame) -> Broadcast:
    """A bitmap of the shingles that many sets have. It only decides which signatures are used, never what links.

    What comes to the driver are its words that aren't 0: MAP_BITS / 64 of them at most."""
    often = sets.filter("often is not null").select(F.explode("often").alias("o"))
    sums = often.groupBy("o.shingle").agg(F.sum("o.times").alias("times")).filter(F.col("times") >= SPREAD)
    bit = F.shiftrightunsigned("shingle", 20) % MAP_BITS
    words = sums.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 64).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("word"))
    found = words.toArrow()
    bitmap = np.zeros(MAP_BITS // 64, np.int64)
    bitmap[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return sets.sparkSession.sparkContext.broadcast(bitmap.view(np.uint8))


def _hashes(kind: Similarity) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = [_signed(shingles(t.as_py(), kind)) for t in batch.column("text").slice(at, 500)]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(at, 500), pa.array(rows, pa.list_(pa.int64()))], ["node", "hashes"])

    return releasing(run)


_BUCKETS = "head bigint, nodes array<bigint>, big boolean"


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """head (the least node) and nodes of the signatures that several nodes have, of rows that come sorted by signature
    and node; a bucket of more than SMALL members is big, and comes in pieces. What a task has given before, it leaves out."""
    told: dict = {}
    held_sig = held_node = np.empty(0, np.int64)
    open_sig = open_head = None  # a big bucket whose pieces have begun

    def rows(heads: list[int], nodes: list[np.ndarray], big: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(heads, pa.int64()), pa.array(nodes, pa.list_(pa.int64())), pa.array([big] * len(heads))], ["head", "nodes", "big"])

    def piece(head: int, nodes: np.ndarray) -> pa.RecordBatch | None:
        given = told.setdefault(head, set())
        new = [x for x in nodes.tolist() if x not in given]
        given.update(new)
        return rows([head], [new], True) if new else None

    def settled(sig: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole buckets."""
        fresh = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])) if len(sig) else np.empty(0, bool)
        sig, node = sig[fresh], node[fresh]
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.empty(0, np.int64)
        size = np.diff(first, append=len(sig))
        for m in np.unique(size[(size > 1) & (size <= SMALL)]).tolist():
            members = np.unique(node[first[size == m][:, None] + np.arange(m)], axis=0)
            new = [x for x in members if x.tobytes() not in told]
            told.update((x.tobytes(), None) for x in new)
            if new:
                yield rows([int(x[0]) for x in new], new, False)
        for k in np.flatnonzero(size > SMALL).tolist():
            out = piece(int(node[first[k]]), node[first[k] : first[k] + size[k]])
            if out:
                yield out

    for batch in batches:
        if sum(1 if v is None else len(v) for v in told.values()) > REMEMBERED:
            told.clear()
        sig, node = batch.column("sig").to_numpy(), batch.column("node").to_numpy()
        if open_sig is not None:
            end = int(np.searchsorted(sig, open_sig, "right"))
            out = piece(open_head, node[:end])
            if out:
                yield out
            sig, node = sig[end:], node[end:]
            if not len(sig):
                continue
            open_sig = None
        sig, node = np.concatenate([held_sig, sig]), np.concatenate([held_node, node])
        if not len(sig):
            continue
        end = int(np.searchsorted(sig, sig[-1]))  # the last bucket may go on
        yield from settled(sig[:end], node[:end])
        held_sig, held_node = sig[end:], node[end:]
        if len(np.unique(held_node[: 2 * SMALL])) > SMALL:
            open_sig, open_head = int(held_sig[0]), int(held_node[0])
            out = piece(open_head, np.unique(held_node))
            if out:
                yield out
            held_sig = held_node = np.empty(0, np.int64)
    yield from settled(held_sig, held_node)


def _buckets(each: DataFrame) -> DataFrame:
    """What ``_gathered`` finds in one exchange by signature."""
    with scratch.conf(each.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "32768"}):
        return scratch.table(each.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(releasing(_gathered), _BUCKETS), "join-buckets")


class _Sets:
    """The shingle hashes of nodes, found when they are first asked for and written once."""

    def __init__(self, rows: DataFrame, nodes: DataFrame, kind: Similarity) -> None:
        self.rows, self.places, self.kind = rows, nodes.select("node", F.col("row").alias("at")), kind
        self.known: list[DataFrame] = []

    def of(self, wanted: DataFrame) -> DataFrame:
        """node, hashes for the distinct nodes of the written table ``wanted``."""
        wanted = scratch.bounded(wanted)
        new = self.places.join(wanted, "node", "left_semi")
        for known in self.known:
            new = new.join(known, "node", "left_anti")
        new = scratch.table(new, "join-chosen")
        texts = self.rows.join(scratch.bounded(new), F.col("row") == F.col("at")).select("node", "text")
        self.known.append(scratch.table(texts.mapInArrow(_hashes(self.kind), _HASHES), "join-hashes"))
        scratch.free(new)
        return reduce(DataFrame.unionByName, self.known).join(wanted, "node", "left_semi")


class _Links:
    """Verifies candidate pairs and keeps the components that the links form."""

    def __init__(self, sets: _Sets, nodes: DataFrame, kind: Similarity) -> None:
        """``nodes``: a written table of node, size and sketch."""
        self.sets, self.brief, self.kind = sets, nodes, kind
        self.labels = scratch.table(nodes.select("node", F.col("node").alias("label")), "join-labels")
        self.tested: DataFrame | None = None

    def labelled(self, members: DataFrame) -> DataFrame:
        return members.join(scratch.bounded(self.labels), "node")

    def sketched(self, members: DataFrame) -> DataFrame:
        return members.join(scratch.bounded(self.brief), "node")

    def near(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sizes and sketches allow a link."""
        of = lambda c: scratch.bounded(self.brief).select(*[F.col(x).alias(f"{c}_{x}") for x in self.brief.columns])
        both = pairs.join(of("b"), F.col("b") == F.col("b_node")).join(of("a"), F.col("a") == F.col("a_node"))
        return both.filter(_near(self.kind, "a_", "b_")).select("a", "b")

    def test(self, pairs: DataFrame) -> None:
        """Forms components with the links among the ``pairs`` (a, b) that weren't tested before."""
        pairs = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = scratch.table(pairs, "join-near")
        if not pairs.limit(1).count():
            return
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        nodes = scratch.table(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "join-tested")
        hashes = self.sets.of(nodes)
        of = lambda c: hashes.select(F.col("node").alias(c), F.col("hashes").alias(f"{c}_hashes"))
        n, m, both = F.size("a_hashes"), F.size("b_hashes"), F.size(F.array_intersect("a_hashes", "b_hashes"))
        linked = self.kind.den * both >= self.kind.num * (n + m - both)
        links = scratch.table(pairs.join(of("b"), "b").join(of("a"), "a").filter(linked).select("a", "b"), "join-links")
        if links.limit(1).count():
            label = lambda c: scratch.bounded(self.labels).select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
            edges = links.join(label("a"), "a").join(label("b"), "b").select(F.col("a_label").alias("u"), F.col("b_label").alias("v"))
            found = components(edges)
            roots = scratch.bounded(found).select(F.col("node").alias("label"), "root")
            before = self.labels
            self.labels = scratch.table(before.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "join-labels")
            scratch.free(before, found)
        scratch.free(links, nodes)


def _near(kind: Similarity, p: str, q: str) -> Column:
    """Whether sizes and sketches allow a link; columns prefixed ``p`` and ``q``."""
    n, m = F.col(f"{p}size"), F.col(f"{q}size")
    bits = reduce(add, [F.bit_count(F.col(f"{p}s{k}").bitwiseXOR(F.col(f"{q}s{k}"))) for k in range(SKETCH)])
    sized = kind.den * F.least(n, m) >= kind.num * F.greatest(n, m)
    return sized & ((kind.den + kind.num) * bits <= (kind.den - kind.num) * (n + m))


def _small_pairs(few: DataFrame, links: _Links) -> DataFrame:
    """Pairs of different components in buckets (a written table of bucket and nodes) of up to SMALL members."""
    of = links.labelled(few.select("bucket", F.explode("nodes").alias("node"))).groupBy("bucket")
    of = of.agg(F.min("label").alias("p_"), F.max("label").alias("q_"), F.collect_set(F.struct("node", "label")).alias("m")).filter("p_ < q_")
    apart = lambda x: F.filter("m", lambda y: (y["node"] > x["node"]) & (y["label"] != x["label"]))
    pairs = F.flatten(F.transform("m", lambda x: F.transform(apart(x), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))))
    return of.select(F.explode(pairs).alias("x")).select("x.a", "x.b").distinct()


def _mixed(merged: DataFrame, links: _Links) -> DataFrame:
    """head, node, label and main (the largest component of the bucket) of merged buckets in which components meet."""
    labelled = links.labelled(merged)
    parts = labelled.groupBy("head", "label").agg(F.count("*").alias("n"))
    largest = parts.groupBy(F.col("head").alias("of")).agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("parts"))
    return scratch.table(labelled.join(largest.filter("parts > 1"), F.col("head") == F.col("of")).select("head", "node", "label", "main"), "join-mixed")


def _drawn_pairs(mixed: DataFrame) -> DataFrame:
    """The members outside of the main component, each with DRAWN members of its bucket."""
    member = F.struct("node", "label")
    picks = [F.min_by(member, F.xxhash64("node", F.lit(k))).alias(f"d{k}") for k in range(DRAWN)]
    drawn = mixed.groupBy(F.col("head").alias("of")).agg(F.array_distinct(F.array(*[p for p in picks])).alias("drawn"))
    pairs = mixed.filter("label <> main").join(drawn, F.col("head") == F.col("of")).select("node", "label", F.explode("drawn").alias("d"))
    return pairs.filter(F.col("label") != F.col("d.label")).select(F.col("node").alias("a"), F.col("d.node").alias("b")).distinct()


def _all_pairs_apart(mixed: DataFrame, links: _Links) -> DataFrame:
    """All near pairs of different components of a merged bucket, one of them outside of its main component."""
    left = links.sketched(mixed)
    lead = left.filter("label <> main").select(F.col("head").alias("of"), *[F.col(c).alias(f"a_{c}") for c in ("node", "label", "size", *_SKETCH)])
    once = (F.col("label") == F.col("main")) | (F.col("node") > F.col("a_node"))
    near = (F.col("head") == F.col("of")) & (F.col("label") != F.col("a_label")) & once & _near(links.kind, "", "a_")
    return lead.join(left, near).select(F.col("a_node").alias("a"), F.col("node").alias("b")).distinct()


def _link_all(buckets: DataFrame, links: _Links) -> None:
    if not buckets.limit(1).count():
        return
    met = buckets.select("head", F.explode("nodes").alias("node"))
    nearest = met.filter("node <> head").groupBy(F.col("node").alias("b")).agg(F.min("head").alias("a"))
    links.test(links.near(nearest.select("a", "b")))

    merged = scratch.table(buckets.filter("big").select("head", F.explode("nodes").alias("node")).distinct(), "join-merged")
    few = scratch.table(buckets.filter("not big").select("nodes").distinct().withColumn("bucket", F.monotonically_increasing_id()), "join-few")
    scratch.free(buckets)
    mixed = _mixed(merged, links)
    links.test(links.near(_small_pairs(few, links).unionByName(_drawn_pairs(mixed)).distinct()))
    scratch.free(few, mixed)

    mixed = _mixed(merged, links)
    links.test(_all_pairs_apart(mixed, links))
    scratch.free(mixed, merged)


def _linked_weights(hashes: list[np.ndarray], block: np.ndarray, same: bool, copies: np.ndarray, kind: Similarity) -> np.ndarray:
    """The copies of all sets that each set links with, of the ``same`` block or else of the other one."""
    size = np.array([len(h) for h in hashes])
    at = np.repeat(np.arange(len(hashes)), size)
    _, column, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    at, column = at[shared], column[shared]
    order = np.argsort(column, kind="stable")
    at, column = at[order], column[order]
    both = np.zeros((len(hashes), len(hashes)))
    start = 0
    while start < len(column):
        end = int(np.searchsorted(column, column[start] + COLUMNS))
        part = np.zeros((len(hashes), COLUMNS), np.float32)
        part[at[start:end], column[start:end] - column[start]] = 1
        both += part @ part.T
        start = end
    linked = kind.den * both >= kind.num * (size[:, None] + size[None, :] - both)
    linked &= ~np.eye(len(hashes), dtype=bool) if same else block[:, None] != block[None, :]
    return linked @ copies


def _counted(kind: Similarity) -> Callable:
    """node and its links, of rows that come sorted by their pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def found() -> pa.RecordBatch:
            hashes = [x[2].view(np.uint64) for x in held]
            links = _linked_weights(hashes, np.array([x[1] for x in held]), key[1] == key[2], np.array([x[3] for x in held]), kind)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.int64()), pa.array(links.astype(np.int64))], ["node", "links"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("label", "one", "two", "node", "block", "copies")]
            for k, (label, one, two, node, block, copies) in enumerate(zip(*columns, strict=True)):
                if held and key != (label, one, two):
                    yield found()
                    held.clear()
                key = (label, one, two)
                held.append((node, block, batch.column("hashes")[k].values.to_numpy().copy(), copies))
        if held:
            yield found()

    return releasing(run)


def _link_counts(labelled: DataFrame, sets: _Sets, kind: Similarity) -> DataFrame:
    """of_node, links: the documents with other sets that link with a document of the set; none of classes of one set."""
    several = labelled.groupBy(F.col("label").alias("class")).agg(F.ceil(F.count("*") / CLASS_BLOCK).cast("int").alias("blocks"), F.count("*").alias("sets"))
    members = labelled.join(several.filter("sets > 1"), F.col("label") == F.col("class"))
    hashes = sets.of(scratch.table(members.select("node"), "join-classes"))
    members = members.select("label", "node", "copies", "blocks", F.pmod(F.col("node"), F.col("blocks")).cast("int").alias("block"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = {"one": F.least("block", "other"), "two": F.greatest("block", "other")}
    sent = members.withColumns(pair).select("label", "one", "two", "node", "block", "copies").join(hashes.select("node", "hashes"), "node")
    sent = sent.repartition("label", "one", "two").sortWithinPartitions("label", "one", "two")
    counts = sent.mapInArrow(_counted(kind), "node bigint, links bigint")
    return scratch.table(counts.groupBy(F.col("node").alias("of_node")).agg(F.sum("links").alias("links")), "join-counts")


def locator(docs: DataFrame) -> str:
    """The column that holds the row locator of the located docs."""
    return scratch.free_name("__qm_row", docs)


def jaccard_components(
    docs: DataFrame, kind: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text", counted: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(located docs, classes): the classes have row, doc_id, n_shingles, component_id and class_key (null for a
    document without links) for every row, and n_links, the number of other documents that it links with, if ``counted``;
    the docs carry the same locator in the column that ``locator`` names."""
    with scratch.conf(docs.sparkSession, BATCH):
        return _jaccard_components(docs, kind, doc_id, text, counted)


def _jaccard_components(docs: DataFrame, kind: Similarity, doc_id: str, text: str, counted: bool) -> tuple[DataFrame, DataFrame]:
    row = locator(docs)
    located = scratch.with_row_locator(docs, row)
    rows = located.select(F.col(doc_id).alias("doc_id"), F.col(row).alias("row"), F.col(text).alias("text"))
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in ("doc_id", "row"))
    while True:
        found = scratch.table(rows.mapInArrow(_sets(kind), f"{kinds}, {_SETS}"), "join-sets")
        sets = found.filter("n >= 0")
        nodes = sets.filter("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("least_id"),
            F.min("row").alias("row"),
            F.count("*").alias("copies"),
            F.min("node2").alias("p"),
            F.max("node2").alias("q"),
            F.min("n").alias("size"),
            *[F.min(c).alias(c) for c in _SKETCH],
        )
        nodes = scratch.table(nodes, "join-nodes")
        if not nodes.filter("p <> q").limit(1).count():
            break
        scratch.free(found, nodes)
        kind = replace(kind, seed=kind.seed + 1)

    frequent = frequent_shingles(found)
    each = rows.select("text").mapInArrow(_signed_sets(kind, frequent), "node bigint, sig bigint")
    buckets = _buckets(each)
    active = scratch.table(nodes.join(buckets.select(F.explode("nodes").alias("node")).distinct(), "node", "left_semi").select("node", "size", *_SKETCH), "join-active")
    hashed = _Sets(rows, nodes, kind)
    links = _Links(hashed, active, kind)
    _link_all(buckets, links)

    labelled = nodes.select("node", "least_id", "copies").join(scratch.bounded(links.labels), "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = scratch.table(labelled, "join-labelled")
    least = labelled.groupBy("label").agg(F.min("least_id").alias("component"), F.sum("copies").alias("members")).filter("members > 1")
    named = labelled.join(least, "label").select(F.col("node").alias("named"), "component", "label")
    named = scratch.bounded(scratch.table(named, "join-named"))
    alone = F.col("named").isNull()
    classes = sets.select("row", "doc_id", "n", "node").join(named, F.col("node") == F.col("named"), "left")
    classes = classes.select(
        "row",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.col("label").alias("class_key"),
        *(["node"] if counted else []),
    )
    if counted:
        links = nodes.select(F.col("node").alias("same"), "copies").join(_link_counts(labelled, hashed, kind), F.col("same") == F.col("of_node"), "left")
        links = links.select("same", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")).filter("n_links > 0")
        links = scratch.bounded(scratch.table(links, "join-links-of"))
        classes = classes.join(links, F.col("node") == F.col("same"), "left").drop("node", "same").fillna(0, ["n_links"])
    return located, classes


def without_near_duplicates(docs: DataFrame, kind: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without links and, of each class, the one with the smallest id (the first by locator of
    rows that repeat it), with the columns of ``docs``."""
    located, classes = jaccard_components(docs, kind, doc_id, text)
    row, off = locator(docs), scratch.free_name("__qm_gone", docs)
    linked = scratch.table(classes.filter("class_key is not null").select("class_key", "doc_id", "row"), "join-linked")
    first = linked.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    gone = linked.join(first.select(F.col("first.row").alias("stays")), F.col("row") == F.col("stays"), "left_anti")
    gone = scratch.bounded(scratch.table(gone.select(F.col("row").alias(off)), "join-gone"))
    stay = located.join(gone, F.col(row) == F.col(off), "left_anti")
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])
