"""Near duplicates at a Jaccard similarity of word shingles, by long SimHash fingerprints.

Two sets of shingles at Jaccard similarity s have a cosine of 2s / (1 + s), and
every bit of their SimHash fingerprints agrees with the same probability,
1 - acos(cosine) / pi: 0.85 at 0.8. So 4 of 64 bits stand for far more than 0.8,
and no bound of 64 bits that lets 0.8 pass leaves keys that tell texts apart.
A fingerprint here is a ring of as many short segments as it takes. Rows that
agree in a segment are held to the chains that follow it on the ring: their
cumulative differences must stay within proportional budgets up to the full
Hamming check of 64 bits. What passes is compared exactly, by the shingles.

The width of a segment follows from the number of texts and the number of
segments from ``miss``, the share of pairs at exactly the similarity asked for
that may share no segment and chain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow, materialise
from .bloom import Bloom
from .graph import connected_components
from .hashing import joined, mix, of_texts, word_hashes, word_places
from .linededup import _chunks, _source
from .simhash import GROUP, Across, Chains, Forest, pairs_by_key

#: Bits that follow a segment on the ring, in so many further segments.
WINDOW, STEPS = 64, 4
#: Shingles added up together in bit planes.
_STACK = 31


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's different shingles; fewer words than a shingle are one shingle."""
    text = joined(texts)
    starts, ends = word_places(text)
    cuts = of_texts(starts, texts).tolist()
    words = word_hashes(text, starts, ends)

    def chained(w: np.ndarray, size: int) -> np.ndarray:
        h = w
        for k in range(1, size):
            h = mix(h[:-1], 20) ^ w[k:]
        return mix(h, 21)

    whole = chained(words, shingle)
    return [np.unique(whole[a : b - shingle + 1] if b - a >= shingle else chained(words[a:b], b - a)) for a, b in zip(cuts, cuts[1:])]


class Segments:
    """How many bits a segment has, how many segments there are, and the chains after one."""

    def __init__(self, rows: int, similarity: float, miss: float = 0.001):
        differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
        self.chains = Chains(max(STEPS, int(WINDOW * differ + 2.25 * math.sqrt(WINDOW * differ * (1 - differ)))), STEPS)
        #: About 32 texts by chance agree in a segment, however many there are.
        self.bits = max(8, round(math.log2(max(2, rows))) - 5)
        found = (1 - differ) ** self.bits * self._kept(differ)
        self.count = max(math.ceil(WINDOW / self.bits) + 1, math.ceil(math.log(miss) / math.log(1 - found)))
        self.words = math.ceil(self.count * self.bits / 64)

    def _kept(self, differ: float) -> float:
        """The share of pairs at the similarity that pass the chains."""
        n = WINDOW // STEPS
        step = np.array([math.comb(n, k) * differ**k * (1 - differ) ** (n - k) for k in range(n + 1)])
        total = np.ones(1)
        for l in range(1, STEPS + 1):
            total = np.convolve(total, step)[: self.chains.budgets[l] + 1]
        return float(total.sum())

    def keys(self, ring: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each segment, key and window of fingerprints (rows of ``words`` words)."""
        bits = np.unpackbits(np.ascontiguousarray(ring).view(np.uint8), axis=1, bitorder="little")[:, : self.count * self.bits]
        bits = np.concatenate([bits, bits[:, : self.bits + WINDOW]], axis=1)
        whole = lambda part: np.packbits(np.ascontiguousarray(part), axis=1, bitorder="little")
        for k in range(self.count):
            at = k * self.bits
            own = np.zeros((len(bits), 8), np.uint8)
            part = whole(bits[:, at : at + self.bits])
            own[:, : part.shape[1]] = part
            key = mix(own.view(np.uint64).ravel() * np.uint64(self.count) + np.uint64(k), 23)
            yield key, whole(bits[:, at + self.bits : at + self.bits + WINDOW]).view(np.uint64).ravel()


def _planes(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Bitwise sums of rows as planes of weight 1, 2, 4 and so on, by full adders."""
    planes = []
    while rows:
        carries = []
        while len(rows) > 1:
            a, b = rows.pop(), rows.pop()
            half = a ^ b
            if rows:
                c = rows.pop()
                rows.append(half ^ c)
                carries.append((a & b) | (half & c))
            else:
                rows.append(half)
                carries.append(a & b)
        planes += rows
        rows = carries
    return planes


def long_fingerprints(sets: list[np.ndarray], words: int) -> np.ndarray:
    """SimHash of each set (none empty), ``words`` times 64 bits: a bit is set if over half of the shingles set it."""
    size = np.array([len(s) for s in sets])
    stacks = -(-size // _STACK)
    start = np.cumsum(stacks) - stacks
    flat = np.zeros(int(stacks.sum()) * _STACK, np.uint64)
    real = np.zeros(len(flat), bool)
    for s, at in zip(sets, (start * _STACK).tolist()):
        flat[at : at + len(s)] = s
        real[at : at + len(s)] = True
    # the rest of a set's last stack adds nothing
    flat, mask = flat.reshape(-1, _STACK), np.where(real, ~np.uint64(0), np.uint64(0)).reshape(-1, _STACK)
    out = np.zeros((len(sets), words), np.uint64)
    for k in range(words):
        h = mix(flat, 40 + k) & mask
        count = np.zeros((len(sets), 64), np.int64)
        for weight, plane in enumerate(_planes([np.ascontiguousarray(h[:, j]) for j in range(_STACK)])):
            bits = np.unpackbits(plane.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            count += np.add.reduceat(bits, start, axis=0, dtype=np.int64) << weight
        out[:, k] = np.packbits(2 * count > size[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _prints(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """(doc_id, fp, ring): a hash of the set and its fingerprint. No words: 0 and none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for ids, texts in _chunks(batches):
            sets = shingle_sets(texts, shingle)
            some = [k for k, s in enumerate(sets) if len(s)]
            fp, ring = np.zeros(len(sets), np.uint64), [None] * len(sets)
            if some:
                held = [sets[k] for k in some]
                size = np.array([len(s) for s in held])
                fp[some] = mix(np.add.reduceat(mix(np.concatenate(held), 2), np.cumsum(size) - size) ^ size.astype(np.uint64))
                for k, row in zip(some, long_fingerprints(held, words)):
                    ring[k] = row.tobytes()
            yield {"doc_id": ids, "fp": fp.view(np.int64), "ring": ring}

    return map_arrow(_source(docs), rows, "doc_id long, fp long, ring binary")


def _keyed(distinct: DataFrame, plan: Segments) -> DataFrame:
    """(key, which, bits, node): a row for each segment of each fingerprint."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ring = np.frombuffer(b"".join(batch.column("ring").to_pylist()), np.uint64).reshape(-1, plan.words)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            for a in range(0, len(ring), 1024):
                keys = list(plan.keys(ring[a : a + 1024]))
                n = len(ring[a : a + 1024])
                yield {"key": np.concatenate([k for k, _ in keys]).view(np.int64), "which": np.zeros(n * len(keys), np.int32), "bits": np.concatenate([w for _, w in keys]).view(np.int64), "node": np.tile(node[a : a + 1024], len(keys))}

    return map_arrow(distinct.where("ring is not null").select("node", "ring"), rows, "key long, which int, bits long, node long")


def compared(docs: DataFrame, pairs: DataFrame, shingle: int, similarity: float, stack: int = 1024) -> DataFrame:
    """(a, b, similar) of pairs of doc_ids by their shingles.

    The shingles of documents that take part are made of their texts again. A
    document meets those it is compared with as a stream behind its own set;
    one with more than ``stack`` of them is dealt in several parts.
    """
    pairs = pairs.select("a", "b").distinct()
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    wanted = Bloom.of(nodes, "node")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for ids, texts in _chunks(batches):
            some = np.flatnonzero(wanted.may_hold(np.array(ids, np.int64))).tolist()
            if some:
                yield {"node": [ids[k] for k in some], "words": [s.tobytes() for s in shingle_sets([texts[k] for k in some], shingle)]}

    sets = map_arrow(_source(docs), made, "node long, words binary")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / stack).cast("int").alias("parts"))
    heads = parts.select(F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("head"))
    tails = pairs.join(parts, "a").select(F.col("b").alias("node"), F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), F.col("a").alias("head"))
    dealt = heads.union(tails).join(sets, "node").repartition("head", "part").sortWithinPartitions("head", "part", F.col("node") != F.col("head"), "node")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, own, last = None, np.zeros(0, np.uint64), None
        for batch in batches:
            out: dict[str, list] = {"a": [], "b": [], "similar": []}
            for head, part, node, words in zip(*(batch.column(c) for c in ("head", "part", "node", "words"))):
                at, node = (head.as_py(), part.as_py()), node.as_py()
                if (at, node) == last:  # rows that repeat a document
                    continue
                words = np.frombuffer(words.as_py(), np.uint64)
                if at != now:
                    now, own = at, words
                else:
                    common = 0
                    if min(len(own), len(words)) >= similarity * max(len(own), len(words)) - 1e-9:
                        common = len(np.intersect1d(own, words, assume_unique=True))
                    out["a"].append(at[0])
                    out["b"].append(node)
                    out["similar"].append(common >= similarity * (len(own) + len(words) - common) - 1e-9)
                last = at, node
            yield out

    return map_arrow(dealt, check, "a long, b long, similar boolean")


def similar_components(docs: DataFrame, distinct: DataFrame, plan: Segments, shingle: int, similarity: float, group: int = GROUP) -> DataFrame:
    """(node, root) by links of all pairs that share a segment and chain and are similar.

    A segment's rows give a spanning forest of pairs to compare. Where one of
    those is refused, its neighbours in the forest may be joined otherwise: such
    segments are searched again, each row against rows of other components, a
    few at first and eight times as many each time, until none is left.
    """
    keyed = _keyed(distinct, plan)
    linked = lambda which, diff: plan.chains.within(0, diff)
    offered = materialise(pairs_by_key(keyed, Forest(linked), group, tag="similar"), "offered")
    known = materialise(compared(docs, offered, shingle, similarity), "compared")
    again = offered.join(known.where("not similar").select("a", "b"), ["a", "b"], "left_semi").select("key").distinct()
    roots = materialise(connected_components(known.where("similar").select("a", "b")), "roots")
    tries = 8
    while not again.isEmpty():
        rows = keyed.join(again, "key", "left_semi").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        offered = materialise(pairs_by_key(rows, Across(linked, tries), group, tag="similar"), "offered")
        new = materialise(compared(docs, offered.select("a", "b").distinct().join(known, ["a", "b"], "left_anti"), shingle, similarity), "compared")
        joined = new.where("similar").select("a", "b")
        if not joined.isEmpty():
            roots = materialise(connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(joined)), "roots")
        known = known.union(new)
        again = offered.where("more").select("key").distinct()
        tries *= 8
    return roots


def similar_documents(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, miss: float = 0.001, group: int = GROUP) -> DataFrame:
    """(doc_id, fp, component_id) of every document with a doc_id.

    component_id is the smallest doc_id reached by links at a Jaccard similarity
    of ``similarity`` or more between sets of ``shingle`` words. Null text counts
    as empty; documents without words share a component. Repeated rows stay
    repeated; rows that give one doc_id several texts are compared by one of
    them. An empty table gives no row, and other columns are ignored. Of pairs
    at exactly ``similarity`` about the share ``miss`` is not found.
    """
    plan = Segments(docs.count(), similarity, miss)
    prints = materialise(_prints(docs, shingle, plan.words), "rings")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("node"), F.min("ring").alias("ring")), "fps")
    roots = similar_components(docs, distinct, plan, shingle, similarity, group)
    named = distinct.select("fp", "node").join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return prints.select("doc_id", "fp").join(named, "fp").select("doc_id", "fp", "component_id")
