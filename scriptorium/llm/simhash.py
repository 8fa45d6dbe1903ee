"""SimHash near-duplicates with pigeonring candidate filtering.

A fingerprint's 64 bits are m segments on a ring. If two fingerprints differ in
at most t bits, then from some segment on every chain of l consecutive segments
differs in at most l*t/m bits (the strong form of the pigeonring principle).
For t = 4 and m = 12 the first two segments of that chain agree and of the next
three at least two do, which gives 36 exact keys of about 21 bits per
fingerprint (a step further: 144 keys of 32 bits); rows that share a key are
held to the chain's budgets and then to the full Hamming distance. Only distinct
fingerprints are compared, and the rows of a key give a spanning forest of
links, so groups cost no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow, materialise, text_bytes
from .graph import connected_components

#: Shingles whose bits are summed at a time.
_BLOCK = 1 << 15
#: Rows of a key that one task compares; more are dealt in pairs of blocks.
GROUP = 1 << 14
#: Up to so many rows of a key are compared by shifting all keys at once.
_SMALL = 64

#: Whether bits that differ (third) keep two rows of a key linked; ``which`` numbers the kind of key.
Linked = Callable[[np.ndarray, np.ndarray], np.ndarray]


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 for a text without words.

    Fewer words than a shingle: the whole sequence is the one shingle. A bit is
    set if it is set in over half of the shingles' XXH64 values.
    """
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    one = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    total = np.zeros(64, np.int64)
    for k in range(0, n, _BLOCK):
        h = np.array([one(line[s : e - 1], seed) for s, e in zip(starts[k : min(n, k + _BLOCK)], ends[k + last :])], np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long. Null text counts as empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield {"doc_id": batch.column("doc_id"), "fp": fps.view(np.int64)}

    return map_arrow(docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")), rows, "doc_id long, fp long")


class Chains:
    """Proportional budgets of chains of segments: l of ``segments`` may differ in l * distance / segments bits."""

    def __init__(self, distance: int, segments: int):
        self.distance, self.m = distance, segments
        cuts = [round(64 * k / segments) for k in range(segments + 1)]
        self.masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
        self.budgets = [l * distance // segments for l in range(segments + 1)]

    def within(self, first: np.ndarray | int, diff: np.ndarray) -> np.ndarray:
        """Which of ``diff`` keep every chain from segment ``first`` within its budget; the last chain is the
        whole, so that is the full Hamming check. Those that fail a chain are not looked at again."""
        masks = np.array(self.masks, np.uint64)
        left = np.arange(len(diff))
        total = np.zeros(len(diff), np.int64)
        first = np.broadcast_to(np.asarray(first), diff.shape)
        for l in range(self.m):
            total = total + np.bitwise_count(diff[left] & masks[(first[left] + l) % self.m])
            ok = total <= self.budgets[l + 1]
            left, total = left[ok], total[ok]
        return left


class Ring(Chains):
    """Chains on a ring, and the exact keys that some chain within its budgets shares.

    Of a chain's first segments, as many as have a budget of ``depth`` - 1 or
    less, a key leaves out ``depth`` - 1 in every way that the budgets allow.
    """

    def __init__(self, distance: int = 4, segments: int = 12, depth: int = 2):
        super().__init__(distance, segments)
        if distance >= segments:
            raise ValueError("take more segments than the distance")
        depth = min(depth, distance + 1)
        reach = max(l for l in range(1, segments + 1) if self.budgets[l] < depth)
        allowed = [out for out in combinations(range(reach), depth - 1) if all(k + 1 <= self.budgets[at + 1] for k, at in enumerate(out))]
        #: Per key: the first segment of its chain and the bits that must agree.
        self.keys = [(first, sum(self.masks[(first + k) % segments] for k in range(reach) if k not in out)) for first in range(segments) for out in allowed]

    @classmethod
    def for_rows(cls, rows: int, distance: int = 4, segments: int = 12) -> Ring:
        """A ring whose keys have about as many bits as tell ``rows`` apart, so that the work grows as they do."""
        for depth in range(2, distance + 2):
            ring = cls(distance, segments, depth)
            if min(mask.bit_count() for _, mask in ring.keys) + 4 >= math.log2(max(2, rows)):
                break
        return ring


def _spread(mask: int, salt: int, fps: np.ndarray) -> np.ndarray:
    """A key: the number of its mask and a mix of the bits under it, one to one."""
    x = (fps & np.uint64(mask)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return ((x * np.uint64(0xBF58476D1CE4E5B9)) ^ np.uint64(salt * 0x94D049BB133111EB & (2**64 - 1))).view(np.int64)


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links (a, b), taken in order, join what no earlier ones joined."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    use = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            use[k] = True
    return use


def _forest(bits: np.ndarray, linked: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Spanning links (row, rows) of a group: each reached row is tested against those not reached yet."""
    left = np.arange(len(bits))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            k = queue.pop()
            hit = linked(bits[k] ^ bits[left])
            if len(hit):
                yield int(k), left[hit]
                queue.extend(left[hit])
                left = np.delete(left, hit)


def close_pairs(edge: np.ndarray, sizes: np.ndarray, which: np.ndarray, bits: np.ndarray, linked: Linked) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs (rows i < j) of groups of rows, given their first rows and sizes."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for shift in range(1, int(sizes.max(initial=0))):  # pairs of all groups at once
        fit = sizes > shift
        n = sizes[fit] - shift
        i = np.repeat(edge[fit] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        i = i[linked(which[i], bits[i] ^ bits[i + shift])]
        a.append(i)
        b.append(i + shift)
    return np.concatenate(a), np.concatenate(b)


@dataclass(frozen=True)
class Forest:
    """Chooses links that connect what ``linked`` connects."""

    linked: Linked

    def __call__(self, edge: np.ndarray, sizes: np.ndarray, which: np.ndarray, bits: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        small = sizes <= _SMALL
        a, b = close_pairs(edge[small], sizes[small], which, bits, self.linked)
        use = spanning(a, b)
        a, b = [a[use]], [b[use]]
        for s, n in zip(edge[~small].tolist(), sizes[~small].tolist()):
            kind = which[s : s + 1]
            for k, rows in _forest(bits[s : s + n], lambda diff: self.linked(np.broadcast_to(kind, diff.shape), diff)):  # noqa: B023
                a.append(np.full(len(rows), s + k))
                b.append(s + rows)
        a, b = np.concatenate(a), np.concatenate(b)
        return a, b, np.zeros(len(a), bool)


@dataclass(frozen=True)
class Across:
    """Chooses, for each row, the first ``tries`` linked rows before it of another root, and says if it had more."""

    linked: Linked
    tries: int

    def __call__(self, edge: np.ndarray, sizes: np.ndarray, which: np.ndarray, bits: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        small = sizes <= _SMALL
        i, j = close_pairs(edge[small], sizes[small], which, bits, self.linked)
        apart = np.flatnonzero(root[i] != root[j])
        a, b = [i[apart]], [j[apart]]
        for s, n in zip(edge[~small].tolist(), sizes[~small].tolist()):
            for k in range(s + 1, s + n):
                i = s + np.flatnonzero(root[s:k] != root[k])
                i = i[self.linked(which[i], bits[i] ^ bits[k])]
                a.append(i)
                b.append(np.full(len(i), k))
        a, b = np.concatenate(a), np.concatenate(b)
        order = np.lexsort((a, b))
        a, b = a[order], b[order]
        head = np.flatnonzero(np.append(True, b[1:] != b[:-1])[: len(b)])
        count = np.diff(np.append(head, len(b)))
        nth = np.arange(len(b)) - np.repeat(head, count)
        use = nth < self.tries
        return a[use], b[use], np.repeat(count > self.tries, count)[use]


def pairs_by_key(rows: DataFrame, choose: Forest | Across, group: int = GROUP, partitions: int | None = None, tag: str = "pairs") -> DataFrame:
    """(key, a, b, more): the pairs of nodes that ``choose`` takes of ``rows`` (key, which, bits, node[, root]) with one key.

    A key's rows are compared in one task while there are no more than ``group``.
    Those of larger keys are only numbered there and dealt again, a task for
    each pair of blocks of ``group`` rows, so no task holds more than two.
    """
    names = ("key", "which", "cell", "bits", "node", "root")
    schema = "key long, a long, b long, more boolean, which int, root long, place long"

    def search(most: int):
        def chosen(cols: list[np.ndarray], edge: np.ndarray, sizes: np.ndarray) -> dict:
            key, which, _, bits, node, root = cols
            a, b, more = choose(edge, sizes, which, bits.view(np.uint64), root)
            return {"key": key[a], "a": node[a], "b": node[b], "more": more, "which": which[a], "root": root[a], "place": np.full(len(a), -1)}

        def numbered(cols: list[np.ndarray], first: int) -> dict:
            key, which, _, bits, node, root = cols
            return {"key": key, "a": bits, "b": node, "more": np.zeros(len(key), bool), "which": which, "root": root, "place": first + np.arange(len(key))}

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            held: list[np.ndarray] = []
            large, seen = None, 0  # the key that is only numbered, and how many of its rows were
            for batch in batches:
                cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
                cols = [np.concatenate(x) for x in zip(held, cols)] if held else cols
                if large is not None:
                    m = int(((cols[0] == large[0]) & (cols[1] == large[1])).sum())
                    yield numbered([c[:m] for c in cols], seen)
                    seen, cols = seen + m, [c[m:] for c in cols]
                    large = None if len(cols[0]) else large
                held = cols
                if not len(cols[0]):
                    continue
                edge = np.flatnonzero(np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:3]])))
                sizes = np.diff(np.append(edge, len(cols[0])))
                for k in np.flatnonzero(sizes[:-1] > most).tolist():
                    yield numbered([c[edge[k] : edge[k + 1]] for c in cols], 0)
                fit = np.flatnonzero(sizes[:-1] <= most)
                if len(fit):
                    yield chosen(cols, edge[fit], sizes[fit])
                held = [c[edge[-1] :] for c in cols]  # the last key may go on
                if sizes[-1] > most:
                    yield numbered(held, 0)
                    large, seen, held = (held[0][0], held[1][0]), int(sizes[-1]), []
            if held and len(held[0]):
                yield chosen(held, np.zeros(1, np.int64), np.array([len(held[0])]))

        return found

    dealt = (rows.repartition(partitions, "key") if partitions else rows.repartition("key")).sortWithinPartitions("key", "which", "node")
    dealt = dealt.withColumn("cell", F.lit(0)).withColumn("root", F.col("root") if "root" in rows.columns else F.lit(0).cast("long"))
    first = materialise(map_arrow(dealt, search(group), schema), tag)
    plain, left = first.where("place < 0").select("key", "a", "b", "more"), first.where("place >= 0")
    if left.isEmpty():
        return plain
    last = left.groupBy("key", "which").agg((F.max("place") / group).cast("int").alias("last"))  # a row for each key of over ``group`` rows
    own, other = F.floor(F.col("place") / group).cast("int"), F.col("other")
    cells = left.join(last, ["key", "which"]).withColumn("other", F.explode(F.sequence(F.lit(0), "last"))).where(own != other)
    cell = (F.least(own, other) * (F.col("last") + 1) + F.greatest(own, other)).alias("cell")
    cells = cells.select("key", "which", cell, F.col("a").alias("bits"), F.col("b").alias("node"), "root").repartition("key", "which", "cell")
    return plain.union(map_arrow(cells.sortWithinPartitions("key", "which", "cell", "node"), search(2 * group), schema).select("key", "a", "b", "more"))


def links(distinct: DataFrame, distance: int = 4, segments: int = 12, partitions: int | None = None, group: int = GROUP) -> DataFrame:
    """(a, b) links between distinct fingerprints ``fp`` whose components are those of
    all pairs at ``distance`` or fewer bits."""
    ring = Ring.for_rows(distinct.count(), distance, segments)
    firsts = np.array([f for f, _ in ring.keys])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 4096):
                part = fps[at : at + 4096]
                keys = np.concatenate([_spread(mask, k, part) for k, (_, mask) in enumerate(ring.keys)])
                which = np.repeat(np.arange(len(ring.keys), dtype=np.int32), len(part))
                same = np.tile(part, len(ring.keys)).view(np.int64)
                yield {"key": keys, "which": which, "bits": same, "node": same}

    rows = map_arrow(distinct.select("fp"), keyed, "key long, which int, bits long, node long")
    return pairs_by_key(rows, Forest(lambda which, diff: ring.within(firsts[which], diff)), group, partitions).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, segments: int = 12) -> DataFrame:
    """(doc_id, fp, component_id, links) of every document.

    component_id is the smallest doc_id reached by links at ``distance`` or
    fewer differing bits. Null text counts as empty; documents without words
    share fingerprint 0 and so a component. Repeated rows stay repeated. Null
    doc_ids keep a row and never name a component unless all of it is null. An
    empty table gives no row.
    """
    prints = materialise(fingerprints(docs, shingle), "simhash")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    return named_components(prints, distinct, links(distinct, distance, segments))


def named_components(prints: DataFrame, distinct: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of ``prints``, by links of the ``distinct`` (fp, least doc_id)."""
    roots = connected_components(links)
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialise(named, "rooted")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id")


def hex16(column: str):
    """A signed long as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def keep_first(docs: DataFrame, components: Callable[..., DataFrame] = near_duplicates, **params) -> DataFrame:
    """Documents that are the first of their component: one of each group stays.

    Rows that repeat a doc_id count as one document and go or stay together.
    Rows without a doc_id can't be told apart from others and all stay.
    """
    named = docs.where("doc_id IS NOT NULL")
    first = components(named, **params).where("doc_id = component_id").select("doc_id").distinct()
    return named.join(first, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
