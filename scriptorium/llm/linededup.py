"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Two lines match at a Jaccard similarity of
``similarity`` or more, and a line with a match that comes earlier (by doc_id,
then place) is removed. Steps:

1. One pass counts words in a sketch whose size follows from the input's and
   settles lines with equal sets by a hash of the set.
2. Words ordered by the sketch (rarest first, ties by hash) are the same order
   everywhere, so matching lines share a word of their prefixes. Entries by
   prefix word, without the lines' words, find those with a possible partner:
   by sizes, places in the prefix, and a 128-bit parity map that bounds the
   overlap. Of lines with equal sets only the earliest takes part. Words that very many lines have are joined with each later word of
   a prefix longer by one, which matching lines share as well.
3. Only entries with a possible partner are dealt again, with the lines' words,
   and compared exactly. Each entry leaves at most one row; pairs are never sent.

Entries are dealt as packed arrays, a row for each bucket and chunk of texts,
so that Spark moves a few large rows and numpy does the work on entries. A
word is known by 64 bits of its hash, a set by 128.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow, materialise, text_bytes, unused
from .bloom import united_bits
from .hashing import joined, mix, packed, ranges, unpacked, word_hashes, word_places

_PIECE = 1 << 14  # counters of a row of a partial sketch
_CODES = 8  # steps of a counter's logarithm for each doubling
_CHUNK = 1 << 19  # bytes of text taken together
_HELD = 12 << 20  # bytes of entries that a task holds before it deals them
_LINES = 12  # bits of a sort key for the line, before 8 for the counter and the first ones of the word


@dataclass
class Lines:
    """Lines of a chunk: document, place, number of different words, and where these begin in ``words``,
    which are in order of rarity; ``codes`` stand for their (sketched) numbers of lines."""

    doc: np.ndarray
    place: np.ndarray
    size: np.ndarray
    start: np.ndarray
    words: np.ndarray
    codes: np.ndarray | None

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each line's set."""
        if not len(self.size):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        one, two = (np.add.reduceat(mix(self.words, k), self.start) for k in (2, 3))
        return mix(one ^ self.size.astype(np.uint64)), mix(two)

    def parities(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each line, each the parity of the words that fall to it."""
        if not len(self.size):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        bit = np.uint64(1) << (self.words & np.uint64(63))
        half = (self.words >> np.uint64(6)) & np.uint64(1)
        return np.bitwise_xor.reduceat(bit * half, self.start), np.bitwise_xor.reduceat(bit * (np.uint64(1) - half), self.start)

    def take(self, keep: np.ndarray) -> Lines:
        """Those lines only."""
        size = self.size[keep]
        start = np.cumsum(size) - size
        at = ranges(self.start[keep], size)
        return Lines(self.doc[keep], self.place[keep], size, start, self.words[at], None if self.codes is None else self.codes[at])


def code(counts: np.ndarray) -> np.ndarray:
    """Counts in 256 steps that keep their order, 1 (and 0) apart from all others; the last begins at 2**31.9."""
    return np.minimum(255, np.floor(_CODES * np.log2(np.maximum(counts, 1)))).astype(np.uint8)


def counter(words: np.ndarray, counters: int) -> np.ndarray:
    """The counter of each word in a sketch of that many (a power of two)."""
    return (words & np.uint64(counters - 1)).astype(np.int64)


def lines_of(docs: list[int], texts: list[bytes], least: int, sketch: np.ndarray | None = None) -> Iterator[Lines]:
    """The lines with at least ``least`` different words; ``sketch`` has the codes of the counters."""
    text = joined(texts)
    starts, ends = word_places(text)
    line = np.cumsum(text[:-8] == 10)[starts] if len(starts) else starts
    per_doc = np.array([t.count(b"\n") + 1 for t in texts])
    total = int(per_doc.sum())
    enough = np.bincount(line, minlength=total) >= least
    dense = np.cumsum(enough) - 1
    use = enough[line] if len(line) else np.zeros(0, bool)
    h = word_hashes(text, starts[use], ends[use])
    line = dense[line[use]]
    owner = np.repeat(np.arange(len(texts)), per_doc)
    place = np.arange(total) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    owner, place = owner[enough], place[enough]
    ids = np.array(docs, np.int64)
    for low in range(0, len(owner), 1 << _LINES):
        a, b = np.searchsorted(line, [low, low + (1 << _LINES)])
        words, own = h[a:b], (line[a:b] - low).astype(np.uint64)
        codes = np.zeros(len(words), np.uint8) if sketch is None else sketch[counter(words, len(sketch))]
        key = (own << np.uint64(64 - _LINES)) | (codes.astype(np.uint64) << np.uint64(56 - _LINES)) | (words >> np.uint64(8 + _LINES))
        order = np.argsort(key)
        key, words = key[order], words[order]
        same = key[1:] == key[:-1]
        if np.any(same & (words[1:] != words[:-1])):  # words that agree in the first bits are ordered by the rest
            order = order[np.lexsort((words, key))]
            words = h[a:b][order]
            same = (own[order][1:] == own[order][:-1]) & (words[1:] == words[:-1])
        keep = np.append(True, ~same)[: len(words)]
        n = len(owner[low : low + (1 << _LINES)])
        size = np.bincount(own[order][keep].astype(np.int64), minlength=n)
        found = Lines(ids[owner[low : low + n]], place[low : low + n], size, np.cumsum(size) - size, words[keep], codes[order][keep] if sketch is not None else None)
        yield found if size.min(initial=least) >= least else found.take(np.flatnonzero(size >= least))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    docs, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            docs.append(doc)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= _CHUNK:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


# Packed entries: arrays of one length, one after the other.
_POSSIBLE = (("key", "<u8"), ("doc", "<i8"), ("place", "<i4"))
_LINE = (("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("place", "<i4"))
_ENTRY = (("key", "<u8"), ("p1", "<u8"), ("p2", "<u8"), ("set", "<u8"), ("doc", "<i8"), ("place", "<i4"), ("size", "<u4"), ("at", "<u4"))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h % np.uint64(buckets)).astype(np.int64)


def _first_of_equal(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each line is the earliest of those with its set, or stands where that does."""
    order = np.lexsort((place, doc, h2, h1))
    new = np.append(True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))[: len(order)]
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    first = np.empty(len(order), bool)
    first[order] = (doc[order] == doc[head]) & (place[order] == place[head])
    return first


def _source(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), text_bytes().alias("text"))


def _survey(docs: DataFrame, least: int, buckets: int, counters: int) -> DataFrame:
    """Rows of three kinds: pieces of partial sketches (0), packed lines by set (1), and lines (doc_id,
    place) that are no first of their chunk (2)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total, held, size = np.zeros(counters, np.uint32), [], 0
        firsts: list[dict[str, np.ndarray]] = []
        waiting = 0

        def add() -> None:
            at = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            total[at[first]] += np.diff(np.append(first, len(at))).astype(np.uint32)

        def dealt() -> dict:
            e = {f: np.concatenate([x[f] for x in firsts]) for f, _ in _LINE}
            out = list(packed(e, _LINE, _bucket(e["h1"], buckets), buckets))
            no = [None] * len(out)
            return {"kind": [1] * len(out), "bucket": [k for k, _, _ in out], "data": [d for _, d, _ in out], "doc_id": no, "line": no}

        for ids, texts in _chunks(batches):
            for lines in lines_of(ids, texts, least):
                held.append(counter(lines.words, counters))
                size += len(held[-1])
                if size > 1 << 19:
                    add()
                    held, size = [], 0
                h1, h2 = lines.sums()
                first = _first_of_equal(h1, h2, lines.doc, lines.place)
                firsts.append({"h1": h1[first], "h2": h2[first], "doc": lines.doc[first], "place": lines.place[first]})
                waiting += 28 * int(first.sum())
                if (m := int((~first).sum())):
                    yield {"kind": [2] * m, "bucket": [None] * m, "data": [None] * m, "doc_id": lines.doc[~first], "line": lines.place[~first].astype(np.int32)}
            if waiting > _HELD:
                yield dealt()
                firsts, waiting = [], 0
        if firsts:
            yield dealt()
        if held:
            add()
        parts = total.reshape(-1, _PIECE)
        used = np.flatnonzero(parts.any(1)).tolist()
        no = [None] * len(used)
        yield {"kind": [0] * len(used), "bucket": used, "data": [parts[k].tobytes() for k in used], "doc_id": no, "line": no}

    return map_arrow(_source(docs), rows, "kind int, bucket int, data binary, doc_id long, line int")


def _codes(pieces: DataFrame, counters: int) -> np.ndarray:
    """The codes of the counters, whose partial counts are in pieces: a byte each reaches the driver."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("bucket").to_pylist(), batch.column("data")):
                held[k] = held.get(k, np.int64(0)) + np.frombuffer(data.as_py(), "<u4")
        yield {"bucket": list(held), "data": [code(v).tobytes() for v in held.values()]}

    out = np.zeros((counters // _PIECE, _PIECE), np.uint8)
    for r in map_arrow(pieces.select("bucket", "data").repartition(64, "bucket"), rows, "bucket int, data binary").collect():
        out[r["bucket"]] = np.frombuffer(r["data"], np.uint8)
    return out.ravel()


def _later_equal(lines: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, line) of lines whose set an earlier line of another chunk has."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        e = unpacked([d.as_py() for b in batches for d in b.column("data")], _LINE)
        later = ~_first_of_equal(e["h1"], e["h2"], e["doc"], e["place"])
        yield {"doc_id": e["doc"][later], "line": e["place"][later]}

    return map_arrow(lines.select("bucket", "data").repartition(buckets, "bucket"), rows, "doc_id long, line int")


def prefix_entries(lines: Lines, similarity: float, hot: int) -> dict[str, np.ndarray]:
    """Keys of the lines' prefixes: key, place in the prefix (at), and line. A word of one line only is no key."""
    first = lines.size - np.ceil(similarity * lines.size - 1e-9).astype(np.int64) + 1
    line = np.repeat(np.arange(len(lines.size)), lines.size)
    at = np.arange(len(line)) - lines.start[line]
    use = np.flatnonzero((at < first[line]) & (lines.codes > 0))
    often = lines.codes[use] > code(np.array([hot]))[0]
    plain = use[~often]
    keys, ats, owners = [mix(lines.words[plain], 5)], [at[plain]], [line[plain]]
    for k in use[often].tolist():
        of, stop = line[k], lines.start[line[k]] + min(first[line[k]] + 1, lines.size[line[k]])
        both = mix(lines.words[k] ^ mix(lines.words[k + 1 : stop], 7), 8)
        if first[of] + 1 > lines.size[of]:  # one common word may be all: it stays a key
            both = np.append(both, mix(lines.words[k : k + 1], 5))
        keys.append(both)
        ats.append(np.full(len(both), at[k]))
        owners.append(np.full(len(both), of))
    return {"key": np.concatenate(keys), "at": np.concatenate(ats), "line": np.concatenate(owners)}


def _dealt(docs: DataFrame, sketch, marks, least: int, similarity: float, hot: int, buckets: int) -> DataFrame:
    """Packed entries by bucket; only marked ones, with the lines' words, if there are ``marks``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bits = marks.value if marks else None
        held: list[dict[str, np.ndarray]] = []
        texts_of: list[np.ndarray] = []
        size = 0

        def flush() -> dict:
            e = {f: np.concatenate([h[f] for h in held]) for f, _ in _ENTRY}
            out = list(packed(e, _ENTRY, _bucket(e["key"], buckets), buckets))
            words = [None] * len(out)
            if bits is not None:
                n = e["size"].astype(np.int64)
                flat, start = np.concatenate(texts_of), np.cumsum(n) - n
                words = [flat[ranges(start[w], n[w])].astype("<u8").tobytes() for _, _, w in out]
            return {"bucket": [k for k, _, _ in out], "data": [d for _, d, _ in out], "words": words}

        for ids, texts in _chunks(batches):
            if bits is not None:
                whole = np.array(ids, np.int64)
                some = _marked(bits, whole, np.full(len(ids), -1), np.zeros(len(ids), np.uint64)).tolist()
                ids, texts = [d for d, x in zip(ids, some) if x], [t for t, x in zip(texts, some) if x]
                if not ids:
                    continue
            for lines in lines_of(ids, texts, least, sketch.value):
                h1, h2 = lines.sums()
                keep = np.flatnonzero(_first_of_equal(h1, h2, lines.doc, lines.place))
                lines, h1 = lines.take(keep), h1[keep]
                e = prefix_entries(lines, similarity, hot)
                of = e["line"]
                p1, p2 = lines.parities()
                e |= {"p1": p1[of], "p2": p2[of], "set": h1[of], "doc": lines.doc[of], "place": lines.place[of], "size": lines.size[of]}
                if bits is not None:
                    hit = np.flatnonzero(_marked(bits, e["doc"], e["place"], e["key"]))
                    e, of = {f: v[hit] for f, v in e.items()}, of[hit]
                    texts_of.append(lines.words[ranges(lines.start[of], lines.size[of])])
                    size += 8 * len(texts_of[-1])
                held.append({f: e[f].astype(t) for f, t in _ENTRY})
                size += 52 * len(e["key"])
            if size > _HELD:
                yield flush()
                held, texts_of, size = [], [], 0
        if held:
            yield flush()

    return map_arrow(_source(docs), rows, "bucket int, data binary, words binary").repartition(buckets, "bucket")


def _positions(doc: np.ndarray, place: np.ndarray, key: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    h = mix(doc.astype(np.int64).view(np.uint64) ^ mix(place.astype(np.int64).view(np.uint64) ^ mix(key, 9), 9), 10)
    for k in range(3):
        yield (mix(h, 11 + k) & np.uint64(bits - 1)).astype(np.int64)


def _marked(marks: np.ndarray, doc: np.ndarray, place: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether a Bloom filter may hold the entries (place -1 and key 0: any of the document)."""
    found = np.ones(len(doc), bool)
    for at in _positions(doc, place, key, 8 * len(marks)):
        found &= (marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return found


def _marks(entries: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of packed (doc, place, key) and of their documents."""

    def places(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        e = unpacked([d.as_py() for d in batch.column("data")], _POSSIBLE)
        docs = np.unique(e["doc"])
        yield from _positions(e["doc"], e["place"], e["key"], bits)
        yield from _positions(docs, np.full(len(docs), -1), np.zeros(len(docs), np.uint64), bits)

    return united_bits(entries.select("data"), places, bits)


def candidates(e: dict[str, np.ndarray], similarity: float, block: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of entries of a key, sorted by key and size, that may match: by size, place and parity."""
    if not len(e["key"]):
        return
    size = e["size"].astype(np.int64)
    rest = size - e["at"].astype(np.int64)
    group = np.cumsum(np.append(0, e["key"][1:] != e["key"][:-1]))
    limit = np.floor(size / similarity + 1e-9).astype(np.int64)
    wide = int(limit.max()) + 2
    n = np.searchsorted(group * wide + size, group * wide + limit, side="right") - np.arange(len(size)) - 1
    low = 0
    while low < len(size):
        m = n[low : low + max(1, int(np.searchsorted(np.cumsum(n[low : low + block]), block, side="right")))]
        if k := int(m.sum()):
            i = np.repeat(np.arange(low, low + len(m)), m)
            j = i + 1 + np.arange(k) - np.repeat(np.cumsum(m) - m, m)
            both = size[i] + size[j]
            need = np.ceil(similarity / (1 + similarity) * both - 1e-9).astype(np.int64)
            ok = np.flatnonzero(np.minimum(rest[i], rest[j]) >= need)
            i, j = i[ok], j[ok]
            apart = np.bitwise_count(e["p1"][i] ^ e["p1"][j]).astype(np.int64) + np.bitwise_count(e["p2"][i] ^ e["p2"][j])
            ok = both[ok] - apart >= 2 * need[ok]
            yield i[ok], j[ok]
        low += len(m)


def _in_order(blobs: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The entries of a task, by key and size, without later ones of a key with an equal set; and which they are."""
    e = unpacked(blobs, _ENTRY)
    _, which, often = np.unique(mix(e["key"] ^ mix(e["set"], 15), 16), return_inverse=True, return_counts=True)
    repeats = np.flatnonzero(often[which] > 1) if len(which) else np.zeros(0, np.int64)
    keep = np.ones(len(e["key"]), bool)
    if len(repeats):
        repeats = repeats[np.lexsort((e["place"][repeats], e["doc"][repeats], which[repeats]))]
        keep[repeats[1:][which[repeats[1:]] == which[repeats[:-1]]]] = False
    keep = np.flatnonzero(keep)
    keep = keep[np.lexsort((e["size"][keep], e["key"][keep]))]
    return {f: v[keep] for f, v in e.items()}, keep


def _possible(dealt: DataFrame, similarity: float) -> DataFrame:
    """Packed (key, doc, place) of the entries with a possible partner, and how many."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        e, _ = _in_order([d.as_py() for b in batches for d in b.column("data")])
        mark = np.zeros(len(e["key"]), bool)
        for i, j in candidates(e, similarity):
            mark[i] = mark[j] = True
        yield {"data": [b"".join(e[f][mark].astype(t).tobytes() for f, t in _POSSIBLE)], "n": [int(mark.sum())]}

    return map_arrow(dealt.select("bucket", "data"), rows, "data binary, n long")


def _matching(words: np.ndarray, start: np.ndarray, size: np.ndarray, start2: np.ndarray, size2: np.ndarray, similarity: float, most: int = 1 << 18) -> np.ndarray:
    """Whether pairs of lines match: words of both sides in order, equal neighbours of a pair counted."""
    out = np.zeros(len(start), bool)
    total = size + size2
    for part in np.split(np.arange(len(start)), np.flatnonzero(np.diff(np.cumsum(total) // most)) + 1):
        pair = np.concatenate([np.repeat(np.arange(len(part)), size[part]), np.repeat(np.arange(len(part)), size2[part])])
        both = words[np.concatenate([ranges(start[part], size[part]), ranges(start2[part], size2[part])])]
        order = np.argsort(both ^ mix(pair.astype(np.uint64), 19))  # a pair's equal words meet; others may lie between pairs
        both, pair = both[order], pair[order]
        common = np.bincount(pair[1:][(both[1:] == both[:-1]) & (pair[1:] == pair[:-1])], minlength=len(part))
        out[part] = common >= similarity * (total[part] - common) - 1e-9
    return out


def _matched(dealt: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, line) of the lines that match an earlier one, repeats included."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        got = [(d.as_py(), w.as_py()) for b in batches for d, w in zip(b.column("data"), b.column("words"))]
        sizes = unpacked([d for d, _ in got], _ENTRY)["size"].astype(np.int64)
        e, kept = _in_order([d for d, _ in got])
        start = (np.cumsum(sizes) - sizes)[kept]
        words = np.frombuffer(b"".join(w for _, w in got), "<u8")
        doc, place, size = e["doc"], e["place"].astype(np.int64), e["size"].astype(np.int64)
        _, line = np.unique(mix(doc.view(np.uint64) ^ mix(place.view(np.uint64), 17), 18), return_inverse=True)
        gone = np.zeros(len(doc), bool)  # by number of the line
        for i, j in candidates(e, similarity):
            later = (doc[i] > doc[j]) | ((doc[i] == doc[j]) & (place[i] > place[j]))
            a, b = np.where(later, i, j), np.where(later, j, i)  # a comes after b
            use = np.flatnonzero((line[a] != line[b]) & ~gone[line[a]])
            use = use[np.lexsort((place[b[use]], doc[b[use]], line[a[use]]))]
            a, b = a[use], b[use]
            tries = 1
            while len(a):  # of each line left, the next candidates; most lines match one of the first
                head = np.flatnonzero(np.append(True, line[a][1:] != line[a][:-1]))
                nth = np.arange(len(a)) - np.repeat(head, np.diff(np.append(head, len(a))))
                now = nth < tries
                x, y = a[now], b[now]
                gone[line[x[_matching(words, start[x], size[x], start[y], size[y], similarity)]]] = True
                left = ~now & ~gone[line[a]]
                a, b, tries = a[left], b[left], 2 * tries
        first = np.unique(line[gone[line]], return_index=True)[1]
        hit = np.flatnonzero(gone[line])[first]
        yield {"doc_id": doc[hit], "line": place[hit].astype(np.int32)}

    return map_arrow(dealt, rows, "doc_id long, line int")


def removed_lines(docs: DataFrame, similarity: float = 0.8, min_words: int = 1, hot: int = 20_000) -> DataFrame:
    """(doc_id, line) of every line to remove; lines count from 0.

    Lines with fewer than ``min_words`` different words are left alone; lines
    without a word always are. ``hot`` is the number of lines beyond which a
    word is keyed together with a second one. Counters and buckets follow from
    the bytes of the input: a counter for 256 bytes (2**24 counters at most;
    beyond that more words share one, which changes their order and no result),
    a bucket for 64 MB, and at least four for each shuffle partition. Null texts
    have no line, rows without a doc_id keep all of theirs, and rows that repeat
    a doc_id count as one document. An empty table gives no row.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / 64e6))
    counters = 1 << max(20, min(24, math.ceil(math.log2(max(1, total / 256)))))
    survey = materialise(_survey(docs, min_words, buckets, counters), "lines")
    sketch = spark.sparkContext.broadcast(_codes(survey.where("kind = 0"), counters))
    equal = survey.where("kind = 2").select("doc_id", "line").union(_later_equal(survey.where("kind = 1"), buckets))
    possible = materialise(_possible(_dealt(docs, sketch, None, min_words, similarity, hot, buckets), similarity), "possible")
    bits = 1 << max(17, min(29, math.ceil(math.log2(8 * max(1, possible.agg(F.sum("n")).first()[0] or 0)))))  # up to 64 MiB; beyond, more entries pass
    marks = spark.sparkContext.broadcast(_marks(possible, bits))
    near = _matched(_dealt(docs, sketch, marks, min_words, similarity, hot, buckets), similarity)
    return equal.union(near).distinct()


def dedup(docs: DataFrame, **params) -> DataFrame:
    """The documents without their removed lines; all other columns as they were, n_chars as counted anew.

    Null texts stay null, rows without a doc_id stay as they are, and rows that
    repeat a doc_id lose the same lines. An empty table gives no row. Other
    columns may have any name.
    """
    doc, lines = unused(docs, "doc"), unused(docs, "lines")
    gone = removed_lines(docs, **params).groupBy("doc_id").agg(F.collect_set("line").alias(lines)).withColumnRenamed("doc_id", doc)
    joined = docs.join(gone, docs["doc_id"].cast("long") == F.col(doc), "left")
    kept = F.filter(F.split("text", "\n", -1), lambda x, k: ~F.array_contains(lines, k))
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(lines).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
