"""Tokenise documents and pack them into fixed-length sequences by vector best-fit.

Every document becomes token ids followed by one end id. Only documents longer
than a sequence are cut. A whole-length piece is a sequence of its own; the
others are dealt evenly into blocks of a bounded number of pieces, and each
block is packed alone, longest piece first. A bin has residual tokens,
documents and attention cost (the sum of squared lengths); of the bins that can
take a piece under all three, the one with the smallest weighted residual norm
(or the largest weighted dot product) takes it. A block wastes at most one part
filled sequence, so the block size bounds what dealing loses.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow, materialise, text_bytes, unused
from .hashing import different, joined, of_texts, ranges, word_hashes, word_places

#: Words whose ids a worker keeps; beyond that it keeps those of the texts at hand, which costs time and no result.
CACHED_WORDS = 500_000

#: Tokenizers of this normaliser and these splits cut where two ASCII characters differ in kind, and never join across.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLITS = {
    "type": "Split", "behavior": "Removed", "invert": True,
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
}
_LETTER, _DIGIT, _SIGN, _QUOTE, _HIGH = range(1, 6)  # kinds of bytes; 0: white space
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[39], _KIND[128:] = _DIGIT, _LETTER, _LETTER, _QUOTE, _HIGH
_CUT = np.zeros((8, 8), bool)  # by the kinds of a byte and the next
_CUT[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = _CUT[_SIGN, [_LETTER, _DIGIT]] = _CUT[_DIGIT, [_LETTER, _DIGIT, _SIGN, _QUOTE]] = True
_BEGINS, _ENDS = _CUT.copy(), _CUT.copy()
_BEGINS[0, 1:6] = _ENDS[1:6, 0] = True


def piece_places(text: np.ndarray, whole: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of joined texts' words. An apostrophe stays with what follows, a byte
    outside ASCII with both sides, each of the texts ``whole`` in one piece."""
    kind = _KIND[text[:-8]]
    pair = (kind[:-1] << 3) | kind[1:]
    begins, ends = np.append(kind[0] > 0, _BEGINS.ravel()[pair]), np.append(_ENDS.ravel()[pair], False)
    data = text.tobytes()
    for content in whole:
        for m in re.finditer(re.escape(content), data) if content in data else ():
            begins[m.start() + 1 : m.end()] = ends[m.start() : m.end() - 1] = False
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class WordIds:
    """32-bit ids of texts, as the tokenizer gives them for their pieces in order.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words. Tokenizers that are known to cut within words as
    well are asked for the pieces, in lower case where these are ASCII. Pieces
    are known by 64 bits of a hash, kept in order beside their ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        cut = spec["pre_tokenizer"] or {}
        self.cuts = spec["normalizer"] == _NORMALIZER and (cut.get("pretokenizers") or [None])[0] == _SPLITS and [c["type"] for c in cut["pretokenizers"]] == ["Split", "ByteLevel"]
        self.whole = [x["content"].encode() for x in spec["added_tokens"]]
        self.keys, self.begin, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _places(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts as they are looked up, and where their pieces start and end."""
        if not self.cuts:
            return text, *word_places(text)
        starts, ends = piece_places(text, self.whole)
        low = text.copy()
        low[(text >= 65) & (text <= 90)] += 32
        high = np.flatnonzero(text >= 128)
        mixed = np.unique(np.searchsorted(starts, high, side="right") - 1) if len(high) else high
        as_is = ranges(starts[mixed], (ends - starts)[mixed])
        low[as_is] = text[as_is]
        return low, starts, ends

    def _keep(self, which: np.ndarray) -> None:
        self.flat = self.flat[ranges(self.begin[which], self.size[which])]
        self.keys, self.size = self.keys[which], self.size[which]
        self.begin = np.cumsum(self.size) - self.size

    def _learn(self, keys: np.ndarray, words: Iterator[bytes]) -> None:
        """Add the ids of words to those kept; ``keys`` are in order."""
        sizes, parts = [], [self.flat]
        while texts := [w.decode("utf-8", "replace") for w in islice(words, 4096)]:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            sizes += map(len, found)
            parts.append(np.fromiter(chain.from_iterable(found), "<u4"))
        size, at = np.array(sizes, np.int64), np.searchsorted(self.keys, keys)
        begin = len(self.flat) + np.cumsum(size) - size
        self.keys, self.begin, self.size = np.insert(self.keys, at, keys), np.insert(self.begin, at, begin), np.insert(self.size, at, size)
        self.flat = np.concatenate(parts)

    def of_texts(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text. Pieces are looked up once for all texts and dealt out by number."""
        text, starts, ends = self._places(joined(texts, lower=False))
        h = word_hashes(text, starts, ends)
        first, which = different(h)
        keys = h[first]  # in order
        at = np.searchsorted(self.keys, keys)
        known = np.append(self.keys, np.uint64(0))[at] == keys
        known &= at < len(self.keys)
        if len(self.keys) + np.count_nonzero(~known) > CACHED_WORDS:
            self._keep(at[known])
        new, data = first[~known], text.tobytes()
        if len(new):
            self._learn(keys[~known], (data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())))
        at = np.searchsorted(self.keys, keys)
        begin, size, cuts = self.begin[at], self.size[at], of_texts(starts, texts)
        for a, b in zip(cuts, cuts[1:]):
            own = which[a:b]
            yield self.flat[ranges(begin[own], size[own])].tobytes()


_WORDS: dict[str, WordIds] = {}


def word_ids(name: str) -> WordIds:
    """The worker's word cache for a tokenizer: a path, or a file name of the public set."""
    if name not in _WORDS:
        path = name
        if not os.path.isabs(name):
            import public_tokenizers

            path = public_tokenizers.path(name)
        _WORDS[name] = WordIds(path)
    return _WORDS[name]


def _chunks(batches: Iterator[pa.RecordBatch], most: int = 2_000_000) -> Iterator[tuple[list[int], list[bytes]]]:
    docs, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            docs.append(doc)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= most:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def tokenise(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every document.

    Null text counts as empty and gives the end id alone; an empty table gives
    no row. Repeated rows give repeated pieces. Other columns are ignored. The
    tokenizer must drop white space (a word-level cache relies on that).
    """
    end = np.array([end_id], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words = word_ids(tokenizer)
        for docs_, texts in _chunks(batches):
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc, ids in zip(docs_, words.of_texts(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), capacity * 4)):
                    part = ids[at : at + capacity * 4]
                    out["doc_id"].append(doc)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(part)
            yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return map_arrow(docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")), rows, schema)


def best_fit(lengths: np.ndarray, capacity: int, max_documents: int, max_attention: int, weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece; pieces are taken longest first, ties in input order.

    An item that alone breaks a limit gets a bin of its own.
    """
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    caps = np.array([capacity, max_documents, max_attention], float)
    scale = np.array(weights) / caps
    left = np.zeros((3, 1024))
    used, low = 0, 0  # bins before low are full
    for k in np.argsort(-lengths, kind="stable"):
        item = np.array([lengths[k], 1.0, float(lengths[k]) ** 2])
        space = left[:, low:used]
        fits = np.flatnonzero((space[0] >= item[0]) & (space[1] >= 1.0) & (space[2] >= item[2]))
        if len(fits):
            rest = space[:, fits]
            if rule == "norm":
                gap = (rest - item[:, None]) * scale[:, None]
                best = low + fits[np.argmin((gap * gap).sum(0))]
            else:
                best = low + fits[np.argmax(((scale / caps) * item) @ rest)]
        else:
            best = used
            used += 1
            if used > left.shape[1]:
                left = np.concatenate([left, np.zeros_like(left)], axis=1)
            left[:, best] = caps
        bins[k], offsets[k] = best, capacity - left[0, best]
        left[:, best] -= item
        while low < used and left[0, low] < 1:
            low += 1
    return bins, offsets


def pack(
    pieces: DataFrame,
    capacity: int = 2048,
    max_documents: int = 256,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02),
    rule: str = "norm",
    block: int = 8192,
) -> DataFrame:
    """Add sequence_id and offset to pieces that have a ``length``.

    A sequence has at most ``capacity`` tokens, ``max_documents`` pieces and an
    attention cost (sum of squared lengths) of ``max_attention``, by default
    that of one whole piece. ``rule`` is "norm" or "dot". The pieces are dealt
    evenly to as many tasks as the session shuffles to, fewer if they are few,
    and packed in blocks of ``block`` to twice as many. Repeated rows are
    packed each by itself; an empty table gives no row; other columns stay as
    they are, whatever their names.
    """
    max_attention = max_attention or capacity * capacity
    names = pieces.columns
    added = [unused(pieces, "sequence_id"), unused(pieces, "offset")]
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(tasks, pieces.count() // block))

    def packed(table: pa.Table, first: int) -> tuple[dict, int]:
        length = table.column("length").to_numpy()
        bins, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        short = np.flatnonzero(length < capacity)
        bins[short], offsets[short] = best_fit(length[short], capacity, max_documents, max_attention, weights, rule)
        full = np.flatnonzero(length >= capacity)
        used = int(bins[short].max()) + 1 if len(short) else 0
        bins[full] = used + np.arange(len(full))
        return {k: table.column(k).combine_chunks() for k in names} | {added[0]: first + bins, added[1]: offsets}, used + len(full)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= 2 * block:
                table = pa.Table.from_batches(held)
                out, used = packed(table.slice(0, block), first)
                yield out
                first, held, size = first + used, table.slice(block).to_batches(), size - block
        if size:
            yield packed(pa.Table.from_batches(held), first)[0]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + f", {added[0]} long, {added[1]} long"
    return map_arrow(pieces.repartition(n), rows, schema)


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = 2048, **limits) -> DataFrame:
    """``tokenise`` then ``pack``; the pieces are written once, for their count and for dealing."""
    return pack(materialise(tokenise(docs, tokenizer, capacity), "pieces"), capacity, **limits)
