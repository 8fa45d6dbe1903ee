"""Benchmark decontamination by pigeonhole edit matching.

An item within k edits of a passage leaves one of its k + 1 pieces unedited, so
an exact hit of a piece (Aho-Corasick over all pieces) is a necessary sign. As
there are fewer edits than pieces, some unedited piece even has, around the ring
of pieces, at most l - 1 edits in every l pieces from it on; so a hit counts only
if the piece behind it follows with one edit or none (the last piece's hits all
count). The text around is then verified with Myers' bit-parallel distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import keep_rows, map_arrow


def normalise(text: str | None) -> str:
    """Lower case, each run of white space one space."""
    return " ".join((text or "").lower().split())


def error_budget(length: int, rate: float = 0.1, piece: int = 9) -> int:
    """Edits allowed for an item: ``rate`` of its length, and fewer if pieces would be shorter than ``piece``
    (at a tenth that is below 90 characters; under 18 an item must occur as it is)."""
    return max(0, min(int(length * rate), length // piece - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """The item cut into k + 1 parts of nearly equal length, with their offsets."""
    cuts = [len(item) * j // (k + 1) for j in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for k, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << k
    return masks


def myers(masks: dict[str, int], m: int, text: str, most: int) -> int:
    """Least edit distance of a pattern of m characters to any part of ``text``; over ``most``: most + 1.

    Myers' bit-parallel recurrence over one machine-independent integer.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
    return min(best, most + 1)


def _stands_alone(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit goes on at either end, where the part has one itself."""
    left = start > 0 and text[start - 1].isalnum() and text[start].isalnum()
    return not left and not (end < len(text) and text[end].isalnum() and text[end - 1].isalnum())


def follows(piece: str, text: str, at: int) -> bool:
    """Whether ``text`` goes on at ``at`` with the piece, one edit allowed."""
    n = len(piece)
    part = text[at : at + n + 1]
    if part.startswith(piece):
        return True
    same = 0
    while same < len(part) and same < n and part[same] == piece[same]:
        same += 1
    rest = piece[same + 1 :]  # a letter changed, left out, or put in
    return part[same + 1 : same + 1 + len(rest)] == rest or part[same : same + len(rest)] == rest or part[same + 1 : n + 1] == piece[same:]


def find_items(text: str, items: list[tuple[int, str, int, dict[str, int]]], hits) -> dict[int, int]:
    """Least distance by item for the items within budget in a normalised text."""
    best: dict[int, int] = {}
    tried: set[tuple[int, int]] = set()
    for end, found in hits(text):
        for which, offset, length, behind in found:
            at = end - length + 1 - offset
            if best.get(which) == 0 or (which, at) in tried or behind and not follows(behind, text, end + 1):
                continue
            tried.add((which, at))
            item, pattern, k, masks = items[which]
            if text.startswith(pattern, max(0, at)) and at >= 0:
                if k or _stands_alone(text, at, at + len(pattern)):
                    best[which] = 0
                continue
            if not k:
                continue
            d = myers(masks, len(pattern), text[max(0, at - k) : at + len(pattern) + k], k)
            if d <= k and d < best.get(which, k + 1):
                best[which] = d
    return best


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, normalised text) in blocks of about ``block_chars`` characters; one block at least."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else rows
        found = {(r["item_id"], normalise(r["text"])) for r in part.collect()}
        found = {(i, p) for i, p in found if any(c.isalnum() for c in p)}
        yield sorted(found, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, piece: int = 9, block_chars: int = 16_000_000) -> DataFrame:
    """(doc_id, item_ids, distances): one row per document, arrays in order of item_id.

    Null texts count as empty. Items without a letter or digit match nothing;
    items too short for an edit match where they stand as whole words. Items
    with equal normalised texts all match; repeated rows stay, each with its
    own matches; an empty table gives no row. The items are sent to the
    executors in blocks of about ``block_chars`` characters, a pass over the
    documents each, so that what is sent stays bounded however many items there
    are.
    """
    found = docs.select(F.col("doc_id").cast("long"), "text", F.array().cast("array<long>").alias("item_ids"), F.array().cast("array<int>").alias("distances"))
    for items in _blocks(benchmark, block_chars):
        found = _add_matches(found, items, rate, piece)
    pairs = F.array_sort(F.arrays_zip("item_ids", "distances"), lambda x, y: F.when(x["item_ids"].isNull(), 1).when(y["item_ids"].isNull(), -1).when(x["item_ids"] < y["item_ids"], -1).when(x["item_ids"] > y["item_ids"], 1).otherwise(x["distances"] - y["distances"]))
    return found.select("doc_id", pairs.alias("p")).select("doc_id", F.col("p.item_ids").alias("item_ids"), F.col("p.distances").alias("distances"))


class _Matcher:
    """Built on an executor from the items sent to it."""

    def __init__(self, items: list[tuple[int, str]], rate: float, piece: int):
        import ahocorasick

        self.known = [(i, p, k := error_budget(len(p), rate, piece), pattern_masks(p)) for i, p in items]
        places: dict[str, list] = {}
        for which, (_, p, k, _) in enumerate(self.known):
            parts = pieces(p, k)
            for (offset, part), (_, behind) in zip(parts, [*parts[1:], (0, "")]):
                places.setdefault(part, []).append((which, offset, len(part), behind))
        automaton = ahocorasick.Automaton()
        for part, where in places.items():
            automaton.add_word(part, where)
        automaton.make_automaton()
        self.hits = automaton.iter if places else lambda text: ()

    def __call__(self, text: str | None) -> dict[int, int]:
        return find_items(normalise(text), self.known, self.hits)


def _add_matches(found: DataFrame, items: list[tuple[int, str]], rate: float, piece: int) -> DataFrame:
    sent = found.sparkSession.sparkContext.broadcast(items)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        match = _Matcher(sent.value, rate, piece)
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch.column("doc_id").to_pylist(), "text": batch.column("text"), "item_ids": batch.column("item_ids").to_pylist(), "distances": batch.column("distances").to_pylist()}
            for text, ids, distances in zip(batch.column("text"), out["item_ids"], out["distances"]):
                best = match(text.as_py())
                order = sorted(best)
                ids += [match.known[w][0] for w in order]
                distances += [best[w] for w in order]
            yield out

    return map_arrow(found, rows, "doc_id long, text string, item_ids array<long>, distances array<int>")


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, piece: int = 9, block_chars: int = 16_000_000) -> DataFrame:
    """The documents that hold no item, all columns as they were; no join and no shuffle.

    Null and empty texts hold none; repeated rows go or stay together; an empty
    table gives no row, and an empty benchmark drops none.
    """
    for items in _blocks(benchmark, block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            match = _Matcher(sent.value, rate, piece)
            for batch in batches:
                yield batch.filter(pa.array([not match(t.as_py()) for t in batch.column("text")], pa.bool_()))

        docs = keep_rows(docs, keep)
    return docs
