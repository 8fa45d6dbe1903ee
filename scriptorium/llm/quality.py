"""Quality rules: repetition counts and divergence from language references.

A reference of a language is two histograms over all its documents: character
classes, and its most common words plus the rest. Both are smoothed by the
histograms of all documents, which weigh as much as ``prior`` words, so that
languages with few words lean on these without a switch. A document is kept if it
passes the repetition rules and its own two histograms lie within set
Jensen-Shannon distances of its language's; the divergence rules apply from a
minimum number of words on, below which histograms say little.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import map_arrow, materialise, text_bytes

# The classes of bytes, and the symbols that the base counts.
CLASSES = ("space", "newline", "lower", "upper", "digit", "stop", "symbol", "other", "letter2", "letter3", "tail")
SYMBOLS = b"#*$%&|<>"
STOPS = b".,;:!?'\"()-"


def _class_table() -> np.ndarray:
    at = {c: k for k, c in enumerate(CLASSES)}
    table = np.full(256, at["other"], np.uint8)
    for name, low, high in (("lower", 97, 122), ("upper", 65, 90), ("digit", 48, 57), ("space", 9, 13), ("tail", 128, 191), ("letter2", 192, 223), ("letter3", 224, 255)):
        table[low : high + 1] = at[name]
    table[32], table[10] = at["space"], at["newline"]
    table[np.frombuffer(STOPS, np.uint8)] = at["stop"]
    table[np.frombuffer(SYMBOLS, np.uint8)] = at["symbol"]
    return table


_TABLE = _class_table()


def class_counts(text: bytes) -> np.ndarray:
    """Counts of a text's characters by class (a character's later bytes are the last class)."""
    return np.bincount(_TABLE[np.frombuffer(text, np.uint8)], minlength=len(CLASSES))


def repeated_words(words: list[bytes], large: int = 20_000) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    if n <= large:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == n:
            return 0
        count = Counter(windows)
        hit = np.fromiter((count[w] > 1 for w in windows), bool, n)
    else:  # numbers for words keep a very long text small
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n + 2)
        pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
        _, which, often = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
        hit = often[which] > 1
    cover = np.zeros(n + 2, bool)
    for k in range(3):
        cover[k : k + n] |= hit
    return int(cover.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if not x.isspace() and x]
    return len(lines) - len(set(lines))


@dataclass(frozen=True)
class Reference:
    """Index of a language's common words, their distribution with the rest, and that of classes."""

    index: dict[bytes, int]
    words: np.ndarray
    classes: np.ndarray


def references(docs: DataFrame, common: int = 64, prior: float = 1000.0, max_languages: int = 4096) -> dict[str | None, Reference]:
    """A reference for each language, and that of all documents under None.

    Every document counts; those without a language count for all only. What
    reaches the driver and the executors is bounded by ``max_languages`` times
    ``common`` words; languages beyond the largest so many share that of all.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[str | None, Counter] = {}
        classes: dict[str | None, np.ndarray] = {}

        def flush() -> Iterator[dict]:
            for lang, words in held.items():
                total = classes.pop(lang)
                yield {"lang": [lang] * (len(words) + len(CLASSES)), "kind": [0] * len(words) + [1] * len(CLASSES), "term": [*words, *(c.encode() for c in CLASSES)], "n": [*words.values(), *total.tolist()]}
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                text = text.as_py()
                held.setdefault(lang, Counter()).update(text.lower().split())
                classes[lang] = classes.get(lang, 0) + class_counts(text)
                if sum(map(len, held.values())) > 400_000:
                    yield from flush()
        yield from flush()

    rows = map_arrow(docs.select("lang", text_bytes().alias("text")), count, "lang string, kind int, term binary, n long")
    counts = materialise(rows.groupBy("lang", "kind", "term").agg(F.sum("n").alias("n")), "words")
    sums = counts.where("kind = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    largest = sums.where("lang is not null").orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    sizes: dict[str | None, int] = {r["lang"]: r["n"] for r in largest} | {None: sums.agg(F.sum("n")).first()[0] or 0}
    whole = counts.groupBy("kind", "term").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "kind", "term", "n")
    own = counts.where("lang is not null").join(F.broadcast(sums.where("lang is not null").orderBy(F.desc("n"), "lang").limit(max_languages).select("lang")), "lang", "left_semi")
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "term"))
    best = whole.union(own.select("lang", "kind", "term", "n")).withColumn("rank", rank).where(f"rank <= {max(common, len(CLASSES))}").collect()
    wanted = {bytes(r["term"]) for r in best if r["kind"] == 0}
    asked = counts.sparkSession.createDataFrame([(t,) for t in sorted(wanted)], "term binary")  # common words of all languages, as bounded as they are
    overall = {bytes(r["term"]): r["n"] for r in whole.where("kind = 0").join(F.broadcast(asked), "term", "left_semi").collect()}
    classes = {(r["lang"], bytes(r["term"]).decode()): r["n"] for r in best if r["kind"] == 1}
    histogram = lambda lang: np.array([classes.get((lang, c), 0) for c in CLASSES], float)
    by_lang: dict[str | None, list] = {}
    for r in best:
        if r["kind"] == 0 and r["rank"] <= common:
            by_lang.setdefault(r["lang"], []).append(r)
    found = {}
    for lang, size in sizes.items():
        words = sorted(by_lang.get(lang, []), key=lambda r: r["rank"])
        index = {bytes(r["term"]): k for k, r in enumerate(words)}
        of_all = np.array([overall.get(t, 0) for t in index], float) / max(1, sizes[None])
        lean = prior / (size + prior)
        share = (1 - lean) * np.array([r["n"] for r in words], float) / max(1, size) + lean * of_all
        hist, total = histogram(lang), histogram(None)
        found[lang] = Reference(index, np.append(share, max(0.0, 1 - share.sum())), (1 - lean) * hist / max(1.0, hist.sum()) + lean * total / max(1.0, total.sum()))
    return found


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2, 0 to 1) of two distributions."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = lambda a: float(np.where(a > 0, a * np.log2(a / m), 0).sum())
        return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5


def assess(docs: DataFrame, min_words: int = 50, max_class_distance: float = 0.33, max_word_distance: float = 0.5, refs: dict[str | None, Reference] | None = None) -> DataFrame:
    """Counts, distances and the verdict of every document.

    Null text counts as empty: no words, which fails the base. Null or unknown
    languages are held against the reference of all documents, the empty name
    is a language like others. Repeated rows
    give repeated rows; an empty table gives none; other columns are ignored.
    """
    refs = references(docs) if refs is None else refs

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept")
        for batch in batches:
            out: dict[str, list] = {k: [] for k in names}
            for doc, lang, text in zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), batch.column("text")):
                text = text.as_py()
                words = text.split()
                n = len(words)
                hist = class_counts(text)
                chars = int(len(text) - hist[0] - hist[1] - hist[-1])
                repeat = repeated_words(words)
                failed = n < 50 or 100 * repeat > 50 * n
                by_class = by_word = None
                if n >= min_words and (ref := refs.get(lang) or refs.get(None)):
                    seen = np.zeros(len(ref.words))
                    for k, c in Counter(map(ref.index.get, text.lower().split())).items():
                        seen[-1 if k is None else k] += c
                    by_class, by_word = js_distance(hist / max(1, hist.sum()), ref.classes), js_distance(seen / n, ref.words)
                kept = not failed and (by_class is None or (by_class <= max_class_distance and by_word <= max_word_distance))
                for k, v in zip(names, (doc, n, chars, int(hist[6]), duplicate_lines(text), repeat, by_class, by_word, failed, kept)):
                    out[k].append(v)
            yield out

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double, base_failed boolean, kept boolean"
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "lang", text_bytes().alias("text")), rows, schema)
