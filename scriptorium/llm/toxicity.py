"""Toxicity scores of texts restored by noisy-channel deobfuscation.

Letters may be hidden by look-alikes (``1d10t``), spacing (``i d i o t``) and
repetition (``stuuupid``). A word becomes a lattice: each character with the
letters it may stand for, separators that may stand for nothing or a word end,
runs that may be shorter. Viterbi search over all states finds the likeliest
reading under a character trigram model of all the texts, and a logistic model
of the restored words scores the text. A word whose lattice has one path, letters
without a double, is its own reading and is not searched.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import crc_mod, keep_rows, map_arrow, materialise, text_bytes
from .hashing import different, joined, of_texts, word_hashes, word_places

# What look-alikes stand for. A character may also be a separator.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "*": "aeiou", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = " .-_*~'\"`#%&,;:/\\^=!|$"
#: Symbols of the model: 0 a word end, 1 to 26 letters, 27 any other letter's byte.
SYMBOLS = 28
_WORD_END = 0


def _symbol_table() -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[97:123] = table[65:91] = np.arange(1, 27)
    table[128:] = 27
    return table


_TABLE = _symbol_table()


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of symbol trigrams over all texts: 28 cubed of them, whatever the input."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            held, size = [], 0
            for text in [*batch.column("text"), None]:
                if text is not None:
                    held.append(text.as_py())
                    size += len(held[-1])
                if held and (text is None or size > 1 << 20):
                    s = _TABLE[np.frombuffer(b" ".join([b"", *held, b""]), np.uint8)]
                    total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
                    held, size = [], 0
        used = np.flatnonzero(total)
        yield {"k": used, "n": total[used]}

    counts = map_arrow(docs.select(text_bytes().alias("text")), rows, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(SYMBOLS**3)
    for r in counts:
        found[r["k"]] = r["n"]
    return found


def trigram_model(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of a symbol after two others, interpolated with shorter contexts."""
    c3 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + SYMBOLS)
    p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
    return np.log((c3 + 5 * p2[None]) / (c3.sum(2, keepdims=True) + 5))


def _letter(c: str) -> int:
    c = c.lower()
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else -1


class Decoder:
    """Reads stretches of characters under a trigram model, with bonuses for words of a lexicon."""

    def __init__(self, model: np.ndarray, words: list[str] = (), word_bonus: float = 4.0):
        self.model = model.tolist()
        self.bonus = word_bonus
        self.trie: dict = {}
        for w in words:
            node = self.trie
            for c in w:
                node = node.setdefault(c, {})
            node[""] = {}

    def options(self, c: str, run: int) -> list[tuple[str, float]]:
        """Readings of a run of one character with their channel log-probabilities."""
        found = []
        if _letter(c) > 0:
            c = c.lower()
            found = [(c * run, 0.0)] if run < 3 else [(c * min(run, 3), -6.0)]
            if run > 1:
                found += [(c, -1.0 if run > 2 else -4.0)]
            if run > 2:
                found += [(c * 2, -2.0)]
        for x in LOOKALIKES.get(c, ""):
            found += [(x, -1.0)] + ([(x * 2, -2.0)] if run > 1 else [])
        if c in SEPARATORS:
            found += [("", -1.0), (" ", -1.0)]
        return found or [(" ", 0.0)]

    def lattice(self, text: str) -> list[list[tuple[str, float]]]:
        """The options of each run of one character; white space is one space, and a word end closes the text."""
        runs = re.finditer(r"(.)\1*", " ".join(text.lower().split()), re.S)
        return [*(self.options(m[0][0], len(m[0])) for m in runs), [(" ", 0.0)]]

    def best(self, text: str) -> tuple[float, str]:
        """Score and outputs of the likeliest path. A state is the last two symbols and the place in the
        lexicon's trie (None: off it), which is all that later steps depend on; none is dropped."""
        states = {(0, 0, id(self.trie)): (0.0, None, self.trie)}
        for options in self.lattice(text):
            new: dict = {}
            for (a, b, _), (score, back, node) in states.items():
                for out, cost in options:
                    x, y, s, at = a, b, score + cost, node
                    for o in out:
                        k = _WORD_END if o == " " else _letter(o)
                        if k == _WORD_END and y == _WORD_END:
                            continue
                        s += self.model[x][y][k]
                        if k == _WORD_END:
                            if at is not None and "" in at:
                                s += self.bonus
                            at = self.trie
                        else:
                            at = at.get(o) if at is not None else None
                        x, y = y, k
                    key = (x, y, id(at))
                    if key not in new or s > new[key][0]:
                        new[key] = (s, (back, out), at)
            states = new
        score, back, _ = max(states.values(), key=lambda v: v[0])
        parts = []
        while back is not None:
            back, out = back
            parts.append(out)
        return score, "".join(reversed(parts))

    def read(self, text: str) -> str:
        """The likeliest reading: lower-case letters, with spaces at word ends."""
        return self.best(text)[1].strip()


#: Three or more single characters in a row, parted by spaces or separators; the whole may stand in brackets or quotes.
SPACED = re.compile(r"(?<![^\s.,(\[{<\"'`«“‘])(?<!\w[(\[{<\"'`«“‘])[a-z0-9@$!|+](?:[ .*_-]{1,3}[a-z0-9@$!|+]){2,}(?![^\s.,;:!?)\]}>\"'`»”’])(?!['’]\w)")
_EDGES = ".,;:!?\"'()[]{}<>#%&*|$~`^=_/\\-+«»¿¡"
#: Features are told apart by how often a word, or a beginning of longer words, occurs at least.
TIMES, BEGINNING = (1, 2, 4), 5


def forms(words: list[str]) -> tuple[str, ...]:
    """The words and, marked by a hyphen, the beginnings of those that are longer: inflections share these."""
    return tuple(x for w in words for x in ((w, w[:BEGINNING] + "-") if len(w) > BEGINNING else (w,)) if w)


def _bytes_of(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_WORDLIKE, _SINGLE, _GAP = _bytes_of(b"abcdefghijklmnopqrstuvwxyz0123456789"), _bytes_of(b"abcdefghijklmnopqrstuvwxyz0123456789@$!|+"), _bytes_of(b" .*_-")


def may_be_spaced(text: np.ndarray) -> np.ndarray:
    """Places of a lower-case byte array (with 8 bytes to spare) where the first three characters of a match of
    ``SPACED`` may begin: every match begins at one of them. For each, the edges are looked at loosely."""
    n = len(text) - 8
    one, gap, word = _SINGLE[text], _GAP[text], _WORDLIKE[text]
    step = {2: gap[1 : n + 1] & one[2 : n + 2], 3: gap[1 : n + 1] & gap[2 : n + 2] & one[3 : n + 3], 4: gap[1 : n + 1] & gap[2 : n + 2] & gap[3 : n + 3] & one[4 : n + 4]}
    ends = np.zeros(n + 8, bool)  # a single character from which a step leads on
    ends[:n] = one[:n] & (step[2] | step[3] | step[4])
    first = one[:n] & ~np.append(False, word[: n - 1])[:n]
    found = np.zeros(n, bool)
    for d, ok in step.items():
        found |= ok & ends[d : n + d]
    return np.flatnonzero(first & found)


def needs_reading(word: str) -> str:
    """The part of a lower-case word whose lattice has more than one path, or empty if it reads as it is.
    Signs at its edges are read only where they may be letters."""
    core = word.strip(_EDGES)
    if not core:
        return ""
    at = word.find(core)
    before, after = word[:at][-2:], word[at + len(core) :]
    lead = re.search(r"[$!|+(]{1,2}$", before)
    tail = after if re.fullmatch(r"[$|]{1,2}", after) else ""
    part = (lead[0] if lead else "") + core + tail
    return "" if part.isalpha() and not _DOUBLE.search(part) else part


_DOUBLE = re.compile(r"(.)\1+")


def _collapsed(word: str) -> str:
    """The word with each run of a letter as one."""
    return _DOUBLE.sub(r"\1", word)


class _Readings(dict):
    """The forms of a word's restored words that are of use; words are kept up to a bound.

    All readings of a word of letters collapse to the same. Where no useful form
    does, nor begins it, none of them is of use, and the word is not searched.
    """

    def __init__(self, decoder: Decoder, useful: frozenset[str] | None, kept: int = 100_000):
        self.decoder, self.useful, self.kept = decoder, useful, kept
        self.whole = frozenset(_collapsed(f) for f in useful or () if not f.endswith("-"))
        self.begun = frozenset(_collapsed(f[:-1]) for f in useful or () if f.endswith("-"))

    def _may_be_useful(self, part: str) -> bool:
        if self.useful is None or not part.isalpha():
            return True
        part = _collapsed(part)
        return part in self.whole or any(part[:k] in self.begun for k in range(1, BEGINNING + 1))

    def __missing__(self, word: str) -> tuple[str, ...] | None:
        part = needs_reading(word)
        if part and not self._may_be_useful(part):
            if len(self) >= self.kept:
                self.clear()
            self[word] = None
            return None
        words = forms(self.decoder.read(part).split() if part else [word.strip(_EDGES)])
        words = tuple(w for w in words if self.useful is None or w in self.useful)
        if len(self) >= self.kept:
            self.clear()
        self[word] = found = words or None
        return found


class Features:
    """Which features a text has. A feature is (form, times), numbered; with no index, all that occur."""

    def __init__(self, decoder: Decoder, index: dict[tuple[str, int], int] | None):
        self.index, self.decoder = index, decoder
        self.words = _Readings(decoder, None if index is None else frozenset(s for s, _ in index))

    def counts(self, text: str) -> Counter:
        text = text.lower()
        found: Counter = Counter()
        for words, n in Counter(map(self.words.__getitem__, text.split())).items():
            for s in words or ():
                found[s] += n
        for m in SPACED.finditer(text):
            found.update(forms(self.decoder.read(m[0]).split()))
        return found

    def of(self, text: str) -> set[int]:
        return self._numbered(self.counts(text))

    def _numbered(self, counts: Counter) -> set[int]:
        has = self.index.get
        return {k for s, n in counts.items() for t in TIMES if n >= t and (k := has((s, t))) is not None}

    def of_texts(self, texts: list[str]) -> list[set[int]]:
        """The features of each text, as ``of`` gives them: words are read once for all texts."""
        lower = [t.lower() for t in texts]
        data = [t.encode("utf-8", "replace") for t in lower]
        text = joined(data, lower=False)
        starts, ends = word_places(text)
        cuts = of_texts(starts, data)
        owner = np.repeat(np.arange(len(texts)), np.diff(cuts))
        first, which = different(word_hashes(text, starts, ends))
        whole = text.tobytes()
        words = [self._of_word(whole[a:b].decode()) for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        useful = np.fromiter((x is not None for x in words), bool, len(words))
        counts: dict[int, Counter] = {}
        hit = np.flatnonzero(useful[which])
        for doc, word in zip(owner[hit].tolist(), which[hit].tolist()):
            counts.setdefault(doc, Counter()).update(words[word])
        begin = np.cumsum([0] + [len(t) + 1 for t in data])
        for doc in np.unique(np.searchsorted(begin, may_be_spaced(text), side="right") - 1).tolist():
            for m in SPACED.finditer(lower[doc]):
                counts.setdefault(doc, Counter()).update(forms(self.decoder.read(m[0]).split()))
        return [self._numbered(counts[k]) if k in counts else set() for k in range(len(texts))]

    def _of_word(self, word: str) -> tuple[str, ...] | None:
        """Readings of a word without ASCII white space; it may hold other white space."""
        parts = word.split()
        if len(parts) == 1:
            return self.words[parts[0]]
        return tuple(x for p in parts for x in self.words[p] or ()) or None


@dataclass(frozen=True)
class Model:
    trigrams: np.ndarray
    words: tuple[tuple[str, int], ...]
    weights: np.ndarray  # the last is the intercept

    def features(self) -> Features:
        """Words that speak for toxicity are a lexicon that readings are drawn to."""
        lexicon = [s for (s, t), x in zip(self.words, self.weights) if t == 1 and x > 1 and s.isascii() and s.isalpha() and len(s) > 3]
        return Features(Decoder(self.trigrams, lexicon), {f: k for k, f in enumerate(self.words)})

    def score(self, features: set[int]) -> float:
        z = self.weights[-1] + sum(self.weights[k] for k in features)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _scored(batches: Iterator[pa.RecordBatch], features: Features, most: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list[set[int]]]]:
    """Parts of batches with the features of their texts."""
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        at = 0
        for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // most)) + 1):
            if len(part):
                yield batch.slice(at, len(part)), features.of_texts(texts[at : at + len(part)])
                at += len(part)


def fit_logistic(x: list[np.ndarray], y: np.ndarray, n: int, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the intercept is last and not penalised.

    ``x`` has the numbers of each row's features. A step is found by conjugate
    gradients, so nothing is made that is larger than the features that occur."""
    size = np.array([len(f) + 1 for f in x], np.int64)
    flat = np.concatenate([np.append(f, n) for f in x]).astype(np.int64) if x else np.zeros(0, np.int64)
    start = np.cumsum(size) - size
    penalty = np.full(n + 1, ridge)
    penalty[n] = 1e-6
    times = lambda w: np.add.reduceat(w[flat], start) if len(start) else np.zeros(0)
    back = lambda v: np.bincount(flat, np.repeat(v, size), n + 1)
    w = np.zeros(n + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        curve, left = p * (1 - p), back(y - p) - penalty * w
        step, way, norm = np.zeros(n + 1), left.copy(), left @ left
        least = 1e-18 * norm
        for _ in range(10 * (n + 1)):
            if norm <= least:
                break
            bent = back(curve * times(way)) + penalty * way
            by = norm / (way @ bent)
            step += by * way
            left -= by * bent
            norm, before = left @ left, norm
            way = left + norm / before * way
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, least_ratio: float = 15.0) -> Model:
    """Learn from labelled rows whose crc32(doc_id) mod 5 is not 0.

    The classifier is fitted on at most ``sample`` such rows (the first by a
    hash of the id; they are marked by a broadcast of ids, bounded by that
    number). Its features are forms that occur a number of times: all those
    whose likelihood ratio of the classes is ``least_ratio`` or more in that
    sample, so the sample bounds them too. The trigram model counts all texts.
    With no labelled row or one class only, the score is the labels' rate, or 0
    without labels. Null labels and ids are left out, null texts are empty.
    """
    trigrams = trigram_model(trigram_counts(docs))
    rows = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where((crc_mod("doc_id", 5) != 0) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    texts = materialise(texts, "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        features = Features(Decoder(trigrams), None)
        by: tuple[Counter, Counter] = Counter(), Counter()
        n = [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                by[toxic].update((s, t) for s, c in features.counts(text.as_py()).items() for t in TIMES if c >= t)
                n[toxic] += 1
        for toxic in (0, 1):
            keys, values = [*by[toxic], (None, 0)], [*by[toxic].values(), n[toxic]]
            yield {"word": [s for s, _ in keys], "times": [t for _, t in keys], "toxic": [toxic] * len(keys), "n": values}

    counts = map_arrow(texts, count, "word string, times int, toxic int, n long")
    pairs = materialise(counts.groupBy("word", "times").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c")), "forms")
    total = pairs.where("word is null").first()
    t, c = (total["t"], total["c"]) if total else (0, 0)
    if not t or not c:
        return Model(trigrams, (), np.array([math.log((t + 1e-9) / (c + 1e-9)) if t + c else -30.0]))
    part = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    x, y = F.col("t").cast("double"), F.col("c").cast("double")
    both, rate = x + y, t / (t + c)
    ratio = part(x, both * rate) + part(y, both * (1 - rate)) + part(t - x, (t + c - both) * rate) + part(c - y, (t + c - both) * (1 - rate))
    telling = pairs.where("word is not null and length(word) > 1").withColumn("ratio", ratio).where(F.col("ratio") >= least_ratio)
    best = telling.orderBy(F.desc("ratio"), "word", "times").collect()
    words = tuple((r["word"], r["times"]) for r in best)
    plain = Model(trigrams, words, np.array([2.0 if r["t"] * c > r["c"] * t else 0.0 for r in best] + [0.0]))
    sent = docs.sparkSession.sparkContext.broadcast(plain)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, found in _scored(batches, sent.value.features()):
            yield {"toxic": batch.column("toxic"), "f": [sorted(f) for f in found]}

    got = map_arrow(texts, featured, "toxic int, f array<int>").collect()
    weights = fit_logistic([np.array(r["f"], np.int32) for r in got], np.array([r["toxic"] for r in got], float), len(words))
    return Model(trigrams, words, weights)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    Null and empty texts get the score of a text without features. Repeated
    rows stay; an empty table gives no row; other columns are never inputs.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, found in _scored(batches, sent.value.features()):
            s = [sent.value.score(f) for f in found]
            yield {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": s, "predicted": [int(x >= 0.5) for x in s]}

    return map_arrow(docs.select(F.col("doc_id").cast("long"), (crc_mod("doc_id", 5) == 0).alias("held_out"), F.coalesce("text", F.lit("")).alias("text")), rows, "doc_id long, held_out boolean, score double, predicted int")


def reject(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents that score under ``threshold``, all columns as they were.

    Null and empty texts score as texts without features; repeated rows go or
    stay together; an empty table gives no row.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _scored(batches, sent.value.features()):
            yield batch.filter(pa.array([sent.value.score(f) < threshold for f in found], pa.bool_()))

    return keep_rows(docs, keep)
