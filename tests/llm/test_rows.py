"""Operators on single documents: exact round trips, brute force, held-out accuracy."""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.llm import chat, licenses, lm, packing, pii, quality, toxicity

# ---------------------------------------------------------------- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def slow_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m[0])]


PII_TEXTS = [
    "a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 256.1.1.1 00001.2.3.255", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (555) 123-4567, +12", "é 😀 a@b.co é +49 30 1234567",
    "..@a.b", "a@b-.c-", "12345678901234567", "+1-4111111111111111", "1.1.1.1@2.2.2.2", "%%%@x.y%z@w.v", "0000000000000000000000", "a" * 20_000 + "@b.c", "1." * 5000, "a@" + "b." * 5000 + "c",
]


def test_base_spans(spark, odd):
    r = random.Random(2)
    alphabet = ["a", "@", ".", "1", "255", "+", " ", "-", "(", "é", "4111111111111111", "x@y.z", "1.2.3.4", "+1 23456789"]
    texts = PII_TEXTS + ["".join(r.choices(alphabet, k=r.randint(1, 25))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {x["doc_id"]: x for x in pii.digest(pii.find(df)).collect()}
    for k, t in enumerate(texts):
        want = slow_spans(t)
        got = rows[k]
        assert [s for s in got["spans"].split(",") if s and not s.startswith(("generalise", "remove"))] == want
        assert got["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[f"n_{kind}"] for kind in PATTERNS] == [sum(s.startswith(kind) for s in want) for kind in PATTERNS]


def test_tables_of_numbers_take_linear_time(spark):
    """A text of 200,000 numbers, one of 60,000 addresses and one of 20,000 cards; by quadratic sums these would take hours."""
    texts = [" ".join(str(10 + k % 90) for k in range(200_000)), " ".join(f"a{k}@b.c" for k in range(60_000)), "; ".join("4111 1111 1111 1111" for _ in range(20_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.digest(pii.find(df)).collect():
        want = slow_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest() and len(want) == (0, 60_000, 20_000)[r["doc_id"]]


def slow_disclosures(texts, support=3, generalise_at=0.8):
    """(entity, term): disclosure, and documents by term and by prefix, of different texts."""
    held, words = [], []
    for t in dict.fromkeys(texts):
        held.append({f"{s.split(':')[0]}:{t[int(s.split(':')[1]) : int(s.split(':')[2])].lower()}" for s in slow_spans(t)})
        words.append({w for w in re.findall(r"[^\W\d_]{4,}", re.sub(PATTERNS["email"], " ", t).lower())})
    n = len(held)
    n_entity, n_term, n_both = Counter(e for h in held for e in h), Counter(w for x in words for w in x), Counter((e, w) for h, x in zip(held, words) for e in h for w in x)
    found = {}
    for (e, w), both in n_both.items():
        if both >= support and n_entity[e] >= support and n_entity[e] < n:
            d = math.log2(both * n / (n_entity[e] * n_term[w])) / math.log2(n / n_entity[e])
            if d >= generalise_at:
                found[e, w] = d, both, n_entity[e], n
    return found, n_term


def test_disclosures_against_brute_force(spark):
    r = random.Random(6)
    names = ["zorblax", "zorbing", "quinta", "marvelo", "merlin", "zorb"]
    texts = []
    for k in range(300):
        words = r.choices(["meet", "today", "about", "number", "with", "someone", "zorbing", "marvel", "merchant"], k=8)
        if k % 6 == 0:
            who = r.randrange(4)
            words.insert(3, f"p{who}@mail.org")
            words.insert(r.randrange(len(words)), names[who] if r.random() < 0.9 else "other")
            if who == 0:
                words.append("call +49 30 1234567")
        elif k % 50 == 1:
            words.append(names[r.randrange(4)].upper())
        texts.append(" ".join(words))
    texts += texts[:3]
    df = spark.createDataFrame([(k if k < 300 else k - 300, t) for k, t in enumerate(texts)], "doc_id long, text string")
    want, n_term = slow_disclosures(texts)
    scanned, terms = pii.scan(df), pii._terms(df)
    risky = pii.disclosures(terms, scanned)
    got = {(x["entity"], x["term"]): x["disclosure"] for x in risky.collect()}
    assert got.keys() == want.keys() and got and all(abs(got[k] - want[k][0]) < 1e-9 for k in got)
    todo = {x["term"]: (x["action"], x["general"]) for x in pii.actions(terms, risky).collect()}
    for term in {w for _, w in want}:
        worst = max(d for (_, w), (d, *_) in want.items() if w == term)
        general = None
        for size in range(len(term) - 1, 0, -1):
            under = sum(c for w, c in n_term.items() if w.startswith(term[:size]))
            if all(math.log2(both * n / (ne * under)) / math.log2(n / ne) < 0.8 for (_, w), (_, both, ne, n) in want.items() if w == term):
                general = term[:size]
                break
        assert todo[term] == (("remove", None) if worst >= 0.95 or not general else ("generalise", general))
    assert {a for a, _ in todo.values()} == {"remove", "generalise"}
    rows = pii.find(df).collect()
    assert len(rows) == len(texts)
    by_id = {k if k < 300 else k - 300: t for k, t in enumerate(texts)}
    for x in rows:
        t = by_id[x["doc_id"]]
        spans = [tuple(map(int, s.split(":")[1:])) for s in slow_spans(t) if s.startswith("email")]
        hits = [m for m in re.finditer(r"[^\W\d_]+", t) if m[0].lower() in todo and not any(a < m.end() and m.start() < b for a, b in spans)]
        assert [(m.start(), m.end(), *todo[m[0].lower()]) for m in hits] == [tuple(s) for s in x["terms"]]


def test_terms_go_wherever_they_occur(spark):
    telling = [(k, f"meet Zorblax about it at joe@mail.org today number {k} " + "number with someone " * 30 + "about today ZORBLAX!") for k in range(4)]
    other = [(10 + k, f"meet today about number {k} with someone or other") for k in range(60)]
    df = spark.createDataFrame(telling + other + [telling[1]] * 2, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(df).collect()}
    text = telling[0][1]
    assert [text[t["start"] : t["end"]] for t in found[0]["terms"]] == ["Zorblax", "ZORBLAX"]
    assert all(not found[k]["terms"] for k in range(10, 70))
    spans = {r["doc_id"]: r["spans"].split(",") for r in pii.digest(pii.find(df)).collect()}
    assert spans[0] == ["email:25:37", "remove:5:12", f"remove:{len(text) - 8}:{len(text) - 1}"]
    rows = pii.sanitise(df).collect()
    assert len(rows) == 66  # repeated rows stay, once each
    clean = {r["doc_id"]: r["text"] for r in rows}
    assert clean[0] == "meet  about it at [EMAIL] today number 0 " + "number with someone " * 30 + "about today !" and clean[10] == other[0][1]


def test_pii_odd_rows(spark, odd, empty):
    assert pii.digest(pii.find(odd)).count() == odd.count() and pii.find(empty).count() == 0
    assert pii.sanitise(odd).count() == odd.count() and pii.sanitise(empty).count() == 0


# ---------------------------------------------------------------- chat

CONTROL = st.text(st.sampled_from(list("<|>\\im_startend\n ab:é")), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(CONTROL, CONTROL), max_size=6))
def test_chat_round_trip(turns):
    assert chat.read_back("".join(chat.render(r, t)[0] for r, t in turns)) == turns
    for r, t in turns:
        body, a, b = chat.render(r, t)
        assert chat.unescape(body[a:b]) == (t if r == "assistant" else "")
        assert body.count(chat.START) == 1 and body.count("<|im_end|>") == 1


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, [("user", "a"), ("assistant", "b")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
    ({"prompt": "a", "completion": None}, [("user", "a"), ("assistant", "")]),
    ({"instruction": "do", "input": "", "output": "b"}, [("user", "do"), ("assistant", "b")]),
    ({"instruction": "do", "input": "x", "output": "b"}, [("user", "do\n\nx"), ("assistant", "b")]),
    ({"system": "s", "prompt": "a", "response": "b"}, [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ({"question": "a", "answer": 3}, [("user", "a"), ("assistant", "3")]),
]


def test_layouts(spark):
    rows = [(k, 0, json.dumps(x)) for k, (x, _) in enumerate(LAYOUTS)]
    got = chat.format_turns(spark.createDataFrame(rows, "conv_id long, seq long, record string")).collect()
    for k, (_, want) in enumerate(LAYOUTS):
        assert [chat.read_back(r["formatted"])[0] for r in sorted((r for r in got if r["conv_id"] == k), key=lambda r: r["part"])] == want


UNTIDY = [
    ('{"messages": []}', [], None),
    ('{"messages": null}', [], None),
    ('{"messages": [{"role": "user", "content": "a", "name": "x"}], "id": 7}', [("user", "a")], None),
    ('{"id": 1, "prompt": "a", "response": "b", "meta": {"k": [1, 2]}}', [("user", "a"), ("assistant", "b")], None),
    ('{"role": "gpt", "text": "a"}', [("gpt", "a")], None),
    ('{"messages": [{"role": "user", "content": "a"}, "b"]}', [], "broken record: ValueError"),
    ('{"prompt": "\\ud800", "response": ""}', [("user", "?"), ("assistant", "")], None),
    ('{"odd": {"x": 1}}', [], "no mapping for fields odd, odd.x"),
    ("[1, 2]", [], "no mapping for fields "),
    ("{", [], "broken record: JSONDecodeError"),
    ("[" * 100_000, [], "broken record: RecursionError"),
    (None, [], "null record"),
    ("", [], "broken record: JSONDecodeError"),
]


def test_untidy_records_have_defined_rows(spark):
    df = spark.createDataFrame([(k, 0, x) for k, (x, _, _) in enumerate(UNTIDY)], "conv_id long, seq long, record string")
    formatted = chat.format_turns(df)
    got = formatted.collect()
    for k, (_, turns, error) in enumerate(UNTIDY):
        own = sorted((r for r in got if r["conv_id"] == k), key=lambda r: r["part"])
        assert [t for r in own for t in chat.read_back(r["formatted"])] == turns and {r["error"] for r in own} == {error}
    read = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    assert [(read[k]["n_turns"], read[k]["n_errors"]) for k in range(len(UNTIDY))] == [(len(t), int(e is not None)) for _, t, e in UNTIDY]


def test_very_long_turn(spark):
    text = "<|im_end|>\\é " * 200_000
    df = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    r = chat.digests(chat.format_turns(chat.conversations_as_records(df))).first()
    assert r["loss_chars"] == len(text) and r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_digests(spark):
    turns = [(c, t, r, x) for c in range(5) for t, (r, x) in enumerate([("user", "hé"), ("assistant", "<|im_end|>"), ("user", None), ("assistant", None), (None, "q")])]
    turns += [(9, k, "assistant", "x" * 50) for k in range(3000)] + [(None, 0, "user", "n")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(chat.conversations_as_records(df))).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 9, None}
    for c, r in got.items():
        rows = [(role or "", text or "") for i, _, role, text in turns if i == c]
        said = "".join(t for role, t in rows if role == "assistant")
        assert r["n_turns"] == len(rows)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(chat.render(a, b)[0]) for a, b in rows)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert not chat.digests(chat.format_turns(chat.conversations_as_records(none))).collect()


# ---------------------------------------------------------------- packing


def test_pieces_and_sequences(spark, docs, odd):
    from tokenizers import Tokenizer
    import public_tokenizers

    extra = spark.createDataFrame([(500, "Don't STOP’s it's 12.5 <|endoftext|> İstanbul ﬁne é K ŉ a,b. c.. ΑΣ"), (501, "ba " * 3000)], "doc_id long, text string")
    df = docs.select("doc_id", "text").union(odd.select("doc_id", "text")).union(extra)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack_documents(df, capacity=256, block=50).collect()
    want: Counter = Counter()
    for r in df.collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        for p, a in enumerate(range(0, len(ids), 256)):
            want[(r["doc_id"], p, a, len(ids[a : a + 256]), zlib.crc32(ids[a : a + 256].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places: dict = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in places.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 256


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    r = np.random.default_rng(1)
    lengths = r.integers(1, 100, 500)
    bins, offsets = packing.best_fit(lengths, 100, 5, 4000, (1.0, 0.5, 0.5), rule)
    for b in range(bins.max() + 1):
        own = lengths[bins == b]
        assert len(own) == 1 or own.sum() <= 100 and len(own) <= 5 and (own**2).sum() <= 4000
        assert sorted(offsets[bins == b]) == sorted(np.cumsum(np.sort(own)[::-1]) - np.sort(own)[::-1]) or len(set(offsets[bins == b])) == len(own)


def test_few_sequences():
    r = np.random.default_rng(2)
    lengths = np.minimum(2047, r.lognormal(5.5, 1, 4000).astype(int) + 1)
    bins, _ = packing.best_fit(lengths, 2048, 64, 2048**2, (1.0, 0.02, 0.02), "norm")
    assert bins.max() + 1 <= math.ceil(lengths.sum() / 2048) + 1


def slow_fit(lengths, caps, weights):
    """First to last by falling length: of the bins with room in every way, the one whose residual after it is least."""
    bins, left = [], []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        need = (lengths[k], 1, lengths[k] ** 2)
        fit = [(sum((w * (r - n) / c) ** 2 for w, r, n, c in zip(weights, room, need, caps)), b) for b, room in enumerate(left) if all(r >= n for r, n in zip(room, need))]
        b = min(fit)[1] if fit else len(left)
        if not fit:
            left.append(list(caps))
        left[b] = [r - n for r, n in zip(left[b], need)]
        bins.append((k, b))
    return [b for _, b in sorted(bins)]


def test_best_fit_chooses_the_least_residual():
    r = np.random.default_rng(9)
    for caps in ((100, 4, 10_000), (100, 50, 3000), (64, 3, 900)):
        lengths = r.integers(1, 30, 120)
        bins, _ = packing.best_fit(lengths, *caps, (1.0, 0.5, 0.25), "norm")
        assert bins.tolist() == slow_fit(lengths.tolist(), caps, (1.0, 0.5, 0.25))


def test_limits_bind_and_names_may_clash(spark):
    rows = [(k, f"w{k}", 7, 3) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int, _part int")
    got = packing.pack_documents(df.select("doc_id", "text")).collect()  # short texts: 256 to a sequence, before 2048 tokens
    assert sorted(Counter(r["sequence_id"] for r in got).values()) == [44, 256]
    pieces = packing.tokenise(df).join(df.select("doc_id", "sequence_id", "_part"), "doc_id")
    found = packing.pack(pieces)
    assert found.columns == [*pieces.columns, "sequence_id_", "offset"] and found.count() == 300


def test_blocks_are_formed_as_pieces_come(spark):
    pieces = spark.range(5000).selectExpr("id as doc_id", "(id * 37) % 500 + 1 as length")
    got = packing.pack(pieces, 512, block=100).collect()
    assert len(got) == 5000
    size: Counter = Counter()
    for r in got:
        size[r["sequence_id"]] += r["length"]
    assert max(size.values()) <= 512 and len(size) <= 1.1 * sum(size.values()) / 512


def test_ids_of_pieces_are_those_of_texts(monkeypatch):
    words = packing.WordIds(packing_path())
    assert list(words.of_texts([b"Word, word.  WORD! w0rd"])) == [ids_of(words, "Word, word.  WORD! w0rd")]
    assert len(words.keys) == 7  # "word" once, three signs, and w, 0, rd
    assert list(words.of_texts([])) == [] and list(words.of_texts([b"", b" "])) == [b"", b""]
    units = ["'", "'s", "'VE", "a", "Z", "É", "W\u030a", "\u0301", "=", "\u0338", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "İ", "ß", "1", "9", "²", "—", "»", ",", ".", " ", "\n", "\u00a0", "\x1c", "日本", "😀", "\u212a", "don't"]
    rng = random.Random(5)
    texts = ["".join(rng.choices(units, k=rng.randint(0, 14))) for _ in range(4000)]
    monkeypatch.setattr(packing, "CACHED_WORDS", 300)
    for k in range(0, len(texts), 100):
        part = texts[k : k + 100]
        assert list(words.of_texts([t.encode() for t in part])) == [ids_of(words, t) for t in part]
    words.cuts = False  # as with any other tokenizer
    assert list(words.of_texts([t.encode() for t in texts])) == [ids_of(words, t) for t in texts]


def packing_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def ids_of(words, text):
    return np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing_empty(empty):
    assert packing.pack_documents(empty).count() == 0


# ---------------------------------------------------------------- quality


def slow_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = Counter(windows)
    cover = {k + d for k, w in enumerate(windows) if count[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover)


def test_quality_counts(spark, odd, docs, empty):
    more = [(900, "a b c a b c\n#$ \n#$ \n\n é日😀|"), (901, "x y z " * 30), (902, "w " * 60)]
    df = odd.select("doc_id", "text", "lang").union(docs.select("doc_id", "text", "lang")).union(spark.createDataFrame([(*m, "en") for m in more], "doc_id long, text string, lang string"))
    rows = quality.assess(df).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in df.collect()]
    assert len(rows) == len(texts)
    want = Counter((d, *slow_quality(t)) for d, t in texts)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows) == want
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["kept"] and r["base_failed"])
    assert quality.assess(empty).count() == 0


def test_long_texts_count_alike():
    words = [b"a", b"b", b"c", b"d"] * 20 + [b"q%d" % k for k in range(50)] + [b"a", b"b", b"c"]
    assert quality.repeated_words(words) == quality.repeated_words(words, large=1)


def test_divergence_tells_junk(spark):
    r = random.Random(1)
    plain = lambda: " ".join(r.choices(["the", "of", "and", "house", "garden", "walks", "slowly", "home"], k=120)) + "."
    rows = [(k, plain(), "en") for k in range(60)] + [(100, " ".join(f"{r.getrandbits(40)}$" for _ in range(120)), "en"), (101, " ".join("".join(r.choices("QWXZKJ", k=7)) for _ in range(120)), "en")]
    got = {x["doc_id"]: x for x in quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_word_distance=0.6).collect()}
    assert not got[100]["kept"] and not got[101]["kept"]
    assert got[0]["class_distance"] < 0.2


def slow_verdicts(rows, common=64, prior=1000, least=50, far=(0.33, 0.5)):
    """(doc_id, kept, distances) by histograms written out: all documents, then each language, leaning on all."""
    cut = lambda t: [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))]
    kinds = lambda t: Counter(quality.CLASSES[k] for k in quality._TABLE[list((t or "").encode())])
    words, classes = {None: Counter()}, {None: Counter()}
    for _, t, lang in rows:
        for name in {None, lang}:
            words.setdefault(name, Counter()).update(cut(t))
            classes.setdefault(name, Counter()).update(kinds(t))
    top = lambda name: sorted(words[name], key=lambda w: (-words[name][w], w))[:common]
    share = lambda c, k: c[k] / max(1, c.total())

    def distance(p, q):
        kl = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
        return math.sqrt(max(0, (kl(p, q) + kl(q, p)) / 2))

    out = []
    for d, t, lang in rows:
        n, _, _, _, repeat = slow_quality(t or "")
        failed, by = n < 50 or 100 * repeat > 50 * n, (None, None)
        if n >= least:
            lean, own = prior / (words[lang].total() + prior), Counter(cut(t))
            mixed = lambda c, k: (1 - lean) * share(c[lang], k) + lean * share(c[None], k)  # noqa: E731, B023
            ref = [mixed(words, w) for w in top(lang)]
            seen = [own[w] / n for w in top(lang)]
            by = (distance([share(kinds(t), c) for c in quality.CLASSES], [mixed(classes, c) for c in quality.CLASSES]), distance([*seen, 1 - sum(seen)], [*ref, max(0, 1 - sum(ref))]))
        out.append((d, not failed and (by[0] is None or (by[0] <= far[0] and by[1] <= far[1])), *(b and round(b, 9) for b in by)))
    return out


def test_verdicts_against_brute_force(spark, docs):
    r = random.Random(3)
    rows = [(x["doc_id"], x["text"], ["en", "de", None, "", "*"][x["doc_id"] % 5]) for x in docs.collect()]
    rows += [(500 + k, " ".join(r.choices(["the", "of", "house", "x9#", "ßé"], k=80)), "xx") for k in range(4)] + [(600, None, "en"), (601, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((x["doc_id"], x["kept"], *(b if b is None else round(b, 9) for b in (x["class_distance"], x["word_distance"]))) for x in quality.assess(df).collect())
    want = sorted(slow_verdicts(rows))
    assert [g[:2] for g in got] == [w[:2] for w in want] and len({k for _, k, *_ in want}) == 2
    for g, w in zip(got, want):
        assert all(a is b is None or math.isclose(a, b, abs_tol=1e-7) for a, b in zip(g[2:], w[2:]))


# ---------------------------------------------------------------- licences


def test_licenses(spark, odd, empty, docs):
    texts = ["Some words. Released under the MIT License. More", "licensed under the APACHE license, version 2.0", "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.", "the license of the work", licenses.TEMPLATES["mit"][3].replace("free of charge", "free of all charge")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.digest(licenses.scan(df)).collect()}
    assert [rows[k]["licenses"] for k in range(5)] == ["mit", "apache-2.0", "cc-by-nc-4.0,gpl-3.0", "", "mit"]
    both = df.union(odd.where("doc_id is not null and doc_id <> 4").select((F.col("doc_id") + 50), "text")).union(docs.select(F.col("doc_id") + 100, "text"))
    r = random.Random(12)
    more = []
    for k in range(60):  # wrapped, cut and garbled templates among other words
        words = licenses.TEMPLATES[r.choice(list(licenses.TEMPLATES))][-1].split()
        for _ in range(r.randrange(12)):
            words[r.randrange(len(words))] = r.choice(["house", "the software", "", "of the License"])
        whole = ["before"] * r.randrange(4) + words[r.choice([0, 0, 5]) :] + ["after"] * r.randrange(4)
        more.append((300 + k, " ".join(x + ("\n * " if r.random() < 0.1 else "") for x in whole * r.choice([1, 1, 2]))))
    both = both.union(spark.createDataFrame(more, "doc_id long, text string"))
    c = duckdb.connect()
    c.register("documents", both.toPandas())
    want = sorted(c.execute(licenses.oracle_sql()).fetchall())
    assert sorted((r["doc_id"], r["n_notices"], r["licenses"], r["best_dice"]) for r in licenses.digest(licenses.scan(both)).collect()) == want
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(empty).count() == 0


def test_wrapped_notices_and_whole_texts(spark):
    import textwrap

    texts, names = [], []
    for name, found in licenses.TEMPLATES.items():
        for t in found:
            if len(t) > 200:
                for wrapped in (textwrap.fill(t, 78), textwrap.fill(t, 40, initial_indent="# ", subsequent_indent="# ")):
                    texts.append("Copyright (c) 1999 Somebody\n\n" + wrapped + "\n\nimport this\nand other words follow")
                    names.append(name)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.digest(licenses.scan(df)).collect()}
    assert [rows[k]["licenses"] for k in range(len(texts))] == names and all(r["n_notices"] == 1 and r["best_dice"] == 1.0 for r in rows.values())
    assert {"mit", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "gpl-3.0", "apache-2.0"} <= set(names)


def test_license_in_a_very_long_text(spark):
    r = random.Random(1)
    words = [f"w{r.randrange(50_000)}" for _ in range(300_000)]
    words[150_000:150_000] = licenses.TEMPLATES["isc"][0].split()
    found = licenses.scan(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()["found"]
    assert [(m["start"], m["license"], m["dice"]) for m in found] == [(150_000, "isc", 1.0)]


def test_pruning_bounds():
    for least in (0.6, 0.8, 0.9):
        for n in range(1, 60):
            low, high = licenses.size_bounds(n, least)
            fit = [m for m in range(1, 200) if 2 * min(n, m) / (n + m) >= least - 1e-12]
            assert (low, high) == (fit[0], fit[-1])


# ---------------------------------------------------------------- toxicity

BAD = ["idiot", "stupid", "moron", "trash"]


@pytest.fixture(scope="module")
def judged(spark):
    r = random.Random(4)
    words = ["river", "stone", "walks", "under", "bright", "garden", "the", "and", "with", "silver", "morning", "quiet", "letter"]
    rows, labels = [], []
    for k in range(400):
        text = r.choices(words, k=40)
        toxic = int(k % 5 == 1)
        if toxic:
            for w in r.sample(BAD, 1 + k % 2):  # texts with one such word tell that one is enough
                text[r.randrange(40)] = w
        rows.append((k, " ".join(text)))
        labels.append((k, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string").cache(), spark.createDataFrame(labels, "doc_id long, toxic int").cache(), labels


HIDDEN = ["you 1d10t there", "you i d i o t there", "so stuuupid it is", "$tup1d thing", "such a m0r0n!!", "tr@sh and quiet", "stuupid river", "you idiiot", "m.o.r.o.n walks", "t r a s h in the garden", "IDIOT###", "st*pid river"]
FAIR = ["the 1st river and 2 stones", "a b c d e f", "soooo bright a morning", "call +1 234 567 now", "quiet@garden.org wrote", "under 50% of the letter", ""]


def test_scores_find_hidden_words(spark, judged):
    docs, labels, rows = judged
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.scores(docs, model).collect()}
    for doc, toxic in rows:
        assert got[doc]["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert got[doc]["predicted"] == toxic == int(got[doc]["score"] >= 0.5)
    odd = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(HIDDEN + FAIR)], "doc_id long, text string")
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.scores(odd, model).collect()}
    assert [t for k, t in enumerate(HIDDEN + FAIR) if scored[1000 + k] != (k < len(HIDDEN))] == []
    assert {r["doc_id"] for r in toxicity.reject(odd, model).collect()} == {1000 + k for k in range(len(HIDDEN), len(HIDDEN + FAIR))}


def test_texts_together_are_read_as_alone(spark, judged):
    docs, labels, _ = judged
    features = toxicity.fit(docs, labels).features()
    texts = HIDDEN + FAIR + ["É È à b c", "i. d. i. o. t. x", "m - o - r - o - n", "a, b, c, d", "x  y\tz", "Ü " * 50, "t r a s h"] + [r["text"] for r in docs.limit(30).collect()]
    assert features.of_texts(texts) == [features.of(t) for t in texts]
    assert features.of_texts([]) == []


def test_spaced_words_in_any_setting_are_read_in_batches(spark, judged):
    docs, labels, _ = judged
    features = toxicity.fit(docs, labels).features()
    one = features.index[("idiot", 1)]
    whole = ["i .d .i .o .t", "i *d *i *o *t", "i d i o t!!", "(i d i o t)", 'said "i d i o t" then', "[i.d.i.o.t]", "i . d . i . o . t"]
    found = features.of_texts(whole)
    assert found == [features.of(t) for t in whole]
    assert [t for t, f in zip(whole, found) if one not in f] == []
    for t in ["a s s!!", "it's a b c", "f(a b c)", "a b c's"]:
        assert features.of_texts([t]) == [features.of(t)]
    assert [m[0] for m in toxicity.SPACED.finditer("it's a b c, (i d i o t) a s s!!")] == ["a b c", "i d i o t", "a s s"]


SYMBOL = {" ": 0, **{c: ord(c) - 96 for c in "abcdefghijklmnopqrstuvwxyz"}}


def slow_best(decoder, words, text):
    """The best score over every path of the lattice, each written out."""
    best = -math.inf
    for path in itertools.product(*decoder.lattice(text)):
        x = y = 0
        score, word = 0.0, ""
        for out, cost in path:
            score += cost
            for o in out:
                k = SYMBOL.get(o, 27)
                if k == 0 and y == 0:
                    continue
                score += decoder.model[x][y][k]
                if k == 0:
                    score, word = score + decoder.bonus * (word in words), ""
                else:
                    word += o
                x, y = y, k
        best = max(best, score)
    return best


@settings(max_examples=150, deadline=None)
@given(st.text("ab1ddoo0t*. $éx", min_size=1, max_size=7), st.integers(0, 3))
def test_best_reading_of_every_lattice(text, seed):
    words = ["dot", "boot", "aid", "to"]
    decoder = toxicity.Decoder(np.random.default_rng(seed).normal(-3, 2, (toxicity.SYMBOLS,) * 3), words)
    score, said = decoder.best(text)
    assert math.isclose(score, slow_best(decoder, words, text), abs_tol=1e-9)


@settings(max_examples=400, deadline=None)
@given(st.text("a b1.*_-,('\"x\n!é", max_size=24))
def test_no_spaced_word_is_passed_over(text):
    data = toxicity.joined([text.encode()], lower=False)
    places = set(toxicity.may_be_spaced(data).tolist())
    for m in toxicity.SPACED.finditer(text):
        assert len(text[: m.start()].encode()) in places


def test_words_with_several_readings_are_read():
    assert [w for w in ["stuupid", "idiiot", "1d10t", "s.t", "455", "(c)ool", "plain", "über", "word,", "word!!"] if toxicity.needs_reading(w)] == ["stuupid", "idiiot", "1d10t", "s.t", "455", "(c)ool"]


def test_words_that_are_not_searched_have_no_useful_reading(judged):
    model = toxicity.fit(*judged[:2])
    features, r = model.features(), random.Random(2)
    for _ in range(3000):
        word = "".join(c * r.choice([1, 1, 2, 3, 5]) for c in r.choice(BAD + ["letter", "idiotic", "trashy", "strash", "bid", "mooring"]))
        plain = toxicity.forms(features.decoder.read(toxicity.needs_reading(word)).split() or [word])
        assert features.words[word] == (tuple(x for x in plain if x in features.words.useful) or None)


def test_very_long_word_is_read(spark, judged):
    model = toxicity.fit(*judged[:2])
    text = "ab1" * 20_000 + " you 1d10t"
    assert toxicity.scores(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()["predicted"] == 1


def test_regression_against_a_dense_solution():
    r = np.random.default_rng(3)
    x = [np.flatnonzero(r.random(12) < 0.3) for _ in range(300)]
    y = (r.random(300) < 0.4).astype(float)
    dense = np.zeros((300, 13))
    for k, f in enumerate(x):
        dense[k, f] = 1
    dense[:, 12] = 1
    w, penalty = np.zeros(13), np.array([0.1] * 12 + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-dense @ w))
        w += np.linalg.solve((dense * (p * (1 - p))[:, None]).T @ dense + np.diag(penalty), dense.T @ (y - p) - penalty * w)
    assert np.allclose(toxicity.fit_logistic(x, y, 12), w, atol=1e-5)


def test_held_out_labels_are_not_learned(spark, judged):
    docs, labels, rows = judged
    turned = spark.createDataFrame([(d, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, t in rows], "doc_id long, toxic int")
    a, b = (toxicity.fit(docs, x) for x in (labels, turned))
    assert a.words == b.words and np.allclose(a.weights, b.weights)


def test_toxicity_odd_rows(spark, odd, empty, judged):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd, none)
    assert toxicity.scores(odd, model).count() == odd.count() and all(r["score"] < 0.5 for r in toxicity.scores(odd, model).collect())
    assert toxicity.reject(odd, model).columns == odd.columns
    assert toxicity.scores(empty, toxicity.fit(empty, none)).count() == 0
    one = toxicity.fit(judged[0], spark.createDataFrame([(1, 1), (2, 1), (3, None)], "doc_id long, toxic int"))
    assert toxicity.scores(odd, one).where("predicted = 1").count() == odd.count()


# ---------------------------------------------------------------- language model


def test_scores_of_text(spark, docs, odd):
    df = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    rows = df.collect()
    tokens = [(r["doc_id"], [*(r["text"] or "").encode().lower().split(), b""]) for r in rows]
    known: Counter = Counter()
    out = lambda d: zlib.crc32(str(d if d is not None else "").encode()) % 7 == 2
    for d, t in tokens:
        if not out(d):
            known.update(t)
    n, v = sum(known.values()), len(known)
    want = sorted((d if d is not None else -1, out(d), len(t), sum(known[w] > 0 for w in t), n, round(sum(math.log10((known[w] + 1) / (n + v + 1)) for w in t), 6)) for d, t in tokens)
    got = lm.scores(df).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    held = [r for r in got if r["held_out"] and r["n_tokens"] > 50]
    # the words are drawn evenly, so counts are all there is to know: the model may cost little more
    assert held and sum(r["score"] for r in held) > 1.05 * sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in got)


def test_unseen_words_and_languages_are_learned(spark):
    """Two languages whose words are spelled from their own syllables: held-out texts cost less than by counts."""
    r = random.Random(8)
    syllables = [["ka", "to", "mi", "ren", "du", "sol"], ["élu", "ço", "ère", "ão", "né", "üst"]]
    rows = [(k, " ".join("".join(r.choices(syllables[k % 2], k=r.choice([1, 1, 1, 2, 3]))) for _ in range(150))) for k in range(300)]
    got = [x for x in lm.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect() if x["held_out"]]
    assert len(got) > 20 and sum(x["score"] > x["base_score"] for x in got) > 0.95 * len(got)


def test_spelling_is_a_probability():
    """Over a model of random counts, all words of up to two letters and longer ones share one."""
    r = np.random.default_rng(3)
    tables = r.integers(0, 50, (len(lm.ORDERS), 1 << 18, 2)).astype(np.uint16)
    weights = r.normal(0.3, 0.2, (lm.GATES, len(lm.ORDERS) + 1))
    letters = np.arange(256, dtype=np.uint8)
    one = np.exp(lm.spelled(letters, np.ones(256, np.int64), np.zeros(256, np.int64), tables, weights))
    none = np.exp(lm.spelled(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64), tables, weights))
    pairs = np.exp(lm.spelled(np.array([[a, b] for a in range(256) for b in range(256)], np.uint8).ravel(), np.full(65536, 2), np.zeros(65536, np.int64), tables, weights))
    assert 0 < none[0] + one.sum() + pairs.sum() <= 1 + 1e-6


def slow_spelled(word: bytes, kind: int, tables, weights) -> float:
    """The word's log-probability bit by bit, contexts hashed one by one."""
    wrap, text, total = 2**64, word + b" ", 0.0
    bits = len(tables[0]).bit_length() - 1
    for place, c in enumerate(text):
        heads, h = [], (kind + 1) * 0x9E3779B97F4A7C15 % wrap
        for back in range(1, max(lm.ORDERS) + 1):
            h = (h ^ (text[place - back] if back <= place else 0)) * 0x9FB21C651E98DF25 % wrap
            h ^= h >> 31
            if back in lm.ORDERS:
                heads.append((h + back) % wrap)
        for b in range(8):
            node, y = c >> (8 - b) | 1 << b, c >> (7 - b) & 1
            gate = 4 * b + min(place, 3)
            z = 0.3 * weights[gate][-1]
            for k, head in enumerate(heads):
                n0, n1 = map(float, tables[k][(((head ^ node << 17) + node) % wrap * 0xD6E8FEB86659FD93 % wrap) >> (64 - bits)])
                z += weights[gate][k] * max(-8, min(8, math.log((n1 + 0.2) / (n0 + 0.2))))
            z = max(-14, min(14, z))
            total -= math.log1p(math.exp(-z if y else z))
    return total


def test_spelling_against_a_slow_mixer():
    r = np.random.default_rng(7)
    tables, weights = r.integers(0, 300, (len(lm.ORDERS), 1 << 12, 2)).astype(np.uint16), r.normal(0.3, 0.3, (lm.GATES, len(lm.ORDERS) + 1))
    words = [b"", b"a", b"the", b"wordlike", "é日".encode(), b"x" * 40]
    kinds = np.array([0, 1, 2, 7, 3, 0])
    got = lm.spelled(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words]), kinds, tables, weights)
    assert np.allclose(got, [slow_spelled(w, k, tables, weights) for w, k in zip(words, kinds.tolist())], rtol=1e-4)


def test_large_counts_are_halved():
    counts = np.array([[0, 0], [65_535, 2], [65_536, 10], [10**7, 10**6], [1, 2**33]])
    found = lm.halved(counts).astype(np.int64)
    assert found[:2].tolist() == counts[:2].tolist() and found.max() <= 65_535
    assert np.allclose(found[2:, 0] / found[2:].sum(1), counts[2:, 0] / counts[2:].sum(1), atol=1e-3)


def test_occurrences_reach_the_predictors(spark):
    """Words of the same letters in all: those that occur more often are spelled as likelier, and teach the mixer more."""
    trained = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 != 2]
    docs = spark.createDataFrame([(k, "abab " * 50 + "acac") for k in trained], "doc_id long, text string")
    lists = lm._survey(docs, 2, 7, 16).where("bucket is not null").select("bucket", "block", "data", "words")
    words = lm._collected(lists, 2).cache()
    tables, halvings = lm._tables(words, 1, 16)
    b_after_a = slow_counts(b"ab", tables)
    assert tables[0].sum() == 8 * len(trained) * (50 * 5 + 5) and b_after_a == (50 * len(trained), len(trained))
    assert not halvings.any()


def slow_counts(text, tables):
    """Occurrences of the last letter's next-to-last bit pattern: b (98) and c (99) after a word's first letter differ in the last bit."""
    wrap, h = 2**64, 0x9E3779B97F4A7C15
    for before in (text[0], 0):
        h = (h ^ before) * 0x9FB21C651E98DF25 % wrap
        h ^= h >> 31
    node = text[1] >> 1 | 1 << 7
    pair = tables[0][((((h + 2) % wrap ^ node << 17) + node) % wrap * 0xD6E8FEB86659FD93 % wrap) >> 48]
    return tuple(pair.tolist())


def test_occurrences_left_out_of_halved_counts():
    counts, y, times = np.array([[10, 3], [0, 7], [1 << 20, 5], [3, 1 << 30]]), np.array([0, 1, 0, 1]), np.array([4, 7, 1 << 20, 1 << 29])
    got = lm.left_out(lm.halved(counts).astype(np.int64), lm.halvings(counts)[:, 0].astype(np.uint8), y, times)
    assert got.tolist() == [[6, 3], [0, 0], [0, 0], [0, (1 << 29) >> 15]]


def test_scores_do_not_depend_on_the_session(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 5_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n, parts in (("2", 1), ("19", 7)):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            found.append({r["doc_id"]: (r["score"], r["bits_per_byte"]) for r in lm.scores(docs.repartition(parts)).collect()})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0].keys() == found[1].keys()
    assert all(np.allclose(found[0][k], found[1][k], rtol=1e-12) for k in found[0])
    size = {r["doc_id"]: len(r["text"].encode()) for r in docs.collect()}
    assert all(math.isclose(bits, -score * math.log2(10) / (size[k] + 1)) for k, (score, bits) in found[0].items())


def test_very_long_text_is_scored(spark):
    text = " ".join(f"w{k % 5000}" for k in range(400_000))
    r = lm.scores(spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string")).orderBy("doc_id").first()
    assert r["n_tokens"] == 400_001 and math.isfinite(r["score"])


def test_gate_gives_probabilities():
    r = np.random.default_rng(5)
    p = r.dirichlet([1, 1], size=(3, 40))  # experts, tokens, the two symbols
    starts, gate = np.array([0, 1, 7, 40]), np.log([0.45, 0.1, 0.45])
    first = lambda k: np.log(p[:, :, k])
    short = np.exp(lm.refine(first(0)[:, :1], np.array([0, 1]), gate)) + np.exp(lm.refine(first(1)[:, :1], np.array([0, 1]), gate))
    assert np.allclose(short, 1)
    whole = lm.refine(first(0), starts, gate)
    apart = [lm.refine(first(0)[:, a:b], np.array([0, b - a]), gate)[0] for a, b in zip(starts, starts[1:])]
    assert np.allclose(whole, apart)


def test_no_training_texts(spark, empty):
    assert lm.scores(empty).count() == 0
    held = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 7 == 2)
    row = lm.scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0) and math.isfinite(row["score"])
