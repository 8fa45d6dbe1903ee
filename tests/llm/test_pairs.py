"""Near duplicates, line deduplication and decontamination against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from scriptorium.llm import decontaminate as D
from scriptorium.llm import linededup as L
from scriptorium.llm import queries
from scriptorium.llm import simhash as S
from scriptorium.llm.graph import connected_components


def slow_fingerprint(text: str, k: int = 4) -> int:
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "Cc", "é", "\n", "dd\te"]), max_size=30))
def test_fingerprint(parts):
    text = " ".join(parts)
    assert S.fingerprint(text.encode()) == slow_fingerprint(text)


def components(fps: list[int], ids: list[int], distance: int) -> list[int]:
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i in range(len(fps)):
        least[find(i)] = min(least.get(find(i), 1 << 62), ids[i])
    return [least[find(i)] for i in range(len(fps))]


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates(spark, docs, shingle):
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in S.near_duplicates(docs, shingle).collect()}
    fps = [slow_fingerprint(r["text"], shingle) for r in rows]
    want = components(fps, [r["doc_id"] for r in rows], 4)
    assert [got[r["doc_id"]]["fp"] & (2**64 - 1) for r in rows] == fps
    assert [got[r["doc_id"]]["component_id"] for r in rows] == want
    kept = {r["doc_id"] for r in S.keep_first(docs, shingle=shingle).collect()}
    assert kept == set(want)


def test_links_find_every_component_among_close_fingerprints(spark):
    r = random.Random(3)
    fps = set()
    for _ in range(12):
        base = r.getrandbits(64)
        for _ in range(25):
            x = base
            for b in r.sample(range(64), r.randint(0, 6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    links = [((a & (2**64 - 1)), (b & (2**64 - 1))) for a, b in S.links(df, 4, 12, 3).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    where = {x: k for k, x in enumerate(fps)}
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        x, y = find(where[a]), find(where[b])
        label[max(x, y)] = min(x, y)
    assert [find(k) for k in range(len(fps))] == components(fps, list(range(len(fps))), 4)


def signed(fps: list[int]) -> list[int]:
    return np.array(fps, np.uint64).view(np.int64).tolist()


def test_large_groups_are_split_and_lose_no_link(spark):
    r = random.Random(5)
    base = r.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for _ in range(300)} | {r.getrandbits(64) for _ in range(20)})
    df = spark.createDataFrame([(x,) for x in signed(fps)], "fp long")
    want = components(fps, list(range(len(fps))), 4)
    for group in (20, 10_000):  # keys of over 20 rows are numbered and dealt again in pairs of blocks
        found = [(a & (2**64 - 1), b & (2**64 - 1)) for a, b in S.links(df, 4, 12, 3, group=group).collect()]
        assert components_of(fps, found) == want
    one_key = df.selectExpr("0L as key", "0 as which", "fp as bits", "fp as node")
    linked = lambda which, diff: np.flatnonzero(np.bitwise_count(diff) <= 4)
    for group in (7, 70, 1000):
        found = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in S.pairs_by_key(one_key, S.Forest(linked), group).collect()]
        assert components_of(fps, found) == want
        assert len(found) <= len(fps) * (len(fps) // group + 2)  # a forest for each pair of blocks, not all pairs


def components_of(fps, links):
    where = {int(x): k for k, x in enumerate(fps)}
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        x, y = find(where[a]), find(where[b])
        label[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


@pytest.mark.parametrize("distance, segments, depth", [(4, 12, 2), (4, 12, 3), (4, 16, 2), (3, 8, 1), (6, 12, 3)])
def test_ring_keys_cover_every_pair_within_the_distance(distance, segments, depth):
    ring, r = S.Ring(distance, segments, depth), random.Random(1)
    for _ in range(300):
        diff = sum(1 << b for b in r.sample(range(64), r.randint(0, distance)))
        assert any(diff & mask == 0 and len(ring.within(first, np.array([diff], np.uint64))) for first, mask in ring.keys)


def test_chains_are_pruned_by_every_budget():
    ring, r = S.Ring(4, 12), random.Random(2)
    diffs = [sum(1 << b for b in r.sample(range(64), r.randint(0, 7))) for _ in range(2000)]
    for first in range(12):
        slow = []
        for k, d in enumerate(diffs):
            bits = [(d & ring.masks[(first + l) % 12]).bit_count() for l in range(12)]
            if all(sum(bits[: l + 1]) <= (l + 1) * 4 // 12 for l in range(12)):
                slow.append(k)
        assert ring.within(first, np.array(diffs, np.uint64)).tolist() == slow


def test_more_rows_take_longer_keys():
    few, many = S.Ring.for_rows(1000), S.Ring.for_rows(10**9)
    assert (len(few.keys), len(many.keys)) == (36, 144)
    assert min(m.bit_count() for _, m in many.keys) >= 30


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 101), (102, 101), (5, 5)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, 100: 100, 101: 100, 102: 100}
    assert not connected_components(spark.createDataFrame([], "a long, b long")).collect()


def slow_removed(rows, t=0.8, least=1):
    lines = [(r["doc_id"], k, frozenset(s)) for r in rows for k, x in enumerate((r["text"] or "").encode().lower().split(b"\n")) if len(s := set(x.split())) >= least]
    lines.sort(key=lambda x: x[:2])
    out = set()
    for i, (d, k, s) in enumerate(lines):
        if any(len(s & o) >= t * len(s | o) - 1e-9 for e, j, o in lines[:i] if (e, j) != (d, k)):
            out.add((d, k))
    return out


@pytest.mark.parametrize("hot, similarity", [(20_000, 0.8), (2, 0.8), (5, 0.6)])
def test_removed_lines(spark, docs, hot, similarity):
    got = {tuple(r) for r in L.removed_lines(docs, similarity, hot=hot).collect()}
    assert got == slow_removed(docs.orderBy("doc_id").collect(), similarity) and got


def test_dedup_rebuilds_texts(spark, docs):
    gone = slow_removed(docs.collect())
    got = {r["doc_id"]: r for r in L.dedup(docs).collect()}
    for r in docs.collect():
        want = "\n".join(x for k, x in enumerate(r["text"].split("\n")) if (r["doc_id"], k) not in gone)
        assert got[r["doc_id"]]["text"] == want and got[r["doc_id"]]["n_chars"] == len(want)


def test_query_and_stage_remove_short_lines(spark, docs, tmp_path):
    short = [(2000, "all rights reserved.\nmenu\none two three four"), (2001, "All  rights reserved.\n\n\nMenu"), (2002, "reserved. all rights\none two three four five\nmenu x")]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(short, "doc_id long, text string"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = slow_removed(df.orderBy("doc_id").collect())
    assert {(2001, 0), (2001, 3), (2002, 0), (2002, 1)} <= want and (2002, 2) not in want
    listed = queries.op10_line_dedup(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], int(x)) for r in listed for x in r["removed_lines"].split(",") if x} == want
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_lines(spark, df, "").collect()}
    assert texts[2001] == "\n" and texts[2002] == "menu x" and texts[2000] == short[0][1]


def test_least_words_and_clashing_names(spark, docs):
    rows = docs.orderBy("doc_id").collect()
    assert {tuple(r) for r in L.removed_lines(docs, min_words=5).collect()} == slow_removed(rows, least=5)
    named = docs.selectExpr("*", "1 as doc", "2 as `lines`", "3 as _id", "4 as _gone", "5 as line")
    found = L.dedup(named)
    assert found.columns == named.columns and {r["doc_id"]: r["text"] for r in found.collect()} == {r["doc_id"]: r["text"] for r in L.dedup(docs).collect()}


def test_words_that_agree_in_their_first_bits_stay_apart(monkeypatch, spark, docs):
    """With hashes that differ in their last bits only, sort keys tie and words are told apart by the rest."""
    whole = L.word_hashes
    monkeypatch.setattr(L, "word_hashes", lambda *a: whole(*a) & np.uint64(0xFFFF))
    rows = docs.orderBy("doc_id").collect()
    for lines in L.lines_of([r["doc_id"] for r in rows], [r["text"].encode() for r in rows], 1, np.zeros(1 << 20, np.uint8)):
        for d, p, s, n in zip(lines.doc, lines.place, lines.start, lines.size):
            text = next(r["text"] for r in rows if r["doc_id"] == d).split("\n")[p]
            assert n == len(set(lines.words[s : s + n].tolist())) and sorted(lines.words[s : s + n].tolist()) == lines.words[s : s + n].tolist()
            assert n == len({int(h) for h in np.unique(hashed(text, L.word_hashes))})


def hashed(text, hashes):
    data = L.joined([text.encode()])
    return hashes(data, *L.word_places(data))


def test_codes_keep_the_order_of_counts():
    counts = np.array([0, 1, 2, 3, 10, 65_535, 65_536, 10**6, 2**31, 2**32 - 1])
    codes = L.code(counts)
    assert codes[0] == codes[1] == 0 < codes[2] and (np.diff(codes.astype(int)) >= 0).all() and codes[5] < codes[7] < codes[8]


def test_long_words_and_lines(spark):
    long = " ".join("w" * (100 + k) for k in range(60))
    rows = [(1, long), (2, long + " tail"), (3, " ".join(f"t{k}" for k in range(3000))), (4, " ".join(f"t{k}" for k in range(100, 3000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in L.removed_lines(df).collect()} == {(2, 0), (4, 0)}


def slow_distance(pattern: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=70), st.text("abc", max_size=90))
def test_myers(pattern, text):
    assert D.myers(D.pattern_masks(pattern), len(pattern), text, len(pattern)) == slow_distance(pattern, text)


@pytest.mark.parametrize("block", [16_000_000, 150])
def test_decontamination(spark, docs, block):
    r = random.Random(11)
    texts = [D.normalise(x["text"]) for x in docs.orderBy("doc_id").collect()]
    items = [(k, t[:120]) for k, t in enumerate(t for t in texts if len(t) > 150)][:8]
    planted = []
    for k, t in enumerate(texts[:40]):
        item = list(items[k % len(items)][1])
        for _ in range(k % 9):
            at = r.randrange(len(item))
            item[at : at + 1] = r.choice([["z"], [], ["q", item[at]]])
        planted.append((1000 + k, "Before  it " + "".join(item).upper() + "\nafter"))
    df = docs.select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {x["doc_id"]: list(zip(x["item_ids"], x["distances"])) for x in D.matches(df, bench, block_chars=block).collect()}
    for x in df.collect():
        text = D.normalise(x["text"])
        want = [(i, d) for i, p in items if (d := slow_distance(p, text)) <= D.error_budget(len(p))]
        assert [i for i, _ in got[x["doc_id"]]] == [i for i, _ in want]
        assert all(a == b for (_, a), (_, b) in zip(got[x["doc_id"]], want))
    clean = {x["doc_id"] for x in D.clean(df, bench, block_chars=block).collect()}
    assert clean == {d for d, m in got.items() if not m}


def test_budget_leaves_pieces_long_enough():
    for n in range(1, 400):
        k = D.error_budget(n)
        parts = D.pieces("x" * n, k)
        assert len(parts) == k + 1 and sum(len(p) for _, p in parts) == n
        assert k == 0 or min(len(p) for _, p in parts) >= 9
        assert k == math.floor(n * 0.1) if n >= 90 else k <= math.floor(n * 0.1)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=1, max_size=8), st.text("ab", max_size=10))
def test_follows_is_a_prefix_with_one_edit(piece, text):
    want = any(edits(piece, text[:n]) <= 1 for n in range(len(text) + 1))
    assert D.follows(piece, "xy" + text, 2) == want


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_short_items_match_as_whole_words(spark):
    rows = [(1, "So:  What is two plus two?\nFour."), (2, "party"), (3, "art, they say"), (4, "what is two plus three?"), (3, "no"), (5, None)]
    items = [(7, "What is two plus two?"), (8, "art"), (9, "..."), (None, "say")]
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (16_000_000, 5):
        got = sorted((x["doc_id"], x["item_ids"], x["distances"]) for x in D.matches(df, bench, block_chars=block).collect())
        assert got == [(1, [7], [0]), (2, [], []), (3, [], []), (3, [8, None], [0, 0]), (4, [], []), (5, [], [])]


def test_odd_rows(spark, odd, empty):
    n = odd.count()
    assert S.near_duplicates(odd).count() == n and S.near_duplicates(empty).count() == 0
    by = {(r["doc_id"], r["fp"]): r["component_id"] for r in S.near_duplicates(odd).collect()}
    assert by[(0, 0)] == by[(1, 0)] == by[(2, 0)] == by[(7, 0)] == 0
    kept = S.keep_first(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == [-1, 0, 3, 5, 6, 8, 10, 11]
    assert S.keep_first(empty).count() == 0
    assert {tuple(r) for r in L.removed_lines(odd).collect()} == {(4, 0), (9, 0)}
    assert L.dedup(odd).columns == odd.columns and L.dedup(odd).count() == n
    assert L.removed_lines(empty).count() == 0 and L.dedup(empty).count() == 0
    bench = spark.createDataFrame([(1, None), (2, "one two three four five six seven"), (None, "x" * 100)], "item_id long, text string")
    got = D.matches(odd, bench)
    assert got.count() == n and {r["doc_id"] for r in got.collect() if 2 in r["item_ids"]} == {8, 9, None}
    assert D.clean(odd, bench).columns == odd.columns
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.clean(odd, none).count() == n and D.matches(empty, bench).count() == 0
