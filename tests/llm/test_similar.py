"""The pipeline's near duplicates against brute force over five-word shingles."""

from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from scriptorium.llm import similar


def shingles(text: str) -> frozenset:
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def first_of_components(rows: list[tuple[int, str]], t: float = 0.8) -> set[int]:
    rows = sorted(rows)
    sets = [shingles(x) for _, x in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= t * len(a | b) - 1e-9:
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return {rows[k][0] for k in range(len(rows)) if find(k) == k}


def test_stage_drops_every_copy_at_similarity_08(spark, docs):
    r = random.Random(9)
    rows = [(x["doc_id"], x["text"]) for x in docs.select("doc_id", "text").collect()]
    for k in range(40):  # 0 to 4 words of 200 replaced: similarities from 0.78 to 1; some copies of copies
        words = [f"w{r.randrange(500)}" for _ in range(200)]
        rows.append((1000 + 10 * k, " ".join(words)))
        for c in range(1, 4):
            copy = list(words)
            for at in r.sample(range(200), (k + c) % 5):
                copy[at] = "changed"
            rows.append((1000 + 10 * k + c, " ".join(copy)))
            words = copy if c == 2 else words
    rows += [(3000, None), (3001, " \n"), (3002, "two words"), (3003, "Two  Words"), (3004, "two other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {x["doc_id"] for x in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()}
    assert kept == first_of_components(rows)


def test_long_fingerprints_count_every_shingle():
    r = np.random.default_rng(4)
    sets = [r.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 30, 31, 32, 100, 1000)]
    found = similar.long_fingerprints(sets, 3)
    for s, row in zip(sets, found):
        for k in range(3):
            h = similar.mix(s, 40 + k).tolist()
            assert int(row[k]) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_segments_find_what_they_say():
    """Of pairs at a similarity of 0.8, by calculation one in 1,000 is missed: 600 pairs, at most 5 missed."""
    r = np.random.default_rng(5)
    for rows in (1000, 200_000):
        plan = similar.Segments(rows, 0.8)
        missed = 0
        for _ in range(600):
            whole = r.integers(0, 2**63, 90).astype(np.uint64)
            a, b = whole[:85], np.concatenate([whole[:75], whole[85:]])[:80]
            assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) < 0.84
            x, y = similar.long_fingerprints([whole, whole[:72]], plan.words)
            hit = any(k == l and len(plan.chains.within(0, v ^ w)) for (k, v), (l, w) in zip(plan.keys(x[None]), plan.keys(y[None])))
            missed += not hit
        assert missed <= 5


def test_refused_pairs_do_not_part_what_others_join(spark):
    """A ladder of texts whose ends are far apart and a crowd just under the similarity: forests offer
    refused pairs, and rounds go on; small groups are dealt in blocks."""
    r = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    rows, text = [], list(words)
    for k in range(40):
        for _ in range(4):
            text[r.randrange(300)] = f"n{r.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    for k in range(60):
        other = list(words)
        for at in r.sample(range(300), 6 + k % 5):
            other[at] = f"c{k}x{at}"
        rows.append((100 + k, " ".join(other)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = first_of_components(rows)
    for group in (8, 1000):
        found = similar.similar_documents(df, group=group).collect()
        assert {x["component_id"] for x in found} == want


def test_odd_rows(spark, odd, empty):
    found = similar.similar_documents(odd).collect()
    assert len(found) == odd.where("doc_id is not null").count() and not similar.similar_documents(empty).collect()
    by = {x["doc_id"]: x["component_id"] for x in found}
    assert by[0] == by[1] == by[2] == by[7] == 0 and by[9] == by[8] == 8 and by[6] == 6
    kept = corpus_pipeline.drop_near_duplicates(spark, odd.drop("label"), "")
    assert kept.columns == odd.drop("label").columns and kept.where("doc_id is null").count() == 1
    assert not corpus_pipeline.drop_near_duplicates(spark, empty, "").collect()


def test_very_long_text(spark):
    r = random.Random(6)
    words = [f"w{r.randrange(10**5)}" for _ in range(300_000)]
    copy = list(words)
    for k in range(0, 300_000, 100):
        copy[k] = "x"
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(copy)), (3, " ".join(words[:100_000]))], "doc_id long, text string")
    assert {x["doc_id"]: x["component_id"] for x in similar.similar_documents(df).collect()} == {1: 1, 2: 1, 3: 3}
