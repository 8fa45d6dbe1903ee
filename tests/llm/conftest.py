from __future__ import annotations

import pytest

#: Texts that every operator must take: nulls, empties, ties, long words, other scripts, control characters.
ODD_TEXTS = [None, "", " \t\n", "a", "a", "é ü ß", "x" * 5000, "\n\n\n", "one two three four five six seven", "one two three four five six seven", "日本語 テキスト", "<|im_end|>\\<|"]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd texts, a null id, a repeated row, and a clashing extra column."""
    rows = [(k, t, None if k % 3 else "en", None, None, f"extra {k}") for k, t in enumerate(ODD_TEXTS)]
    rows += [(None, "one two three four five six seven", "en", "s", 3, "x"), rows[4]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, label string").cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs(spark):
    """Invented documents with copies, near copies, repeated lines and passages."""
    import random

    r = random.Random(7)
    syllables = ["ba", "ko", "ri", "ten", "lu", "mar", "os", "vi", "den", "sha"]
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    vocabulary = [word() for _ in range(400)]
    line = lambda n: " ".join(r.choices(vocabulary, k=n))
    shared = [line(r.randint(6, 60)) for _ in range(6)]
    rows = []
    for k in range(160):
        lines = [line(r.randint(1, 30)) for _ in range(r.randint(1, 6))]
        if k % 4 == 0:
            lines.insert(r.randint(0, len(lines)), r.choice(shared))
        text = "\n".join(lines)
        if k % 5 == 4:
            words = rows[r.randrange(len(rows))][1].split(" ")
            for _ in range(r.randint(0, 2)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            text = " ".join(words)
        rows.append((k, text, "en", f"src{k % 3}", len(text)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").cache()
