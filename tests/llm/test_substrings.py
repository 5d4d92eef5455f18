import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from overflight.llm import substrings
from tests.llm.texts import EDGES, documents


def wanted(rows, length):
    """Brute force: (id, words, removed words, hash of the rest)."""
    words = [(r[1] or "").encode().split() for r in rows]
    times = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for row, w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if times[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((row[0], len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = documents(spark, rows).selectExpr("*", "1 AS key", "2 AS digest", "3 AS copies", "4 AS start", "5 AS ranges")
    return sorted((tuple(r) for r in substrings.digests(df, **options).collect()), key=str)


def corpus():
    draw = random.Random(3)
    shared = [" ".join(f"p{k}_{i}" for i in range(50)) for k in range(3)]
    rows = []
    for d in range(100, 200):
        text = " ".join(draw.choice("abcdefgh") + str(draw.randrange(30)) for _ in range(draw.randrange(200)))
        if d % 3 == 0:
            cut = draw.randrange(len(text) + 1)
            text = f"{text[:cut]} {shared[draw.randrange(3)][draw.randrange(40):]} {text[cut:]}"
        if d % 7 == 0:
            text += " é x " + "rep eat " * draw.randrange(60)
        rows.append((d, text, "en", "a"))
    same = rows[3][1]
    rows += [(100, rows[0][1], None, None), (100, rows[1][1], None, None), (300, same, None, None), (None, same, None, None)]
    rows += [(301, rows[9][1].replace(" ", "\n\t"), None, None), (302, rows[12][1].upper(), None, None)]
    return rows + [(400 + n, "z " * n, None, None) for n in (34, 35, 36, 70)] + [(500, "y " * 35, None, None)] + EDGES


@pytest.mark.parametrize("many", [2000, 1])  # occurrences from which a prefix is lengthened to the window
@pytest.mark.parametrize("length", [35, 10])
def test_against_brute_force(spark, monkeypatch, many, length):
    monkeypatch.setattr(substrings, "MANY", many)
    monkeypatch.setattr(substrings, "MANY_ANCHORS", 5 if many == 1 else 500_000)
    monkeypatch.setattr(substrings, "BIN_WORDS", 500)
    rows = corpus()
    got = found(spark, rows, length=length)
    assert got == wanted(rows, length)
    assert 0 < sum(r[2] for r in got) < sum(r[1] for r in got)


def test_equal_texts(spark):
    rows = [(i % 7, "k " + "w" * 5 + " v" * 40, "en", "a") for i in range(60)] + [(9, "short text", "en", "a")] * 2
    assert found(spark, rows) == wanted(rows, 35)


def test_removed_spans(spark):
    passage = " ".join(f"q{i}" for i in range(40))
    rows = [(1, f"a b {passage} c", "en", "a"), (2, f"{passage} d", "en", "a")]
    got = {r.doc_id: (r.kept_text, [tuple(s) for s in r.removed]) for r in substrings.cleaned(documents(spark, rows)).collect()}
    assert got == {1: ("a b c", [(2, 41)]), 2: ("d", [(0, 39)])}


def test_runs_cover_each_window_once():
    draw = random.Random(1)
    words = [bytes([97 + draw.randrange(3)]) for _ in range(400)]
    _, starts, sizes, own = substrings.runs(words, 9, 4)
    covered = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, sizes)])
    windows = [tuple(words[i:i + 9]) for i in range(392)]
    assert sorted(covered) == [i for i, w in enumerate(windows) if w not in windows[:i]]
    assert own.tolist() == [i for i, w in enumerate(windows) if windows.count(w) > 1]


def test_empty_table(spark):
    assert found(spark, []) == []
