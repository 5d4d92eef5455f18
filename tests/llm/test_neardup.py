import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from overflight.llm import neardup
from tests.llm.texts import EDGES, documents, prose, space_words, lowered


def sets_of(rows, size):
    out = defaultdict(list)
    for i, text, *_ in rows:
        w = space_words(lowered(text))
        out[i].append(frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, size, percent):
    """Every pair that shares a shingle, by counting."""
    sets = [(i, s) for i, found in sets_of(rows, size).items() for s in found if i is not None]
    lists, root = defaultdict(list), {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (_, s) in enumerate(sets):
        for g in s:
            lists[g].append(n)
    for n, (i, s) in enumerate(sets):
        for m, both in Counter(m for g in s for m in lists[g] if m > n).items():
            a, b = find(i), find(sets[m][0])
            if 100 * both >= percent * (len(s) + len(sets[m][1]) - both) and a != b:
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def check(spark, rows, size, percent):
    got = neardup.clustered(documents(spark, rows), size, percent).collect()
    wanted = brute(rows, size, percent)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == wanted.get(r.doc_id) and r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(s)) for i, found in sets_of(rows, size).items() for s in found)


@pytest.mark.parametrize("size, percent, block, sent", [(3, 85, 400, 500_000), (5, 80, 400, 500_000), (5, 80, 60, 0)])
def test_components_equal_brute_force(spark, monkeypatch, size, percent, block, sent):
    monkeypatch.setattr(neardup, "BLOCK", block)  # large groups are cut into parts
    monkeypatch.setattr(neardup, "MANY_NODES", sent)  # with 0 nothing is broadcast
    draw = random.Random(3)
    base, rows = prose(1, 120, 3000).split(), []
    for _ in range(500):  # near copies of a text that is not itself there
        words = list(base)
        for _ in range(draw.randrange(1, 9)):
            words[draw.randrange(len(words))] = draw.choice(["x", "y", "z"]) + str(draw.randrange(999))
        rows.append(" ".join(words))
    rows += [" ".join(base[:60]) + " " + prose(draw.randrange(10**9), draw.randrange(3, 30)) for _ in range(200)]  # a shared passage
    rows += [" ".join(base)] * 300 + [" ".join(base).upper()] * 20
    for k in range(150):  # short texts with one changed word
        words = prose(1000 + k, draw.randrange(1, 14)).split()
        rows += [" ".join(words), " ".join([*words[:-1], "changed"])]
    draw.shuffle(rows)
    check(spark, [(i, t, "en", "a") for i, t in enumerate(rows)], size, percent)


def test_edges_and_repeated_ids(spark):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [*EDGES, (50, a, "en", "a"), (51, a, "en", "a"), (52, b, "en", "a"), (51, b, "en", "a"), (60, c, "en", "a"), (61, c, "en", "a"), (None, c, "en", "a")]
    check(spark, rows, 3, 85)


def test_chain_of_copies(spark):
    words, rows = prose(9, 200, 5000).split(), []
    for i in range(60):  # each like the next, the ends unlike
        words = words[:i * 3] + [f"new{i}"] + words[i * 3 + 1:]
        rows.append((i, " ".join(words), "en", "a"))
    check(spark, rows, 3, 85)


def test_one_of_each_group_stays(spark):
    rows = [*EDGES, (50, prose(5), "en", "a"), (51, prose(5), "en", "a"), (40, prose(5) + " x", "en", "a"), (70, prose(6), "en", "a"), (70, prose(6), "en", "a")]
    kept = neardup.deduplicated(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    found = Counter(r.doc_id for r in kept.collect())
    assert found[40] == found[70] == 1 and 50 not in found and 51 not in found and found[None] == 1 and found[1] == 1


def test_components_of_links(spark):
    draw = random.Random(4)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(50)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in neardup.components(spark.createDataFrame(pairs, "a BIGINT, b BIGINT")).collect()}
    assert got == {i: find(i) for pair in pairs for i in pair if pair[0] != pair[1]}


def test_signature_and_sets():
    many = np.arange(10_000, dtype=np.uint64)
    assert (neardup.signature(many) == np.minimum(neardup.signature(many[:5000]).view(np.uint32), neardup.signature(many[5000:]).view(np.uint32)).view(np.int32)).all()
    assert neardup.jaccard(many[:10], many[5:20]) == (5, 20) and neardup.jaccard(many[:0], many[:3]) == (0, 3)
    assert len(neardup.shingles("a b c a b c a b c", 3)) == 3 and len(neardup.shingles("a", 3)) == 1 and not len(neardup.shingles(" ", 3))


def test_empty_table(spark):
    assert neardup.clustered(documents(spark, [])).collect() == []
    assert neardup.deduplicated(documents(spark, [])).collect() == []
