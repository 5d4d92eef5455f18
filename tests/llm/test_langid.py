import itertools
import math
import random
import zlib

import numpy as np

from overflight.llm import langid
from tests.llm.texts import EDGES, documents

WORDS = {
    "aa": "the house and garden with some things that were there".split(), "bb": "der garten und das haus mit einigen dingen".split(),
    "cc": "el jardín y la casa con algunas cosas que estaban".split(),
}


def text(lang, seed, n=40):
    draw = random.Random(f"{lang}{seed}")
    return " ".join(draw.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


def corpus(n=90):
    return [(i, text(lang, i), lang, "s") for i in range(n) for lang in [sorted(WORDS)[i % 3]]]


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_documents(spark):
    rows = corpus()
    got = langid.identified(documents(spark, rows)).collect()
    assert {r.doc_id: r.held_out for r in got} == {i: held_out(i) for i, *_ in rows}
    assert all(r.lang_pred == rows[r.doc_id][2] and 0.9 < r.score <= 1 for r in got)


def test_mixtures(spark):
    langs, model = langid.train(documents(spark, corpus()))
    lang, score, listed = langid.predict(text("aa", 1, 120) + " " + text("bb", 2, 60), langs, model)
    assert lang == "aa" and abs(score - 2 / 3) < 0.1 and [p.split("=")[0] for p in listed.split(",")] == ["aa", "bb"]
    assert langid.predict("123 !? ...", langs, model) == ("und", 0.0, "")
    assert langid.predict(text("cc", 3, 20_000), langs, model)[0] == "cc"
    assert langid.predict("the house", [], np.empty((0, langid.BUCKETS), np.float32)) == ("und", 0.0, "")


def plain_em(rows, columns, steps=4000):
    """Proportions by expectation-maximisation, in lists, run to convergence."""
    share = [1 / len(columns)] * len(columns)
    for _ in range(steps):
        sums = [0.0] * len(columns)
        for row in rows:
            weights = [s * row[c] for s, c in zip(share, columns)]
            for i, w in enumerate(weights):
                sums[i] += w / sum(weights)
        share = [s / len(rows) for s in sums]
    return share, sum(math.log(sum(s * row[c] for s, c in zip(share, columns))) for row in rows)


def test_mixture_against_plain_em():
    """The chosen set is the best of all sets by penalised likelihood, with the proportions of a plain EM."""
    draw = np.random.default_rng(3)
    for languages, truth, n in ((3, [0.7, 0.3, 0.0], 60), (3, [1.0, 0.0, 0.0], 50), (4, [0.4, 0.35, 0.25, 0.0], 80), (2, [0.5, 0.5], 40)):
        spoken = draw.choice(languages, size=n, p=truth)
        scores = draw.normal(-14, 1.5, (n, languages))
        scores[np.arange(n), spoken] += 9
        rows = np.exp(np.maximum(scores - scores.max(axis=1)[:, None], -20)).tolist()
        cost = langid.PENALTY * math.log(n + 1) / 2
        best = max(
            (value - cost * (len(columns) - 1), columns, share)
            for size in range(1, languages + 1) for columns in itertools.combinations(range(languages), size)
            for share, value in [plain_em(rows, columns, 400)])
        chosen, share = langid.mixture(scores)
        assert sorted(chosen.tolist()) == list(best[1])
        assert all(abs(share[chosen.tolist().index(c)] - s) < 0.01 for c, s in zip(best[1], best[2]))


def test_a_tie_goes_to_the_first_language():
    model = np.log(np.full((2, langid.BUCKETS), 1 / langid.BUCKETS, dtype=np.float32))
    assert langid.predict("some words", ["aa", "bb"], model)[:2] == ("aa", 1.0)


def test_labels_are_learned_only_outside_the_fold(spark):
    rows = corpus()
    lied = [(i, t, "zz" if held_out(i) else lang, s) for i, t, lang, s in rows] + [(500, None, "yy", "s"), (501, "the", None, "s")]
    assert langid.train(documents(spark, lied))[0] == ["aa", "bb", "cc"]
    got = {r.doc_id: r.lang_pred for r in langid.identified(documents(spark, lied)).collect()}
    assert all(got[i] == lang for i, _, lang, _ in rows) and got[500] == "und"


def test_edges(spark):
    got = langid.identified(documents(spark, EDGES)).collect()
    assert len(got) == len(EDGES) and all(r.lang_pred == "und" for r in got if r.doc_id in (1, 2, 3))
    assert langid.identified(documents(spark, [])).collect() == []
    assert [r.lang_pred for r in langid.identified(documents(spark, [(1, "words", None, None)])).collect()] == ["und"]


def test_grams_count_each_word():
    buckets, starts = langid.grams("Ab, c")
    # ab: a b _a ab b_ _ab ab_ _ab_ ; c: c _c c_ _c_
    assert len(buckets) == 12 and starts.tolist() == [0, 8]
    assert sorted(buckets[:8]) == sorted(langid.grams("ab")[0])
