import math
import zlib
from collections import Counter

import numpy as np

from overflight.llm import hpylm
from tests.llm.texts import EDGES, documents, lowered, prose, space_words


def in_training(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 7 != 2


def base(rows):
    tokens = [(i, [*space_words(lowered(t)), None]) for i, t, _, _ in rows]
    count = Counter(w for i, words in tokens if in_training(i) for w in words)
    total = sum(count.values())
    return [(i, not in_training(i), len(words), sum(count[w] > 0 for w in words), total,
             round(sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in words), 6)) for i, words in tokens]


def rows_of(df):
    return [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()]


def test_base_and_order(spark):
    rows = [*EDGES, *[(100 + i, prose(i, 5 + i * 3), "en", "a") for i in range(60)]]
    docs = documents(spark, rows)
    few = hpylm.scored(docs, frequent=20)
    assert sorted(rows_of(few), key=str) == sorted(base(rows), key=str)
    scores = {(r.doc_id, round(r.base_score, 6)): r.score for r in few.collect()}
    assert all(math.isfinite(s) and s < 0 for s in scores.values())
    for r in hpylm.scored(docs, frequent=100_000).collect():  # all words sent, none joined
        assert math.isclose(r.score, scores[r.doc_id, round(r.base_score, 6)], rel_tol=1e-9)


def test_beats_the_base_on_held_out_texts(spark):
    # Three sets of words, one per text.
    rows = [(i, prose(i, 300, vocabulary=60).translate(str.maketrans("klmnopqr", ["klmnopqr", "stuvwxyz", "éèàùêâîô"][i % 3])), "en", "a")
            for i in range(150)]
    table = {r.held_out: r for r in hpylm.perplexity(hpylm.scored(documents(spark, rows))).collect()}
    assert table[True].perplexity < table[True].base_perplexity


def test_seating_follows_the_restaurant_rule():
    """Mean number of tables against the process itself, one dish, other tables given."""
    rng, pull, discount, parent = np.random.default_rng(1), 5.0, 0.6, 0.3
    for count in (1, 2, 10, 200):
        plain = []
        for _ in range(1500):
            tables = 1
            for seats in range(1, count):
                tables += rng.random() < pull * parent / (pull * parent + seats - discount * tables)
            plain.append(tables)
        n = 4000
        keys = rng.integers(0, 1 << 62, n).astype(np.uint64)
        got = hpylm.seated(np.full(n, float(count)), np.full(n, parent), np.full(n, pull), discount, keys, 1)
        assert got.min() >= 1 and got.max() <= count
        assert abs(got.mean() - np.mean(plain)) < 0.15 * np.mean(plain)


def test_spelling_probabilities_sum_to_one():
    words = [b"abc", b"abd", b"xab", "é".encode(), b""] * 3
    context, symbol, _ = hpylm.spelled(words)
    dishes, n = np.unique(context[-1] * hpylm.SYMBOLS + symbol, return_counts=True)
    model = hpylm.Spelling()
    for sweep in range(3):
        model = hpylm.resampled(dishes, n.astype(float), model, sweep)
    for word in (b"ab", b"zz", b""):
        ahead = [c[-1:] for c in hpylm.spelled([word])[0]]
        total = model.probability([np.repeat(c, hpylm.SYMBOLS) for c in ahead], np.arange(hpylm.SYMBOLS))
        assert math.isclose(total.sum(), 1, rel_tol=1e-9)
    assert model.log_words([b"abc"])[0] > model.log_words([b"cba"])[0]
    assert model.log_words([]).tolist() == []


def test_own_seating_sums_to_one():
    words = [b"a", b"b", b"a", b"c", b"a", b""]
    _, dish, a, b = hpylm._own_seating(words)
    for i in range(len(words)):
        seen = Counter(dish[:i].tolist())
        total = sum((n - hpylm.TEXT_DISCOUNT) / (hpylm.TEXT_STRENGTH + i) for n in seen.values()) + b[i]
        assert math.isclose(total, 1)
        assert math.isclose(a[i], max(0, seen[dish[i]] - hpylm.TEXT_DISCOUNT) / (hpylm.TEXT_STRENGTH + i) if seen[dish[i]] else 0)


def test_scores_of_documents_by_formula(spark):
    """A document's score from the corpus probabilities and a restaurant of its own that is walked through token by token."""
    rows = [*EDGES[:7], *[(100 + i, prose(i, 5 + i * 3, vocabulary=40), "en", "a") for i in range(40)]]
    docs = documents(spark, rows)
    texts = docs.selectExpr("text", "pmod(crc32(cast(coalesce(cast(doc_id as string), '') as binary)), 7) = 2 AS held_out").na.fill("")
    words = hpylm.stored(hpylm.vocabulary(texts), "vocabulary")
    model = hpylm.fit(words)
    listed = words.toPandas()
    corpus = dict(zip(map(bytes, listed.word), model.log10_words(list(map(bytes, listed.word)), listed.train.to_numpy(float))))

    def score(text):
        seated, total = Counter(), 0.0
        for n, word in enumerate(hpylm.tokens(text or "")):
            own = max(seated[word] - hpylm.TEXT_DISCOUNT, 0)
            passed = hpylm.TEXT_STRENGTH + hpylm.TEXT_DISCOUNT * len(seated)
            total += math.log10((own + passed * 10 ** corpus[word]) / (hpylm.TEXT_STRENGTH + n))
            seated[word] += 1
        return total

    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in hpylm.scored(docs, frequent=15).collect())
    expected = sorted((str(i), len(hpylm.tokens(t or "")), score(t)) for i, t, _, _ in rows)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert all(math.isclose(g[2], e[2], rel_tol=1e-9) for g, e in zip(got, expected))


def test_without_training_text(spark):
    held = next(i for i in range(100) if not in_training(i))
    r, = hpylm.scored(documents(spark, [(held, "a b", "en", "a")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and math.isfinite(r.score)
    assert hpylm.scored(documents(spark, [])).collect() == []
