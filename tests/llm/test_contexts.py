import math
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from overflight.llm import contexts, hpylm
from overflight.llm.queries import QUERIES
from tests.llm.test_hpylm import base, in_training, rows_of
from tests.llm.texts import EDGES, documents, prose

ROWS = [*EDGES, *EDGES[-2:], *[(100 + i, prose(i, 5 + i * 3, vocabulary=60), "en", "a") for i in range(60)]]


def sentence(seed, words=80):
    """Every word is followed by one of two."""
    rng, at, out = random.Random(seed), seed % 50, []
    for _ in range(words):
        out.append(f"w{at}")
        at = (3 * at + rng.choice((1, 7))) % 50
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    """Scores of ROWS, and the words and the model they were made with."""
    caught = {}

    def fit(words, pairs, plain=contexts.fit):
        caught["model"], caught["words"], caught["pairs"] = plain(words, pairs), words, pairs
        return caught["model"]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(contexts, "fit", fit)
        caught["rows"] = contexts.scored(documents(spark, ROWS), frequent=20).collect()
    return caught


def test_base_and_both_ways_of_words(spark, fitted):
    docs, few = documents(spark, ROWS), fitted["rows"]
    assert sorted(rows_of(SimpleNamespace(collect=lambda: few)), key=str) == sorted(base(ROWS), key=str)
    scores = sorted((str(r.doc_id), r.n_tokens, r.score) for r in few)
    all_sent = sorted((str(r.doc_id), r.n_tokens, r.score) for r in contexts.scored(docs, frequent=100_000).collect())
    assert all(math.isfinite(s) and s < 0 for _, _, s in scores)
    assert all(a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-9) for a, b in zip(scores, all_sent))


def test_scores_by_formula(fitted):
    """Every text walked through with plain counts of the pairs and the sampled tables."""
    model, key = fitted["model"], {bytes(r.word): r.key for r in fitted["words"].collect()}
    train, seen = Counter(), Counter()
    for doc_id, text, _, _ in ROWS:
        words = hpylm.tokens(text or "")
        pairs = [(key[u], key[w]) for u, w in zip([b"", *words], words)]
        seen.update(pairs)
        train.update(pairs if in_training(doc_id) else ())
    assert {(r.u, r.w): r.train for r in fitted["pairs"].collect()} == {p: n for p, n in train.items() if seen[p] > 1}
    met = {(r.u, r.w): r.x for r in model.pairs.collect()}
    x = {p: met.get(p, 1 - model.discount) for p in train}
    assert all(n - model.discount * n - 1e-9 <= x[p] <= n - model.discount + 1e-9 for p, n in train.items())
    assert any(x[p] < n - 1.5 * model.discount for p, n in train.items())  # some dish has two tables
    figures = {r.key: r for r in contexts.word_figures(fitted["words"], model).collect()}
    samples = range(len(model.corpus))

    def corpus(u, w):
        passed = sum(math.exp(figures[u].pull[i] + figures[w].chance[i]) for i in samples)
        return (x.get((u, w), 0) + passed) / (contexts.STRENGTH + figures[u].train)

    # A previous word's distribution: what its dishes keep and what it leaves to the corpus make one.
    for u, r in figures.items():
        kept = sum(value for (before, _), value in x.items() if before == u)
        assert math.isclose(kept + sum(map(math.exp, r.pull)), contexts.STRENGTH + r.train, rel_tol=1e-9)

    def score(text):
        own, total, before = Counter(), 0.0, key[b""]
        for n, word in enumerate(hpylm.tokens(text or "")):
            kept = max(own[word] - hpylm.TEXT_DISCOUNT, 0)
            passed = hpylm.TEXT_STRENGTH + hpylm.TEXT_DISCOUNT * len(own)
            total += math.log10((kept + passed * corpus(before, key[word])) / (hpylm.TEXT_STRENGTH + n))
            own[word] += 1
            before = key[word]
        return total

    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in fitted["rows"])
    expected = sorted((str(i), len(hpylm.tokens(t or "")), score(t)) for i, t, _, _ in ROWS)
    assert all(g[:2] == e[:2] and math.isclose(g[2], e[2], rel_tol=1e-9) for g, e in zip(got, expected))


def test_pairs_sent_or_joined(spark, fitted):
    """Scores are the same however many pairs the tasks know; a place whose pair is settled in its task is not joined."""
    rows = [(0, 1, 5, 4.5), (2, 1, 3, 2.5), (1, 0, 2, 1.5), (2, 2, 2, 1.25), (-7, 1, 9, 8.5), (0, -7, 2, 1.5)]
    pairs = spark.createDataFrame(rows, "u BIGINT, w BIGINT, train BIGINT, x DOUBLE")
    for most, codes in ((0, []), (1, [1]), (3, [1, 7]), (4, [1, 3, 7, 8])):
        sent, others = contexts.sent_pairs(pairs, 3, most)
        assert sent.code.tolist() == codes and sent.whole == (most == 4)
        assert sorted(others.collect()) == sorted((u, w, x) for u, w, _, x in rows if u < 0 or w < 0 or u * 3 + w not in codes)
    known, x, stored_too = sent.met(np.array([0, 0, -7, 0, 2]), np.array([1, 2, 1, -(1 << 63), 2]))
    assert known.tolist() == [True, False, False, False, True] and x.tolist() == [4.5, 1.25]
    assert stored_too.tolist() == [False, False, True, True, False]
    few = contexts.sent_pairs(pairs, 3, 3)[0].met(np.array([0, 1, 0]), np.array([1, 0, 2]))
    assert few[0].tolist() == [True, False, False] and few[2].tolist() == [False, True, True]
    scores = sorted((str(r.doc_id), r.n_tokens, r.score) for r in fitted["rows"])
    for most in (0, 300):
        got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in contexts.scored(documents(spark, ROWS), 100_000, most).collect())
        assert all(a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-9) for a, b in zip(scores, got, strict=True))


def test_customers_of_the_corpus_are_the_tables_of_the_pairs(fitted):
    model = fitted["model"]
    for corpus, spare in zip(model.corpus, model.spare):
        total = spare.selectExpr("sum(of_context)", "sum(of_dish)").first()
        assert total[0] == total[1] == model.total - corpus.total > 0


def test_query_minds_the_order_of_words(spark, tmp_path):
    """Held-out texts beat their own words shuffled, and a model without previous words."""
    held = [i for i in range(2000) if not in_training(i)][:60]
    rows = [(i, " ".join(sentence(i)), "en", "a") for i in range(2000) if in_training(i)][:300]
    for i in held[:30]:
        rows.append((i, " ".join(sentence(i)), "en", "a"))
    for i, of in zip(held[30:], held[:30]):
        rows.append((i, " ".join(random.Random(i).sample(sentence(of), 80)), "en", "a"))
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    score = {r.doc_id: r.score for r in QUERIES["op4_lm_scoring"](spark, str(tmp_path)).collect()}
    without = {r.doc_id: r.score for r in hpylm.scored(docs).collect()}
    assert all(score[i] > score[j] for i, j in zip(held[:30], held[30:]))
    assert all(score[i] > without[i] for i in held[:30])


def test_long_words_and_no_training_text(spark):
    held = next(i for i in range(100) if not in_training(i))
    r, = contexts.scored(documents(spark, [(held, "a b", "en", "a")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and math.isfinite(r.score)
    assert contexts.scored(documents(spark, [])).collect() == []
    learnt = next(i for i in range(100) if in_training(i))
    long = documents(spark, [(learnt, "a b", "en", "a"), (held, "é" * 5000 + " b", "en", "a")])
    assert all(math.isfinite(r.score) for r in contexts.scored(long, frequent=0).collect())
