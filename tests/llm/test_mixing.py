from collections import Counter

import pandas as pd

from overflight.llm import mixing
from tests.llm.texts import EDGES, documents, prose, space_words


def expected_targets(size):
    named = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(named)}
    total, held = 1.5 * sum(size.values()), set()
    while True:
        left = total - sum(2 * size[s] for s in held)
        share = sum(weight[s] for s in named if s not in held)
        target = {s: 2 * size[s] if s in held else left * weight[s] / share for s in named}
        over = {s for s in named if s not in held and target[s] > 2 * size[s]}
        if not over:
            return target
        held |= over


def corpus():
    rows = [(i, prose(i, 40 + i * 7 % 900), "en", ["a", "b", "c", None, "B"][i % 5 if i % 3 else 0]) for i in range(300)]
    return rows + [(1000 + i, t, lang, source) for i, (_, t, lang, source) in enumerate(EDGES)]


def test_mix(spark):
    rows = corpus()
    docs = documents(spark, rows)
    got = mixing.mix(docs).collect()
    size = {i: len(space_words(t)) for i, t, _, _ in rows}
    source = {r[0]: r[3] for r in rows}
    of = Counter()
    for i, n in size.items():
        of[source[i]] += n
    target, taken = expected_targets(of), Counter()
    assert Counter((r.doc_id, r.size) for r in got) == Counter(size.items())
    for r in got:
        assert r.source_size == of[source[r.doc_id]] and abs(r.target - target[source[r.doc_id]]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= mixing.BLOCK for s in of)
    assert sorted(mixing.mix(docs.repartition(5)).collect()) == sorted(got)

    out = mixing.mixed(docs)
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(space_words(r.text))
    assert out.columns == docs.columns
    assert words == Counter({r.doc_id: r.taken for r in got if r.taken})


def test_equal_rows_and_null_ids(spark):
    got = mixing.mix(documents(spark, EDGES))
    assert sorted(((r.doc_id, r.size) for r in got.collect()), key=str) == sorted(((r[0], len(space_words(r[1]))) for r in EDGES), key=str)
    assert mixing.mixed(documents(spark, EDGES)).count() > 0


def test_columns_of_any_name_pass_through(spark):
    docs = documents(spark, EDGES).selectExpr("*", "doc_id AS round", "1 AS _size", "2 AS _source", "3 AS _id1", "4 AS _row", "5 AS _taken", "6 AS first")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert all((r["round"], r["_size"], r["first"]) == (r.doc_id, 1, 6) for r in out.collect())


def test_permutation_is_one():
    permuted = mixing._permuted.func
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        out = permuted(pd.Series(range(n)), pd.Series([n] * n), pd.Series([-5 + n] * n))
        assert sorted(out) == list(range(n))
        assert n < 50 or list(out) != list(range(n))


def test_slots_are_exact_and_spread(spark):
    rows = [("=a", 4000, 3000, 6000), ("=b", 500, 1500, 1000), ("=c", 10, 7, 20), ("=d", 0, 0, 0)]
    sources = spark.createDataFrame([(s, n, b, k, 0.0) for s, n, b, k in rows],
                                    "_source STRING, source_size BIGINT, blocks BIGINT, slots BIGINT, target DOUBLE")
    got = mixing.slots(sources, shard=500).collect()
    assert len({(r.shard, r.slot) for r in got}) == len(got) == 7020
    times = Counter((r._source, r.block, r.round) for r in got)
    assert max(times.values()) == 1
    assert Counter(r._source for r in got) == Counter({s: k for s, _, _, k in rows if k})
    per_shard = Counter((r.shard, r._source) for r in got)
    assert all(abs(per_shard[s, "=a"] - 427) < 80 for s in range(14))


def test_empty(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert mixing.mixed(documents(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix(documents(spark, [(1, None, "en", "a"), (2, " ", "en", None)])).collect()] == [0, 0]
