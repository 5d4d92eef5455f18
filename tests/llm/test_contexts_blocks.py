from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from overflight.llm import contexts, hpylm
from tests.llm.test_contexts import ROWS
from tests.llm.test_hpylm import in_training
from tests.llm.texts import documents

ODD = ["", " ", "a B  a\t\n\x0b\x0c\rX ", "É é \x1c q\x85  z\u3000y", " lead", "trail ", "x x x", "", "\x1d\x1e\x1f a"]


def test_tokens_of_many_texts():
    word, names, size = hpylm.numbered(pa.array(ODD))
    words, names = [names.to_pylist()[i] for i in word], names.to_pylist()
    assert len(set(names)) == len(names)
    cuts = np.append(0, np.cumsum(size))
    assert [words[a:b] for a, b in zip(cuts, cuts[1:])] == [hpylm.tokens(t) for t in ODD]
    a, b = contexts._own_seating(word, np.repeat(np.arange(len(size)), size), size)
    alone = [hpylm._own_seating(hpylm.tokens(t))[2:] for t in ODD]
    assert np.allclose(a, np.concatenate([x for x, _ in alone])) and np.allclose(b, np.concatenate([x for _, x in alone]))
    word, _, size = hpylm.numbered(pa.array([], pa.string()))
    assert len(word) == len(size) == 0


def test_packed_values():
    for values in (np.array([], np.int64), np.array([-5, 0, 3, 1 << 60]), np.array([0.5, -1e300])):
        assert contexts._unpacked(contexts._packed(values), values.dtype).tolist() == values.tolist()


def test_pairs_are_stored_once_and_texts_take_turns(spark, monkeypatch):
    """Neither seats nor places are written row by row, and the texts that lie shuffled at a time are a share of all."""
    kept = []

    def stored(df, name, plain=contexts.stored):
        kept.append((name, plain(df, name)))
        return kept[-1][1]

    monkeypatch.setattr(contexts, "stored", stored)
    rows = contexts.scored(documents(spark, ROWS), frequent=20, most_pairs=10).collect()
    by_pair = [name for name, df in kept if {"u", "w"} <= set(df.columns)]
    assert by_pair == ["pairs"]
    turns = [df for name, df in kept if name == "sums"]
    assert len(turns) == contexts.TURNS > 1 and all(0 < t.count() < len(rows) for t in turns)


@pytest.mark.parametrize("parts", [1, 7])
def test_pairs_counted_in_parts(spark, parts):
    """Any number of parts gives the counts of a plain loop; digests and numbers both."""
    train, seen, number = Counter(), Counter(), {b"": 0, b"w1": 1, b"w2": 2}
    key = lambda word: number.get(word, contexts._digest(word))
    for doc_id, text, _, _ in ROWS:
        words = hpylm.tokens(text or "")
        pairs = [(key(u), key(w)) for u, w in zip([b"", *words], words)]
        seen.update(pairs)
        train.update(pairs if in_training(doc_id) else ())
    texts = spark.createDataFrame([(t or "", not in_training(i)) for i, t, _, _ in ROWS], "text STRING, held_out BOOLEAN")
    got = contexts.pair_counts(texts, spark.sparkContext.broadcast(number), len(number), parts).collect()
    assert len(got) == len({(r.u, r.w) for r in got})
    assert {(r.u, r.w): r.train for r in got} == {p: n for p, n in train.items() if seen[p] > 1}
