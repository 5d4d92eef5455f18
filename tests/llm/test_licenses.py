import random

from overflight.llm import licenses
from tests.llm.texts import EDGES, alnum_words, documents, prose


def base(text):
    words = alnum_words(text)
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def test_base_places(spark):
    rows = [*EDGES, (30, "The MIT License. mit-license MIT\nLICENSE; Apache  License, cc by cc by", "en", "a"),
            (31, "GNU general public license GNU GENERAL public x license", "en", "a"), (32, "mİt license apacKe license", "en", "a"),
            (33, "mit license " * 5000, "en", "a"), (34, "cc", "en", "a"), (35, "by cc", "en", "a")]
    got = licenses.scan(documents(spark, rows)).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str)
    assert found == sorted(((i, *base(text)) for i, text, _, _ in rows), key=str)
    assert all((r.score == 1.0) == (r.n_base > 0) for r in got if r.score in (0.0, 1.0))


def test_notices_with_changes(spark):
    notice = max(licenses.NOTICES, key=len)
    label, words = licenses.NOTICES[notice], notice.split()
    changed = words[:10] + words[11:20] + ["new"] + words[20:]  # one word left out, one put in
    half = words[: len(words) // 2]
    rows = [(i, f"{prose(i)} {' '.join(w)} {prose(i + 9)}", "en", "a") for i, w in enumerate([words, changed, half])]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert got[0].labels == label and got[0].score == 1.0 and got[0].n_notices == 1
    assert got[1].labels == label and 0.75 <= got[1].score < 1.0 and got[1].n_notices == 1
    assert got[2].labels == "" and got[2].score == 0.0


def test_repeated_and_unordered_parts_do_not_add_up(spark):
    notice = "licensed under the apache license version 2 0"
    other = max(licenses.NOTICES, key=len).split()
    turned = other[len(other) // 2:] + other[:len(other) // 2]
    rows = [(0, "licensed under the " * 6, "en", "a"), (1, notice, "en", "a"), (2, f"{notice} {prose(1, 9)} {notice}", "en", "a"),
            (3, " ".join(turned), "en", "a"), (4, "licensed under the the the apache license version 2 0", "en", "a"),
            (5, " ".join(f"{w} {w}" for w in other), "en", "a")]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert (got[0].labels, got[0].score) == ("", 0.0)
    assert (got[1].labels, got[1].score, got[1].n_notices) == ("apache,apache-2.0", 1.0, 1)
    assert (got[2].labels, got[2].n_notices) == ("apache,apache-2.0", 2)
    assert got[3].labels == got[5].labels == ""
    assert "apache-2.0" in got[4].labels


def series(words, template, drift):
    """The longest rising series of k-grams, by brute force, over every span of diagonals."""
    size = template.gram
    met = sorted((q, p) for q in range(template.grams) for p in range(len(words) - size + 1)
                 if tuple(words[p:p + size]) == template.words[q:q + size])
    best = 0
    for start in {p - q for q, p in met}:
        chain = {}
        for q, p in met:
            if 0 <= p - q - start <= drift:
                chain[q, p] = 1 + max((n for (a, b), n in chain.items() if a < q and b < p), default=0)
        best = max(best, *chain.values())
    return best / template.grams


def test_scores_by_brute_force(spark):
    draw, texts = random.Random(2), []
    for n in range(150):
        words = draw.choice(list(licenses.NOTICES)).split()
        for _ in range(draw.randrange(6)):
            at = draw.randrange(len(words))
            words[at:at + draw.randrange(3)] = draw.choice([[], ["new"], words[at:at + 4] * 2, ["a", "b"]])
        texts.append(" ".join(words))
    got = {r.doc_id: r for r in licenses.scan(documents(spark, [(n, t, "en", "a") for n, t in enumerate(texts)])).collect()}
    listed = licenses.templates()
    for n, text in enumerate(texts):
        words = alnum_words(text)
        scores = {t: series(words, t, 0 if t.whole else licenses.DRIFT) for t in listed if series(words, t, licenses.DRIFT)}
        held = {t: s for t, s in scores.items() if s >= (1 if t.whole else licenses.COVERAGE)}
        assert got[n].labels == ",".join(sorted({t.label for t in held}))
        assert abs(got[n].score - max(held.values(), default=0)) < 1e-12


def test_empty_table(spark):
    assert licenses.scan(documents(spark, [])).collect() == []


def test_rows_come_in_few_partitions(spark, monkeypatch):
    """Each partition is a file, and each file costs an executor a few processes."""
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    rows = [(n, f"{prose(n)} mit license", "en", "a") for n in range(50)]
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        monkeypatch.setattr("overflight.llm.common.in_files.__defaults__", (20,))
        found = licenses.scan(documents(spark, rows).repartition(30))
        assert found.rdd.getNumPartitions() == 3
        assert sorted((r.doc_id, r.n_base) for r in found.collect()) == [(n, 1) for n in range(50)]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
