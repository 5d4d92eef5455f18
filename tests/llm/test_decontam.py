import itertools
import random
import re

from pyspark.sql import functions as F

from overflight.llm import decontam, queries
from tests.llm.texts import EDGES, documents, prose


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING").selectExpr("*", "'z' AS item", "1 AS words")


def item(n, words=30):
    return prose(10_000 + n, words, vocabulary=5000)


def changed(text, share, seed):
    draw = random.Random(seed)
    return " ".join("changed" if draw.random() < share else w for w in text.split())


def test_passages_with_substitutions(spark):
    items = [(n, item(n)) for n in range(12)]
    texts = [(100 + n, f"{prose(n)} {changed(t, 0.1 * (n % 2), n)}. {prose(n + 50)}".upper(), "en", "a") for n, t in items]
    clean = [(200 + n, prose(n, 200, vocabulary=5000), "en", "a") for n in range(40)]
    docs, bench = documents(spark, [*texts, *clean, *EDGES]), benchmark(spark, items)
    got = decontam.overlaps(docs, bench)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(100 + n, n) for n in range(12)]
    first = {r.doc_id: r for r in got.collect()}[100]
    assert (first.first_word, first.last_word, first.identity) == (60, 89, 1.0)
    kept = decontam.cleaned(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(clean) + len(EDGES)
    shuffled = decontam.overlaps(docs, bench, many_seeds=1)  # no broadcast
    assert sorted(shuffled.collect()) == sorted(got.collect())


def test_every_pattern_of_changes_is_found(spark):
    """All ways to change three of 16 words inside a longer item, and as many words of a whole item as the identity allows."""
    words = [f"w{i}" for i in range(40)]
    rows, items = [], [(0, " ".join(words))]
    for bad in itertools.combinations(range(16), 3):
        text = [f"x{i}" if i in bad else w for i, w in enumerate(words[10:26])]
        rows.append((len(rows), " ".join(["before"] * 20 + text + ["after"] * 20), "en", "a"))
    for n, c in ((8, 1), (9, 1), (10, 2), (12, 2), (14, 2), (15, 3)):
        items.append((n, " ".join(f"v{n}y{i}" for i in range(n))))
        for bad in itertools.combinations(range(n), c):
            text = [f"x{i}" if i in bad else f"v{n}y{i}" for i in range(n)]
            rows.append((len(rows), " ".join(["before"] * 3 + text + ["after"]), "en", "a"))
    got = decontam.overlaps(documents(spark, rows, extra=False), benchmark(spark, items)).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    assert {r.identity for r in got if r.item_id == 0} == {13 / 16}


def test_too_many_changes(spark):
    words = item(1, 16).split()
    rows = [(n, " ".join(["a"] * 9 + ["x"] * n + words[n:] + ["b"] * 9), "en", "a") for n in range(6)]
    got = decontam.overlaps(documents(spark, rows), benchmark(spark, [(1, item(1, 16))]))
    assert sorted((r.doc_id, r.identity, r.first_word, r.last_word) for r in got.collect()) == [(n, (16 - n) / 16, 9, 24) for n in range(4)]


def test_common_words_as_items(spark):
    rows = [(n, f"yes and {prose(n)} no", "en", "a") for n in range(50)] + [(90, "Yes", "en", "a"), (91, "and no but so yes!", "en", "a")]
    items = [(1, "yes"), (2, "and"), (3, "and no but so yes")]
    docs, bench = documents(spark, rows), benchmark(spark, items)
    assert sorted((r.doc_id, r.item_id) for r in decontam.overlaps(docs, bench).collect()) == [(90, 1), (91, 3)]
    assert decontam.cleaned(docs, bench).count() == 50


def test_short_items_and_ends(spark):
    items = [(1, "alpha beta gamma"), (2, None), (3, ""), (4, "delta"), (5, item(5, 12)), (5, item(6, 12)), (None, item(7))]
    rows = [(1, "x alpha beta gamma y", "en", "a"), (2, "alpha beta x gamma", "en", "a"), (3, "DELTA", "en", "a"),
            (4, item(5, 12), "en", "a"), (5, item(6, 12), "en", "a"), (None, item(7), "en", "a"), (6, item(7)[: len(item(7)) // 3], "en", "a"),
            (7, "alpha beta gamma", "en", "a"), (7, "alpha beta gamma", "en", "a")]
    got = decontam.overlaps(documents(spark, rows), benchmark(spark, items)).collect()
    found = sorted(((r.doc_id, r.item_id) for r in got), key=str)
    assert found == sorted([(3, 4), (4, 5), (5, 5), (None, None), (7, 1)], key=str)


def test_empty_tables(spark):
    docs = documents(spark, EDGES)
    assert decontam.overlaps(docs, benchmark(spark, [])).collect() == []
    assert decontam.overlaps(documents(spark, []), benchmark(spark, [(1, item(1))])).collect() == []
    assert decontam.cleaned(docs, benchmark(spark, [])).count() == len(EDGES)


def test_hits_in_a_long_text_hold_only_the_words_around_them(spark, monkeypatch):
    seen, confirmed = [], decontam._confirmed
    monkeypatch.setattr(decontam, "_confirmed", lambda found, identity: seen.append(found) or confirmed(found, identity))
    passage, short, long = item(1, 20), item(2, 6), prose(3, 3000, vocabulary=5000)
    docs = documents(spark, [(1, f"{passage} {long} {passage} {short} {long} {short} {passage}", "en", "a"), (2, f"{long} {long}", "en", "a")])
    bench = benchmark(spark, [(1, passage), (2, short)])
    for many_seeds in (decontam.MANY_SEEDS, 1):
        got = {tuple(r) for r in decontam.overlaps(docs, bench, many_seeds=many_seeds).collect()}
        assert got == {(1, 1, 20, 0, 6071, 1.0), (1, 2, 6, 3040, 6051, 1.0)}
        words = [c for c, kind in seen[-1].dtypes if kind == "array<string>" and c != "item_words"]
        sizes = seen[-1].agg(F.count("*"), *[F.max(F.size(c)) for c in words]).first()
        assert sizes[0] > 100 and words and max(sizes[1:]) <= 2 * decontam.WINDOW


def test_texts_are_split_once_and_read_in_light_batches(spark, tmp_path):
    documents(spark, EDGES).write.parquet(f"{tmp_path}/documents.parquet")
    benchmark(spark, [(1, item(1))]).write.parquet(f"{tmp_path}/benchmark.parquet")
    default = spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")
    try:
        plan = queries.op8_benchmark_decontamination(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) < int(default)
    finally:
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", default)
    text = re.search(r"Relation \[doc_id#\d+L?,(text#\d+)", plan).group(1)
    assert sum("split(" in line and text in line for line in plan.splitlines()) == 1
