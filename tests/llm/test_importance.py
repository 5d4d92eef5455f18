import hashlib
import math
import zlib
from collections import Counter

import pytest

from overflight.llm import importance
from tests.llm.texts import EDGES, alnum_words, documents, prose

BENCHMARK = [(1, "mit license in words", 0), (2, None, 0), (3, prose(40), 0), (4, "", 0)]
COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")


def wanted(rows, target, longest=2, buckets=10_000, percent=25, least=20):
    def features(text):
        words = alnum_words(text)
        return [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    source, aim = Counter(), Counter()
    for row in rows:
        source.update(features(row[1]))
    for text in target:
        aim.update(features(text))
    s, t = sum(source.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1.0) * (s + float(buckets)) / ((source[b] + 1.0) * (t + float(buckets)))))
    scored = []
    for row in rows:
        held = features(row[1])
        weight = sum(map(gain, held)) // len(held) if held else 0
        h = int(hashlib.sha256(f"7:{'' if row[0] is None else row[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((len(alnum_words(row[1])) >= least, row[0], len(held), weight, score))
    able = sorted((r for r in scored if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    due = len(able) * percent // 100
    return [(*r[1:], i + 1 if i < due else None) for i, r in enumerate(able)] + [(*r[1:], None) for r in scored if not r[0]]


def found(spark, rows, target=BENCHMARK, **options):
    items = spark.createDataFrame(target, "item_id BIGINT, text STRING, bucket INT")
    df = documents(spark, rows).selectExpr("*", "1 AS weight", "2 AS score", "3 AS rank", "4 AS bucket", "5 AS n")
    return sorted((tuple(r) for r in importance.resample(df, items, **options).select(*COLUMNS).collect()), key=str)


ROWS = EDGES + [(i, prose(i, words=5 + i), "en", "a") for i in range(20, 90)] + [(20, prose(20, words=25), "en", "a")] * 3


@pytest.mark.parametrize("longest,piece", [(1, 1 << 20), (2, 1 << 20), (2, 40), (3, 40), (3, 1)])
def test_against_strings(spark, monkeypatch, longest, piece):
    monkeypatch.setattr(importance, "PIECE", piece)
    rows = ROWS if piece > 1 else ROWS[:9] + ROWS[10:30]
    got = found(spark, rows, longest=longest, percent=40)
    assert got == sorted(wanted(rows, [t for _, t, _ in BENCHMARK], longest, percent=40), key=str)
    assert sum(r[-1] is not None for r in got) == 40 * sum(len(alnum_words(r[1])) >= 20 for r in rows) // 100


def test_ties_and_repeated_rows(spark):
    rows = [(i % 5, "same words " * 12, "en", "a") for i in range(40)]
    got = found(spark, rows)
    assert sorted(r[-1] for r in got if r[-1]) == list(range(1, 11))
    assert got == sorted(wanted(rows, [t for _, t, _ in BENCHMARK]), key=str)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, ROWS[:12], target=[]) == sorted(wanted(ROWS[:12], []), key=str)


def test_bytes():
    text = "Ab,cD\té ÀB x\x7f1_2".encode()
    assert [w for words in importance.pieces(text) for w in words] == [w.encode() for w in alnum_words(text.decode())]


def test_few_files(spark, monkeypatch):
    """Each file costs an executor a few processes; the parts of a sort may share one."""
    held = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    items = spark.createDataFrame(BENCHMARK, "item_id BIGINT, text STRING, bucket INT")
    rows = [(i, prose(i, words=15 + i % 9), "en", "a") for i in range(200)]
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        monkeypatch.setattr("overflight.llm.common.ROWS_PER_FILE", 50)
        monkeypatch.setattr(importance, "ROWS_PER_FILE", 50)
        df = importance.resample(documents(spark, rows).repartition(40), items)
        assert df.rdd.getNumPartitions() == 1
        files = [f.split("/")[-2].split("-")[0] for f in df.inputFiles()]
        able = sum(len(alnum_words(r[1])) >= 20 for r in rows)
        assert Counter(files) == {"weights": 5, "ranked": able // 50 + 1}
        assert sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str) == sorted(
            wanted(rows, [t for _, t, _ in BENCHMARK]), key=str)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
