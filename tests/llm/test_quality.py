import math
import random
from collections import Counter

from overflight.llm import quality
from tests.llm.texts import EDGES, documents, prose, space_words


def base(text):
    words, text = space_words(text), text or ""
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if space_words(line)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
            len(words) < 10 or 100 * len(repeated) > 20 * len(words))


def tail(n, k, p):
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")


def test_measures(spark):
    rows = [*EDGES, (20, "a b c d e f\n" * 3 + "a b c d e\n \nx", "en", "a"), (21, "## $$ <b> " + prose(4), "en", "a"),
            (22, "a b c d e " * 4, "en", "a"), (23, "l1 x\nl1 x\n l1 x\nl1 x", "en", "a")]
    got = quality.judged(documents(spark, rows), labels(spark, [(None, 1, 0), (6, None, 0), (99, 1, 0)])).collect()
    assert len(got) == len(rows)
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert found == Counter((i, *base(text)) for i, text, _, _ in rows)
    assert all(r.kept is (not r.base_failed) and r.rejected_by == 0 for r in got)  # too few labels to reject anything


def test_accepted_keeps_columns_and_clean_documents(spark):
    junk = [(i, prose(i).upper().replace(" ", "!! ") + "!!", "en", "a") for i in range(50)]
    clean = [(1000 + i, prose(i), "en", "a") for i in range(700)]
    docs = documents(spark, junk + clean + [(5000, None, None, None)])
    kept = quality.accepted(docs, labels(spark, [(d[0], int(d[0] >= 1000), 0) for d in junk + clean]), risk=0.02)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d[0] for d in clean]


def test_empty_tables(spark):
    none = labels(spark, [])
    assert quality.judged(documents(spark, []), none).collect() == []
    assert quality.accepted(documents(spark, [(1, prose(1), "en", "a")]), none).count() == 1


def test_each_rule_has_its_own_cutoff(spark):
    """Good documents that the base rule rejects, and a rule that good documents exceed, do not hold up the symbol rule."""
    clean = [(i, prose(i), "en", "a") for i in range(700)]
    lines = [(1000 + i, "\n".join([prose(1000 + i)[:90], "same line", "same line", "same line"]), "en", "a") for i in range(40)]
    repeated = [(2000 + i, "same five words here again " * 9, "en", "a") for i in range(30)]
    junk = [(3000 + i, prose(i).replace(" ", " #$ "), "en", "a") for i in range(60)]
    docs = documents(spark, clean + lines + repeated + junk)
    marks = [(d[0], int(d[0] < 3000), 0) for d in clean + lines + repeated + junk[:30]]
    clash = docs.selectExpr("*", "1 AS _key", "2 AS _q", "3 AS _by", "4 AS _row", "5 AS _m", "6 AS _cutoffs", "7 AS _words")
    accepted = quality.accepted(clash, labels(spark, marks))
    assert accepted.columns == clash.columns
    kept = sorted(r.doc_id for r in accepted.collect())
    assert kept == [d[0] for d in clean + lines]
    told = {r.doc_id: r.kept for r in quality.judged(clash, labels(spark, marks)).collect()}
    assert sorted(d for d, keep in told.items() if keep) == kept


def test_certified_rules(spark):
    """The order and its tests by brute force; all rules together stay within the risk."""
    risk, error, draw = 0.05, 0.1, random.Random(1)
    rows, marks = [], []
    for lang, n in (("en", 900), ("de", 300), ("fr", 20)):
        for _ in range(n):
            quality_label = draw.choice([1, 1, 1, 0, None])
            often = (0.01, 0.0, 0.02, 0.004, 0.0, 0.01, 0.0, 0.05) if quality_label != 0 else (0.6, 0.0, 0.1, 0.2, 0.0, 0.0, 0.3, 0.0)
            steps = [draw.randint(1, 8) if draw.random() < p else None for p in often]
            if quality_label is not None:
                marks.append((len(rows), quality_label, 0))
            rows.append((len(rows), lang, steps))
    got = {r.stratum: r.cutoffs for r in quality.certified_rules(
        spark.createDataFrame(rows, "doc_id BIGINT, stratum STRING, steps ARRAY<INT>"), labels(spark, marks), risk, error).collect()}
    known = {doc: label for doc, label, _ in marks}
    hits = lambda steps, rule, level: steps[rule] is not None and steps[rule] <= level
    for lang in ("en", "de", "fr"):
        good, bad, other = ([s for i, name, s in rows if name == lang and known.get(i) == k] for k in (1, 0, None))
        path = []
        for rule in range(8):
            for level in range(1, 9):
                b, o = (sum(hits(s, rule, level) for s in part) for part in (bad, other))
                if b + o:
                    path.append(((o + 1) / (b + 1), rule, level))
        cutoffs = [0] * 8
        for i, (_, rule, level) in enumerate(sorted(path)):
            k = sum(any(hits(s, r, at) for _, r, at in sorted(path)[:i + 1]) for s in good)
            if k >= risk * len(good) or tail(len(good), k, risk) > error / 3:
                break
            cutoffs[rule] = max(cutoffs[rule], level)
        assert got.get(lang, [0] * 8) == cutoffs
    assert got["en"][0] > 0 and got.get("fr", [0] * 8) == [0] * 8
