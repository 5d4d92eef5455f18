"""Quality rules whose strictness is set by labelled holdouts (risk control).

A document is measured once. Every rule compares one measure with a ladder of
cutoffs, from lenient to strict. Only documents that the base rule keeps count
from here on. The steps of all rules are put in one order for each stratum, by
the documents a step rejects that are not labelled for each one labelled bad,
and tested in that order on the labelled good documents: an exact binomial test
of "the rules so far falsely reject more than ``risk``", at ``error`` divided by
the number of strata (Bonferroni over strata, fixed sequence inside one, so the
family-wise error stays below ``error``). The steps before the first failed test
hold, so every rule has its own cutoff and a noisy rule does not hold up a clean
one, while ``risk`` bounds all rules together. The order comes from documents
other than those that are tested. ``judged`` reports the verdicts, ``accepted``
applies them.

Defined results: null and empty texts have no words and fail the base rule. A
null stratum is a stratum of its own. A stratum without enough labels certifies
no step, so only the base rule rejects there. Several labels of one document
count as good only if all are; labels of unknown documents, null ids and null
labels are ignored. Equal rows are judged alike, each giving a row. An empty
table gives an empty result. Extra columns are ignored or, in ``accepted``,
passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from overflight.llm.common import SPACE_CHARS, broadcast_if_small, in_files, space_words, stored, text_of

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
RISK = 0.01
ERROR = 0.05
MANY_STRATA = 10_000

# Measure and its cutoffs from lenient to strict; a larger value is worse.
RULES: dict[str, tuple[float, ...]] = {
    "_m.n_symbols / greatest(_m.n_words, 1)": (2.0, 1.5, 1.0, 0.7, 0.5, 0.35, 0.25, 0.18),
    "_m.bangs / greatest(_m.n_words, 1)": (1.5, 1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12),
    "_m.capitals / greatest(_m.word_chars, 1)": (0.8, 0.7, 0.6, 0.5, 0.4, 0.32, 0.26, 0.22),
    "_m.digits / greatest(_m.word_chars, 1)": (0.7, 0.6, 0.5, 0.4, 0.32, 0.26, 0.2, 0.15),
    "_m.n_dup_lines / greatest(_m.n_lines, 1)": (0.8, 0.7, 0.6, 0.5, 0.4, 0.32, 0.26, 0.2),
    "_m.n_repeat_words / greatest(_m.n_words, 1)": (0.19, 0.18, 0.17, 0.16, 0.15, 0.14, 0.13, 0.12),
    "_m.word_chars / greatest(_m.n_words, 1)": (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0),
    "-_m.word_chars / greatest(_m.n_words, 1)": (-1.2, -1.4, -1.6, -1.8, -2.0, -2.2, -2.4, -2.6),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "steps")

# Words of the text that lie in a five-word window found at least twice. Hashes
# show that most texts have no such window; the others are decided on the
# windows themselves, sorted so that equal ones are neighbours.
_HASHES = """
    CASE WHEN size(_words) >= 5 THEN transform(sequence(0, size(_words) - 5), i ->
        xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2), get(_words, i + 3), get(_words, i + 4)))
    ELSE array() END
"""
_REPEATED = """
    CASE WHEN NOT _repeats THEN 0L ELSE get(transform(
        array(sort_array(transform(sequence(0, size(_words) - 5),
            i -> named_struct('w', array_join(slice(_words, i + 1, 5), ' '), 'i', i)))),
        s -> get(transform(
            array(sort_array(transform(
                filter(s, (x, j) -> coalesce(get(s, j - 1).w = x.w, false) OR coalesce(get(s, j + 1).w = x.w, false)),
                x -> x.i))),
            p -> aggregate(
                transform(p, (x, j) -> least(5, x - coalesce(get(p, j - 1), -5))), 0L, (total, x) -> total + x)
        ), 0)), 0) END
"""


def _only(text: Column, kept: str) -> Column:
    """How many characters of a class the text has."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with one struct column ``_q`` of measures added; row by row, no shuffle."""
    text = text_of()
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
    split = docs.select("*", space_words(text).alias("_words"), lines.alias("_lines"))
    hashed = split.select("*", F.expr(_HASHES).alias("_hashes"))
    flagged = hashed.select(
        "*", (F.size(F.array_distinct("_hashes")) < F.size("_hashes")).alias("_repeats")
    ).drop("_hashes")
    counted = flagged.select(
        *docs.columns,
        F.struct(
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            _only(text, "#*$%&|<>").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.expr(_REPEATED).alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("n_lines"),
            _only(text, "!").alias("bangs"),
            _only(text, r"\p{Lu}").alias("capitals"),
            _only(text, "0-9").alias("digits"),
        ).alias("_m"),
    )
    base_failed = (F.col("_m.n_words") < MIN_WORDS) | (
        100 * F.col("_m.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_m.n_words"))
    return counted.select(
        *docs.columns,
        F.struct(*[F.col(f"_m.{name}") for name in MEASURES[:5]], base_failed.alias("base_failed"),
                 _steps().alias("steps")).alias("_q"),
    )


def _steps() -> Column:
    """For every rule the first step, from 1, whose cutoff it exceeds; null if no step does."""
    steps = []
    for rule, cutoffs in RULES.items():
        value = F.expr(f"CAST({rule} AS DOUBLE)")
        step = F.lit(None).cast("int")
        for level, cutoff in reversed(list(enumerate(cutoffs, 1))):
            step = F.when(value > cutoff, level).otherwise(step)
        steps.append(step)
    return F.array(*steps)


def _tail(n: str, k: str, rate: float) -> Column:
    """P(Binomial(n, rate) <= k), summed in logarithms; 1 where k is not below the mean."""
    return F.expr(f"""
        CASE WHEN {k} >= {n} * {rate!r}D THEN 1D ELSE exp(aggregate(
            CASE WHEN {k} > 0 THEN sequence(1L, {k}) ELSE array() END,
            named_struct('term', {n} * ln(1 - {rate!r}D), 'total', {n} * ln(1 - {rate!r}D)),
            (z, j) -> named_struct(
                'term', z.term + ln(({n} - j + 1D) / j) + ln({rate!r}D / (1 - {rate!r}D)),
                'total', greatest(z.total, z.term + ln(({n} - j + 1D) / j) + ln({rate!r}D / (1 - {rate!r}D)))
                    + ln(1 + exp(-abs(z.total - (z.term + ln(({n} - j + 1D) / j) + ln({rate!r}D / (1 - {rate!r}D))))))),
            z -> z.total)) END""")


def _marks(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()) \
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))


def _ordered(measures: DataFrame, marks: DataFrame) -> DataFrame:
    """``(stratum, path)``: the steps of all rules as ``(place, rule, level)``, those that reject least besides junk first.

    Steps that reject no document but labelled good ones are left out.
    """
    last = len(next(iter(RULES.values())))
    hit = measures.select("doc_id", "stratum", F.posexplode("steps").alias("rule", "step")).where("step IS NOT NULL")
    counts = (
        hit.join(marks, "doc_id", "left").where("quality IS NULL OR quality <> 1")
        .groupBy("stratum", "rule", "step")
        .agg(F.count(F.when(F.col("quality").isNull(), 1)).alias("other"), F.count("quality").alias("bad"))
        .select("stratum", "rule", "other", "bad", F.explode(F.sequence("step", F.lit(last))).alias("level"))
        .groupBy("stratum", "rule", "level").agg(F.sum("other").alias("other"), F.sum("bad").alias("bad"))
    )
    order = Window.partitionBy("stratum").orderBy((F.col("other") + 1) / (F.col("bad") + 1), "rule", "level")
    return counts.withColumn("place", F.row_number().over(order)) \
        .groupBy("stratum").agg(F.collect_list(F.struct("place", "rule", "level")).alias("path"))  # rules x steps at most


def certified_rules(measures: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``(stratum, cutoffs)``: for every rule its strictest certified step, 0 if none; together they reject at most ``risk``.

    ``measures`` has doc_id, stratum and steps of the documents that the base rule keeps.
    """
    marks = _marks(labels)
    paths = stored(_ordered(measures, marks), "quality-paths", MANY_STRATA)
    held = measures.join(marks.where("quality = 1").select("doc_id"), "doc_id").join(
        broadcast_if_small(paths, MANY_STRATA), "stratum", "left")
    place = F.expr("array_min(transform(filter(path, p -> get(steps, p.rule) <= p.level), p -> p.place))")
    tested = (
        held.groupBy("stratum", F.coalesce(place, F.lit(0)).alias("place")).agg(F.count("*").alias("held"))
        .groupBy("stratum").agg(F.sum("held").alias("n"), F.collect_list(F.struct("place", "held")).alias("hits"))
        .withColumn("share", error / F.count("*").over(Window.partitionBy(F.lit(0))))  # one row for each stratum here
        # Nothing changes between the places where good documents are rejected; place 1 tests that none is.
        .withColumn("place", F.explode(F.array_union(F.array(F.lit(1)), F.filter("hits.place", lambda p: p > 0))))
        .withColumn("k", F.expr("aggregate(filter(hits, h -> h.place BETWEEN 1 AND place), 0L, (total, h) -> total + h.held)"))
    )
    failed = tested.where(_tail("n", "k", risk) > F.col("share")).groupBy("stratum").agg(F.min("place").alias("failed"))
    limits = tested.select("stratum").distinct().join(failed, "stratum", "left")
    cutoff = lambda rule: F.expr(
        f"coalesce(array_max(transform(filter(path, p -> p.rule = {rule} AND p.place < coalesce(failed, p.place + 1)), p -> p.level)), 0)")
    return limits.join(paths, "stratum").select("stratum", F.array(*[cutoff(rule) for rule in range(len(RULES))]).alias("cutoffs"))


def _measured(docs: DataFrame, columns: list[str], stratum: str) -> DataFrame:
    key = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("null"))
    return stored(in_files(measured(docs).select(*columns, F.col("_q"), key.alias("_key")), docs.count()), "quality")


def _with(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Add the stratum's ``name`` as ``_name``."""
    found = broadcast_if_small(stored(found, f"quality-{name}", MANY_STRATA), MANY_STRATA)
    found = found.select(F.col("stratum").alias("_stratum"), F.col(name).alias(f"_{name}"))
    return rows.join(found, F.col("_key") == F.col("_stratum"), "left")


def _verdicts(docs: DataFrame, columns: list[str], labels: DataFrame, stratum: str, risk: float, error: float) -> DataFrame:
    """The columns, the measures ``_q`` and ``_by``: the number of the first rule, from 1, whose cutoff rejects (0: none)."""
    rows = _measured(docs, columns, stratum)
    sound = rows.where("NOT _q.base_failed")
    cutoffs = certified_rules(sound.select("doc_id", F.col("_key").alias("stratum"), F.col("_q.steps")), labels, risk, error)
    rejects = F.expr("coalesce(array_position(zip_with(_q.steps, _cutoffs, (s, c) -> s <= c), true), 0L)")
    return _with(rows, cutoffs, "cutoffs").withColumn("_by", rejects)


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per document: the measures, the base verdict, ``kept``, the first step that any rule reaches
    (``hit_level``), and the first rule that rejects (``rejected_by``); 0 for none."""
    rows = _verdicts(docs.select("doc_id", "text", stratum), ["doc_id"], labels, stratum, risk, error)
    kept = ~F.col("_q.base_failed") & (F.col("_by") == 0)
    return rows.select(
        "doc_id", *[f"_q.{name}" for name in MEASURES[:-1]], kept.alias("kept"),
        F.coalesce(F.array_min("_q.steps"), F.lit(0)).alias("hit_level"), F.col("_by").alias("rejected_by"))


def accepted(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The documents that neither the base rule nor a rule's certified cutoff rejects, with their columns."""
    own = {c: f"_own{n}" for n, c in enumerate(docs.columns)}  # the measures' names are free then, whatever the columns are called
    plain = docs.select("doc_id", "text", stratum, F.struct(*[F.col(c).alias(o) for c, o in own.items()]).alias("_row"))
    rows = _verdicts(plain, ["doc_id", "_row"], labels, stratum, risk, error)
    return rows.where("NOT _q.base_failed AND _by = 0").select(*[F.col(f"_row.{o}").alias(c) for c, o in own.items()])
