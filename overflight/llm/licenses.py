"""License scan by diagonal voting.

Every word k-gram of a text is hashed and joined with the k-grams of the
templates. A hit at text word p and template word q votes for the diagonal
p - q; hits are confirmed on the words themselves. A diagonal remembers which
places of its template voted. Diagonals of one template no further apart than
``DRIFT`` (words put in or left out) are merged, and a merged span is verified:
what counts is the longest series of votes whose places rise in the template
and in the text alike, so a phrase that is repeated counts once, and parts in
another order do not add up. A span holds if that series has enough of the
template's k-grams.

Templates of two kinds: the base phrases, found only as whole consecutive runs
(every k-gram on one diagonal), and notices, found with changes. Notices are
the sentences by which a text places itself, or quotes, a common public license
(listed below; full license texts are known by such sentences of theirs). They
are a fixed list given by the caller, so the joined table has several hundred
rows whatever the corpus, and is broadcast.

Defined results: null and empty texts have no words and no labels. Equal rows
each give a row. A text may be of any length: its hits are counted in the task
that reads it, before anything is shuffled. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from overflight.functions.literals import sql_literal
from overflight.llm.common import alnum_words, in_files, row_key, text_of

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences of public licenses and notices; the label names the license and version.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation": "gpl",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
    "public license as published by the free software foundation": "lgpl",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license": "agpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files to deal in the software without restriction": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4.0",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4.0",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this "
    "work": "cc0-1.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
    "accompanying documentation covered by this license": "bsl-1.0",
    "this software is provided as is without any express or implied warranty in no event will the authors be held "
    "liable for any damages arising from the use of this software": "zlib",
}
PHRASE_GRAM = 2
NOTICE_GRAM = 3
DRIFT = 5  # first and last diagonal of a span are at most so far apart
MOST_GRAMS = 63  # of a template; its places are bits of a number
COVERAGE = 0.75  # share of a notice's k-grams that have to vote


@dataclass(frozen=True)
class Template:
    number: int
    words: tuple[str, ...]
    label: str
    gram: int
    whole: bool

    @property
    def grams(self) -> int:
        return len(self.words) - self.gram + 1


def templates(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> list[Template]:
    rows = [(text, label, PHRASE_GRAM, True) for text, label in phrases.items()]
    rows += [(text, label, NOTICE_GRAM, False) for text, label in notices.items()]
    listed = [Template(n, tuple(text.split()), label, min(gram, len(text.split())), whole)
              for n, (text, label, gram, whole) in enumerate(rows, 1)]
    if any(t.grams > MOST_GRAMS for t in listed):
        raise ValueError(f"a template has more than {MOST_GRAMS} k-grams; give it as several sentences")
    return listed


def _hash(size: int, word: list[Column]) -> Column:
    return F.xxhash64(F.lit(size), *word)


def _positions(spark: SparkSession, patterns: list[Template]) -> DataFrame:
    """One row per k-gram of a template; number 0 is the end mark every text has once."""
    rows = ["(0, 0, 0, array(), CAST(NULL AS STRING), 0, true)"]
    for t in patterns:
        for q in range(t.grams):
            gram = ", ".join(map(sql_literal, t.words[q:q + t.gram]))
            rows.append(f"({t.number}, {q}, {t.gram}, array({gram}), {sql_literal(t.label)}, {t.grams}, {str(t.whole).lower()})")
    listed = spark.sql(
        f"SELECT * FROM VALUES {', '.join(rows)} AS t(template, q, size, gram, label, grams, whole)")
    widest = max(t.gram for t in patterns)
    word = [F.get("gram", F.lit(i)) for i in range(widest)]
    return listed.withColumn("hash", _hash_by_size("size", word, {0, *(t.gram for t in patterns)}))


def _hash_by_size(size: str, word: list[Column], sizes: set[int]) -> Column:
    out = F.lit(None).cast("long")
    for n in sizes:
        out = F.when(F.col(size) == n, _hash(n, word[:n])).otherwise(out)
    return out


def hits(docs: DataFrame, patterns: list[Template]) -> DataFrame:
    """Votes by diagonal: doc_id, text_hash, n_words, template, label, grams, whole, diagonal, votes, places (bits).

    Row ``template = 0`` stands for the text itself; its votes tell how many equal rows there are.
    """
    sizes = sorted({t.gram for t in patterns})
    words = docs.select(*row_key(), alnum_words(text_of()).alias("words"))
    # One position more than words: the last one carries the end mark.
    at = words.select("*", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("pos", "word"))
    here = [F.get("words", F.col("pos") + i) for i in range(max(sizes))]
    n = F.size("words")
    grams = [F.when(F.col("pos") + size <= n, _hash(size, here[:size])) for size in sizes]
    end = F.when(F.col("pos") == n, _hash(0, []))
    at = at.select("doc_id", "text_hash", "words", "pos", F.explode(F.array(*grams, end)).alias("hash"))
    listed = F.broadcast(_positions(docs.sparkSession, patterns))
    same = F.slice("words", F.col("pos") + 1, F.col("size")) == F.col("gram")
    found = at.join(listed, (at["hash"] == listed["hash"]) & same)
    return found.groupBy(
        "doc_id", "text_hash", n.alias("n_words"), "template", "label", "grams", "whole",
        (F.col("pos") - F.col("q")).alias("diagonal"),
    ).agg(F.count("*").alias("votes"), F.bit_or(F.expr("shiftleft(1L, q)")).alias("places"))


# The longest series of votes (q, p) that rises in both, of the diagonals in ``near``. Votes are taken by q.
_IN_ORDER = """
    array_max(transform(aggregate(
        sort_array(flatten(transform(near, d -> transform(
            filter(sequence(0, grams - 1), q -> (shiftright(d.places, q) & 1L) = 1L), q -> named_struct('q', q, 'p', d.diagonal + q))))),
        CAST(array() AS ARRAY<STRUCT<q: INT, p: INT, n: INT>>),
        (known, x) -> array_append(known, named_struct('q', x.q, 'p', x.p, 'n',
            1 + coalesce(array_max(transform(filter(known, k -> k.q < x.q AND k.p < x.p), k -> k.n)), 0)))), x -> x.n))
"""


def spans(votes: DataFrame, coverage: float = COVERAGE, drift: int = DRIFT) -> DataFrame:
    """Merge each diagonal with those that follow within ``drift``, and keep the spans whose votes in order suffice.

    Spans that begin within ``drift`` of one another are one (``opens`` tells the first of them). Whole phrases are
    not merged: each place is a span of its own.
    """
    text = ["doc_id", "text_hash"]
    votes = votes.withColumn("copies", F.max(F.when(F.col("template") == 0, F.col("votes"))).over(Window.partitionBy(*text)))
    after = Window.partitionBy(*text, "template").orderBy("diagonal").rangeBetween(Window.currentRow, drift)
    merged = votes.withColumn("near", F.collect_list(F.struct("diagonal", "places")).over(after))  # drift + 1 at most
    voted = F.bit_count(F.aggregate("near", F.lit(0).cast("long"), lambda bits, d: bits.bitwiseOR(d["places"])))
    needed = F.lit(coverage) * F.col("grams")
    share = (
        F.when(F.col("template") == 0, F.lit(None).cast("double"))
        .when(F.col("whole"), F.when(F.bit_count("places") == F.col("grams"), F.lit(1.0)))
        .when(voted >= needed, F.expr(_IN_ORDER) / F.col("grams"))
    )
    held = merged.withColumn("share", share).where((F.col("template") == 0) | F.col("whole") & F.col("share").isNotNull() | (
        ~F.col("whole") & (F.col("share") >= F.lit(coverage))))
    before = F.lag("diagonal").over(Window.partitionBy(*text, "template").orderBy("diagonal"))
    return held.withColumn("opens", F.col("whole") | F.coalesce(F.col("diagonal") - before > drift, F.lit(True)))


def scan(docs: DataFrame, patterns: list[Template] | None = None) -> DataFrame:
    """One row per document: base places, labels and the best coverage of any template.

    The texts' few votes are spread over as many partitions as a shuffle has; the rows come in no more than their number takes.
    """
    found = spans(hits(docs, patterns or templates()))
    real = F.col("template") > 0
    base = real & F.col("whole")
    joined = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    rows = found.groupBy("doc_id", "text_hash", "n_words", "copies").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(real).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.count(F.when(real & ~F.col("whole") & F.col("opens"), 1)).alias("n_notices"),
    )
    listed = rows.select(
        "doc_id", F.col("n_words").cast("long"), "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        "n_notices", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")
    return in_files(listed, docs.count())
