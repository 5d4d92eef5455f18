"""The stages of the corpus pipeline on documents with planted cases."""

from collections import Counter

import corpus_pipeline
from overflight.llm import tokens
from overflight.llm.common import stored
from tests.llm.texts import documents, prose, space_words

import public_tokenizers
from tokenizers import Tokenizer


def write_tables(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, prose(777, 40, 5000))], "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")


def test_stages(spark, tmp_path):
    clean = [(i, prose(i, 80 + i, 5000), "en", "ab"[i % 2]) for i in range(300)]
    junk = [(400, "a b c", "en", "a"), (401, None, None, None), (402, "same five words here again " * 9, "en", "a")]
    copies = [(500, clean[7][1], "en", "a"), (501, clean[8][1] + " more", "en", "a")]
    leaks = [(600, f"{prose(9999, 30)} {prose(777, 40, 5000)} {prose(9998, 30)}", "en", "a")]
    docs = documents(spark, clean + junk + copies + leaks)
    write_tables(spark, str(tmp_path), docs)
    kept, names = [], []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), "test")
        names.append(name)
        kept.append(docs)
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in kept]
    assert len(names) == 5 and all(df.columns == kept[0].columns for df in kept[:-1])
    assert ids[0] == {d[0] for d in clean + copies + leaks}
    assert ids[1] == ids[0] - {500, 501} and ids[2] == ids[1] - {600}
    assert ids[3] <= ids[2] and ids[4] == ids[3]

    size = {d[0]: len(space_words(d[1])) for d in clean}
    taken = Counter()
    for r in kept[3].collect():
        taken[r.doc_id] += len(space_words(r.text))
    assert all(taken[i] <= 2 * size[i] for i in taken)
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) < 400

    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    lengths = Counter((r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids) + 1) for r in kept[3].collect())
    rows = sorted(kept[4].collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == lengths
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(len(rows))]
    assert tokens.END_ID == 0


def test_run_and_empty_tables(spark, tmp_path):
    write_tables(spark, str(tmp_path / "one"), documents(spark, [(i, prose(i), "en", "a") for i in range(20)], extra=False))
    assert corpus_pipeline.run(spark, str(tmp_path / "one")).count() >= 15
    write_tables(spark, str(tmp_path / "none"), documents(spark, [], extra=False))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
