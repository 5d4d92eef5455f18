import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from overflight.llm import tokens
from tests.llm.texts import EDGES, documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


@given(st.lists(st.integers(0, 2**32 - 1)))
def test_pack_round_trip(values):
    values = np.array(values, dtype=np.uint32)
    control, data = tokens.pack(values)
    assert len(control) == -(-len(values) // 4)
    assert tokens.unpack(control, data, len(values)).tolist() == values.tolist()


def test_ranks():
    table, ranks = tokens.ranked(np.array([7, 5, 7, 9, 5, 7], dtype="<u4"))
    assert table.tolist() == [7, 5, 9] and ranks.tolist() == [0, 1, 0, 2, 1, 0]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'.,!?1aBsé <|endoftext|>　"), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_encoder_equals_the_library(library, text):
    ids = np.frombuffer(tokens.encoder(PATH).encode([text])[0], "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids


def test_kept_chunks_are_bounded(library):
    own = tokens.Encoder(PATH, 20)
    for seed in range(3):
        text = prose(seed) + ", and so on."
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.chunks) <= 20 and len(own.pieces) <= 20


def test_a_batch_looks_a_chunk_up_once(library):
    class Counted(dict):
        looked = 0

        def get(self, *args):
            Counted.looked += 1
            return super().get(*args)

    own = tokens.Encoder(PATH)
    own.chunks = Counted()
    texts = ["", " ", "a", "\n", " the end ", "a\nb \u3000c", "x  y", *[prose(i, 200, vocabulary=50) + "\nthe end" for i in range(30)]]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in own.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert Counted.looked < 600  # of over 6000 places
    assert own.encode([]) == [] and own.encode(["x  y"]) == [own.encode(["x  y", "z"])[0]]


@pytest.mark.parametrize("block", [1, 500, 1 << 20])
def test_files_round_trip(spark, library, block):
    rows = [*EDGES, *[(100 - i, prose(i, i * 9), "en", "a") for i in range(60)]]
    got = tokens.encoded(documents(spark, rows).repartition(6), PATH, block).collect()
    wanted, start = [], 0
    for i, text, _, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]
        wanted.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == wanted


def test_empty_table(spark):
    assert tokens.encoded(documents(spark, []), PATH).collect() == []
