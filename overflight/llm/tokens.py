"""Token ids in byte-aligned variable-length files.

Documents are sorted by id over the whole corpus, encoded, and written as
blocks of about ``BLOCK_IDS`` ids (whole documents). A block ranks its ids by
frequency and stores the ranks, so that common ids take one byte. The length of
every value, 1 to 4 bytes, lies in a separate stream of control bytes, four
values each; a reader finds all offsets with one table lookup per control byte
and gathers the values with numpy, without looking at the data in between.

File format, one Parquet row per block, in ``part``, ``block`` order:
``doc_ids, counts`` (ids per document), ``before`` (ids of the part in front of
the block), ``ranked`` (ids from frequent to rare, uint32), ``control``,
``data``.

Encoding is done by the tokenizers library. Its pre-tokenizer never joins
characters across a space that stands between two other characters, so a text
is cut there and every distinct chunk is encoded once per worker; the texts of a
batch are gathered from its distinct chunks. Texts with neighbouring white space
go to the library whole. Special-token strings in a text are ordinary text.

Defined results: null and empty texts have the end id alone. Documents with the
same id stand next to each other, ordered by text; null ids come first. A
document longer than a block is a block of its own. An empty table writes no
block. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from overflight.llm.common import broadcast_if_small, portions
from overflight.session import scratch_path

END_ID = 0
BLOCK_IDS = 1 << 20
BATCH_BYTES = 1 << 22  # of texts encoded at once; the more, the fewer distinct chunks they have
CHUNKS_KEPT = 1_000_000  # per worker; more are encoded again when they come back
MANY_PARTS = 1_000_000
FILE_SCHEMA = (
    "part INT, block INT, before BIGINT, doc_ids ARRAY<BIGINT>, counts ARRAY<INT>, ranked BINARY, control BINARY, data BINARY"
)

# The pre-tokenizer's pattern.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NEIGHBOURS = re.compile(r"\s\s")


def _byte_letters() -> str:
    """The 256 letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(others)) for b in range(256))


BYTE_LETTERS = _byte_letters()


class Encoder:
    """Text to uint32 ids (as bytes), with the ids of chunks kept."""

    def __init__(self, path: str, kept: int = CHUNKS_KEPT):
        self.kept = kept
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.model = self.library.model
        self.chunks: dict[str | tuple[str], bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _piece(self, piece: str) -> bytes:
        """One piece of the pre-tokenizer, given to the library's model in its letters."""
        letters, _ = charmap_decode(piece.encode(), "strict", BYTE_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _new(self, chunks: list[str | tuple[str]]) -> dict[str | tuple[str], bytes]:
        """Ids of chunks not seen yet, by way of the pieces the pre-tokenizer cuts them into."""
        out, get, new = {}, self.pieces.get, {}
        for c in chunks:
            text = c[0] if isinstance(c, tuple) else c if c.startswith("\n") else " " + c
            if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
                cut = (text,)
            elif text[1:-1].isalpha() and text[-1] in ".,!?" and (text[0] == " " or text[0].isalpha()):
                cut = (text[:-1], text[-1])
            else:
                cut = PIECES.findall(text)
            ids = []
            for p in cut:
                found = get(p) or new.get(p)
                if found is None:
                    found = new[p] = self._piece(p)
                ids.append(found)
            out[c] = b"".join(ids)
        if len(self.pieces) + len(new) <= self.kept:
            self.pieces.update(new)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """A chunk is a run without spaces and stands for itself with the space before it.

        A line break starts a chunk too, without a space. The first chunk of a
        text has no space before it either and is kept as a tuple.
        """
        out: list[bytes | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if NEIGHBOURS.search(t)]
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        cut = [i for i, ids in enumerate(out) if ids is None]
        if not cut:
            return out
        # Chunks by number; the batch's distinct ones are looked up once and the texts gathered from them.
        lists = pc.split_pattern(pc.replace_substring(pa.array([texts[i] for i in cut], pa.large_string()), "\n", " \n"), " ")
        coded = lists.flatten().dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        firsts: dict[tuple[str], int] = {}
        number[bounds[:-1]] = [len(chunks) + firsts.setdefault((chunks[n],), len(firsts)) for n in number[bounds[:-1]].tolist()]
        chunks += firsts
        known = list(map(self.chunks.get, chunks))
        new = self._new([c for c, ids in zip(chunks, known) if ids is None])
        known = [new[c] if ids is None else ids for c, ids in zip(chunks, known)]
        if len(self.chunks) + len(new) <= self.kept:
            self.chunks.update(new)
        table = np.frombuffer(b"".join(known), np.uint32)
        length = np.fromiter(map(len, known), np.int64, len(known)) // 4
        begin = np.cumsum(length) - length
        each = length[number]
        end = np.cumsum(each)
        at = np.repeat(begin[number] - (end - each), each)
        at += np.arange(len(at))
        ids = table[at]
        stops = np.append(0, end)[bounds].tolist()
        for i, first, last in zip(cut, stops, stops[1:]):
            out[i] = ids[first:last].tobytes()
        return out

    def forget(self) -> None:
        self.chunks, self.pieces = {}, {}


@cache
def encoder(path: str, kept: int = CHUNKS_KEPT) -> Encoder:
    return Encoder(path, kept)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    length = 1 + (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    two = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    two[:len(values)] = length - 1
    control = two[0::4] | two[1::4] << 2 | two[2::4] << 4 | two[3::4] << 6
    four = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), four[np.arange(4) < length[:, None]].tobytes()


# For each control byte the lengths of its four values.
_LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values again: lengths by table lookup, then one gather per byte of a value."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    start = np.cumsum(length) - length
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    values = raw[start].astype(np.uint32)
    for byte in (1, 2, 3):
        more = np.flatnonzero(length > byte)
        values[more] |= raw[start[more] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids from frequent to rare (ties by id), and each id's rank."""
    times = np.bincount(ids)
    distinct = np.flatnonzero(times)
    order = distinct[np.argsort(-times[distinct], kind="stable")]
    rank = np.empty(len(times), dtype=np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return order.astype("<u4"), rank[ids]


def _write(path: str, block_ids: int, kept: int, forget: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("counts", pa.list_(pa.int32())), ("ranked", pa.binary()), ("control", pa.binary()), ("data", pa.binary())])
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def packed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            table, ranks = ranked(ids)
            control, data = pack(ranks)
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "before": before, "doc_ids": docs, "counts": [len(h) // 4 for h in held],
                "ranked": table.tobytes(), "control": control, "data": data}], schema=schema)

        for batch in portions(batches, "text", BATCH_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder(path, kept).encode(texts)):
                if held and size + len(ids) // 4 + 1 > block_ids:
                    yield packed()
                    block, before, docs, held, size = block + 1, before + size, [], [], 0
                docs.append(doc)
                held.append(ids + end)
                size += len(held[-1]) // 4
        if held:
            yield packed()
        if forget:
            encoder(path, kept).forget()

    return run


def write(
    docs: DataFrame, tokenizer: str, path: str, block_ids: int = BLOCK_IDS, kept: int = CHUNKS_KEPT, forget: bool = False
) -> None:
    """Encode all documents and write the files, in ascending order of doc_id.

    A worker keeps the ids of ``kept`` chunks from task to task; with
    ``forget`` it drops them after each one, which leaves the memory to others.
    """
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_write(tokenizer, block_ids, kept, forget), FILE_SCHEMA).write.parquet(path)


def block_ids(row: dict) -> np.ndarray:
    """All ids of a block."""
    table = np.frombuffer(row["ranked"], dtype="<u4")
    return table[unpack(row["control"], row["data"], sum(row["counts"]))]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, counts = block_ids(row).astype("<u4"), row["counts"]
            ends = np.cumsum(counts)
            starts = ends - counts
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "start": pa.array(starts + row["before"] + row["part_start"], pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64()),
                "n_bytes": pa.array([len(row["data"]) + len(row["control"])] + [0] * (len(counts) - 1), pa.int64()),
            })


def read(spark: SparkSession, path: str) -> DataFrame:
    """From the files, one row per document: where its ids start, how many and their checksum.

    ``n_bytes`` of a block's first document is what the block's ids take.
    """
    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda total, n: total + n)
    # A row per file and the ids in front of it.
    parts = blocks.select("part", size.alias("ids")).groupBy("part").agg(F.sum("ids").alias("ids"))
    front = F.sum("ids").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(front, F.lit(0).cast("long")).alias("part_start"))
    return blocks.join(broadcast_if_small(parts, MANY_PARTS), "part").mapInArrow(
        _read, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT, n_bytes BIGINT")


def encoded(
    docs: DataFrame, tokenizer: str, block_ids: int = BLOCK_IDS, kept: int = CHUNKS_KEPT, forget: bool = False
) -> DataFrame:
    """Write the files to the shared folder and return what they hold by document."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write(docs, tokenizer, path, block_ids, kept, forget)
    return read(docs.sparkSession, path)
