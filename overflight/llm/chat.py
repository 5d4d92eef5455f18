"""Chat formatting from an event log.

The log holds, per conversation, what a chat service emits: streamed pieces of
a message (``delta``), replacements of a message (``edit``) and restarts
(``regenerate``). The events of a message are sorted by sequence and folded
into its final text: everything before the last restart or edit is void, an
edit's own text counts, later pieces are added. Messages are rendered one by
one in a template with marked turns; the output is a table of segments whose
concatenation in order is the formatted conversation, with the span of each
segment that a loss may see (the text of assistant messages).

Folding works on messages, so a conversation with very many of them is spread
over all tasks. Reading back a conversation is a pass over its segments in
order that holds one segment at a time.

Control strings inside texts are escaped by a backslash after their first
character (one more if there are some already), which is reversible.

Defined results: a null text is empty, a null role is the empty role, a null
conversation id is a conversation of its own, a null turn comes first. Rows
with the same conversation and turn are different messages, ordered by role and
text. Texts may have any length. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from overflight.llm.common import text_of
from overflight.session import scratch_path

# The template's marks and the strings that other templates use as marks.
START, END = "<|im_start|>", "<|im_end|>"
_REST = r"\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|<SYS>>|</SYS>>"
_MARKED = rf"(<|\[)(\\*)({_REST})"
_ESCAPED = rf"(<|\[)\\(\\*)({_REST})"
LEARNED_ROLE = "assistant"
MESSAGE = ("conv_id", "turn", "copy")
SEGMENTS = "conv_id BIGINT, turn BIGINT, copy INT, segment STRING, loss_from INT, loss_to INT"


def messages(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, copy, role, text``: rows of the same turn numbered, nulls made empty."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text_of().alias("text"))
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return rows.withColumn("copy", F.row_number().over(same))


def event_log(rows: DataFrame) -> DataFrame:
    """A log that folds into these messages, with every kind of event: ``conv_id, turn, copy, role, seq, kind, payload``."""
    half = F.floor(F.length("text") / 2).cast("int")
    first, second = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text"))
    event = lambda seq, kind, payload: F.struct(
        F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), payload.alias("payload"))
    draft = F.lit("Let me ")
    kinds = [
        [event(0, "delta", first), event(1, "delta", second)],
        [event(0, "delta", draft), event(1, "delta", first), event(2, "regenerate", F.lit("")), event(3, "delta", F.col("text"))],
        [event(0, "delta", draft), event(1, "edit", F.col("text"))],
        [event(0, "delta", draft), event(1, "edit", first), event(2, "delta", second)],
    ]
    kind = F.pmod(F.xxhash64(*MESSAGE), F.lit(len(kinds)))
    events = F.array(*kinds[0])
    for n, listed in enumerate(kinds):
        events = F.when(kind == n, F.array(*listed)).otherwise(events)
    return rows.select(*MESSAGE, "role", F.inline(events))


def folded(log: DataFrame) -> DataFrame:
    """Final messages of a log: ``conv_id, turn, copy, role, text``."""
    voids = F.col("kind").isin("edit", "regenerate")
    groups = log.groupBy(*MESSAGE).agg(
        F.max_by("role", "seq").alias("role"),
        F.max(F.when(voids, F.col("seq"))).alias("restart"),
        F.sort_array(F.collect_list(F.struct("seq", "kind", "payload"))).alias("events"),
    )
    restart = F.coalesce("restart", F.lit(-1))
    counts = F.filter("events", lambda e: (e["seq"] > restart) | ((e["seq"] == restart) & (e["kind"] == "edit")))
    text = F.array_join(F.transform(counts, lambda e: F.coalesce(e["payload"], F.lit(""))), "")
    return groups.select(*MESSAGE, "role", text.alias("text"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, r"$1\\$2$3")


def rendered(rows: DataFrame) -> DataFrame:
    """Segments of final messages. Line breaks and backslashes of a role are escaped, as a line break ends it."""
    role = F.replace(F.replace("role", F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    head = F.concat(F.lit(START), escaped(role), F.lit("\n"))
    text = escaped(F.col("text"))
    learned = F.col("role") == LEARNED_ROLE
    return rows.select(
        *MESSAGE, F.concat(head, text, F.lit(END + "\n")).alias("segment"),
        F.when(learned, F.length(head)).alias("loss_from"),
        F.when(learned, F.length(head) + F.length(text)).alias("loss_to"),
    )


def unescape(text: str) -> str:
    return re.sub(_ESCAPED, r"\1\2\3", text)


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    if not (segment.startswith(START) and segment.endswith(END + "\n")):
        raise ValueError("not a segment")
    role, text = segment[len(START):-len(END) - 1].split("\n", 1)
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))
    return role, unescape(text)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation and order in; one row per conversation out. Holds the running digests of one conversation."""
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def row() -> dict:
        return dict(zip(names, (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)))

    conv, n, loss_chars, chars = None, 0, 0, 0
    turns, loss = hashlib.sha256(), hashlib.sha256()
    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if n and r["conv_id"] != conv:
                done.append(row())
                n, loss_chars, chars, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            conv, n, segment = r["conv_id"], n + 1, r["segment"]
            role, text = parse(segment)
            turns.update(f"{role}\n{text}\n".encode())
            chars += len(segment)
            if r["loss_from"] is not None:
                learned = unescape(segment[r["loss_from"]:r["loss_to"]])
                loss_chars += len(learned)
                loss.update(learned.encode())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_DIGESTS)
    if n:
        yield pa.RecordBatch.from_pylist([row()], schema=_DIGESTS)


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                      ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """One row per conversation, computed from the written segments."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    return segments.repartition("conv_id").sortWithinPartitions(*MESSAGE).mapInArrow(
        _digests, "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, "
        "formatted_chars BIGINT")


def formatted(conversations: DataFrame) -> DataFrame:
    """Log, fold, render and write all conversations; return what the written segments hold."""
    path = scratch_path(conversations.sparkSession, "chat")
    rendered(folded(event_log(messages(conversations)))).write.parquet(path)
    return read_back(conversations.sparkSession, path)
