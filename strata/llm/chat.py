"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. The operator renders the successive prefixes
of a conversation and compares consecutive outputs: what the k-th output adds to the one before it is the span of turn
k. An output that does not begin with the one before it means that the template rewrites history; such conversations
are reported and get no loss mask, since no span can be trusted. Within a turn's span its text is located by rendering
the same prefix twice more, with an empty text and with one marker character as text: what the two have in common at
the front is the head of the turn, what the empty one has after it is the tail.

Conversations are rendered in segments of ``segment_turns`` turns (by turn number), so that neither the prefixes nor a
conversation that holds a third of all turns gather in one task. That is right for a template whose output for a turn
does not depend on the turns before it, and every conversation of several segments is made to prove it at each cut
(:func:`looks_back`): the last turn before and the first after it, rendered together, must be the two rendered alone, and
a conversation without turns must give nothing. A conversation that fails is rendered whole, by one task. Segments are
cut by turn number, so turns with far apart numbers are cut too, and proven in the same way. What this cannot see is a
template that looks back by more than one turn, but never to the last one; ``segment_turns=None`` renders all whole.

:func:`marked_turns` is the template of the query. It marks turns with control strings and escapes control strings
inside roles and texts reversibly: a backslash is put between ``<`` and ``|``, after any backslashes that stand there.

Defined results: null roles and texts are empty; turns are taken by (turn, role, text), null turns first, so ties and
repeated rows have a fixed order and each row is a turn; very long texts are rendered whole; ``rewrites`` is that of a
row, a conversation rewrites if any of its rows does; rows with a null conv_id form one conversation; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import ship_code, written

START, END = "<|im_start|>", "<|im_end|>"
SEGMENT_TURNS = 64
MARKER = "\ue000"
Template = Callable[[list[tuple[str, str]]], str]
OUT = "conv_id {kind}, segment long, part long, n_turns long, text string, turns array<struct<start:long,head:long,tail:long," \
      "end:long,loss:boolean>>, rewrites boolean"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role takes one line: newlines are written as a backslash and n, backslashes doubled."""
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", role))


def marked_turns(turns: list[tuple[str, str]]) -> str:
    """``<|im_start|>role``, a newline, the text, ``<|im_end|>`` and a newline for each turn."""
    return "".join(f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)


def read_marked(text: str) -> list[tuple[str, str]]:
    """The turns of an output of :func:`marked_turns`."""
    out = []
    for part in text.split(START)[1:]:
        role, _, body = part.partition("\n")
        out.append((unescape_role(role), unescape(body[:-len(END) - 1])))
    return out


def common_front(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def render(turns: list[tuple[str, str]], template: Template, learn: tuple[str, ...] = ("assistant",)
           ) -> tuple[str, list[dict], bool]:
    """The whole rendering, for each turn where its span starts and ends and its text (``head`` to ``tail``), and
    whether the template rewrites what it has rendered before."""
    before, spans = template([]), []
    for k, (role, text) in enumerate(turns):
        now = template(turns[:k + 1])
        if not now.startswith(before):
            return template(turns), [], True
        empty, probe = (template(turns[:k] + [(role, x)]) for x in ("", MARKER))
        head = common_front(empty, probe)
        tail = len(now) - (len(empty) - head)
        if not (len(before) <= head <= tail and now.endswith(empty[head:]) and now.startswith(empty[:head])):
            return template(turns), [], True  # the text of a turn changes what stands around it
        spans.append({"start": len(before), "head": head, "tail": tail, "end": len(now), "loss": role in learn})
        before = now
    return before, spans, False


def looks_back(turns: DataFrame, template: Template, segment_turns: int) -> DataFrame:
    """(conv_id) of the conversations of ``turns`` (conv_id, segment, turn, role, text) with several segments, or parts of
    one, that cannot be rendered apart. Only the turns beside cuts are looked at."""
    keys = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    per = written(turns.groupBy("conv_id", "segment").agg(F.count(F.lit(1)).alias("n")), "segments")
    long = per.groupBy("conv_id").agg(F.count(F.lit(1)).alias("segments"), F.max("n").alias("n")).where(
        (F.col("segments") > 1) | (F.col("n") > segment_turns))
    full = (F.col("t.segment") == F.col("p.segment")) & keys("t", "p")
    some = turns.alias("t").join(per.alias("p"), full).join(long.alias("l"), keys("t", "l"), "left_semi").select("t.*", "p.n")
    turn = F.struct("turn", "role", "text")
    ends = some.where(F.col("n") <= segment_turns).groupBy("conv_id", "segment").agg(
        F.min(turn).alias("first"), F.max(turn).alias("last"), F.max("n").alias("n"))
    ends = ends.select("conv_id", "segment", F.inline(F.when(F.col("n") > 1, F.array("first", "last")).otherwise(
        F.array("first"))))
    beside = ends.unionByName(some.where(F.col("n") > segment_turns).drop("n"))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        header, found = template([]) != "", set()
        last, conv, segment, at = None, None, None, 0
        for batch in source:
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "segment", "role", "text"))
            for key, part, role, text in zip(*columns):
                now = (role, text)
                if last is None or key != conv:
                    conv, at = key, 0
                elif part != segment or at % segment_turns == 0:
                    at = 0
                    if key not in found and (header or template([last, now]) != template([last]) + template([now])):
                        found.add(key)
                        yield pa.RecordBatch.from_arrays([pa.array([key], batch.schema.field("conv_id").type)], ["conv_id"])
                last, segment, at = now, part, at + 1

    kind = turns.schema["conv_id"].dataType.simpleString()
    placed = beside.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "turn", "role", "text")
    return placed.mapInArrow(batches, f"conv_id {kind}")


def format_chats(turns: DataFrame, template: Template = marked_turns, learn: tuple[str, ...] = ("assistant",),
                 segment_turns: int | None = SEGMENT_TURNS) -> DataFrame:
    """One row per conversation and segment: the rendered text, and for each turn its span, the span of its text, and
    whether it counts for the loss (code points from the start of the segment's text)."""
    ship_code(turns.sparkSession)
    segment = F.lit(0) if segment_turns is None else F.coalesce(F.floor(F.col("turn") / segment_turns), F.lit(-(1 << 62)))
    chosen = turns.select(
        "conv_id", segment.cast("long").alias("segment"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    if segment_turns is None:
        return _rendered(chosen, template, learn, None)
    back = written(looks_back(chosen, template, segment_turns), "looks-back")
    same = F.col("t.conv_id").eqNullSafe(F.col("b.conv_id"))
    apart = chosen.alias("t").join(back.alias("b"), same, "left_anti")
    whole = chosen.alias("t").join(back.alias("b"), same, "left_semi").withColumn("segment", F.lit(0).cast("long"))
    return _rendered(apart, template, learn, segment_turns).unionByName(_rendered(whole, template, learn, None))


def _rendered(turns: DataFrame, template: Template, learn: tuple[str, ...], segment_turns: int | None) -> DataFrame:
    """The rows of :func:`format_chats` for ``turns`` (conv_id, segment, turn, role, text)."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, waiting, schema = None, 0, [], None

        def rendered() -> pa.RecordBatch:
            text, spans, rewrites = render(waiting, template, learn)
            row = {"conv_id": key[0], "segment": key[1], "part": part, "n_turns": len(waiting), "text": text, "turns": spans,
                   "rewrites": rewrites}
            return pa.RecordBatch.from_pylist([row], schema)

        span = pa.struct([pa.field(n, pa.int64()) for n in ("start", "head", "tail", "end")]
                         + [pa.field("loss", pa.bool_())])
        for batch in source:
            schema = schema or pa.schema([
                ("conv_id", batch.schema.field("conv_id").type), ("segment", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()),
                ("text", pa.string()), ("turns", pa.list_(span)), ("rewrites", pa.bool_())])
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "segment", "role", "text"))
            for conv, segment, role, text in zip(*columns):
                if waiting and ((conv, segment) != key or len(waiting) == segment_turns):
                    yield rendered()
                    waiting = []
                    part += 1
                key = (conv, segment)
                waiting.append((role, text))
        if waiting:
            yield rendered()

    placed = turns.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "turn", "role", "text")
    return placed.drop("turn").mapInArrow(batches, OUT.format(kind=kind))


def digests(formatted: DataFrame) -> DataFrame:
    """Read the output of :func:`format_chats` with :func:`marked_turns` back: per conversation its turns and the text
    under the loss mask. Segments pass one after another; only the state of the hashes is held."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, rows = None, None, []
        for batch in source:
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "text", "turns"))
            for key, text, turns in zip(*columns):
                if state is None or key != conv:
                    if state:
                        rows.append(finished(conv, state))
                    conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_marked(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for turn in turns:
                    if turn["loss"]:
                        said = unescape(text[turn["head"]:turn["tail"]])
                        state[2] += len(said)
                        state[3].update(said.encode())
                state[4] += len(text)
            if rows:
                yield made(rows, batch.schema.field("conv_id").type)
                rows = []
        if state:
            yield made([finished(conv, state)], batch.schema.field("conv_id").type)

    def finished(conv, state: list) -> tuple:
        return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    def made(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    ship_code(formatted.sparkSession)
    placed = formatted.select("conv_id", "segment", "part", "text", "turns").repartition(
        "conv_id").sortWithinPartitions("conv_id", "segment", "part")
    return placed.mapInArrow(batches, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
