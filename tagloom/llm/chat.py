"""Chat formatting by prefix-target expansion (op9).

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside texts are escaped
by one backslash between ``<`` and ``|`` (any that stand there get one more), which is undone exactly.
Every assistant turn is a training example of its own: all formatted turns before it are the context,
and only its reply is under the loss mask.

The formatted turns of a conversation are written once, as segments with their offsets, and every
example is written out: its whole context, its target and the target's closing. So the examples of a
conversation of n turns take up to n times its own length; that is what the expansion is. The loss text
is read from the written examples' targets only, and the written context, target and closing are checked
against the segments; a context moves for that as its digest. Segments are made and read, and examples
made, by streaming over the sorted turns of each conversation, one turn at a time: making an example
takes memory for its context, reading takes it for the longest turn (the digests of a conversation
are sequential, so they are made in one task).

Defined results: null roles and texts are empty; turns are ordered by turn, then role, then text,
null turns first; repeated rows are turns of their own; rows with a null conv_id are one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textvec
from tagloom.llm.batches import map_arrow, text_slices
from tagloom.session import cut_lineage, scratch_folder

START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")
_SEGMENT = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text starts and ends in it."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse_segment(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    m = _SEGMENT.fullmatch(formatted)
    return unescape_role(m[1]), unescape(m[2])


_SCHEMA = "conv_id long, n long, segment string, start long, target_start long, target_end long"
_EXAMPLE = "conv_id long, turn_index long, context_end long, target_start long, target_end long, context string, target string, rest string"
_NAMES = ["conv_id", "n", "segment", "start", "target_start", "target_end"]
_EXAMPLE_NAMES = [column.split()[0] for column in _EXAMPLE.split(", ")]


def _rows(batches, columns: list[str], text: str) -> Iterator[list[tuple]]:
    for batch in batches:
        for piece in text_slices(batch, text, textvec.SLICE_BYTES):
            yield list(zip(*(piece.column(c).to_pylist() for c in columns)))


def _digest(before, opening: str) -> str:
    """Digest of the text before a turn and the turn's opening."""
    context = before.copy()
    context.update(opening.encode())
    return context.hexdigest()


def segments(conversations: DataFrame) -> DataFrame:
    """Formatted turns with their offsets in the conversation, and a target's offsets where one is trainable."""

    def run(batches):
        conv, n, at, begun = None, 0, 0, False
        for rows in _rows(batches, ["conv_id", "role", "text"], "text"):
            out = []
            for conv_id, role, text in rows:
                if not begun or conv_id != conv:
                    conv, n, at, begun = conv_id, 0, 0, True
                formatted, a, b = segment(role, text)
                target = (at + a, at + b) if role == TARGET_ROLE else (None, None)
                out.append((conv_id, n, formatted, at, *target))
                n, at = n + 1, at + len(formatted)
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES)

    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    return map_arrow(turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"), run, _SCHEMA)


def examples(formatted: DataFrame) -> DataFrame:
    """One row for each trainable turn, written out: all text before the target (up to ``target_start``), the target, its closing."""

    def run(batches):
        conv, before, begun = None, "", False
        for rows in _rows(batches, _NAMES, "segment"):
            for conv_id, n, formatted, start, a, b in rows:
                if not begun or conv_id != conv:
                    conv, before, begun = conv_id, "", True
                if a is not None:
                    i, j = a - start, b - start
                    values = [conv_id, n, a, a, b, before + formatted[:i], formatted[i:j], formatted[j:]]
                    kinds = [pa.int64()] * 5 + [pa.string()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=_EXAMPLE_NAMES)
                before += formatted

    return map_arrow(formatted.repartition("conv_id").sortWithinPartitions("conv_id", "n"), run, _EXAMPLE)


def example_texts(formatted: DataFrame) -> DataFrame:
    """Every example as text: context with the target's opening, target, closing."""
    return examples(formatted).select("conv_id", "turn_index", "context", "target", "rest")


def read_back(formatted: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from segments and examples alone.

    Turns come from the segments' texts, the loss only from the examples' targets. An example whose context, target
    or closing is not what the segments hold is an error.
    """

    def run(batches):
        conv, begun = None, False
        so_far = before = hashlib.sha256()
        last, last_n, last_start = "", -1, 0
        turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

        def result():
            values = [conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        held = []
        for rows in _rows(batches, columns, "segment"):
            for conv_id, n_turn, example, formatted, start, a, b, context in rows:
                if not begun or conv_id != conv:
                    if begun:
                        held.append(result())
                    conv, begun = conv_id, True
                    turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                    so_far, last_n = hashlib.sha256(), -1
                if example:
                    opening = last[: a - last_start] if n_turn == last_n and start == a else ""
                    if not opening or _digest(before, opening) != context:
                        raise ValueError(f"conversation {conv_id}: the context of example {n_turn} is not in the segments")
                    if formatted != last[a - last_start :]:
                        raise ValueError(f"conversation {conv_id}: the target of example {n_turn} is not in the segments")
                    target = unescape(formatted[: b - a])
                    loss.update(target.encode())
                    loss_chars += len(target)
                    continue
                role, text = parse_segment(formatted)
                turns.update(f"{role}\n{text}\n".encode())
                n, chars = n + 1, chars + len(formatted)
                before, last, last_n, last_start = so_far.copy(), formatted, n_turn, start
                so_far.update(formatted.encode())
            if held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if begun:
            yield result()

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    columns = ["conv_id", "n", "example", "segment", "start", "target_start", "target_end", "context_sha256"]
    # both tables meet by conversation, each example right after the segment that holds its target
    turns = formatted.selectExpr("conv_id", "n", "false AS example", "segment", "start", "CAST(null AS long) AS target_start",
                                 "CAST(null AS long) AS target_end", "CAST(null AS string) AS context_sha256")
    refs = found.selectExpr("conv_id", "turn_index AS n", "true AS example", "target || rest AS segment", "context_end AS start",
                            "target_start", "target_end", "sha2(context, 256) AS context_sha256")
    both = turns.unionByName(refs).repartition("conv_id").sortWithinPartitions("conv_id", "n", "example")
    return map_arrow(both, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def written(found: DataFrame) -> DataFrame:
    """Examples as written to JSON lines and read again: a line at a time, however long the contexts are."""
    path = scratch_folder(found.sparkSession, "examples")
    found.write.option("zlib.compress.level", "BEST_SPEED").json(path, compression="gzip")
    return found.sparkSession.read.schema(_EXAMPLE).option("mode", "FAILFAST").option("maxStringLen", 2**31 - 1).json(path)


def round_trip(conversations: DataFrame) -> DataFrame:
    """Format all conversations, write their segments and examples, and read both back."""
    formatted = cut_lineage(segments(conversations), "chat")
    return read_back(formatted, written(examples(formatted)))
