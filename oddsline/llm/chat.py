"""Op 8. Chat formatting: prefix-target expansion.

Every assistant turn becomes an example: all preceding turns as context, then
that reply, and only the reply's text is trainable. Turns after the last reply
(or a conversation without one) give one more example with no trainable part,
so that every turn is in the output. A turn is rendered as
``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts the two
characters ``<|``, with any backslashes between them, get one more backslash
between them, so no control string can appear there; in roles a backslash and
a line feed are written ``\\\\`` and ``\\n`` first. ``parse`` undoes both.

Conversations are dealt by conv_id and sorted by turn; a task streams over its
rows and holds one conversation's rendering and a bounded batch of examples.

Defined cases: null text or role is empty; a null turn sorts first; rows of
the same turn go by role, then text; a null conv_id is one conversation;
repeated rows are turns; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
EXAMPLES = "conv_id long, example int, text string, loss_start long, loss_end long"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, examples long")
BATCH_CHARS = 4_000_000

_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)
_SLASH = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _SLASH.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendering."""
    turns, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        turns.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError("not a rendering of turns")
    return turns


def _string(x) -> str:
    return x.as_py() or ""


def examples(rows: DataFrame) -> DataFrame:
    """One row per example (``EXAMPLES``); rows of a conversation lie together, in order."""
    names, kinds = ["conv_id", "example", "text", "loss_start", "loss_end"], \
        [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]

    def expand(batches):
        out: list[tuple] = []
        chars, conv, first = 0, None, True
        prefix: list[str] = []
        length, number, open_turns = 0, 0, False

        def close():
            nonlocal chars, open_turns
            if open_turns:
                out.append((conv, number, "".join(prefix), None, None))
                chars += length
                open_turns = False

        def batch():
            nonlocal out, chars
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
            out, chars = [], 0
            return made

        for b in batches:
            for c, role, text in zip(*b.columns, strict=True):
                c, role, text = c.as_py(), _string(role), _string(text)
                if first or c != conv:
                    close()
                    conv, first, prefix, length, number = c, False, [], 0, 0
                head, body = f"{START}{escape_role(role)}\n", escape(text)
                prefix.append(f"{head}{body}{END}\n")
                begin = length + len(head)
                length += len(prefix[-1])
                open_turns = True
                if role == "assistant":
                    prefix = ["".join(prefix)]
                    out.append((c, number, prefix[0], begin, begin + len(body)))
                    number, open_turns, chars = number + 1, False, chars + length
                if chars > BATCH_CHARS:
                    yield batch()
        close()
        if out:
            yield batch()

    some = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return (some.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(expand, EXAMPLES))


def digests(made: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples (``DIGEST``)."""
    names = [c.split()[0] for c in DIGEST.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in DIGEST.split(", ")]

    def read(batches):
        conv, last, first = None, "", True
        loss, loss_chars, chars, count = hashlib.sha256(), 0, 0, 0

        def row():
            turns, digest = parse(last), hashlib.sha256()
            for role, text in turns:
                digest.update(f"{role}\n{text}\n".encode())
            values = (conv, len(turns), digest.hexdigest(), loss_chars, loss.hexdigest(), chars, count)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for b in batches:
            for c, text, start, end in zip(*b.columns, strict=True):
                c, text = c.as_py(), text.as_py()
                if first or c != conv:
                    if not first:
                        yield row()
                    conv, first = c, False
                    loss, loss_chars, chars, count = hashlib.sha256(), 0, 0, 0
                last, chars, count = text, chars + len(text), count + 1
                if start.as_py() is not None:
                    reply = unescape(text[start.as_py() : end.as_py()])
                    loss.update(reply.encode())
                    loss_chars += len(reply)
        if not first:
            yield row()

    return made.select("conv_id", "text", "loss_start", "loss_end").mapInArrow(read, DIGEST)
