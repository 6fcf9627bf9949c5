"""Chat formatting by columnar byte assembly.

A turn is written as `<|turn|>role\\ntext<|end|>\\n`. Control strings inside roles and texts are escaped by one more
backslash behind their first character, which is undone on reading, so no text can end or open a turn. For each Arrow
batch the lengths of all segments are computed first, their running sum gives every segment's place, and headers and
contents are scattered into one preallocated buffer.
"""

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from lexloom.llm.base import small_batches, table

OPEN, END, LEARNED = "<|turn|>", "<|end|>", "assistant"
# Control strings: the template's own and those of common chat models.
CONTROL = r"\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|</?SYS>>"
ESCAPE, UNESCAPE = rf"([<\[])(\\*)({CONTROL})", rf"([<\[])(\\*)\\({CONTROL})"
PARTS = "conv_id long, part long, formatted string, loss_start array<long>, loss_end array<long>"
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def escaped(column):
    """Reversible: `<|end|>` becomes `<\\|end|>`, and that would become `<\\\\|end|>`."""
    return pc.replace_substring_regex(column, ESCAPE, r"\1\2\\\3")


def unescaped(column):
    return pc.replace_substring_regex(column, UNESCAPE, r"\1\2\3")


def escaped_role(column):
    """A role's line breaks and backslashes are escaped as well, as a line break ends it."""
    return escaped(pc.replace_substring(pc.replace_substring(column, "\\", "\\\\"), "\n", "\\n"))


def _role(text):
    text = unescaped(pa.array([text]))[0].as_py()
    return "".join("\n" if p == "\\n" else p[-1] for p in _pieces(text))


def _pieces(text):
    i = 0
    while i < len(text):
        n = 2 if text[i] == "\\" and i + 1 < len(text) else 1
        yield text[i:i + n]
        i += n


def _bytes(column):
    """(lengths, bytes) of a string array without NULLs."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return np.diff(offsets), data


def _scatter(out, place, lengths, data):
    start = np.cumsum(lengths) - lengths
    out[np.repeat(place - start, lengths) + np.arange(len(data))] = data


def assemble(roles, contents):
    """(bytes of all turns, their byte lengths, byte place of each content, its byte length)."""
    (rn, rd), (cn, cd) = _bytes(escaped_role(roles)), _bytes(escaped(contents))
    head, tail = (np.frombuffer(s.encode(), np.uint8) for s in (OPEN, END + "\n"))
    total = len(head) + rn + 1 + cn + len(tail)
    begin = np.cumsum(total) - total
    out = np.empty(int(total.sum()), np.uint8)
    role_at = begin + len(head)
    text_at = role_at + rn + 1
    out[begin[:, None] + np.arange(len(head))] = head
    _scatter(out, role_at, rn, rd)
    out[text_at - 1] = 10
    _scatter(out, text_at, cn, cd)
    out[(text_at + cn)[:, None] + np.arange(len(tail))] = tail
    return out, total, text_at, cn


def _format_task(batches):
    """Rows come in order of conversation and turn; a conversation that spans batches gets several parts."""
    last, part = object(), 0
    for b in batches:
        if not b.num_rows:
            continue
        ids, roles = b.column("conv_id").to_pylist(), pc.fill_null(b.column("role"), "")
        out, total, text_at, n = assemble(roles, pc.fill_null(b.column("text"), ""))
        new = np.array([True] + [x != y for x, y in itertools.pairwise(ids)])
        first = np.flatnonzero(new)
        char = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))  # code points before each byte
        begin = np.cumsum(total) - total
        row_at = np.append(begin[first], len(out))
        base = np.repeat(char[row_at[:-1]], np.diff(np.append(first, len(ids))))
        loss = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
        group = np.cumsum(new)[loss] - 1
        cuts = np.concatenate(([0], np.cumsum(np.bincount(group, minlength=len(first))))).astype(np.int32)
        span = [pa.ListArray.from_arrays(pa.array(cuts), pa.array((char[p] - base)[loss].astype(np.int64))) for p in (text_at, text_at + n)]
        parts = np.zeros(len(first), np.int64)
        parts[0] = part + 1 if ids[0] == last else 0
        last, part = ids[-1], int(parts[-1])
        formatted = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(row_at.astype(np.int64)), pa.py_buffer(out)])
        yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in first], pa.int64()), pa.array(parts), formatted.cast(pa.string()), *span], names=["conv_id", "part", "formatted", "loss_start", "loss_end"])


def format_chats(turns):
    """Formatted conversations: conv_id, part, formatted, loss_start, loss_end (character spans of learned texts).

    turns: conv_id, turn, role, text. Turns are ordered by turn, role, text; NULL first, and a NULL role or text is empty.
    Rows with a NULL conv_id are one conversation; repeated rows stay. The parts of a conversation in order are its text:
    a task holds one Arrow batch, however long a conversation is. Turns without text are kept. An empty table gives none.
    """
    small_batches(turns.sparkSession)
    order = ["conv_id", "turn", "role", "text"]
    return turns.select(*order).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_format_task, PARTS)


class _Reading:
    """Digests of one conversation, fed part by part."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss, self.n, self.loss_chars, self.chars = conv_id, hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def feed(self, formatted, starts, ends):
        self.chars += len(formatted)
        masked = unescaped(pa.array([formatted[a:b] for a, b in zip(starts, ends)], pa.string())).to_pylist()
        for text in masked:
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        for turn in formatted.split(OPEN)[1:]:
            role, _, rest = turn.partition("\n")
            text = unescaped(pa.array([rest.removesuffix(END + "\n")]))[0].as_py()
            self.turns.update(f"{_role(role)}\n{text}\n".encode())
            self.n += 1

    def row(self):
        return (self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest_task(batches):
    now, names = None, [c.split()[0] for c in DIGEST.split(", ")]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n.endswith("sha256") else pa.int64()) for n, c in zip(names, zip(*rows))], names=names)
    for b in batches:
        rows = []
        for r in b.to_pylist():
            if now is None or now.conv_id != r["conv_id"]:
                rows += [now.row()] if now else []
                now = _Reading(r["conv_id"])
            now.feed(r["formatted"], r["loss_start"], r["loss_end"])
        if rows:
            yield pack(rows)
    if now:
        yield pack([now.row()])


def read_back(parts):
    """Parses formatted conversations back into digests of their turns and of the text under the loss mask."""
    small_batches(parts.sparkSession)
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_digest_task, DIGEST)


def op10_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(turns.unionByName(spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string"))))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([<\[])(\\*)(\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|</?SYS>>)', '\1\2\\\3', 'g')) AS nr,
         length(regexp_replace(text, '([<\[])(\\*)(\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|</?SYS>>)', '\1\2\\\3', 'g')) AS nt
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(nr + nt + 8 + 1 + 8)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
