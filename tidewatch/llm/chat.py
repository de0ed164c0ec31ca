"""Chat formatting by columnar byte assembly.

Conversations are shuffled by id and sorted by turn; each task then formats an Arrow
batch of turns at once: control strings inside texts are escaped on the whole column,
segment lengths and cumulative offsets come from numpy, and headers, contents and
footers are scattered into one preallocated buffer that becomes an Arrow column without
a copy.  A conversation's turns leave as parts of a bounded size, in order, so one with a
third of all rows streams through a task in constant memory.

Template: ``<|im_start|>`` role line feed text ``<|im_end|>`` line feed.  In texts and
roles every ``<`` followed by any number of backslashes and ``|`` gets one backslash
more, so ``<|`` occurs in markers only; reading takes one backslash off.  In roles, line
feed and backslash are written ``\\n`` and ``\\\\`` before that.

Defined cases: a null text or role is empty; rows with the same id and turn follow by
role, then text; a null turn comes first; rows of a null id are one conversation; other
columns are not read, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import byte_slices

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: A part ends with the turn that takes it to so many bytes.
PART_BYTES = 1 << 20

PARTS = "conv_id long, part long, text string, loss array<struct<start:long,length:long>>"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\\\1|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(roles: pa.Array) -> pa.Array:
    return escape(pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def assemble(roles: pa.Array, texts: pa.Array, trained: str = "assistant"):
    """Formatted turns: bytes, turn offsets, and by turn where its text starts, its loss length, whether
    it is trained on and its whole length, these in code points.

    Every segment -- marker, role, line feed, text, end marker -- is a run of source bytes
    with a length; its place in the output is the running sum of lengths, and one scatter
    index per byte copies each source column into the buffer.
    """
    n = len(roles)
    role, text = escape_role(roles), escape(texts)
    columns, sizes = [], np.empty((n, 5), np.int64)
    for k, part in enumerate((OPEN, role, "\n", text, CLOSE + "\n")):
        if isinstance(part, str):
            raw = np.frombuffer(part.encode(), np.uint8)
            columns.append((raw, np.zeros(n, np.int64)))
            sizes[:, k] = len(raw)
        else:
            chunks = list(byte_slices(part, 1 << 62))
            data, offs = chunks[0][2:] if chunks else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
            columns.append((data, offs[:-1]))
            sizes[:, k] = np.diff(offs)
    places = np.zeros(n * 5 + 1, np.int64)
    np.cumsum(sizes.ravel(), out=places[1:])
    out = np.empty(places[-1], np.uint8)
    starts = places[:-1].reshape(n, 5)
    for k, (data, first) in enumerate(columns):
        size = sizes[:, k]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(starts[:, k], size) + inner] = data[np.repeat(first, size) + inner]
    points = pc.utf8_length
    is_trained = pc.equal(roles, trained).to_numpy(zero_copy_only=False)
    length = np.where(is_trained, points(text).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    begin = len(OPEN) + 1 + points(role).to_numpy(zero_copy_only=False).astype(np.int64)
    turn_points = begin + points(text).to_numpy(zero_copy_only=False) + len(CLOSE) + 1
    return out, places[::5], begin, length, is_trained, turn_points


def _strings(column: pa.Array) -> pa.Array:
    return column.cast(pa.string()).fill_null("")


def _formatter(trained: str, part_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, open_part, any_open = None, 0, False       # the conversation that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            first = 0
            roles, texts = _strings(batch.column(2)), _strings(batch.column(3))
            ids, null = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            # turns of this batch in slices of about part_bytes of text
            bytes_to = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
            while first < batch.num_rows:
                base = bytes_to[first - 1] if first else 0
                stop = max(first + 1, int(np.searchsorted(bytes_to, base + part_bytes, "right")))
                part, null_part = ids[first:stop], null[first:stop]
                buffer, offs, begin, length, is_trained, size = assemble(roles[first:stop], texts[first:stop], trained)
                new = np.ones(len(part), bool)
                new[1:] = (part[1:] != part[:-1]) | (null_part[1:] != null_part[:-1])
                same = any_open and (None if null_part[0] else int(part[0])) == open_id
                heads = np.flatnonzero(new)
                points_to = np.concatenate([[0], np.cumsum(size)])
                number = np.zeros(len(heads), np.int64)
                if same:
                    number[0] = open_part + 1
                loss_at = np.flatnonzero(is_trained)
                of = np.searchsorted(heads, loss_at, "right") - 1
                loss = pa.StructArray.from_arrays(
                    [pa.array(points_to[loss_at] - points_to[heads[of]] + begin[loss_at], pa.int64()),
                     pa.array(length[loss_at], pa.int64())], ["start", "length"])
                text_offs = np.append(offs[heads], offs[-1]).astype(np.int64)
                text = pa.LargeStringArray.from_buffers(len(heads), pa.py_buffer(text_offs), pa.py_buffer(buffer))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[heads], pa.int64(), mask=null_part[heads]), pa.array(number),
                     text.cast(pa.string()),
                     pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(heads) + 1)), pa.int32()), loss)],
                    ["conv_id", "part", "text", "loss"])
                any_open, open_part = True, int(number[-1])
                open_id = None if null_part[-1] else int(part[-1])
                first = stop

    return run


def formatted(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text", trained: str = "assistant", part_bytes: int = PART_BYTES) -> DataFrame:
    """``(conv_id, part, text, loss)``: formatted conversations, loss spans in code points of ``text``.

    Parts are numbered from 0 in order, and rows of a conversation are neighbours in one
    partition.  ``loss`` covers every text of role ``trained``.
    """
    rows = conversations.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                                F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_formatter(trained, part_bytes), PARTS)


#: One formatted turn, as read back.
_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE) + "\n", re.S)

DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def read_back(parts: DataFrame) -> DataFrame:
    """One row per conversation, read from ``formatted``'s rows in their order: turns and loss text as digests.

    Works through the partitions as ``formatted`` left them (no shuffle), a part at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row(s):
            return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

        for batch in batches:
            done = []
            for conv, part, text, loss in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if part == 0:
                    if state:
                        done.append(row(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                at = 0
                while at < len(text):
                    m = _TURN.match(text, at)
                    if not m:
                        raise ValueError(f"conversation {conv}: not a formatted turn at {at}")
                    state[1] += 1
                    state[2].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                    at = m.end()
                for span in loss:
                    learned = unescape(text[span["start"]:span["start"] + span["length"]])
                    state[3] += len(learned)
                    state[4].update(learned.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            yield _rows(done)
        if state:
            yield _rows([row(state)])

    def _rows(done):
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        columns = list(zip(*done)) if done else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return parts.mapInArrow(run, DIGESTS)
