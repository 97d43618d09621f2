"""Chat formatting by columnar byte assembly.

Rows arrive sorted by conversation and turn. For each batch the lengths of all segments (headers, roles, texts,
ends) are laid out as one array; their running sum gives every segment's offset; one gather then copies the bytes
of constants, roles and texts from a common pool into one preallocated Arrow buffer. No row is formatted by
itself in Python.

Template: each turn is `<|turn|>role<|text|>text<|end|>`. Inside roles and texts a control string can't appear:
every `<|`, and every `<` with backslashes before `|`, gets one more backslash between them; undoing it takes
one away. Trained are the texts of assistant turns, as spans of code points of the formatted string.
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

from leafworks.llm.shared import small_batches

#: The template's control strings and the role that is trained.
TURN, TEXT, END, TRAINED = "<|turn|>", "<|text|>", "<|end|>", "assistant"
FORMATTED = "n_turns long, formatted string, loss_spans array<struct<start:long,length:long>>"


def escaped(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, r"<(\\*)\|", r"<\1\\|")


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def as_large(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "").cast(pa.large_string())


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array without nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """One buffer with all turns after another, and the offset where each row's turn starts (and the end)."""
    n = len(roles)
    role_at, role_bytes = bytes_of(roles)
    text_at, text_bytes = bytes_of(texts)
    marks = [np.frombuffer(s.encode(), np.uint8) for s in (TURN, TEXT, END)]
    pool = np.concatenate([*marks, role_bytes, text_bytes])
    base = np.cumsum([0, *(len(m) for m in marks), len(role_bytes)])
    source, length = np.empty((n, 5), np.int64), np.empty((n, 5), np.int64)
    segments = [
        (base[0], len(marks[0])), (base[3] + role_at[:-1], np.diff(role_at)), (base[1], len(marks[1])),
        (base[4] + text_at[:-1], np.diff(text_at)), (base[2], len(marks[2])),
    ]
    for column, (at, size) in enumerate(segments):
        source[:, column], length[:, column] = at, size
    ends = np.cumsum(length.ravel())
    starts = ends - length.ravel()
    total = int(ends[-1]) if n else 0
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, np.uint8)
    step = 1 << 22  # bytes copied at a time: the index array takes eight times as many
    first = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + step, "right")))
        size = length.ravel()[first:last]
        at = np.repeat(source.ravel()[first:last] - starts[first:last], size) + np.arange(starts[first], ends[last - 1])
        np.take(pool, at, out=out[starts[first] : ends[last - 1]])
        first = last
    return buffer, np.concatenate([starts.reshape(n, 5)[:, 0], [total]])


def formatted_batch(keys: pa.Array, roles: pa.Array, texts: pa.Array, key: str) -> pa.RecordBatch:
    """Whole conversations, rows of one next to each other."""
    roles, texts = as_large(roles), as_large(texts)
    trained = pc.equal(roles, TRAINED).to_numpy(zero_copy_only=False).astype(bool)
    roles, texts = escaped(roles), escaped(texts)
    buffer, starts = assemble(roles, texts)
    coded = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False)
    nulls = keys.is_null().to_numpy(zero_copy_only=False)
    change = np.flatnonzero((coded[1:] != coded[:-1]) | (nulls[1:] != nulls[:-1])) + 1
    first = np.concatenate([[0], change]).astype(np.int64)
    bounds = np.concatenate([first, [len(coded)]])
    offsets = starts[bounds]
    out = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), buffer])
    role_chars, text_chars = pc.utf8_length(roles).to_numpy(), pc.utf8_length(texts).to_numpy()
    turn_chars = role_chars.astype(np.int64) + text_chars + len(TURN) + len(TEXT) + len(END)
    at = np.cumsum(turn_chars) - turn_chars
    text_start = at + len(TURN) + role_chars + len(TEXT) - np.repeat(at[first], np.diff(bounds))
    rows = np.flatnonzero(trained)
    spans = pa.StructArray.from_arrays([pa.array(text_start[rows]), pa.array(text_chars[rows].astype(np.int64))], ["start", "length"])
    span_at = np.searchsorted(rows, bounds).astype(np.int32)
    masks = pa.ListArray.from_arrays(pa.array(span_at), spans)
    return pa.RecordBatch.from_arrays([keys.take(pa.array(first)), pa.array(np.diff(bounds)), out.cast(pa.string()), masks], names=[key, "n_turns", "formatted", "loss_spans"])


def format_chats(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, n_turns, formatted, loss_spans) of each conversation.

    Rows go by turn (null first), ties by role, then text; repeated rows are turns of their own. A null role or
    text is empty; rows with a null key make one conversation. An empty table gives an empty table. Other columns
    are not used. A conversation is one row of the output, so its text has to fit into one; nothing else is held.
    """
    small_batches(turns.sparkSession)
    kind = turns.schema[key].dataType.simpleString()
    rows = turns.select(key, turn, role, text).repartition(F.col(key)).sortWithinPartitions(key, turn, role, text).select(key, role, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(0)
            begin = int(pc.index(keys.is_null() if not keys[-1].is_valid else pc.equal(keys, keys[-1]), True).as_py())
            if held and begin == 0 and keys[-1].as_py() == last:
                held.append(b)
                continue
            # All before the batch's last conversation is whole.
            ready = pa.Table.from_batches([*held, b.slice(0, begin)]).combine_chunks()
            held, last = [b.slice(begin)], keys[-1].as_py()
            if ready.num_rows:
                yield formatted_batch(*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in ready.columns), key)
        if held:
            ready = pa.Table.from_batches(held).combine_chunks()
            yield formatted_batch(*(c.combine_chunks() for c in ready.columns), key)

    return rows.mapInArrow(run, f"`{key}` {kind}, {FORMATTED}")


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from a formatted conversation."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(TURN).partition(TEXT)
        turns.append((unescaped(role), unescaped(text)))
    return turns


def read_back(chats: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all from the formatted strings and spans."""
    small_batches(chats.sparkSession)
    kind = chats.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for formatted, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                turns = parse(formatted)
                whole = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
                loss = "".join(unescaped(formatted[s["start"] : s["start"] + s["length"]]) for s in spans)
                out.append((len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array([x[i] for x in out], kinds[i]) for i in range(5)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=[key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return chats.select(key, "formatted", "loss_spans").mapInArrow(run, schema)
