"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut at safe boundaries before they are encoded: where white space follows another character. The
pattern starts a new match there, so the ids of the parts are the ids of the whole. Long runs of white space,
which the library's matcher can't go through (it keeps a state for each character), are matched by another
engine, and each match is given to the encoder as one piece. Decoding joins the tokens' raw bytes, so ids that
cut a character in two still give back the exact bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from leafworks.llm.shared import small_batches

#: Characters after which the next safe boundary is taken.
PART_CHARS = 50_000
#: Runs of white space of this length go to the other engine.
RUN_CHARS = 1000
#: Unicode's white space, as the pattern's `\s` has it.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SAFE = re.compile(f"(?<=[^{SPACES}])(?=[{SPACES}])")
RUN = re.compile(f"[{SPACES}]{{{RUN_CHARS},}}")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def matcher(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def parts(text: str) -> Iterator[str]:
    """The text in parts that can be encoded one by one."""
    start = 0
    while len(text) - start > PART_CHARS:
        cut = SAFE.search(text, start + PART_CHARS)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str, path: str, pattern: str) -> list[int]:
    """The ids of a whole text, of any length and with runs of any length.

    pattern: one in which white space after another character begins a match.
    """
    enc = encoding(path, pattern)
    if len(text) < RUN_CHARS:
        return enc.encode_ordinary(text)
    ids, start = [], 0
    for run in RUN.finditer(text):
        for part in parts(text[start : run.start()]):
            ids += enc.encode_ordinary(part)
        start, size = run.end(), run.end() - run.start()
        # With the character after the run: a match that goes beyond the run begins the rest of the text.
        for match in matcher(pattern).finditer(text[run.start() : run.end() + 1]):
            if match.end() > size:
                start = run.start() + match.start()
                break
            ids += enc._encode_single_piece(match.group())
    for part in parts(text[start:]):
        ids += enc.encode_ordinary(part)
    return ids


def decode(ids: list[int], path: str, pattern: str) -> bytes:
    return encoding(path, pattern).decode_bytes(ids)


def encoded(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of each whole text; a null text is empty and has no ids.

    Every row gives one row, with null or repeated keys too. Other columns are dropped.
    Strings of special tokens are ordinary text.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = pa.array([encode(t or "", path, pattern) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decoded(ids: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, bytes binary) of each row of ids; null ids decode to no bytes."""
    small_batches(ids.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = pa.array([decode(x or [], path, pattern) for x in b.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), out], names=[key, "bytes"])

    kind = ids.schema[key].dataType.simpleString()
    return ids.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes each whole text, decodes its ids again and returns (key, n_tokens, ids_sha256, decoded_sha256).

    One pass: ids are not sent back to the JVM between encoding and decoding. Nulls and repeats as in encoded().
    """
    small_batches(docs.sparkSession)
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        decimal = [str(i).encode() for i in range(enc.n_vocab)]
        for b in batches:
            n, own, back = [], [], []
            for t in b.column(1).to_pylist():
                ids = encode(t or "", path, pattern)
                n.append(len(ids))
                own.append(hashlib.sha256(b",".join(map(decimal.__getitem__, ids))).hexdigest())
                back.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(own), pa.array(back)], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(key, text).mapInArrow(run, schema)
