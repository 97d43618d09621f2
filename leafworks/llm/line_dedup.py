"""Line de-duplication with two Bloom filters.

1. Each task notes the hashes of its documents' line keys (each once a document) in two filters: seen once, and
   seen twice. A task holds only the set positions of its own keys, so its memory and what it sends grow with its
   rows, not with the filters. Filters of two tasks merge exactly like a carry: twice = twice | twice' |
   (once & once'), once = once | once'. A key of two documents has all its bits in both once-filters, so it can't
   be missed; a key of one document gets through only by chance. Filters travel in segments of sparse positions,
   merged by segment number, so no task gathers more than one segment.
2. Only suspected repeats (keys in the merged twice-filter) are shuffled: as 128-bit hashes with their document,
   counted exactly and given the document that keeps them. Counting combines in each task first. Lines of very
   many rows, of which there can only be a few, are joined apart from the others.
3. The lines to drop are gathered by document. A third filter, of the documents that lose lines, goes to the scan:
   documents that it doesn't name are handed on where they are read, only the others move to meet their lines and are
   rewritten.

The filters are sized by the number of lines, BITS_PER_LINE bits each, so that few keys of one document get
through; MAX_BITS bounds what is broadcast (128 MB). Beyond about 60 million lines (some 40 GB of text) they fill up and let more lines
through to the exact count; they never change the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafworks.llm.shared import BLANK_CHARS, discard, free, small_batches, text_or_empty, written

MIN_BITS, MAX_BITS, BITS_PER_LINE = 1 << 21, 1 << 30, 16
SEGMENT_BITS = 1 << 21
PROBES = 2
#: Keys after which a task sends its filters on and begins new ones.
CHUNK_KEYS = 1 << 21
#: A line of this share of the suspects' rows, or more, is joined apart; so there are 1 / HOT_SHARE such lines at most.
HOT_SHARE = 1e-4
#: Keys that are broadcast themselves at most, some 10 MB.
BROADCAST_KEYS = 100_000
#: A-Z to a-z, for keys.
LOWER = {c: c + 32 for c in range(65, 91)}


def line_keys(text: str, min_chars: int) -> list[bytes | None]:
    """A 16-byte hash of each line's key, None for keys that are too short."""
    digest, out = xxhash.xxh3_128_digest, []
    for line in text.split("\n"):
        key = line.strip(BLANK_CHARS)
        out.append(digest((key.lower() if key.isascii() else key.translate(LOWER)).encode()) if len(key) >= min_chars else None)
    return out


def positions(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions (PROBES a key) of an array of keys as pairs of unsigned 64-bit numbers; bits: a power of two."""
    a, b = keys[:, 0], keys[:, 1] | np.uint64(1)
    with np.errstate(over="ignore"):
        return ((a[:, None] + b[:, None] * np.arange(PROBES, dtype=np.uint64)) >> np.uint64(20)) & np.uint64(bits - 1)


def as_pairs(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)


def filter_bits(docs: DataFrame, text: str) -> int:
    """The filters' size: a power of two, by the number of lines."""
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    lines = docs.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1).alias("n")).first()["n"] or 0
    return min(MAX_BITS, max(MIN_BITS, 1 << (BITS_PER_LINE * lines - 1).bit_length()))


def segments(keys: list[bytes], bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(segment, once, twice) of the filters of some documents' keys, repeats in one document left out."""
    pairs = as_pairs(sorted(keys))
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
    once = np.unique(positions(pairs[new], bits))
    twice = np.unique(positions(pairs[~new], bits))
    edges = np.arange(0, bits + 1, SEGMENT_BITS, dtype=np.uint64)
    a, b = np.searchsorted(once, edges), np.searchsorted(twice, edges)
    for k in np.flatnonzero(np.diff(a)).tolist():
        yield k, sparse(once[a[k] : a[k + 1]] - edges[k]), sparse(twice[b[k] : b[k + 1]] - edges[k])


def has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def sparse(at: np.ndarray) -> bytes:
    """Rising positions as compressed differences."""
    steps = np.diff(at.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return b"s" + zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def packed(segment: np.ndarray) -> bytes:
    """A segment's set bits as sparse positions where there are few of them, else its compressed bytes."""
    at = np.flatnonzero(np.unpackbits(segment, bitorder="little"))
    return sparse(at) if len(at) < SEGMENT_BITS // 64 else b"d" + zlib.compress(segment.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data[1:])
    if data[:1] == b"d":
        return np.frombuffer(raw, np.uint8).copy()
    at = np.cumsum(np.frombuffer(np.frombuffer(raw, np.uint8).reshape(4, -1).T.tobytes(), "<u4"))
    bits = np.zeros(SEGMENT_BITS, np.uint8)
    bits[at] = 1
    return np.packbits(bits, bitorder="little")


def merged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one task, sorted by segment: one row for each segment, merged as they come."""
    number, once, twice = None, None, None
    for part in parts:
        for s, a, b in zip(part["segment"], part["once"], part["twice"], strict=True):
            a, b = unpacked(a), unpacked(b)
            if s == number:
                twice |= b | (once & a)
                once |= a
                continue
            if number is not None:
                yield pd.DataFrame({"segment": [number], "once": [packed(once)], "twice": [packed(twice)]})
            number, once, twice = s, a, b
    if number is not None:
        yield pd.DataFrame({"segment": [number], "once": [packed(once)], "twice": [packed(twice)]})


def twice_filter(docs: DataFrame, text: str, min_chars: int, bits: int) -> dict[int, bytes]:
    """The merged twice-filter over all documents: its segments, packed."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(held: list[bytes]) -> Iterator[pa.RecordBatch]:
            for s, once, twice in segments(held, bits):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([once]), pa.array([twice])], names=["segment", "once", "twice"])

        held = []
        for b in batches:
            for t in b.column(0).to_pylist():
                held += set(line_keys(t, min_chars)) - {None}
                if len(held) > CHUNK_KEYS:
                    yield from made(held)
                    held = []
        yield from made(held)

    shape = "segment int, once binary, twice binary"
    parts = docs.select(text_or_empty(text).alias("t")).mapInArrow(build, shape)
    whole = parts.repartition(max(1, bits // SEGMENT_BITS), "segment").sortWithinPartitions("segment").mapInPandas(merged, shape)
    return {r.segment: bytes(r.twice) for r in whole.select("segment", "twice").collect()}  # MAX_BITS / 8 bytes at most


def whole_filter(found: dict[int, bytes], bits: int) -> np.ndarray:
    out, size = np.zeros(bits // 8, np.uint8), SEGMENT_BITS // 8
    for k, part in found.items():
        out[k * size : (k + 1) * size] = unpacked(part)
    return out


def member_filter(keys: DataFrame) -> tuple[dict[int, bytes], int]:
    """A filter of the keys (a, b: two hashes) that names all of them and few others, and its size; keys are distinct."""
    n = keys.count()
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (BITS_PER_LINE * n - 1).bit_length()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = np.stack([b.column(c).to_numpy().view(np.uint64) for c in range(2)], axis=1)
            for s, once, twice in segments([p.tobytes() for p in pairs], bits):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([once]), pa.array([twice])], names=["segment", "once", "twice"])

    shape = "segment int, once binary, twice binary"
    parts = keys.select("a", "b").mapInArrow(build, shape)
    whole = parts.repartition(max(1, bits // SEGMENT_BITS), "segment").sortWithinPartitions("segment").mapInPandas(merged, shape)
    return {r.segment: bytes(r.once) for r in whole.select("segment", "once").collect()}, bits  # MAX_BITS / 8 bytes at most


def named_by(docs: DataFrame, found: dict[int, bytes], bits: int) -> Callable[[Column, Column], Column]:
    """Whether the filter names a row, by its key's two hashes, which alone go to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(found)

    @F.arrow_udf("boolean")
    def named(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        whole = whole_filter(shared.value, bits)
        for a, b in parts:
            pairs = np.stack([x.to_numpy().view(np.uint64) for x in (a, b)], axis=1)
            yield pa.array(has(whole, positions(pairs, bits)) if len(pairs) else np.zeros(0, bool))

    return named


def without_keys(rows: DataFrame, gone: DataFrame, a: Column, b: Column, narrow: DataFrame | None = None) -> DataFrame:
    """The rows whose key (a, b: two hashes) isn't among the distinct keys of gone; whole rows hardly move.

    Up to BROADCAST_KEYS keys go to the scan themselves. Of more a filter goes there: rows that it doesn't name stay where
    they are read. Of the few others that it names by chance a second filter is made, and only rows that both name move,
    to be told apart by their keys. narrow: rows with the columns that a and b need, if these can be had for less than rows.
    """
    own_a, own_b = free("_a", rows), free("_b", rows)
    if gone.count() <= BROADCAST_KEYS:
        keys = gone.select(F.col("a").alias(own_a), F.col("b").alias(own_b))
        return rows.withColumns({own_a: a, own_b: b}).join(F.broadcast(keys), [own_a, own_b], "left_anti").drop(own_a, own_b)
    one = named_by(rows, *member_filter(gone))(a, b)
    narrow = rows if narrow is None else narrow
    by_chance = written(narrow.where(one).select(a.alias("a"), b.alias("b")).distinct().join(gone.select("a", "b"), ["a", "b"], "left_anti"))
    two = named_by(rows, *member_filter(by_chance))(a, b)
    few = by_chance.withColumnsRenamed({"a": own_a, "b": own_b})
    moved = rows.where(one).where(two).withColumns({own_a: a, own_b: b}).join(few, [own_a, own_b], "left_semi")
    return rows.where(~one).unionByName(moved.drop(own_a, own_b))


def hot_apart(found: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """found joined with repeated by line: the few lines of very many rows against a broadcast list."""
    hot = repeated.where(F.col("n") >= max(1000, int(total * HOT_SHARE)))
    cold = repeated.where(F.col("n") < max(1000, int(total * HOT_SHARE)))
    rest = found.join(F.broadcast(hot.select("line")), "line", "left_anti")
    return found.join(F.broadcast(hot), "line").unionByName(rest.join(cold, "line"))


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """docs with the repeated lines taken out of text, and n_lines (before) and n_dropped as long columns.

    A line's key is the line without white space at both ends, A-Z in lower case. Keys of min_chars code points or
    more that min_docs documents or more hold lose all their lines except in the document with the largest key
    column. Other lines stay, joined by \\n. A null text is empty, with one empty line, and comes back empty.
    Each row is a document of its own in the count; rows that repeat the largest key all keep the line, and rows
    that repeat a key lose the same lines. A null key comes before all others. An empty table gives an empty
    table. Columns named n_lines or n_dropped are replaced; all others stay.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("n_lines", "n_dropped")
    bits = filter_bits(docs, text)
    shared = spark.sparkContext.broadcast(twice_filter(docs, text, min_chars, bits))
    kind = docs.schema[key].dataType.simpleString()

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = whole_filter(shared.value, bits)
        for b in batches:
            keys = [[*(set(line_keys(t, min_chars)) - {None})] for t in b.column(2).to_pylist()]
            flat = [k for ks in keys for k in ks]
            row = np.repeat(np.arange(len(keys)), [len(ks) for ks in keys])
            hit = np.flatnonzero(has(twice, positions(as_pairs(flat), bits))) if flat else np.zeros(0, int)
            own = [c.take(pa.array(row[hit])) for c in b.columns[:2]]
            yield pa.RecordBatch.from_arrays([*own, pa.array([flat[i] for i in hit], pa.binary())], names=["id", "h", "line"])

    # With a hash of the text: rows that repeat a key, or have none, then keep their lines apart.
    texts = docs.select(F.col(key).alias("id"), F.xxhash64(text_or_empty(text)).alias("h"), text_or_empty(text).alias("t"))
    found = written(texts.mapInArrow(suspects, f"id {kind}, h long, line binary"))
    repeated = found.groupBy("line").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs)
    lost = hot_apart(found, repeated, found.count()).where(~F.col("id").eqNullSafe(F.col("keeper")))
    lost = written(lost.groupBy("id", "h").agg(F.collect_set("line").alias("lines")))
    discard(found)
    row_key = lambda i, h: (F.xxhash64(i, h), F.xxhash64(h, i, F.lit(1)))
    a, b = row_key("id", "h")
    named = named_by(docs, *member_filter(lost.select(a.alias("a"), b.alias("b"))))(*row_key(F.col(key), F.xxhash64(text_or_empty(text))))
    own_id, own_hash, own_lines = free("_id", docs), free("_h", docs), free("_lines", docs)
    lost = lost.withColumnsRenamed({"id": own_id, "h": own_hash, "lines": own_lines})
    same = F.col(key).eqNullSafe(F.col(own_id)) & (F.xxhash64(text_or_empty(text)) == F.col(own_hash))
    joined = docs.where(named).join(lost, same, "left").drop(own_id, own_hash)
    at = joined.columns.index(text)
    schema = docs.select("*", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")).schema

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for t, drop in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                t, gone = t or "", 0
                n = t.count("\n") + 1
                if drop:
                    lines, drop = t.split("\n"), set(drop)
                    kept = [line for line, k in zip(lines, line_keys(t, min_chars), strict=True) if k not in drop]
                    t, gone = "\n".join(kept), len(lines) - len(kept)
                texts.append(t)
                n_lines.append(n)
                n_dropped.append(gone)
            columns = [*b.columns[:-1], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names[:-1], "n_lines", "n_dropped"])

    whole = text_or_empty(text)
    breaks = (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit("")))).cast("long")
    rest = docs.where(~named).withColumns({text: whole, "n_lines": breaks + 1, "n_dropped": F.lit(0).cast("long")})
    return rest.unionByName(joined.mapInArrow(rewrite, schema))
