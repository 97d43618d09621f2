"""Exact de-duplication over an extendible-hash index, in DataFrame operations only.

1. Every row's entry (key, 64-bit hash, SHA-256 and size of the normalised text) is written once to the shared folder:
   the index. Texts stay where they are.
2. The directory: the hash's first bits name a slot; one counter a slot says how many bytes of text lie there. Starting
   from one bucket, a bucket that is over its capacity is split by doubling the directory, until it fits. The directory
   doubles as far as the texts need, to 2**MAX_DEPTH slots at most (100 MB a slot at 100 TB). A bucket that can't be
   split any more, as one chain of copies fills it, gets several owners, and its rows are dealt over them.
3. Consecutive buckets are given to owner tasks, so each owner holds a range of hashes. A text moves once, to its owner.
   There, entries of one hash form a chain and are told apart by comparing bytes (the grouping key is the text itself,
   not its digest). Nothing is grouped by its text before. What several owners found in the parts of one bucket is
   compared by bytes once more; all others hand on digests and counts alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafworks.llm.shared import discard, text_or_empty, without_blanks, written

#: Bytes of text of an owner, which grow once there would be more than MAX_OWNERS of them.
MAX_DEPTH, BUCKET_BYTES, MAX_OWNERS = 20, 32 << 20, 50_000
TWO_63, TWO_64 = "9223372036854775808BD", "18446744073709551616BD"


def normalised(docs: DataFrame, key: str, text: str, hashed: Callable[[str], Column] = F.xxhash64) -> DataFrame:
    """(id, n_cp, norm, h) of each row. hashed: the 64-bit hash of a column."""
    original = text_or_empty(text)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.length(original).cast("long").alias("n_cp"), without_blanks(original).alias("norm"))
    return rows.select("*", hashed("norm").cast("long").alias("h"))


def index(rows: DataFrame) -> DataFrame:
    """The index's entries (id, h, sha, n_bytes), written to the shared folder. rows: as from normalised()."""
    return written(rows.select("id", "h", F.unhex(F.sha2("norm", 256)).alias("sha"), F.octet_length("norm").cast("long").alias("n_bytes")))


def split(loads: dict[int, int], capacity: int, max_depth: int = MAX_DEPTH) -> dict[int, tuple[int, int]]:
    """slot -> (prefix, local depth) of its bucket: overfull buckets are split, the directory doubling on demand."""
    buckets, done = {(0, 0): loads}, {}
    while buckets:
        (prefix, depth), held = buckets.popitem()
        if depth == max_depth or sum(held.values()) <= capacity:
            done |= dict.fromkeys(held, (prefix, depth))
            continue
        for bit in (0, 1):
            if half := {s: n for s, n in held.items() if s >> (max_depth - depth - 1) & 1 == bit}:
                buckets[prefix << 1 | bit, depth + 1] = half
    return done


def directory(entries: DataFrame, capacity: int = BUCKET_BYTES) -> tuple[DataFrame, int, int]:
    """(slot, owner, shares) of each slot in use, the bits of a slot's number, and the number of owners. A slot's rows go
    to `shares` owners from `owner` on."""
    slots = entries.groupBy(F.shiftrightunsigned("h", 64 - MAX_DEPTH).alias("slot")).agg((F.sum("n_bytes") + F.count("*")).alias("load"))
    slots = written(slots)
    total = slots.agg(F.sum("load")).first()[0] or 0
    capacity = max(capacity, -(-total // MAX_OWNERS))
    depth = min(MAX_DEPTH, (16 * total // capacity).bit_length())
    loads = {r.slot: r.load for r in slots.groupBy(F.shiftright("slot", MAX_DEPTH - depth).alias("slot")).agg(F.sum("load").alias("load")).collect()}
    discard(slots)
    found = split(loads, capacity, depth)
    sums: dict[tuple[int, int], int] = {}
    for s, bucket in found.items():
        sums[bucket] = sums.get(bucket, 0) + loads[s]
    owners, held, last, shares, rows = 0, capacity, None, 1, []
    for s in sorted(found):
        if found[s] != last:
            last = found[s]
            if held + sums[last] > capacity:
                shares = -(-sums[last] // capacity)
                owners, held = owners + shares, 0
            held += sums[last]
        rows.append((s, owners - shares, shares))
    return entries.sparkSession.createDataFrame(rows, "slot long, owner int, shares int"), depth, owners


def owned(rows: DataFrame, slots: DataFrame, depth: int, owners: int) -> DataFrame:
    """(owner, shares, h, norm, rank) of each row, in the task of its owner: the only move of texts."""
    # The largest rank stays: more code points, then the smaller id (null: after all others).
    rank = F.col("n_cp").cast("decimal(18,0)") * F.expr(TWO_64) - F.coalesce("id", F.lit(2**63 - 1)).cast("decimal(38,0)")
    slot = F.when(F.lit(depth > 0), F.shiftrightunsigned("h", 64 - max(depth, 1))).otherwise(F.lit(0).cast("long"))
    ranked = rows.select("h", "norm", rank.cast("decimal(38,0)").alias("rank"), slot.alias("slot"), F.xxhash64("id", F.spark_partition_id()).alias("deal"))
    found = ranked.join(F.broadcast(slots), "slot").withColumn("owner", F.col("owner") + F.pmod("deal", F.col("shares")).cast("int"))
    return found.select("owner", "shares", "h", "norm", "rank").repartitionById(max(owners, 1), "owner")


def groups(rows: DataFrame, entries: DataFrame, capacity: int = BUCKET_BYTES) -> DataFrame:
    """One row for each distinct normalised text: h, sha, group_size, keep_id."""
    slots, depth, owners = directory(entries, capacity)
    chains = owned(rows, slots, depth, owners).groupBy("owner", "h", "norm").agg(F.count("*").alias("n"), F.max("rank").alias("rank"), F.max("shares").alias("shares"))
    parts = chains.select("h", F.unhex(F.sha2("norm", 256)).alias("sha"), F.when(F.col("shares") > 1, F.col("norm")).alias("text"), "n", "rank")
    found = parts.groupBy("h", "sha", "text").agg(F.sum("n").alias("group_size"), F.max("rank").alias("rank"))
    low = F.pmod("rank", F.expr(TWO_64))  # 2**64 - id for id > 0, -id for others
    keep = (F.when(low > F.expr(TWO_63), F.expr(TWO_64) - low).otherwise(-low)).cast("long")
    return found.select("h", "sha", "group_size", F.when(keep < 2**63 - 1, keep).alias("keep_id"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = BUCKET_BYTES, hashed: Callable[[str], Column] = F.xxhash64) -> DataFrame:
    """One row per row of docs: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after deleting white space. Of equal texts the row with the most code
    points in the original text, then with the smallest key, stays. Null texts are empty texts; empty texts are
    equal to each other. A null key comes after all others. Rows that repeat the staying row's key all stay.
    An empty table gives an empty table; columns other than key and text are not looked at.
    """
    rows = normalised(docs, key, text, hashed)
    entries = index(rows)
    narrow = entries.select("id", "h", "sha")
    # Null-safe: a plain equality would be inferred as a filter below the aggregation and hash every row again.
    found = groups(rows, entries, capacity).withColumnsRenamed({"h": "_h", "sha": "_sha"})
    found = narrow.join(found, (F.col("h") == F.col("_h")) & F.col("sha").eqNullSafe(F.col("_sha")))
    return found.select(F.col("id").alias(key), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
