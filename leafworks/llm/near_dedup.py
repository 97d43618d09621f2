"""Near-duplicate detection: one-permutation MinHash, banded buckets, star-shaped candidates, exact confirmation.

1. One pass over the texts gives each document its sketch: shingles are hashed once (rolling sums over the bytes,
   in numpy), the hash's top bits name one of BINS bins, and each bin keeps its minimum. An empty bin borrows from
   another bin, tried in an order that depends only on the bin and the attempt (optimal densification).
2. Documents with the same shingle set are linked by the set's 128-bit digest, and only the smallest of them, a
   node of the graph, goes on. So thousands of copies make one row.
3. ROWS bins make a band's key; BANDS keys a document. In each bucket two hubs are taken (the smallest node, and the
   smallest by a hash that differs from band to band), and each member is paired with the hubs alone: pairs grow
   with the documents, not with the square of a bucket. Pairs whose set sizes alone rule out a link are left out.
4. Round one confirms one pair a node, with the hub that shares the most buckets, on the full shingle sets.
   Round two confirms all other star pairs whose ends are still in different components.
5. A bucket whose members besides the hubs still lie in several components is open: pairs of them were never looked
   at. All members of open buckets go through an exact similarity join: a node's shingles are ordered from rare to
   frequent (those that only one component holds first), and two nodes that are similar enough share one of the
   first few of them (a quarter of the larger set, a seventh of the smaller one). Their places there bound how much
   two sets can share, and so do PARITY_WORDS words of parity bits: sets whose bits differ in d places differ in d
   shingles at least. What these bounds leave is confirmed on the full sets. Nothing is lost, and text that many
   documents share comes last in the order, so it makes no pairs unless it is nearly all that both documents have.
6. Components come from alternating large-star and small-star steps on tables, never on the driver.

A link is missed only if no band catches it, at a similarity of 0.75 with probability (1 - 0.75**ROWS)**BANDS =
5e-6.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafworks.llm.shared import discard, small_batches, text_or_empty, written

WORDS, PERCENT = 5, 75
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
#: 64-bit words of parity bits that a set gets for the exact join.
PARITY_WORDS = 16
#: Members that a hub's text is sent to at a time, on average.
MEMBERS = 256
#: Odd multiplier of the rolling sums, its inverse, and multipliers that mix hashes (fixed values).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_BYTES = np.array([int.from_bytes(xxhash.xxh3_64_digest(bytes([b + 32 if 65 <= b <= 90 else b])), "little") for b in range(256)], np.uint64)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Bytes of text hashed at a time, unless one text is longer.
PART_BYTES = 1 << 20
BLANK_BYTE = re.compile(rb"[\x20\x09-\x0D]")


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and INVERSE**i for i up to n, modulo 2**64."""
    if not _powers or len(_powers["up"]) <= n:
        size = max(n + 1, PART_BYTES + 1)
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of raw."""
    raw = np.frombuffer(raw + b"\n", np.uint8)
    edge = np.diff(_BLANK[raw].view(np.int8), prepend=np.int8(1))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)), start


def long_word_hashes(text: bytes) -> np.ndarray:
    """The same for a long text, in parts that end at blanks."""
    found, at = [], 0
    while at < len(text):
        cut = BLANK_BYTE.search(text, min(at + PART_BYTES, len(text)))
        end = cut.start() if cut else len(text)
        found.append(word_hashes(text[at:end])[0])
        at = end + 1
    return np.concatenate(found)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text: A-Z lower-cased, words split at the six blanks."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0
    for t in texts:
        if part and size + len(t) > PART_BYTES:
            out += short_sets(part, words)
            part, size = [], 0
        if len(t) > PART_BYTES:
            w = long_word_hashes(t)
            out.append(one_set(w, rolled(w, words), words))
            continue
        part.append(t)
        size += len(t) + 1
    return out + short_sets(part, words) if part else out


def rolled(word: np.ndarray, words: int) -> np.ndarray:
    n = max(len(word) - words + 1, 0)
    h = np.zeros(n, np.uint64)
    for k in range(words):
        h = mixed(h * np.uint64(BASE) + word[k : k + n])
    return h


def one_set(word: np.ndarray, shingles: np.ndarray, words: int) -> np.ndarray:
    if len(word) >= words:
        return np.unique(shingles)
    h = np.zeros(min(len(word), 1), np.uint64)
    for w in word:  # fewer words: the whole sequence is one shingle
        h = mixed(h * np.uint64(BASE) + w)
    return mixed(h + np.uint64(len(word)))


def short_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    word, start = word_hashes(b"\n".join(texts))
    bounds = np.concatenate([[0], np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))])
    shingles = rolled(word, words)
    return [one_set(word[a:b], shingles[a : max(a, b - words + 1)], words) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _attempts(tries: int = 4096) -> np.ndarray:
    """For each attempt and bin, the bin that an empty bin looks at."""
    k = np.arange(tries, dtype=np.uint64)[:, None] * np.uint64(BINS) + np.arange(BINS, dtype=np.uint64)
    return (mixed(k * np.uint64(BASE) + np.uint64(1)) >> np.uint64(40)).astype(np.int64) % BINS


_LOOK = _attempts()


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each bin, empty bins densified; shingles: not empty."""
    bins = (shingles >> np.uint64(57)).astype(np.int64)  # sorted, as the shingles are
    out = np.zeros(BINS, np.uint64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    full = np.zeros(BINS, bool)
    full[bins[first]] = True
    out[bins[first]] = shingles[first]
    empty = np.flatnonzero(~full)
    if len(empty):
        # The first attempt at which a full bin is looked at; attempts go on for the bins that are still empty.
        at, source, left, tried = np.zeros(len(empty), np.int64), np.full(len(empty), bins[0]), np.arange(len(empty)), 0
        step = max(8, BINS // len(first))
        while len(left) and tried < len(_LOOK):
            look = _LOOK[tried : tried + step, empty[left]]
            hits = full[look]
            k = hits.argmax(axis=0)
            hit = hits[k, np.arange(len(left))]
            at[left[hit]], source[left[hit]] = tried + k[hit], look[k[hit], np.flatnonzero(hit)]
            left, tried = left[~hit], tried + step
        out[empty] = mixed(out[source] + (at.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))
    return out


def bands(sign: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band."""
    rows = sign.reshape(BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        h = mixed(h * np.uint64(BASE) + rows[:, k])
    return h.view(np.int64)


def sketches(docs: DataFrame, key: str, text: str, words: int = WORDS) -> DataFrame:
    """(row, id, t, n_shingles, digest, bands) of each row, written; row is unique, digest and bands are null
    without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for b in batches:
            n, digests, keys = [], [], []
            for s in shingle_sets([t.encode() for t in b.column(1).to_pylist()], words):
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(bands(signature(s)) if len(s) else None)
            columns = {
                "row": pa.array(np.arange(row, row + len(n))), "id": b.column(0), "t": b.column(1), "n_shingles": pa.array(n, pa.int64()),
                "digest": pa.array(digests, pa.binary()), "bands": pa.array(keys, pa.list_(pa.int64())),
            }
            row += len(n)
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col(key).cast("long").alias("id"), text_or_empty(text).alias("t"))
    return written(rows.mapInArrow(run, "row long, id long, t string, n_shingles long, digest binary, bands array<long>"))


def bucket_members(reps: DataFrame) -> DataFrame:
    """(band, bucket, node, size, n, low, low_size, drawn, drawn_size) of each member of a bucket of n > 1 nodes,
    written; low and drawn are the bucket's hubs."""
    rows = reps.select("node", F.col("n_shingles").alias("size"), F.posexplode("bands").alias("band", "bucket"))
    mask = F.xxhash64("band")  # the smallest node after this mask is another member in each band
    drawn = F.min(F.col("node").bitwiseXOR(mask))
    found = rows.groupBy("band", "bucket").agg(F.count("*").alias("n"), F.min("node").alias("low"), drawn.alias("drawn")).where("n > 1")
    found = found.withColumn("drawn", F.col("drawn").bitwiseXOR(mask))
    for hub in ("low", "drawn"):
        found = found.join(reps.select(F.col("node").alias(hub), F.col("n_shingles").alias(f"{hub}_size")), hub)
    return written(rows.join(found, ["band", "bucket"]))


def star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(hub, member, shared) of each pair of a bucket's hub and another member: hub < member, buckets shared."""
    hubs = F.array(*(F.struct(F.col(h).alias("h"), F.col(f"{h}_size").alias("h_size")) for h in ("low", "drawn")))
    pairs = members.select("node", "size", F.inline(hubs)).where(f"node != h AND 100 * size >= {percent} * h_size AND 100 * h_size >= {percent} * size")
    return pairs.groupBy(F.least("node", "h").alias("hub"), F.greatest("node", "h").alias("member")).agg(F.count("*").alias("shared"))


def confirmed(pairs: DataFrame, held: DataFrame, percent: int, words: int) -> DataFrame:
    """(hub, member) of the pairs whose full sets are similar enough. held: (node, v), one row a node; v is a text,
    or the sorted array of its shingles.

    A hub's members are dealt in blocks of MEMBERS on average, and its own v goes once to each block, so a hub of very
    many members is neither copied to all of them nor one task's.
    """
    texts = held.schema["v"].dataType.simpleString() == "string"

    def sets_of(column: pa.Array) -> list[np.ndarray]:
        if texts:
            return shingle_sets([t.encode() for t in column.to_pylist()], words)
        return [v.values.to_numpy() for v in column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, None  # a block's hub comes before its members, which may go on in the next batch
        for b in batches:
            hubs, members = b.column(0).to_pylist(), b.column(3).to_pylist()
            keep = []
            for i, (h, member, own) in enumerate(zip(hubs, members, sets_of(b.column(4)), strict=True)):
                if member is None:
                    last, one = h, own
                    continue
                if h != last:
                    raise ValueError(f"members of {h} without their hub")
                both = np.intersect1d(one, own, assume_unique=True).size
                if 100 * both >= percent * (len(one) + len(own) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([hubs[i] for i in keep], pa.int64()), pa.array([members[i] for i in keep], pa.int64())], names=["hub", "member"])

    n = pairs.groupBy("hub").agg(F.ceil(F.count("*") / MEMBERS).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int").alias("block")
    dealt = pairs.select("hub", "member").join(n, "hub").select("hub", block, F.lit(1).alias("side"), "member")
    held = held.select("node", "v")
    members = dealt.join(held, F.col("member") == F.col("node")).drop("node")
    hubs = n.select("hub", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block")).join(held, F.col("hub") == F.col("node"))
    hubs = hubs.select("hub", "block", F.lit(0).alias("side"), F.lit(None).cast("long").alias("member"), "v")
    return members.unionByName(hubs).repartition("hub", "block").sortWithinPartitions("hub", "block", "side").mapInArrow(run, "hub long, member long")


def open_nodes(members: DataFrame, joined: DataFrame) -> DataFrame:
    """(node, component) of each member of an open bucket that isn't its hub, written. joined: (node, component)."""
    own = F.coalesce("component", "node").alias("component")
    rest = members.where("n > 2 AND node != low AND node != drawn").select("band", "bucket", "node")
    rest = rest.join(joined, "node", "left").select("band", "bucket", "node", own)
    found = rest.groupBy("band", "bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    return written(rest.join(found.select("band", "bucket"), ["band", "bucket"]).select("node", "component").distinct())


def parity(shingles: np.ndarray) -> np.ndarray:
    """For each of the bits, whether an odd number of shingles falls on it; as PARITY_WORDS signed words."""
    bits = 64 * PARITY_WORDS
    odd = np.bincount(((shingles >> np.uint64(7)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


PARITY = [f"w{k}" for k in range(PARITY_WORDS)]


def full_sets(nodes: DataFrame, held: DataFrame, words: int) -> DataFrame:
    """(node, component, v, w0, w1, ...) with the sorted shingles of each node's text and their parity, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = shingle_sets([t.encode() for t in b.column(2).to_pylist()], words)
            sets = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
            odd = np.array([parity(s) for s in found], np.int64).reshape(-1, PARITY_WORDS)
            columns = [b.column(0), b.column(1), sets, *(pa.array(odd[:, k]) for k in range(PARITY_WORDS))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "component", "v", *PARITY])

    shape = f"node long, component long, v array<long>, {', '.join(f'{w} long' for w in PARITY)}"
    return written(nodes.join(held, "node").select("node", "component", "v").mapInArrow(run, shape))


def rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """(token, node, component, n, place, first) of the shingles that nodes of several components hold, from those
    at the beginning of each node's order; first where the smaller node of a pair must have one."""
    rows = sets.select("node", "component", F.size("v").cast("long").alias("n"), F.explode("v").alias("token"))
    across = rows.groupBy("token").agg(F.count("*").alias("f"), F.min("component").alias("least"), F.max("component").alias("most"))
    rows = rows.join(across.where("least < most").select("token", "f"), "token")
    order = F.sort_array(F.collect_list(F.struct("f", "token")))
    nodes = rows.groupBy("node", "component", "n").agg(order.alias("o")).withColumn("own", F.col("n") - F.size("o"))
    # A link shares at least percent of the larger set, and 2 * percent / (100 + percent) of the smaller one.
    larger = F.expr(f"n - ({percent} * n + 99) DIV 100")
    smaller = F.expr(f"n - ({2 * percent} * n + {99 + percent}) DIV {100 + percent}")
    front = F.slice("o", 1, F.greatest(larger + 1 - F.col("own"), F.lit(0)).cast("int"))
    found = nodes.select("node", "component", "n", "own", F.posexplode(front).alias("k", "x"))
    place = F.col("own") + F.col("k")
    return written(found.select("x.token", "node", "component", "n", place.alias("place"), (place <= smaller).alias("first")))


def rare_pairs(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(hub, member) of nodes of different components that share a rare shingle and may still be similar enough."""
    entries = entries.join(sets.select("node", *PARITY), "node")
    small = entries.where("first").select("token", *(F.col(c).alias(f"s_{c}") for c in ("node", "component", "n", "place", *PARITY)))
    differ = sum(F.bit_count(F.col(w).bitwiseXOR(F.col(f"s_{w}"))) for w in PARITY)
    pairs = small.join(entries, "token").where(
        f"s_component != component AND (s_n < n OR s_n = n AND s_node < node) AND 100 * s_n >= {percent} * n"
        f" AND {100 + percent} * least(s_n - s_place, n - place) >= {percent} * (s_n + n)"
    )
    pairs = pairs.where((100 - percent) * (F.col("s_n") + F.col("n")) >= (100 + percent) * differ)
    return pairs.select(F.least("s_node", "node").alias("hub"), F.greatest("s_node", "node").alias("member")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each end of an edge, component the smallest node reachable.

    Alternating stars: each step hangs all larger neighbours, then all smaller ones, on the smallest neighbour.
    It ends when every edge leads to a root, after a number of steps that grows with the logarithm of the longest
    path. Hot nodes are combined in each task (a minimum) and joined, never gathered.
    """
    now = written(edges.select(F.greatest("hub", "member").alias("v"), F.least("hub", "member").alias("u")).where("u != v").distinct())
    while True:
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u != v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").where("u != m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        now, before = written(small.unionByName(low.select("v", F.col("m").alias("u"))).distinct()), now
        discard(before)
        # Done when no node is at once above and below another, or below two: all edges hang on roots, one a node.
        ends = now.select(F.col("v").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above"))
        ends = ends.unionByName(now.select(F.col("u").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above")))
        ends = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        if ends.where("below > 1 OR below = 1 AND above = 1").isEmpty():
            roots = now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
            return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)


def linked(reps: DataFrame, sketched: DataFrame, percent: int, words: int) -> DataFrame:
    """(hub, member) of links of nodes that connect all that links connect."""
    members = bucket_members(reps)
    pairs = written(star_pairs(members, percent))
    ends = members.select("node").distinct().join(reps.select("node", "row"), "node")
    held = written(sketched.select("row", F.col("t").alias("v")).join(ends, "row").select("node", "v"))
    best = written(pairs.groupBy("member").agg(F.max_by("hub", F.struct("shared", -F.col("hub"))).alias("hub")).select("hub", "member"))
    links = written(confirmed(best, held, percent, words))
    joined = written(components(links))
    rest = pairs.join(best, ["hub", "member"], "left_anti")
    for end in ("hub", "member"):
        rest = rest.join(joined.select(F.col("node").alias(end), F.col("component").alias(f"{end}_of")), end, "left")
    rest = written(rest.where(F.coalesce("hub_of", "hub") != F.coalesce("member_of", "member")).select("hub", "member"))
    discard(pairs, best, joined)
    both = written(links.unionByName(confirmed(rest, held, percent, words)))
    discard(links, rest)
    nodes = open_nodes(members, components(both))
    sets = full_sets(nodes, held, words)
    discard(members, held)
    entries = rare_first(sets, percent)
    pairs = written(rare_pairs(entries, sets, percent))
    discard(entries)
    whole = written(both.unionByName(confirmed(pairs, sets, percent, words)))
    discard(both, nodes, sets, pairs)
    return whole


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """One row per row of docs: key, n_shingles, component_id (smallest key reachable over links), kept.

    Two documents are linked when 100 * intersection >= percent * union of their shingle sets. With fewer than
    `words` words the whole sequence is the one shingle. Null, empty and blank texts have no shingles and no
    links: each is its own component. Rows that repeat a key have that key's component; where their texts differ
    all of them count. Rows with a null key take no part in links and keep a null component. An empty table gives
    an empty table; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    sketched = sketches(docs, key, text, words)
    with_set = sketched.where("n_shingles > 0 AND id IS NOT NULL")
    one = F.min(F.struct("id", "row")).alias("one")
    reps = with_set.groupBy("digest").agg(one, F.max("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    reps = written(reps.select(F.col("one.row").alias("node"), "one.*", "n_shingles", "digest", "bands"))
    # Rows that repeat a key: the sets of one key are linked, the others to the smallest.
    keyed = with_set.select("id", "digest").distinct().join(reps.select("digest", "node"), "digest").select("id", "node")
    first = keyed.groupBy("id").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    same_key = keyed.join(first, "id").where("hub != node").select("hub", F.col("node").alias("member"))
    near = reps.join(components(linked(reps, sketched, percent, words).unionByName(same_key)), "node").select("digest", "id", "component")
    near = written(near)
    lowest = near.groupBy("component").agg(F.min("id").alias("component_id"))
    near = near.join(lowest, "component").select("digest", "component_id")
    # A set without links: its copies belong to its smallest key.
    alone = reps.select("digest", F.col("id").alias("own_id"))
    found = sketched.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest"))
    found = found.join(alone.join(near, "digest", "left").select("digest", F.coalesce("component_id", "own_id").alias("of_set")), "digest", "left")
    component = F.coalesce("of_set", "id")
    return found.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
