"""Runs of words with a period in each text, by the linear method of Gusfield and Stoye for tandem repeats.

1. Stretches. In a run that is long enough each group of GRAM words in a row comes again inside the run. A text is cut
   into the stretches whose groups do so, and these are cut again by what they hold themselves, until none changes.
   Most texts have none. No run crosses an end of a stretch, so each is looked at alone, with its words numbered.
2. Leftmost covering squares. The stretch falls into LZ blocks: each is the longest beginning of the rest that occurs
   further left too, or a new word. A square (a tandem repeat) that occurs first here has its middle in one block and
   touches the next one or the one before. For each block and each half length two extensions, to the left and to the
   right, find all of them, as (start, length) from which the others follow by rotation.
3. The vocabulary. The squares are placed in the suffix tree bottom-up, at each node those of its leftmost leaf. From
   each place a walk goes over suffix links: the square without its first word is found one link further, and if that
   word can follow there, the rotation is a square that occurs, too. A walk ends where it can't go on or comes to a
   place that is marked. After that each square of the stretch has its place in the tree.
4. Runs. The leaves below a place are the starts of its square. Squares whose half is itself a power are left out; of
   the others the starts that follow each other with one half length make up one run with its smallest period.

Longest extensions come from the ranks of prefix doubling. Memory: some 200 bytes a word of the longest stretch, not of
the text; a text is one row and is worked on by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafworks.llm.shared import NON_BLANK, small_batches, text_or_empty

#: A run has at least so many words and so many periods.
MIN_WORDS, MIN_PERIODS = 24, 3
#: In a run of MIN_WORDS words and MIN_PERIODS periods each GRAM words in a row come twice: GRAM <= MIN_WORDS / 3.
GRAM = 8


def repeated_stretches(hashes: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches of words that can hold a run. Words are given as 64-bit hashes: two that share one
    can only make a stretch longer."""
    found, todo = [], [(0, len(hashes))]
    with np.errstate(over="ignore"):
        grams, step = hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(29)
        for k in (1, 2, 4):
            grams = grams[:-k] * step + grams[k:] if len(grams) > k else grams[:0]
            step = step * step * np.uint64(3)
    while todo:
        start, end = todo.pop()
        if end - start < MIN_WORDS:
            continue
        own = grams[start : end - GRAM + 1]
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        again = np.zeros(len(own) + 2, np.int8)
        again[order[1:][same] + 1] = 1
        again[order[:-1][same] + 1] = 1
        edges = np.flatnonzero(np.diff(again))
        parts = [(start + int(a), start + int(b) + GRAM - 1) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a + GRAM - 1 >= MIN_WORDS]
        if parts == [(start, end)]:
            found.append((start, end))
        else:
            todo += parts
    return found


def doubled(x: np.ndarray) -> list[np.ndarray]:
    """ranks[k][i]: the rank of the 2**k words from i on among all such, to the k at which all differ. One more at the end."""
    n, ranks = len(x), []
    own = np.unique(x, return_inverse=True)[1].astype(np.int64)
    while True:
        ranks.append(np.append(own, -1).astype(np.int32))
        if int(own.max()) == n - 1:
            return ranks
        shift, after = 1 << len(ranks) - 1, np.full(n, -1, np.int64)
        after[: n - shift] = own[shift:]
        own = np.unique(own * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64)


def extension(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of words that agree from a and from b on; a differs from b everywhere, both are 0 to n."""
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 2, -1, -1):
        step = (ranks[k][a] == ranks[k][b]).astype(np.int64) << k
        a, b, total = a + step, b + step, total + step
    return total


def blocks(sa: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """The starts of the LZ blocks, and n."""
    n = len(sa)
    before, after, stack = [-1] * n, [-1] * n, []  # of each suffix, the nearest ones in rank that start further left
    for s in sa.tolist():
        while stack and stack[-1] > s:
            after[stack.pop()] = s
        if stack:
            before[s] = stack[-1]
        stack.append(s)
    longest, at = np.zeros(n, np.int64), np.arange(n)
    for other in (np.array(before), np.array(after)):
        has = other >= 0
        longest[has] = np.maximum(longest[has], extension(ranks, at[has], other[has]))
    sizes, starts, i = np.maximum(longest, 1).tolist(), [], 0
    while i < n:
        starts.append(i)
        i += sizes[i]
    return np.array([*starts, n])


def ramps(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sizes (s0, s1..) the numbers 0..s0-1, 0..s1-1, .. in a row, and the place of the size that each belongs to."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner], owner


def covering_squares(edges: np.ndarray, ranks: list[np.ndarray], back: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, halves) of a leftmost covering set of squares: all others come from these by rotation to the right."""
    n, starts, ends = int(edges[-1]), edges[:-1], edges[1:]
    sizes, after = ends - starts, np.append(ends[1:] - ends[:-1], 0)
    # Squares that begin in a block and reach the next one: the second half, or a rotation of it, begins at `middle`.
    k, owner = ramps(sizes)
    half, edge = k + 1, ends[owner]
    half, edge = half[edge < n], edge[edge < n]
    middle = edge - half
    right, left = extension(ranks, edge, middle), extension(back, n - edge, n - middle)
    start = np.maximum(middle - left, middle - half + 1)
    good = (right + left >= half) & (right > 0)
    found = [(start[good], half[good])]
    # Squares that begin before a block and whose first half ends in it.
    k, owner = ramps(sizes + after)
    half, edge, stop = k + 1, starts[owner], ends[owner]
    inside = edge + half < n
    half, edge, stop = half[inside], edge[inside], stop[inside]
    middle = edge + half
    right, left = extension(ranks, edge, middle), extension(back, n - edge, n - middle)
    start = np.maximum(edge - left, edge - half + 1)
    good = (right + left >= half) & (right > 0) & (left > 0) & (start + half <= stop)
    found.append((start[good], half[good]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class SuffixTree:
    """The suffix tree of a stretch. Nodes in post-order: each comes after those below it, the root is the last one.

    depth: words from the root; up: the parent; first, last: places of its leaves in the suffix array; low: the smallest
    suffix below; link: the node of the same words without the first one. Each suffix ends in a mark of its own.
    """

    def __init__(self, x: np.ndarray, sa: np.ndarray, ranks: list[np.ndarray]) -> None:
        n = len(x)
        lcp = [*extension(ranks, sa[:-1], sa[1:]).tolist(), 0]
        depth, up, first, last, low, path = [], [], [], [], [], []  # path: (depth, first place, smallest suffix, children)
        path.append((0, 0, n, []))

        def closed(d: int, f: int, s: int, below: list[int], place: int) -> int:
            for c in below:
                up[c] = len(depth)
            depth.append(d), up.append(-1), first.append(f), last.append(place), low.append(s)
            return len(depth) - 1

        for place, s in enumerate(sa.tolist()):
            node, d = closed(n - s, place, s, [], place), lcp[place]
            begin, smallest = place, s
            while path[-1][0] > d:
                dd, f, m, below = path.pop()
                below.append(node)
                begin, smallest = f, min(m, smallest)
                node = closed(dd, f, smallest, below, place)
            if path[-1][0] < d:
                path.append((d, begin, smallest, [node]))
            else:
                dd, f, m, below = path[-1]
                below.append(node)
                path[-1] = (dd, f, min(m, smallest), below)
        self.root = closed(0, 0, path[0][2], path[0][3], n - 1)
        self.depth, self.up, self.first, self.last, self.low, self.x = depth, up, first, last, low, x.tolist()
        low_, depth_, up_ = np.array(low), np.array(depth), np.array(up)
        # A node's name: its depth and the ranks of two overlapping parts; links go to the node of the name without the first word.
        inner = np.flatnonzero((np.array(last) > np.array(first)) & (depth_ > 0))
        names = self.names(ranks, low_[inner], depth_[inner])
        node_of = dict(zip(names, inner.tolist(), strict=True)) | {(0, 0, 0): self.root}
        targets = map(node_of.__getitem__, self.names(ranks, low_[inner] + 1, depth_[inner] - 1))
        self.link = dict(zip(inner.tolist(), targets, strict=True)) | {self.root: self.root}
        below = np.flatnonzero(up_ >= 0)
        branch = low_[below] + depth_[up_[below]]
        heads = np.where(branch < n, np.append(x, -1)[branch], -1 - low_[below])
        self.child = dict(zip(zip(up_[below].tolist(), heads.tolist(), strict=True), below.tolist(), strict=True))

    @staticmethod
    def names(ranks: list[np.ndarray], at: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, int]]:
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        table, full = np.stack(ranks) if len(at) and len(ranks) * len(ranks[0]) <= 1 << 22 else ranks, size > 0
        if isinstance(table, list):
            one, two = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for k in np.unique(level):
                own = level == k
                one[own], two[own] = ranks[k][at[own]], ranks[k][(at + size)[own] - np.where(full[own], 1 << k, 0)]
        else:
            one, two = table[level, at], table[level, at + size - np.where(full, 1 << level, 0)]
        return zip(size.tolist(), np.where(full, one, 0).tolist(), np.where(full, two, 0).tolist(), strict=True)

    def down(self, node: int, at: int, size: int) -> int:
        """From a node to where the words [at, at + size) end: the node at that place or below it on the edge. The words
        are known to be there, so only the edges' first ones are looked at."""
        while self.depth[node] < size:
            node = self.child[node, self.x[at + self.depth[node]]]
        return node


def vocabulary(tree: SuffixTree, starts: np.ndarray, halves: np.ndarray) -> set[tuple[int, int]]:
    """(node, half): the place of each square of the stretch, at the node where it ends or that its edge leads to."""
    mine: dict[int, list[int]] = {}
    order = np.lexsort((halves, starts))  # of each start the longest is taken from the end first
    for s, h in zip(starts[order].tolist(), halves[order].tolist(), strict=True):
        mine.setdefault(s, []).append(h)
    depth, up, low, x, link, child, down = tree.depth, tree.up, tree.low, tree.x, tree.link, tree.child, tree.down
    placed: set[tuple[int, int]] = set()
    for node in range(tree.root):
        if (held := mine.get(low[node])) is not None:
            above = depth[up[node]]
            while held and 2 * held[-1] > above:
                placed.add((node, held.pop()))
    marked = set(placed)
    for node, half in placed:
        size = 2 * half
        while True:
            # Of the words from `at` on: without the first one, then with it at the end.
            at, above = low[node], up[node]
            first = x[at]
            node = down(link[above], at + 1, size - 1)
            if depth[node] == size - 1:
                node = child.get((node, first), -1)
            elif x[low[node] + size - 1] != first:
                node = -1
            if node < 0 or (node, half) in marked:
                break
            marked.add((node, half))
    return marked


def primes(limit: int) -> np.ndarray:
    """The smallest prime factor of each number up to limit."""
    out = np.arange(limit + 1)
    for p in range(2, int(limit**0.5) + 1):
        if out[p] == p:
            own = out[p * p :: p]
            own[own == np.arange(p * p, limit + 1, p)] = p
    return out


def runs(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of the numbers x with at least MIN_WORDS words and MIN_PERIODS periods."""
    n = len(x)
    if n < MIN_WORDS:
        return []
    ranks, back = doubled(x), doubled(x[::-1])
    sa = np.argsort(ranks[-1][:n])
    starts, halves = covering_squares(blocks(sa, ranks), ranks, back)
    if not len(starts):
        return []
    tree = SuffixTree(x, sa, ranks)
    placed = np.array(sorted(vocabulary(tree, starts, halves)), np.int64)
    node, half = placed[:, 0], placed[:, 1]
    at = np.array(tree.low)[node]
    factor, rest, whole = primes(int(half.max())), half.copy(), np.ones(len(half), bool)
    while (open_ := rest > 1).any():  # a half that is a power has a shorter period that divides it
        p = factor[rest[open_]]
        part = half[open_] // p
        whole[open_] &= extension(ranks, at[open_], at[open_] + part) < half[open_] - part
        rest[open_] //= p
    node, half = node[whole], half[whole]
    first = np.array(tree.first)[node]
    k, owner = ramps(np.array(tree.last)[node] - first + 1)
    keys = np.sort(half[owner] * (n + 1) + sa[first[owner] + k])
    cut = np.flatnonzero(np.diff(keys) != 1) + 1
    begin, end = keys[np.append(0, cut)], keys[np.append(cut - 1, len(keys) - 1)]
    period, start = begin // (n + 1), begin % (n + 1)
    length = end - begin + 2 * period
    long = (length >= MIN_WORDS) & (length >= MIN_PERIODS * period)
    return list(zip(start[long].tolist(), length[long].tolist(), period[long].tolist(), strict=True))


def text_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of a text's words, by start, then period."""
    if len(words) < MIN_WORDS:
        return []
    found = []
    for start, end in repeated_stretches(np.fromiter(map(hash, words), np.int64, len(words))):
        numbers: dict[bytes, int] = {}
        x = np.array([numbers.setdefault(w, len(numbers)) for w in words[start:end]], np.int64)
        found += [(start + s, n, p) for s, n, p in runs(x)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by blanks."""
    if found:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [w for w, d in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not d]
    return b" ".join(words)


def greatest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods, then the smallest start, then the smallest period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, runs, collapsed) of each whole text: runs as array of (start, length, period) by start, then period, and the
    text without what repeats, its words joined by blanks.

    A null text is empty; empty, blank and short texts have no runs. Every row gives one row, with null or repeated
    keys too; other columns are dropped. Of runs that overlap each drops its own words. An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, texts = [], []
            for t in b.column(1).to_pylist():
                words = (t or "").encode().split()
                own = text_runs(words)
                found.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                texts.append(collapsed(words, own).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, shape), pa.array(texts, pa.string())], names=[key, "runs", "collapsed"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def run_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): the runs of periodic_runs() in
    numbers and digests; the four of a run are those of the one with the most periods, null without one. In one pass."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, tops, own, texts = [], [], [], []
            for t in b.column(1).to_pylist():
                words = (t or "").encode().split()
                found = text_runs(words)
                n.append(len(found))
                tops.append(greatest(found))
                own.append(hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in found).encode()).hexdigest())
                texts.append(hashlib.sha256(collapsed(words, found)).hexdigest())
            parts = [pa.array([x and x[k] for x in tops], pa.int64()) for k in range(3)]
            milli = pa.array([x and 1000 * x[1] // x[2] for x in tops], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *parts, milli, pa.array(own), pa.array(texts)], names=names)

    shape = f"`{key}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return docs.select(key, text).mapInArrow(run, shape)


def repeating_tail(key: Column, text: str = "text") -> Column:
    """The text of one key in ten with its words from some place on replaced by the first few of these, again and again.

    With h the CRC-32 of the key in decimal, these are the keys with h % 10 = 0 and a word in the text; g is h div 10, the
    place g % n of n words, and of the n - a words from there on the first 1 + (n - a) div (3 + g % 8) are repeated.
    Other texts, and those of null keys, stay as they are.
    """
    h, words = F.crc32(key.cast("string").cast("binary")), F.regexp_extract_all(text_or_empty(text), F.lit(f"({NON_BLANK}+)"))
    s = F.struct(words.alias("w"), F.floor(h / 10).cast("long").alias("g"))

    def cut(s: Column) -> Column:
        n = F.size(s["w"])
        a = (s["g"] % F.greatest(n, F.lit(1))).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + s["g"] % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(s["w"], a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(s["w"], F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")).otherwise("")

    return F.when(h % 10 == 0, F.transform(F.array(s), cut)[0]).otherwise(F.col(text))
