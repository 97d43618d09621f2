"""Best-fit packing by a grouping genetic algorithm on islands.

1. One pass tokenises the texts and cuts documents longer than a sequence into pieces: whole sequences, and one
   shorter first piece. Pieces are written once, as narrow rows.
2. A piece that fills a sequence is one by itself and goes no further. The others are dealt in turn, from another
   beginning in each task, over islands of about ISLAND_PIECES each. An island's chromosome is a set of bins; a bin is the multiset
   of its pieces' lengths, so pieces of one length stand for each other.
3. Each island breeds: a crossover injects whole well-filled bins of another parent, removes bins that hold pieces
   which are used up by that (the duplicates), and puts the displaced pieces back by best fit. Mutation empties
   badly filled bins. Fitness is fewer bins, then fuller bins. An island rests once it meets the lower bound.
4. After the first epoch every island sends its fullest bins (the elite) to the next one on a ring; there they are
   a parent like any other in the second epoch, as far as the island has pieces of these lengths.
An island has a bounded number of pieces, so all of it fits a task at every size of the input.
"""

from __future__ import annotations

import itertools
import random
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafworks.llm.bpe import encode
from leafworks.llm.shared import small_batches, written

CAPACITY = 1024
END_ID = 2
ISLAND_PIECES = 8192
POPULATION, GENERATIONS, ELITE_BINS = 6, 6, 512
#: Islands that a task breeds one after another, where there are more of them than shuffle partitions.
ISLANDS_A_TASK = 4
CACHE_ENTRIES = 300_000
#: Above this code point the Unicode tables of two regular expression engines may differ.
COMMON = "\u0530"
RARE = re.compile(f"[{COMMON}-\U0010ffff]")
#: Characters that no engine takes for white space, and the places before a space that stands after one.
SOLID = re.compile("[\\w!-~\xa1-\u052f]")
CUT = re.compile(f"(?<={SOLID.pattern})(?= )")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"


class TokenIds:
    """The ids that the tokenizers library gives for a byte-level BPE file, as packed little-endian 32-bit numbers.

    Texts of common characters are encoded whole from the same vocabulary as ranks. Characters beyond them go to the
    tokenizers library with what stands around them up to a single space after a solid character, where the pattern always
    begins a match; the ids of such stretches are kept in a bounded cache. Texts with special strings go to it whole.
    """

    def __init__(self, json_path: str, rank_path: str, pattern: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(json_path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.rank_path, self.pattern = rank_path, pattern
        self.stretches: dict[str, bytes] = {}

    def common(self, text: str) -> bytes:
        return array("I", encode(text, self.rank_path, self.pattern)).tobytes()

    def by_library(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def stretch(self, text: str) -> bytes:
        ids = self.stretches.get(text)
        if ids is None:
            ids = self.by_library(text)
            if len(text) <= 64:
                if len(self.stretches) >= CACHE_ENTRIES:
                    self.stretches.clear()
                self.stretches[text] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            return self.by_library(text)
        out, at = [], 0
        while not text.isascii() and (rare := RARE.search(text, at)):
            start = text.rfind(" ", at, rare.start())
            while start > at and not SOLID.match(text, start - 1):
                start = text.rfind(" ", at, start)
            end = CUT.search(text, rare.end())
            start, end = max(start, at), end.start() if end else len(text)
            out += self.common(text[at:start]), self.stretch(text[start:end])
            at = end
        return b"".join([*out, self.common(text[at:])])


@lru_cache(maxsize=2)
def token_ids(json_path: str, rank_path: str, pattern: str) -> TokenIds:
    return TokenIds(json_path, rank_path, pattern)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: a shorter first piece, then whole sequences."""
    head = n % capacity or capacity
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def pieces(docs: DataFrame, json_path: str, rank_path: str, pattern: str, key: str, text: str, capacity: int = CAPACITY) -> DataFrame:
    """PIECES, written: a row for each piece of each row of docs. deal numbers a task's short pieces, and apart from
    them its whole ones, above the task's number times 2**33."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of, end = token_ids(json_path, rank_path, pattern), array("I", [END_ID]).tobytes()
        task = TaskContext.get().partitionId() << 33
        deal = [task, task]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "deal"]
        for b in batches:
            rows = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = (ids_of(t) if t else b"") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    full = length == capacity
                    rows.append((doc, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), deal[full]))
                    deal[full] += 1
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32() if n == "piece" else pa.int64()) for c, n in zip(columns, names, strict=True)], names=names)

    return written(docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(run, PIECES))


def best_fit(lengths: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """bins with the lengths added, longest first, each to the bin that it leaves the least room in."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for k, b in enumerate(bins):
        room = capacity - sum(b)
        free[room].append(k)
        mask |= 1 << room
    for w in sorted(lengths, reverse=True):
        fits = mask >> w
        if fits:
            room = w + (fits & -fits).bit_length() - 1
            k = free[room].pop()
            if not free[room]:
                mask ^= 1 << room
            bins[k].append(w)
        else:
            room, k = capacity, len(bins)
            bins.append([w])
        free[room - w].append(k)
        mask |= 1 << (room - w)
    return bins


def lower_bound(lengths: list[int], capacity: int) -> int:
    """The better of the volume bound and the bounds that pair large pieces with what can't join them."""
    lengths = sorted(lengths)
    best = -(-sum(lengths) // capacity)
    n = len(lengths)
    sums = [0]
    for w in lengths:
        sums.append(sums[-1] + w)
    for k in range(0, capacity // 2 + 1, 16):
        big = n - bisect_right(lengths, capacity - k)
        half = bisect_right(lengths, capacity // 2)
        middle_at, middle_to = half, n - big
        middle = middle_to - middle_at
        small_at = bisect_left(lengths, k)
        small = sums[half] - sums[small_at] if half > small_at else 0
        room = middle * capacity - (sums[middle_to] - sums[middle_at])
        best = max(best, big + middle + max(0, -(-(small - room) // capacity)))
    return best


class Island:
    """A population of packings of the same pieces."""

    def __init__(self, lengths: list[int], capacity: int, seed: int) -> None:
        self.capacity, self.lengths, self.counts = capacity, lengths, Counter(lengths)
        self.random = random.Random(seed)
        self.bound = lower_bound(lengths, capacity)
        self.packings = [best_fit(lengths, [], capacity)]

    def fitness(self, bins: list[list[int]]) -> tuple[int, int]:
        return len(bins), -sum(sum(b) ** 2 for b in bins)

    def done(self) -> bool:
        return len(self.packings[0]) <= self.bound

    def inject(self, strong: list[list[int]], base: list[list[int]]) -> list[list[int]]:
        """base with the bins of strong put in whole: bins that lose a piece to them are taken apart, and what
        they still hold is put back by best fit."""
        left, bins = dict(self.counts), []
        for b in itertools.chain(strong, base):
            for k, w in enumerate(b):
                if not left.get(w):
                    for x in b[:k]:
                        left[x] += 1
                    break
                left[w] -= 1
            else:
                bins.append(list(b))
        return best_fit([w for w, n in left.items() for _ in range(n)], bins, self.capacity)

    def well_filled(self, bins: list[list[int]]) -> list[list[int]]:
        share = self.random.uniform(0.2, 0.6)
        best = sorted(bins, key=lambda b: -sum(b))[: max(1, len(bins) // 2)]
        return self.random.sample(best, max(1, int(len(best) * share)))

    def mutated(self, bins: list[list[int]]) -> list[list[int]]:
        """The emptiest bins and some others are emptied, their pieces put back in another order of bins."""
        order = sorted(bins, key=sum)
        gone = max(1, len(order) // 50)
        kept = order[gone:]
        self.random.shuffle(kept)
        extra = len(kept) // 20
        loose = [w for b in [*order[:gone], *kept[:extra]] for w in b]
        return best_fit(loose, [list(b) for b in kept[extra:]], self.capacity)

    def breed(self, immigrants: list[list[int]], generations: int) -> None:
        if immigrants:
            self.packings.append(self.inject(immigrants, self.packings[0]))
        while len(self.packings) < POPULATION and not self.done():
            self.packings.append(self.mutated(self.packings[0]))
            self.packings.sort(key=self.fitness)
        for _ in range(generations):
            if self.done():
                break
            children = []
            for _ in range(POPULATION // 2):
                a, b = self.random.sample(self.packings, 2)
                children.append(self.mutated(self.inject(self.well_filled(a), b)))
            self.packings = sorted([*self.packings, *children], key=self.fitness)[:POPULATION]
        self.packings.sort(key=self.fitness)

    def elite(self) -> list[list[int]]:
        return sorted(self.packings[0], key=lambda b: -sum(b))[:ELITE_BINS]


def packed(found: DataFrame, capacity: int = CAPACITY, island_pieces: int = ISLAND_PIECES, generations: int = GENERATIONS) -> DataFrame:
    """Rows of PIECES without deal, with sequence_id and offset."""
    short = found.where(F.col("length") < capacity)
    islands = max(1, -(-short.count() // island_pieces))
    turn = F.col("deal").bitwiseAND((1 << 33) - 1) + F.pmod(F.xxhash64(F.shiftright("deal", 33)), F.lit(islands))
    dealt = short.withColumn("island", F.pmod(turn, F.lit(islands)).cast("int"))

    def first_epoch(frame: pd.DataFrame) -> pd.DataFrame:
        k = int(frame["island"].iloc[0])
        island = Island([int(w) for w in frame["length"]], capacity, k)
        island.breed([], generations)
        own = pd.DataFrame({"island": k, "own": True, "lengths": island.packings[0]})
        sent = pd.DataFrame({"island": (k + 1) % islands, "own": False, "lengths": island.elite()})
        return pd.concat([own, sent])

    def second_epoch(frame: pd.DataFrame, bins: pd.DataFrame) -> pd.DataFrame:
        if frame.empty:  # an elite came to an island without pieces
            return frame.assign(sequence_id=0, offset=0).drop(columns=["deal", "island"])
        k = int(frame["island"].iloc[0])
        frame = frame.sort_values(["length", "deal"], ignore_index=True)
        lengths = [int(w) for w in frame["length"]]
        island = Island(lengths, capacity, -k - 1)
        as_lists = lambda rows: [[int(w) for w in b] for b in rows]
        own = as_lists(bins.loc[bins["own"], "lengths"])
        island.packings = sorted([island.inject(own, []), *island.packings], key=island.fitness)
        island.breed(as_lists(bins.loc[~bins["own"], "lengths"]), generations)
        waiting: dict[int, list[int]] = {}
        for row, w in enumerate(lengths):
            waiting.setdefault(w, []).append(row)
        bins_of, offsets = [0] * len(lengths), [0] * len(lengths)
        for number, b in enumerate(island.packings[0]):
            at = 0
            for w in b:
                row = waiting[w].pop()
                bins_of[row], offsets[row] = number, at
                at += w
        frame["sequence_id"] = [(k << 32) + n for n in bins_of]
        frame["offset"] = offsets
        return frame.drop(columns=["deal", "island"])

    # A number of tasks that isn't merged again by bytes: pieces are small rows, their islands long work.
    partitions = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(islands, max(partitions, -(-islands // ISLANDS_A_TASK)))
    bins = dealt.select("island", "length").repartition(tasks, "island").groupBy("island").applyInPandas(first_epoch, "island int, own boolean, lengths array<int>")
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    placed = dealt.repartition(tasks, "island").groupBy("island").cogroup(written(bins).repartition(tasks, "island").groupBy("island")).applyInPandas(second_epoch, out)
    # Sequences of islands have numbers from 0, those of whole pieces have negative ones.
    whole = found.where(F.col("length") >= capacity).withColumns({"sequence_id": -1 - F.col("deal"), "offset": F.lit(0).cast("long")})
    return placed.unionByName(whole.drop("deal"))


def pack(docs: DataFrame, json_path: str, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): each piece's place in a sequence.

    Sequences have at most `capacity` tokens; each document is its tokens and one end id. Only longer documents
    are cut. A null or empty text is the end id alone. Rows that repeat a key or have none are packed like any
    other. An empty table gives an empty table; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    return packed(pieces(docs, json_path, rank_path, pattern, key, text, capacity), capacity)
