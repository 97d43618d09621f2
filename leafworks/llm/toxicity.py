"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

1. Examples: MAX_EXAMPLES labelled keys of the training folds at most, drawn by a hash of the key from the labels
   alone. That bounded list meets the documents where they are read, so only the examples' texts move.
2. Features are words (lower-cased, punctuation at the ends removed) and word beginnings of 3 to 6
   characters. Of these the MAX_FEATURES that tell labels apart best are kept: only counts by feature reach the
   driver's side, MAX_FEATURES rows at most.
3. One pass over all documents turns each whole text into its few kept features; document frequencies are then
   counted over all documents, and TF-IDF vectors are normalised.
4. Examples with the same vector are one entry of the index. The index holds each feature's postings with the
   entries sorted so that similar ones are neighbours, in blocks of BLOCK entries with the largest weight a feature
   has in each. A query takes blocks by their upper bound and stops when no block can reach its NEIGHBOURS-th best:
   the result is the exact list of nearest examples, with all that are as near as the last.
5. Votes are weighted by similarity and shrunk towards the rate of toxic examples among those that the text's
   evidence can't tell apart; a monotone fit on the examples' own votes (each without itself and its copies)
   calibrates scores.
The index is bounded by MAX_EXAMPLES x MAX_FEATURES, whatever the input, and is broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafworks.llm.shared import small_batches, text_or_empty, written

MAX_EXAMPLES, MAX_FEATURES = 12_000, 4_000
#: A feature is kept if this many examples hold it (or this share of them, if more) and it is this many times as
#: frequent in one label as in the other.
MIN_EXAMPLES, MIN_SHARE, MIN_RATIO = 5, 1 / 1500, 3.0
BLOCK, NEIGHBOURS = 32, 15
#: Blocks that a query looks at before it asks which others it needs.
FIRST_BLOCKS = 4
PREFIXES = (3, 4, 5, 6)
#: Punctuation removed at the ends of words.
EDGES = ".,;:!?\"'()[]{}<>*&%$#-_/"
#: Words that a worker remembers the kept features of.
CACHE_ENTRIES = 100_000
#: Vectors that a worker remembers the neighbours of, some 5 KB each.
SEEN_ENTRIES = 2_000


def features_of(word: str) -> tuple[str, ...]:
    """A word's features: itself and its beginnings."""
    word = word.strip(EDGES)
    return (word, *(f"{word[:n]}~" for n in PREFIXES if len(word) > n)) if word else ()


class Extractor:
    """Counts of kept features in a text; the kept features of a word are held in a bounded cache."""

    def __init__(self, kept: dict[str, int] | None = None) -> None:
        self.kept = kept
        self.words: dict[str, tuple] = {}

    def of_word(self, word: str) -> tuple:
        found = features_of(word)
        if self.kept is not None:
            found = tuple(self.kept[f] for f in found if f in self.kept)
        if len(word) <= 64:
            if len(self.words) >= CACHE_ENTRIES:
                self.words.clear()
            self.words[word] = found
        return found

    def counts(self, text: str) -> Counter:
        known, slow, out = self.words.get, self.of_word, Counter()
        for word, n in Counter(text.lower().split()).items():
            found = known(word)
            for f in slow(word) if found is None else found:
                out[f] += n
        return out


def examples(docs: DataFrame, labels: DataFrame, trained: Column, key: str, text: str, most: int = MAX_EXAMPLES) -> DataFrame:
    """(name, digest, toxic, features, counts) of the chosen examples, written. labels: (key, toxic); one row a key
    is used, and of documents that repeat a key the one whose text has the smallest hash."""
    chosen = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull() & trained)
    chosen = chosen.groupBy(F.col(key).alias("name")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("name"), "name").limit(most)  # so it may be broadcast
    texts = docs.select(F.col(key).alias("name"), text_or_empty(text).alias("t"))
    joined = texts.join(F.broadcast(chosen), "name").groupBy("name", "toxic").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("x"))
    shape = f"name {docs.schema[key].dataType.simpleString()}, digest long, toxic int, features array<string>, counts array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor()
        for b in batches:
            found = [sorted(extract.counts(t).items()) for t in b.column(3).to_pylist()]
            f = pa.array([[k for k, _ in x] for x in found], pa.list_(pa.string()))
            n = pa.array([[c for _, c in x] for x in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], f, n], names=["name", "digest", "toxic", "features", "counts"])

    return written(joined.select("name", F.col("x.h").alias("digest"), "toxic", "x.t").mapInArrow(run, shape))


def kept_features(found: DataFrame, most: int = MAX_FEATURES) -> dict[str, int]:
    """The features that tell the labels apart best, numbered."""
    sums = found.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).first()
    bad, good = (sums["bad"] or 0) + 1.0, sums["n"] - (sums["bad"] or 0) + 1.0
    counts = found.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad"))
    counts = counts.where(F.col("n") >= max(MIN_EXAMPLES, int(sums["n"] * MIN_SHARE)))
    p, q = (F.col("bad") + 0.5) / bad, (F.col("n") - F.col("bad") + 0.5) / good
    scored = counts.select("f", F.log(p / q).alias("ratio"), (F.abs(p - q) * F.abs(F.log(p / q))).alias("gain")).where(F.abs("ratio") >= float(np.log(MIN_RATIO)))
    top = scored.orderBy(F.desc("gain"), "f").limit(most).collect()
    return {r.f: k for k, r in enumerate(sorted(top, key=lambda r: r.f))}


def narrowed(found: DataFrame, kept: dict[str, int]) -> DataFrame:
    """The examples with their kept features alone, as numbers in rising order; written, so that what the driver
    reads is a few numbers a row."""
    shape = f"name {found.schema['name'].dataType.simpleString()}, digest long, toxic int, features array<int>, counts array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)
            pairs = [sorted((kept[f], n) for f, n in zip(*x, strict=True) if f in kept) for x in both]
            f = pa.array([[k for k, _ in x] for x in pairs], pa.list_(pa.int32()))
            n = pa.array([[c for _, c in x] for x in pairs], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], f, n], names=["name", "digest", "toxic", "features", "counts"])

    return written(found.mapInArrow(run, shape))


def vectors(docs: DataFrame, kept: dict[str, int], key: str, text: str) -> DataFrame:
    """(id, features, counts) of each row's kept features, written: the one pass over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(kept)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(shared.value)
        for b in batches:
            found = [sorted(extract.counts(t).items()) for t in b.column(1).to_pylist()]
            f = pa.array([[k for k, _ in x] for x in found], pa.list_(pa.int32()))
            n = pa.array([[c for _, c in x] for x in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), f, n], names=["id", "features", "counts"])

    rows = docs.select(F.col(key).alias("id"), text_or_empty(text).alias("t"))
    return written(rows.mapInArrow(run, f"id {kind}, features array<int>, counts array<int>"))


#: name, hash of the text, label, numbers of the kept features and their counts.
Example = tuple[object, int, int, list[int], list[int]]


class Index:
    """The block-max inverted index over the examples' normalised vectors; examples of one vector are one entry."""

    def __init__(self, rows: list[Example], idf: np.ndarray) -> None:
        self.idf = idf
        alike: dict[tuple, list[Example]] = {}
        for row in sorted(rows, key=lambda r: r[1]):
            alike.setdefault((tuple(row[3]), tuple(row[4])), []).append(row)
        blank = alike.pop(((), ()), [])
        bad = sum(r[2] for r in blank)
        self.prior = (bad + 0.5) / (len(blank) + 10) if rows else 0.0
        self.vectors = sorted(alike, key=lambda v: (sorted(v[0], key=lambda f: -idf[f]), v[1]))
        self.entries = [alike[v] for v in self.vectors]
        self.sizes = np.array([len(e) for e in self.entries], np.int64)
        self.toxic = np.array([sum(r[2] for r in e) for e in self.entries], np.int64)
        self.n_blocks = -(-len(self.entries) // BLOCK)
        held: list[tuple[list[int], list[float]]] = [([], []) for _ in idf]
        for at, (features, counts) in enumerate(self.vectors):
            for f, x in zip(features, self.weights(features, counts), strict=True):
                held[f][0].append(at)
                held[f][1].append(float(x))
        #: Of each feature the entries that hold it, in order, and its weights there; of each block of entries with some, its
        #: number, where it starts in these, and the largest weight. Plain arrays: small, and quick to send.
        self.flat = [(np.array(at, np.int32), np.array(x)) for at, x in held]
        self.heads = []
        for at, x in self.flat:
            blocks, starts = np.unique(at // BLOCK, return_index=True)
            self.heads.append((blocks, np.append(starts, len(at)), np.maximum.reduceat(x, starts) if len(x) else x))
        self.steps: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def weights(self, features: list[int], counts: list[int]) -> np.ndarray:
        w = (1 + np.log(np.array(counts, np.float64))) * self.idf[np.array(features, np.int64)]
        return w / np.sqrt((w * w).sum())

    def nearest(self, features: list[int], weights: np.ndarray, k: int = NEIGHBOURS, without: tuple[int, int] = (-1, 0)) -> list[tuple[float, int, int]]:
        """(similarity, entry, examples) of the entries that hold the k nearest examples, the most similar first, and
        of all that are as similar as the last of them. without: an entry, and how many of its examples don't count."""
        bounds = np.zeros(self.n_blocks)
        for f, w in zip(features, weights, strict=True):
            blocks, _, most = self.heads[f]
            bounds[blocks] += w * most
        order = np.flatnonzero(bounds)
        order = order[np.argsort(-bounds[order], kind="stable")]
        # The blocks of the highest bounds one by one; what they hold tells which others can hold a nearer entry.
        first = order[:FIRST_BLOCKS]
        sims = np.zeros((len(first), BLOCK))
        for f, w in zip(features, weights, strict=True):
            (blocks, starts, _), (at, x) = self.heads[f], self.flat[f]
            places = np.searchsorted(blocks, first)
            for own, block, place in zip(sims, first.tolist(), places.tolist(), strict=True):
                if place < len(blocks) and blocks[place] == block:
                    part = slice(starts[place], starts[place + 1])
                    own[at[part] - block * BLOCK] += w * x[part]
        ids, sims = (first[:, None] * BLOCK + np.arange(BLOCK)).ravel(), sims.ravel()
        # An entry is one example at least, so the k-th best entry (of all but one) is as near as the k-th best example, or less.
        least = np.partition(sims, len(sims) - k - 1)[len(sims) - k - 1] if len(sims) > k else 0.0
        rest = order[FIRST_BLOCKS:]
        rest = rest[bounds[rest] >= least - 1e-9]
        if len(rest):
            whole = np.zeros((self.n_blocks, BLOCK))
            flat = whole.ravel()
            for f, w in zip(features, weights, strict=True):
                at, x = self.flat[f]
                flat[at] += w * x
            more = (rest[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            ids, sims = np.concatenate([ids, more]), np.concatenate([sims, whole[rest].ravel()])
        ids, sims = self.best(ids, sims, k, without)
        return list(zip(sims.tolist(), ids.tolist(), (self.sizes[ids] - np.where(ids == without[0], without[1], 0)).tolist(), strict=True))

    def best(self, ids: np.ndarray, sims: np.ndarray, k: int, without: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Of entries and their similarities the nearest that hold k examples, with all that are as near as the last, in order."""
        hit = np.flatnonzero(sims > 0)
        if len(hit) > 4 * k:
            hit = hit[sims[hit] >= np.partition(sims[hit], len(hit) - 2 * k)[len(hit) - 2 * k] - 1e-9]
        ids, sims = ids[hit], np.round(sims[hit], 12)
        n = self.sizes[ids] - np.where(ids == without[0], without[1], 0)
        order = np.lexsort((ids, -sims))
        order = order[n[order] > 0]
        upto = np.cumsum(n[order])
        last = int(np.searchsorted(upto, k))
        if last < len(order):
            order = order[sims[order] >= sims[order[last]]]
        return ids[order], sims[order]

    def vote(self, found: list[tuple[float, int, int]], less: tuple[int, int] = (-1, 0)) -> float:
        """The share of toxic neighbours, weighted by similarity, a fifth of a vote of the prior added. less: an
        entry, and how many of its toxic examples don't count."""
        if not found:
            return self.prior
        at = np.array([x[1] for x in found])
        w = np.array([x[0] for x in found]) ** 2
        y = (w * (self.toxic[at] - np.where(at == less[0], less[1], 0))).sum()
        n = (w * np.array([x[2] for x in found])).sum()
        return float((y + 0.2 * self.prior) / (n + 0.2))

    def calibrate(self) -> None:
        """A monotone map from votes to the rate of toxic examples (pool adjacent violators)."""
        votes = []
        for at, ((features, counts), entry) in enumerate(zip(self.vectors, self.entries, strict=True)):
            weights = self.weights(features, counts)
            copies: dict[int, list[int]] = {}
            for row in entry:
                copies.setdefault(row[1], []).append(row[2])
            for y in copies.values():
                votes.append((self.vote(self.nearest(features, weights, without=(at, len(y))), (at, sum(y))), sum(y), len(y)))
        pools: list[list[float]] = []
        for v, y, n in sorted(votes):
            pools.append([y, n, v])
            while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
                y2, n2, v2 = pools.pop()
                y1, n1, v1 = pools[-1]
                pools[-1] = [y1 + y2, n1 + n2, (v1 * n1 + v2 * n2) / (n1 + n2)]
        if pools:
            x, r = np.array([p[2] for p in pools]), np.array([(p[0] + 0.5 * self.prior) / (p[1] + 0.5) for p in pools])
            self.steps = np.concatenate([[0.0], x, [1.0]]), np.concatenate([[r[0]], np.maximum.accumulate(r), [r[-1]]])

    def score(self, found: list[tuple[float, int, int]]) -> float:
        return float(np.clip(np.interp(self.vote(found), *self.steps), 0, 1)) if found else self.prior

    def evidence(self, found: list[tuple[float, int, int]]) -> list[tuple[object, float, int]]:
        """(example, similarity, label) of the nearest NEIGHBOURS examples; of equally near ones, by their texts' hash."""
        return [(row[0], s, row[2]) for s, at, _ in found for row in self.entries[at]][:NEIGHBOURS]


def fitted(docs: DataFrame, labels: DataFrame, trained: Column, key: str, text: str) -> tuple[DataFrame, Index]:
    """The vectors of docs, and the index over the examples."""
    found = examples(docs, labels, trained, key, text)
    kept = kept_features(found)
    rows = [tuple(r) for r in narrowed(found, kept).collect()]  # MAX_EXAMPLES at most
    found = vectors(docs, kept, key, text)
    n = found.count()
    df = dict(found.select(F.explode("features").alias("f")).groupBy("f").count().collect())
    idf = np.array([np.log((1 + n) / (1 + df.get(k, 0))) + 1 for k in range(len(kept))])
    index = Index(rows, idf)
    index.calibrate()
    return found, index


def scores(docs: DataFrame, labels: DataFrame, trained: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, evidence) of each row: score from 0 to 1, evidence the nearest examples as
    array<struct<example (as key), similarity double, toxic int>>.

    `trained` tells which rows of labels may be learned from, as an expression on labels. Null and empty texts, and
    texts without any kept feature, have no neighbours; their score is the rate of toxic examples among such
    examples. Examples that are equally near count alike, whatever their keys. Rows that repeat keep their places;
    a null key is scored like any other. Labels without a document, with a null, or repeated (the largest holds) do
    no harm. Without examples all scores are 0. An empty table gives an empty table; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    found, index = fitted(docs, labels, trained, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        index, seen = shared.value, {}
        evidence = pa.list_(pa.struct([("example", to_arrow_type(kind)), ("similarity", pa.float64()), ("toxic", pa.int32())]))
        for b in batches:
            out, why = [], []
            for f, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                same = (*f, *n)
                if same not in seen:
                    if len(seen) > SEEN_ENTRIES:
                        seen.clear()
                    near = index.nearest(f, index.weights(f, n)) if f else []
                    seen[same] = index.score(near), [{"example": a, "similarity": s, "toxic": y} for a, s, y in index.evidence(near)]
                out.append(seen[same][0])
                why.append(seen[same][1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64()), pa.array(why, evidence)], names=[key, "score", "evidence"])

    shape = f"`{key}` {kind.simpleString()}, score double, evidence array<struct<example:{kind.simpleString()},similarity:double,toxic:int>>"
    return found.mapInArrow(run, shape)
