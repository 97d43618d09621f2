"""Vectors: hashed embeddings, cosine, nearest neighbours and retrieval measures."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafworks.functions import patterns as P
from leafworks.sources.store import bounded_batches, written

#: Queries that meet the candidates of a slice at a time, rows of a slice, pivots at most, and rows a cell beyond FEW_PIVOTS.
QUERY_BLOCK, SLICE_ROWS, MAX_PIVOTS, CELL_ROWS, FEW_PIVOTS = 256, 8192, 4096, 4096, 128
#: What bounds leave for the rounding of scores to six places and of angles.
SCORE_SLACK, ANGLE_SLACK = 5e-7 + 1e-9, 1e-6
#: Queries whose visits are made at a time.
VISITORS = 64
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def embedded(df: DataFrame, text: str = "text", dims: int = 64) -> DataFrame:
    """Adds vector: the L2-normalised hashed bag of words, an offline stand-in for a text model, which would stand in
    the same place: one pass in Arrow batches. All zeros for a text without words. A word's place is the first 32 bits
    of its MD5 digest, modulo dims."""

    bounded_batches(df.sparkSession)

    @F.arrow_udf("array<double>")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        places: dict[str, int] = {}
        for part in parts:
            out = []
            for t in part.to_pylist():
                counts = np.zeros(dims)
                for word, n in Counter(WORD.findall(t or "")).items():
                    if word not in places:
                        if len(places) > 300_000:
                            places.clear()
                        places[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dims
                    counts[places[word]] += n
                norm = np.sqrt((counts * counts).sum())
                out.append(counts / norm if norm else counts)
            yield pa.array(out, pa.list_(pa.float64()))

    return df.withColumn("vector", encode(F.lower(text)))


def misfits(df: DataFrame, dims: int, vector: str = "vector") -> DataFrame:
    """The rows whose vector isn't one of `dims` numbers: the check before a collection takes them."""
    return df.where(F.coalesce(F.size(vector) != dims, F.lit(True)))


@dataclass
class Cells:
    """The cells of a table of vectors: unit pivots, and of each cell the number of its rows and the least and greatest
    angle to its pivot. Cell -1 holds the vectors of zeros."""

    pivots: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    zeros: int
    slice_rows: int

    def slices(self, cell: int) -> int:
        return -(-(self.zeros if cell < 0 else int(self.rows[cell])) // self.slice_rows) or 1

    def angles(self, units: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(units @ self.pivots.T, -1, 1))

    def first(self, angles: np.ndarray, k: int) -> list[np.ndarray]:
        """For each row of angles the nearest cells that hold k other rows together."""
        order = np.argsort(angles, axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1)
        return [o[: int(np.searchsorted(h, k + 1)) + 1] for o, h in zip(order, held, strict=True)]

    def reach(self, angles: np.ndarray) -> np.ndarray:
        """The greatest cosine that a member of each cell can have, by the triangle inequality of angles."""
        least = np.maximum(0, np.maximum(angles - self.high, self.low - angles) - ANGLE_SLACK)
        return np.where(self.rows > 0, np.cos(least), -2.0)


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """The vectors of an Arrow column as the rows of a matrix of unit length; nulls and zeros are rows of zeros."""
    out = np.zeros((len(column), dims))
    if len(column):
        out[column.is_valid().to_numpy(zero_copy_only=False)] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-300)


def cells(candidates: DataFrame, dims: int) -> tuple[DataFrame, Cells]:
    """The candidates, written with their cell and angle, and the cells. The pivots are rows drawn by a hash of their id:
    twice the root of the number of rows, but no more than FEW_PIVOTS or one for CELL_ROWS rows, and MAX_PIVOTS at most. A
    query's vector is sent to each cell that it visits, so cells have to be large enough to be worth it."""
    count = candidates.count()
    n = min(MAX_PIVOTS, int(2 * count**0.5), max(FEW_PIVOTS, count // CELL_ROWS))
    drawn = candidates.select("embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).toArrow()["embedding"].combine_chunks()
    pivots = np.unique(matrix(drawn, dims).round(12), axis=0) if n else np.zeros((0, dims))
    pivots = matrix(pa.array(list(pivots[(pivots != 0).any(axis=1)]), pa.list_(pa.float64())), dims)
    shared = candidates.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units = matrix(b.column("embedding"), dims)
            there = (units != 0).any(axis=1)
            cosines = np.clip(units @ shared.value.T, -1, 1) if len(shared.value) else np.zeros((len(units), 1))
            cell = np.where(there, cosines.argmax(axis=1), -1)
            angle = np.where(there, np.arccos(cosines.max(axis=1)), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(angle)], names=[*b.schema.names, "cell", "angle"])

    table = written(candidates.mapInArrow(assign, "vec_id long, label int, embedding array<double>, cell int, angle double"))
    found = {r.cell: r for r in table.groupBy("cell").agg(F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")).collect()}
    own = [(found[c].n, found[c].low, found[c].high) if c in found else (0, 0.0, 0.0) for c in range(len(pivots))]
    rows, low, high = (np.array([x[k] for x in own], float if k else int) for k in range(3))
    return table, Cells(pivots, rows, low, high, found[-1].n if -1 in found else 0, SLICE_ROWS)


def scored(visits: DataFrame, table: DataFrame, sizes: DataFrame, dims: int, k: int) -> DataFrame:
    """(query_id, query_label, vec_id, label, score): of each visit (a query in a slice of a cell) the k best rows there.
    A task holds one slice of candidates as a matrix and goes through the queries that visit it, batch by batch."""
    slice_ = F.pmod(F.xxhash64("vec_id"), F.col("slices")).cast("int").alias("slice")
    visited = visits.select("cell", "slice").distinct()  # as many as there are slices at most; the others stay where they are
    members = table.join(F.broadcast(sizes), "cell").select("cell", slice_, F.lit(0).alias("side"), F.lit(-1.0).alias("least"), "vec_id", "label", "embedding")
    members = members.join(F.broadcast(visited), ["cell", "slice"], "left_semi")
    dealt = visits.select("cell", "slice", F.lit(1).alias("side"), "least", "vec_id", "label", "embedding").unionByName(members)
    dealt = dealt.repartition("cell", "slice").sortWithinPartitions("cell", "slice", "side")
    names = ["query_id", "query_label", "vec_id", "label", "score"]

    def best(q: pa.RecordBatch, ids: np.ndarray, labels: np.ndarray, units: np.ndarray) -> Iterator[pa.RecordBatch]:
        own, own_label = (q.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        asked = matrix(q.column("embedding"), dims)
        floor = q.column("least").to_numpy() - SCORE_SLACK
        for at in range(0, len(asked), QUERY_BLOCK):
            part = slice(at, at + QUERY_BLOCK)
            scores = asked[part] @ units.T
            scores[own[part, None] == ids[None, :]] = -2.0  # a row isn't its own neighbour
            least = np.maximum(floor[part, None], -1.5)
            hits = scores >= least
            if k < scores.shape[1] and np.count_nonzero(hits) > 8 * k * len(scores):
                # All that can be as good as the k-th once both are rounded.
                hits = scores >= np.maximum(least, np.partition(scores, -k, axis=1)[:, -k, None] - 2 * SCORE_SLACK)
            i, j = np.nonzero(hits)
            found = np.round(scores[i, j], 6) + 0.0
            order = np.lexsort((ids[j], -found, i))
            i, j, found = i[order], j[order], found[order]
            kept = np.arange(len(i)) - np.searchsorted(i, i) < k
            i, j, found = i[kept], j[kept], found[kept]
            columns = own[part][i], own_label[part][i], ids[j], labels[j], found
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.float64()], strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, labels, units = None, [], [], []
        for b in batches:
            keys = np.stack([b.column(c).to_numpy() for c in ("cell", "slice", "side")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), len(b)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                part, key = b.slice(start, end - start), tuple(keys[:2, start].tolist())
                if key != at:
                    at, ids, labels, units = key, [], [], []
                if keys[2, start] == 0:
                    ids.append(part.column("vec_id").to_numpy())
                    labels.append(part.column("label").to_numpy(zero_copy_only=False))
                    units.append(matrix(part.column("embedding"), dims))
                elif ids:
                    ids, labels, units = [np.concatenate(ids)], [np.concatenate(labels)], [np.concatenate(units)]
                    yield from best(part, ids[0], labels[0], units[0])

    return dealt.mapInArrow(run, "query_id long, query_label int, vec_id long, label int, score double")


def top(found: DataFrame, k: int) -> DataFrame:
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k)


def visits(queries: DataFrame, own: Cells, dims: int, k: int, first: bool) -> DataFrame:
    """(vec_id, label, embedding, least, cell, slice): the slices of cells that each query has to look at. First: its nearest
    cells that hold k rows. Then (queries with `least`, their k-th best score so far): those others that can hold a better row."""
    shared = queries.sparkSession.sparkContext.broadcast(own)
    columns = ["vec_id", "label", "embedding"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        slices = np.array([own.slices(c) for c in [*range(len(own.pivots)), -1]])  # the last one is that of cell -1
        for b in batches:
            units = matrix(b.column("embedding"), dims)
            angles = own.angles(units)
            near, reach = own.first(angles, k), None if first else own.reach(angles)
            least = np.full(len(b), -1.0) if first else b.column("least").to_numpy(zero_copy_only=False)
            # A few queries at a time: their visits are rows with a vector each.
            for start in range(0, len(b), VISITORS):
                at, cell = [], []
                for i in range(start, min(start + VISITORS, len(b))):
                    chosen = near[i]
                    if not first:
                        chosen = np.setdiff1d(np.flatnonzero(reach[i] >= least[i] - SCORE_SLACK), near[i])
                        chosen = np.append(chosen, [-1] if own.zeros and least[i] - SCORE_SLACK <= 0 else []).astype(int)
                    at.append(np.full(len(chosen), i))
                    cell.append(chosen)
                at, cell = np.concatenate(at), np.concatenate(cell)
                n = slices[cell]
                part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at, cell = np.repeat(at, n), np.repeat(cell, n)
                taken = b.select(columns).take(pa.array(at, pa.int32()))
                out = [*taken.columns, pa.array(least[at]), pa.array(cell, pa.int32()), pa.array(part, pa.int32())]
                yield pa.RecordBatch.from_arrays(out, names=[*columns, "least", "cell", "slice"])

    return queries.mapInArrow(run, "vec_id long, label int, embedding array<double>, least double, cell int, slice int")


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, query_label, vec_id, label, score, rank): the k best of all candidates for each query but itself, by
    cosine to six places, then by id. Both: vec_id, label, embedding; nulls and vectors of zeros are at 0 to all.

    Exact, with pruning: candidates lie in the cells of pivots, once. A query looks at its nearest cells first; then its
    k-th best score and the triangle inequality of angles leave the cells that can still hold a neighbour, and only those
    are visited. Large cells are cut in slices of SLICE_ROWS rows, so many equal vectors are no hot key. A query's vector
    moves once a slice that it visits, a candidate twice, whatever the number of queries.
    """
    bounded_batches(queries.sparkSession)
    shaped = lambda df: df.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), F.col("embedding").cast("array<double>"))
    queries, candidates = shaped(queries), shaped(candidates)
    sizes = (df.agg(F.max(F.size("embedding"))).first()[0] for df in (candidates, queries))
    dims = next((n for n in sizes if n and n > 0), 1)
    table, own = cells(candidates, dims)
    zero = F.coalesce(F.forall("embedding", lambda x: x == 0), F.lit(True))
    # Queries of zeros are at 0 to all: their neighbours are the smallest ids.
    lead = [(r.vec_id, r.label) for r in candidates.orderBy("vec_id").limit(k + 1).collect()]
    firsts = F.array(*(F.struct(F.lit(i).alias("vec_id"), F.lit(v).cast("int").alias("label")) for i, v in lead)).cast("array<struct<vec_id:long,label:int>>")
    blank = queries.where(zero).select(F.col("vec_id").alias("query_id"), F.col("label").alias("query_label"), F.explode(firsts).alias("x"))
    blank = blank.select("query_id", "query_label", "x.vec_id", "x.label", F.lit(0.0).alias("score")).where("vec_id <> query_id")
    asked = queries.where(~zero).repartition(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), "vec_id")
    sizes = queries.sparkSession.createDataFrame([(c, own.slices(c)) for c in range(-1, len(own.pivots))], "cell int, slices int")
    one = written(top(scored(visits(asked, own, dims, k, True), table, sizes, dims, k), k).drop("rank"))
    least = one.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(-1.0).alias("least"))
    narrowed = asked.join(least, asked["vec_id"] == least["query_id"], "left").select("vec_id", "label", "embedding", F.coalesce("least", F.lit(-1.0)).alias("least"))
    two = scored(visits(narrowed, own, dims, k, False), table, sizes, dims, k)
    return top(one.unionByName(two).unionByName(blank), k)


def synthesized(text: Column) -> Column:
    """The retrieval query that a chunk's words stand for, null for none; the first rule that applies."""
    has = lambda w: F.lower(text).contains(w[1:]) if w[0] == "~" else text.contains(w)
    q = F.when(F.lit(False), "")
    for (how, words), found in P.QUERY_RULES:
        q = q.when(reduce(and_ if how == "all" else or_, [has(w) for w in words]), found)
    return q


def asked(chunks: DataFrame, place: str, text: str = "text") -> DataFrame:
    """(query, expected): each query that some chunk stands for, and the first such chunk by place. Where none does, the two
    default queries, which ask for the first and the second chunk, or the first one again."""
    found = chunks.select(synthesized(F.col(text)).alias("query"), F.col(place).alias("c")).where("query IS NOT NULL").groupBy("query").agg(F.min("c").alias("expected"))
    if found.isEmpty():
        first = [r.c for r in chunks.select(F.col(place).alias("c")).orderBy("c").limit(2).collect()]
        rows = [(q, first[min(k, len(first) - 1)]) for k, q in enumerate(P.DEFAULT_QUERIES) if first]
        return chunks.sparkSession.createDataFrame(rows, f"query string, expected {chunks.schema[place].dataType.simpleString()}")
    return found


def retrieved(chunks: DataFrame, queries: DataFrame, encode: Callable[[DataFrame, str], DataFrame], k: int = 10) -> DataFrame:
    """(query, expected, rank): the place of each query's chunk among the k nearest chunks, 0 if it isn't there.
    chunks: place (long), text; queries: query, expected (a place); encode: adds vector to a frame, given its text column."""
    own = encode(chunks.select(F.col("place").alias("vec_id"), F.lit(0).alias("label"), "text"), "text")
    own = written(own.select("vec_id", "label", "vector"))  # asked several times, encoded once
    numbers = written(queries.select("query", "expected", (-1 - F.pmod(F.xxhash64("query"), F.lit(1 << 62))).alias("vec_id")))
    sides = (encode(numbers.withColumn("label", F.lit(0)), "query"), own)
    near = nearest(*(s.select("vec_id", "label", F.col("vector").alias("embedding")) for s in sides), k)
    near = near.select(F.col("query_id").alias("vec_id"), F.col("vec_id").alias("expected"), "rank")
    return numbers.join(near, ["vec_id", "expected"], "left").select("query", "expected", F.coalesce("rank", F.lit(0)).alias("rank"))


def first_hits(found: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, rank): the first neighbour with the query's label, 0 for none."""
    hits = found.where("label = query_label").groupBy("query_id").agg(F.min("rank").alias("rank"))
    return queries.select(F.col("vec_id").alias("query_id")).join(hits, "query_id", "left").select("query_id", F.coalesce("rank", F.lit(0)).alias("rank"))


def measures(ranks: DataFrame) -> DataFrame:
    r = F.col("rank")
    mean = lambda x, name: F.round(F.avg(x), 6).alias(name)
    return ranks.agg(
        F.count("*").alias("queries"), mean(F.when(r > 0, 1 / r).otherwise(0.0), "mrr"), mean(F.when(r.between(1, 5), 1 / F.log2(r + 1)).otherwise(0.0), "ndcg5"),
        mean(r.between(1, 5).cast("double"), "recall5"), mean(r.between(1, 10).cast("double"), "recall10"),
    )


def evaluation(found: DataFrame, queries: DataFrame) -> DataFrame:
    """The measures of nearest()'s lists, the first neighbour of a query's label being the hit."""
    return measures(first_hits(found, queries))


def corpus(chunks: DataFrame, fallback: DataFrame) -> DataFrame:
    """chunks, or the fallback rows where there are none."""
    return fallback if chunks.isEmpty() else chunks
