"""Divergence of sources: how far the words of each source are from those of the other sources of its language.

1. Counts. Each task counts the terms of its rows by language and source, a bounded number at a time, and the documents
   that hold them. What moves is one row a term, source and task; a source or a word that a third of all rows share
   has no more than others. Terms in too few documents of their language go. The rest is written: the kept counts.
2. Dictionary. The kept counts are dealt by ranges of (language, term), so a task holds some terms of a language in
   UTF-8 order. It cuts them into chunks of CHUNK_TERMS. In a chunk the terms are a sorted array, searchsorted gives
   each row its term's id, and bincount makes one dense vector of counts a source. Ids are in UTF-8 order too.
3. Divergences. Each chunk's vectors become shares in whole numbers, and pairs of sources sum up their distances, one
   block of sources after the other. A task adds up its chunks; the rows that move are one a pair and task. Of each
   source a chunk hands on its TOP terms: the first of equal ones are those with smaller ids.

All arithmetic is in whole numbers; products that don't fit 64 bits are taken in steps. No vocabulary is broadcast or
collected; the totals of a language's sources come to its chunks by a join, broadcast only when they are few.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafworks.llm.shared import free, small_batches, text_or_empty, written

MIN_DOCS = 10
TOP = 10
SCALE_STEPS, SCALE_STEP = 3, 1000  # 1000 ** 3 parts
#: Terms of a chunk; sources whose vectors meet all others at a time; counts that a task holds before it hands them on.
CHUNK_TERMS, SOURCE_BLOCK, HELD_COUNTS = 4096, 64, 400_000
#: Bytes of text after which a task hands its counts on, too.
HELD_BYTES = 64 << 20
#: Sources that are broadcast to the chunks at most (some 10 MB); more come by a join on salted keys.
BROADCAST_SOURCES, SALTS = 100_000, 64
#: Bytes that make terms are letters and all beyond ASCII; capitals become small letters.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Partial counts (lang, source, term, n, docs): occurrences of a term in some rows of a source, and the rows that
    hold it. A row with an empty term stands for the source itself."""
    small_batches(docs.sparkSession)
    names = [x.split()[0] for x in COUNTS.split(", ")]
    few = docs.select(*(text_or_empty(c).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))

    def batch(n: dict, held: dict) -> pa.RecordBatch:
        rows = [(g[0], g[1], w, c, held[g][w]) for g, own in n.items() for w, c in own.items()]
        columns = [*zip(*rows, strict=True)] or [[]] * 5
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held, size, read = defaultdict(Counter), defaultdict(Counter), 0, 0
        for b in batches:
            for one, two, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                group, words = (one, two), t.encode().translate(LETTERS).split()
                read += len(t)
                own, rows = n[group], held[group]
                size -= len(own)
                own.update(words)
                rows.update(set(words))
                own[b""] = rows[b""] = 0
                size += len(own)
                if size > HELD_COUNTS or read > HELD_BYTES:
                    yield batch(n, held)
                    n, held, size, read = defaultdict(Counter), defaultdict(Counter), 0, 0
        yield batch(n, held)

    return few.mapInArrow(run, COUNTS)


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n) of the terms in at least min_docs documents of their language, and a row with an empty
    term for each source. Written: one shuffle, by language and term."""
    dealt = term_counts(docs, lang, source, text).repartition("lang", "term")
    n = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    found = n.withColumn("docs", F.sum("docs").over(Window.partitionBy("lang", "term")))
    return written(found.where((F.col("docs") >= min_docs) | (F.col("term") == "")).select("lang", "source", "term", "n"))


def totals(kept: DataFrame) -> DataFrame:
    """One row a language: lang, v (its kept terms), n (their occurrences), sources array of (source, n) in order."""
    sources = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    listed = sources.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("sources"), F.sum("n").alias("n"))
    terms = kept.where("term <> ''").groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("v"))
    return listed.join(terms, "lang", "left").select("lang", F.coalesce("v", F.lit(0)).alias("v"), "n", "sources")


def chunks(kept: DataFrame, chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """(lang, terms, sources, at, term, n): chunks of a language's terms in UTF-8 order, and their counts as sparse
    vectors: of the source sources[at[i]] the term terms[term[i]] occurs n[i] times."""
    shape = "lang string, terms array<string>, sources array<string>, at array<int>, term array<int>, n array<long>"
    rows = kept.where("term <> ''").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    names = [x.split()[0] for x in shape.split(", ")]

    def chunk(lang: str, rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
        sources, found = (np.array([r[k].encode() for r in rows], object) for k in (0, 1))  # objects: a long term widens no other
        own, terms = np.unique(sources), np.unique(found)
        lists = [pa.array([[x.decode() for x in c]], pa.list_(pa.string())) for c in (terms, own)]
        ids = [pa.array([np.searchsorted(c, x).astype(np.int32)], pa.list_(pa.int32())) for c, x in ((own, sources), (terms, found))]
        return pa.RecordBatch.from_arrays([pa.array([lang]), *lists, *ids, pa.array([[r[2] for r in rows]], pa.list_(pa.int64()))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, last, n, held = None, None, 0, []
        for b in batches:
            for one, source, term, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if (one, term) != (lang, last):
                    if held and (one != lang or n == chunk_terms):
                        yield chunk(lang, held)
                        n, held = 0, []
                    lang, last, n = one, term, n + 1
                held.append((source, term, c))
        if held:
            yield chunk(lang, held)

    return rows.mapInArrow(run, shape)


def shares(counts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / of), exact for totals below 9 * 10**15: the product is taken in steps."""
    whole, rest = np.divmod(counts + 2, of)
    for _ in range(SCALE_STEPS):
        more, rest = np.divmod(rest * SCALE_STEP, of)
        whole = whole * SCALE_STEP + more
    return whole + 1


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def divergences(found: DataFrame, top: int = TOP) -> DataFrame:
    """Partial rows (lang, source, part, item, value): of pairs sums over some terms, of terms the best `top` of a chunk.
    found: as from with_totals()."""
    shape = "lang string, source string, part string, item string, value long"
    names = [x.split()[0] for x in shape.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [*zip(*rows, strict=True)] or [[]] * 5
        kinds = [pa.string()] * 4 + [pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, listed, sums = None, [], np.zeros((0, 0), np.int64)

        def pairs() -> Iterator[pa.RecordBatch]:
            for i, s in enumerate(listed):
                yield batch([(held, s, "pair", t, v) for j, (t, v) in enumerate(zip(listed, sums[i].tolist(), strict=True)) if j != i])

        for b in batches:
            for row in b.to_pylist():
                if row["lang"] != held:
                    yield from pairs()
                    held, listed = row["lang"], [s["source"] for s in row["all"]]
                    sums = np.zeros((len(listed), len(listed)), np.int64)
                terms, many = row["terms"], len(row["terms"])
                place = {s: k for k, s in enumerate(listed)}
                ids = np.array([place[s] for s in row["sources"]])[row["at"]] * many + np.array(row["term"])
                # Whole counts as bincount's weights are exact to 2**53.
                counts = np.bincount(ids, np.array(row["n"], np.float64), len(listed) * many).astype(np.int64).reshape(len(listed), many)
                of = np.array([s["n"] for s in row["all"]], np.int64)[:, None] + 2 * row["v"]
                p, q = shares(counts, of), shares(counts.sum(axis=0), np.int64(row["total"] + 2 * row["v"]))
                for i in range(len(listed)):
                    for j in range(i + 1, len(listed), SOURCE_BLOCK):
                        block = slice(j, min(j + SOURCE_BLOCK, len(listed)))
                        d = distances(p[block], p[i]).sum(axis=1)
                        sums[i, block] += d
                        sums[block, i] += d
                best = []
                for i, s in enumerate(listed):
                    more = np.flatnonzero((counts[i] > 0) & (p[i] > q))
                    value = distances(p[i][more], q[more])
                    best += [(held, s, "term", terms[more[k]], int(value[k])) for k in np.argsort(-value, kind="stable")[:top]]
                yield batch(best)
        yield from pairs()

    return found.mapInArrow(run, shape)


def with_totals(found: DataFrame, sums: DataFrame) -> DataFrame:
    """chunks() with v, total and all (the language's sources and their totals)."""
    sides = sums.select(F.col("lang").alias("_lang"), "v", F.col("n").alias("total"), F.col("sources").alias("all"))
    if (sums.agg(F.sum(F.size("sources"))).first()[0] or 0) <= BROADCAST_SOURCES:
        return found.join(F.broadcast(sides), F.col("lang") == F.col("_lang")).drop("_lang")
    salted = sides.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(F.element_at("terms", 1)), F.lit(SALTS))
    return found.join(salted, (F.col("lang") == F.col("_lang")) & (salt == F.col("_salt"))).drop("_lang", "_salt")


def source_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang: str = "lang", source: str = "source", text: str = "text", chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): of each source the other sources of its language (part `pair`, all of
    them) and its `top` most over-represented terms (part `term`), ranked from 1 by value, then by the item's UTF-8 bytes.

    Terms are stretches of ASCII letters and characters beyond ASCII; A-Z count as a-z, nothing else changes. A language
    keeps the terms in at least min_docs of its rows; rows that repeat a document count again. Null texts, languages and
    sources are empty ones. A language without kept terms has pairs of value 0, one with a single source has no pairs.
    Texts of any length count whole. An empty table gives an empty table; other columns aren't looked at.
    """
    kept = kept_counts(docs, min_docs, lang, source, text)
    sums = written(totals(kept))
    found = divergences(with_totals(chunks(kept, chunk_terms), sums), top)
    # Pairs of languages without terms, and of a task that had no chunk: zeros that add nothing to others.
    own, item = free("own", sums), free("item", sums)
    zero = sums.where("v = 0").select("lang", "sources", F.explode("sources.source").alias(own)).select("lang", own, F.explode("sources.source").alias(item))
    zero = zero.where(F.col(own) != F.col(item)).select("lang", F.col(own).alias("source"), F.lit("pair").alias("part"), F.col(item).alias("item"), F.lit(0).cast("long").alias("value"))
    whole = found.unionByName(zero).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = whole.withColumn("rank", place)
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
