"""Entities: spans by labelled patterns, earlier labels first."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafworks.functions import patterns as P

#: What a text must hold before a label's pattern is tried on it: saves its long walks back over texts without a match.
GUARDS = {"ACT_POLICY": r"(?i)(act|policy),?\s+\d{4}|code\s+of\s"}
#: Marks that no match of a guarded pattern can span, nor take as part of a word: it is tried on what lies between.
MARKS = r"[.;:!?\"()\[\]{}/]"
BETWEEN = re.compile(r"[^.;:!?\"()\[\]{}/]+")
SPANS = "array<struct<text:string,label:string,start:int,end:int>>"


def found_in(text: str, label: str, pattern: re.Pattern) -> Iterator[re.Match]:
    if label not in GUARDS:
        yield from pattern.finditer(text)
    elif re.search(GUARDS[label], text):
        for part in BETWEEN.finditer(text):
            if re.search(GUARDS[label], part.group()):
                yield from pattern.finditer(text, *part.span())


def spans(text: str, compiled: list[tuple[str, re.Pattern]]) -> list[dict]:
    """The matches of all labels in the order of their start; one that overlaps an accepted one is dropped."""
    taken: list[tuple[int, int]] = []
    found = []
    for label, pattern in compiled:
        for m in found_in(text, label, pattern):
            if all(m.end() <= a or m.start() >= b for a, b in taken):
                taken.append(m.span())
                found.append({"text": m.group().strip(), "label": label, "start": m.start(), "end": m.end()})
    return sorted(found, key=lambda e: e["start"])


def with_entities(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds entities. Spark's regular expressions give no offsets, so batches go through Arrow; only the text does."""

    @F.arrow_udf(SPANS)
    def extract(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compiled = [(label, re.compile(p)) for label, p in P.ENTITIES]
        kind = pa.list_(pa.struct([("text", pa.string()), ("label", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for part in parts:
            yield pa.array([spans(t or "", compiled) for t in part.to_pylist()], kind)

    return df.withColumn("entities", extract(F.col(text)))


def totals(df: DataFrame) -> DataFrame:
    """(file_id, entities): the mentions of each file."""
    return df.groupBy("file_id").agg(F.sum(F.size("entities")).alias("entities"))


def frequencies(df: DataFrame) -> DataFrame:
    """(label, mentions) of the entities that stay after overlaps are dropped. df: as from with_entities()."""
    return df.select(F.explode("entities.label").alias("label")).groupBy("label").agg(F.count("*").alias("mentions"))


def label_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(label, mentions) by each label's pattern alone, inside the JVM: overlaps count for each label, unlike frequencies()."""

    def count(label: str, p: str) -> Column:
        if label not in GUARDS:
            return F.regexp_count(text, F.lit(p))
        parts = F.filter(F.split(text, MARKS), lambda x: x.rlike(GUARDS[label]))
        return F.aggregate(parts, F.lit(0), lambda n, x: n + F.regexp_count(x, F.lit(p)))

    counts = F.explode(F.array(*(F.struct(F.lit(label).alias("label"), count(label, p).alias("n")) for label, p in P.ENTITIES))).alias("x")
    return df.select(counts).where("x.n > 0").groupBy("x.label").agg(F.sum("x.n").cast("long").alias("mentions"))
