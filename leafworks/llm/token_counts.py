"""Token counts by the whole-token shortcut.

A vocabulary string that the merges turn into exactly one token is proved so once, on the driver, before any row
is read; the proved set, no larger than the vocabulary, is broadcast.
Pre-tokens found in that proved set count one each; only the rest runs the merges, and the result of a
pre-token is kept in a bounded cache. Counts equal those of the tokenizer library for whole texts.

Exactness: white space never enters a pre-token, and neither NFC nor lower-casing works across white space,
so a text's count is the sum over its blank-separated chunks. Chunks beyond U+052F, texts that hold a special
token's string or one of the separators U+001C..U+001F, and tokenizers of another shape than
(NFC, white space, lower case | split, byte level | BPE) go to the library itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafworks.llm.shared import small_batches

CACHE_ENTRIES = 300_000
#: Above this code point the Unicode tables of two regular expression engines may differ.
COMMON = "԰"


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in keep else chr(next(spare)) for b in range(256)}


class TokenCounter:
    """Counts tokens without begin, end or added special tokens, truncation or padding."""

    def __init__(self, path: str, proved: frozenset[str] | None = None) -> None:
        self.proved = proved
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda text: len(pieces.encode(text))
            return
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        self.specials = [t["content"] for t in spec["added_tokens"]]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        shape = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if shape != ["NFC", "Replace", "Lowercase"] or (split.get("type"), split.get("invert")) != ("Split", True):
            self.count = self.by_library
            return
        import regex

        self.find = regex.compile(split["pattern"]["Regex"]).findall
        self.normal = self.library.normalizer.normalize_str
        self.letters = {chr(b): c for b, c in byte_letters().items()}
        self.merge = self.library.model.tokenize
        if proved is None:
            self.proved = self.prove(spec["model"])
        self.pieces: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def prove(self, model: dict) -> frozenset[str]:
        """The texts whose pre-token encodes alone as one token."""
        end, back = model["end_of_word_suffix"] or "", {c: b for b, c in byte_letters().items()}
        found = set()
        for token in model["vocab"]:
            word = token[: len(token) - len(end)] if token.endswith(end) else ""
            if word and len(self.merge(word)) == 1 and all(c in back for c in word):
                try:
                    found.add(bytes(back[c] for c in word).decode())
                except UnicodeDecodeError:
                    continue
        return frozenset(found)

    def by_library(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def of_piece(self, piece: str) -> int:
        n = len(self.merge("".join(map(self.letters.__getitem__, piece.encode().decode("latin-1")))))
        if len(piece) <= 64:
            if len(self.pieces) >= CACHE_ENTRIES:
                self.pieces.clear()
            self.pieces[piece] = n
        return n

    def of_chunk(self, chunk: str) -> int:
        if max(chunk) >= COMMON:
            n = self.by_library(chunk)
        else:
            n = 0
            for piece in self.find(chunk.lower() if chunk.isascii() else self.normal(chunk)):
                n += 1 if piece in self.proved else self.pieces.get(piece) or self.of_piece(piece)
        if len(chunk) <= 64:
            if len(self.chunks) >= CACHE_ENTRIES:
                self.chunks.clear()
            self.chunks[chunk] = n
        return n

    def count(self, text: str) -> int:
        if any(s in text for s in self.specials) or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.by_library(text)
        total, known, slow = 0, self.chunks.get, self.of_chunk
        for chunk in text.split():
            n = known(chunk)
            total += slow(chunk) if n is None else n
        return total


@lru_cache(maxsize=2)
def counter(path: str, proved: frozenset[str] | None = None) -> TokenCounter:
    return TokenCounter(path, proved)


def token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """Adds the number of tokens of each whole text as a long column.

    A null or empty text has none. Rows stay as they are, repeated rows and rows with null keys included;
    an empty table gives an empty table. A column that already has the new name is replaced.
    tokenizer_path: a .json of the tokenizers library or a .model of sentencepiece, readable on the driver and on each
    executor.
    """
    small_batches(docs.sparkSession)
    rest = docs.drop(into)
    schema = rest.select("*", F.lit(0).cast("long").alias(into)).schema
    at = rest.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(counter(tokenizer_path).proved)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path, shared.value).count
        for b in batches:
            n = pa.array([count(t) if t else 0 for t in b.column(at).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, n], [*b.schema.names, into])

    return rest.mapInArrow(run, schema)
