"""BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a word has one BPE encoding, and the encodings of its own prefixes are the beginnings of it. So one
token a prefix is enough: its last one. An automaton over the vocabulary reads the word once and names, at each place,
the vocabulary strings that are a suffix of what it has read. Of those the last token is the one that

* the merges make of its own string, and
* stays apart from the last token of the prefix before it: no merge joins the two across their boundary.

There is exactly one. The ids are read off backwards, from the whole word along the stored tokens.

Whether two tokens stay apart is decided by undoing merges at their boundary, the youngest first: the two innermost
parts lived side by side until the first of them was merged away, and a merge of just these two that comes earlier
would have joined them. The answer is kept for the pair.

The word's last symbol carries the mark of a word's end, so it is a symbol of its own here. White space, which words
never hold, divides texts into chunks; chunks of printable ASCII are cut into words by the tokenizer's pattern, all
others by the library's own normalizer and cutter, whose Unicode tables decide. The merges are never run on a text.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from leafworks.llm.bpe import SPACES
from leafworks.llm.shared import small_batches

#: Chunks and words, and pairs of tokens, that a worker remembers at most; longer chunks are not remembered.
CACHE_ENTRIES, CACHE_PAIRS, CACHE_CHARS = 500_000, 1_000_000, 64
#: Added to a letter: the same letter at a word's end, as one symbol.
END = 0x1000
#: The shape of the tokenizers that this module reads.
NORMALIZERS, CUTTERS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same pattern for printable ASCII in lower case.
ASCII_CUT = CUT.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")


class PrefixEncoder:
    """Encodes words, chunks and whole texts by the vocabulary and merges of a .json of the tokenizers library."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        spec = json.loads(library.to_str())
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        self.check(spec)
        self.normal, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added, self.special = added, re.compile("|".join(map(re.escape, added))) if added else None
        self.names: dict[int, str] = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in added.items()}
        #: born: the rank of the merge that makes a token, -1 for single symbols; parts: the two tokens that it joins.
        ranks = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): k for k, m in enumerate(model["merges"])}
        ids = model["vocab"]
        self.rank = {(ids[a], ids[b]): k for (a, b), k in ranks.items()}
        self.born, self.parts = dict.fromkeys(ids.values(), -1), {}
        for (a, b), k in ranks.items():
            joined = ids[a + b]
            if max(self.born[ids[a]], self.born[ids[b]]) >= k or joined in self.parts:
                raise ValueError(f"merge {k} comes before its parts, or makes a token again")
            self.born[joined], self.parts[joined] = k, (ids[a], ids[b])
        self.never, self.own, self.pairs, self.chunks = len(ranks), {}, {}, {}
        #: Strings that the merges don't make one token are never a last token, so the automaton doesn't name them.
        self.automaton, self.sizes = ahocorasick.Automaton(), [0] * (max(ids.values()) + 1)
        for t, i in ids.items():
            symbols = t[: -len(end) - 1] + chr(ord(t[-len(end) - 1]) + END) if t.endswith(end) and len(t) > len(end) else t
            self.sizes[i] = len(symbols)
            if self.is_own(i):
                self.automaton.add_word(symbols, i)
        self.automaton.make_automaton()
        self.ascii_words = re.compile(ASCII_CUT).findall
        self.printable = re.compile(r"[!-~]+").fullmatch

    @staticmethod
    def check(spec: dict) -> None:
        """Raises ValueError unless the file is of the shape that this module knows."""
        model, added = spec["model"], spec["added_tokens"]
        normalizers = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cutters = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        plain = not (model["continuing_subword_prefix"] or model["dropout"] or model.get("ignore_merges") or spec.get("decoder"))
        words = [c["type"] for c in cutters] == CUTTERS and cutters[0]["pattern"] == {"Regex": CUT} and cutters[0]["invert"]
        raw = not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        if not (plain and words and raw and model["end_of_word_suffix"] and normalizers == NORMALIZERS):
            raise ValueError("not a word-end BPE tokenizer of the known shape")

    def stay_apart(self, a: int, b: int, until: int) -> bool:
        """Whether no merge below the rank `until` joins tokens a and b, or what they are made of, across their boundary."""
        ends_a = ends_b = until  # the ranks at which a and b are merged away
        while True:
            r = self.rank.get((a, b))
            # Of equal pairs in a row the left one is merged first: a merge takes b from its right neighbour in a tie.
            if r is not None and r < ends_a and r <= ends_b and r < until:
                return False
            if self.born[a] < 0 and self.born[b] < 0:
                return True
            if self.born[a] >= self.born[b]:
                ends_a, a = self.born[a], self.parts[a][1]
            else:
                ends_b, b = self.born[b], self.parts[b][0]

    def is_own(self, token: int) -> bool:
        """Whether the merges make this token of its own string."""
        found = self.own.get(token)
        if found is None:
            a, b = self.parts.get(token, (None, None))
            found = a is None or (self.is_own(a) and self.is_own(b) and self.stay_apart(a, b, self.born[token]))
            self.own[token] = found
        return found

    def compatible(self, a: int, b: int) -> bool:
        """Whether token b can follow token a in an encoding."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        found = self.pairs[a << 32 | b] = self.stay_apart(a, b, self.never)
        return found

    def last_tokens(self, letters: str) -> list[int]:
        """The last token of each prefix of a word, given as the letters of its bytes."""
        last, sizes, known = [-1] * len(letters), self.sizes, self.pairs.get
        for at, token in self.automaton.iter(letters[:-1] + chr(ord(letters[-1]) + END)):  # at each place the longest first
            if last[at] < 0:
                before = at - sizes[token]
                if before < 0:
                    last[at] = token
                else:
                    fits = known(last[before] << 32 | token)
                    if fits or (fits is None and self.compatible(last[before], token)):
                        last[at] = token
        return last

    def word(self, letters: str) -> list[int]:
        """The ids of a word, given as the letters of its bytes."""
        last, sizes, at, ids = self.last_tokens(letters), self.sizes, len(letters) - 1, []
        while at >= 0:
            token = last[at]
            ids.append(token)
            at -= sizes[token]
        ids.reverse()
        return ids

    def chunk(self, text: str) -> list[int]:
        """The ids of a text without white space."""
        plain = self.printable(text)
        pieces = self.ascii_words(text.lower()) if plain else [p for p, _ in self.cut(self.normal(text))]
        if len(pieces) == 1 and (pieces[0] == text or not plain):
            ids = self.word(pieces[0])
        elif plain:  # words of ASCII are chunks themselves
            ids = []
            for p in pieces:
                found = self.chunks.get(p)
                ids += self.chunk(p) if found is None else found
        else:
            ids = [i for p in pieces for i in self.word(p)]
        if len(text) <= CACHE_CHARS:
            if len(self.chunks) >= CACHE_ENTRIES:
                self.chunks.clear()
            self.chunks[text] = ids
        return ids

    def plain(self, text: str) -> list[int]:
        ids, known, new = [], self.chunks.get, self.chunk
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")  # white space to split(), but not to the tokenizer
        for c in filter(None, re.split(f"[{SPACES}]+", text)) if odd else text.split():
            found = known(c)
            ids += new(c) if found is None else found
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text; strings of added tokens in it are these tokens."""
        if self.special is None or "<" not in text or not self.special.search(text):
            return self.plain(text)
        ids, start = [], 0
        for found in self.special.finditer(text):
            ids += self.plain(text[start : found.start()])
            ids.append(self.added[found.group()])
            start = found.end()
        return ids + self.plain(text[start:])

    def decode(self, ids: list[int]) -> str:
        """The tokens of ids, added tokens included, joined by spaces: the file has no decoder. Unknown ids are left out."""
        names = self.names
        try:
            return " ".join(map(names.__getitem__, ids))
        except KeyError:
            return " ".join(names[i] for i in ids if i in names)


@lru_cache(maxsize=2)
def encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(path)


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of each whole text; a null text is empty and has no ids.

    Every row gives one row, with null or repeated keys too; other columns are dropped. An empty table gives an empty
    table. Texts of any length are encoded whole, with memory of eight bytes a symbol of the longest word.
    path: a .json of the tokenizers library, readable on each executor.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for b in batches:
            ids = pa.array([encode(t) if t else [] for t in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decoded(ids: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, text) of each row of ids; null or empty ids give an empty text."""
    small_batches(ids.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(path).decode
        for b in batches:
            texts = pa.array([decode(x or []) for x in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), texts], names=[key, "text"])

    kind = ids.schema[key].dataType.simpleString()
    return ids.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text string")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes each whole text, decodes its ids again and returns (key, n_tokens, ids_sha256, decoded_sha256).

    One pass: ids are not sent back to the JVM between encoding and decoding. Nulls and repeats as in encoded().
    """
    small_batches(docs.sparkSession)
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        decimal = {i: str(i).encode() for i in own.names}
        for b in batches:
            n, digests, back = [], [], []
            for t in b.column(1).to_pylist():
                ids = own.encode(t) if t else []
                n.append(len(ids))
                digests.append(hashlib.sha256(b" ".join(map(decimal.__getitem__, ids))).hexdigest())
                back.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digests), pa.array(back)], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(key, text).mapInArrow(run, schema)
