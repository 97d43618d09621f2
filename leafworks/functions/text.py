"""Text functions on columns: trimming, normalising, correction."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafworks.functions import patterns as P
from leafworks.sources.store import bounded_batches


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends; only texts that have some there go through the pattern."""
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    return F.when(ends.rlike(r"(?U)\s"), F.regexp_replace(c, r"(?U)^\s+|\s+$", "")).otherwise(c)


def named(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a column that is costly to compute and that f looks at several times: a lambda's argument is computed once."""
    return F.transform(F.array(c), f)[0]


def strip_result(c: Column) -> Column:
    """The same for a text that is costly to compute: it is named once."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalized(c: Column) -> Column:
    """White space runs as one space, stripped, lower-cased."""
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def has_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (c.contains(w) for w in words))


def core(pattern: str) -> str:
    """The longest plain characters, in lower case, that each match of a pattern holds; empty if none are certain."""
    runs, run, depth, k = [], "", 0, 0
    pattern = pattern.removeprefix("(?i)")
    while k < len(pattern):
        ch, plain = pattern[k], None
        if ch == "\\":
            k += 1
            plain = None if pattern[k].isalnum() else pattern[k]
        elif ch == "[":
            k = re.compile(r"\[\^?\]?(?:\\.|[^\]\\])*\]").match(pattern, k).end() - 1
        elif ch in "()":
            depth += 1 if ch == "(" else -1
        elif ch == "|" and not depth:
            return ""
        elif ch in "*?{":  # what is before it need not be there
            run = run[:-1]
            k = pattern.index("}", k) if ch == "{" else k
        elif ch not in "^$.+|":
            plain = ch
        if plain and not depth:
            run += plain
        else:
            runs, run = [*runs, run], ""
        k += 1
    return max([*runs, run], key=len).lower()


def matches(c: Column, found: list[str]) -> Column:
    """Whether one of the patterns is found. Those that begin at the start of the text share one start, so the engine
    tries them there alone and not at each character. Others are tried on texts that hold characters which their matches
    must have."""
    start = re.compile(r"^(\(\?i\))?\^")
    fixed, free = [start.sub(r"\1", p) for p in found if start.match(p)], [p for p in found if not start.match(p)]
    sure, unsure = [p for p in free if core(p)], [p for p in free if not core(p)]
    parts = [c.rlike(f"^(?:{P.any_of(fixed)})")] if fixed else []
    parts += [has_any(F.lower(c), sorted({core(p) for p in sure})) & c.rlike(P.any_of(sure))] if sure else []
    return reduce(lambda a, b: a | b, [*parts, c.rlike(P.any_of(unsure))] if unsure else parts)


def literal(pattern: str) -> str:
    """The plain characters that a pattern starts with (a match holds them all), empty if it has none."""
    head = re.match(r"(?:\\b)?((?:[^\\\[\](){}?*+.|^$]|\\[.{])*)(.?)", pattern)
    plain = head[1][:-1] if head[2] and head[2] in "?*{" else head[1]
    return plain.replace("\\", "")


def replaced(c: Column, pairs: list[tuple[str, str]], together: int = 12) -> Column:
    """Each pattern replaced in turn. Patterns go in groups, tried one by one only on texts that hold the plain characters
    of one of them and in which one of them is found at all; each group's lambda gives the text so far a name, so that
    it is computed once."""

    def group(few: list[tuple[str, str]]) -> Column:
        plain = [literal(p) for p, _ in few]
        chain = lambda x: reduce(lambda a, p: F.regexp_replace(a, f"(?U){p[0]}", p[1]), few, x)
        found = f"(?U){P.any_of([p for p, _ in few])}"
        held = lambda x: has_any(x, plain) & x.rlike(found) if all(plain) else x.rlike(found)
        return F.transform(F.array(c), lambda x: F.when(held(x), chain(x)).otherwise(x))[0]

    for k in range(0, len(pairs), together):
        c = group(pairs[k : k + together])
    return c


class Replacer:
    """Patterns replaced in turn, after one pass of an automaton over the plain characters that each pattern starts with.

    The automaton (Aho-Corasick) names the patterns whose characters occur, at a word's edge where the pattern asks for
    one; only those are tried, in their order. A replacement can make another pattern's characters, so the pass is made
    again on a text that changed, for the patterns after that one. Most texts are read once and no pattern is tried.
    """

    def __init__(self, pairs: list[tuple[str, str]]) -> None:
        import ahocorasick

        self.rules = [(re.compile(p), to) for p, to in pairs]
        self.whole = [(p.startswith(r"\b"), p == rf"\b{re.escape(literal(p))}\b") for p, _ in pairs]
        self.automaton, held, self.folded = ahocorasick.Automaton(), {}, []
        for k, (p, _) in enumerate(pairs):
            if p.startswith("(?i)"):
                self.folded.append((literal(p[4:]).lower(), k))
            else:
                held.setdefault(literal(p), []).append(k)
        if "" in held:
            raise ValueError(f"no plain characters at the start of {pairs[held[''][0]][0]}")
        for word, rules in held.items():
            self.automaton.add_word(word, (len(word), rules))
        self.automaton.make_automaton()

    def candidates(self, text: str, after: int) -> list[int]:
        word = lambda k: 0 <= k < len(text) and (text[k].isalnum() or text[k] == "_")
        found = set()
        for end, (size, rules) in self.automaton.iter(text):
            for k in rules:
                if k > after and k not in found and (not self.whole[k][0] or word(end - size) != word(end - size + 1)) and (not self.whole[k][1] or word(end) != word(end + 1)):
                    found.add(k)
        if self.folded:
            low = text.lower()
            found |= {k for start, k in self.folded if k > after and start in low}
        return sorted(found)

    def replaced(self, text: str) -> str:
        todo = self.candidates(text, -1)
        while todo:
            k, *todo = todo
            pattern, to = self.rules[k]
            new = pattern.sub(to, text)
            if new != text:
                text, todo = new, self.candidates(new, k)
        return text


def replaced_by_automaton(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """replaced() for many patterns without groups that start with plain characters; in Arrow batches."""
    bounded_batches(SparkSession.active())

    @F.arrow_udf("string")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Replacer(pairs)
        for texts in parts:
            yield pa.array([None if t is None else own.replaced(t) for t in texts.to_pylist()], pa.string())

    return run(c)


def characters(c: Column) -> Column:
    """Look-alike characters, ligatures and private glyphs as plain ones: single ones in one pass, then the others."""
    single = [(a, b) for a, b in P.CHARACTERS if len(b) <= 1]
    out = F.translate(c, "".join(a for a, b in single if b) + "".join(a for a, b in single if not b), "".join(b for _, b in single if b))
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), [p for p in P.CHARACTERS if len(p[1]) > 1], out)


def joined_breaks(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U){P.HYPHEN_BREAK}", "$1$2")


def spaces(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n")


def basic_correction(c: Column) -> Column:
    """Characters, line breaks in words, abbreviations, confused and split words, spaces; in this order."""
    c = joined_breaks(characters(c))
    return strip_result(spaces(replaced_by_automaton(c, [*P.DOMAIN_TERMS, *P.CONFUSIONS, *P.SPLIT_WORDS])))


def urls(c: Column) -> Column:
    """Spaces inside web addresses removed until none is left: a round removes one at least, so white space bounds them."""
    rounds = F.sequence(F.lit(0), F.regexp_count(c, F.lit(r"(?U)\s")))
    start = F.struct(F.lit(None).cast("string").alias("before"), c.alias("text"))
    step = lambda s: F.struct(s["text"].alias("before"), F.regexp_replace(s["text"], f"(?U){P.URL_SPACE}", "$1$2").alias("text"))
    return F.aggregate(rounds, start, lambda s, _: F.when(s["before"].eqNullSafe(s["text"]), s).otherwise(step(s)))["text"]


def diacritics(c: Column) -> Column:
    """Transliteration letters split off their words rejoined: those between two parts of a word, then those after one."""
    word, space, mark = r"([\p{L}\p{N}_])", r"[\s\x0B\x1C-\x1F\x85\p{Z}]", f"([{P.DIACRITICS}])"
    return F.regexp_replace(F.regexp_replace(c, f"{word}{space}+{mark}{space}*{word}", "$1$2$3"), f"{word}{space}+{mark}", "$1$2")


def without_header_tail(c: Column) -> Column:
    """The first running header, in the list's order, that ends the text is removed."""
    out = F.when(F.lit(False), c)
    for phrase in P.RUNNING_HEADERS:
        tail = rf"(?U)\s*{re.escape(phrase)}\s*$"
        out = out.when(c.rlike(tail), F.regexp_replace(F.regexp_replace(c, tail, ""), r"(?U)\s+$", ""))
    return out.otherwise(c)


def without_inline_headers(c: Column) -> Column:
    """The first place between words of each running header is removed."""
    return reduce(lambda a, h: F.regexp_replace(a, rf"(?sU)^(.*?\w)\s+{re.escape(h)}\s+(?=\w)", "$1 "), P.RUNNING_HEADERS, c)


def emphasized(c: Column) -> Column:
    return reduce(lambda a, t: F.regexp_replace(a, rf"(?U)(?<![*])\b({re.escape(t)})\b(?![*])", "*$1*"), P.FOREIGN_TERMS, c)


def corrected(df: DataFrame, name: str = "text", into: str = "corrected") -> DataFrame:
    """Adds the text after all rules of correction: the basic ones, repeated words, split diacritics, web addresses, running
    headers and emphasis. Rules that few texts need are tried only on those that hold one of their words."""
    c = joined_breaks(characters(F.col(name)))
    c = replaced_by_automaton(c, [*P.DOMAIN_TERMS, *P.CONFUSIONS, *P.SPLIT_WORDS])
    df = df.withColumn(into, F.regexp_replace(c, r"(?iU)\b([a-zA-Z]{3,})\s+\1\b", "$1"))
    c = F.col(into)
    df = df.withColumn(into, spaces(F.when(c.rlike(f"[{P.DIACRITICS}]"), diacritics(c)).otherwise(c)))
    df = df.withColumn(into, F.when(c.contains("://"), urls(c)).otherwise(c))
    df = df.withColumn(into, F.when(has_any(c, P.RUNNING_HEADERS), without_inline_headers(without_header_tail(c))).otherwise(c))
    return df.withColumn(into, strip_result(F.when(has_any(c, P.FOREIGN_TERMS), emphasized(c)).otherwise(c)))


def corrected_blocks(df: DataFrame) -> DataFrame:
    """Blocks with corrected texts: where one changed, raw_text keeps the former and was_corrected is true; all others
    have no raw_text and was_corrected is false, whatever it was."""
    out = corrected(df, "text", "_corrected")
    changed = F.col("_corrected") != strip(F.col("text"))
    new = {"raw_text": F.when(changed, F.col("text")), "text": F.when(changed, F.col("_corrected")).otherwise(F.col("text")), "was_corrected": changed}
    return out.withColumns(new).drop("_corrected")


def with_fingerprint(df: DataFrame, name: str = "text", into: str = "fingerprint", chars: int = 120) -> DataFrame:
    """Adds the first code points of the text in compatibility form, with single spaces, in lower case. Spark has no
    such form; texts of ASCII are in it already, and only the others go through Arrow."""

    bounded_batches(df.sparkSession)

    @F.arrow_udf("string")
    def composed(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())

    c = F.col(name)
    whole = F.coalesce(composed(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)
    return df.withColumn(into, F.left(normalized(whole), F.lit(chars)))


def without_fences(c: Column) -> Column:
    """Without the first line if it begins with three backticks, and without three backticks at the end and what
    follows; blanks at the ends go too."""
    head = lambda x: F.when(x.startswith("```") & x.contains("\n"), F.regexp_replace(x, r"(?s)^[^\n]*\n", "")).otherwise(x)
    tail = lambda x: F.when(x.endswith("```"), F.left(x, F.length(x) - 3)).otherwise(x)
    # Each step looks at its text several times: it is named, so that what it comes from is computed once.
    return named(named(strip_result(c), head), lambda x: strip_result(tail(x)))


def half_even(c: Column, digits: int) -> Column:
    """A double rounded to some digits by its exact binary value, as a double: 2.675 is a little less than it seems and
    gives 2.67; only what is a tie exactly, like 2.5 or 0.125, goes to the even digit.

    The value times the power of ten is taken as a sum of two doubles without any error: the product and what its
    rounding lost (by splitting both factors in halves). Where the product looks like a tie the lost part decides.
    """
    power, split = 10.0**digits, 134217729.0
    high = power * split - (power * split - power)
    low = power - high

    def rounded(x: Column) -> Column:
        product = x * power
        x_high = x * split - (x * split - x)
        lost = ((x_high * high - product) + x_high * low + (x - x_high) * high) + (x - x_high) * low
        near = F.rint(product)
        tie = F.abs(product - near) == 0.5
        exact = F.when(tie & (lost > 0), product + 0.5).when(tie & (lost < 0), product - 0.5).otherwise(near)
        return F.when(F.abs(product) < 2.0**52, exact / power).otherwise(x)

    return F.transform(F.array(c.cast("double")), rounded)[0]  # a lambda gives the value a name: it is computed once


def uuid4() -> Column:
    """A random version-4 UUID, another one in each row and each run."""
    return F.uuid()


def uuid5(name: Column, namespace: str = "6ba7b8109dad11d180b400c04fd430c8") -> Column:
    """The version-5 UUID of a name, by default in the DNS namespace."""
    h = F.substring(F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "utf-8"))), 1, 32)
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3)).bitwiseOR(8)))
    third, fourth = F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), third, fourth, F.substring(h, 21, 12))
