"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule is a boolean expression on the text: true rejects. A bounded sample from all over the table tells each
rule's selectivity (share of rows it rejects) and its cost (nanoseconds that it takes on them); the cascade evaluates the rules in the order of rejection per cost, and a row that one rule rejects never reaches the next
(CASE WHEN). The order changes only the work: the verdict is that of all rules together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafworks.llm.shared import BLANK, NON_BLANK, text_or_empty, without_blanks

SAMPLE_ROWS, REPEATS = 1000, 3
WINDOW = 8
#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"


def settled(array: Column) -> Column:
    """The same array, marked so that the optimizer computes it once and in its place.

    An array that a lambda looks into must not be put into that lambda in place of its name, as happens when a
    filter on a later column is pushed down: it would be computed again for each element.
    """
    return F.when(F.monotonically_increasing_id() >= 0, array)


def with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """row (all columns of docs, out of the way of other names), _text (null: empty), _words and _lines (with a word)."""
    out = docs.select(F.struct("*").alias("row"), text_or_empty(text).alias("_text"))
    words = F.array_remove(F.split("_text", f"{BLANK}+"), "")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(NON_BLANK))
    return out.withColumns({"_words": settled(words), "_lines": settled(lines)})


def n_words() -> Column:
    return F.size("_words").cast("long")


def word_chars() -> Column:
    return F.length(without_blanks(F.col("_text"))).cast("long")


def n_symbols() -> Column:
    return F.regexp_count("_text", F.lit(SYMBOLS)).cast("long")


def n_dup_lines() -> Column:
    return (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")


def with_windows(df: DataFrame) -> DataFrame:
    """Adds _windows, the hashes of all windows of eight words, and _sorted, those of texts that repeat one with their places."""
    last = F.size("_words") - (WINDOW - 1)
    hashes = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))
    df = df.withColumn("_windows", settled(F.when(last >= 1, hashes).otherwise(F.array().cast("array<bigint>"))))
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return df.withColumn("_sorted", settled(F.when(repeats, placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))))


def with_repeats(df: DataFrame) -> DataFrame:
    """Adds _repeat_words: the words that lie in a window found twice or more."""
    df = with_windows(df)
    here = F.col("_sorted")
    same = lambda x, k: (F.get(here, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(here, k + 1)["h"].eqNullSafe(x["h"]))
    df = df.withColumn("_at", settled(F.sort_array(F.transform(F.filter(here, same), lambda x: x["i"]))))
    step = F.transform("_at", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_at"), k + 1) - x, F.lit(WINDOW))).cast("long"))
    return df.withColumn("_repeat_words", settled(F.aggregate(step, F.lit(0).cast("long"), lambda a, b: a + b))).drop("_windows", "_sorted", "_at")


def base_failed(words: Column, repeats: Column) -> Column:
    return (words < 20) | (100 * repeats > 30 * words)


def rules() -> dict[str, Column]:
    """The cascade's rules besides the base rules; each needs _text, _words and _lines."""
    words, text = F.size("_words"), F.col("_text")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    stutter = F.size(F.filter("_words", lambda x, i: x.eqNullSafe(F.get(F.col("_words"), i - 1))))
    return {
        "symbols": 10 * n_symbols() > words,
        "shouting": (capitals > 20) & (capitals > F.regexp_count(text, F.lit("[a-z]"))),
        "exclamations": 5 * F.regexp_count(text, F.lit("!")) > words,
        "stutter": 100 * stutter > 30 * words,
        "repeated_lines": 100 * n_dup_lines() > 75 * F.size("_lines"),
        "word_length": (words > 0) & ((word_chars() < 2 * words) | (word_chars() > 20 * words)),
    }


def drawn(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """The texts of some `rows` rows from all over docs, drawn by a hash of their place; four times as many at most."""
    share = rows / max(docs.count(), rows)
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
    return docs.select(F.col(text).alias("text")).where(place < int(share * (1 << 30)) + 1).limit(4 * rows)


def estimates(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Of each rule the share of sampled rows that it rejects, and its mean cost in nanoseconds.

    One job over a drawn sample reads the clock before and after each rule on each row, in the task that evaluates it.
    Words and lines, which rules share, are there before the first reading. Each row is looked at REPEATS times and
    the fastest counts, so neither compilation nor pauses do. Flags and times reach the driver, texts don't.
    """
    clock = lambda: F.expr("reflect('java.lang.System', 'nanoTime')")
    candidates = rules()
    steps = [clock().alias("t0")]
    for k, (name, rejects) in enumerate(candidates.items(), 1):
        steps += [rejects.alias(name), clock().alias(f"t{k}")]
    sample = with_words(drawn(docs, text, rows)).select(F.monotonically_increasing_id().alias("at"), "_text", "_words", "_lines", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))).alias("turn"))
    flags, fastest = {n: {} for n in candidates}, {n: {} for n in candidates}
    spark, setting = docs.sparkSession, "spark.sql.subexpressionElimination.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # else parts that occur twice are computed before the first reading
    try:
        timed = sample.select("at", F.struct(*steps).alias("x")).collect()
    finally:
        spark.conf.set(setting, before)
    for r in timed:
        for k, n in enumerate(candidates, 1):
            flags[n][r.at] = bool(r.x[n])
            fastest[n][r.at] = min(fastest[n].get(r.at, 1 << 62), int(r.x[f"t{k}"]) - int(r.x[f"t{k - 1}"]))
    return {n: ((sum(flags[n].values()) + 0.5) / (len(flags[n]) + 1), (sum(fastest[n].values()) + 1) / (len(flags[n]) + 1)) for n in candidates}


def ordered(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> list[str]:
    """The rules' names, the one with the most rejections per cost first, as a sample tells. Two runs may differ in rules
    that are about as good; the verdict is the same."""
    found = estimates(docs, text, rows)
    return sorted(found, key=lambda n: (-found[n][0] / found[n][1], n))


def cascade(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Column:
    """The name of the first rule that rejects, null where none does; for a frame as from with_words(docs).

    Which rule is named depends on the order that the sample gave; whether one is named doesn't.
    """
    candidates, names = rules(), ordered(docs, text, sample_rows)
    first = F.when(candidates[names[0]], names[0])
    for name in names[1:]:
        first = first.when(candidates[name], name)
    return first


def measured(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with the base measures, base_failed, kept and rejected_by; columns of these names are replaced.

    A null or empty text has no words and fails the base rules. Every row stays, repeated rows too; an empty
    table gives an empty table. A rule's row is rejected by that rule alone or by several; nothing is sampled
    but the order of the rules.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"]
    rest = docs.drop(*names)
    df = with_repeats(with_words(rest, text))
    verdict = cascade(docs, text, sample_rows)
    df = df.withColumns({"n_words": n_words(), "word_chars": word_chars(), "n_symbols": n_symbols(), "n_dup_lines": n_dup_lines(), "n_repeat_words": F.col("_repeat_words")})
    df = df.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    df = df.withColumn("rejected_by", F.when(F.col("base_failed"), "base").otherwise(verdict))
    return df.withColumn("kept", F.col("rejected_by").isNull()).select("row.*", *names)


def accepted(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that no rule rejects, with docs' columns; cheap rules run before the repeated windows."""
    checked = with_words(docs, text).withColumn("_rejected_by", cascade(docs, text, sample_rows))
    checked = with_repeats(checked.where(F.col("_rejected_by").isNull() & (F.size("_words") >= 20)))
    return checked.where(~base_failed(n_words(), F.col("_repeat_words"))).select("row.*")
