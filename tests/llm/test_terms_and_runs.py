"""Source divergence, prefix BPE and periodic runs against plain computations."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leafworks.llm import periodic_runs, prefix_bpe, source_audit
from tests.llm.test_operators import CLASHES, LOWER, TEXTS, VERY_LONG, WORD, by_rows, sentences

PATH = public_tokenizers.path("word_bpe_49k.json")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, (None, "en", "de")[k % 3], (None, "a", "b", "")[k % 4], len(t or "")) for k, (i, t) in enumerate(TEXTS)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return plain.withColumns({c: F.lit("clash") for c in (*CLASHES, "term", "n", "docs", "v", "terms", "all", "runs", "ids")}).persist()


def plain_audit(rows, min_docs=10, top=10):
    """Of (lang, source, text) rows the audit's rows, with whole numbers of any size."""
    n, held, groups = defaultdict(Counter), Counter(), set()
    for lang, source, text in rows:
        g, words = (lang or "", source or ""), TERM.findall((text or "").translate(LOWER))
        groups.add(g)
        n[g].update(words)
        held.update((g[0], w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(w for x, w in held if x == lang and held[x, w] >= min_docs)
        own = {s: n[x, s] for x, s in groups if x == lang}
        whole = sum(own.values(), Counter())

        def share(counts, kept=kept):
            of = sum(counts[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 10**9 * (counts[w] + 2) // of for w in kept}

        apart = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            pairs = [(-sum(apart(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in own if o != s]
            terms = [(-apart(p[s][w], q[w]), w.encode(), w) for w in kept if own[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, x, -v, k + 1) for k, (v, _, x) in enumerate(found)]
    return Counter(out)


AUDIT = ["lang", "source", "part", "item", "value", "rank"]


def test_source_audit(spark, docs, monkeypatch):
    rows = [(r.lang, r.source, r.text) for r in docs.select("lang", "source", "text").collect()]
    for least in (10, 2, 1):
        assert by_rows(source_audit.source_audit(docs, least), *AUDIT) == plain_audit(rows, least)
    assert source_audit.source_audit(docs.where("false")).count() == 0
    r = random.Random(4)
    vocabulary = [w for w in {*sentences(50, 400).split(), "über", "ÜBER", "漢字", "𝔸", "￿", "zz"}]
    rows = [("en" if k % 3 else "de", f"s{r.randrange(6)}\0"[: r.choice([2, 3])], " ".join(r.choice(vocabulary) for _ in range(60))) for k in range(300)]
    rows += [("xx", f"s{k}", "none") for k in range(3)] + [("xx", None, None), (None, "alone", "word " * 9)] + [("en", "hot", "the same words " * 20)] * 200
    df, want = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5), plain_audit(rows)
    assert by_rows(source_audit.source_audit(df), *AUDIT) == want
    # Small chunks, counts handed on early, blocks of two sources, and totals by the salted join.
    for name, v in {"SOURCE_BLOCK": 2, "BROADCAST_SOURCES": 0}.items():
        monkeypatch.setattr(source_audit, name, v)
    assert by_rows(source_audit.source_audit(df, chunk_terms=7), *AUDIT) == want
    assert {x[1] for x in want if x[0] == "xx" and x[2] == "pair" and x[4] == 0} == {"s0", "s1", "s2", ""} and not [x for x in want if x[0] == ""and x[2] == "pair"]


def test_source_audit_hands_counts_on_early(spark):
    text = " ".join(chr(97 + a) + chr(97 + b) + chr(97 + c) for a in range(26) for b in range(26) for c in range(26))
    rows = [("en", f"s{k % 3}", " ".join([text] * 30)) for k in range(12)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(2)
    assert source_audit.term_counts(df.coalesce(1)).count() <= 3 * (26**3 + 1)
    assert by_rows(source_audit.source_audit(df), *AUDIT) == plain_audit(rows)
    long = [("en", f"s{k % 2}", "é" * 1_000_000 + f" other{'x' * (k % 2)}") for k in range(20)]
    assert by_rows(source_audit.source_audit(spark.createDataFrame(long, "lang string, source string, text string")), *AUDIT) == plain_audit(long)


def test_shares_are_exact():
    r = random.Random(6)
    for _ in range(300):
        of = r.randrange(5, 9 * 10**15)
        counts = np.array([r.randrange(of - 2) for _ in range(4)] + [0, of - 2])
        assert source_audit.shares(counts, np.int64(of)).tolist() == [1 + 10**9 * (int(c) + 2) // of for c in counts]


def library_ids(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_prefix_bpe_gives_the_library_s_ids():
    library, own, r = Tokenizer.from_file(PATH), prefix_bpe.encoder(PATH), random.Random(3)
    tokens = [t.replace("</w>", "") for t in library.get_vocab()]
    kinds = [lambda: "".join(r.choice("abcdeinst") for _ in range(r.randint(1, 12))), lambda: "".join(r.choice(tokens) for _ in range(r.randint(1, 4)))]
    kinds += [lambda: "".join(r.choice("ah!.-éß漢字🙂'sΣ́ \x1c\x85<|") for _ in range(r.randint(1, 12))), lambda: "".join(r.choice("ae") * r.randint(1, 6) for _ in range(4))]
    texts = [kinds[k % 4]() for k in range(6000)] + [f"ab{chr(c)}cd {chr(c)}1{chr(c)}" for c in range(1, 0x600)]
    texts += ["a<|endoftext|><|endoftext|>b <|ENDOFTEXT|>", "<|startoftext|>", "it's  I'LL x're"]
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(t) == e.ids, t
        assert own.decode(e.ids) == library.decode(e.ids, skip_special_tokens=False)
    assert own.decode([320, 10**6, 320]) == library.decode([320, 10**6, 320], skip_special_tokens=False)


def test_each_prefix_has_one_last_token():
    """Of the vocabulary's suffixes of each prefix exactly one passes, and it is the last token of the prefix's own encoding."""
    own, r = prefix_bpe.encoder(PATH), random.Random(8)
    for _ in range(200):
        word = "".join(r.choice("aeinstrh") for _ in range(r.randint(1, 14)))
        last = {}
        for at, token in own.automaton.iter(word[:-1] + chr(ord(word[-1]) + prefix_bpe.END)):
            before = at - own.sizes[token]
            if before < 0 or own.compatible(last[before], token):
                assert at not in last
                last[at] = token
        assert sorted(last) == [*range(len(word))] and [last[k] for k in range(len(word))] == own.last_tokens(word) and last[len(word) - 1] == own.word(word)[-1]


def test_prefix_bpe(spark, docs):
    want, own = Counter(), Tokenizer.from_file(PATH)
    for i, t in TEXTS:
        ids = own.encode(t or "", add_special_tokens=False).ids
        back = own.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    assert by_rows(prefix_bpe.round_trip(docs, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    encoded = prefix_bpe.encoded(docs, PATH)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == Counter((i, tuple(library_ids(t or ""))) for i, t in TEXTS)
    texts = Counter((i, own.decode(library_ids(t or ""), skip_special_tokens=False)) for i, t in TEXTS)
    assert by_rows(prefix_bpe.decoded(encoded, PATH), "doc_id", "text") == texts
    assert prefix_bpe.round_trip(docs.where("false"), PATH).count() == 0
    long = spark.createDataFrame([*enumerate(VERY_LONG)], "doc_id long, text string").repartition(3)
    assert {r.doc_id: list(r.ids) for r in prefix_bpe.encoded(long, PATH).collect()} == {k: library_ids(t) for k, t in enumerate(VERY_LONG)}


def plain_runs(x, least=24, periods=3):
    """(start, length, period) of each run, by trying all periods at all places."""
    n, out = len(x), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            size = j - i + q
            smaller = any(all(x[k] == x[k + d] for k in range(i, i + size - d)) for d in range(1, q))
            if j > i and size >= max(least, periods * q) and not smaller:
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(r):
    m = r.choice([1, 2, 2, 3, 5])
    x = [r.randrange(m) for _ in range(r.randint(1, 90))]
    for _ in range(r.randint(0, 3)):
        u, e, at = [r.randrange(m + 1) for _ in range(r.randint(1, 12))], r.randint(2, 8), r.randint(0, len(x))
        x[at:at] = (u * e)[: len(u) * e - r.randrange(len(u))]
    return x


def test_runs(monkeypatch):
    r, n = random.Random(9), 0
    for _ in range(500):
        x = random_words(r)
        want = plain_runs(x)
        n += len(want)
        assert periodic_runs.text_runs([b"%d" % v for v in x]) == want
    assert n > 300
    # Also short runs, and those of two periods: all of the vocabulary is found.
    monkeypatch.setattr(periodic_runs, "MIN_WORDS", 2)
    monkeypatch.setattr(periodic_runs, "MIN_PERIODS", 2)
    for _ in range(500):
        x = random_words(r)
        assert sorted(periodic_runs.runs(np.array(x)), key=lambda r: (r[0], r[2])) == plain_runs(x, 2, 2)
    a, b = [0], [0, 1]  # words of Fibonacci hold the most squares
    while len(b) < 300:
        a, b = b, b + a
    assert sorted(periodic_runs.runs(np.array(b)), key=lambda r: (r[0], r[2])) == plain_runs(b, 2, 2)


def test_long_runs():
    assert periodic_runs.text_runs([b"a"] * 400_000) == [(0, 400_000, 1)]
    assert periodic_runs.text_runs([b"%d" % (k % 7001) for k in range(100_000)]) == [(0, 100_000, 7001)]
    assert periodic_runs.text_runs([b"%d" % (k % 20_000) for k in range(59_999)]) == []
    edge = [b"x", *[b"%d" % (k % 8) for k in range(24)], b"y"]
    assert periodic_runs.text_runs(edge) == [(1, 24, 8)] and periodic_runs.text_runs(edge[2:]) == []


def changed_words(i, text):
    """The words of a text after the query's change, in plain Python."""
    w = WORD.findall(text or "")
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def test_periodic_runs(spark, docs):
    r = random.Random(10)
    rows = TEXTS + [(1000 + k, " \n".join(f"w{v}" for v in random_words(r))) for k in range(150)]
    rows += [(3000 + k, sentences(700 + k, r.choice([1, 3, 50, 120]))) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)
    tail = df.withColumn("text", periodic_runs.repeating_tail(F.col("doc_id")))
    words = {(i, t): changed_words(i, t) for i, t in rows}
    changed = [x for x in rows if words[x] != WORD.findall(x[1] or "")]
    assert len(changed) > 10
    want, texts = Counter(), Counter()
    for i, t in rows:
        w = words[i, t]
        found = plain_runs(w) if len(w) < 10_000 else []
        best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        gone = {k for s, n, p in found for k in range(s + p, s + n)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        own = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want[i, len(found), *top, hashlib.sha256(own.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()] += 1
        texts[i, len(found), kept] += 1
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert by_rows(periodic_runs.run_digests(tail), "doc_id", *names) == want
    assert by_rows(periodic_runs.periodic_runs(tail).select("doc_id", F.size("runs").alias("n"), "collapsed"), "doc_id", "n", "collapsed") == texts
    for f in (periodic_runs.run_digests, periodic_runs.periodic_runs):
        assert f(docs.where("false")).count() == 0
    long = [(0, "ab " * 300_000), (1, " ".join(map(str, range(200_000)))), (2, "x" * 2_000_000), (3, ("one two three\n" * 9 + "four ") * 3000)]
    found = {r.doc_id: r for r in periodic_runs.run_digests(spark.createDataFrame(long, "doc_id long, text string")).collect()}
    assert [(found[k].n_runs, found[k].length, found[k].period) for k in (0, 1, 2)] == [(1, 300_000, 1), (0, None, None), (0, None, None)]
    assert found[3].n_runs == 3001 and (found[3].length, found[3].period) == (28 * 3000, 28)
