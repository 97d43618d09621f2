"""Each operator against a plain computation, over texts with all the awkward cases."""

import array
import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from leafworks.llm import bpe, chat, exact_dedup, line_dedup, near_dedup, packing, quality, token_counts, toxicity, warc

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns whose names the operators use themselves.
CLASHES = ("_text", "_words", "_lines", "_id", "id", "t", "row", "h", "line", "n_tokens", "n_lines", "n_words", "kept", "component", "sha1")


def sentences(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["th", "er", "on", "an", "re", "ed", "ch", "é"]) for _ in range(r.randint(1, 4))) for _ in range(n))


BASE = sentences(1, 120)
NEAR = BASE.replace(BASE.split()[60], "changed", 1)
REPEATED = "This line stands in many of the documents here"
TEXTS = [
    (1, BASE), (2, NEAR), (3, BASE), (4, f" {BASE}\n"), (5, None), (6, ""), (7, " \t\n"), (8, "one two"), (9, "ONE  two"), (10, "x" * 5000),
    (11, sentences(2, 40_000)), (12, f"{REPEATED}\nown\n{REPEATED.upper()}"), (13, f"a\n  {REPEATED}\t"), (14, REPEATED), (None, REPEATED), (None, None),
    (15, "<|endoftext|> it's  I'LL 漢字🙂 Σίσυφος J̌\x1cé\x85 <|startoftext|>"), (16, BASE), (16, BASE), (17, "stop " * 60), (18, sentences(3, 30) + "\r\n\n \n x y  z"),
    (19, "# " * 40), (20, "NO!! YES!! " * 30), (21, "\n".join([sentences(4, 9)] * 9)), (-5, sentences(5, 50)), (-6, sentences(5, 50)), (22, "a  b \n c\n\nd " * 50), (23, "it é ́x a\n b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in TEXTS]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return plain.withColumns({c: F.lit("clash") for c in CLASHES}).persist()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_token_counts(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = Counter((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS)
    found = token_counts.token_counts(docs, path)
    assert by_rows(found, "doc_id", "n_tokens") == want and set(found.columns) == set(docs.columns)
    assert token_counts.token_counts(empty, path).count() == 0
    counter = token_counts.counter(path)
    for c in range(1, 0x600):
        t = f"ab{chr(c)}cd {chr(c)}1{chr(c)}"
        assert counter.count(t) == len(library.encode(t, add_special_tokens=False).ids), hex(c)
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces)
    assert by_rows(token_counts.token_counts(docs, pieces), "doc_id", "n_tokens") == Counter((i, len(model.encode(t)) if t else 0) for i, t in TEXTS)


def test_bpe_round_trip(docs, empty):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    enc = bpe.encoding(path, pattern)
    want = Counter()
    for i, t in TEXTS:
        ids = enc.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert by_rows(bpe.round_trip(docs, path, pattern), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert by_rows(bpe.decoded(bpe.encoded(docs, path, pattern), path, pattern).select("doc_id", F.col("bytes").cast("string").alias("s")), "doc_id", "s") == Counter((i, t or "") for i, t in TEXTS)
    assert bpe.round_trip(empty, path, pattern).count() == 0
    long = "word  two\n\n three " * 20_000
    assert [i for p in bpe.parts(long) for i in enc.encode_ordinary(p)] == enc.encode_ordinary(long) and len([*bpe.parts(long)]) > 3


BLANK_RUNS = [" ", "\n", "\t", "\r\n", "\x0b", "\u3000", "\xa0", "\x85", "\x1c"]


def test_runs_of_white_space_have_the_library_s_ids():
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    json_path, r = public_tokenizers.path("byte_bpe_50k.json"), random.Random(1)
    ids_of, library = packing.token_ids(json_path, public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern), Tokenizer.from_file(json_path)
    words, counter = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), token_counts.counter(public_tokenizers.path("word_bpe_49k.json"))
    for _ in range(200):
        t = "".join(r.choice([r.choice(BLANK_RUNS) * r.choice([1, 2, 999, 1000, 3000]), "ab", "12", "!?", "é", "漢", "'s"]) for _ in range(r.randint(1, 9)))
        assert bpe.encode(t, path, pattern) == bpe.encoding(path, pattern).encode_ordinary(t)
        assert array.array("I", ids_of(t)).tolist() == library.encode(t, add_special_tokens=False).ids
        assert counter.count(t) == len(words.encode(t, add_special_tokens=False).ids)


VERY_LONG = [" " * 2_000_000, "a" + " " * 2_000_000 + "b", "\n" * 2_000_000, "x\t" + "\t" * 2_000_000 + "y", "x" * 2_000_000, "漢" * 700_000]


def test_very_long_texts(spark):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    library, words = Tokenizer.from_file(paths[0]), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    df = spark.createDataFrame([*enumerate(VERY_LONG)], "doc_id long, text string").repartition(3)
    back = {r.doc_id: r.decoded_sha256 for r in bpe.round_trip(df, path, pattern).collect()}
    counted = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, public_tokenizers.path("word_bpe_49k.json")).collect()}
    packed = packing.pack(df, *paths, pattern).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    n = {r.doc_id: r.n for r in packed}
    for k, t in enumerate(VERY_LONG):
        assert back[k] == hashlib.sha256(t.encode()).hexdigest()
        assert counted[k] == len(words.encode(t, add_special_tokens=False).ids)
        assert n[k] == len(library.encode(t, add_special_tokens=False).ids) + 1


def test_line_dedup(docs, empty):
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    holders, rank = defaultdict(list), lambda i: (i is not None, i or 0)
    for i, t in TEXTS:
        for k in {key(x) for x in (t or "").split("\n")}:
            holders[k].append(i)
    want = Counter()
    for i, t in TEXTS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)], key=rank) == i]
        want[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    found = line_dedup.line_dedup(docs)
    assert by_rows(found, "doc_id", "text", "n_lines", "n_dropped") == want
    assert by_rows(found, "_id", "_lines") == Counter({("clash", "clash"): len(TEXTS)})
    assert line_dedup.line_dedup(empty).count() == 0


def test_filters_merge():
    import numpy as np
    import pandas as pd

    keys, bits = [hashlib.md5(bytes([k])).digest() for k in range(100)], 1 << 27
    parts = [keys[:60], keys[40:] + keys[90:]]
    rows = [(s, a, b) for p in parts for s, a, b in line_dedup.segments(p, bits)]
    merged = pd.concat(line_dedup.merged(iter([pd.DataFrame(sorted(rows, key=lambda r: r[0]), columns=["segment", "once", "twice"])])))
    whole = line_dedup.whole_filter(dict(zip(merged["segment"], merged["twice"], strict=True)), bits)
    hit = line_dedup.has(whole, line_dedup.positions(line_dedup.as_pairs(keys), bits))
    assert [k for k in range(100) if hit[k]] == [*range(40, 60), *range(90, 100)]
    assert np.unpackbits(whole).sum() == 30 * line_dedup.PROBES


def test_filters_are_sized_by_the_lines(spark):
    """Hardly any line of one document is suspected, with ten times the lines as with few."""
    for n in (2_000, 200_000):
        lines = F.concat_ws("\n", *(F.concat(F.lit(f"a line of one document {k} "), F.col("id")) for k in range(20)), F.lit("a line that all the documents have"))
        df = spark.range(0, n // 20, 1, 4).select(F.col("id").alias("doc_id"), lines.alias("text"))
        bits = line_dedup.filter_bits(df, "text")
        whole = line_dedup.whole_filter(line_dedup.twice_filter(df, "text", 20, bits), bits)
        keys = [k for k in line_dedup.line_keys("\n".join(f"a line of one document {k} {i}" for k in range(20) for i in range(n // 20)), 20)]
        assert line_dedup.has(whole, line_dedup.positions(line_dedup.as_pairs(keys), bits)).mean() < 0.05
        assert line_dedup.has(whole, line_dedup.positions(line_dedup.as_pairs(line_dedup.line_keys("a line that all the documents have", 20)), bits)).all()


def test_line_dedup_of_a_line_that_most_documents_hold(spark):
    texts = [(k if k % 3 else None, f"a line that most of the documents have\nown line of the document {k}\na pair's line, of two documents {k // 2}") for k in range(3000)]
    found = line_dedup.line_dedup(spark.createDataFrame(texts, "doc_id long, text string").repartition(7))
    want = Counter((i, t if i == 2999 else t.split("\n", 1)[1]) for i, t in texts)
    assert by_rows(found, "doc_id", "text") == want


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def components(texts):
    sets, parent = [(i, shingles(t)) for i, t in texts if i is not None], {i: i for i, _ in texts if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in sets:
        for b, u in sets:
            if s and u and 100 * len(s & u) >= 75 * len(s | u):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def test_near_dedup(docs, empty):
    groups = components(TEXTS)
    want = Counter((i, len(shingles(t)), groups.get(i), i is None or groups[i] == i) for i, t in TEXTS)
    assert by_rows(near_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == want
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_dedup_chains(spark):
    r = random.Random(5)
    texts, at = [], 0
    for g in range(12):
        words = sentences(100 + g, 150).split()
        for _ in range(25):
            texts.append((at, " ".join(words)))
            at += 1
            words = list(words)
            for _ in range(r.choice([1, 2, 4])):
                words[r.randrange(len(words))] = f"w{r.random()}"
    r.shuffle(texts)
    want, df = components(texts), spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert sum(found[i] != want[i] for i in want) == 0


def dense_components(texts):
    """components(), by one product of matrices."""
    import numpy as np

    ids, sets = [i for i, _ in texts], [shingles(t) for _, t in texts]
    number = {x: k for k, x in enumerate(sorted(set().union(*sets)))}
    held = np.zeros((len(sets), len(number)), np.float32)
    for row, s in zip(held, sets, strict=True):
        row[[number[x] for x in s]] = 1
    both, n = held @ held.T, held.sum(axis=1)
    near, group = 100 * both >= 75 * (n[:, None] + n - both), np.array(ids)
    while (low := np.where(near, group, max(ids)).min(axis=1)).tolist() != group.tolist():
        group = low
    return dict(zip(ids, group.tolist(), strict=True))


def test_near_dedup_joins_variants_by_their_original(spark):
    r = random.Random(11)
    original = sentences(400, 200).split()
    texts = [(500, " ".join(original))]
    for k in range(1001):
        words = list(original)
        for at in r.sample(range(8, 192, 8), 5):
            words[at] = f"w{r.random()}"
        texts += [(k, " ".join(words))] if k != 500 else []
    want, df = dense_components(texts), spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert set(want.values()) == {0} and len(set(dense_components(texts[1:]).values())) > 900
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()} == want


def test_near_dedup_on_pages_of_one_template(spark):
    """3,000 pages in pairs: similarity 0.70 and 0.74 between pages, 0.80 and 0.77 within a pair; two such templates."""
    words = lambda tag, n: [f"{tag}w{k}" for k in range(n)]
    similar = lambda x, y: len(x & y) / len(x | y)
    texts, want = [], {}
    for at, template, shared in ((0, 169, 13), (3000, 174, 4)):
        pages = [(k, " ".join(words(f"t{at}", template) + words(f"p{k // 2}", shared) + words(f"u{k}", 204 - template - shared))) for k in range(at, at + 3000)]
        a, b, c = (shingles(pages[k][1]) for k in (0, 1, 2))
        assert 0.69 < similar(a, c) < 0.745 and 0.75 < similar(a, b) < 0.81
        texts, want = texts + pages, want | {k: k // 2 * 2 for k, _ in pages}
    random.Random(1).shuffle(texts)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()} == want


def test_rare_pairs_are_exact(spark):
    import numpy as np

    r = random.Random(12)
    sets = [(k, k, sorted(r.sample(range(40), r.randint(4, 24)))) for k in range(150)]
    for k in range(150, 400):
        v = {*sets[r.randrange(150)][2]}
        sets.append((k, k if k % 10 else 1, sorted(v - {*r.sample(sorted(v), 1)} | {*r.sample(range(5000), r.randint(0, 3))})))
    odd = [near_dedup.parity(np.array(v, np.uint64) << np.uint64(7)).tolist() for _, _, v in sets]
    shape = "node long, component long, v array<long>, " + ", ".join(f"{w} long" for w in near_dedup.PARITY)
    df = spark.createDataFrame([(*s, *w) for s, w in zip(sets, odd, strict=True)], shape)
    pairs = near_dedup.rare_pairs(near_dedup.rare_first(df, 75), df, 75)
    found = {tuple(x) for x in near_dedup.confirmed(pairs, df.select("node", "v"), 75, 5).collect()}
    held = [(k, c, {*v}) for k, c, v in sets]
    want = {(x, y) for x, c, v in held for y, d, w in held if x < y and c != d and 100 * len(v & w) >= 75 * len(v | w)}
    assert found == want and len(want) > 100


def test_near_dedup_of_rows_that_repeat_a_key(spark):
    texts = [(1, sentences(501, 60)), (1, sentences(502, 60)), (2, sentences(501, 60)), (3, sentences(502, 60)), (0, sentences(502, 60) + " more"), (7, ""), (8, sentences(503, 60))]
    texts += [(9, sentences(510 + k, 20)) for k in range(30)]
    found = near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"))
    assert by_rows(found, "doc_id", "component_id") == Counter([(1, 0), (1, 0), (2, 0), (3, 0), (0, 0), (7, 7), (8, 8)] + [(9, 9)] * 30)


def test_long_texts_have_the_same_shingles(monkeypatch):
    text = sentences(9, 3000).encode()
    whole = near_dedup.shingle_sets([text])[0]
    monkeypatch.setattr(near_dedup, "PART_BYTES", 500)
    assert (near_dedup.shingle_sets([b"a b", text, b""])[1] == whole).all() and len(whole) == len(shingles(text.decode()))


def test_packing(docs, empty):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = Tokenizer.from_file(paths[0])
    want = Counter()
    for i, t in TEXTS:
        ids = array.array("I", library.encode(t or "", add_special_tokens=False).ids + [2])
        for k, (start, n) in enumerate(packing.cut(len(ids))):
            want[i, k, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
    found = packing.pack(docs, *paths, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        ends = [0, *(a + n for a, n in sorted(s))]
        assert ends[-1] <= 1024 and [a for a, _ in sorted(s)] == ends[:-1]
    assert len(sequences) <= packing.lower_bound([r.length for r in found], 1024) + 1
    assert packing.pack(empty, *paths, public_tokenizers.PATTERN).count() == 0


def test_islands_improve_on_best_fit(spark):
    r = random.Random(3)
    lengths = [r.choice([257, 263, 301, 342, 410, 511, 340, 129]) for _ in range(900)]
    island = packing.Island(lengths, 1024, 1)
    first = len(island.packings[0])
    island.breed([], 12)
    assert Counter(w for b in island.packings[0] for w in b) == Counter(lengths) and all(sum(b) <= 1024 for b in island.packings[0])
    assert island.bound <= len(island.packings[0]) <= first
    rows = spark.createDataFrame([(k, 0, 0, w, 7, k) for k, w in enumerate(lengths)], packing.PIECES)
    found = packing.packed(rows, island_pieces=200).collect()
    assert sorted(x.doc_id for x in found) == [*range(900)] and len({x.sequence_id for x in found}) <= island.bound * 1.05 + 5


def test_islands_hold_as_many_pieces(spark):
    """Short and whole pieces by turns, over partitions that all begin at a multiple of the number of islands."""
    rows = spark.range(0, 64 * 100, 1, 64).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "IF(id % 2 = 0, 300L, 1024L) AS length", "0L AS ids_crc32", "(id DIV 100 << 33) + id % 100 DIV 2 AS deal")
    found = packing.packed(rows, island_pieces=200, generations=1)
    whole, short = found.where("length = 1024"), found.where("length < 1024")
    assert whole.count() == whole.select("sequence_id").distinct().count() == 3200 and whole.where("sequence_id >= 0").count() == 0
    islands = [r["count"] for r in short.groupBy(F.shiftright("sequence_id", 32)).count().collect()]
    assert sum(islands) == 3200 and len(islands) == 16 and max(islands) < 300 and min(islands) > 100


def test_packing_encodes_common_texts_whole(monkeypatch):
    seen, encode, r = [], packing.encode, random.Random(4)
    monkeypatch.setattr(packing, "encode", lambda t, *a: seen.append(t) or encode(t, *a))
    json_path = public_tokenizers.path("byte_bpe_50k.json")
    ids_of, library = packing.TokenIds(json_path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), Tokenizer.from_file(json_path)
    same = lambda t: array.array("I", ids_of(t)).tolist() == library.encode(t, add_special_tokens=False).ids
    assert same(" ".join(f"w\u00f6rd{k}," for k in range(1000))) and len(seen) == 1
    assert same(" ".join(f"word{k}" for k in range(1000)) + " \u201cquoted\u201d " + " ".join(f"word{k}" for k in range(1000))) and len(seen) <= 3
    atoms = [" ", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "\u180e", "\u200b", "\u3000", "ab", "x1", "!?", "'s", "\u2014", "\u201cq\u201d", "\u00e9", "\u0301", "\u052f", "\u0530", "\u6f22", "\u0939\u093f", "\U0001f600"]
    for _ in range(500):
        assert same("".join(r.choice(atoms) for _ in range(r.randint(1, 30))))


def test_islands_are_bred_in_several_tasks(spark, monkeypatch):
    """Rows of a few bytes aren't merged into one task: an island is long work. 40 islands of 50 pieces, 4 shuffle partitions."""
    rows = spark.range(0, 2000, 1, 4).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "300 + id % 7 AS length", "0L AS ids_crc32", "id AS deal")
    wrote, written = [], packing.written
    monkeypatch.setattr(packing, "written", lambda df: wrote.append(written(df)) or wrote[-1])
    assert packing.packed(rows, island_pieces=50, generations=1).count() == 2000
    assert len(wrote[0].inputFiles()) > 4


def test_exact_dedup(docs, empty):
    groups, strip = defaultdict(list), lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for i, t in TEXTS:
        groups[strip(t)].append((-len(t or ""), i is None, i))
    want = Counter()
    for i, t in TEXTS:
        g = groups[strip(t)]
        keep = min(g, key=lambda x: (x[0], x[1], x[2] or 0))[2]
        want[i, keep, len(g), i == keep, hashlib.sha256(strip(t).encode()).hexdigest()] += 1
    found = exact_dedup.exact_dedup(docs, capacity=20_000)
    assert by_rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_directory_splits():
    loads = {k: 10 for k in range(0, 1 << 16, 64)}
    found = exact_dedup.split(loads, 300, 16)
    sums = Counter()
    for s, bucket in found.items():
        assert s >> (16 - bucket[1]) == bucket[0]
        sums[bucket] += loads[s]
    assert found.keys() == loads.keys() and max(sums.values()) <= 300 and len(sums) > 1


def test_exact_dedup_of_hot_copies(spark):
    df = spark.range(0, 400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    for capacity in (1, 100, exact_dedup.BUCKET_BYTES):
        found = exact_dedup.exact_dedup(df, capacity=capacity).where("group_size > 1").collect()
        assert len(found) == 134 and {(r.keep_id, r.group_size) for r in found} == {(0, 134)} and sum(r.kept for r in found) == 1


def test_owners_get_a_range_of_hashes(spark):
    """Owners hold ranges of about a bucket each; the one bucket that copies of a long text fill is dealt over many."""
    long = F.when(F.col("id") < 99, F.repeat(F.lit("x"), 50_000)).otherwise(F.repeat(F.concat(F.lit("y"), F.col("id")), 100))
    df = spark.range(0, 3000, 1, 7).select(F.col("id").alias("doc_id"), long.alias("text"))
    rows = exact_dedup.normalised(df, "doc_id", "text")
    slots, depth, owners = exact_dedup.directory(exact_dedup.index(rows), 100_000)
    total = 99 * 50_000 + sum(100 * len(f"y{k}") for k in range(99, 3000))
    assert total / 100_000 <= owners <= 4 * total / 100_000 and 4 <= depth <= 20
    listed = slots.orderBy("slot").collect()
    assert [r.owner for r in listed] == sorted(r.owner for r in listed) and max(r.owner + r.shares for r in listed) == owners
    assert sorted({r.shares for r in listed})[0] == 1 and max(r.shares for r in listed) >= 49
    # The directory's ranges decide which task compares which chain.
    of_slot = {r.slot: range(r.owner, r.owner + r.shares) for r in listed}
    found = exact_dedup.owned(rows, slots, depth, owners).select("owner", F.spark_partition_id().alias("task"), "h", F.octet_length("norm").alias("n")).collect()
    assert len(found) == 3000 and all(r.owner == r.task and r.owner in of_slot[(r.h % 2**64) >> (64 - depth)] for r in found)
    sums = Counter()
    for r in found:
        sums[r.owner] += r.n
    assert max(sums.values()) <= 600_000 and sum(r.n == 50_000 for r in found) == 99


@pytest.mark.parametrize("capacity", [100, 1 << 25])
def test_texts_of_one_hash_are_told_apart_by_their_bytes(spark, capacity):
    """All texts in one chain, and texts of two hashes: by one owner, and dealt over many."""
    texts = [(k, ("same text", "another", f"own {k}", None)[k % 4]) for k in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    want = by_rows(exact_dedup.exact_dedup(df), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    for forced in (lambda c: F.lit(7), lambda c: F.when(F.col(c) == "another", -5).otherwise(7)):
        found = exact_dedup.exact_dedup(df, capacity=capacity, hashed=forced)
        assert by_rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    assert sorted(n for _, _, n, _, _ in want.elements()) == [1] * 50 + [50] * 150


def test_texts_move_to_their_owners_alone(spark):
    """Nothing groups texts before the exchange by owner, which is the only one that holds them; no Python runs."""
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 7).alias("text"))
    plan = exact_dedup.exact_dedup(df, capacity=10)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    steps = [x for x in plan.split("\n") if "Exchange" in x or "Aggregate" in x or "Python" in x or "Arrow" in x]
    first = next(k for k, x in enumerate(steps) if "REPARTITION_BY_NUM" in x)  # from the top down: what follows comes before it
    assert not any("norm" in x for x in steps[first + 1 :]) and not any("Python" in x or "Arrow" in x for x in steps)
    assert [("norm" in x, "Exchange" in x) for x in steps[:first] if "norm" in x] == [(True, False)] * 2


def base_measures(t):
    w = WORD.findall(t or "")
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    many, covered = Counter(windows), set()
    for k, x in enumerate(windows):
        if many[x] > 1:
            covered |= {*range(k, k + 8)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, empty):
    found = quality.measured(docs)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = Counter()
    for i, t in TEXTS:
        m = base_measures(t)
        want[i, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]] += 1
    assert by_rows(found, *names) == want
    kept = Counter(r.doc_id for r in found.where("kept").collect())
    assert kept == Counter(r.doc_id for r in quality.accepted(docs).collect())
    assert {1, 2, 3, 4, 11, 16, -5, -6} <= kept.keys() and not {5, 6, 17, 19, 20, 21} & kept.keys()
    assert quality.accepted(docs).columns == docs.columns and quality.accepted(empty).count() == quality.measured(empty).count() == 0


def test_rules_are_ordered_by_what_a_sample_from_all_over_tells(spark):
    """Only rows of the last partition break a rule; rules that go through more cost more."""
    text = F.when(F.col("id") >= 1500, F.repeat(F.lit("# word "), 40)).otherwise(F.repeat(F.lit("some words of a text "), 40))
    df = spark.range(0, 2000, 1, 8).select(F.col("id").alias("doc_id"), text.alias("text"))
    assert 100 < quality.drawn(df, "text", 200).count() < 300 and quality.drawn(df, "text", 5000).count() == 2000
    found = quality.estimates(df, rows=400)
    assert found.keys() == quality.rules().keys() and 0.15 < found["symbols"][0] < 0.35 and found["shouting"][0] < 0.01
    assert all(100 < cost < 10**8 for _, cost in found.values())
    assert quality.ordered(df)[0] == "symbols" and spark.conf.get("spark.sql.subexpressionElimination.enabled") == "true"


def test_chat(spark):
    turns = [(1, 0, "user", "a <|text|> b"), (1, 1, "assistant", "<\\|end|> é🙂 <|"), (1, 2, "assistant", None), (1, None, "system", "s"), (2, 0, None, "<|turn|>x\n"), (None, 3, "assistant", "n"), (None, 1, "user", ""), (3, 5, "assistant", "z" * 100_000), (3, 5, "assistant", "z" * 100_000), (4, 0, "as<|sistant", "<<<|||\\")]
    turns += [(9, k, "assistant" if k % 2 else "user", f"turn {k} <|") for k in range(1500)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")).repartition(5)
    want, groups = {}, defaultdict(list)
    for c, turn, role, text in turns:
        groups[c].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    for c, g in groups.items():
        g = [(x[3], x[5]) for x in sorted(g)]
        loss = "".join(t for r, t in g if r == "assistant")
        want[c] = len(g), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in g).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
    chats = chat.format_chats(df)
    found = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chats).collect()}
    assert found == want and chats.count() == len(want)
    assert chat.format_chats(df.where("false")).count() == 0


def test_warc(spark):
    pages = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\r\n: %41", None), (4, "v", ""), (5, "w", "é\r\n\r\nWARC/1.1\r\n"), (6, "w", "<p>x</p>"), (None, "n", "<p>x</p>"), (7, "z", "y" * 300_000), (5, "w", "é\r\n\r\nWARC/1.1\r\n"), (8, "q", "only")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"sha1": F.lit("clash"), "first": F.lit(1)}).repartition(3)
    manifest = warc.write_archives(df)
    first = {}
    for i, _, h in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(h or "", i)
    want = Counter()
    for i, _, h in pages:
        b = (h or "").encode()
        response = first[h or ""] == i
        want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if response else "revisit", None if response else first[h or ""]] += 1
    records = warc.read_archives(manifest)
    assert by_rows(warc.with_originals(records), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == want
    assert {(r.page_id, r.uri) for r in records.collect()} == {(i, u) for i, u, _ in pages}
    small = warc.with_originals(warc.read_archives(warc.write_archives(df, min_bytes=9)))
    assert small.where("record_type = 'revisit'").count() == 0
    assert warc.with_originals(warc.read_archives(warc.write_archives(df.where("false")))).count() == 0


def toxic_table(spark):
    r = random.Random(7)
    rows = []
    for k in range(600):
        bad = k % 5 == 0
        words = sentences(1000 + k, 30).split()
        if bad:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["vile", "filthy", "vileness,", "Filthiest"]))
        rows.append((k, " ".join(words), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity(spark, docs, empty):
    table = toxic_table(spark)
    labels = table.where("doc_id % 2 = 0").select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (2, None), (99999, 1)], "doc_id long, toxic int"))
    trained = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    found = {r.doc_id: r for r in toxicity.scores(table.withColumn("score", F.lit("clash")), labels, trained).collect()}
    wrong = [r.doc_id for r in table.collect() if (found[r.doc_id].score >= 0.5) != bool(r.toxic)]
    assert len(wrong) <= 6 and all(0 <= r.score <= 1 and len(r.evidence) <= toxicity.NEIGHBOURS for r in found.values())
    odd = toxicity.scores(docs, labels, trained).collect()
    assert Counter(r.doc_id for r in odd) == Counter(i for i, _ in TEXTS)
    assert toxicity.scores(empty, labels, trained).count() == 0
    assert {r.score for r in toxicity.scores(docs, labels.where("false"), trained).collect()} == {0.0}


def test_nearest_examples_are_exact(spark):
    import numpy as np

    r = random.Random(2)
    rows = [(k, k, k % 2, f, [r.randint(1, 3) for _ in f]) for k in range(700) for f in [sorted(r.sample(range(60), r.randint(0, 8)))]]
    rows += [(700 + k, k, k % 2, rows[k][3], rows[k][4]) for k in range(0, 700, 7)]
    idf = np.array([1 + r.random() for _ in range(60)])
    index = toxicity.Index(rows, idf)
    dense = np.zeros((len(rows), 60))
    for at, (_, _, _, f, n) in enumerate(rows):
        dense[at, f] = index.weights(f, n) if f else 0
    for _ in range(60):
        f = sorted(r.sample(range(60), r.randint(1, 7)))
        w = index.weights(f, [r.randint(1, 4) for _ in f])
        sims = np.sort((dense[:, f] @ w).round(12))[::-1]
        sims = sims[(sims > 0) & (sims >= sims[toxicity.NEIGHBOURS - 1])]
        got = [s for s, _, n in index.nearest(f, w) for _ in range(n)]
        assert np.allclose(got, sims, atol=1e-9)
        assert [s for _, s, _ in index.evidence(index.nearest(f, w))] == got[: toxicity.NEIGHBOURS]


def plain_scores(texts, labels):
    """Scores by dense vectors and plain loops: texts of all rows, labels {text: toxic} of the examples, one a text."""
    import math

    def counts(text):
        out = Counter()
        for word in (text or "").lower().split():
            if word := word.strip(toxicity.EDGES):
                out.update([word, *(word[:n] + "~" for n in (3, 4, 5, 6) if len(word) > n)])
        return out

    held = {t: counts(t) for t in {*texts, *labels}}
    bad, good = sum(labels.values()) + 1.0, len(labels) - sum(labels.values()) + 1.0
    in_bad, in_all = Counter(f for t, y in labels.items() if y for f in held[t]), Counter(f for t in labels for f in held[t])
    scored = []
    for f, n in in_all.items():
        p, q = (in_bad[f] + 0.5) / bad, (n - in_bad[f] + 0.5) / good
        if n >= 5 and abs(math.log(p / q)) >= math.log(toxicity.MIN_RATIO):
            scored.append((-abs(p - q) * abs(math.log(p / q)), f))
    kept = [f for _, f in sorted(scored)[: toxicity.MAX_FEATURES]]
    df = Counter(f for t in texts for f in held[t])
    idf = {f: math.log((1 + len(texts)) / (1 + df[f])) + 1 for f in kept}

    def vector(t):
        v = {f: (1 + math.log(held[t][f])) * idf[f] for f in kept if f in held[t]}
        return {f: x / math.sqrt(sum(y * y for y in v.values())) for f, x in v.items()}

    vectors = {t: vector(t) for t in held}
    blank = [y for t, y in labels.items() if not vectors[t]]
    prior = (sum(blank) + 0.5) / (len(blank) + 10)

    def vote(t, without=None):
        sims = sorted(((round(sum(x * vectors[e].get(f, 0) for f, x in vectors[t].items()), 12), y) for e, y in labels.items() if e != without), reverse=True)
        sims = [x for x in sims if x[0] > 0 and x[0] >= sims[min(14, len(sims) - 1)][0]]
        return (sum(s * s * y for s, y in sims) + 0.2 * prior) / (sum(s * s for s, _ in sims) + 0.2) if sims else prior

    votes = sorted((vote(e, e), y) for e, y in labels.items() if vectors[e])
    mean = lambda a, b: sum(y for _, y in votes[a : b + 1]) / (b + 1 - a)
    fit = [max(min(mean(a, b) for b in range(i, len(votes))) for a in range(i + 1)) for i in range(len(votes))]
    pools = {}
    for f, (v, y) in zip(fit, votes, strict=True):
        pools.setdefault(round(f, 12), []).append((v, y))
    x = [sum(v for v, _ in p) / len(p) for p in pools.values()]
    rates = [(sum(y for _, y in p) + 0.5 * prior) / (len(p) + 0.5) for p in pools.values()]
    rates = [max(rates[: k + 1]) for k in range(len(rates))]
    import numpy as np

    return [float(np.interp(vote(t), [0.0, *x, 1.0], [rates[0], *rates, rates[-1]])) if vectors[t] else prior for t in texts]


def training(i):
    return zlib.crc32(str(i).encode()) % 5 != 0


def test_toxicity_scores_against_dense_vectors(spark):
    rows = [(r.doc_id, r.text, r.toxic) for r in toxic_table(spark).where("doc_id < 260").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = {t: y for i, t, y in rows if i % 2 == 0 and training(i)}
    found = {r.doc_id: r.score for r in toxicity.scores(df, df.where("doc_id % 2 = 0").select("doc_id", "toxic"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).collect()}
    want = plain_scores([t for _, t, _ in rows], labels)
    assert [round(found[i], 9) for i, _, _ in rows] == [round(x, 9) for x in want]
    # Equal examples under other keys give the same scores.
    moved = df.withColumn("doc_id", F.lit(10_000) - F.col("doc_id"))
    again = {10_000 - r.doc_id: r.score for r in toxicity.scores(moved, moved.where("doc_id % 2 = 0").select("doc_id", "toxic"), F.crc32((10_000 - F.col("doc_id")).cast("string").cast("binary")) % 5 != 0).collect()}
    assert again == found


def plain_rules(t):
    """Whether a quality rule rejects a text."""
    n, chars, symbols, dup_lines, repeats = base_measures(t)
    t, words = t or "", WORD.findall(t or "")
    lines = [x for x in t.split("\n") if WORD.search(x)]
    upper, lower = len(re.findall("[A-Z]", t)), len(re.findall("[a-z]", t))
    return any([
        n < 20 or 100 * repeats > 30 * n, 10 * symbols > n, upper > 20 and upper > lower, 5 * t.count("!") > n,
        100 * sum(a == b for a, b in zip(words, words[1:])) > 30 * n, 100 * dup_lines > 75 * len(lines), n > 0 and not 2 * n <= chars <= 20 * n,
    ])


def test_pipeline_stages_against_plain_computations(spark, tmp_path):
    toxic = [(r.doc_id, r.text, r.toxic) for r in toxic_table(spark).where("doc_id < 200").collect()]
    rows = [(i, t) for i, t, _ in toxic] + [(i if i is None else i + 1000, t) for i, t in TEXTS if len(t or "") < 9000]
    rows += [(2000 + k, f"{REPEATED} and in this one\n{sentences(600 + k, 40)}") for k in range(6)] + [(2100 + k, sentences(610, 80) + f" w{k}") for k in range(4)]
    labels = [(i, y) for i, _, y in toxic if i % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    columns, functions = frame.columns, dict(corpus_pipeline.STAGES)

    def ran(name):
        functions[name](spark, frame, str(tmp_path)).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    def check(name, want):
        out = ran(name)
        assert out.columns == columns and by_rows(out, "doc_id", "text", "n_chars") == want
        return out

    as_rows = lambda rs: Counter((i, t, len(t or "")) for i, t in rs)
    scores = plain_scores([t for _, t in rows], {t: y for i, t, y in toxic if i % 2 == 0 and training(i)})
    gone = {i for (i, _), s in zip(rows, scores, strict=True) if s >= 0.5}
    assert 20 <= len(gone) <= 60
    rows = [x for x in rows if x[0] not in gone]
    frame = check("toxicity", as_rows(rows))
    rows = [x for x in rows if not plain_rules(x[1])]
    frame = check("quality_rules", as_rows(rows))
    key, holders = (lambda line: line.strip(BLANKS).translate(LOWER)), defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in t.split("\n")}:
            holders[k].append(i)
    before = rows
    rows = [(i, "\n".join(x for x in t.split("\n") if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)], key=lambda j: (j is not None, j or 0)) == i)) for i, t in rows]
    assert rows != before
    frame = check("line_dedup", as_rows(rows))
    groups = components(rows)
    rows = [(i, t) for i, t in rows if i is None or groups[i] == i]
    frame = check("near_dedup", as_rows(rows))
    library, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for i, t in rows:
        ids = array.array("I", library.encode(t, add_special_tokens=False).ids + [2])
        for k, (start, n) in enumerate(packing.cut(len(ids))):
            want[i, k, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
    out = ran("packing")
    assert by_rows(out, "doc_id", "piece", "start", "length", "ids_crc32") == want
    places = defaultdict(list)
    for r in out.collect():
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        ends = [0, *(a + n for a, n in sorted(x))]
        assert ends[-1] <= 1024 and [a for a, _ in sorted(x)] == ends[:-1]


def test_pipeline(spark, docs, empty, tmp_path):
    table = toxic_table(spark)
    table.select("doc_id", "toxic").write.parquet(str(tmp_path / "labels.parquet"))
    for frame in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            before = frame
            frame = stage(spark, frame, str(tmp_path))
            if name != "packing":
                assert frame.columns == before.columns
            frame.write.parquet(str(tmp_path / f"{name}-{before is docs}-{id(before)}"))
            frame = spark.read.parquet(str(tmp_path / f"{name}-{before is docs}-{id(before)}"))
    table.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars")).write.parquet(str(tmp_path / "documents.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    clean = {r.doc_id for r in table.where("toxic = 0").collect()}
    assert len(clean ^ {r.doc_id for r in packed.collect()}) <= 6


@pytest.mark.parametrize("most", [0, 100_000])
def test_rows_without_keys_of_a_list(spark, monkeypatch, most):
    """Equal to an anti-join, by filters and by the keys themselves."""
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", most)
    rows = spark.range(0, 20_000, 1, 5).select(F.when(F.col("id") % 97 > 0, F.col("id")).alias("doc_id"), F.lit("clash").alias("_a"), F.lit("clash").alias("a"))
    a, b = F.xxhash64("doc_id"), F.xxhash64("doc_id", F.lit(1))
    for ids in ("doc_id % 3 = 0", "doc_id IS NULL", "false", "true"):
        gone = rows.where(ids).select(a.alias("a"), b.alias("b")).distinct()
        found = line_dedup.without_keys(rows, gone, a, b)
        assert found.columns == rows.columns and by_rows(found, "doc_id") == by_rows(rows.where(f"NOT coalesce({ids}, false)"), "doc_id")


def test_by_chance_named_rows_stay(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MIN_BITS", 1 << 21)
    monkeypatch.setattr(line_dedup, "BITS_PER_LINE", 1)
    rows = spark.range(0, 4_000_000, 1, 4).select(F.col("id").alias("doc_id"))
    a, b = F.xxhash64("doc_id"), F.xxhash64("doc_id", F.lit(1))
    gone = rows.where("doc_id % 2 = 0").select(a.alias("a"), b.alias("b"))
    one = line_dedup.named_by(rows, *line_dedup.member_filter(gone))(a, b)
    assert rows.where(one).count() > 2_500_000  # so half a million by chance, at least
    found = line_dedup.without_keys(rows, gone, a, b)
    assert found.count() == 2_000_000 and found.where("doc_id % 2 = 0").isEmpty()


def test_scratch_of_a_stage_goes(spark):
    from pathlib import Path

    from leafworks.llm import shared

    out, first = None, shared.written(spark.range(3).toDF("x"))
    held = set(shared._written)
    with shared.scratch_of(lambda: out):
        inner = shared.written(spark.range(5).toDF("x"))
        shared.written(spark.range(7).toDF("x"))
        out = shared.written(inner.where("x > 2"))
    paths = {k: Path(p.removeprefix("file://")) for k, (_, p) in shared._written.items()}
    assert len(set(paths) - held) == 1 and out.count() == 2 and first.count() == 3 and all(p.is_dir() for p in paths.values())
    path = paths[max(paths)]
    shared.discard(out)
    assert not path.exists()


LONG = [" ".join(f"w{k % 5000}" for k in range(300_000)), "x" * 2_000_000, "a line that comes again and again\n" * 60_000, "\n" * 2_000_000, " \t" * 1_000_000, "漢字 " * 700_000]


def test_texts_of_two_megabytes(spark, tmp_path):
    """Whole texts through line dedup, near dedup, exact dedup, quality rules, chats, toxicity, archives and the pipeline."""
    texts = [*enumerate([*LONG, LONG[2], LONG[0] + " more"])]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    key, holders = (lambda x: x.strip(BLANKS).translate(LOWER)), defaultdict(set)
    for i, t in texts:
        for k in {key(x) for x in t.split("\n")}:
            holders[k].add(i)
    lines = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(df, min_docs=2).collect()}
    for i, t in texts:
        rows = t.split("\n")
        kept = [x for x in rows if len(key(x)) < 20 or len(holders[key(x)]) < 2 or max(holders[key(x)]) == i]
        assert lines[i] == ("\n".join(kept), len(rows), len(rows) - len(kept))
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    sets = {i: shingles(t) for i, t in texts}
    assert {i: n for i, (n, _) in near.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: c for i, (_, c) in near.items()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 2, 7: 0}
    exact = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.exact_dedup(df).collect()}
    for i, t in texts:
        assert exact[i] == (2 if i in (2, 6) else 3 if i in (3, 4) else i, 2 if i in (2, 3, 4, 6) else 1, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).hexdigest())
    rules = {r.doc_id: (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) for r in quality.measured(df).collect()}
    assert rules == {i: (m[0], m[1], m[3], m[4]) for i, t in texts for m in [base_measures(t)]}
    turns = spark.createDataFrame([(i, k, r, t) for i, t in texts for k, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    chats = {r.conv_id: (r.n_turns, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_chats(turns)).collect()}
    assert chats == {i: (2, len(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts}
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, toxic int")
    assert {r.doc_id for r in toxicity.scores(df, labels, F.lit(True)).collect() if 0 <= r.score <= 1} == {i for i, _ in texts}
    pages = warc.with_originals(warc.read_archives(warc.write_archives(df.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html")))))
    first = {}
    for i, t in texts:
        first.setdefault(t, i)
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in pages.collect()} == {(i, len(t.encode()), digest(t), None if first[t] == i else first[t]) for i, t in texts}
    labels.withColumn("toxic", F.lit(0)).write.parquet(str(tmp_path / "labels.parquet"))
    df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars")).write.parquet(str(tmp_path / "documents.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    kept = [i for i, t in texts if not plain_rules(t)]
    assert {r.doc_id: r.n for r in packed} == {i: len(library.encode(texts[i][1], add_special_tokens=False).ids) + 1 for i in kept if near[i][1] == i}
