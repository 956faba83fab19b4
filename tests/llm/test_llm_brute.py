"""Operators against plain Python on small inputs, with nulls, ties, repeated rows, clashing names and empty tables."""

import datetime
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from driftloom.llm import (
    bktree, decontamination, embedding_cells, language, licences, mixing, pseudonyms, repeats, simhash, simple8b, substrings, suffix_arrays, token_output,
)
from driftloom.llm.common import table
from driftloom.llm.components import components
from driftloom.llm.queries import QUERIES, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string"
WORDS = "aa bb cc dd ee ff gg hh ii jj kk ll".split()


def texts(seed, n, longest=90):
    rng = random.Random(seed)
    out = [" ".join(rng.choices(WORDS, k=rng.randint(0, longest))) for _ in range(n)]
    passage = " ".join(rng.choices(WORDS, k=60))
    out += [f"{a} {passage}  {b}" for a, b in zip(out[:4], out[4:8])] + out[:3]
    return [*out, None, "", " \t\n", "!!", "ein\x0bwort"]


def frame(spark, values, schema=DOCS):
    return spark.createDataFrame([(i, t, "en" if i % 2 else "de", f"s{i % 3}") for i, t in enumerate(values)], schema)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, texts(1, 30))


def clashing(df):
    """The frame with nulls in every other column and with names that operators use inside."""
    return df.withColumns({c: F.lit(None).cast("string") for c in ("contamination", "language", "n_replaced", "tie", "id", "bits", "node", "line", "ids", "start")})


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 59, 4095, 4096, 4097, 40_000):
        bits = rng.integers(0, 64, n, dtype=np.uint64)
        values = rng.integers(0, 1 << 63, n, dtype=np.uint64) >> bits
        values[rng.random(n) < 0.3] = 0
        if n:
            values[0] = np.uint64((1 << 64) - 1)
        assert (simple8b.decode(*simple8b.encode(values), n) == values).all()
    data = simple8b.pack_file(np.array([5]), np.array([0]), np.array([3]), np.array([1, 2, 1 << 61], np.uint64))
    assert simple8b.unpack_file(data)[3].tolist() == [1, 2, 1 << 61]
    with pytest.raises(ValueError):
        simple8b.unpack_file(data[:-1] + b"x")


def expected_tokens(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_output_matches_whole_texts(spark):
    odd = ["Don't STOP, it's 12.5%!", "A<|endoftext|>b", "été, Éa. «x», y.,z", "　wide blank\x1c!", None, "", "x" * 9000, "a,b. c.,", "中文字 かな, İı ΑΣ."]
    values = [*odd, *[r["text"] for r in table(spark, SMALL, "documents").limit(40).collect()], "Same.", "Same."]
    rows = [(None if i == 3 else i, t) for i, t in enumerate(values)]
    df = clashing(spark.createDataFrame([(d, t) for d, t in rows], "doc_id long, text string"))
    got = [tuple(r) for r in token_output.token_digests(df, tokenizer_path()).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected_tokens(rows)


def test_other_vocabularies_are_encoded_whole(spark, docs):
    path = tokenizer_path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    want = {r["doc_id"]: len(whole.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in token_output.token_digests(docs, path).collect()}
    assert got == want


def test_token_folders_have_a_scheme(spark):
    assert token_output.shared_folder(spark, "/tmp/x/").startswith("file:///tmp/x")
    assert token_output.shared_folder(spark, "file:/tmp/x") == "file:///tmp/x"


def test_token_output_small_files_and_empty(spark, docs):
    manifest = token_output.write_token_files(docs, tokenizer_path(), ids_per_file=40)
    assert manifest.count() > 8
    rows = token_output.read_token_files(manifest).orderBy("start").select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()
    assert [tuple(r) for r in rows] == expected_tokens([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert token_output.token_digests(docs.limit(0), tokenizer_path()).count() == 0


def benchmark_rows(docs, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    out = {}
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, body in items:
            v = words(body)
            k = min(window, len(v))
            if not k:
                continue
            for i in range(len(v) - k + 1):
                for j in range(len(w) - k + 1):
                    if w[j : j + k] == v[i : i + k]:
                        hit |= set(range(j, j + k))
                        found |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_decontamination(spark, docs, block_bytes):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(900, "AA-bb,CC é1 tail"), (901, "é1 aa")]
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 20)))) for i in range(3)]
    items += [(10, rows[1][1]), (11, rows[1][1][:60]), (12, "bb cc É1"), (13, "é1"), (None, "aa"), (14, None), (15, "..")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    marked, name = decontamination.find_contamination(df, bench, block_bytes=block_bytes)
    assert name == "contamination_"
    want = benchmark_rows(rows, items)
    for r in marked.collect():
        f = r[name]
        n_words, n_hit, n_items, digest, _ = want[r["doc_id"]]
        assert (f["n_words"], f["n_hit"], len(f["items"])) == (n_words, n_hit, n_items)
        assert hashlib.sha256(",".join(f["items"]).encode()).hexdigest() == digest
        spoken = [r["text"][s["start"] : s["stop"]] for s in f["spans"]]
        assert sum(len(benchmark_words(x)) for x in spoken) == n_hit
    report = {r["doc_id"]: tuple(r)[1:] for r in decontamination.contamination_report(df, bench).collect()}
    assert report == want
    kept = decontamination.without_contaminated(df, bench)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {d for d, w in want.items() if not w[4]}
    assert decontamination.contamination_report(df, bench.limit(0)).filter("contaminated").count() == 0
    assert decontamination.contamination_report(df.limit(0), bench).count() == 0


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def test_language(spark):
    docs = table(spark, SMALL, "documents")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "123 !!"), (9004, "the"), (9004, "the"), (None, "и")], "doc_id long, text string")
    both = docs.unionByName(odd, allowMissingColumns=True)
    rows = language.language_report(clashing(both)).collect()
    assert len(rows) == both.count()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (9001, 9002, 9003))
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert language.with_known_language(both).columns == both.columns
    blank = language.language_report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in blank} == {("und", 0.0)}
    assert language.language_report(docs.limit(0)).count() == 0


def test_kernel_is_the_presence_kernel():
    import pyarrow as pa

    grams = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    a, b = "the cat", "that hat"
    coded = [np.unique(language.gram_codes(np.frombuffer(t.encode().translate(language._CODES), np.uint8))) for t in (a, b)]
    assert len(np.intersect1d(*coded)) == len(grams(a) & grams(b))
    every = np.unique(np.concatenate(coded))
    place = np.full(language.GRAMS, len(every), np.int32)
    place[every] = np.arange(len(every))
    seen = language.presence(pa.array([a, b, None]), place, len(every)).astype(int)
    assert (seen @ seen.T)[:2, :2].tolist() == [[len(grams(a)), len(grams(a) & grams(b))], [len(grams(a) & grams(b)), len(grams(b))]]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def removed(rows, window):
    """For each row (in order) the covered words; rows are (doc_id, text) with distinct ids."""
    first = {}
    for doc, text in sorted(rows):
        w = words_of(text)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (doc, i))
    out = {}
    for doc, text in rows:
        w = words_of(text)
        out[doc] = {k for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < (doc, i) for k in range(i, i + window)}
    return out


@pytest.mark.parametrize("hot", [1, 3, 256])
def test_substrings_and_passages(spark, hot):
    values = texts(5, 25) + ["aa " * 70, "bb " + "aa " * 55 + "cc"]
    rows = list(enumerate(values))
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    gone = removed(rows, 20)
    got = {r["doc_id"]: r for r in substrings.without_repeats(df, hot=hot).collect()}
    for doc, text in rows:
        w = words_of(text)
        assert (got[doc]["n_words"], got[doc]["n_removed"]) == (len(w), len(gone[doc]))
        assert got[doc]["kept"] == " ".join(x for i, x in enumerate(w) if i not in gone[doc])
    gone = removed(rows, 50)
    found = defaultdict(set)
    for r in suffix_arrays.repeated_passages(df, hot=hot).collect():
        found[r["doc_id"]] |= set(range(r["first_word"], r["first_word"] + r["n_words"]))
        assert r["passage"] == " ".join(words_of(dict(rows)[r["doc_id"]])[r["first_word"] : r["first_word"] + r["n_words"]])
    assert dict(found) == {d: g for d, g in gone.items() if g}


def test_equal_passages_meet_an_engine_once(spark):
    """5,000 copies in 60 tasks: every group has one distinct window, and only the first copy keeps it."""
    passage = " ".join(random.Random(3).choices(WORDS, k=40))
    df = spark.range(5000, numPartitions=60).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 500 == 7, F.lit(None)).otherwise(F.concat(F.lit(f"{passage} "), F.col("id"))).alias("text")
    )

    def engine(regions):
        if len(regions) > 4:
            raise ValueError(f"{len(regions)} regions meet")
        return substrings.judge(regions, 20)

    rows = repeats.find_repeats(df, 20, 5, engine, 8, lambda doc, words, covered: [(doc, int(covered.sum()))], "doc_id long, n long").collect()
    assert {(r["doc_id"], r["n"]) for r in rows} == {(i, 0 if i == 0 or i % 500 == 7 else 40) for i in range(5000)}
    assert len(rows) == 5000


def test_marks_of_equal_rows_are_counted_once(spark):
    df = spark.createDataFrame([(1, " ".join(WORDS * 5), 0)] * 40, "id long, text string, tie long")
    (marks,) = [r["marks"] for r in repeats.repeated_anchors(df, 20, 5, 8).collect()]
    assert len(marks) == len(set(marks)) <= 60


def test_repeats_with_shared_and_null_ids(spark):
    long = " ".join(WORDS * 3)
    df = spark.createDataFrame([(1, long), (1, long), (None, long), (None, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] is not None, r["n_removed"]) for r in substrings.without_repeats(df).collect())
    assert got[0] == (False, 0) and got[2][1] > 0 and got[2] == got[3]
    assert substrings.repeats_report(df.limit(0)).count() == 0 and suffix_arrays.repeated_passages(df.limit(0)).count() == 0


def test_automaton_statistics():
    rng = random.Random(2)
    for _ in range(60):
        earlier = [[rng.choice("ab").encode() for _ in range(rng.randint(1, 14))] for _ in range(3)]
        automaton = substrings.SuffixAutomaton()
        for words in earlier:
            automaton.add(words)
        query = [rng.choice("abc").encode() for _ in range(12)]
        parts = {tuple(w[i:j]) for w in earlier for i in range(len(w)) for j in range(i, len(w) + 1)}
        want = [max(n for n in range(i + 2) if tuple(query[i + 1 - n : i + 1]) in parts or n == 0) for i in range(12)]
        assert automaton.statistics(query).tolist() == want


def brute_simhash(text):
    w = (text or "").encode().lower().split()
    k = min(4, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(nodes, linked):
    """Smallest member of each node's component."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in nodes}


def test_simhash(spark):
    values = texts(7, 40) + [f"{'the quick brown fox jumps over a lazy dog ' * 30} {i}" for i in range(12)] + ["Ab c", "aB  c"]
    rows = list(enumerate(values))
    prints = {d: brute_simhash(t) for d, t in rows}
    want = groups(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert got == {d: (f"{prints[d]:016x}", want[d]) for d in prints}
    kept = simhash.keep_one_of_each(df.union(df.limit(0)))
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))
    with_null = spark.createDataFrame([(None, "x y"), (3, "x y"), (3, "x y")], "doc_id long, text string")
    assert [r["doc_id"] for r in simhash.keep_one_of_each(with_null).collect()] == [3]
    shared = [(1, "one two"), (5, "one two"), (5, "three four five six"), (7, "x"), (7, "x"), (None, "alone here"), (None, "alone here")]
    both = clashing(spark.createDataFrame(shared, "doc_id long, text string")).withColumn("llm_key", F.lit(1))
    left = simhash.keep_one_of_each(both)
    assert left.columns == both.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in left.collect()) == [("1", "one two"), ("5", "three four five six"), ("7", "x"), ("None", "alone here")]
    assert simhash.keep_one_of_each(both.limit(0)).count() == 0
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("agree,slice_size", [(1, 5), (2, 1000), (3, 7)])
def test_fingerprint_links_find_all(spark, agree, slice_size):
    rng = random.Random(agree)
    base = [rng.getrandbits(64) for _ in range(25)] + [0, (1 << 64) - 1]
    prints = sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(6)})
    want = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(p),) for p in prints], "bits long")
    found = components(simhash.fingerprint_links(df, slice_size=slice_size, agree=agree)).collect()
    roots = {r["node"] & ((1 << 64) - 1): r["component"] for r in found}
    for a, b in itertools.combinations(prints, 2):
        assert (want[a] == want[b]) == (roots.get(a, signed(a)) == roots.get(b, signed(b)))


def test_bktree_near():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    values = np.unique(base[rng.integers(0, 30, 300)] ^ (np.uint64(1) << rng.integers(0, 63, 300).astype(np.uint64)))
    found = {(int(q), int(v)) for qs, vs in bktree.BKTree(values).near(base, 4) for q, v in zip(qs, vs)}
    assert found == {(i, j) for i, q in enumerate(base) for j, v in enumerate(values) if int(q ^ v).bit_count() <= 4}


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 150)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{x: 100 for x in range(100, 150)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("cell_target,slice_size", [(2048, 1024), (8, 3)])
def test_embeddings(spark, cell_target, slice_size):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 6))
    rows = [(i, (base[i % 12] + rng.normal(scale=0.08, size=6)).tolist(), i % 2) for i in range(90)]
    rows += [(100, rows[0][1], 0), (101, rows[0][1], 0), (102, rows[0][1], None), (103, None, 0), (104, [0.0] * 6, 0), (105, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0)]
    rows += [(106, [float("nan")] * 6, 0), (107, [float("inf")] + [0.0] * 5, 0), (108, [], 0), (109, [1.0, 0.0], 0), (110, [2.0, 0.0], 0), (111, [x * 1e-30 for x in rows[0][1]], 0)]

    def fit(v):
        return v and None not in v and all(map(math.isfinite, v)) and any(v)

    def linked(a, b):
        (x, la), (y, lb) = by_id[a], by_id[b]
        if la is None or la != lb or not fit(x) or not fit(y) or len(x) != len(y):
            return False
        x, y = np.array(x) / max(map(abs, x)), np.array(y) / max(map(abs, y))
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98

    by_id = {i: (v, lab) for i, v, lab in rows}
    root = groups(list(by_id), linked)
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = {r["vec_id"]: tuple(r)[1:] for r in embedding_cells.linked_vectors(df, cell_target=cell_target, slice_size=slice_size).collect()}
    assert got == {i: (sum(linked(i, j) for j in by_id if j != i), root[i], root[i] == i) for i in by_id}
    assert embedding_cells.linked_vectors(df.limit(0)).count() == 0


def test_mixture_exponent_and_budgets(spark):
    rng = random.Random(1)
    sizes = {"a": 400, "b": 60, "c": 25, None: 10, "empty": 3}
    rows = [(i, s, " ".join(["w"] * (0 if s == "empty" else rng.randint(1, 9)))) for i, s in enumerate(x for x, n in sizes.items() for _ in range(n))]
    df = clashing(spark.createDataFrame([(i, t, s) for i, s, t in rows], "doc_id long, text string, source string"))
    tokens = defaultdict(int)
    for _, s, t in rows:
        tokens[s] += len(t.split())
    every = sum(tokens.values())
    share = {s: n / every for s, n in tokens.items() if n}

    for settings in ({"most_repeats": 2.0}, {"most_repeats": None, "target_entropy": 1.0}, {"most_repeats": 3.0, "budget": 2 * every}, {"most_repeats": None, "target_entropy": 9.0, "budget": 500}):
        out = mixing.mixture(df, block_tokens=100, **settings).select("*", "mix.*").collect()
        used, epochs = defaultdict(int), {}
        for r in out:
            used[r["source"]] += len(r["text"].split())
            epochs[r["source"]] = r["epochs"]
        weight = {s: epochs[s] * tokens[s] for s in share if s in epochs}
        whole = sum(weight.values())
        entropy = -sum(w / whole * math.log(w / whole) for w in weight.values())
        if settings.get("target_entropy") == 1.0:
            assert abs(entropy - 1.0) < 1e-6
        if settings.get("target_entropy") == 9.0:
            assert max(weight.values()) - min(weight.values()) < 1e-6 * whole  # even sources are the best there is
        if settings.get("most_repeats") == 2.0:
            assert abs(max(epochs.values()) - 2.0) < 1e-6 and min(epochs.values()) == 1.0
            assert {r["doc_id"] for r in out} == {i for i, _, _ in rows}
        if settings.get("most_repeats") == 3.0:
            assert max(epochs[s] for s in share) <= 3 + 1e-9 or abs(entropy - -sum(p * math.log(p) for p in share.values())) < 1e-6
        for s in weight:
            assert weight[s] - 9 - 1e-6 <= used[s] <= weight[s] + 1e-6
        seen = [(r["doc_id"], r["epoch"]) for r in out]
        assert len(seen) == len(set(seen))
    assert mixing.mixture(df.limit(0)).count() == 0
    assert mixing.mixture(df.withColumn("text", F.lit(None).cast("string"))).count() == len(rows)
    assert mixing.mixed(df).columns == df.columns


def test_mixture_counts_all_words(spark, docs):
    got = {r["doc_id"]: r["n_tokens"] for r in mixing.mixture_report(docs).collect()}
    assert got == {r["doc_id"]: len(words_of(r["text"])) for r in docs.collect()}


def test_pseudonyms_keep_format_and_invert(spark):
    rng = random.Random(9)

    def luhn(body):
        return next(body + str(c) for c in range(10) if sum(sum(divmod(int(d) * (1 + (i % 2)), 10)) for i, d in enumerate(reversed(body + str(c)))) % 10 == 0)

    cards = [luhn("4" + "".join(rng.choices("0123456789", k=n))) for n in (11, 14, 14, 17)]
    dates = [(datetime.date(1700, 1, 1) + datetime.timedelta(rng.randrange(146097))) for _ in range(40)] + [datetime.date(1700, 1, 1), datetime.date(2099, 12, 31), datetime.date(2000, 2, 29)]
    values = [*cards, "4111-1111-1111-1111", "+1 (988) 555-2485", "988-555-2485", "(222) 200-0000", "123-45-6789", "667-01-0001", "899-99-9999", "0.0.0.0", "255.255.255.255", "10.2.3.4"]
    values += [f for d in dates for f in (d.isoformat(), f"{d:%d.%m.}{d.year:04d}")] + [f"{d:%m/%d/}{d.year:04d}" for d in dates]
    stay = ["4111111111111112", "1990-02-30", "1699-12-31", "2100-01-01", "000-12-3456", "666-12-3456", "300.1.1.1", "1.2.3.4.5", "01.2.3.4", "x4111111111111111", "(188) 555-2485", "12345"]
    rows = [(i, f"see {v}, and {v}. End") for i, v in enumerate([*values, *stay])] + [(900, None), (901, ""), (902, "none here")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    out, count = pseudonyms.with_pseudonyms(df, "k")
    assert count == "n_replaced_" and out.columns[:-1] == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    for i, v in enumerate(values):
        found = re.fullmatch(r"see (.*), and (.*)\. End", got[i]["text"])
        assert found[1] == found[2] and re.sub(r"\d", "9", found[1]) == re.sub(r"\d", "9", v) or v.count(".") == 3, v
        assert got[i][count] in (0, 2)
    for i in range(len(values), len(rows)):
        assert got[i if i < len(values) + len(stay) else 900 + i - len(values) - len(stay)]["text"] == rows[i][1]
    for i, c in enumerate(cards):
        new = got[i]["text"][4 : 4 + len(c)]
        assert new[0] == c[0] and luhn(new[:-1]) == new
    assert len({r["text"] for r in got.values() if r["text"]}) == len({t for _, t in rows if t})
    back, _ = pseudonyms.with_pseudonyms(out.select("doc_id", "text"), "k", inverse=True)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == dict(rows)
    other, _ = pseudonyms.with_pseudonyms(df, "another key")
    assert {r["text"] for r in other.collect()} != {r["text"] for r in got.values()}


def test_feistel_is_a_permutation(spark):
    out = spark.range(21).select(pseudonyms._feistel(F.col("id"), 3, 7, F.lit("t"), F.lit("k"), False).alias("p"), "id")
    back = out.select(pseudonyms._feistel(F.col("p"), 3, 7, F.lit("t"), F.lit("k"), True).alias("b"), "id", "p").collect()
    assert sorted(r["p"] for r in back) == list(range(21)) and all(r["b"] == r["id"] for r in back)


def test_licences(spark):
    mit = dict(licences.KNOWN)["Unlicense"]
    other = "Copyright (c) 2020 Someone\n\n  " + mit.upper().replace("LICENSE", "LICENCE").replace(", ", " ,\n")
    rows = [(1, mit), (2, other), (3, mit + " and more"), (4, None), (5, ""), (6, "intro\n# LICENSED under the MIT licence!\nx"), (6, "!!"), (None, "é")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = licences.scan_licences(df, licences.known_licences(spark)).collect()
    assert {(r["doc_id"], r["line"], r["license_id"]) for r in got if r["license_id"]} == {(1, 0, "Unlicense"), (2, 0, "Unlicense"), (6, 2, "MIT")}
    assert sorted(str(r["doc_id"]) for r in got if r["line"] == 0) == sorted(str(d) for d, _ in rows)
    assert {r["digest"] for r in got if r["doc_id"] in (4, 5)} == {None}
    assert licences.scan_licences(df, licences.known_licences(spark).limit(0)).filter("license_id IS NOT NULL").count() == 0
    assert licences.scan_licences(df.limit(0), licences.known_licences(spark)).count() == 0


def test_pipeline_stages(spark):
    docs = table(spark, SMALL, "documents")
    odd = spark.createDataFrame([(5000, None), (5001, "123"), (5002, "the and of " * 9)], "doc_id long, text string")
    start = docs.unionByName(odd, allowMissingColumns=True).withColumn("extra", F.lit(1))
    kept = start
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SMALL)
        assert kept.columns == start.columns, name
    ids = {r["doc_id"] for r in kept.collect()}
    # By brute force: letters, then one of each fingerprint group, then what the benchmark leaves.
    rows = [(r["doc_id"], r["text"]) for r in start.collect() if r["text"] and any(map(str.isalpha, r["text"]))]
    prints = {d: brute_simhash(t) for d, t in rows}
    root = groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    left = [(d, t) for d, t in rows if root[d] == d]
    marks = {r["doc_id"]: r["contaminated"] for r in QUERIES["op2_decontamination"][0](spark, SMALL).collect()}
    assert ids == {d for d, _ in left if not marks.get(d)}
    out = corpus_pipeline.run(spark, SMALL).orderBy("start").collect()
    again = [r["doc_id"] for r in out]
    assert set(again) == ids - {5002} and again == sorted(again) and out[0]["start"] == 0
