"""Spelling variants, periodic runs and toxicity against brute force and planted cases."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftloom.llm import spelling, token_output, toxicity, word_runs, words
from driftloom.llm.common import sent_in
from driftloom.llm.queries import tokenizer_path


def clashing(df):
    """The same rows with extra columns named like those the operators add."""
    extra = ("periodic", "toxicity", "word", "n", "near", "run", "id", "size", "weight")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(extra)])


# --- periodic runs -----------------------------------------------------------------------------


def runs_of(w, least=6, exponent=4):
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            smaller = any(all(w[s + t] == w[s + t + p] for t in range(size - p)) for p in range(1, q))
            if size >= max(least, exponent * q) and not smaller:
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed_of(w, runs):
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_texts(n, seed=7):
    rng, out = random.Random(seed), []
    for _ in range(n):
        w = [rng.choice("abcde"[: rng.choice([1, 2, 3, 5])]) for _ in range(rng.randint(0, 50))]
        if w and rng.random() < 0.6:
            p, a = rng.randint(1, 6), rng.randrange(len(w))
            w = [x if i < a else w[a + (i - a) % p] if a + (i - a) % p < len(w) else x for i, x in enumerate(w)]
        out.append(rng.choice([" ", "\t", "\n  "]).join(w) + rng.choice(["", " ", "\r\n"]))
    return out


def strongest_of(runs):
    best = None
    for s, size, q in runs:
        if best is None or size * best[2] > best[1] * q:
            best = (s, size, q)
    return best


@pytest.mark.parametrize("least,exponent", [(6, 4), (9, 3), (2, 5)])
def test_runs(spark, least, exponent):
    odd = [None, "", " \n", "a", "a " * 6, "a " * 5, "x" * 5000, "é é é é é é ü", "a a " * 6, "b " + "a b " * 3000 + "c"]
    values = [*odd, *periodic_texts(400), "a b a b a b a b", "a b a b a b a b"]
    df = clashing(spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(values)], "doc_id long, text string").repartition(3))
    found, name = word_runs.with_runs(df, least_words=least, least_exponent=exponent)
    assert name == "periodic_" and found.columns[:-1] == df.columns
    got = found.collect()
    assert sorted(str(r["text"]) for r in got) == sorted(map(str, values))
    for r in got:
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        want, f = runs_of(w, least, exponent), r[name]
        assert [tuple(x) for x in f["runs"]] == want and f["n_words"] == len(w)
        assert f["collapsed"] == collapsed_of(w, want)
        assert (f["strongest"] and tuple(f["strongest"])) == strongest_of(want)
    assert word_runs.with_runs(df.limit(0))[0].count() == 0


def test_a_very_long_run_and_many_passages(spark):
    rng = random.Random(3)
    passage = " ".join(rng.choice("pqrstuvw") + str(k) for k in range(12))
    spread = " ".join(f"{passage} {rng.random()}" for _ in range(3000))
    df = spark.createDataFrame([(1, "a " * 200_000), (2, spread)], "doc_id long, text string")
    rows = {r["doc_id"]: r["periodic"] for r in word_runs.with_runs(df)[0].collect()}
    assert [tuple(x) for x in rows[1]["runs"]] == [(0, 200_000, 1)] and rows[1]["collapsed"] == "a"
    assert rows[2]["runs"] == [] and rows[2]["collapsed"] == spread


def test_periodic_report(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 120)))) for i in range(300)] + [(5000, None), (5001, "")]
    want = {}
    for doc, text in rows:
        w, h = (text or "").split(), zlib.crc32(str(doc).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = runs_of(w)
        best = strongest_of(runs)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want[doc] = (doc, len(runs), *tail, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed_of(w, runs))))
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r[0]: tuple(r) for r in word_runs.periodic_report(df).collect()} == want
    assert any(t[1] for t in want.values())
    blank = word_runs.periodic_report(spark.createDataFrame([(None, "a b c")], "doc_id long, text string")).first()
    assert blank["doc_id"] is None and blank["n_runs"] == 0


# --- spelling variants -------------------------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def forms_of(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, around in near.items():
        best = min(around, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def variants(seed, alphabet="abé÷", n=60):
    rng, out = random.Random(seed), {}
    for _ in range(n):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(2, 11)))
        out[w] = rng.choice([2, 3, 20, 30, 200, 300, 2000])
        for _ in range(4):
            i = rng.randrange(len(w))
            v = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1 :]])
            if len(v) > 1:
                out.setdefault(v, rng.choice([2, 3, 20]))
    return out


@pytest.mark.parametrize("most", [0, 3, 256])
def test_forms(spark, most):
    counts = variants(most) | {"prefixes" + c: 2 for c in "abcdefghijklm"}
    df = clashing(spark.createDataFrame(list(counts.items()), "word string, n long").select(F.col("word").alias("w"), F.col("n").alias("k")))
    words = df.select(F.col("w").alias("word"), F.col("k").alias("n"))
    got = {r["word"]: tuple(r) for r in spelling.spelling_forms(words, most_grams=most).collect()}
    assert got == forms_of(counts)
    pairs = spelling.near_words(words, most).select("word", "near").collect()
    assert len(pairs) == len(set(pairs)) and spelling.near_words(words.limit(0), most).count() == 0


def test_a_half_that_all_words_share_pairs_near_words_only(spark):
    rng = random.Random(1)
    rows = list({("commonhalf" + "".join(rng.choice("abcdefghij") for _ in range(10)), 2) for _ in range(4000)})
    words = spark.createDataFrame(rows + [("commonhalfaaaaaaaaaa", 2), ("commonhalfaaaaabaaaa", 2)], "word string, n long").dropDuplicates(["word"])
    found = spelling.near_words(words)
    assert {tuple(r) for r in found.filter("word = 'commonhalfaaaaaaaaaa'").select("near").collect()} == {("commonhalfaaaaabaaaa",)}


def test_spelling_report(spark):
    rng = random.Random(2)
    base = ["Running", "WALKING", "swimming", "öffnung", "Éditions", "cyclists", "tiny", "a×b÷cdefg"]
    rows = [(i, "1" + ", ".join(rng.choices(base, k=60)) + "_x") for i in range(120)] + [(None, "Running running"), (7, None), (8, ""), (9, "x" * 30_000)]
    counts = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = 1 if doc is None else zlib.crc32(f"{doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["word"]: tuple(r) for r in spelling.spelling_report(df).collect()}
    assert got == forms_of(counts) and any(r[1] for r in got.values())
    assert spelling.spelling_report(df.limit(0)).count() == 0


# --- toxicity ----------------------------------------------------------------------------------


def planted(n=1600, seed=5):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    insults = ["vile", "zzgrub", "mudface"]
    rows, labels = [], []
    for i in range(n):
        w = rng.choices(plain, k=rng.randint(5, 60))
        bad = rng.random() < 0.2
        if bad:
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = rng.choice(insults[:2] if rng.random() < 0.5 else ["krox" + rng.choice(plain)])
        rows.append((i, " ".join(w).capitalize() + "."))
        labels.append((i, int(bad != (rng.random() < 0.03))))  # some labels are wrong
    return rows, labels


def is_bad(text):
    return bool(re.search(r"\b(vile|zzgrub|krox)", text.lower()))


@pytest.fixture(scope="module")
def rated(spark):
    rows, labels = planted()
    docs = spark.createDataFrame([*rows, (90_001, None), (90_002, ""), (90_003, "123 !!"), (None, "plain"), (3, rows[3][1])], "doc_id long, text string")
    return clashing(docs).repartition(3), spark.createDataFrame([*labels, (5, None), (None, 1), (77_777, 1)], "doc_id long, toxic int")


def test_toxicity_finds_planted_texts(spark, rated):
    docs, labels = rated
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert len(rows) == docs.count()
    right = 0
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2)
        right += r["predicted"] == int(is_bad(texts[r["doc_id"]] or ""))
        if not texts[r["doc_id"]]:
            assert r["predicted"] == 0
    assert right >= 0.97 * len(rows)
    assert toxicity.toxicity_report(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_never_read(spark, rated):
    docs, labels = rated
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (toxicity.fit(docs, x) for x in (labels, turned))
    assert one.weights == other.weights and one.intercept == other.intercept


def test_labels_that_tell_nothing_apart(spark, rated):
    docs, labels = rated
    some = docs.limit(20)
    for chosen, score in ((labels.limit(0), 0), (labels.filter("toxic = 0"), 0), (labels.filter("toxic = 1"), 1)):
        assert {(round(r["score"], 6), r["predicted"]) for r in toxicity.toxicity_report(some, chosen).collect()} <= {(score, score)} | {(0, 0)}


def test_label_model_finds_accuracies_and_copies(spark):
    rng = np.random.default_rng(1)
    y = rng.random(6000) < 0.3
    rate = np.array([[0.05, 0.1, 0.05, 0.02], [0.8, 0.6, 0.5, 0.4]])
    cast = rng.random((6000, 4)) < np.where(y[:, None], rate[1], rate[0])
    cast = np.column_stack([cast, cast[:, 0], cast[:, 0]])  # two copies of the first voter
    given = np.where(rng.random(6000) < 0.2, -1, y ^ (rng.random(6000) < 0.05)).astype(int)
    rows = [(int(g), 1.0, [bool(v) for v in c]) for g, c in zip(given, cast)]
    labelled = spark.createDataFrame([r for r in rows if r[0] >= 0], "toxic int, weight double, votes array<boolean>")
    model = toxicity.fit_label_model(labelled, 6)
    assert np.abs(model.rates[:, :4] - rate).max() < 0.04 and abs(model.prior - 0.3) < 0.03
    assert model.shared[0, 4] > 0.95 and model.shared[0, 1] == 0
    alone = np.zeros((1, 6), bool)
    alone[0, [0, 4, 5]] = True
    once = toxicity.LabelModel(model.prior, model.rates[:, :4], np.eye(4), model.trust)
    assert abs(model.posterior(alone, np.array([-1]))[0] - once.posterior(alone[:, :4], np.array([-1]))[0]) < 0.1
    assert ((model.posterior(cast, np.full(6000, -1)) > 0.5) == y).mean() > 0.9


def test_descend_solves_a_quadratic():
    a = np.diag([1.0, 10.0, 100.0])
    b = np.array([1.0, 2.0, 3.0])
    at = toxicity.descend(lambda x: (float(x @ a @ x / 2 - b @ x), a @ x - b), np.zeros(3), 100)
    assert np.allclose(at, b / np.diag(a), atol=1e-2)


def test_token_writer_holds_little_text_at_once(spark, monkeypatch):
    """Neither the batches that Spark sends nor the slices that are encoded follow the partition's size; the session stays as it was."""
    slices = token_output.sliced

    def watched(batches, text, *most):
        def small(batches):
            for batch in batches:
                assert batch.num_rows * 8000 < 6 << 20
                yield batch

        for batch in slices(small(batches), text, *most):
            assert batch.num_rows * 8000 < 1 << 20
            yield batch

    monkeypatch.setattr(token_output, "sliced", watched)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(1600).select(F.col("id").alias("doc_id"), F.repeat(F.lit("many word "), 800).alias("text")).coalesce(1)
    rows = token_output.token_digests(docs, tokenizer_path()).collect()
    assert sorted(r.doc_id for r in rows) == list(range(1600)) and len({(r.n_tokens, r.ids_crc32) for r in rows}) == 1
    assert rows[0].n_tokens > 1600 and spark.conf.get(key) == before
    with sent_in(spark, 1 << 40):
        assert spark.conf.get(key) == before


def test_a_worker_keeps_its_encoder_and_words(spark):
    """Tasks of one Python worker share an encoder; the package's code travels with each, so a global would not do."""
    path = tokenizer_path()
    encoder = token_output.encoder

    def visit(batches):
        rows = sum(batch.num_rows for batch in batches)
        held = encoder(path)
        held.visits = getattr(held, "visits", 0) + rows
        yield pa.record_batch([pa.array([os.getpid()]), pa.array([held.visits])], names=["worker", "visits"])

    rows = spark.range(0, 64, 1, 64).mapInArrow(visit, "worker long, visits long").collect()
    assert len(set(rows)) == 64 and max(r.visits for r in rows) > 1


def test_a_changed_vocabulary_file_has_a_new_encoder(tmp_path):
    path = tmp_path / "words.json"
    path.write_bytes(open(tokenizer_path(), "rb").read())
    first = token_output.encoder(str(path))
    assert token_output.encoder(str(path)) is first
    path.write_bytes(path.read_bytes() + b"\n")
    assert token_output.encoder(str(path)) is not first


def word_encoder(kept=400_000):
    return words.WordEncoder(tokenizer_path(), kept)


def test_latin_words_need_no_normalizer():
    """Capital letters, and marks after letters, of Latin-1 text go to the model as they are; those beyond need the whole tokenizer."""
    texts = ["Été, ÉTÉ. Über!! naïve... Ñandú; Straße, Þing (ÿ) déjà-", "ΑΣ 12"]
    encoder = word_encoder()
    want = [encoder.whole.encode(t, add_special_tokens=False).ids for t in texts]
    whole, seen = encoder.whole, []

    class Watched:
        def encode_batch_fast(self, texts, **settings):
            seen.extend(texts)
            return whole.encode_batch_fast(texts, **settings)

    encoder.whole = Watched()
    ids, sizes = encoder.encode(pa.array(texts))
    assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
    assert sorted(" ".join(seen).split()) == sorted(["(ÿ)", "ΑΣ", "12", ",", "."])


def test_odd_words_match_whole_texts():
    letters = "abcdeßàéüÿÀÉÖÞ×÷ªºµ¿ŁłİΣσ中ﬁ\u0301\u0327\u0345\u00a0\u2003'!,.-<|>_09"
    rng = random.Random(3)
    odd = lambda: "".join(rng.choices(letters, k=rng.choice([1, 2, 3, 5, 8, 80])))
    for kept in (400_000, 60):
        encoder = word_encoder(kept)
        for _ in range(40):
            texts = [None, "", *(rng.choice([" ", "\t", "  "]).join(odd() for _ in range(rng.randint(0, 30))) for _ in range(8))]
            ids, sizes = encoder.encode(pa.array(texts))
            want = [encoder.whole.encode(t or "", add_special_tokens=False).ids for t in texts]
            assert sizes.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_an_encoder_forgets_texts_and_failures(monkeypatch):
    """What outlasts a task is bounded in ids too: special texts are not kept, nor words half added when a task fails."""
    encoder = word_encoder(kept=50)
    encoder.encode(pa.array(["some words here"]))
    before = encoder.n_known, encoder.n_flat
    encoder.encode(pa.array(["<|endoftext|> " + "other words " * 50] * 3))
    assert (encoder.n_known, encoder.n_flat) == before
    for i in range(20):
        encoder.encode(pa.array([f"{'qxz' * 300}{'abcdefghijklmnopqrst'[i]} same"] * 2))
        assert encoder.n_flat < 2 * 50 * words.IDS_PER_WORD
    monkeypatch.setattr(encoder, "_learn", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        encoder.encode(pa.array(["never seen"]))
    assert encoder.n_known == 0


def test_hashed_numbers_find_what_was_put():
    rng = np.random.default_rng(2)
    table, held = words.HashedNumbers(4), {}
    for _ in range(30):
        # Many share their low bits, which choose the first place.
        hashes = np.setdiff1d(rng.integers(0, 1 << 20, 200, dtype=np.uint64) << np.uint64(rng.integers(0, 40)), np.array(list(held), np.uint64))
        assert (table.find(hashes) == -1).all()
        numbers = len(held) + rng.permutation(len(hashes))
        table.put(hashes, numbers)
        held.update(zip(hashes.tolist(), numbers.tolist()))
        assert table.find(np.array(list(held), np.uint64)).tolist() == list(held.values())
    assert dict(zip(*map(np.ndarray.tolist, table.held()))) == held
