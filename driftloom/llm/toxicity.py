"""Toxicity from weak supervision: many simple voters, a generative model of them, a linear classifier.

1. **Voters.** Words and word beginnings that go with the toxic label are read off labelled texts
   and dealt into lists: a lexicon voter votes when a text holds one of its words, a pattern voter
   when a word begins in one of its ways. A few fixed patterns of shouting and masking join them.
2. **Label model.** Every text has an unknown class. A voter has a rate of voting in either class
   (its accuracy), and voters correlate within a class; the given label is one more voter that is
   right with probability `trust`. Expectation-maximisation alternates posteriors and rates. A
   vote counts for its log-likelihood ratio divided by the sum of its correlations with the votes
   that agree with it, so that lists holding forms of one word count as one.
3. **Classifier.** Logistic regression with a ridge on counts of distinct words and word
   beginnings, fitted to the posteriors by L-BFGS. Texts are scored by its weights alone.

Only the fit is on a sample: at most `rows_per_label` labelled texts of either label, chosen by a
hash of the id, weighted so that the labels' shares stay those of all labelled rows. Its features
are the `vocabulary` terms with the most evidence for either label, its voters hold `terms` of them.
Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.llm.common import fresh_name, need, sliced
from driftloom.llm.language import held_out
from driftloom.sources.scratch import settle

ROWS_PER_LABEL = 4096
VOCABULARY = 1 << 14
TERMS = 768
LISTS = 24
TRUST = 0.95
ROUNDS = 5
RIDGE = 3e-4
STEPS = 200
CUTOFF = 0.3
FIT_TASKS = 8
BEGINNINGS = (4, 5, 6)
PATTERNS = (r"!!", r"\b\p{Lu}{4,}\b", r"\p{L}[*#@$%]{2,}", r"(aaa|eee|iii|ooo|uuu)")
MOST_KNOWN = 1 << 18


def features_of(word: str) -> list[str]:
    """A word, and its beginnings marked by a hyphen."""
    return [word, *[f"{word[:k]}-" for k in BEGINNINGS if len(word) > k]]


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Pairs of a text's number and a word's, each once, and the words: runs of letters, lower-cased."""
    letters = pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.string()).fill_null("")), r"[^\p{L}]+", " ")
    lists = pc.split_pattern(letters, " ")
    coded = lists.flatten().dictionary_encode()
    sizes = np.diff(lists.offsets.to_numpy())
    words = coded.dictionary.to_pylist()
    pairs = np.unique(np.repeat(np.arange(len(texts)), sizes) * max(1, len(words)) + coded.indices.to_numpy())
    text, word = np.divmod(pairs, max(1, len(words)))
    real = np.array([bool(w) for w in words], bool)[word] if len(words) else np.zeros(0, bool)
    return text[real], word[real], words


def sample_of(docs: DataFrame, labels: DataFrame, rows_per_label: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """text, toxic (0 or 1) and weight of the labelled texts to learn from; held-out rows are never among them.

    An id's label is the largest of its rows in `labels`; null labels and texts are left out. The
    labels' counts go through the driver, two numbers.
    """
    toxic = (F.max(F.col(label_col).cast("double")) > 0).cast("int")
    rated = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    rows = settle(rated.groupBy(F.col(id_col).alias("id")).agg(toxic.alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return docs.select(F.col(text_col).alias("text"), F.lit(0).alias("toxic"), F.lit(1.0).alias("weight")).limit(0)
    # A third more than wanted by hash, then exactly the first by rank: only the sample is ordered.
    scale, mixed = 1 << 30, F.xxhash64(F.lit("toxicity"), F.col("id"))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(scale, int(scale * 4 / 3 * (rows_per_label + 32) / n) + 1))])
    some = rows.filter(F.pmod(mixed, F.lit(scale)) < share[F.col("toxic")])
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(mixed, "id"))
    picked = settle(some.withColumn("__rank", rank).filter(F.col("__rank") <= rows_per_label).select("id", "toxic"))
    weight = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, n / min(n, rows_per_label) / sum(counts.values()))])
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    return texts.join(picked, F.col("__id") == F.col("id")).select("text", "toxic", weight[F.col("toxic")].alias("weight"))


def with_features(sample: DataFrame) -> DataFrame:
    """The sample's rows with the `features` of their distinct words, one entry for each, and the fixed patterns' votes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            raw = batch.column("text")
            text, word, words = distinct_words(raw)
            spelt = [features_of(w) for w in words]
            found: list[list[str]] = [[] for _ in range(batch.num_rows)]
            for t, w in zip(text.tolist(), word.tolist()):
                found[t] += spelt[w]
            shown = np.column_stack([pc.match_substring_regex(raw, p).to_numpy(zero_copy_only=False) for p in PATTERNS]).tolist()
            columns = [batch.column("toxic"), batch.column("weight"), pa.array(found, pa.list_(pa.string())), pa.array(shown, pa.list_(pa.bool_()))]
            yield pa.record_batch(columns, names=["toxic", "weight", "features", "patterns"])

    return sample.mapInArrow(find, "toxic int, weight double, features array<string>, patterns array<boolean>")


def rated_terms(rows: DataFrame) -> DataFrame:
    """`term`, its `evidence` (twice the log-likelihood ratio), `lift` and whether it is `toxic`, for terms found in three texts.

    The lift is a term's smoothed frequency in toxic texts over that in others. A term counts as
    toxic if the lift is at least 4, three toxic texts hold it, and it is beyond chance.
    """
    sizes = rows.agg(F.count_if(F.col("toxic") == 1).alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0")).first()
    n1, n0 = F.lit(float(sizes["n1"])), F.lit(float(sizes["n0"]))
    spread = rows.select("toxic", F.explode(F.array_distinct("features")).alias("term"))
    counted = spread.groupBy("term").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
    a, b = F.col("a"), F.col("b")
    share = (a + b) / (n1 + n0)

    def part(x, expected):
        return F.when(x > 0, x * F.ln(x / expected)).otherwise(F.lit(0.0))

    evidence = 2 * (part(a, n1 * share) + part(b, n0 * share) + part(n1 - a, n1 * (1 - share)) + part(n0 - b, n0 * (1 - share)))
    lift = (a + 0.5) / (n1 + 1) * (n0 + 1) / (b + 0.5)
    known = counted.filter(a + b >= 3).select("term", "a", evidence.alias("evidence"), lift.alias("lift"))
    return known.select("term", "evidence", "lift", ((a >= 3) & (F.col("lift") >= 4) & (F.col("evidence") > 10.83)).alias("toxic"))


def voter_lists(terms: list[str], lists: int) -> dict[str, int]:
    """The number of the list each term is dealt to: words fill the first `lists`, beginnings the next.

    Terms come by falling lift and a list takes the next of them, so what is in one list is about
    equally reliable.
    """
    dealt = {}
    for kind in (0, 1):
        own = [t for t in terms if t.endswith("-") == bool(kind)]
        dealt |= {t: kind * lists + i * lists // len(own) for i, t in enumerate(own)}
    return dealt


@dataclass
class LabelModel:
    """`rates[y]` are the voters' rates of voting in class y, `shared` their correlations within a class."""

    prior: float
    rates: np.ndarray
    shared: np.ndarray
    trust: float

    def posterior(self, votes: np.ndarray, given: np.ndarray) -> np.ndarray:
        """Chance of class 1 per text; `given` is its label, or -1 for none."""
        cast = votes.astype(float)
        silent = 1 - cast
        for_it = np.log(self.rates[1] / self.rates[0])
        against = np.log((1 - self.rates[1]) / (1 - self.rates[0]))
        odds = (cast * for_it / np.maximum(1, cast @ self.shared)).sum(axis=1)
        odds += (silent * against / np.maximum(1, silent @ self.shared)).sum(axis=1)
        odds += np.log(self.prior / (1 - self.prior))
        odds += np.where(given < 0, 0.0, np.where(given > 0, 1.0, -1.0) * np.log(self.trust / (1 - self.trust)))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _sums(votes: np.ndarray, weight: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Per class: weight, votes per voter and votes cast together, as one array."""
    cast = votes.astype(float)
    out = []
    for q in (weight * (1 - chance), weight * chance):
        out.append(np.concatenate(([q.sum()], q @ cast, ((cast * q[:, None]).T @ cast).ravel())))
    return np.stack(out)


def model_from(sums: np.ndarray, voters: int, rows: int, trust: float) -> LabelModel:
    """Maximum-likelihood rates (half a text added on either side) and correlations from `_sums` over `rows` texts."""
    size = np.maximum(sums[:, 0], 1e-12)
    half = 0.5 * size.sum() / max(1, rows)
    rates = (sums[:, 1 : 1 + voters] + half) / (size[:, None] + 2 * half)
    together = sums[:, 1 + voters :].reshape(2, voters, voters)
    means = sums[:, 1 : 1 + voters] / size[:, None]
    covariance = sum(together[y] - size[y] * np.outer(means[y], means[y]) for y in (0, 1)) / size.sum()
    spread = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
    shared = covariance / np.outer(spread, spread)
    shared[shared < max(0.05, 3 / np.sqrt(max(1, rows)))] = 0  # what chance alone can show, and votes that part
    np.fill_diagonal(shared, 1)
    return LabelModel(float(np.clip(size[1] / size.sum(), 1e-6, 1 - 1e-6)), rates, shared, trust)


def fit_label_model(votes: DataFrame, voters: int, trust: float = TRUST, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over rows of `votes` (array of booleans), `toxic` and `weight`; a pass sends its sums only."""
    model: LabelModel | None = None
    for _ in range(rounds):
        held = model

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros((2, 1 + voters + voters * voters)), 0
            for batch in batches:
                cast = batch.column("votes").flatten().to_numpy(zero_copy_only=False).reshape(-1, voters)
                given = batch.column("toxic").to_numpy()
                chance = np.where(given > 0, trust, 1 - trust) if held is None else held.posterior(cast, given)
                total += _sums(cast, batch.column("weight").to_numpy(), chance)
                n += batch.num_rows
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary()), pa.array([n])], names=["sums", "n"])

        parts = votes.mapInArrow(step, "sums binary, n long").collect()
        sums = sum(np.frombuffer(bytes(p["sums"])).reshape(2, -1) for p in parts)
        model = model_from(sums, voters, sum(p["n"] for p in parts), trust)
    return model


def descend(loss_at, start: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; `loss_at` gives loss and gradient."""
    at = start
    loss, slope = loss_at(at)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, shares = slope.copy(), []
        for s, y, r in reversed(moves):
            shares.append(r * (s @ way))
            way -= shares[-1] * y
        if moves:
            s, y, r = moves[-1]
            way *= 1 / (r * (y @ y))
        for (s, y, r), share in zip(moves, reversed(shares)):
            way += s * (share - r * (y @ way))
        size = 1.0 if moves else 1 / max(1e-12, np.linalg.norm(slope))
        for _ in range(20):
            there = at - size * way
            new_loss, new_slope = loss_at(there)
            if new_loss <= loss - 1e-4 * size * (slope @ way):
                break
            size /= 2
        else:
            return at
        s, y = there - at, new_slope - slope
        if s @ y > 1e-16:
            moves = [*moves[1 - memory :], (s, y, 1 / (s @ y))]
        settled = loss - new_loss < 1e-6 * abs(loss)
        at, loss, slope = there, new_loss, new_slope
        if settled:
            break
    return at


def fit_line(rows: DataFrame, width: int, ridge: float, steps: int) -> np.ndarray:
    """Weights and, last, the intercept of logistic regression on `places` (feature numbers, repeats count), `chance` and `weight`.

    The bounded sample is fitted in one task, as feature numbers without texts; its rows are put
    in a fixed order first, so that the result does not depend on how they arrive.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = [b for b in batches if b.num_rows]
        lists = [b.column("places") for b in taken]
        places = np.concatenate([x.flatten().to_numpy() for x in lists])
        sizes = np.concatenate([np.diff(x.offsets.to_numpy()) for x in lists])
        weight, chance = (np.concatenate([b.column(c).to_numpy() for b in taken]) for c in ("weight", "chance"))
        weight = weight / weight.sum()
        row, n = np.repeat(np.arange(len(sizes)), sizes), len(sizes)

        def loss_at(line: np.ndarray) -> tuple[float, np.ndarray]:
            odds = np.clip(line[-1] + np.bincount(row, line[places], n), -500, 500)
            miss = weight * (1 / (1 + np.exp(-odds)) - chance)
            held = np.append(line[:-1], 0.0)
            slope = np.append(np.bincount(places, miss[row], width), miss.sum()) + ridge * held
            return float((weight * (np.logaddexp(0, odds) - chance * odds)).sum() + ridge / 2 * (held * held).sum()), slope

        yield pa.record_batch([pa.array([descend(loss_at, np.zeros(width + 1), steps).tobytes()], pa.binary())], names=["line"])

    ordered = rows.repartition(1).sortWithinPartitions(F.xxhash64("places", "chance", "weight"))
    return np.frombuffer(bytes(ordered.mapInArrow(train, "line binary").first()["line"]))


@dataclass
class Scorer:
    """Weights of words and beginnings, the intercept, and the label model behind them (None where there was nothing to learn)."""

    weights: dict[str, float]
    intercept: float
    label_model: LabelModel | None = None


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_label: int = ROWS_PER_LABEL,
    vocabulary: int = VOCABULARY,
    terms: int = TERMS,
    lists: int = LISTS,
    trust: float = TRUST,
    rounds: int = ROUNDS,
    ridge: float = RIDGE,
    steps: int = STEPS,
) -> Scorer:
    """Learn from the labelled texts that are not held out.

    Without texts of both labels nothing can be told apart: the score of every text then is 0, or
    1 where all labelled texts are toxic.
    """
    sample = sample_of(docs, labels, rows_per_label, id_col, text_col, label_col)
    rows = settle(with_features(sample.repartition(FIT_TASKS, F.xxhash64("text"))))
    seen = {r["toxic"] for r in rows.select("toxic").distinct().collect()}
    if seen != {0, 1}:
        return Scorer({}, 30.0 if seen == {1} else -30.0)
    rated = settle(rated_terms(rows))
    voting = rated.filter("toxic").orderBy(F.desc("evidence"), "term").limit(terms)
    dealt = voter_lists([r["term"] for r in voting.orderBy(F.desc("lift"), "term").collect()], lists)
    known = [r["term"] for r in rated.orderBy(F.desc("evidence"), "term").limit(vocabulary).select("term").collect()]
    voters = 2 * lists + len(PATTERNS)
    shared = docs.sparkSession.sparkContext.broadcast((dealt, {term: i for i, term in enumerate(known)}))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, place = shared.value
        for batch in batches:
            cast = np.zeros((batch.num_rows, voters), bool)
            places = []
            for i, (found, shown) in enumerate(zip(batch.column("features").to_pylist(), batch.column("patterns").to_pylist())):
                cast[i, [listed[f] for f in found if f in listed]] = True
                cast[i, 2 * lists :] = shown
                places.append([place[f] for f in found if f in place])
            columns = [*batch.select(["toxic", "weight"]).columns, pa.array(places, pa.list_(pa.int32())), pa.array(cast.tolist(), pa.list_(pa.bool_()))]
            yield pa.record_batch(columns, names=["toxic", "weight", "places", "votes"])

    votes = settle(rows.mapInArrow(vote, "toxic int, weight double, places array<int>, votes array<boolean>"))
    model = fit_label_model(votes.select("toxic", "weight", "votes"), voters, trust, rounds)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast = batch.column("votes").flatten().to_numpy(zero_copy_only=False).reshape(-1, voters)
            chance = model.posterior(cast, batch.column("toxic").to_numpy())
            yield pa.record_batch([batch.column("places"), batch.column("weight"), pa.array(chance)], names=["places", "weight", "chance"])

    judged = votes.select("toxic", "weight", "places", "votes").mapInArrow(judge, "places array<int>, weight double, chance double")
    line = fit_line(judged, len(known), ridge, steps)
    weights = {term: float(w) for term, w in zip(known, line[:-1]) if abs(w) > 1e-6}
    return Scorer(weights, float(line[-1]), model)


def score_toxicity(docs: DataFrame, scorer: Scorer, text_col: str = "text") -> tuple[DataFrame, str]:
    """The documents with one more column, and its name: the chance (0 to 1) that a whole text is toxic.

    A null or empty text, and one without letters, has the score of a text without known words.
    Rows and other columns stay as they are; the column is called `toxicity`, with underscores
    after it where the frame has one of that name.
    """
    need(docs, text_col)
    name = fresh_name(docs, "toxicity")
    shared = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.intercept))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shared.value
        known: dict[str, float] = {}
        for batch in sliced(batches, text_col):
            text, word, words = distinct_words(batch.column(text_col))
            if len(known) > MOST_KNOWN:
                known.clear()
            of_words = np.zeros(len(words))
            for i, w in enumerate(words):
                value = known.get(w)
                if value is None:
                    value = known[w] = sum(weights.get(f, 0.0) for f in features_of(w))
                of_words[i] = value
            total = intercept + np.bincount(text, of_words[word], batch.num_rows)
            chance = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
            yield pa.record_batch([*batch.columns, pa.array(chance)], names=[*batch.schema.names, name])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])), name


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.3 on): one row per document, repeated rows and null ids too.

    An empty table of documents gives an empty one; empty or one-sided labels as in `fit`.
    """
    scored, name = score_toxicity(docs.select("doc_id", "text"), fit(docs, labels))
    score = F.col(name)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= CUTOFF).cast("int").alias("predicted"))
