"""Language identification with a string kernel.

A text's grams are its runs of one to three characters over a small alphabet (letters a-z
folded, every byte outside ASCII for itself, all else one boundary sign). The kernel of two
texts is the number of grams present in both, divided by the root of the product of their
numbers of grams: the blended-spectrum presence kernel. It counts the grams of the landmark
texts; others tell nothing about them.

The classifier is kernel ridge regression, one language against the rest, on Nystroem features:
landmarks are a few texts of each language, and their kernel matrix to the power -1/2 maps a
text's kernel values to features. A text's scores are its presence vector times the landmarks'
presence matrix times the weights; the last two are multiplied once, and texts are scored in
batches with one matrix product each.

Only the fit is on a sample: at most `rows_per_language` labelled texts of each language and
`landmarks` texts in all, chosen by a hash of the document's id. Both bounds are parameters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.llm.common import fresh_name, need, sliced, text_bytes
from driftloom.sources.scratch import settle

ROWS_PER_LANGUAGE = 512
LANDMARKS = 256
RIDGE = 1e-3
UNKNOWN = "und"
ALPHABET = 155
_CODES = bytes(
    c - 0x60 if 0x61 <= c <= 0x7A else c - 0x40 if 0x41 <= c <= 0x5A else c - 0x80 + 27 if c >= 0x80 else 0 for c in range(256)
)
GRAMS = ALPHABET + ALPHABET**2 + ALPHABET**3
TEXTS_AT_ONCE = 64


def held_out(doc_id: Column) -> Column:
    """Documents that are never learnt from: crc32 of the id as text leaves 2 when divided by 4. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def gram_codes(coded: np.ndarray) -> np.ndarray:
    """The grams of one text as numbers below GRAMS, repeats included."""
    one = coded.astype(np.int32)
    two = one[:-1] * ALPHABET + one[1:]
    three = two[:-1] * ALPHABET + one[2:]
    return np.concatenate((one, two + ALPHABET, three + (ALPHABET + ALPHABET**2)))


def presence(column: pa.Array, place: np.ndarray, width: int) -> np.ndarray:
    """One row per text, with 1 where a landmark gram occurs in it. `place` gives a gram's column, or `width` for none."""
    raw, offsets = text_bytes(column)
    coded = np.frombuffer(raw.translate(_CODES), np.uint8)
    out = np.zeros((len(column), width + 1), np.uint8)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for c in range(a, b, 1 << 20):  # a long text in pieces that overlap by two characters
            out[i, place[gram_codes(coded[c : min(b, c + (1 << 20) + 2)])]] = 1
    return out[:, :width]


def has_letter(text: str | None) -> bool:
    """Whether a text holds a letter of any script."""
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Classifier:
    """`grams` are the landmark grams in order; `weights` has a row per gram and a column per language."""

    languages: list[str]
    grams: np.ndarray
    weights: np.ndarray

    def place(self) -> np.ndarray:
        out = np.full(GRAMS, len(self.grams), np.int32)
        out[self.grams] = np.arange(len(self.grams), dtype=np.int32)
        return out

    def scores(self, seen: np.ndarray) -> np.ndarray:
        size = np.maximum(1, seen.sum(axis=1, dtype=np.int64))
        return seen.astype(np.float32) @ self.weights / np.sqrt(size)[:, None]


def training_sample(docs: DataFrame, rows_per_language: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """id, text, lang and rank of the sampled rows. Languages' counts go through the driver, a number for each."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(~held_out(F.col("id")) & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return rows.limit(0).withColumn("rank", F.lit(1))
    # A third more than wanted by hash, then exactly the first by rank: only the sample is ordered.
    scale = 1 << 30
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(scale, int(scale * 4 / 3 * (rows_per_language + 32) / n) + 1))])
    mixed = F.xxhash64(F.lit("sample"), F.col("id"))
    sample = rows.filter(F.pmod(mixed, F.lit(scale)) < share[F.col("lang")]).filter(F.col("text").isNotNull())
    order = Window.partitionBy("lang").orderBy(mixed, "id", F.xxhash64("text"))
    return sample.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rows_per_language)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    landmarks: int = LANDMARKS,
    ridge: float = RIDGE,
) -> Classifier:
    """Learn from the labelled rows that are not held out. Without any, the classifier knows no language."""
    sample = settle(training_sample(docs, rows_per_language, id_col, text_col, lang_col))
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not languages:
        return Classifier([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32))
    each = max(4, landmarks // len(languages))

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            raw, offsets = text_bytes(batch.column("text"))
            coded = np.frombuffer(raw.translate(_CODES), np.uint8)
            found = [np.unique(gram_codes(coded[a:b])).astype(np.int32).tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.record_batch([pa.array(found, pa.binary())], names=["grams"])

    chosen = sample.filter(F.col("rank") <= each).orderBy("lang", "rank").select("text")
    sets = [np.frombuffer(bytes(r["grams"]), np.int32) for r in chosen.mapInArrow(grams_of, "grams binary").collect()]
    sets = [s for s in sets if len(s)]
    grams = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.int32)
    marks = np.zeros((len(sets), len(grams)), np.float32)
    for row, own in zip(marks, sets):
        row[np.searchsorted(grams, own)] = 1
    marks /= np.sqrt(np.maximum(1, marks.sum(axis=1)))[:, None]
    kernel = marks.astype(np.float64) @ marks.T.astype(np.float64)
    values, vectors = np.linalg.eigh(kernel)
    good = values > 1e-6 * max(1e-12, values[-1] if len(values) else 0)
    root = vectors[:, good] / np.sqrt(values[good])

    shared = sample.sparkSession.sparkContext.broadcast((languages, grams, marks, root))
    width, n_lang = root.shape[1], len(languages)

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, root = shared.value
        known = Classifier(*parts)
        place, gram, aim, n = known.place(), np.zeros((width, width)), np.zeros((width, n_lang)), 0
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(i, TEXTS_AT_ONCE)
                seen = presence(some.column("text"), place, len(known.grams)).astype(np.float32)
                features = seen @ known.weights.T / np.sqrt(np.maximum(1, seen.sum(axis=1)))[:, None] @ root
                lang = some.column("lang").to_pylist()
                target = np.where(np.array(lang)[:, None] == np.array(known.languages)[None, :], 1.0, -1.0)
                gram += features.T @ features
                aim += features.T @ target
                n += len(lang)
        yield pa.record_batch([pa.array([np.hstack((gram, aim)).tobytes()], pa.binary()), pa.array([n])], names=["sums", "n"])

    parts = sample.select("text", "lang").repartition(8).mapInArrow(sums_of, "sums binary, n long").collect()
    sums = sum(np.frombuffer(bytes(p["sums"])).reshape(width, width + n_lang) for p in parts)
    n = max(1, sum(p["n"] for p in parts))
    beta = np.linalg.solve(sums[:, :width] + ridge * n * np.eye(width), sums[:, width:])
    return Classifier(languages, grams, (marks.T.astype(np.float64) @ (root @ beta)).astype(np.float32))


def predict(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> tuple[DataFrame, str]:
    """The documents with one more column, and its name: `lang` and `score` of every whole text.

    A null text, or one without a letter, is `und` with score 0, and so is every text where
    nothing was learnt; ties go to the language that comes first in order. Rows and other
    columns stay as they are; the new column is called `language`, with underscores after it
    where the frame has one of that name.
    """
    need(docs, text_col)
    name = fresh_name(docs, "language")
    shared = docs.sparkSession.sparkContext.broadcast((classifier.languages, classifier.grams, classifier.weights))
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Classifier(*shared.value)
        place = known.place()
        for batch in sliced(batches, text_col):
            for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(i, TEXTS_AT_ONCE)
                column = some.column(text_col)
                letters = np.array([has_letter(t) for t in column.to_pylist()])
                langs, scores = np.full(len(column), UNKNOWN, object), np.zeros(len(column))
                if known.languages:
                    values = known.scores(presence(column, place, len(known.grams)))
                    langs = np.where(letters, np.array(known.languages, object)[values.argmax(axis=1)], UNKNOWN)
                    scores = np.where(letters, np.clip((values.max(axis=1) + 1) / 2, 0, 1), 0.0)
                found = pa.StructArray.from_arrays([pa.array(langs.tolist(), pa.string()), pa.array(scores.astype(float))], fields=list(kind))
                yield pa.record_batch([*some.columns, found], names=[*some.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string("struct<lang:string,score:double>"))])
    return docs.mapInArrow(score, schema), name


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per document."""
    marked, name = predict(docs.select("doc_id", "text"), fit(docs))
    return marked.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(name)["lang"].alias("lang_pred"), F.col(name)["score"].alias("score"))


def with_known_language(docs: DataFrame) -> DataFrame:
    """The documents whose language is known, with their own columns; `und` is rejected."""
    marked, name = predict(docs, fit(docs))
    return marked.filter(F.col(name)["lang"] != UNKNOWN).select(*docs.columns)
