"""Spelling variants: words one edit apart, the usual form of each and the root it leads to.

Near words are found with asymmetric q-chunks. A word of L code points contributes two disjoint
chunks, its halves; every other word the grams of the chunks' lengths. One inserted, deleted or
replaced code point leaves a half whole, and that half stands in the other word at most one place
off: the first half at the same distance from the start, the second at the same distance from the
end. So the only grams a word has to offer are, for each length one less, equal or one more, the
one at its start and the one at its end. Chunks and grams meet in an equality join, and the
distance of every pair that meets is verified.

A half that very many words share (`most_grams`) would pair all of them. There the rest of the
word joins the key: a word's rest with one code point left out, which two rests one edit apart
have in common. Then only near words meet, however many words share the half, and none is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.attach import attach
from driftloom.llm.common import need
from driftloom.sources.scratch import settle

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_POINTS = 7
LEAST_COUNT = 2
RATIO = 10
MOST_GRAMS = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_points: int = 1) -> DataFrame:
    """`id` (as text) and `run` of every run of letters of whole texts, from `least_points` code points on, A-Z lower-cased.

    Repeats are kept. A null text has no runs; rows with the same id, or none, each give theirs.
    """
    need(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    long = rows.filter(F.char_length("run") >= least_points)
    plain = F.octet_length("run") == F.char_length("run")
    return long.select("id", F.when(plain, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("run"))


def misspelt(runs: DataFrame) -> DataFrame:
    """`word`: the runs, with code point number h % length left out where 31 divides h, the crc32 of `<id>:<run>`. Without an id a run stays."""
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    hashed = runs.select("run", h.alias("__h"), F.char_length("run").alias("__n"))
    at = (F.col("__h") % F.col("__n")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("__n")))
    return hashed.select(F.when(F.col("__h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))


def count_words(words: DataFrame, least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT) -> DataFrame:
    """`word` and its number of occurrences `n`, for the words that are long and frequent enough. Null is no word."""
    counted = words.filter(F.char_length("word") >= least_points).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def _chunks(words: DataFrame) -> DataFrame:
    """Two rows a word: its length, a half (`side` 0 or 1) and the rest."""
    half, size = _half(F.col("size")), F.col("size")
    first, second = F.substring("word", F.lit(1), half), F.substring("word", half + 1, size)
    sides = F.array(
        F.struct(F.lit(0).alias("side"), first.alias("part"), second.alias("rest")),
        F.struct(F.lit(1).alias("side"), second.alias("part"), first.alias("rest")),
    )
    return words.select("word", "n", "size", F.inline(sides))


def _grams(words: DataFrame) -> DataFrame:
    """Six rows a word: for each `size` a near word can have, its gram at the start and at the end, and the rest."""
    own = F.char_length("near")
    sized = words.select(F.col("word").alias("near"), F.col("n").alias("near_n")).select(
        "near", "near_n", F.explode(F.array(own - 1, own, own + 1)).alias("size")
    )
    half, size = _half(F.col("size")), F.col("size")
    later = half + own - size
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.substring("near", F.lit(1), half).alias("part"), F.substring("near", half + 1, own).alias("rest")),
        F.struct(F.lit(1).alias("side"), F.substring("near", later + 1, own).alias("part"), F.substring("near", F.lit(1), later).alias("rest")),
    )
    return sized.select("near", "near_n", "size", F.inline(sides))


def _without_one(text: Column) -> Column:
    """The text with its code point 0, 1, ... left out, as an array."""
    size = F.char_length(text)
    every = F.transform(
        F.sequence(F.lit(1), size), lambda i: F.concat(F.substring(text, F.lit(1), (i - 1).cast("int")), F.substring(text, (i + 1).cast("int"), size))
    )
    return F.when(size > 0, every).otherwise(F.array().cast("array<string>"))


def _meeting(kind: str, variants: Column, numbered: bool = False) -> Column:
    """The variants as structs of a kind, a place (0 unless numbered) and a text."""
    return F.transform(
        variants if numbered else F.array_distinct(variants),
        lambda v, i: F.struct(F.lit(kind).alias("kind"), (i if numbered else F.lit(0)).alias("place"), v.alias("left_over")),
    )


def near_words(words: DataFrame, most_grams: int = MOST_GRAMS) -> DataFrame:
    """`word`, `n`, `near`, `near_n`: every pair of different words one edit apart, from both sides, once each.

    `words` has distinct words and their counts. Order of rows and layout do not matter; an
    empty frame has no pairs. Words of one code point or none meet nothing.
    """
    need(words, "word", "n")
    key = ["size", "side", "part"]
    sized = words.filter(F.char_length("word") > 1).withColumn("size", F.char_length("word"))
    chunks, grams = _chunks(sized), _grams(sized)
    crowded = settle(grams.groupBy(*key).agg(F.count(F.lit(1)).alias("__grams")).filter(F.col("__grams") > most_grams))
    chunks, grams = attach(chunks, crowded, key), attach(grams, crowded, key)
    free = F.col("__grams").isNull()

    def sides(left: DataFrame, right: DataFrame, more: list[str]) -> DataFrame:
        named = right.select("near", "near_n", *[F.col(c).alias(f"__{c}") for c in (*key, *more)])
        return left.join(named, [F.col(c) == F.col(f"__{c}") for c in (*key, *more)])

    # A pair whose halves both agree is found by the first half.
    both = (F.col("side") == 1) & (F.substring("near", F.lit(1), _half(F.col("size"))) == F.col("rest"))
    plain = sides(chunks.filter(free), grams.filter(free), []).filter((F.levenshtein("word", "near", 1) == 1) & ~both)

    rest, longer = F.col("rest"), F.char_length("near") - F.col("size")
    replaced = _meeting("replaced", _without_one(rest), numbered=True)
    whole, shorter = F.array(rest), _without_one(rest)
    asked = F.concat(replaced, _meeting("more", whole), _meeting("less", shorter))
    offered = F.when(longer == 0, replaced).when(longer == 1, _meeting("more", shorter)).otherwise(_meeting("less", whole))
    dense = sides(
        chunks.filter(~free).select("word", "n", *key, "rest", F.inline(asked)),
        grams.filter(~free).select("near", "near_n", *key, F.inline(offered)),
        ["kind", "place", "left_over"],
    ).filter((F.col("word") != F.col("near")) & ~both)
    return plain.select("word", "n", "near", "near_n").unionByName(dense.select("word", "n", "near", "near_n"))


def last_forms(links: DataFrame) -> DataFrame:
    """`word` and `root` of every word with a form: where its chain of forms ends.

    Each round doubles the reach of every link; a form has a multiple of the word's count, so
    chains are as short as the counts' number of digits. Rounds are written tables.
    """
    current = settle(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = current.select(F.col("word").alias("__at"), F.col("root").alias("__root"))
        stepped = current.join(ahead, F.col("root") == F.col("__at"), "left")
        current = settle(stepped.select("word", F.coalesce("__root", "root").alias("root"), F.col("__root").isNotNull().alias("moved")))
        if current.filter("moved").isEmpty():
            return current.select("word", "root")
        current = current.select("word", "root")


def spelling_forms(words: DataFrame, ratio: int = RATIO, most_grams: int = MOST_GRAMS) -> DataFrame:
    """Per word its `form`, `root`, count `n`, number of near words `n_near` and the form's count `form_n`.

    The form is the near word of largest count (ties: the smallest in code-point order) if that
    count is at least `ratio` times the word's, else null; the root is where forms lead, the word
    itself without one. `words` has distinct words and counts; an empty frame gives an empty one.
    """
    words = settle(words.select("word", "n"))
    pairs = near_words(words, most_grams)
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near")))
    nearest = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("__best"))
    usual = F.col("n") * ratio <= -F.col("__best")["rank"]
    formed = settle(
        attach(words, nearest, ["word"]).select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(usual, F.col("__best")["near"]).alias("form"),
            F.when(usual, -F.col("__best")["rank"]).alias("form_n"),
        )
    )
    roots = last_forms(formed.filter("form IS NOT NULL"))
    return attach(formed, roots, ["word"]).select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_report(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words that `misspelt` makes of all texts.

    Null and empty texts, and an empty table, have no words; repeated rows count again.
    """
    runs = word_runs(docs, least_points=LEAST_POINTS)
    return spelling_forms(count_words(misspelt(runs)))
