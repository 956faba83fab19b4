"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power `alpha`, normalised. The exponent is
found by bisection, so that the weights' entropy reaches a target, or no source is repeated more
often than a limit; sums over sources come from Spark, a few exponents at a time, and the list
of sources never goes to the driver.

A source's budget is its weight of the whole budget. It is realised as passes over the source's
documents, each in the order of a keyed hash: whole passes, and a last one that ends where the
budget does. To find that place, tokens are summed in about the root of n blocks of the
permuted source, and only the block in which the budget ends is ordered. The mixture's blocks
then take from all sources alike: a document's place in the mixture is its place in the passes
of its source, as a share of them all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftloom.functions.attach import attach
from driftloom.llm.common import need
from driftloom.sources.scratch import settle

#: No source is repeated more often than this, against none being seen less than once.
MOST_REPEATS = 1.5
BLOCK_TOKENS = 1 << 20
SEED = 7
SPREAD = 1 << 40
MOST_BLOCKS = 1 << 20
#: Exponents tried in one pass over the sources, and passes; together about 2^-30 of the range.
AT_ONCE, PASSES = 32, 6


def word_count(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _hash(doc_id: Column, *salt: object) -> Column:
    return F.pmod(F.xxhash64(*[F.lit(x) for x in salt], doc_id), F.lit(SPREAD))


def _measures(sources: DataFrame, alphas: list[float]) -> list[dict[str, float]]:
    """For each exponent: entropy of the weights (nats), sum of powers, and the largest and smallest share."""
    p = F.col("share")
    sums = [F.sum(F.pow(p, F.lit(a))).alias(f"z{i}") for i, a in enumerate(alphas)]
    sums += [F.sum(F.pow(p, F.lit(a)) * F.ln(p)).alias(f"s{i}") for i, a in enumerate(alphas)]
    row = sources.filter("share > 0").agg(F.min(p).alias("least"), F.max(p).alias("most"), *sums).first()
    out = []
    for i, a in enumerate(alphas):
        z, s = row[f"z{i}"], row[f"s{i}"]
        out.append({"alpha": a, "z": z, "entropy": math.log(z) - a * s / z, "least": row["least"], "most": row["most"]})
    return out


def repeats(m: dict[str, float], budget_share: float | None) -> float:
    """Passes over the most repeated source; the budget is a share of all tokens, or what shows each source once (None)."""
    budget = m["most"] ** (1 - m["alpha"]) * m["z"] if budget_share is None else budget_share
    return budget * m["least"] ** (m["alpha"] - 1) / m["z"]


def find_exponent(sources: DataFrame, target_entropy: float | None, most_repeats: float | None, budget_share: float | None) -> dict[str, float]:
    """The largest exponent of 0 to 1 whose entropy reaches the target, or else the smallest that keeps within the repeats.

    Entropy falls and repeats fall as the exponent grows to 1. Where even 0 misses the target it
    is 0; where even 1 repeats too often it is 1.
    """
    if (target_entropy is None) == (most_repeats is None):
        raise ValueError("give either a target entropy or a limit of repeats")

    def high_side(m: dict[str, float]) -> bool:
        """Whether the wanted exponent is at most this one."""
        return m["entropy"] < target_entropy if target_entropy is not None else repeats(m, budget_share) <= most_repeats

    low, high = 0.0, 1.0
    for _ in range(PASSES):
        step = (high - low) / AT_ONCE
        tried = _measures(sources, [low + step * i for i in range(AT_ONCE + 1)])
        first = next((i for i, m in enumerate(tried) if high_side(m)), len(tried))
        if first == 0:
            return tried[0]
        if first == len(tried):
            return tried[-1]
        best = tried[first - 1] if target_entropy is not None else tried[first]
        low, high = tried[first - 1]["alpha"], tried[first]["alpha"]
    return best


def mixture(
    docs: DataFrame,
    counts: DataFrame | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    target_entropy: float | None = None,
    most_repeats: float | None = MOST_REPEATS,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """Every document as often as the mixture takes it: the frame's columns, and a struct `mix`.

    `mix` holds `epoch` (from 0), `epochs` (passes over its source, a fraction), `weight` (the
    source's), `block` of the mixture and `slot`, its order there. With no `budget` (in tokens),
    it is the least that shows every document once, and none is left out. A null source is a
    source of its own. Documents without words cost nothing and come once; so do those of a
    source that has no words at all. Rows that share an id stand together in the order and are
    taken or left together. An empty table gives an empty result. A column called `mix` in the
    frame is refused.
    """
    need(docs, id_col, source_col, text_col)
    if "mix" in docs.columns:
        raise ValueError("the frame has a column mix")
    slim = counts if counts is not None else settle(docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("tokens")))
    totals = settle(slim.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("n_docs")))
    every = totals.agg(F.sum("total")).first()[0] or 0
    if not every:
        mix = F.struct(F.lit(0).alias("epoch"), F.lit(1.0).alias("epochs"), F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("block"), F.xxhash64(F.lit(seed), id_col).alias("slot"))
        return docs.withColumn("mix", mix)
    sources = totals.withColumn("share", F.col("total") / F.lit(every))
    found = find_exponent(sources, target_entropy, most_repeats, None if budget is None else budget / every)
    alpha, z = found["alpha"], found["z"]
    whole = budget if budget is not None else every * found["most"] ** (1 - alpha) * z
    weight = F.when(F.col("share") > 0, F.pow("share", F.lit(alpha)) / F.lit(z)).otherwise(0.0)
    epochs = F.when(F.col("total") > 0, F.lit(float(whole)) * F.col("weight") / F.col("total")).otherwise(1.0)
    # A number within a billionth of a whole one is that one: the largest source is to come once, not 0.9999 times.
    epochs = F.when(F.abs(epochs - F.round(epochs)) < 1e-9, F.round(epochs)).otherwise(epochs)
    planned = sources.withColumn("weight", weight).withColumn("epochs", epochs).withColumn("passes", F.floor("epochs").cast("int"))
    planned = planned.withColumn("left", (F.col("epochs") - F.col("passes")) * F.col("total"))
    planned = planned.withColumn("parts", F.least(F.lit(MOST_BLOCKS), F.ceil(F.sqrt("n_docs"))).cast("long"))

    # Where the last pass of each source ends: block sums first, then the order inside one block.
    part = F.floor(F.col("u") * F.col("parts") / F.lit(SPREAD)).cast("long")
    last = attach(slim.withColumn("u", _hash(F.col("id"), seed)), settle(planned.select("source", "parts", "left")), ["source"]).withColumn("part", part)
    sums = settle(last.groupBy("source", "part", "parts", "left").agg(F.sum("tokens").alias("held")))
    order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("held").over(order))
    ends = settle(sums.filter("upto > left AND upto - held <= left").select("source", "part", (F.col("left") - F.col("upto") + F.col("held")).alias("room")))
    inside = attach(last.select("source", "part", "u", "tokens"), ends, ["source", "part"], how="inner")
    ordered = Window.partitionBy("source", "part").orderBy("u").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    taken = inside.withColumn("upto", F.sum("tokens").over(ordered)).filter("upto <= room").groupBy("source").agg(F.max("u").alias("taken"))
    facts = attach(attach(planned, ends.select("source", "part"), ["source"]), taken, ["source"])
    start = F.ceil(F.col("part") * F.lit(SPREAD) / F.col("parts")).cast("long")
    cut = F.when(F.col("part").isNull(), F.lit(SPREAD)).otherwise(F.coalesce("taken", start - 1))
    facts = settle(facts.select(F.col("source").alias(source_col), "epochs", "weight", "passes", cut.alias("cut"), (F.col("left") > 0).alias("partial")))

    names = {c: f"__mix_{c}" for c in ("epochs", "weight", "passes", "cut", "partial")}
    known = attach(docs, facts.withColumnsRenamed(names), [source_col])
    u = _hash(F.col(id_col), seed)
    of = {c: F.col(n) for c, n in names.items()}
    taken_now = of["passes"] + F.when(of["partial"] & (u <= of["cut"]), 1).otherwise(0)
    once = F.sequence(F.lit(0), F.greatest(taken_now, F.lit(1)) - 1)
    passes = F.filter(once, lambda k: k < taken_now)
    shown = known.withColumn("__mix_epoch", F.explode(passes))
    blocks = max(1, math.ceil(whole / block_tokens))
    place = (F.col("__mix_epoch") + u / F.lit(SPREAD)) / F.greatest(of["epochs"], F.col("__mix_epoch") + u / F.lit(SPREAD) + F.lit(1e-12))
    mix = F.struct(
        F.col("__mix_epoch").alias("epoch"),
        of["epochs"].alias("epochs"),
        of["weight"].alias("weight"),
        F.least(F.floor(place * blocks).cast("long"), F.lit(blocks - 1)).alias("block"),
        F.xxhash64(F.lit(seed), F.col("__mix_epoch"), F.col(id_col)).alias("slot"),
    )
    return shown.select(*docs.columns, mix.alias("mix"))


def mixture_report(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens, epoch, weight, mix_block, slot: one row for each time a document is taken."""
    counted = settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("n_tokens")))
    counts = counted.select("source", F.col("doc_id").alias("id"), F.col("n_tokens").alias("tokens"))
    rows = mixture(counted.withColumn("text", F.lit(None).cast("string")), counts)
    return rows.select("doc_id", "source", "n_tokens", "mix.epoch", "mix.weight", F.col("mix.block").alias("mix_block"), "mix.slot")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents as often as the mixture takes them, with their own columns."""
    return mixture(docs).select(*docs.columns)
