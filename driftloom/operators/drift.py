"""Two-sample drift tests for every feature of a frame, per segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.functions.attach import attach
from driftloom.functions.cells import HEAVY_CELL, cell_of, part_of, parts_of
from driftloom.functions.pvalues import chi_square_p, ks_p_asymptotic, ks_p_exact
from driftloom.operators.sketches import clean_double
from driftloom.sources.scratch import settle

# Fixed value: the p-value below which a feature counts as drifted.
P_CUTOFF = 0.05
RESULT = ("feature", "kind", "n_ref", "n_cur", "statistic", "p_value", "p_method", "drift_detected", "status")


def is_numeric(kind: T.DataType) -> bool:
    """Numbers (decimals too) and booleans are compared by distribution, all else by category."""
    return isinstance(kind, (T.NumericType, T.BooleanType))


def tag_samples(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two frames stacked into one, marked `is_ref` and `is_cur`."""
    ref = reference.select(*columns, F.lit(True).alias("is_ref"), F.lit(False).alias("is_cur"))
    cur = current.select(*columns, F.lit(False).alias("is_ref"), F.lit(True).alias("is_cur"))
    return ref.unionByName(cur)


def _typed(df: DataFrame, feature: str) -> Column:
    """A numeric feature as a clean double, any other as text."""
    kind = df.schema[feature].dataType
    if isinstance(kind, T.BooleanType):
        return F.col(feature).cast("int").cast("double")
    return clean_double(F.col(feature)) if is_numeric(kind) else F.col(feature).cast("string")


def listed_rows(
    df: DataFrame, features: Sequence[str], is_ref: Column, is_cur: Column, group_cols: Sequence[str] = ()
) -> DataFrame:
    """One row per sampled row and feature: `feature`, its value as `number` or as `text`, and how often each sample has it (`ref`, `cur`)."""
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    pairs = []
    for c in features:
        numeric = is_numeric(df.schema[c].dataType)
        value = _typed(df, c)
        pairs.append(
            F.struct(
                F.lit(c).alias("feature"), (value if numeric else no_number).alias("number"), (no_text if numeric else value).alias("text")
            )
        )
    count = [F.coalesce(x, F.lit(False)).cast("int").cast("bigint").alias(n) for x, n in ((is_ref, "ref"), (is_cur, "cur"))]
    return df.filter(is_ref | is_cur).select(*group_cols, F.inline(F.array(*pairs)), *count)


def count_samples(listed: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Both samples counted per feature and cell of the number axis, or category: the one pass that all tests read.

    Missing values are counted too (as neither), so every feature of every group has a row.
    """
    keys = [*group_cols, "feature"]
    counted = listed.groupBy(*keys, cell_of(F.col("number")).alias("cell"), "text").agg(
        F.sum("ref").alias("ref"), F.sum("cur").alias("cur"), F.min("number").alias("low"), F.max("number").alias("high")
    )
    return settle(counted)


def sample_sizes(counts: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Values per group and feature in each sample."""
    there = F.col("cell").isNotNull() | F.col("text").isNotNull()
    of = [F.coalesce(F.sum(F.when(there, F.col(c))), F.lit(0)).cast("bigint").alias(n) for c, n in (("ref", "n_ref"), ("cur", "n_cur"))]
    return counts.groupBy(*group_cols, "feature").agg(*of)


def _usable(counts: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """The sample sizes of the features with values on both sides."""
    sizes = sample_sizes(counts, group_cols).filter("n_ref > 0 AND n_cur > 0")
    return sizes.withColumnsRenamed({"n_ref": "__n", "n_cur": "__m"})


def _with_untested(counts: DataFrame, features: Sequence[str], tested: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """One row per group and feature with its sample sizes, and the test's columns where it ran."""
    sizes = sample_sizes(counts, group_cols).filter(F.col("feature").isin(*features))
    return attach(sizes, tested, [*group_cols, "feature"])


def ks_statistic(
    listed: DataFrame, counts: DataFrame, features: Sequence[str], group_cols: Sequence[str] = ()
) -> DataFrame:
    """Largest gap between the two empirical distributions of every numeric feature.

    `listed` comes from `listed_rows` (or from stored counts) and `counts` from `count_samples`.
    The gap at a cell's end is known from the counts, and inside a cell it can leave the gap at
    its start by no more than the cell's own shares. Only cells that could beat the largest gap at
    any end are looked into; without one there is no second pass. A heavy one is first cut into
    parts, which are held against the largest gap in the same way. Everything is exact.
    """
    keys = [*group_cols, "feature"]
    usable = _usable(counts, group_cols)
    cells = attach(counts.filter("cell IS NOT NULL").drop("text"), usable, keys, how="inner")

    def gap(r: Column, c: Column) -> Column:
        return r / F.col("__n") - c / F.col("__m")

    def before(column: str, *within: str, by: str) -> Column:
        """Sum of what comes before a row in the order of `by`."""
        order = Window.partitionBy(*keys, *within).orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum(column).over(order) - F.col(column)

    r0, c0, r1, c1 = F.col("__r0"), F.col("__c0"), F.col("__r0") + F.col("ref"), F.col("__c0") + F.col("cur")
    bound, end = F.greatest(F.abs(gap(r1, c0)), F.abs(gap(r0, c1))), F.abs(gap(r1, c1))
    begun = cells.select("*", before("ref", by="cell").alias("__r0"), before("cur", by="cell").alias("__c0"))
    ends = settle(begun.select("*", bound.alias("__bound"), F.max(end).over(Window.partitionBy(*keys)).alias("__reached")))
    reached = ends.groupBy(*keys).agg(F.max("__reached").alias("__reached"))
    inside = [*keys, "cell"]
    open_cells = settle(
        ends.filter("__bound > __reached AND low < high").select(
            *inside, "low", "high", parts_of(F.col("ref") + F.col("cur"), F.col("low"), F.col("high")).alias("__parts"),
            "__n", "__m", "__r0", "__c0", "__reached", (F.col("ref") + F.col("cur")).alias("__size"),
        )
    )
    if open_cells.isEmpty():
        return _with_untested(counts, features, reached.withColumnRenamed("__reached", "statistic"), group_cols)

    part = part_of(F.col("number"), F.col("low"), F.col("high"), F.col("__parts"))
    placed = listed.filter("number IS NOT NULL").select(*keys, "number", "ref", "cur", cell_of(F.col("number")).alias("cell"))
    cut = attach(placed, open_cells.select(*inside, "low", "high", "__parts"), inside, how="inner").withColumn("__part", part)
    where = [*inside, "__part"]
    sums = [F.sum("ref").alias("ref"), F.sum("cur").alias("cur")]
    totals = ["__n", "__m", "__r0", "__c0", "__reached"]

    def parts_begun(per_part: DataFrame) -> DataFrame:
        named = attach(per_part, open_cells.select(*inside, *totals), inside)
        r, c = before("ref", "cell", by="__part"), before("cur", "cell", by="__part")
        return named.withColumns({"__r0": F.col("__r0") + r, "__c0": F.col("__c0") + c})

    more = None
    if not open_cells.filter(F.col("__size") > HEAVY_CELL).isEmpty():
        begun_parts = parts_begun(cut.groupBy(*where).agg(*sums))
        part_ends = settle(begun_parts.select("*", bound.alias("__bound"), end.alias("__end")))
        more = part_ends.groupBy(*keys).agg(F.max("__end").alias("__more"))
        best = attach(part_ends, more, keys)
        kept = settle(best.filter(F.col("__bound") > F.greatest("__reached", "__more")).select(*where, *totals))
        cut = attach(cut, kept.select(*where, F.lit(True).alias("__kept")), where, how="inner")
        values, begun_parts = cut.groupBy(*where, "number").agg(*sums), kept
    else:
        values = settle(cut.groupBy(*where, "number").agg(*sums))
        begun_parts = parts_begun(values.groupBy(*where).agg(*sums)).select(*where, *totals)
    gaps = attach(values, begun_parts, where).select(
        *keys, F.abs(gap(r0 + before("ref", "cell", "__part", by="number") + F.col("ref"), c0 + before("cur", "cell", "__part", by="number") + F.col("cur"))).alias("__gap")
    )
    tested = attach(reached, gaps.groupBy(*keys).agg(F.max("__gap").alias("__gap")), keys)
    if more is not None:
        tested = attach(tested, more, keys)
    found = [c for c in ("__reached", "__gap", "__more") if c in tested.columns]
    return _with_untested(counts, features, tested.select(*keys, F.greatest(*found).alias("statistic")), group_cols)


def chi_square_statistic(counts: DataFrame, features: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Goodness of fit of the current counts to the reference shares of every categorical feature.

    Expected counts are the reference counts scaled to the current total. A category the
    reference lacks makes the statistic infinite.
    """
    keys = [*group_cols, "feature"]
    held = attach(counts.filter("text IS NOT NULL"), _usable(counts, group_cols), keys, how="inner")
    expected = F.col("ref") * F.col("__m").cast("double") / F.col("__n")
    term = F.when(F.col("ref") > 0, F.try_divide(F.pow(F.col("cur") - expected, F.lit(2.0)), expected)).otherwise(F.lit(float("inf")))
    tested = held.groupBy(*keys).agg(F.sum(term).alias("statistic"), (F.count(F.lit(1)) - 1).alias("degrees"))
    return _with_untested(counts, features, tested, group_cols)


def _ks_rows(listed: DataFrame, counts: DataFrame, features: Sequence[str], group_cols: Sequence[str], method: str) -> DataFrame:
    """Result rows of the Kolmogorov-Smirnov test."""
    keys = [*group_cols, "feature"]
    if method not in ("asymptotic", "exact"):
        raise ValueError(f"method must be 'exact' or 'asymptotic', not {method!r}")
    stats = ks_statistic(listed, counts, features, group_cols)
    series = ks_p_asymptotic(F.col("statistic"), F.col("n_ref"), F.col("n_cur"))
    if method == "asymptotic":
        exact = F.lit(None).cast("double")
    else:
        # A few rows whose work is large: dealt out, or they would meet in one task.
        stats = stats.repartition(*keys)
        exact = ks_p_exact("statistic", "n_ref", "n_cur")
    tested = stats.select("*", exact.alias("__exact"))
    return tested.select(
        *keys,
        F.lit("ks").alias("kind"),
        "n_ref",
        "n_cur",
        "statistic",
        F.coalesce("__exact", series).alias("p_value"),
        F.when(F.col("statistic").isNull(), None)
        .when(F.col("__exact").isNotNull(), F.lit("exact"))
        .otherwise(F.lit("asymptotic"))
        .alias("p_method"),
    )


def _chi_square_rows(counts: DataFrame, features: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """Result rows of the chi-square test."""
    return chi_square_statistic(counts, features, group_cols).select(
        *group_cols,
        "feature",
        F.lit("chi_square").alias("kind"),
        "n_ref",
        "n_cur",
        "statistic",
        chi_square_p("statistic", "degrees").alias("p_value"),
        F.when(F.col("statistic").isNotNull() & (F.col("degrees") > 0), F.lit("chi_square")).alias("p_method"),
    )


def ks_test(
    df: DataFrame,
    features: Sequence[str],
    is_ref: Column,
    is_cur: Column,
    group_cols: Sequence[str] = (),
    method: str = "asymptotic",
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test of numeric features.

    `method="exact"` uses the distribution over all interleavings, whose work grows with the
    product of the samples' sizes; `"asymptotic"` the limiting series, made for large samples.
    Each holds at every size.
    """
    listed = listed_rows(df, features, is_ref, is_cur, group_cols)
    return _ks_rows(listed, count_samples(listed, group_cols), features, group_cols, method)


def chi_square_test(
    df: DataFrame, features: Sequence[str], is_ref: Column, is_cur: Column, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Chi-square goodness-of-fit test of categorical features."""
    return _chi_square_rows(count_samples(listed_rows(df, features, is_ref, is_cur, group_cols), group_cols), features, group_cols)


def drift_of_counts(
    listed: DataFrame, numeric: Sequence[str], categorical: Sequence[str], group_cols: Sequence[str] = (), cutoff: float = P_CUTOFF, method: str = "asymptotic"
) -> DataFrame:
    """The test of every feature from rows as `listed_rows` makes them, counted once."""
    keys = list(group_cols)
    counts = count_samples(listed, keys)
    parts = []
    if numeric:
        parts.append(_ks_rows(listed, counts, numeric, keys, method))
    if categorical:
        parts.append(_chi_square_rows(counts, categorical, keys))
    tested = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return tested.select(
        *keys,
        *RESULT[:-2],
        F.coalesce(F.col("p_value") < cutoff, F.lit(False)).alias("drift_detected"),
        F.when((F.col("n_ref") == 0) | (F.col("n_cur") == 0), F.lit("empty")).otherwise(F.lit("ok")).alias("status"),
    )


def feature_drift(
    df: DataFrame,
    is_ref: Column,
    is_cur: Column,
    features: Sequence[str] | None = None,
    group_cols: Sequence[str] = (),
    cutoff: float = P_CUTOFF,
    method: str = "asymptotic",
) -> DataFrame:
    """One row per segment and feature: which test, its result, and whether it shows drift.

    Samples are given as conditions on one frame, so a row may belong to both. A requested
    feature the frame lacks gets status `missing`; one without values on either side `empty`.
    """
    keys = list(group_cols)
    if features is None:
        features = [c for c in df.columns if c not in {*keys, "is_ref", "is_cur"}]
    present = [c for c in features if c in df.columns]
    numeric = [c for c in present if is_numeric(df.schema[c].dataType)]
    categorical = [c for c in present if c not in numeric]
    if not present:
        raise ValueError("none of the features is in the frame")
    result = drift_of_counts(listed_rows(df, present, is_ref, is_cur, keys), numeric, categorical, keys, cutoff, method)
    missing = [c for c in features if c not in present]
    if missing:
        result = result.unionByName(_missing_rows(df, missing, is_ref | is_cur, keys, result.schema))
    return result


def _missing_rows(df: DataFrame, missing: Sequence[str], sampled: Column, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    segments = df.filter(sampled).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    named = segments.select(*keys, F.explode(F.array(*[F.lit(c) for c in missing])).alias("feature"))
    filled = {"status": F.lit("missing"), "drift_detected": F.lit(False)}
    return named.select(
        *keys,
        "feature",
        *[filled.get(c, F.lit(None)).cast(schema[c].dataType).alias(c) for c in RESULT if c != "feature"],
    )


def feature_drift_between(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] | None = None,
    group_cols: Sequence[str] = (),
    cutoff: float = P_CUTOFF,
    method: str = "asymptotic",
) -> DataFrame:
    """`feature_drift` for two separate frames; types are taken from the reference."""
    wanted = list(features) if features is not None else [c for c in reference.columns if c not in group_cols]
    shared = [c for c in wanted if c in reference.columns and c in current.columns]
    typed = current.select(*group_cols, *[F.col(c).cast(reference.schema[c].dataType).alias(c) for c in shared])
    both = tag_samples(reference, typed, [*group_cols, *shared])
    return feature_drift(both, F.col("is_ref"), F.col("is_cur"), wanted, group_cols, cutoff, method)


def drift_summary(drift: DataFrame, group_cols: Sequence[str] = (), prediction: str | None = None) -> DataFrame:
    """Per segment: any drift, and the sorted names of the drifted features.

    When `prediction` names one of the tested columns, its drift is reported apart from the
    features', as `anomaly_detected`.
    """
    is_feature = F.lit(True) if prediction is None else F.col("feature") != prediction
    drifted = F.col("drift_detected") & is_feature
    aggregates = [
        F.bool_or(drifted).alias("drift_detected"),
        F.sort_array(F.collect_list(F.when(drifted, F.col("feature")))).alias("drifted_features"),
    ]
    if prediction is not None:
        aggregates.append(F.bool_or(F.col("drift_detected") & ~is_feature).alias("anomaly_detected"))
    return drift.groupBy(*group_cols).agg(*aggregates)
