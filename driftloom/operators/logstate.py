"""Current state per key from an append-only log of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftloom.functions.attach import attach, same_keys
from driftloom.operators.ordering import number_rows
from driftloom.sources.scratch import settle

# The stages a version may be in, and those an arriving version can clear.
STAGES = ("Production", "Staging", "Archived", "None")
EXCLUSIVE_STAGES = ("Production", "Staging")


def latest_records(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The newest record of every key.

    An aggregate rather than a window: each map task sends one record per key, so a key with a
    third of the log costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order_cols))
    return df.groupBy(*keys).agg(newest.alias("__newest")).select(*keys, "__newest.*").select(*df.columns)


def latest_in_stage(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], stage_col: str, stages: Sequence[str] = ("None",)
) -> DataFrame:
    """The newest record per key and stage, for the requested stages only."""
    return latest_records(df.filter(F.col(stage_col).isin(*stages)), [*keys, stage_col], order_cols)


def _newest_first(keys: Sequence[str], order_cols: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_cols])


def newest_n(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """The n newest records per key with their rank; the limit is applied before the shuffle too."""
    rank = F.row_number().over(_newest_first(keys, order_cols))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def nth_newest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], n: int = 2) -> DataFrame:
    """The n-th newest record per key, where there is one."""
    return newest_n(df, keys, order_cols, n).filter(F.col("rank") == n).drop("rank")


def check_stage(stage: str) -> str:
    """The stage itself, or an error when it is not a known one."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}: must be one of {', '.join(STAGES)}")
    return stage


def fold_stages(
    transitions: DataFrame,
    model_cols: Sequence[str],
    version_cols: Sequence[str],
    order_cols: Sequence[str],
    stage_col: str = "stage",
    archive_existing: bool | Column = False,
    exclusive: Sequence[str] = EXCLUSIVE_STAGES,
) -> DataFrame:
    """Current stage of every version from its log of transitions.

    A version is in the stage of its newest transition. With `archive_existing` (a flag, or a
    column saying so per transition) moving a version into an exclusive stage archives the ones
    already there: a version whose own newest transition is older than such a move of the same
    model into the same stage is archived. A stage that is not among `STAGES` is an error.
    """
    known = F.col(stage_col).isin(*STAGES)
    problem = F.concat(F.lit("unknown stage "), F.coalesce(F.col(stage_col).cast("string"), F.lit("null")))
    transitions = transitions.withColumn(stage_col, F.when(known, F.col(stage_col)).otherwise(F.raise_error(problem)))
    versions, stages = [*model_cols, *version_cols], [*model_cols, stage_col]
    moment = F.struct(*order_cols)
    clears = (archive_existing if isinstance(archive_existing, Column) else F.lit(archive_existing)) & F.col(
        stage_col
    ).isin(*exclusive)
    steps = transitions.groupBy(*versions, stage_col).agg(
        F.max(moment).alias("__last"), F.max(F.when(clears, moment)).alias("__cleared")
    )
    newest_step = F.max(F.struct("__last", "__cleared", stage_col))
    current = steps.groupBy(*versions).agg(newest_step.alias("__s")).select(*versions, f"__s.{stage_col}", "__s.__last")
    # The moment of the last step rides along so that both branches read the same columns of
    # `steps` and share its exchange; a null `__cleared` sorts below every moment.
    newest_clear = F.max(F.struct("__cleared", "__last"))
    cleared = steps.groupBy(*stages).agg(newest_clear.alias("__c")).select(*stages, F.col("__c.__cleared").alias("__cleared"))
    archived = F.col("__last") < F.col("__cleared")
    return attach(current, cleared, stages).select(
        *versions, F.when(archived, F.lit("Archived")).otherwise(F.col(stage_col)).alias("current_stage")
    )


def without_deleted(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], is_delete: Column) -> DataFrame:
    """Newest record per key, leaving out keys whose newest record is a deletion."""
    return latest_records(df, keys, order_cols).filter(~F.coalesce(is_delete, F.lit(False)))


def fold_attributes(
    df: DataFrame, entity_cols: Sequence[str], order_cols: Sequence[str], tag_col: str = "tag", value_col: str = "value"
) -> DataFrame:
    """Last value of every (entity, tag), in long form; records without a tag name are not tags."""
    named = df.filter(F.col(tag_col).isNotNull() & (F.col(tag_col) != ""))
    return latest_records(named.select(*entity_cols, tag_col, value_col, *order_cols), [*entity_cols, tag_col], order_cols).select(
        *entity_cols, tag_col, value_col
    )


def attribute_map(long: DataFrame, entity_cols: Sequence[str], tag_col: str = "tag", value_col: str = "value") -> DataFrame:
    """Long attributes as one map per entity (an entity has few tags)."""
    entries = F.sort_array(F.collect_list(F.struct(tag_col, value_col)))
    return long.groupBy(*entity_cols).agg(F.map_from_entries(entries).alias("attributes"))


def number_versions(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], name: str = "version", most: int | None = None
) -> DataFrame:
    """Version numbers 1, 2, ... per key in log order."""
    return number_rows(df, order_cols, keys, name, most)


def append_versions(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order_cols: Sequence[str], name: str = "version"
) -> DataFrame:
    """New records numbered on from each key's highest existing version."""
    highest = settle(existing.groupBy(*keys).agg(F.max(name).alias("__highest")))
    numbered = attach(number_versions(new, keys, order_cols, name), highest, keys)
    return numbered.select(*new.columns, (F.col(name) + F.coalesce("__highest", F.lit(0))).alias(name))


def promotion_records(
    decisions: DataFrame, current: DataFrame, keys: Sequence[str], version: str = "version", stage_col: str = "stage"
) -> DataFrame:
    """Rows to append to the log of transitions once retraining is decided.

    `decisions` has one `decision` per key, `current` the versions with their `current_stage`.
    Where the decision is `promote`, the versions in Production are archived (`step` 1) and the
    challenger comes next to the highest version, in Production (`step` 2). Other keys give no row.
    """
    hidden = [f"__key_{k}" for k in keys]
    promoted = decisions.filter(F.col("decision") == "promote").select(*keys)
    chosen = promoted.select(*[F.col(k).alias(h) for k, h in zip(keys, hidden)])
    archived = current.filter(F.col("current_stage") == "Production").join(chosen, same_keys(keys, hidden), "left_semi")
    highest = current.groupBy(*keys).agg(F.max(version).alias("__highest"))
    added = attach(promoted, highest, keys).select(
        *keys, (F.coalesce("__highest", F.lit(0)) + 1).alias(version), F.lit("Production").alias(stage_col), F.lit(2).alias("step")
    )
    return archived.select(*keys, version, F.lit("Archived").alias(stage_col), F.lit(1).alias("step")).unionByName(added)
