"""Shared pieces of the catalogue: table access, rounding, and SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = tuple[Callable[[SparkSession, str], DataFrame], "str | None"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round columns for comparison; adding zero turns -0.0 into 0.0."""
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if c in columns else F.col(c) for c in df.columns])


def r(expression: str, digits: int, name: str) -> str:
    """The same rounding in SQL."""
    return f"round({expression}, {digits}) + 0.0::DOUBLE AS {name}"


def hash_share_sql(key: str) -> str:
    return f"((({key} % 2147483647) * 2654435761) % 4294967296) / 4294967296.0::DOUBLE"


def metrics_sql(source: str, y: str, p: str, keys: list[str], metrics: list[str]) -> str:
    """Long regression metrics of a relation, as a SELECT."""
    by = ", ".join(keys)
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    over = f"PARTITION BY {by}" if by else ""
    each = " UNION ALL ".join(f"SELECT {head}'{m}' AS metric, {m} AS value FROM wide" for m in metrics)
    return f"""(
      WITH c AS (SELECT *, avg({y}) OVER ({over}) AS y_mean FROM {source}),
      wide AS (SELECT {head}avg(({y} - {p}) * ({y} - {p})) AS mse, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse,
        avg(abs({y} - {p})) AS mae, avg(abs({y} - {p}) / greatest(abs({y}), 2.220446049250313e-16)) AS mape,
        1 - sum(({y} - {p}) * ({y} - {p})) / sum(({y} - y_mean) * ({y} - y_mean)) AS r2 FROM c{tail})
      {each})"""


def ks_sql(source: str, keys: list[str], features: list[str], is_ref: str, is_cur: str) -> str:
    """Statistic and limiting p-value per group and feature, as a SELECT."""
    head = "".join(f"{k}, " for k in keys)
    listed = " UNION ALL ".join(
        f"SELECT {head}'{f}' AS feature, CAST({f} AS DOUBLE) AS v, ({is_ref}) AS a, ({is_cur}) AS b FROM {source}" for f in features
    )
    part = f"PARTITION BY {head}feature"
    terms = "list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * lam * lam)))"
    return f"""(
      WITH l AS ({listed}),
      c AS (SELECT {head}feature, v, count(*) FILTER (a) AS na, count(*) FILTER (b) AS nb FROM l WHERE v IS NOT NULL GROUP BY ALL),
      s AS (SELECT *, sum(na) OVER ({part} ORDER BY v) AS ra, sum(nb) OVER ({part} ORDER BY v) AS rb,
        sum(na) OVER ({part}) AS ta, sum(nb) OVER ({part}) AS tb FROM c),
      d AS (SELECT {head}feature, max(ta)::BIGINT AS n_ref, max(tb)::BIGINT AS n_cur, max(abs(ra / ta - rb / tb)) AS statistic
        FROM s GROUP BY ALL),
      z AS (SELECT *, statistic * sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) AS lam FROM d)
      SELECT {head}feature, 'ks' AS kind, n_ref, n_cur, statistic,
        CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * {terms})) END AS p_value FROM z)"""


def chi_square_sql(source: str, keys: list[str], feature: str, is_ref: str, is_cur: str, degrees: int) -> str:
    """Statistic and p-value (even degrees of freedom only) per group, as a SELECT."""
    head = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    terms = " + ".join(["1.0"] + [f"pow(statistic / 2, {i}) / {_factorial(i)}" for i in range(1, degrees // 2)])
    return f"""(
      WITH c AS (SELECT {head}{feature} AS v, count(*) FILTER ({is_ref}) AS na, count(*) FILTER ({is_cur}) AS nb
        FROM {source} GROUP BY ALL),
      t AS (SELECT *, sum(na) OVER ({part}) AS ta, sum(nb) OVER ({part}) AS tb FROM c),
      d AS (SELECT {head}max(ta)::BIGINT AS n_ref, max(tb)::BIGINT AS n_cur,
        sum((nb - na::DOUBLE * tb / ta) * (nb - na::DOUBLE * tb / ta) / (na::DOUBLE * tb / ta)) AS statistic FROM t GROUP BY ALL)
      SELECT {head}'{feature}' AS feature, 'chi_square' AS kind, n_ref, n_cur, statistic,
        exp(-statistic / 2) * ({terms}) AS p_value FROM d)"""


def _factorial(n: int) -> int:
    return 1 if n < 2 else n * _factorial(n - 1)
