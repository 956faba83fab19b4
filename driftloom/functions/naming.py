"""Names of tables and of the generated feature columns."""

from __future__ import annotations

from collections.abc import Sequence

# Output column names that callers of the feature table rely on.
DATE = "data"
WEEK = "semana"
MONTH = "mes"


def week_total(c: str) -> str:
    return f"{c}_semana"


def month_total(c: str) -> str:
    return f"{c}_mes"


def week_lag(c: str, k: int) -> str:
    return f"{c}_semana_lag{k}w"


def month_lag(c: str, k: int) -> str:
    return f"{c}_mes_lag{k}m"


def qualified(*parts: str) -> str:
    """Dotted table name with every part back-quoted; empty parts are left out."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts if p)


def table_name(name: str | Sequence[str]) -> str:
    """A table's name as SQL takes it: text as it is, the parts of a name (catalog, schema, table) quoted and joined."""
    return name if isinstance(name, str) else qualified(*name)
