"""Names of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that no column of the table has, whatever its case."""
    taken, out = {x.lower() for x in df.columns}, []
    for name in wanted:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column's name as an expression."""
    return "`" + name.replace("`", "``") + "`"
