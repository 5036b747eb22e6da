"""Column references and literals that survive any character."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def literal(text: str) -> str:
    """A string literal; text the SQL parser could read otherwise goes in as bytes."""
    if "'" in text or "\\" in text:
        return f"cast(X'{text.encode().hex()}' as string)"
    return f"'{text}'"
