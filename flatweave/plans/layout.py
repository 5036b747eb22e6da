"""The flat layout: which columns a table becomes, decided before any row is read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flatweave.operators.census import FLATTENABLE
from flatweave.plans.policy import resolve_fill, resolve_policies, resolve_tags, slots_for


@dataclass(frozen=True)
class FlatColumn:
    """One source column and the number of flat columns it makes."""
    name: str
    category: str
    data_type: T.DataType
    width: int
    longest: int

    @property
    def element_type(self) -> T.DataType:
        return self.data_type.elementType if self.category != "scalar" else self.data_type

    @property
    def names(self) -> list[str]:
        if self.category == "jagged":
            return [f"{self.name}_{j}" for j in range(self.width)]
        return [self.name]


@dataclass(frozen=True)
class FlatLayout:
    tags: dict[str, int]
    columns: list[FlatColumn]
    dropped: list[str]
    fill: float | str
    names: list[str] = field(init=False)

    def __post_init__(self):
        names = list(self.tags) + [n for c in self.columns for n in c.names]
        if len(set(names)) < len(names):
            seen, clashes = set(), set()
            for n in names:
                (clashes if n in seen else seen).add(n)
            raise ValueError(f"flat column names clash: {sorted(clashes)}")
        object.__setattr__(self, "names", names)

    @property
    def n_columns(self) -> int:
        return len(self.names)


def flat_layout(schema: T.StructType, census: Iterable[Mapping], *,
                policies: Mapping[str, str] | DataFrame | None = None,
                tags: Mapping[str, int] | Iterable[str] | None = None,
                fill: float | str | None = None) -> FlatLayout:
    """Lay out a flat table from census rows (anything indexable by field name).

    Tags come first, then every flattenable column in plain name order. Policies
    apply to jagged columns only; of the stored census the bin, the type and the
    longest length are used, and checked against ``schema``.
    """
    edits = resolve_policies(policies)
    rows = {r["name"]: r for r in census}
    unknown = sorted(set(edits) - set(rows))
    if unknown:
        raise ValueError(f"policies for columns that do not exist: {unknown}")
    fields = {f.name: f for f in schema.fields}
    taken = resolve_tags(tags)
    lost = sorted(set(fields) - set(rows) - set(taken))
    if lost:
        raise ValueError(f"columns of the table that are not in the census: {lost}")
    columns, dropped = [], []
    for name in sorted(rows):
        row = rows[name]
        if row["category"] not in FLATTENABLE:
            continue
        if name not in fields:
            raise ValueError(f"column {name} is in the census but not in the table")
        data_type = fields[name].dataType
        if data_type.simpleString() != row["type"]:
            raise ValueError(f"column {name} is {data_type.simpleString()}, "
                             f"its census says {row['type']}")
        longest = int(row["max_len"])
        if longest < 1:
            raise ValueError(f"column {name} is {row['category']} but its census says "
                             f"its longest list holds {longest}")
        width = longest
        if row["category"] == "jagged":
            width = slots_for(edits.get(name, row["policy"]), longest, name)
            if width == 0:
                dropped.append(name)
                continue
        columns.append(FlatColumn(name, row["category"], data_type, width, longest))
    clash = sorted(set(taken) & set(rows))
    if clash:
        raise ValueError(f"tags named like columns of the table: {clash}")
    return FlatLayout(taken, columns, dropped, resolve_fill(fill))
