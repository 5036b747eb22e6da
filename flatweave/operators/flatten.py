"""Nested rows to flat rows: a projection, so no row leaves its partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flatweave.functions.lists import list_length, padded, within
from flatweave.functions.names import quoted
from flatweave.functions.text import cell_text, flat_value, is_float, joined_cells, plain_text
from flatweave.plans.layout import FlatColumn, FlatLayout
from flatweave.plans.policy import fill_literal, slot_type


def single_value(c: FlatColumn) -> str:
    """A scalar as it is, or the only element of a one-element list."""
    source = quoted(c.name)
    if c.category == "vec1":
        return within(source, 1, c.name, flat_value(f"get({source}, 0)", c.element_type))
    return flat_value(source, c.data_type)


def kept_items(c: FlatColumn) -> tuple[str, T.DataType]:
    """The items of a jagged column that get a slot, single precision taken to double."""
    items = quoted(c.name)
    if c.width < c.longest:
        items = f"slice({items}, 1, {c.width})"
    if isinstance(c.element_type, T.FloatType):
        return f"cast({items} as array<double>)", T.DoubleType()
    return items, c.element_type


def checked(c: FlatColumn, value: str) -> str:
    """Where every item is to get a slot, fail if there are more than slots."""
    return within(quoted(c.name), c.longest, c.name, value) if c.width == c.longest else value


def padded_array(c: FlatColumn, fill: float | str) -> str:
    """All slots of a jagged column as one array of fixed width and one type."""
    t = slot_type(c.element_type, fill)
    items, element = kept_items(c)
    if isinstance(element, T.StructType):
        items = f"transform({items}, x -> {plain_text('x', element)})"
    elif isinstance(t, T.StringType) and is_float(element):
        # Next to text, NaN is a missing cell.
        items = f"transform({items}, x -> nullif({plain_text('x', element)}, 'NaN'))"
    elif element != t:
        items = f"cast({items} as array<{t.simpleString()}>)"
    return checked(c, padded(items, list_length(quoted(c.name)), c.width, fill_literal(fill, t)))


def flat_arrays(df: DataFrame, layout: FlatLayout) -> DataFrame:
    """One fixed-width array per jagged column instead of one column per slot."""
    tags = [f"cast({v} as tinyint) as {quoted(k)}" for k, v in layout.tags.items()]
    cells = [(padded_array(c, layout.fill) if c.category == "jagged" else single_value(c))
             + f" as {quoted(c.name)}" for c in layout.columns]
    return df.selectExpr(*tags, *cells)


def flat_columns(df: DataFrame, layout: FlatLayout) -> DataFrame:
    """One flat column per slot, picked from the padded arrays.

    Dropped columns are not read.
    """
    picks = [quoted(tag) for tag in layout.tags]
    for c in layout.columns:
        if c.category == "jagged":
            picks += [f"{quoted(c.name)}[{j}] as {quoted(name)}" for j, name in enumerate(c.names)]
        else:
            picks.append(quoted(c.name))
    return flat_arrays(df, layout).selectExpr(*picks)


def padded_text(c: FlatColumn, fill: float | str) -> str:
    """All slots of a jagged column as CSV text.

    Only elements that exist are rendered. The run of fill cells after them is
    one string repeat, so a sparse wide column costs its elements, not its width.
    """
    t = slot_type(c.element_type, fill)
    items, element = kept_items(c)
    if not isinstance(t, T.StringType) and element != t:
        items, element = f"cast({items} as array<{t.simpleString()}>)", t
    pad = cell_text(fill_literal(fill, t), t)
    length = list_length(quoted(c.name))
    filled = f"greatest(least({length}, {c.width}), 1)"
    return checked(c, f"concat(if({length} > 0, {joined_cells(items, element)}, {pad}), "
                      f"repeat(concat(',', {pad}), {c.width} - {filled}))")


def flat_lines(df: DataFrame, layout: FlatLayout) -> DataFrame:
    """Each row as one line of CSV text, with the cells ``flat_columns`` would give.

    One expression per source column, so tens of thousands of flat columns plan
    and compile as fast as a few hundred.
    """
    cells = [f"'{v}'" for v in layout.tags.values()]
    for c in layout.columns:
        if c.category == "jagged":
            cells.append(padded_text(c, layout.fill))
        else:
            t = T.StringType() if isinstance(c.element_type, T.StructType) else c.element_type
            cells.append(cell_text(single_value(c), t))
    return df.selectExpr(f"concat_ws(',', {', '.join(cells)}) as value")


def header_line(layout: FlatLayout) -> str:
    def cell(name: str) -> str:
        special = any(ch in name for ch in ',"\r\n')
        return '"' + name.replace('"', '""') + '"' if special else name
    return ",".join(cell(n) for n in layout.names)


FORMS = {"columns": flat_columns, "arrays": flat_arrays, "lines": flat_lines}


def flatten(df: DataFrame, layout: FlatLayout, form: str = "columns") -> DataFrame:
    """Flatten as ``columns``, fixed-width ``arrays`` or CSV text ``lines``."""
    if form not in FORMS:
        raise ValueError(f"form must be one of {sorted(FORMS)}, got: {form}")
    return FORMS[form](df, layout)
