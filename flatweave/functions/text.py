"""Text of cells, matching what the columnar CSV writer produces."""

from __future__ import annotations

from pyspark.sql import types as T

from flatweave.functions.names import literal

# The characters that force a CSV cell into quotes.
QUOTED_CELL = '[,"\r\n]'


def is_float(t: T.DataType) -> bool:
    return isinstance(t, (T.FloatType, T.DoubleType))


def is_integer(t: T.DataType) -> bool:
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def plain_text(value: str, t: T.DataType) -> str:
    """A value as a string; nested values become JSON."""
    if isinstance(t, T.StringType):
        return value
    if isinstance(t, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return f"to_json({value})"
    if isinstance(t, T.BinaryType):
        return f"hex({value})"
    return f"cast({value} as string)"


def flat_value(value: str, t: T.DataType) -> str:
    """A value fit for one flat cell: structs become JSON, the rest stay typed."""
    return f"to_json({value})" if isinstance(t, T.StructType) else value


def writable(cell: str, t: T.DataType) -> str:
    """A flat cell as the CSV writer should see it.

    NaN is an empty cell; types whose text depends on writer options (dates,
    timestamps, decimals, intervals) are turned into strings first.
    """
    if is_float(t):
        return f"if(isnan({cell}), null, {cell})"
    if is_integer(t) or isinstance(t, (T.StringType, T.BooleanType)):
        return cell
    return f"cast({cell} as string)"


def quote_cell(text: str) -> str:
    return (f"if({text} rlike {literal(QUOTED_CELL)}, "
            f"""concat('"', replace({text}, '"', '""'), '"'), {text})""")


def needs_quoting(t: T.DataType) -> bool:
    return not (is_float(t) or is_integer(t) or
                isinstance(t, (T.BooleanType, T.DateType, T.TimestampType,
                               T.TimestampNTZType, T.DecimalType)))


def cell_text(value: str, t: T.DataType) -> str:
    """One CSV cell, never NULL; NaN is empty."""
    text = plain_text(value, t)
    if needs_quoting(t):
        text = quote_cell(text)
    elif is_float(t):
        text = f"nullif({text}, 'NaN')"
    return f"coalesce({text}, '')"


def joined_cells(items: str, t: T.DataType) -> str:
    """All elements of a list as comma-separated CSV cells."""
    if needs_quoting(t):
        return f"array_join(transform({items}, x -> {quote_cell(plain_text('x', t))}), ',', '')"
    text = f"array_join(cast({items} as array<string>), ',', '')"
    # No other number is spelled with these letters, so this empties NaN only.
    return f"replace({text}, 'NaN', '')" if is_float(t) else text
