"""List lengths and padding as built-in expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import types as T

from flatweave.functions.names import literal, quoted


def list_length(items: str) -> str:
    """Elements in a list; a NULL list counts as empty."""
    return f"coalesce(array_size({items}), 0)"


def longest_list(items: str, axis: int) -> str:
    """Longest list ``axis`` levels down within one row.

    Axis 1 is the row's own list. Deeper axes reduce inside the row, so the
    nested values are never copied or exploded.
    """
    if axis == 1:
        return list_length(items)
    inner = f"x{axis}"
    return f"coalesce(array_max(transform({items}, {inner} -> {longest_list(inner, axis - 1)})), 0)"


def length_source(field: T.StructField) -> str:
    """The cheapest expression that has the same length as a list column.

    The length of a list of structs is the length of any one of its fields,
    and reading just that field lets the scan skip all the others.
    """
    source = quoted(field.name)
    element = field.dataType.elementType
    while isinstance(element, T.StructType) and element.fields:
        plain = [f for f in element.fields
                 if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
        structs = [f for f in element.fields if isinstance(f.dataType, T.StructType)]
        if not (plain or structs):
            break
        # Fixed-width fields are the cheapest to decode.
        plain.sort(key=lambda f: isinstance(f.dataType, (T.StringType, T.BinaryType)))
        chosen = (plain or structs)[0]
        source, element = f"{source}.{quoted(chosen.name)}", chosen.dataType
    return source


def padded(items: str, length: str, width: int, fill: str) -> str:
    """``items``, a list of at most ``width``, topped up with ``fill`` past ``length``.

    NULL elements stay NULL: only slots past the end of the list are filled.
    """
    missing = f"{width} - least({length}, {width})"
    return f"concat(coalesce({items}, array()), array_repeat({fill}, {missing}))"


def within(items: str, width: int, name: str, value: str) -> str:
    """``value``, failing the job if a list is longer than the profiled width."""
    message = literal(f"column {name} holds a list longer than its profiled length {width}: "
                      "profile it again; found ")
    return (f"if(array_size({items}) > {width}, "
            f"raise_error(concat({message}, array_size({items}))), {value})")
