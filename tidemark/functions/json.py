"""JSON predicates that tell a JSON null from an absent field.

``get_json_object`` returns SQL NULL for both, so these go through VARIANT:
``{"a": null}`` has a field ``a``, ``{}`` has not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_END = "__end__"
_BAD = "__bad__"


def field(data: Column, name: str) -> Column:
    """JSON text of a top-level field; NULL only where the field is absent."""
    return F.to_json(F.variant_get(F.try_parse_json(data), f"$.{name}", "variant"))


def _closed(text: Column) -> Column:
    """A line as the first element of an array that an end mark closes.

    The one parse of a line: validity, timepoint and error all start from this
    expression, so Spark evaluates it once per row.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))


def json_ok(text: Column) -> Column:
    """True where ``text`` is exactly one JSON value.

    The parser stops after the first value and ignores what follows it, so the
    text is closed by a mark that must come second and last.  Text that holds the
    mark itself could end the array early; it must also parse inside an object.
    """
    closed = _closed(text)
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit(',"z":7}')))
    marked = F.try_variant_get(in_object, "$.z", "int") == 7
    return F.coalesce(
        (F.try_variant_get(closed, "$[1]", "string") == _END)
        & F.try_variant_get(closed, "$[2]", "variant").isNull()
        & F.when(text.contains(_END), F.coalesce(marked, F.lit(False))).otherwise(True),
        F.lit(False),
    )


def parse_one(text: Column, ddl: str) -> Column:
    """``text`` as one value of type ``ddl``; NULL unless it is exactly one JSON value of it.

    One parse tells both: the text is the first field of an object whose second field
    must come through, so a second value on the line, or anything else behind the first,
    makes it NULL, and so does a field of another type.  ``json_ok`` settles the rare
    text that holds the second field's name.
    """
    wrapped = F.concat(F.lit('{"v":'), text, F.lit(f',"{_END}":7}}'))
    parsed = F.from_json(
        wrapped, f"v {ddl}, `{_END}` int, `{_BAD}` string", {"columnNameOfCorruptRecord": _BAD}
    )
    alone = F.when(text.contains(_END), json_ok(text)).otherwise(True)
    return F.when((parsed[_END] == 7) & parsed[_BAD].isNull() & alone, parsed["v"])


def line_timepoint(text: Column) -> Column:
    """``event.timepoint`` of a valid line, NULL where it is not a number."""
    found = F.try_variant_get(_closed(text), "$[0].event.timepoint", "variant")
    return F.when(~F.to_json(found).startswith('"'), F.try_variant_get(found, "$", "bigint"))


def line_error(text: Column) -> Column:
    """True where a valid line carries a non-empty top-level ``error``."""
    value = F.to_json(F.try_variant_get(_closed(text), "$[0].error", "variant"))
    return F.coalesce(~value.isin("null", "false", "0", '""'), F.lit(False))
