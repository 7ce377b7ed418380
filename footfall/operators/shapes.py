r"""Shapes of event lines: most verdicts from a typed read and a few looks at the text.

The usual line is one flat object whose keys and types are those of its event type. A line
without backslashes and with braces only at its ends holds quotes nowhere but around keys
and strings, so its text tells how many keys it has (``":``) and whether a key's value is a
string (``"key":"``); a typed read tells which keys have a value of the right type. A small
table, built from the field rules, says what each event type must show. For lines that fit
only values are checked; whatever does not fit is left to the full chain of tests over a
parsed variant, so a wrong guess here costs time and never a verdict.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.operators.rules import Field, Keys

#: Longer lines go to the full chain.
_MOST_BYTES = 1 << 20
CORRUPT = "_corrupt_record"
# as strict as the parser of variants
READ_OPTIONS = {
    "allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
    "columnNameOfCorruptRecord": CORRUPT,
}


def value_schema(kind_key: str, fields: Sequence[Field]) -> str:
    kinds = ["DOUBLE" if {"number", "integer"} & {*f.types} else "STRING" for f in fields]
    typed = [f"{f.name} {kind}" for f, kind in zip(fields, kinds, strict=True)]
    return ", ".join([*typed, f"{kind_key} STRING", f"{CORRUPT} STRING"])


def is_flat(line: Column) -> Column:
    """One pair of braces, at the ends; no escapes."""
    return (
        line.startswith("{")
        & (F.instr(line, "}") == F.length(line))
        & ~F.substring(line, 2, _MOST_BYTES).contains("{")
        & ~line.contains("\\")
        & (F.octet_length(line) < _MOST_BYTES)
    )


def _number_of_keys(line: Column) -> Column:
    without = F.replace(line, F.lit('":'), F.lit(""))
    return (F.octet_length(line) - F.octet_length(without)) / 2


def _followed_by(line: Column, key: str, sign: str) -> Column:
    return line.contains(f'"{key}":{sign}') | line.contains(f'"{key}": {sign}')


def fits_shape(
    line: Column, kind: Column, values: Column, keys: Mapping[str, Keys], fields: Sequence[Field],
    kind_key: str,
) -> Column:
    """The flat line has exactly the keys of its event type, each with a value of its type.

    Strings that rules on patterns and choices accept are strings in the line as well;
    for others the line must show one.
    """
    by_name = {f.name: f for f in fields}
    count = _number_of_keys(line)

    def plain_text(name: str) -> bool:
        field = by_name[name]
        return "string" in field.types and not field.pattern and not field.choices

    def read(name: str) -> Column:
        numeric = {"number", "integer"} & {*by_name[name].types}
        # parsers differ on numbers beyond doubles
        return F.abs(values[name]) < 1e15 if numeric else values[name].isNotNull()

    found = F.lit(False)
    for name, own in keys.items():
        tests = [read(k) for k in own.required if k != kind_key]
        tests += [_followed_by(line, k, '"') for k in (*own.required,) if k != kind_key and plain_text(k)]
        expected = F.lit(len(own.required))
        for k in own.optional:
            present = _followed_by(line, k, "")
            good = _followed_by(line, k, '"') if plain_text(k) else read(k)
            if "null" in by_name[k].types:
                good = good | (values[k].isNull() & _followed_by(line, k, "null"))
            tests.append(~present | good)
            expected = expected + present.cast("int")
        fits = reduce(lambda a, b: a & b, tests) & (count == expected)
        found = F.when(kind == name, fits).otherwise(found)
    return F.coalesce(values[CORRUPT].isNull() & _followed_by(line, kind_key, '"') & found, F.lit(False))


def value_problem(line: Column, field: Field, value: Column, violation: str) -> Column:
    """What a value breaks, else NULL; an empty reason where the text cannot tell which rule."""

    def reason(message: str) -> Column:
        return F.lit(f"{violation}{field.name}: {message}")

    def if_text(message: str) -> Column:
        return F.when(_followed_by(line, field.name, '"'), reason(message)).otherwise("")

    if field.pattern:
        return F.when(~value.rlike(f"(?dU){field.pattern}"), if_text("pattern does not match"))
    if field.choices:
        return F.when(~value.isin(*field.choices), if_text("not an allowed value"))
    size = F.char_length(value) if "string" in field.types else value
    tests = [size < field.low] if field.low is not None else []
    tests += [size > field.high] if field.high is not None else []
    what = "length out of bounds" if "string" in field.types else "out of bounds"
    outside = F.when(reduce(lambda a, b: a | b, tests), reason(what)) if tests else F.lit(None)
    if "integer" in field.types:
        return F.when(value != F.floor(value), reason("wrong type")).otherwise(outside)
    return outside


def value_problems(
    line: Column, kind: Column, values: Column, keys: Mapping[str, Keys], fields: Sequence[Field],
    violation: str,
) -> Column:
    """The first broken value rule among the event type's own fields, in declared order."""
    found = F.lit(None).cast("string")
    for name, own in keys.items():
        allowed = {*own.required, *own.optional}
        tests = [
            value_problem(line, f, values[f.name], violation) for f in fields if f.name in allowed
        ]
        found = F.when(kind == name, F.coalesce(*tests)).otherwise(found)
    return found
