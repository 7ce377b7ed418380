"""Line validation as column expressions: one projection, no shuffle, no UDF."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import computed_once, sql_list
from footfall.operators import shapes
from footfall.operators.rules import (
    ENTITY_FIELDS,
    ENTITY_KEYS,
    EVENT_FIELDS,
    EVENT_KEYS,
    Field,
    Keys,
)
from footfall.schema import EVENT_SCHEMA, EVENT_TYPES

# --- fixed values: reasons --------------------------------------------------------
EMPTY_LINE = "empty_line"
NOT_JSON = "json_decode_error: not a JSON document"
NOT_OBJECT = "payload_not_object"
UNKNOWN_TYPE = "unknown_event_type: "
VIOLATION = "schema_violation at "
ROOT = "<root>"

_VARIANT_MAP = "map<string,variant>"
# Python's notion of blank: Unicode white space and the separators 1C-1F.
_BLANK = r"(?U)^[\s\x1c-\x1f]*$"
# `$` may match before a final \n only, and \d covers all Unicode digits.
_FLAGS = "(?dU)"


def _members(document: Column) -> Column:
    return F.try_variant_get(document, "$", _VARIANT_MAP)


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def parse_line(lines: DataFrame, column: str = "line") -> DataFrame:
    """Add ``raw``, ``is_json`` and ``members`` (keys and values, NULL if not an object).

    Spark's JSON parser stops after the first complete value. The line is wrapped
    in an envelope whose two keys carry the line's own hash: text behind the first
    value, or a line that closes the envelope early, leaves other keys.
    """
    return _parsed(computed_once(lines, raw=_without_end(column)), "raw")


def _without_end(column: str) -> Column:
    return F.rtrim(F.make_valid_utf8(F.col(column)), F.lit("\r\n"))


def _parsed(lines: DataFrame, source: str) -> DataFrame:
    """Add ``is_json`` and ``members`` of the text in ``source``."""
    line_key, end_key = (
        F.concat(F.lit(name), F.xxhash64(source).cast("string")) for name in ("line", "end")
    )
    envelope = F.concat(
        F.lit('{"'), line_key, F.lit('":'), F.col(source), F.lit(',"'), end_key, F.lit('":1}')
    )
    parts = F.col("__parts")
    keys = F.map_keys(parts)
    intact = (
        (F.size(parts) == 2) & F.array_contains(keys, line_key) & F.array_contains(keys, end_key)
    )
    enveloped = computed_once(lines, __parts=_members(F.try_parse_json(envelope)))
    return computed_once(
        enveloped,
        is_json=F.coalesce(intact, F.lit(False)),
        members=F.when(intact, _members(parts[line_key])),
    ).drop("__parts")


def _first_reason(df: DataFrame, tests: Sequence[Column], group: int = 4) -> DataFrame:
    """Add ``error``, the first non-NULL test.

    Tests are evaluated in small groups: generated code for the whole list would
    exceed the size the JVM compiles and run interpreted, several times slower.
    """
    error = F.lit(None).cast("string")
    steps = []
    for start in range(0, len(tests), group):
        name = f"__error{start}"
        df = computed_once(df, **{name: F.coalesce(error, *tests[start : start + group])})
        error = F.col(name)
        steps.append(name)
    return df.withColumn("error", error).drop(*steps)


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def _string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _has_type(kind: Column, value: Column, accepted: Iterable[str]) -> Column:
    numeric = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
    tests = {
        "string": kind == "STRING",
        "number": numeric,
        "integer": numeric & (_number(value) == F.floor(_number(value))),
        "boolean": kind == "BOOLEAN",
        "array": kind.startswith("ARRAY"),
        "null": kind == "VOID",
    }
    return reduce(or_, [tests[name] for name in accepted])


def _outside(size: Column, field: Field) -> Column:
    tests = []
    if field.low is not None:
        tests.append(size < field.low)
    if field.high is not None:
        tests.append(size > field.high)
    return reduce(or_, tests)


def _problem(field: Field, value: Column) -> Column:
    """Reason text if ``value`` breaks the rule, else NULL; a missing key is no problem."""

    def reason(message: str, path: Column | None = None) -> Column:
        where = F.lit(field.name) if path is None else path
        return F.concat(F.lit(VIOLATION), where, F.lit(f": {message}"))

    kind = _kind(value)
    fits = _has_type(kind, value, field.types)
    problem = F.when(value.isNull(), None).when(~fits, reason("wrong type"))
    if "array" in field.types:
        items = F.try_variant_get(value, "$", "array<variant>")
        good = F.transform(
            items,
            lambda item: F.coalesce(
                (_kind(item) == "STRING") & _string(item).rlike(_FLAGS + field.pattern),
                F.lit(False),
            ),
        )
        position = F.array_position(good, False)
        path = F.concat(F.lit(f"{field.name}."), (position - 1).cast("string"))
        problem = problem.when(position > 0, reason("pattern does not match", path))
        return problem.when(_outside(F.size(items), field), reason("size out of bounds"))
    if field.pattern:
        return problem.when(
            ~_string(value).rlike(_FLAGS + field.pattern), reason("pattern does not match")
        )
    if field.choices:
        return problem.when(~_string(value).isin(*field.choices), reason("not an allowed value"))
    if field.low is not None or field.high is not None:
        if "string" in field.types:
            length = F.char_length(_string(value))
            return problem.when(
                (kind == "STRING") & _outside(length, field), reason("length out of bounds")
            )
        return problem.when(_outside(_number(value), field), reason("out of bounds"))
    return problem


def _key_problem(keys: Mapping[str, Keys], kind: Column, present: Column) -> Column:
    """Missing keys first, in declared order, then keys that are not allowed."""

    def per_kind(pick) -> Column:
        pairs = [c for name, k in keys.items() for c in (F.lit(name), sql_list(pick(k)))]
        return F.create_map(*pairs)[kind]

    missing = F.array_except(per_kind(lambda k: k.required), present)
    extra = F.array_except(present, per_kind(lambda k: (*k.required, *k.optional)))
    at_root = VIOLATION + ROOT
    return F.when(
        F.size(missing) > 0, F.concat(F.lit(f"{at_root}: missing key "), missing[0])
    ).when(
        F.size(extra) > 0,
        F.concat(F.lit(f"{at_root}: unexpected keys "), F.array_join(F.sort_array(extra), ", ")),
    )


def _decided_by_shape(lines: DataFrame) -> DataFrame:
    """Add ``__kind``, ``__decided`` and ``__reason`` from ``raw``, for lines of a known shape."""
    line, values, kind = F.col("raw"), F.col("__values"), F.col("__values")["event_type"]
    schema = shapes.value_schema("event_type", EVENT_FIELDS)
    read = computed_once(
        lines,
        __values=F.when(shapes.is_flat(line), F.from_json(line, schema, shapes.READ_OPTIONS)),
    )
    fits = shapes.fits_shape(line, kind, values, EVENT_KEYS, EVENT_FIELDS, "event_type")
    reason = shapes.value_problems(line, kind, values, EVENT_KEYS, EVENT_FIELDS, VIOLATION)
    shaped = computed_once(read, __fits=fits)
    told = computed_once(shaped, __reason=F.when(F.col("__fits"), reason), __kind=kind)
    unclear = F.coalesce(F.col("__reason") == "", F.lit(False))
    return told.withColumn("__decided", F.col("__fits") & ~unclear).drop("__values", "__fits")


def validate_lines(lines: DataFrame, column: str = "line", by_shape: bool = True) -> DataFrame:
    """Add ``is_valid``, ``event_type``, ``error`` and ``raw``; the first failing test wins.

    Lines of a known shape get their verdict from it and from their values; only the
    others are parsed for the full chain of tests. ``by_shape=False`` sends all there.
    """
    shown = computed_once(lines, raw=_without_end(column))
    if not by_shape:
        return _checked(shown, "raw").withColumn("is_valid", F.col("error").isNull())
    shaped = _decided_by_shape(shown)
    decided = F.col("__decided")
    rest = computed_once(shaped, __rest=F.when(~decided, F.col("raw")))
    kind, error = F.col("event_type"), F.col("error")
    return (
        _checked(rest, "__rest")
        .withColumns(
            {
                "event_type": F.when(decided, F.col("__kind")).otherwise(kind),
                "error": F.when(decided, F.col("__reason")).otherwise(error),
            }
        )
        .withColumn("is_valid", error.isNull())
        .drop("__rest", "__decided", "__kind", "__reason")
    )


def _checked(lines: DataFrame, source: str) -> DataFrame:
    """Add ``event_type`` and ``error`` of the text in ``source`` by all tests."""
    members, value = F.col("members"), F.col("__type")
    is_text = _kind(value) == "STRING"
    known = is_text & F.col("event_type").isin(*EVENT_TYPES)
    shown = (
        F.when(value.isNull() | (_kind(value) == "VOID"), "None")
        .when(is_text, F.concat(F.lit("'"), F.col("event_type"), F.lit("'")))
        .when(_kind(value) == "BOOLEAN", F.initcap("event_type"))
        .otherwise(F.col("event_type"))
    )
    tests = [
        F.when(F.col(source).rlike(_BLANK), EMPTY_LINE),
        F.when(~F.col("is_json"), NOT_JSON),
        F.when(members.isNull(), NOT_OBJECT),
        F.when(~F.coalesce(known, F.lit(False)), F.concat(F.lit(UNKNOWN_TYPE), shown)),
        _key_problem(EVENT_KEYS, F.col("event_type"), F.map_keys(members)),
        *[_problem(field, members[field.name]) for field in EVENT_FIELDS],
    ]
    typed = computed_once(_parsed(lines, source), __type=members["event_type"])
    named = computed_once(
        typed, event_type=F.when(is_text, _string(value)).otherwise(F.to_json(value))
    )
    return _first_reason(named, tests).drop("is_json", "members", "__type")


def valid_events(verdicts: DataFrame) -> DataFrame:
    """Typed events of the lines that passed."""
    event = F.from_json("raw", EVENT_SCHEMA)
    return verdicts.filter("is_valid").select(event.alias("event")).select("event.*")


def matches_one_event_shape(lines: DataFrame, column: str = "line") -> DataFrame:
    """Add ``matches_event``: the line fits exactly one of the five event shapes."""
    members = F.col("members")

    def fits(kind: str) -> Column:
        declared = _kind(members["event_type"]) == "STRING"
        allowed = {*EVENT_KEYS[kind].required, *EVENT_KEYS[kind].optional}
        tests = [
            declared & (_string(members["event_type"]) == kind),
            _key_problem({kind: EVENT_KEYS[kind]}, F.lit(kind), F.map_keys(members)).isNull(),
            *[
                _problem(f, members[f.name]).isNull() for f in EVENT_FIELDS if f.name in allowed
            ],
        ]
        return F.coalesce(reduce(and_, tests), F.lit(False)).cast("int")

    shapes = {f"__fits_{kind}": fits(kind) for kind in EVENT_TYPES}
    checked = parse_line(lines, column)
    for name, test in shapes.items():
        checked = computed_once(checked, **{name: test})
    total = reduce(lambda a, b: a + b, [F.col(name) for name in shapes])
    one = F.coalesce(members.isNotNull() & (total == 1), F.lit(False))
    return checked.withColumn("matches_event", one).drop("is_json", "members", *shapes)


def validate_entities(lines: DataFrame, entity: str = "entity", column: str = "line") -> DataFrame:
    """Check users, products, sessions and transactions; ``entity`` names the kind per row."""
    members, kind = F.col("members"), F.col(entity)
    fields = [
        F.when(kind == name, _problem(field, members[field.name]))
        for name, rules in ENTITY_FIELDS.items()
        for field in rules
    ]
    tests = [
        F.when(~F.col("is_json"), NOT_JSON),
        F.when(members.isNull(), NOT_OBJECT),
        _key_problem(ENTITY_KEYS, kind, F.map_keys(members)),
        *fields,
    ]
    return (
        _first_reason(parse_line(lines, column), tests)
        .withColumn("is_valid", F.col("error").isNull())
        .drop("is_json", "members")
    )
