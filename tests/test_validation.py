import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from footfall.operators.rules import EVENT_FIELDS, EVENT_KEYS
from footfall.operators.validation import (
    matches_one_event_shape,
    valid_events,
    validate_entities,
    validate_lines,
)

COMMON = {
    "event_id": "E5d0c9b81f7e2a634",
    "user_id": "U00482913",
    "session_id": "S7e19c04ab2d8",
    "timestamp": "2026-05-22T07:05:31.250000Z",
}
VALID = {
    "page_view": {"page_url": "https://tienda.example/ofertas", "page_type": "home",
                  "time_on_page_seconds": 12.5, "referrer": None, "device_type": "mobile",
                  "country": "MX"},
    "click": {"element_id": "menu-3", "element_type": "button", "page_url": "/x",
              "x_position": 100, "y_position": 250},
    "search": {"query": "lamp shade", "results_count": 42},
    "product_view": {"product_id": "P004417", "category": "electronics", "price": 18.4,
                     "time_on_page_seconds": 45.0},
    "cart_event": {"product_id": "P004417", "action": "add"},
}


def event(kind, drop=(), **changes):
    full = {**COMMON, "event_type": kind, **VALID[kind], **changes}
    return {k: v for k, v in full.items() if k not in drop}


def verdicts(spark, *lines):
    texts = [x if isinstance(x, str) else json.dumps(x) for x in lines]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, line string")
    return sorted(validate_lines(df.coalesce(1)).collect(), key=lambda r: r.i)


def test_every_type_is_accepted(spark):
    rows = verdicts(spark, *[event(kind) for kind in VALID])
    assert [(r.is_valid, r.event_type, r.error) for r in rows] == [(True, k, None) for k in VALID]


# (line, start of the reason)
REJECTED = [
    ("", "empty_line"),
    ("   \t", "empty_line"),
    ("  ", "empty_line"),
    ("<event/>", "json_decode_error"),
    ("{event_id: 7}", "json_decode_error"),
    (json.dumps(event("page_view")) + "x" * 5000, "json_decode_error"),
    (json.dumps(event("page_view")) + ',"end":1}', "json_decode_error"),
    ("[1, 2, 3]", "payload_not_object"),
    ("5", "payload_not_object"),
    ("null", "payload_not_object"),
    ({"event_type": "teleport"}, "unknown_event_type: 'teleport'"),
    ({"event_type": True}, "unknown_event_type: True"),
    ({"event_type": False}, "unknown_event_type: False"),
    ({"a": 1}, "unknown_event_type: None"),
    ({"event_type": None}, "unknown_event_type: None"),
    ({"event_type": 5}, "unknown_event_type: 5"),
    ({"event_type": ["click"]}, "unknown_event_type: "),
    (event("page_view", drop=["page_url"]), "schema_violation at <root>: missing key page_url"),
    (event("page_view", drop=["user_id", "page_url"]),
     "schema_violation at <root>: missing key user_id"),
    (event("page_view", time_on_page_seconds=-10), "schema_violation at time_on_page_seconds"),
    (event("page_view", time_on_page_seconds=7200.5), "schema_violation at time_on_page_seconds"),
    (event("page_view", time_on_page_seconds="5"), "schema_violation at time_on_page_seconds"),
    (event("page_view", time_on_page_seconds=True), "schema_violation at time_on_page_seconds"),
    (event("page_view", referrer="r" * 501), "schema_violation at referrer"),
    (event("page_view", page_url=""), "schema_violation at page_url"),
    (event("page_view", page_url="u" * 501), "schema_violation at page_url"),
    (event("page_view", country=None), "schema_violation at country"),
    (event("page_view", user_id="user-12"), "schema_violation at user_id"),
    (event("page_view", user_id=7), "schema_violation at user_id"),
    (event("page_view", timestamp="2026-05-22 13:45:00"), "schema_violation at timestamp"),
    (event("page_view", country="XX", user_id="bad"), "schema_violation at user_id"),
    (event("click", x_position=5.5), "schema_violation at x_position"),
    (event("click", y_position=10001), "schema_violation at y_position"),
    (event("search", query=""), "schema_violation at query"),
    (event("product_view", price=0.4), "schema_violation at price"),
    (event("cart_event", action="wipe"), "schema_violation at action"),
    (event("cart_event", page_url="/x"), "schema_violation at <root>: unexpected keys page_url"),
]


def test_rejects_with_the_first_reason(spark):
    rows = verdicts(spark, *[line for line, _ in REJECTED])
    for row, (line, reason) in zip(rows, REJECTED):
        assert not row.is_valid, line
        assert row.error.startswith(reason), (line, row.error)


ACCEPTED = [
    event("click", x_position=5.0),
    event("page_view", drop=["referrer"]),
    event("page_view", time_on_page_seconds=0),
    event("page_view", page_url="é" * 500),
    event("page_view", timestamp="2026-05-22T13:45:00+02:00"),
    event("cart_event", user_id="U00482913\n"),
    json.dumps(event("search")) + "\r",
    "  " + json.dumps(event("search")) + "  ",
]


def test_accepts_borderline_values(spark):
    for row, line in zip(verdicts(spark, *ACCEPTED), ACCEPTED):
        assert row.is_valid, (line, row.error)


def test_line_cannot_close_the_envelope_itself(spark):
    good = json.dumps(event("search"))
    bad = [good + ',"line":1}', good + ',"line":1', good + ',"end1":1}garbage', good + "}", "{}," + good]
    rows = verdicts(spark, *bad)
    assert [r.error.split(":")[0] for r in rows] == ["json_decode_error"] * len(bad)


def test_last_of_repeated_keys_counts(spark):
    text = json.dumps(event("cart_event"))
    rows = verdicts(
        spark,
        text[:-1] + ', "action": "remove"}',
        text[:-1] + ', "action": "wipe"}',
        text.replace('"add"', '"wipe"')[:-1] + ', "action": "add"}',
    )
    assert [r.is_valid for r in rows] == [True, False, True]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(st.characters(exclude_characters="\n\r"), max_size=20), min_size=1))
def test_json_test_agrees_with_a_strict_parser(spark, texts):
    def reject(_):
        raise ValueError

    def category(text):
        if not text.strip():
            return "empty_line"
        try:
            value = json.loads(text, parse_constant=reject)
        except ValueError:
            return "json_decode_error"
        return "unknown_event_type" if isinstance(value, dict) else "payload_not_object"

    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    got = [r.error.split(":")[0] for r in verdicts(spark, *texts)]
    assert got == [category(t) for t in texts]


def test_field_order_fits_every_type():
    position = {f.name: i for i, f in enumerate(EVENT_FIELDS)}
    declared = {
        kind: ["event_id", "user_id", "session_id", "timestamp", *fields]
        for kind, fields in VALID.items()
    }
    for kind, names in declared.items():
        assert [position[n] for n in names] == sorted(position[n] for n in names)
        keys = EVENT_KEYS[kind]
        assert set(names) | {"event_type"} == {*keys.required, *keys.optional}


def test_valid_rows_become_typed_events(spark):
    df = spark.createDataFrame([(json.dumps(event("click")),), ("junk",)], "line string")
    rows = valid_events(validate_lines(df)).collect()
    assert len(rows) == 1 and rows[0].x_position == 100 and rows[0].page_type is None


def test_polymorphic_check_equals_the_verdict(spark):
    lines = [json.dumps(x) if isinstance(x, dict) else x for x, _ in REJECTED]
    lines += [json.dumps(event(kind)) for kind in VALID]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    both = validate_lines(matches_one_event_shape(df).drop("raw"))
    assert all(r.is_valid == r.matches_event for r in both.collect())


USER = {"user_id": "U00482913", "signup_date": "x", "country": "MX", "age_bucket": "18-24",
        "device_preference": "mobile"}
PRODUCT = {"product_id": "P000001", "category": "toys", "subcategory": "s", "name": "n",
           "price": 1, "stock": 3, "created_at": "2026-01-01"}
SESSION = {"session_id": "S7e19c04ab2d8", "user_id": "U00482913",
           "start_time": COMMON["timestamp"], "end_time": COMMON["timestamp"],
           "device_type": "mobile", "browser": "edge", "country": "MX"}
TRANSACTION = {"transaction_id": "Tabcdef0123456789", "user_id": "U00482913",
               "session_id": "S7e19c04ab2d8", "product_ids": ["P000001"], "total_amount": 10,
               "status": "completed", "timestamp": COMMON["timestamp"]}

ENTITIES = [
    ("user", USER, None),
    ("user", {**USER, "is_premium": True}, None),
    ("user", {**USER, "is_premium": 1}, "schema_violation at is_premium"),
    ("user", {**USER, "country": "XX"}, "schema_violation at country"),
    ("user", {"user_id": "U00482913"}, "schema_violation at <root>: missing key signup_date"),
    ("product", PRODUCT, None),
    ("product", {**PRODUCT, "price": 5001}, "schema_violation at price"),
    ("product", {**PRODUCT, "rating": 5.1}, "schema_violation at rating"),
    ("product", {**PRODUCT, "name": ""}, "schema_violation at name"),
    ("session", SESSION, None),
    ("session", {**SESSION, "referrer_source": "tv"}, "schema_violation at referrer_source"),
    ("transaction", TRANSACTION, None),
    ("transaction", {**TRANSACTION, "product_ids": []}, "schema_violation at product_ids:"),
    ("transaction", {**TRANSACTION, "product_ids": ["P000001"] * 51},
     "schema_violation at product_ids:"),
    ("transaction", {**TRANSACTION, "product_ids": ["P000001", 5]},
     "schema_violation at product_ids.1:"),
    ("transaction", {**TRANSACTION, "product_ids": "P000001"}, "schema_violation at product_ids:"),
    ("transaction", {**TRANSACTION, "extra": 1}, "schema_violation at <root>: unexpected"),
]


@pytest.fixture(scope="module")
def entity_rows(spark):
    rows = [(i, kind, json.dumps(doc)) for i, (kind, doc, _) in enumerate(ENTITIES)]
    df = spark.createDataFrame(rows, "i int, entity string, line string")
    return {r.i: r for r in validate_entities(df).collect()}


@pytest.mark.parametrize("i", range(len(ENTITIES)))
def test_entities(entity_rows, i):
    reason = ENTITIES[i][2]
    error = entity_rows[i].error
    assert (error is None) if reason is None else error.startswith(reason), error


def test_shapes_decide_as_the_full_chain(spark):
    import random

    rng = random.Random(4)  # each run has the same lines
    values = ['"x"', '"mobile"', "5", "-1", "7.5", "1e400", "null", "true", "[1]", '{"a": 1}', '""', '"NaN"',
              "NaN", "007", '"U0000000a"', '"a\\u0041"', "'q'", '"{}"', '"k\\":\\"v"', "99999999999999999999999"]
    lines = []
    for _ in range(700):
        kind = rng.choice(["page_view", "click", "search", "product_view", "cart_event"])
        pairs = [[k, json.dumps(v)] for k, v in event(kind).items()]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(pairs))
            pairs[at][1] = rng.choice(values)
        if rng.random() < 0.2:
            pairs.insert(rng.randrange(len(pairs)), [rng.choice(["referrer", "extra", "event_id"]), rng.choice(values)])
        if rng.random() < 0.1:
            pairs.pop(rng.randrange(len(pairs)))
        colon, comma = rng.choice([(":", ","), (": ", ", "), (" :", " ,")])
        line = "{" + comma.join(f'"{k}"{colon}{v}' for k, v in pairs) + "}"
        lines.append(rng.choice([line] * 6 + [line + " ", line + "}", line + "{}", line[:-1], " " + line, line + "\r"]))
    df = spark.createDataFrame(list(enumerate([*lines, None, "", "{}"])), "n long, line string")
    columns = ["n", "raw", "is_valid", "event_type", "error"]
    fast, full = (
        {r.n: r for r in validate_lines(df, by_shape=b).select(*columns).collect()} for b in (True, False)
    )
    differing = [f"{full[n]} | {fast[n].error}" for n in full if fast[n] != full[n]]
    assert not differing, "\n".join(differing)
    assert sum(r.is_valid for r in fast.values()) > 100
