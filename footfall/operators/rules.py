"""Field rules of events and entities, stated as data.

Fixed values: keys, bounds and word lists follow the data contract. The order of
fields is the order in which violations are reported.
"""

from __future__ import annotations

from typing import NamedTuple

from footfall import schema as s


class Field(NamedTuple):
    """Accepted JSON types and limits of one key.

    ``low``/``high`` bound a number, the length of a string or the size of an array.
    """

    name: str
    types: tuple[str, ...]
    pattern: str | None = None
    choices: tuple[str, ...] | None = None
    low: float | None = None
    high: float | None = None


class Keys(NamedTuple):
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()


def text(name, low=None, high=None, *, nullable=False):
    return Field(name, ("string", "null") if nullable else ("string",), low=low, high=high)


def matching(name, pattern):
    return Field(name, ("string",), pattern=pattern)


def one_of(name, choices):
    return Field(name, ("string",), choices=choices)


def number(name, low, high):
    return Field(name, ("number",), low=low, high=high)


def integer(name, low, high):
    return Field(name, ("integer",), low=low, high=high)


# --- fixed values: events ---------------------------------------------------------
_COMMON = ("event_id", "event_type", "user_id", "session_id", "timestamp")

EVENT_KEYS = {
    "page_view": Keys(
        (*_COMMON, "page_url", "page_type", "time_on_page_seconds", "device_type", "country"),
        ("referrer",),
    ),
    "click": Keys(
        (*_COMMON, "element_id", "element_type", "page_url", "x_position", "y_position")
    ),
    "search": Keys((*_COMMON, "query", "results_count")),
    "product_view": Keys((*_COMMON, "product_id", "category", "price", "time_on_page_seconds")),
    "cart_event": Keys((*_COMMON, "product_id", "action")),
}

# A key has the same rule in every event type that allows it, so one list serves
# all types; for each type it keeps that type's own order.
EVENT_FIELDS = (
    matching("event_id", s.EVENT_ID),
    matching("user_id", s.USER_ID),
    matching("session_id", s.SESSION_ID),
    matching("timestamp", s.ISO_TIMESTAMP),
    text("element_id", 1, 100),
    one_of("element_type", s.ELEMENT_TYPES),
    text("page_url", 1, 500),
    integer("x_position", 0, 5000),
    integer("y_position", 0, 10000),
    text("query", 1, 200),
    integer("results_count", 0, 10000),
    matching("product_id", s.PRODUCT_ID),
    one_of("category", s.PRODUCT_CATEGORIES),
    number("price", 0.5, 5000),
    one_of("page_type", s.PAGE_TYPES),
    number("time_on_page_seconds", 0, 7200),
    text("referrer", high=500, nullable=True),
    one_of("device_type", s.DEVICE_TYPES),
    one_of("country", s.COUNTRIES),
    one_of("action", s.CART_ACTIONS),
)

# --- fixed values: entities -------------------------------------------------------
ENTITY_FIELDS = {
    "user": (
        matching("user_id", s.USER_ID),
        text("signup_date"),
        one_of("country", s.COUNTRIES),
        one_of("age_bucket", s.AGE_BUCKETS),
        one_of("device_preference", s.DEVICE_TYPES),
        Field("is_premium", ("boolean",)),
    ),
    "product": (
        matching("product_id", s.PRODUCT_ID),
        one_of("category", s.PRODUCT_CATEGORIES),
        text("subcategory", 1, 60),
        text("name", 1, 120),
        number("price", 0.5, 5000),
        integer("stock", 0, 10000),
        text("brand", high=60),
        number("rating", 0, 5),
        text("created_at"),
    ),
    "session": (
        matching("session_id", s.SESSION_ID),
        matching("user_id", s.USER_ID),
        matching("start_time", s.ISO_TIMESTAMP),
        matching("end_time", s.ISO_TIMESTAMP),
        one_of("device_type", s.DEVICE_TYPES),
        one_of("browser", s.BROWSERS),
        one_of("country", s.COUNTRIES),
        one_of("referrer_source", s.REFERRER_SOURCES),
    ),
    "transaction": (
        matching("transaction_id", s.TRANSACTION_ID),
        matching("user_id", s.USER_ID),
        matching("session_id", s.SESSION_ID),
        Field("product_ids", ("array",), pattern=s.PRODUCT_ID, low=1, high=50),
        number("total_amount", 0.5, 100000),
        one_of("status", s.TRANSACTION_STATUS),
        one_of("payment_method", s.PAYMENT_METHODS),
        matching("timestamp", s.ISO_TIMESTAMP),
    ),
}

_ENTITY_OPTIONAL = {
    "user": ("is_premium",),
    "product": ("brand", "rating"),
    "session": ("referrer_source",),
    "transaction": ("payment_method",),
}

ENTITY_KEYS = {
    entity: Keys(
        tuple(f.name for f in fields if f.name not in _ENTITY_OPTIONAL[entity]),
        _ENTITY_OPTIONAL[entity],
    )
    for entity, fields in ENTITY_FIELDS.items()
}
