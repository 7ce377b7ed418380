"""Quality rules of the fact tables.

Fixed values. ``LOAD_RULES`` guard every load; ``FULL_RULES`` are stricter and can
fail on correct data (adds can exceed views, a funnel step can exceed the one
before); ``TYPED_RULES`` belong to the typed variant of three tables;
``CONSTRAINTS`` are the checks of the warehouse tables themselves.
"""

from __future__ import annotations

from footfall.operators.quality import (
    has_type,
    is_complete,
    is_primary_key,
    values,
    values_between,
)


def _complete(*columns):
    return [is_complete(c) for c in columns]


LOAD_RULES = {
    "top_pages": [*_complete("dt", "page_url"), values("views", ">", 0)],
    "bounce_rate": [
        *_complete("dt", "landing_page_type"),
        values_between("bounce_rate", 0, 1),
        values("total_sessions", ">", 0),
    ],
    "funnel": [*_complete("dt", "stage"), values("sessions", ">=", 0)],
    "product_gap": [*_complete("dt", "product_id"), values("views", ">=", 0)],
    "nav_paths": [*_complete("dt", "path"), values("sessions", ">", 0)],
    "device_country": _complete("dt", "device_type", "country"),
    "anomalies": [*_complete("dt", "session_id"), values("total_flags", ">=", 2)],
}

COMMON_RULES = [is_complete("dt"), has_type("dt", "DATE"), is_primary_key("dt")]

FULL_RULES = {
    "bounce_rate": [
        *_complete("dt", "landing_page_type", "total_sessions", "bounce_rate"),
        has_type("dt", "DATE"),
        has_type("bounce_rate", "DOUBLE"),
        values_between("bounce_rate", 0, 1),
        values("total_sessions", ">", 0),
        values("bounce_sessions", ">=", 0),
    ],
    "top_pages": [
        *_complete("dt", "page_url", "views"),
        has_type("dt", "DATE"),
        has_type("views", "INTEGER"),
        values("views", ">", 0),
        values("avg_time_on_page", ">=", 0),
    ],
    "funnel": [
        *_complete("dt", "stage", "sessions"),
        has_type("dt", "DATE"),
        values("sessions", ">=", 0),
        values_between("conversion_rate_overall", 0, 1),
        values_between("conversion_rate_from_previous", 0, 1),
    ],
    "product_gap": [
        *_complete("dt", "product_id", "views"),
        has_type("dt", "DATE"),
        values("views", ">=", 0),
        values("cart_adds", ">=", 0),
        values_between("gap_score", 0, 1),
    ],
    "nav_paths": [
        *_complete("dt", "path", "sessions"),
        has_type("dt", "DATE"),
        values("sessions", ">", 0),
    ],
    "device_country": [
        *_complete("dt", "device_type", "country", "page_views"),
        has_type("dt", "DATE"),
        values("page_views", ">=", 0),
        values("avg_time_on_page", ">=", 0),
    ],
    "anomalies": [
        *_complete("dt", "session_id", "anomaly_type"),
        has_type("dt", "DATE"),
        values("total_flags", ">=", 2),
        values("total_events", ">", 0),
    ],
}

TYPED_RULES = {
    "bounce_rate": [
        *_complete("dt", "landing_page_type"),
        has_type("dt", "DATE"),
        has_type("bounce_rate", "DOUBLE"),
        values_between("bounce_rate", 0, 1),
        is_complete("total_sessions"),
        values("total_sessions", ">", 0),
    ],
    "top_pages": [
        *_complete("dt", "page_url"),
        has_type("dt", "DATE"),
        values("views", ">", 0),
        values("avg_time_on_page", ">=", 0),
    ],
    "anomalies": [
        *_complete("dt", "session_id", "anomaly_type"),
        has_type("dt", "DATE"),
        values("total_flags", ">=", 2),
        values("total_events", ">", 0),
    ],
}

#: Rule sets a load can be gated with; a metric that a set does not name has its ``load`` rules.
RULE_SETS = {"load": LOAD_RULES, "full": FULL_RULES, "typed": TYPED_RULES}

CONSTRAINTS = {
    "top_pages": [*_complete("dt", "page_url", "views"), values("views", ">", 0)],
    "bounce_rate": [
        *_complete("dt", "landing_page_type", "total_sessions", "bounce_sessions", "bounce_rate"),
        values("total_sessions", ">", 0),
        values("bounce_sessions", ">=", 0),
        values_between("bounce_rate", 0, 1),
        is_primary_key("dt", "landing_page_type"),
    ],
    "funnel": [
        *_complete("dt", "stage", "sessions"),
        values("sessions", ">=", 0),
        is_primary_key("dt", "stage"),
    ],
    "product_gap": [
        *_complete("dt", "product_id", "views", "cart_adds"),
        values("views", ">=", 0),
        values("cart_adds", ">=", 0),
    ],
    "nav_paths": [*_complete("dt", "path", "sessions"), values("sessions", ">", 0)],
    "device_country": [
        *_complete("dt", "device_type", "country", "page_views"),
        values("page_views", ">=", 0),
        is_primary_key("dt", "device_type", "country"),
    ],
    "anomalies": _complete("dt", "session_id"),
}


def rules_for(metric: str, rule_set: str = "load"):
    """The rules of a set for one metric."""
    return RULE_SETS[rule_set].get(metric, LOAD_RULES[metric])
