"""The seven daily metric tables and the events columns each one reads."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from footfall.operators.metrics import anomalies as _anomalies
from footfall.operators.metrics import bounce_rate as _bounce_rate
from footfall.operators.metrics import device_country as _device_country
from footfall.operators.metrics import funnel as _funnel
from footfall.operators.metrics import nav_paths as _nav_paths
from footfall.operators.metrics import product_gap as _product_gap
from footfall.operators.metrics import top_pages as _top_pages


# --- fixed values: columns and types of the metric tables --------------------------
METRIC_SCHEMAS = {
    "top_pages": """dt date, page_url string, page_type string, views bigint,
        avg_time_on_page double, p95_time_on_page double""",
    "bounce_rate": """dt date, landing_page_type string, total_sessions bigint,
        bounce_sessions bigint, bounce_rate double""",
    "funnel": """dt date, stage string, sessions bigint, conversion_rate_overall double,
        conversion_rate_from_previous double""",
    "product_gap": """dt date, product_id string, category string, views bigint,
        cart_adds bigint, conversion double, gap_score double""",
    "nav_paths": "dt date, path string, sessions bigint, avg_path_length double",
    "device_country": """dt date, device_type string, country string, page_views bigint,
        avg_time_on_page double, p95_time_on_page double, unique_sessions bigint""",
    "anomalies": """dt date, session_id string, user_id string, total_events bigint,
        session_duration_seconds double, unique_pages bigint, events_per_minute double,
        z_total_events double, z_session_duration_seconds double, z_unique_pages double,
        z_events_per_minute double, total_flags int, anomaly_type string""",
}


class Metric(NamedTuple):
    compute: Callable[..., DataFrame]
    columns: tuple[str, ...]


METRICS = {
    "top_pages": Metric(_top_pages.top_pages, _top_pages.COLUMNS),
    "bounce_rate": Metric(_bounce_rate.bounce_rate, _bounce_rate.COLUMNS),
    "funnel": Metric(_funnel.funnel, _funnel.COLUMNS),
    "product_gap": Metric(_product_gap.product_gap, _product_gap.COLUMNS),
    "nav_paths": Metric(_nav_paths.nav_paths, _nav_paths.COLUMNS),
    "device_country": Metric(_device_country.device_country, _device_country.COLUMNS),
    "anomalies": Metric(_anomalies.anomalies, _anomalies.COLUMNS),
}
