"""Clickstream, entity and JSON-line views over the supplied Parquet tables.

Only ``events`` resembles a clickstream; it is mapped to the event schema by the
plain projections below, with copies, missing values and damaged lines decided by
the number ``k`` each event carries. No step shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schema import EVENT_SCHEMA
from footfall.sources.events import with_time_columns

# A session is a user's half day, cut at 06:00 and 18:00, so evening sessions
# run over midnight.
_HALF_DAY = 12 * 3600
_SHIFT = 6 * 3600


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(number: Column, *choices: str) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (number + 1).cast("int"))


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    copies = F.when(F.col("k") % 25 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    half_day = F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) + _SHIFT) / _HALF_DAY)
    kind = (
        F.when(F.col("event_type").isin("view", "error"), "page_view")
        .when(F.col("event_type") == "signup", "product_view")
        .when(F.col("event_type") == "purchase", "cart_event")
        .when(F.col("k") % 5 == 0, "search")
        .otherwise("click")
    )
    return (
        table(spark, folder, "events")
        .withColumn("k", k)
        .select(
            F.concat(F.lit("E"), F.lpad(F.col("event_id").cast("string"), 16, "0")).alias("event_id"),
            kind.alias("event_type"),
            F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("user_id"),
            F.concat(
                F.lit("S"),
                F.lpad(F.lower(F.hex(F.col("user_id") * 1048576 + half_day)), 12, "0"),
            ).alias("session_id"),
            F.col("event_id").alias("number"),
            F.col("user_id").alias("visitor"),
            "ts",
            "k",
            "value",
            F.explode(copies).alias("copy"),
        )
    )


def raw_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table in the shape of the JSON-lines event schema."""
    k, visitor = F.col("k"), F.col("visitor")
    page, product = F.col("event_type") == "page_view", F.col("event_type") == "product_view"
    cart, search = F.col("event_type") == "cart_event", F.col("event_type") == "search"
    click = F.col("event_type") == "click"
    stamp = F.col("ts").cast("timestamp") + F.make_interval(secs=F.col("copy"))
    text_k = k.cast("string")
    columns = {
        "timestamp": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "page_url": F.when(
            page | click,
            F.concat(
                F.lit("https://Shop.Example/"), (k % 20).cast("string"), F.lit("?k="), text_k
            ),
        ),
        "page_type": F.when(
            page,
            _pick(k % 7, "home", "category", "product", "cart", "checkout", "search", "other"),
        ),
        "time_on_page_seconds": F.when((page | product) & (k % 10 != 0), F.col("value")),
        "referrer": F.lit(None).cast("string"),
        "device_type": F.when(
            page & (k % 17 != 0), _pick(visitor % 3, "mobile", "desktop", "tablet")
        ),
        "country": F.when(page & (k % 13 != 0), _pick(visitor % 4, "MX", "co", "AR", "es")),
        "element_id": F.when(click, F.concat(F.lit("el_"), text_k)),
        "element_type": F.when(click, _pick(k % 3, "button", "link", "image")),
        "x_position": F.when(click, k),
        "y_position": F.when(click, k * 10),
        "query": F.when(search, F.concat(F.lit("term "), text_k)),
        "results_count": F.when(search, k),
        "product_id": F.when(
            product | cart, F.concat(F.lit("P"), F.lpad((k % 12).cast("string"), 6, "0"))
        ),
        "category": F.when(
            product, _pick((k % 12) % 4, "electronics", "clothing", "home", "sports")
        ),
        "price": F.when(product, F.lit(10.5) + k),
        "action": F.when(cart, F.when(k % 4 == 3, "remove").otherwise("add")),
    }
    names = [part.split()[0] for part in EVENT_SCHEMA.replace("\n", " ").split(",")]
    return _numbered(spark, folder).withColumns(columns).select(*names)


def clickstream(spark: SparkSession, folder: str) -> DataFrame:
    """Clickstream with its derived time columns."""
    return with_time_columns(raw_clickstream(spark, folder))


def _json(*pairs: tuple[str, Column]) -> Column:
    parts = []
    for i, (name, value) in enumerate(pairs):
        parts += [F.lit(("," if i else "{") + f'"{name}":'), value]
    return F.concat(*parts, F.lit("}"))


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every clickstream row as a JSON line, some damaged, in four files per day.

    Columns: ``source_key, block, ts, number, copy, line, size_bytes``. A block is
    one minute of one file. ``k % 20`` picks the damage; on the 10th, 20th and
    30th most lines are cut in half, which makes those files corrupt.
    """
    k = F.col("k")
    stamp = F.date_format(
        F.col("ts").cast("timestamp") + F.make_interval(secs=F.col("copy")),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    )
    damage = k % 20
    head = [
        ("event_id", _quoted(F.col("event_id"))),
        (
            "event_type",
            _quoted(F.when(damage == 2, F.lit("teleport")).otherwise(F.col("event_type"))),
        ),
        ("user_id", _quoted(F.when(damage == 6, F.lit("nobody")).otherwise(F.col("user_id")))),
        ("session_id", _quoted(F.col("session_id"))),
    ]
    number = F.when(damage == 5, F.lit(-10)).otherwise(k).cast("string")
    product = _quoted(F.concat(F.lit("P"), F.lpad((k % 12).cast("string"), 6, "0")))
    url = _quoted(F.concat(F.lit("https://shop.example/"), (k % 20).cast("string")))
    body = {
        "page_view": [
            ("page_url", url),
            ("page_type", _quoted(_pick(k % 3, "home", "cart", "checkout"))),
            ("time_on_page_seconds", number),
            ("device_type", _quoted(_pick(F.col("visitor") % 2, "mobile", "desktop"))),
            ("country", _quoted(_pick(F.col("visitor") % 4, "MX", "CO", "AR", "ES"))),
        ],
        "click": [
            ("element_id", _quoted(k.cast("string"))),
            ("element_type", _quoted(_pick(k % 3, "button", "link", "image"))),
            ("page_url", url),
            ("x_position", number),
            ("y_position", F.lit("5.0")),
        ],
        "search": [("query", _quoted(k.cast("string"))), ("results_count", number)],
        "product_view": [
            ("product_id", product),
            ("category", _quoted(_pick(k % 2, "books", "toys"))),
            ("price", F.when(damage == 5, F.lit("-10")).otherwise(F.lit("9.99"))),
            ("time_on_page_seconds", k.cast("string")),
        ],
        "cart_event": [
            ("product_id", product),
            (
                "action",
                _quoted(
                    F.when(damage == 5, F.lit("wipe")).otherwise(_pick(k % 2, "add", "remove"))
                ),
            ),
        ],
    }
    time = [("timestamp", _quoted(stamp))]
    extra = [("surprise", F.lit("1"))]
    whole = F.coalesce(
        *[
            F.when(
                F.col("event_type") == kind,
                F.when(damage == 3, _json(*head, *fields))
                .when(damage == 4, _json(*head, *time, *fields, *extra))
                .otherwise(_json(*head, *time, *fields)),
            )
            for kind, fields in body.items()
        ]
    )
    halved = F.expr("substring(whole, 1, cast(char_length(whole) / 2 as int))")
    bad_day = (F.dayofmonth("ts") % 10 == 0) & (k < 60)
    line = (
        F.when(bad_day | (damage == 1), halved)
        .when(damage == 7, F.lit("[1, 2]"))
        .when(damage == 8, F.lit("  "))
        .otherwise(F.col("whole"))
    )
    key = F.concat(
        F.date_format(F.col("ts").cast("timestamp"), "'events/year='yyyy'/month='MM'/day='dd'/events_'"),
        (F.col("visitor") % 4).cast("string"),
        F.lit(".jsonl"),
    )
    return (
        _numbered(spark, folder)
        .withColumn("whole", whole)
        .withColumn("line", line)
        .select(
            key.alias("source_key"),
            F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 60).alias("block"),
            "ts",
            "number",
            "copy",
            "k",
            "line",
            F.octet_length("line").cast("bigint").alias("line_bytes"),
        )
    )


def entity_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Users, products, sessions and transactions as JSON lines: ``entity, id, line``."""
    key = F.col("c_custkey")
    users = table(spark, folder, "customer").select(
        F.lit("user").alias("entity"),
        key.alias("id"),
        _json(
            ("user_id", _quoted(F.concat(F.lit("U"), F.lpad(key.cast("string"), 8, "0")))),
            ("signup_date", _quoted(F.lit("2024-01-01"))),
            (
                "country",
                _quoted(_pick(F.col("c_nationkey") % 6, "MX", "CO", "AR", "ES", "PE", "XX")),
            ),
            ("age_bucket", _quoted(_pick(key % 3, "18-24", "65+", "35-44"))),
            ("device_preference", _quoted(_pick(key % 3, "mobile", "desktop", "tablet"))),
            ("is_premium", F.when(key % 7 == 0, F.lit('"yes"')).otherwise(F.lit("true"))),
        ).alias("line"),
    )
    part = F.col("p_partkey")
    products = table(spark, folder, "part").select(
        F.lit("product").alias("entity"),
        part.alias("id"),
        _json(
            (
                "product_id",
                _quoted(F.concat(F.lit("P"), F.lpad((part % 1000000).cast("string"), 6, "0"))),
            ),
            ("category", _quoted(F.when(F.col("p_size") > 45, "tools").otherwise("home"))),
            ("subcategory", _quoted(F.col("p_type"))),
            ("name", _quoted(F.col("p_name"))),
            ("price", F.col("p_retailprice").cast("decimal(18,2)").cast("string")),
            (
                "stock",
                F.when(F.col("p_size") % 5 == 0, F.lit("7.5")).otherwise(
                    F.col("p_size").cast("string")
                ),
            ),
            ("brand", _quoted(F.col("p_brand"))),
            ("created_at", _quoted(F.lit("2024-01-01"))),
        ).alias("line"),
    )
    event, who = F.col("event_id"), F.col("user_id")
    sessions = table(spark, folder, "events").select(
        F.lit("session").alias("entity"),
        event.alias("id"),
        _json(
            (
                "session_id",
                _quoted(F.concat(F.lit("S"), F.lpad(event.cast("string"), 12, "0"))),
            ),
            ("user_id", _quoted(F.concat(F.lit("U"), F.lpad(who.cast("string"), 8, "0")))),
            ("start_time", _quoted(F.lit("2024-01-01T00:00:00Z"))),
            (
                "end_time",
                _quoted(
                    F.when(event % 9 == 0, "2024-01-01 00:10").otherwise("2024-01-01T00:10:00+02:00")
                ),
            ),
            ("device_type", _quoted(F.lit("mobile"))),
            ("browser", _quoted(_pick(event % 4, "chrome", "edge", "opera", "lynx"))),
            ("country", _quoted(F.lit("MX"))),
            (
                "referrer_source",
                F.when(event % 11 == 0, F.lit("null")).otherwise(F.lit('"organic"')),
            ),
        ).alias("line"),
    )
    order = F.col("o_orderkey")
    items = F.when(order % 10 == 0, F.lit("[]")).otherwise(
        F.concat(
            F.lit('["P000001","'),
            F.when(order % 13 == 0, F.lit("Q1")).otherwise(F.lit("P000002")),
            F.lit('"]'),
        )
    )
    transactions = table(spark, folder, "orders").select(
        F.lit("transaction").alias("entity"),
        order.alias("id"),
        _json(
            (
                "transaction_id",
                _quoted(F.concat(F.lit("T"), F.lpad(order.cast("string"), 16, "0"))),
            ),
            (
                "user_id",
                _quoted(F.concat(F.lit("U"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"))),
            ),
            ("session_id", _quoted(F.lit("Sabcdef123456"))),
            ("product_ids", items),
            ("total_amount", F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
            (
                "status",
                _quoted(
                    F.when(F.col("o_orderstatus") == "F", "completed")
                    .when(F.col("o_orderstatus") == "O", "pending")
                    .otherwise("failed")
                ),
            ),
            ("timestamp", _quoted(F.lit("2024-01-01T00:00:00.5Z"))),
        ).alias("line"),
    )
    return users.unionByName(products).unionByName(sessions).unionByName(transactions)
