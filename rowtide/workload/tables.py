"""Change-capture inputs derived by Spark from the sample tables.

Events become a topic (one message per event, keyed by user), orders become a change log (one
change per order, keyed by customer) and a polled table (one row per order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.messages import json_object, message_key
from rowtide.functions.times import to_iso
from rowtide.session import scratch
from rowtide.sources.topic import Topic
from rowtide.spec import CREATE, DELETE, ISO, MICROS, UPDATE, Field, TableSpec

EVENT_SPEC = TableSpec(
    {
        "name": Field("name"),
        "value": Field("value", "double"),
        "created_at": Field("created_at", "timestamp"),
    },
    key="id",
    time_format=MICROS,
)

ORDER_SPEC = TableSpec(
    {
        "name": Field("name", missing=""),
        "price": Field("price", "double"),
        "created_at": Field("created_at", "timestamp"),
    },
    key="id",
    ops=(CREATE, UPDATE, DELETE),
    time_format=ISO,
)

POLL_SPEC = TableSpec(
    {
        "name": Field("name"),
        "price": Field("price", "double"),
        "created_at": Field("created_at", "timestamp"),
    },
    key="id",
    time_format=MICROS,
)

TOPIC_PARTITIONS = 4
EVENTS_CUT = "2024-01-16 00:00:00"  # between the two landings
ORDERS_CUT = "2000-12-01 00:00:00"  # between the state and the changes applied to it
THINNED_AT = "2010-01-01 00:00:00"  # when orders are marked as deleted, and others removed
FULFILMENT_DAYS = 400  # from creation to the update of a fulfilled order
WITHDRAWAL_DAYS = 300  # from creation to the removal of an order in process
LOGGED_FROM = "1997-07-01 00:00:00"  # the log of booked orders holds later changes only
# When a snapshot in four ranges looks at the table or its log: the starts of quarters.
LOOKS = [f"{1998 + n // 4}-{n % 4 * 3 + 1:02d}-01 00:00:00" for n in range(13)]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# -- events as a topic --------------------------------------------------------------------


def event_op() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "signup", CREATE).when(kind == "error", DELETE).otherwise(UPDATE)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as typed changes."""
    ts = F.col("ts").cast("timestamp")
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("name"),
        "value",
        ts.alias("created_at"),
        event_op().alias("__op"),
        ts.alias("kafka_timestamp"),
        F.pmod("user_id", F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def event_message() -> Column:
    return json_object(
        {
            "id": F.col("id"),
            "name": F.col("name"),
            "value": F.col("value"),
            "created_at": F.unix_micros("created_at"),
            "__op": F.col("__op"),
        }
    )


def event_messages(rows: DataFrame, *keep: str) -> DataFrame:
    """Placed events as messages."""
    value, at_time = event_message().alias("value"), F.col("kafka_timestamp").alias("timestamp")
    return rows.select(*keep, "event_id", "key", value, at_time)


def as_topic(rows: DataFrame, value: Column, key: Column | None = None) -> DataFrame:
    """Rows with their place to Kafka-shaped records."""
    return rows.select(
        (message_key(F.col("id")) if key is None else key).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        "partition",
        "offset",
        F.col("kafka_timestamp").alias("timestamp"),
    )


def events_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per event. The event id serves as offset: it rises within a partition, with
    gaps, as Kafka offsets may."""
    return as_topic(event_rows(spark, sf_dir), event_message())


def written_topic(spark: SparkSession, sf_dir: str) -> Topic:
    topic = Topic(spark, scratch(spark, "topic"), "events", TOPIC_PARTITIONS)
    topic.append(events_topic(spark, sf_dir))
    return topic


def faulty_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events topic with high-value events spoilt in a way that depends on their type."""
    spoilt, name = F.col("value") > 100, F.col("name")
    value = (
        F.when(spoilt & (name == "signup"), "oops")
        .when(spoilt & (name == "click"), "{}")
        .when(spoilt & (name == "view"), json_object({"id": F.col("id"), "__op": F.lit("t")}))
        .when(spoilt & (name == "purchase"), '{"id":"abc","__op":"u"}')
        .when(spoilt & (name == "error"), F.lit(None))
        .otherwise(event_message())
    )
    key = F.when(~(spoilt & name.isin("click", "purchase")), message_key(F.col("id")))
    return as_topic(event_rows(spark, sf_dir), value, key)


def tombstone_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events topic with every delete sent as a key without a value."""
    value = F.when(F.col("__op") != DELETE, event_message())
    return as_topic(event_rows(spark, sf_dir), value)


def nested_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events topic as before/after envelopes, each delete followed by a tombstone."""
    row = F.struct("id", "name", "value", F.unix_micros("created_at").alias("created_at"))
    op = F.col("__op")
    envelope = json_object(
        {
            "before": F.when(op != CREATE, row),
            "after": F.when(op != DELETE, row),
            "source": F.struct(F.unix_millis("kafka_timestamp").alias("ts_ms")),
            "op": op,
        }
    )
    sent = F.when(op == DELETE, F.array(envelope, F.lit(None))).otherwise(F.array(envelope))
    rows = event_rows(spark, sf_dir).select("*", F.posexplode(sent).alias("_n", "_value"))
    return as_topic(rows.withColumn("offset", F.col("offset") * 2 + F.col("_n")), F.col("_value"))


def lagged_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events topic with the time of each change at its source; records reach the topic up to 5 s after it."""
    rows = event_rows(spark, sf_dir).withColumn("source_ms", F.unix_millis("kafka_timestamp"))
    late = F.make_dt_interval(secs=(F.pmod("offset", F.lit(51)) / 10).cast("decimal(18,6)"))
    message = json_object({"id": F.col("id"), "__op": F.col("__op"), "__source_ts_ms": F.col("source_ms")})
    return as_topic(rows.withColumn("kafka_timestamp", F.col("kafka_timestamp") + late), message)


# -- orders as a change log ---------------------------------------------------------------


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as typed changes of their customer's latest-order row."""
    status = F.col("o_orderstatus")
    ts = F.col("o_orderdate").cast("timestamp")
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("price"),
        ts.alias("created_at"),
        F.when(status == "O", CREATE).when(status == "P", UPDATE).otherwise(DELETE).alias("__op"),
        ts.alias("kafka_timestamp"),
        F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"),
    )


def order_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change per order. New images of updates lack the creation stamp, and the name where
    the priority is low, as a row image may."""
    status, low = F.col("o_orderstatus"), F.col("o_orderpriority") == "5-LOW"
    update = status == "P"
    image = F.to_json(
        F.struct(
            F.col("o_custkey").alias("id"),
            F.when(~(update & low), F.col("o_orderpriority")).alias("name"),
            F.col("o_totalprice").alias("price"),
            F.when(~update, to_iso(F.col("o_orderdate").cast("timestamp"))).alias("created_at"),
        )
    )
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("change_id"),
        F.concat(F.lit("orders_"), F.substring("o_orderpriority", 1, 1)).alias("table_name"),
        F.when(status == "O", "I").when(update, "U").otherwise("D").alias("operation"),
        F.col("o_custkey").alias("record_id"),
        F.when(status != "O", image).alias("old_data"),
        F.when(status != "F", image).alias("new_data"),
        F.col("o_orderdate").cast("timestamp").alias("changed_at"),
        F.lit(False).alias("processed"),
    )


# -- orders as a polled table -------------------------------------------------------------


def polled_orders(spark: SparkSession, sf_dir: str, now: str | None = None) -> DataFrame:
    """The order table as it stands at ``now`` (by default after all changes): an order exists
    from its date on and is updated when it is fulfilled."""
    orders = read(spark, sf_dir, "orders")
    created = F.col("o_orderdate").cast("timestamp")
    done_at = created + F.make_dt_interval(F.lit(FULFILMENT_DAYS))
    done = F.col("o_orderstatus") == "F"
    if now is not None:
        orders = orders.filter(F.col("o_orderdate") <= F.lit(now).cast("timestamp_ntz"))
        done = done & (done_at <= at(now))
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(done, "fulfilled").otherwise("open").alias("name"),
        F.col("o_totalprice").alias("price"),
        created.alias("created_at"),
        F.when(done, done_at).otherwise(created).alias("updated_at"),
    )


def thinned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polled table after orders without a priority were marked as deleted and those of low priority removed."""
    priority = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority")
    rows = polled_orders(spark, sf_dir).join(priority.filter("o_orderpriority <> '5-LOW'"), "id")
    marked = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", at(THINNED_AT))
    return rows.select(
        "id", "name", "price", "created_at", F.coalesce(marked, "updated_at").alias("updated_at"), marked.alias("deleted_at")
    )


def booked_orders(spark: SparkSession, sf_dir: str, now: str | None = None) -> DataFrame:
    """The polled table without the orders that are withdrawn by ``now`` (by default all of them): those in process,
    some days after their date."""
    status = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    rows = polled_orders(spark, sf_dir, now).join(status, "id")
    gone = F.col("o_orderstatus") == "P"
    if now is not None:
        gone = gone & (F.col("created_at") + F.make_dt_interval(F.lit(WITHDRAWAL_DAYS)) <= at(now))
    return rows.filter(~gone).select("id", "name", "price", "created_at")


def booked_changelog(spark: SparkSession, sf_dir: str, now: str | None = None) -> DataFrame:
    """The change log of that table as it stands at ``now``: each order's entry, its fulfilment, its withdrawal, as
    far as they came after capture began."""
    created, status = F.col("o_orderdate").cast("timestamp"), F.col("o_orderstatus")
    image = [F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), to_iso(created).alias("created_at")]
    before, after = (F.to_json(F.struct(F.lit(name).alias("name"), *image)) for name in ("open", "fulfilled"))
    none = F.lit(None).cast("string")
    steps = [("I", status.isNotNull(), none, before, 0), ("U", status == "F", before, after, FULFILMENT_DAYS)]
    steps += [("D", status == "P", before, none, WITHDRAWAL_DAYS)]
    each = [
        F.when(
            happens,
            F.struct(
                (F.col("o_orderkey") * len(steps) + n).alias("change_id"),
                F.lit("orders").alias("table_name"),
                F.lit(operation).alias("operation"),
                F.col("o_orderkey").alias("record_id"),
                old.alias("old_data"),
                new.alias("new_data"),
                (created + F.make_dt_interval(F.lit(days))).alias("changed_at"),
                F.lit(False).alias("processed"),
            ),
        )
        for n, (operation, happens, old, new, days) in enumerate(steps)
    ]
    log = read(spark, sf_dir, "orders").select(F.inline(F.array_compact(F.array(*each))))
    log = log.filter(F.col("changed_at") > at(LOGGED_FROM))
    return log if now is None else log.filter(F.col("changed_at") <= at(now))


def stamped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose update stamp lies less than, exactly, or an unknown time after creation."""
    status, created = F.col("o_orderstatus"), F.col("o_orderdate").cast("timestamp")
    gap = F.when(status == "O", F.expr("interval 0.999999 seconds")).otherwise(F.expr("interval 1 second"))
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("price"),
        F.when(status != "F", created).alias("created_at"),
        (created + gap).alias("updated_at"),
    )
