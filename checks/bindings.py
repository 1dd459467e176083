"""The application's tables, expressed over the driver's Parquet files.

Every driver row takes part. Where an application row is to be absent (an order that is no advert),
it is present but unpaid, and the operator under test has to see that.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylift import Rules, Tables
from staylift.functions.clock import from_epoch_seconds, wall_micros

AS_OF = datetime(1998, 1, 15)
CONTACTS_AS_OF = datetime(2024, 2, 5)
RULES = Rules(name_words=("NATION_1", "BUILDING"), type_suffix="TURE")


# The driver's tables as declared in FIXTURES.md; a declared schema saves a look into every file.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey LONG, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
    "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING",
    "conversations": "conv_id LONG, turn LONG, role STRING, text STRING",
}


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def _users(df: DataFrame, key: str, name: str) -> DataFrame:
    """Addresses with gaps: some missing, some marked as tests, some of the house itself."""
    return df.selectExpr(
        f"{key} AS id",
        f"{name} AS name",
        f"""CASE WHEN {key} % 17 = 0 THEN NULL
                 WHEN {key} % 19 = 0 THEN concat('Test.', lower({name}), '@example.com')
                 WHEN {key} % 23 = 0 THEN concat(lower({name}), '@house.example')
                 ELSE concat(lower({name}), '@example.com') END AS email""",
    )


def _user_infos(df: DataFrame, key: str) -> DataFrame:
    """No record for some, two for every fourth user, and blanks around every seventh number."""
    prefix = f"CASE {key} % 3 WHEN 0 THEN '010' WHEN 1 THEN '02' ELSE '2' END"
    digits = f"lpad(CAST({key} AS STRING), 8, '0')"
    first = f"CASE WHEN {key} % 7 = 0 THEN concat('\\t', {prefix}, {digits}, '\\n') ELSE concat({prefix}, {digits}) END"
    numbers = f"CASE WHEN {key} % 4 = 0 THEN array({first}, concat('019', {digits})) ELSE array({first}) END"
    return df.filter(f"{key} % 13 <> 5").selectExpr(f"{key} AS user_id", f"explode({numbers}) AS phone_number")


def _accommodations(nation: DataFrame, df: DataFrame, key: str, name: str, nation_key: str, segment: str, type_id: str) -> DataFrame:
    return df.join(nation, F.expr(f"n_nationkey = {nation_key}")).selectExpr(
        f"{key} AS id",
        f"concat('[', n_name, '/', {segment}, '] ', {name}) AS name_expression",
        f"CAST({nation_key} AS LONG) AS sales_id",
        # Every fifth accommodation belongs to the owner of the one before it.
        f"{key} - CASE WHEN {key} % 5 = 4 THEN 1 ELSE 0 END AS user_id",
        f"{type_id} AS type_id",
        f"CASE WHEN {key} % 29 = 0 THEN TIMESTAMP_NTZ'1997-01-01' END AS deleted_at",
        f"{key} % 31 = 0 AS is_test",
    )


def _reservations(lineitem: DataFrame, room: str, created: str, success: str) -> DataFrame:
    """Bookings are confirmed some days after they are made, so that the two times cannot stand for each other."""
    price = "CAST(l_extendedprice AS DECIMAL(14,2))"
    discounted = f"CAST({price} * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(14,2))"
    return lineitem.selectExpr(
        "xxhash64(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS id",
        f"{room} AS room_id",
        """CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 1 WHEN 'AO' THEN 3 WHEN 'NF' THEN 6
             WHEN 'NO' THEN 7 WHEN 'RF' THEN 8 ELSE 12 END AS status""",
        f"{created} AS created_at",
        f"{success} AS success_at",
        f"CASE WHEN l_linenumber % 3 = 0 THEN {price} ELSE CAST(0 AS DECIMAL(14,2)) END AS suggestion_price",
        f"{price} AS total_price",
        f"CASE WHEN l_linenumber % 2 = 0 THEN CAST(0 AS DECIMAL(14,2)) ELSE {discounted} END AS total_price_set",
    )


def upsell_tables(spark: SparkSession, sf: str) -> Tables:
    """Customers as accommodations, orders as rooms and (a part of them paid) adverts, line items as bookings."""
    customer, orders = read(spark, sf, "customer"), read(spark, sf, "orders")
    nation, lineitem = read(spark, sf, "nation"), read(spark, sf, "lineitem")
    adverts = orders.selectExpr(
        "o_orderkey AS id",
        "o_custkey AS accommodation_id",
        "o_orderpriority AS advert_name",
        """CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0.30 WHEN '2-HIGH' THEN 0.20 WHEN '3-MEDIUM' THEN 0.15 ELSE 0.10 END
             AS DECIMAL(4,2)) AS advert_commission""",
        "CASE WHEN o_orderkey % 4 = 0 AND o_orderstatus <> 'P' THEN o_orderdate END AS success_at",
        "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL 365 DAYS END AS expiration_at",
    )
    return Tables(
        accommodations=_accommodations(
            nation, customer, "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "crc32(c_mktsegment)"
        ),
        users=_users(customer, "c_custkey", "c_name"),
        user_infos=_user_infos(customer, "c_custkey"),
        accommodation_types=customer.selectExpr("crc32(c_mktsegment) AS id", "c_mktsegment AS name").distinct(),
        rooms=orders.selectExpr("o_orderkey AS id", "o_custkey AS accommodation_id"),
        reservations=_reservations(lineitem, "l_orderkey", "l_shipdate", "l_shipdate + make_dt_interval(3 * l_linenumber)"),
        accommodation_adverts=adverts,
    )


def monthly_tables(spark: SparkSession, sf: str) -> Tables:
    """Suppliers as accommodations, (supplier, line number) as rooms, line items as adverts, paid if in bulk."""
    supplier, lineitem = read(spark, sf, "supplier"), read(spark, sf, "lineitem")
    packages = RULES.packages
    adverts = lineitem.selectExpr(
        "xxhash64(l_orderkey, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS id",
        "l_suppkey AS accommodation_id",
        f"CASE l_returnflag WHEN 'A' THEN '{packages.starter}' WHEN 'N' THEN '{packages.partner}' ELSE '{packages.top}' END AS advert_name",
        "CAST(CASE l_returnflag WHEN 'A' THEN 0.15 WHEN 'N' THEN 0.20 ELSE 0.30 END AS DECIMAL(4,2)) AS advert_commission",
        "CASE WHEN l_quantity >= 48 AND l_linenumber = 1 THEN l_shipdate END AS success_at",
        "l_shipdate + INTERVAL 730 DAYS AS expiration_at",
    )
    return Tables(
        accommodations=_accommodations(
            read(spark, sf, "nation"), supplier, "s_suppkey", "s_name", "s_nationkey", "'SUPPLIER'", "CAST(NULL AS LONG)"
        ),
        users=_users(supplier, "s_suppkey", "s_name"),
        user_infos=_user_infos(supplier, "s_suppkey"),
        accommodation_types=read(spark, sf, "region").selectExpr("CAST(r_regionkey AS LONG) AS id", "r_name AS name"),
        rooms=supplier.selectExpr("explode(transform(sequence(1, 7), n -> s_suppkey * 10 + n)) AS id", "s_suppkey AS accommodation_id"),
        reservations=_reservations(lineitem, "l_suppkey * 10 + l_linenumber", "l_shipdate - make_dt_interval(3 * l_linenumber)", "l_shipdate"),
        accommodation_adverts=adverts,
    )


def click_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """Every click event as a contact."""
    events = read(spark, sf, "events").filter(F.col("event_type") == "click")
    return events.select(F.col("user_id").alias("acm_id"), F.col("ts").alias("contacted_at"), "event_id")


def shown_log(spark: SparkSession, sf: str) -> DataFrame:
    return click_contacts(spark, sf).groupBy("acm_id").agg(F.max("contacted_at").alias("last_shown"))


def sent_log(spark: SparkSession, sf: str, users: DataFrame) -> DataFrame:
    """The shown log under the users' addresses."""
    log = shown_log(spark, sf).withColumnRenamed("acm_id", "id")
    return log.join(users, "id").filter(F.col("email").isNotNull()).select("email", F.col("last_shown").alias("last_sent"))


def _wrapped(copy: Column, key: Column, odd: Column) -> Column:
    """A response: bare JSON, fenced JSON, or broken (cut short, or a list)."""
    return (
        F.when(key % 3 == 0, copy)
        .when(key % 3 == 1, F.concat(F.lit("```json\n"), copy, F.lit("\n```")))
        .when(odd, F.concat(F.lit("["), copy, F.lit("]")))
        .otherwise(F.expr("left(copy, length(copy) - 1)"))
    )


def conversation_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation turn as the body of a generated copy."""
    turns = read(spark, sf, "conversations")
    subject = F.concat(F.lit("coupon "), F.col("role"), F.lit(" Package"))
    copies = turns.withColumn("copy", F.to_json(F.struct(subject.alias("subject"), F.col("text").alias("body"))))
    return copies.select(
        F.col("conv_id").alias("acm_id"), "turn", _wrapped(F.col("copy"), F.col("conv_id"), F.col("turn") % 2 == 1).alias("response")
    )


def partner_responses(partners: DataFrame, key: str, name: str) -> DataFrame:
    """Three generated copies for every partner, made one after the other (``made``), the last not the greatest text; of every
    third partner none can be read."""
    made = partners.withColumn("made", F.explode(F.sequence(F.lit(0), F.lit(2))))
    subject = F.concat(F.lit("쿠pon "), (9 - F.col("made")).cast("string"), F.lit(" "), F.col(name))
    body = F.concat(F.lit(" marketing push\n"), F.col(name), F.lit("\n"))
    copies = made.withColumn("copy", F.to_json(F.struct(subject.alias("subject"), body.alias("body"))))
    return copies.select(F.col(key).alias("acm_id"), "made", _wrapped(F.col("copy"), F.col(key), F.col("made") == 1).alias("response"))


ACTIONS = {
    "signup": "test_upsell_email", "view": "test_monthly_report", "click": "send_upsell_email", "purchase": "send_all_upsell",
}


def as_clicks(events: DataFrame) -> DataFrame:
    """Events as click requests: stamped at ``ts``, arriving k * 5 seconds later."""
    k = F.get_json_object("props", "$.k").cast("int")
    action = F.coalesce(
        # Purchases of even users approve monthly reports.
        F.when((F.col("event_type") == "purchase") & (F.col("user_id") % 2 == 0), F.lit("send_all_monthly_report")),
        F.try_element_at(F.create_map(*[F.lit(p) for item in ACTIONS.items() for p in item]), F.col("event_type")),
        F.lit("no_such_button"),
    )
    value = F.concat(F.col("user_id").cast("string"), F.lit(","), k.cast("string"))
    payload = F.to_json(
        F.struct(
            F.lit("block_actions").alias("type"),
            F.array(F.struct(action.alias("action_id"), value.alias("value"))).alias("actions"),
        )
    )
    epoch = F.floor(wall_micros(F.col("ts")) / 1_000_000).cast("long")
    return events.select(
        F.col("event_id").alias("click_id"),
        F.concat(F.lit("token=x&payload="), F.url_encode(payload)).alias("form_body"),
        epoch.cast("string").alias("request_ts"),
        from_epoch_seconds(epoch + k * 5).alias("arrived_at"),
    )


#: Forms that are of no use, by event_id % 13.
ODD_FORMS = {
    0: "token=x", 1: "payload=%7Bbroken", 2: "payload=%7B%22type%22%3A%22url_verification%22%7D", 8: "payload=%zz",
    3: "payload=%7B%22type%22%3A%22block_actions%22%2C%22actions%22%3A%5B%5D%7D",
}


def odd_clicks(events: DataFrame) -> DataFrame:
    """Clicks of which many are of no use: forms that cannot be read, buttons without ids, ids that are none, bad stamps, repeats."""
    kind = F.col("click_id") % 13
    made, user = as_clicks(events), events.select(F.col("event_id").alias("click_id"), "user_id")

    def sent(value: Column) -> Column:
        action = F.struct(F.lit("send_upsell_email").alias("action_id"), value.alias("value"))
        return F.concat(F.lit("payload="), F.url_encode(F.to_json(F.struct(F.lit("block_actions").alias("type"), F.array(action).alias("actions")))))

    form = F.when(kind == 4, sent(F.lit(""))).when(kind == 5, sent(F.concat(F.col("user_id").cast("string"), F.lit(", x,")))).otherwise(F.col("form_body"))
    for k, text in ODD_FORMS.items():
        form = F.when(kind == k, F.lit(text)).otherwise(form)
    odd = made.join(user, "click_id").withColumns({
        "form_body": form, "request_ts": F.when(kind == 6, "soon").otherwise(F.col("request_ts")), "arrived_at": F.when(kind != 7, F.col("arrived_at")),
    }).drop("user_id")
    return odd.unionByName(odd.filter(kind == 9)).unionByName(odd.filter(kind == 9))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf)
