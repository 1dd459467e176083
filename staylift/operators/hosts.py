"""Accommodations that may be contacted, and their hosts.

What is keyed by accommodation comes first, so that a job's selective joins (adverts, bookings) have thinned the list
before users and phones are looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylift.config import Rules
from staylift.functions.names import region_of
from staylift.operators.filters import (
    exclude_house_domain,
    exclude_name_all_of,
    exclude_test_email,
    exclude_type_suffix,
    live_accommodations,
)
from staylift.sources.tables import Tables


def eligible_accommodations(t: Tables, rules: Rules) -> DataFrame:
    """acm_id, acm_name, sales_id, user_id, region of live accommodations whose name and type are not excluded."""
    named = exclude_name_all_of(live_accommodations(t.accommodations), "name_expression", rules.name_words)
    name = F.col("name_expression")
    return exclude_type_suffix(named, t.accommodation_types, rules.type_suffix).select(
        F.col("id").alias("acm_id"), name.alias("acm_name"), "sales_id", "user_id", region_of(name).alias("region")
    )


def with_users(acm: DataFrame, t: Tables, rules: Rules, *, exclude_test: bool) -> DataFrame:
    """Add host_name and host_email; accommodations whose host has no address, or an excluded one, drop out."""
    users = exclude_house_domain(t.users, "email", rules.house_domain)
    if exclude_test:
        users = exclude_test_email(users, "email", rules.test_marker)
    # One row per user, so only an owner of very many accommodations is a hot key, and Spark may split that side.
    return acm.join(users.selectExpr("id AS user_id", "name AS host_name", "email AS host_email"), "user_id")


def with_phones(hosts: DataFrame, t: Tables, *, compat: bool = False, listed: bool = False) -> DataFrame:
    """Add host_phone and host_copies.

    A host with several phone records keeps the smallest number. With ``compat`` each number makes a row of its own and
    ``host_copies`` says how often it occurs, which is how often its bookings count. ``listed`` says that ``hosts`` is a
    stored list, which is then read a second time to look up no other phones.
    """
    infos = t.user_infos.selectExpr("user_id", "phone_number AS host_phone")
    if listed:
        infos = infos.join(hosts.select("user_id").distinct(), "user_id", "left_semi")
    if compat:
        phones = infos.groupBy("user_id", "host_phone").agg(F.expr("count(1) AS host_copies"))
    else:
        phones = infos.groupBy("user_id").agg(F.expr("min(host_phone) AS host_phone"), F.expr("1L AS host_copies"))
    return hosts.join(phones, "user_id", "left").withColumn("host_copies", F.expr("coalesce(host_copies, 1)"))
