"""Declared schemas. Database datetimes carry no zone, so they are TIMESTAMP_NTZ wall clock."""

from __future__ import annotations

from pyspark.sql import types as T

_PRICE = T.DecimalType(14, 2)
RATE = T.DecimalType(4, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


NATIVE = {
    "accommodations": _schema(
        id=T.LongType(), name_expression=T.StringType(), sales_id=T.LongType(), user_id=T.LongType(),
        type_id=T.LongType(), deleted_at=T.TimestampNTZType(), is_test=T.BooleanType(),
    ),
    "users": _schema(id=T.LongType(), name=T.StringType(), email=T.StringType()),
    "user_infos": _schema(user_id=T.LongType(), phone_number=T.StringType()),
    "accommodation_types": _schema(id=T.LongType(), name=T.StringType()),
    "rooms": _schema(id=T.LongType(), accommodation_id=T.LongType()),
    "reservations": _schema(
        id=T.LongType(), room_id=T.LongType(), status=T.IntegerType(),
        created_at=T.TimestampNTZType(), success_at=T.TimestampNTZType(),
        suggestion_price=_PRICE, total_price=_PRICE, total_price_set=_PRICE,
    ),
    "accommodation_adverts": _schema(
        id=T.LongType(), accommodation_id=T.LongType(), advert_name=T.StringType(),
        advert_commission=RATE, success_at=T.TimestampNTZType(), expiration_at=T.TimestampNTZType(),
    ),
}

SHOWN_LOG = _schema(acm_id=T.LongType(), last_shown=T.TimestampNTZType())
SENT_LOG = _schema(email=T.StringType(), last_sent=T.TimestampNTZType())
COPY = _schema(acm_id=T.LongType(), subject=T.StringType(), body=T.StringType())

# One click as the gateway lands it: the raw form body, the request's own epoch second, the arrival time.
CLICK_REQUEST = _schema(
    click_id=T.LongType(), form_body=T.StringType(), request_ts=T.StringType(), arrived_at=T.TimestampNTZType(),
)
CLICK_PAYLOAD = "type STRING, challenge STRING, actions ARRAY<STRUCT<action_id: STRING, value: STRING>>"
