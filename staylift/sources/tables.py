"""The application's seven tables, from Parquet, from a bucketed catalogue, or over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from staylift.schemas import NATIVE


@dataclass(frozen=True)
class Tables:
    accommodations: DataFrame
    users: DataFrame
    user_infos: DataFrame
    accommodation_types: DataFrame
    rooms: DataFrame
    reservations: DataFrame
    accommodation_adverts: DataFrame

    def __post_init__(self) -> None:
        for f in fields(self):
            check_columns(f.name, getattr(self, f.name))


def check_columns(table: str, df: DataFrame) -> None:
    """Fail early, with the table named, when a column is absent or has another type."""
    actual = {f.name: f.dataType for f in df.schema}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        + (actual[f.name].simpleString() if f.name in actual else "no such column")
        for f in NATIVE[table]
        if actual.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"table {table}: " + "; ".join(wrong))


def load_tables(spark: SparkSession, path: str) -> Tables:
    """Each table as ``<path>/<table>``: one Parquet file or a folder of them."""
    return Tables(**{name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in NATIVE.items()})


# Tables large enough to be worth pre-shuffling, and the key their joins use.
BUCKET_KEYS = {"reservations": "room_id", "rooms": "id", "accommodation_adverts": "accommodation_id"}


def save_bucketed(tables: Tables, database: str, buckets: int) -> None:
    """Write the catalogue so that bookings meet rooms, and adverts their accommodation, without a shuffle.

    Sorting bookings by time inside each bucket keeps row-group min/max narrow, so the look-back
    filter skips most of the file.
    """
    for f in fields(tables):
        df = getattr(tables, f.name)
        writer = df.write.mode("overwrite").format("parquet")
        if f.name in BUCKET_KEYS:
            order = "success_at" if f.name == "reservations" else BUCKET_KEYS[f.name]
            writer = writer.bucketBy(buckets, BUCKET_KEYS[f.name]).sortBy(order)
        writer.saveAsTable(f"{database}.{f.name}")


def load_catalogue(spark: SparkSession, database: str) -> Tables:
    return Tables(**{name: spark.table(f"{database}.{name}") for name in NATIVE})


def load_jdbc(
    spark: SparkSession, url: str, properties: dict[str, str], bounds: dict[str, tuple[int, int, int]]
) -> Tables:
    """Read from the live database. ``bounds[table] = (lowest id, highest id, partitions)`` splits a
    large table into parallel range scans; a table without bounds is read by one connection.
    """
    def read(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**properties)
        reader = reader.option("preferTimestampNTZ", "true")
        if name in bounds:
            low, high, parts = bounds[name]
            key = NATIVE[name][0].name
            reader = reader.options(
                partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
            )
        raw = reader.load()
        return raw.select(*[raw[f.name].cast(f.dataType).alias(f.name) for f in NATIVE[name]])

    return Tables(**{name: read(name) for name in NATIVE})
