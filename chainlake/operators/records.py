"""Nested API records to flat rows, and writing rows to a database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.functions import schemas

# Payload schemas of the two record sources.
WEATHER = (
    "location struct<name: string, localtime: string, utc_offset: string>, "
    "current struct<temperature: double, weather_descriptions: array<string>, wind_speed: double>"
)
PERSON = (
    "gender string, name struct<first: string, last: string>, "
    "location struct<street: struct<number: int, name: string>, city: string, state: string, "
    "country: string, postcode: string>, email string, login struct<username: string>, "
    "dob struct<date: string>, registered struct<date: string>, phone string, "
    "picture struct<medium: string>"
)


def weather_rows(payloads: DataFrame) -> DataFrame:
    r = F.from_json("payload", schemas.struct(WEATHER))
    return payloads.select(r.alias("r")).select(
        F.col("r.location.name").alias("city"),
        F.col("r.current.temperature").alias("temperature"),
        F.get("r.current.weather_descriptions", F.lit(0)).alias("weather_description"),
        F.col("r.current.wind_speed").alias("wind_speed"),
        F.try_to_timestamp("r.location.localtime", F.lit("yyyy-MM-dd HH:mm")).alias("time"),
        F.col("r.location.utc_offset").alias("utc_offset"),
    )


def person_rows(payloads: DataFrame) -> DataFrame:
    r = F.from_json("payload", schemas.struct(PERSON))
    street = F.concat_ws(" ", F.col("r.location.street.number").cast("string"), "r.location.street.name",
                         "r.location.city")
    return payloads.select(r.alias("r")).select(
        F.col("r.name.first").alias("first_name"), F.col("r.name.last").alias("last_name"), "r.gender",
        F.concat_ws(", ", street, "r.location.state", "r.location.country").alias("address"),
        F.col("r.location.postcode").alias("postcode"), "r.email",
        F.col("r.login.username").alias("username"), F.col("r.dob.date").alias("dob"),
        F.col("r.registered.date").alias("registration_date"), "r.phone",
        F.col("r.picture.medium").alias("picture"),
    )


def to_database(rows: DataFrame, url: str, table: str, properties: dict[str, str], writers: int = 8) -> None:
    """Append rows through JDBC. ``writers`` bounds the connections held open at once."""
    rows.coalesce(writers).write.mode("append").jdbc(url, table, properties=properties)
