"""Column builders for classification, keys, times and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainlake.functions.hexnum import hex_to_long

# Selectors of the two proxy presets.
PROXY_UPGRADE = ("0x5c60da1b", "0x3659cfe6")
PROXY_ROUTER = ("0x5ae401dc", "0x1cff79cd", "0x3593564c")

BLOCKS_PER_BUCKET = 1_000_000


# ---- transactions -------------------------------------------------------------------


def has_input(input_data: Column) -> Column:
    return F.coalesce(input_data != "0x", F.lit(False))


def method_id(input_data: Column) -> Column:
    return F.when(has_input(input_data), F.substring(input_data, 1, 10))


def input_length(input_data: Column) -> Column:
    return F.length(input_data)


def input_words(input_data: Column) -> Column:
    """Words of 64 digits after the prefix, fractional."""
    return (F.length(input_data) - 2) / 64


def arg_words(input_data: Column) -> Column:
    """Whole argument words after the selector; NULL without input."""
    whole = F.floor((F.length(input_data) - 10) / 64).cast("bigint")
    return F.when(has_input(input_data), whole)


def input_hash(input_data: Column) -> Column:
    return F.sha2(input_data, 256)


def is_proxy_like(input_data: Column, selectors=PROXY_UPGRADE, min_words: int = 0) -> Column:
    hit = method_id(input_data).isin(*selectors)
    if min_words:
        hit = hit & (arg_words(input_data) >= min_words)
    return F.coalesce(hit, F.lit(False))


def address(c: Column) -> Column:
    """Lower-case address; empty text counts as absent."""
    return F.nullif(F.lower(c), F.lit(""))


def tx_kind(to_address: Column, input_data: Column) -> Column:
    return (
        F.when(F.nullif(to_address, F.lit("")).isNull(), "contract_creation")
        .when(input_data == "0x", "transfer")
        .otherwise("contract_call")
    )


def fee_model(tx_type: Column) -> Column:
    return (
        F.when(tx_type == "0x2", "eip1559")
        .when(tx_type == "0x1", "access_list")
        .otherwise("legacy")
    )


def strip_type(tx_type: Column) -> Column:
    return F.regexp_replace(tx_type, "^0x", "")


def composite_id(prefix: str, tx_hash: Column, tx_index: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), tx_hash, F.lit("_"), tx_index.cast("string"))


def block_bucket(block_number: Column, width: int = BLOCKS_PER_BUCKET) -> Column:
    return F.floor(block_number / F.lit(width)).cast("bigint")


# ---- blocks -------------------------------------------------------------------------


def block_number(c: Column) -> Column:
    """A block number given as decimal or hex text."""
    return F.coalesce(c.try_cast("bigint"), hex_to_long(c))


# ---- time ---------------------------------------------------------------------------


def unix_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


# Fixed value: timestamps in records.
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSX"


def iso_ts(c: Column) -> Column:
    """ISO-8601 text with milliseconds and zone; NULL when it does not parse."""
    return F.try_to_timestamp(c, F.lit(ISO))


def to_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def now_iso() -> Column:
    return to_iso(F.current_timestamp())


def day_start(day: Column) -> Column:
    """UTC epoch of a day's first second."""
    return F.unix_timestamp(day.cast("date").cast("timestamp"))


def next_day_start(day: Column) -> Column:
    return day_start(F.date_add(day.cast("date"), 1))


# ---- keys and text ------------------------------------------------------------------


def split_state_key(key: Column) -> Column:
    """``chain:entity:type`` (or the same with ``_``) as a struct; missing parts are NULL."""
    parts = F.split(key, "[:_]", 3)
    return F.struct(
        F.get(parts, 0).alias("chain"),
        F.get(parts, 1).alias("entity"),
        F.get(parts, 2).alias("type"),
    )


# Characters replaced in file names, and their longest length.
PATH_CHARACTERS = r'[\\/:*?"<>|]'
NAME_WIDTH = 120


def safe_name(c: Column, width: int = NAME_WIDTH) -> Column:
    """A file name without path characters, trimmed and shortened."""
    return F.substring(F.trim(F.regexp_replace(c, PATH_CHARACTERS, "_")), 1, width)


def occurrences(text: Column, word: str) -> Column:
    """Non-overlapping occurrences of a literal word."""
    gone = F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))
    return F.floor(gone / F.lit(len(word))).cast("bigint")


def bytes_text(c: Column) -> Column:
    """Bytes as ``0x`` hex text."""
    return F.concat(F.lit("0x"), F.lower(F.hex(c)))
