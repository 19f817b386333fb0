"""Edge rows of the scalar functions."""

import datetime
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chainlake.functions import columns as C
from chainlake.functions import hexnum as H
from chainlake.functions import schemas
from chainlake.operators import silver


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_hex_to_long(spark):
    got = values(spark, H.hex_to_long, ["0x4b67a6d", "0x0", "0x00", "0x8ac7230489e80000", "0x7fffffffffffffff",
                                        "0x" + "f" * 64, "0x", "", None, "zz", "0x00000000000000000000000012"])
    assert got == [79067757, 0, 0, None, 2**63 - 1, None, None, None, None, None, 18]


def test_hex_to_decimal(spark):
    top = 10**38 - 1
    got = values(spark, H.hex_to_decimal, ["0x8ac7230489e80000", hex(top), hex(top + 1), hex(2**128 - 1), hex(2**128),
                                           "0x" + "f" * 64, "0x0", "0x", None])
    assert got == [Decimal(10**19), Decimal(top), None, None, None, None, Decimal(0), None, None]


def test_hex64_orders_like_numbers(spark):
    numbers = [0, 1, 255, 2**64, 10**38, 2**128, 2**255, 2**256 - 1]
    got = values(spark, H.hex64, [hex(n) for n in numbers])
    assert got == sorted(got) and [int(g, 16) for g in got] == numbers
    assert values(spark, H.hex64, ["0x", None, "0xAB"]) == [None, None, "ab".rjust(64, "0")]


def test_narrow_unsigned(spark):
    assert values(spark, H.hex_to_uint64, ["0xffffffffffffffff", "0x1ffffffffffffffff", "0x"]) == [
        Decimal(2**64 - 1), Decimal(2**64 - 1), None]
    assert values(spark, H.hex_to_uint32, ["0xffffffff", "0x38"]) == [2**32 - 1, 56]


def test_input_columns(spark):
    inputs = ["0x", None, "0x5c60da1b" + "0" * 64, "0xa9059cbb" + "0" * 128]
    assert values(spark, C.has_input, inputs) == [False, False, True, True]
    assert values(spark, C.is_proxy_like, inputs) == [False, False, True, False]
    assert values(spark, C.method_id, inputs) == [None, None, "0x5c60da1b", "0xa9059cbb"]
    assert values(spark, C.arg_words, inputs) == [None, None, 1, 2]


def test_kind_of_missing_receiver(spark):
    df = spark.createDataFrame([(None, "0x"), ("", "0x12"), ("0xa", "0x"), ("0xa", "0x12")], "t string, d string")
    got = [r[0] for r in df.select(C.tx_kind(F.col("t"), F.col("d"))).collect()]
    assert got == ["contract_creation", "contract_creation", "transfer", "contract_call"]


def test_state_keys(spark):
    got = values(spark, C.split_state_key, ["bsc:logs:realtime", "bsc_realtime_logs", "bsc.x", "a:b"])
    assert [tuple(g) for g in got] == [("bsc", "logs", "realtime"), ("bsc", "realtime", "logs"), ("bsc.x", None, None),
                                       ("a", "b", None)]


def test_times(spark):
    assert values(spark, C.iso_ts, ["2026-01-11T10:20:30.123Z", "nonsense", None]) == [
        datetime.datetime(2026, 1, 11, 10, 20, 30, 123000), None, None]
    assert values(spark, C.day_start, ["1970-01-02"]) == [86400]
    assert values(spark, C.next_day_start, ["1970-01-02"]) == [172800]


@pytest.mark.parametrize("text,word,n", [("ethereum eth method", "eth", 3), ("aaaa", "aa", 2), ("", "x", 0), ("Éth é", "é", 1)])
def test_occurrences(spark, text, word, n):
    assert values(spark, lambda c: C.occurrences(c, word), [text]) == [n] == [text.count(word)]


def test_safe_name(spark):
    assert values(spark, C.safe_name, [' a/b:c*?"<>|\\ ', "x" * 200]) == ["a_b_c" + "_" * 7, "x" * 120]


def test_unparsed_payloads_are_dropped(spark):
    raws = ['{"hash":"0x1","from":null}', '{"hash":"0x1","from":null,"x":', '{"hash":""}', '{"from":"0x2"}', None, "[]"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    kept = silver.parse(df, ["i"], schemas.only(schemas.TX_JSON, "hash", "from"), "hash")
    assert [r["i"] for r in kept.collect()] == [0]


def test_parses_once(src):
    plan = silver.enriched_tx(src.view("tx"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


ODD_QUANTITIES = [None, "", "0x", "0x0", "0xG1", "12", "0xAbC", "0x5208", "0x" + "f" * 8, "0x1" + "0" * 8, "0x" + "f" * 16, "0x1" + "0" * 16,
                  "0x" + "9" * 31, "0x" + "f" * 32, "0x" + "f" * 33, "0x" + "1234567890abcdef" * 4, "0x1" + "0" * 64, "0x" + "0" * 40 + "c" * 32]


def test_quantities_taken_from_the_end(spark):
    """Limbs equal those of the padded word, for every length of text and beyond a word."""
    def wanted(text):
        if text is None or not re.fullmatch("0x[0-9a-fA-F]+", text):
            return None, None, None, None
        word = text[2:66].rjust(64, "0").lower()
        low = int(word[32:], 16) if re.fullmatch("0x0*[0-9a-fA-F]{1,32}", text) else 10**38
        return word, int(word[48:], 16), int(word[56:], 16), low if low < 10**38 else None

    texts = ODD_QUANTITIES + ["0x" + "a1" * n for n in range(1, 40)]
    df = spark.createDataFrame([(t,) for t in texts], "c string").select(
        "c", H.hex64(F.col("c")).alias("w"), H.hex_to_uint64(F.col("c")).alias("l"), H.hex_to_uint32(F.col("c")).alias("i"),
        H.hex_to_decimal(F.col("c")).alias("d"))
    got = {r.c: (r.w, None if r.l is None else int(r.l), r.i, None if r.d is None else int(r.d)) for r in df.collect()}
    assert got == {t: wanted(t) for t in texts}


def test_no_padding_character_by_character(src):
    """``lpad`` took about a third of the time of silver transactions."""
    for made in (src.view("tx"), silver.fact_tx(src.view("tx")), silver.normalized_tx(src.view("tx")), src.view("logs"), src.view("trunk")):
        assert "lpad(" not in made._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name, padded", [("tx", 5), ("logs", 4), ("trunk", 2)])
def test_repeated_digits_are_made_once(src, name, padded):
    """Payloads mention a padded number up to eight times a row, most in CASE branches."""
    plan = src.view(name)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("repeat(") == padded
