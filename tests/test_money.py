import pytest
from pyspark.sql import functions as F

from spanloom.functions import money

FILLED = [
    ("四萬五千零三元", "四萬五千零三元"),
    ("八百三十億零九千四百六十九萬六千五百一十元", "八百三十億零九千四百六十九萬六千五百一十元"),
    ("四萬元", "四萬元"),
    ("三十五萬五百元", "三十五萬零五百元"),
    ("十五萬兩百零二元", "十五萬零兩百零二元"),
    ("四千零三萬五百元", "四千零三萬零五百元"),
    ("五百三元", "五百零三元"),
    ("四千五百兆五億七千三百零六萬四十元", "四千五百兆零五億零七千三百零六萬零四十元"),
    ("四十八億五百三十元", "四十八億零五百三十元"),
    ("九千九百億九十九萬九百元", "九千九百億零九十九萬零九百元"),
    ("五百五百元", None),
]

PARSED = [
    ("123萬03元", 1230003),
    ("70２萬２３", 7020023),
    ("七千二十萬0３元", 70200003),
    ("八亿五佰33万４千３十", 805334030),
    ("八拾參亿伍佰33万４千兩百玖十捌", 8305334298),
    ("壹億參仟肆佰伍拾貳萬玖仟捌佰柒拾陸元", 134529876),
    ("拾捌億壹仟贰佰叁拾肆万陆仟柒佰玖拾伍元", 1812346795),
    ("五萬萬元", None),
    ("i310750", None),
    ("3107 50", None),
    ("幾萬元", None),
    ("四萬五千零三元", 45003),
    ("三十五萬五百元", 350500),
    ("十五萬兩百零二元", 150202),
    ("四千五百兆五億七千三百零六萬四十元", 4500000573060040),
    ("九千九百億九十九萬九百元", 990000990900),
    ("150000元", 150000),
    ("萬元", None),
    ("", None),
    ("元", None),
    ("9999999999999999999", None),
]

RAW = [
    ("30,000元", "30000", "30000"),
    ("約5萬餘元", "nan", "nan"),
    ("5萬餘元", "50000", "50000"),
    ("3107 50", "310750", "310750"),
    ("1.5萬", "nan", "150000"),
    ("nan", "nan", "nan"),
    (None, "nan", "nan"),
    ("不詳", "nan", "nan"),
]


def test_parse(spark):
    df = spark.createDataFrame(PARSED, "raw string, expected bigint")
    rows = df.select("raw", "expected", money.parse_amount(F.col("raw")).alias("got")).collect()
    assert [(r.raw, r.got) for r in rows] == [(r.raw, r.expected) for r in rows]


def test_fill_zeros(spark):
    df = spark.createDataFrame(FILLED, "raw string, expected string")
    rows = df.select("raw", "expected", money.fill_zeros(F.col("raw")).alias("got")).collect()
    assert [(r.raw, r.got) for r in rows] == [(r.raw, r.expected) for r in rows]


def test_normalize(spark):
    df = spark.createDataFrame(RAW, "raw string, expected string, compat string")
    rows = df.select("*", money.normalize_money(F.col("raw")).alias("got"), money.normalize_money(F.col("raw"), compat=True).alias("got_compat")).collect()
    assert [(r.raw, r.got, r.got_compat) for r in rows] == [(r.raw, r.expected, r.compat) for r in rows]


def test_remain_outlier_and_columns(spark):
    df = spark.createDataFrame([("1", "幾 萬元"), ("2", "3萬")], "id string, `醫療費` string")
    out = money.convert_money_columns(df, ["醫療費", "收入"], remain_outlier=True).orderBy("id").collect()
    assert [r["醫療費"] for r in out] == ["幾萬元", "30000"]
    rate = money.conversion_error_rate(df, ["醫療費"]).first()
    assert (rate.failed, rate.total, rate.error_rate) == (1, 2, 0.5)
    assert [r.raw for r in money.failed_amounts(df, "醫療費").collect()] == ["幾 萬元"]


def test_every_number_round_trips(spark):
    """Numbers written by an independent speller come back."""
    digits = "零一二三四五六七八九"

    def section(n):
        out, zero = "", False
        for unit, weight in (("千", 1000), ("百", 100), ("十", 10), ("", 1)):
            d = n // weight % 10
            if d:
                out += ("零" if zero and out else "") + digits[d] + unit
                zero = False
            else:
                zero = True
        return out

    def spell(n):
        out = ""
        for unit, weight in (("兆", 10**12), ("億", 10**8), ("萬", 10**4), ("", 1)):
            s = n // weight % 10000
            if s:
                out += ("零" if out and s < 1000 else "") + section(s) + unit
        return out + "元"

    numbers = [(n * 7919**k) % 10**16 + 1 for n in range(1, 200) for k in (0, 1, 2, 3)]
    df = spark.createDataFrame([(n, spell(n)) for n in numbers], "n bigint, raw string")
    assert df.where(~money.parse_amount(F.col("raw")).eqNullSafe(F.col("n"))).count() == 0


def test_amounts_up_to_a_bigint(spark):
    rows = [("1234567890123456元", 1234567890123456), ("123456789012345678元", 123456789012345678), ("9223372036854775807元", 2**63 - 1), ("9223372036854775808元", None), ("922萬3372兆", None), ("99999999兆", None), ("9223372兆", 9223372 * 10**12), ("123456789012345678901234567890元", None)]
    got = spark.createDataFrame(rows, "raw string, want bigint").select("raw", "want", money.money_to_number(F.col("raw")).alias("got")).collect()
    assert [(r.raw, r.got) for r in got] == [(raw, want) for raw, want in rows]
