import pytest
from pyspark.sql import functions as F

from keylane.functions import scalars as S
from keylane.operators.filters import expire, filter_allowed_events, filter_own_messages, filter_topics

TYPES = ["user.created", "account.deleted", "admin.user.created", "my.account.deleted", "notification", "user.",
         "User.created", None]


def types(df):
    return {r["type"] for r in df.collect()}


@pytest.fixture(scope="module")
def typed(spark):
    return spark.createDataFrame([(t,) for t in TYPES], "type string")


def test_prefixes_match_from_the_start(typed):
    got = types(filter_allowed_events(typed, ["user.", "account."]))
    assert got == {"user.created", "account.deleted", "user.", None}


def test_one_prefix_as_text_and_none(typed):
    assert types(filter_allowed_events(typed, "account.")) == {"account.deleted", None}
    for empty in (None, []):
        assert types(filter_allowed_events(typed, empty)) == set(TYPES)


def test_own_messages(spark):
    df = spark.createDataFrame([(1, "me"), (2, "other"), (3, None)], "n int, source_system string")
    assert [r["n"] for r in filter_own_messages(df, "me").orderBy("n").collect()] == [2, 3]


def test_topics(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "topic string")
    assert filter_topics(df, "a").count() == 1
    assert filter_topics(df, ["a", "c"]).count() == 2


def test_expiry_keeps_the_exact_age(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "ts_us bigint")
    assert sorted(r[0] for r in expire(df, 10_000_001, 10).collect()) == [1, 2]


SECOND = 1_000_000


@pytest.mark.parametrize("micros, second", [
    (0, 0), (499_999, 0), (500_000, 1), (1_499_999, 1), (1_500_000, 2), (-1, None), (-SECOND, None),
    ((2**32 - 1) * SECOND, 2**32 - 1), ((2**32 - 1) * SECOND + 499_999, 2**32 - 1),
    ((2**32 - 1) * SECOND + 500_000, None), (2**32 * SECOND, None),
])
def test_rounding(spark, micros, second):
    df = spark.createDataFrame([(micros,)], "m bigint")
    got = df.select(S.round_to_second(F.col("m")), S.invalid_time(F.col("m"))).first()
    assert tuple(got) == (second, second is None)


def test_rounding_strict(spark):
    df = spark.createDataFrame([(-1,)], "m bigint").select(S.round_to_second(F.col("m"), strict=True).alias("s"))
    with pytest.raises(Exception, match="1970-2106"):
        df.collect()


@pytest.mark.parametrize("attempt, delay", [(1, 20), (2, 40), (3, 80), (14, 163_840), (15, 300_000), (10_000, 300_000)])
def test_backoff(spark, attempt, delay):
    df = spark.createDataFrame([(attempt,)], "a int")
    assert df.select(S.backoff_delay(F.col("a"), 20, 300_000)).first()[0] == delay


@pytest.mark.parametrize("wait, boost", [(0, 0), (-5, 0), (60_000, 50_000), (120_000, 200_000), (10**9, 200_000)])
def test_wait_boost(spark, wait, boost):
    df = spark.createDataFrame([(wait,)], "w bigint")
    assert df.select(S.wait_boost(F.col("w"), 120_000, 200_000)).first()[0] == boost


def test_task_ids(spark):
    row = spark.createDataFrame([("t", 3, 12, "k", 1_700_000_000)], "t string, p int, o bigint, k string, s bigint")
    got = row.select(S.message_task_id(F.col("t"), F.col("p"), F.col("o")), S.timer_task_id(F.col("k"), F.col("s")))
    assert tuple(got.first()) == ("t/3:12", "timer/k/2023-11-14T22:13:20Z")


def test_payload_fields(spark):
    df = spark.createDataFrame([('{"type":"a","n":3,"deep":{"x":[1,2]}}',), ("[1]",)], "j string")
    payload = F.try_parse_json("j")
    got = df.select(S.payload_get(payload, "$.type"), S.payload_get(payload, "$.n", "int"),
                    S.payload_get(payload, "$.deep.x[1]", "int")).collect()
    assert [tuple(r) for r in got] == [("a", 3, 2), (None, None, None)]
