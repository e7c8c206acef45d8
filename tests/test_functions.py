import pytest
from pyspark.sql import functions as F

from tidewatch.functions import durations as D
from tidewatch.functions import labels as L
from tidewatch.functions.hashing import cohort, fnv1a32
from tidewatch.operators import selectors as S
from tidewatch.schema import known, require_columns, require_rows


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_durations():
    assert D.micros("15s") == 15_000_000 and D.micros("1h30m") == 5_400_000_000 and D.seconds("30d") == 2_592_000
    with pytest.raises(ValueError):
        D.seconds("5 parsecs")


def test_duration_column(spark):
    assert one(spark, a=D.duration_seconds(F.lit("24h")), b=D.duration_seconds(F.lit("soon"))) == (86400.0, None)


def test_fnv_known_value_and_bytes(spark):
    row = one(spark, a=fnv1a32(F.lit("foobar")), b=fnv1a32(F.lit("")), c=fnv1a32(F.lit("é")), d=cohort(F.lit("foobar")))
    h = 2166136261
    for byte in "é".encode():
        h = ((h ^ byte) * 16777619) % 2**32
    assert tuple(row) == (3214735720, 2166136261, h, 20)


def test_matchers_are_anchored_and_missing_is_empty(spark):
    row = one(
        spark, a=L.matches(F.lit("svc-1"), "=~", "svc"), b=L.matches(F.lit("svc-1"), "=~", "svc.*"),
        c=L.matches(F.lit(None).cast("string"), "=", ""), d=L.matches(F.lit(None).cast("string"), "!=", "x"),
    )
    assert tuple(row) == (False, True, True, True)


def test_labelmap_last_wins_without_error(spark):
    labels = F.create_map(F.lit("m_a"), F.lit("1"), F.lit("m2_a"), F.lit("2"), F.lit("a"), F.lit("0"), F.lit("keep"), F.lit("k"))
    assert one(spark, m=L.labelmap(labels, "m2?_(.+)"))["m"] == {"a": "2", "keep": "k"}


def test_attributes(spark):
    base = F.create_map(F.lit("env"), F.lit("dev"))
    row = one(
        spark, a=L.attribute_insert(base, "env", F.lit("prod")), b=L.attribute_upsert(base, "env", F.lit("prod")),
        c=L.attribute_upsert(base, "env", F.lit(None).cast("string")), d=L.attribute_insert(base, "x", F.lit("1")),
    )
    assert tuple(row) == ({"env": "dev"}, {"env": "prod"}, {"env": "dev"}, {"env": "dev", "x": "1"})


def test_render_keeps_unknown_and_does_not_rescan(spark):
    text, context = "{x} of {y}: { {z}", {"x": F.lit("{y}"), "y": F.lit(3)}
    row = one(spark, a=L.render(F.lit(text), context), b=L.render(text, context))
    assert tuple(row) == ("{y} of 3: { {z}",) * 2


def test_band_edges(spark):
    steps = L.BANDS["error_rate"]
    row = one(spark, a=L.band(F.lit(0.01), steps), b=L.band(F.lit(0.0099), steps), c=L.band(F.lit(0.05), steps), d=L.band(F.lit(None).cast("double"), steps))
    assert tuple(row) == ("yellow", "green", "red", None)


def test_traceparent(spark):
    good = "00-0af7651916cd43dd8448eb211c80319c-b7ad6b7169203331-01"
    row = one(spark, a=L.traceparent(F.lit(good)), b=L.traceparent(F.lit("00-zz-1-01")))
    assert row["a"]["span_id"] == "b7ad6b7169203331" and row["b"] is None


def test_mask_secrets(spark):
    row = one(spark, a=L.mask_secrets(F.lit('login user=bob password=hunter2 "token": "abc" done')))
    assert row["a"] == 'login user=bob password=*** "token": "***" done'


@pytest.mark.parametrize(("text", "want"), [
    ("password='two words' x", "password='***' x"), ("Authorization: ApiKey abc123", "Authorization: ***"), ("client_secret=a", "client_secret=***"),
    ("access_token: b c", "access_token: *** c"), ("db_password=x;pwd=y", "db_password=***;pwd=***"), ('{"x-api-key": "k \\" k"}', '{"x-api-key": "***"}'),
    ('password="no end', 'password="*** end'), ("compass=1 tokens=2 secretary=3", "compass=1 tokens=2 secretary=3"), ("token=***", "token=***"), ("", ""),
])
def test_secrets_in_all_their_forms(spark, text, want):
    assert one(spark, a=L.mask_secrets(F.lit(text)))["a"] == want


def test_relabel_replace_no_match_is_unchanged(spark):
    df = spark.createDataFrame([("10.0.0.1:80", "9404", "old"), ("nohost", "x", "old")], "address string, port string, target string")
    out = S.relabel_replace(df, ["address", "port"], "target", r"([^:]+)(?::\d+)?;(\d+)", "$1:$2").collect()
    assert [r["target"] for r in out] == ["10.0.0.1:9404", "old"]


def test_shards(spark):
    row = one(spark, a=S.shard_of(F.lit("x.api2.example.com")), b=S.shard_of(F.lit("api1.example.com")), c=S.shard_of(F.lit("xapi1.example.com")))
    assert tuple(row) == ("nginx-shard2", "nginx-shard1", "nginx-default")


def test_weights_must_sum(spark):
    with pytest.raises(ValueError):
        S.weighted_split(F.lit("k"), {"a": 50, "b": 40})


def test_one_hot_drops_first_and_levels_refuse_to_cut(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    out = S.one_hot(df, "k", S.levels_of(df, "k"))
    assert out.columns == ["k_b", "k_c"] and sorted(map(tuple, out.collect())) == [(0, 0), (0, 0), (0, 1), (1, 0)]
    with pytest.raises(ValueError):
        S.levels_of(df, "k", limit=2)


def test_missing_columns_are_all_named(spark):
    with pytest.raises(ValueError, match="value.*other"):
        require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "value", "other"])
    with pytest.raises(ValueError):
        require_rows(spark.createDataFrame([], "a int"))
    assert one(spark, a=known(F.lit(float("nan"))))["a"] is None
