"""Hand-made cases of results that must be exact, whatever the SQL of the registered queries says."""

import pytest
from pyspark.sql import functions as F

from tickloom.functions.scalar import contract_quantity, distance_bps, imbalance, is_json, microprice, redacted
from tickloom.operators.telemetry import resource_summary
from tickloom.operators.universe import stretched


def test_stretch_is_exact(spark):
    rows = [("a", 1, 1, 3600 * 10**9, False, "0.0001"), ("b", 1, 1, 10**9, True, "3"), ("b", 2, 1, 10**9, False, "3"), ("b", 1, 1, 3 * 10**9, False, "3"), ("c", 5, 1, 10**9, True, "5"), ("c", 1, 1, 10**9, False, "5"), (None, 1, 1, 10**9, False, "9")]
    frame = spark.createDataFrame(rows, "g string, jobs int, cost int, requested_ns long, fixed boolean, rate string").withColumn("rate", F.col("rate").cast("decimal(20,6)"))
    got = {(r.g, r.requested_ns, r.fixed): r.effective_ns for r in stretched(frame, ["g"], "rate").collect()}
    assert got == {
        ("a", 3600 * 10**9, False): 10_000_000_000_000, ("b", 10**9, True): 10**9, ("b", 10**9, False): 1_166_666_667, ("b", 3 * 10**9, False): 3_500_000_000,
        ("c", 10**9, True): 10**9, ("c", 10**9, False): None, (None, 10**9, False): 10**9,
    }


def test_slope_of_large_values(spark):
    rows = [("k", h, h * 60, 10**15 + 7 * h) for h in range(50)]
    got = resource_summary(spark.createDataFrame(rows, "k string, hour int, t int, v long"), ["k"], "hour", "t", "v", 0).first()
    assert got.slope_per_minute == 7.0


@pytest.mark.parametrize(
    ("text", "good"),
    [('{"a":"x NaN y"}', True), ('{"a":"q \\" Infinity"}', True), ('{"a":NaN}', False), ('{"a":-Infinity}', False), ("[1,", False), ('"NaN"', True), ("1.5", True), ("NaN", False), (None, None)],
)
def test_json(spark, text, good):
    got = spark.createDataFrame([(text,)], "t string").select(is_json("t").alias("x")).first().x
    assert bool(got) is bool(good)


def test_divisions_by_zero(spark):
    one = spark.createDataFrame([(0.0, 0.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    got = one.select(microprice(a, a, b, b).alias("m"), imbalance(a, b).alias("i"), distance_bps(a, b).alias("d"), contract_quantity(F.lit(1.0), F.lit(1.0), F.lit("usd"), F.lit("btc"), a).alias("c")).first()
    assert list(got) == [None] * 4


@pytest.mark.parametrize(
    ("text", "secrets", "stays"),
    [
        ("Authorization:\n Bearer canary", ["canary"], []), ("headers={'api-key': 'canary'}", ["canary"], []), ("headers=[(b'Set-Cookie', b'session=canary; Path=/')]", ["canary", "Path"], []),
        ("connect auth=('someone','canary') timeout=10", ["someone", "canary"], ["timeout=10"]), ("auth=(b'us)er', b'ca)nary') timeout=10", ["us)er", "ca)nary"], ["timeout=10"]), ("auth=(b'user', b'pa\rss')", [], ["user"]),
        ('PASSWORD="a\\"b canary" x', ["canary"], [" x"]), ("> GET /ws?to%6ben=canary&limit=10 HTTP/1.1", ["canary"], ["limit=10", "to%6ben="]), ("?api%5Fkey=canary", ["canary"], []), ("X-Amz-Signature=1 ?X-Amz-Signature=canary", ["canary"], []),
        ("https://user:canary@example.test:8443/path?token=canary&limit=100", ["user", "canary"], ["example.test:8443/path", "limit=100"]), ("socks5h://user:canary@127.0.0.1:1080", ["canary", "127.0.0.1"], []),
        ('Authorization: Digest username="someone", response="canary"', ["someone", "canary"], []), ("PROXY_PASSWORD='alpha&beta'", ["alpha", "beta"], []), ("AWS_SECRET_ACCESS_KEY=canary next", ["canary"], ["next"]),
        ("the token and the password are safe", [], ["the token and the password are safe"]),
    ],
)
def test_redaction(spark, text, secrets, stays):
    got = spark.createDataFrame([(text,)], "t string").select(redacted("t").alias("x")).first().x
    assert not [s for s in secrets if s in got], got
    assert not [s for s in stays if s not in got], got
