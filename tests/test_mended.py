"""Hand-made and brute-force cases of operators whose SQL shares their fixtures."""

import random
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from fractions import Fraction
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tickloom.functions.scalar import half_even, http_date, quotient_text
from tickloom.operators import books, ordered, telemetry, universe, windows
from tickloom.operators.reconcile import trace_places


def rounded(a, b, digits):
    """Half to even, from exact fractions."""
    n = round(Fraction(abs(a), abs(b)) * 10**digits)
    text = str(n).rjust(digits + 1, "0")
    text = text[: len(text) - digits] + ("." + text[len(text) - digits :] if digits else "")
    return ("-" if n and (a < 0) != (b < 0) else "") + text


@pytest.mark.parametrize("digits", [0, 2, 12, 18])
def test_wide_quotients(spark, digits):
    rng = random.Random(digits)
    pairs = [(10**30, 3), (10**15, 7), (1, 8), (3, 8), (5, 2), (7, 2), (-5, 2), (1, -3), (0, 5), (10**31 - 1, 10**17), (999, 1000), (9995, 1000), (125, 1000), (10**37, 10**17 + 3), (-1, 10**17)]
    pairs += [(rng.randrange(-(10**30), 10**30), rng.randrange(1, 10 ** rng.randrange(1, 17))) for _ in range(60)]
    frame = spark.createDataFrame([(str(a), str(b)) for a, b in [*pairs, (1, 0)]], "a string, b string").select(*[F.col(c).cast("decimal(38,0)").alias(c) for c in "ab"])
    got = [r.q for r in frame.select(quotient_text("a", "b", digits).alias("q")).collect()]
    assert got == [*[rounded(a, b, digits) for a, b in pairs], None]


def test_half_even_of_large_numbers(spark):
    got = spark.range(1).select(half_even(F.lit(10**15), F.lit(3), 2).alias("x"), half_even(F.lit(10**14 + 1).cast("decimal(20,0)"), F.lit(8), 2).alias("y"), half_even(F.lit(2.5).cast("decimal(9,1)"), F.lit(1), 0).alias("z")).first()
    assert [str(v) for v in got] == ["333333333333333.33", "12500000000000.12", "2"]


@pytest.mark.parametrize(
    "text",
    ["Sun, 06 Nov 1994 08:49:37 GMT", "Sun, 6 Nov 2094 08:49:37 GMT", "6 Nov 1994 08:49:37 GMT", "Sun, 06 Nov 1994 08:49:37 +0130", "Sun, 06 Nov 1994 08:49:37 -0800", "Sun, 06 Nov 1994 08:49 GMT",
     "Sunday, 06-Nov-94 08:49:37 GMT", "Sunday, 06-Nov-31 08:49:37 GMT", "Sun Nov  6 08:49:37 1994", "Sun, 06 nov 1994 08:49:37 UTC", "Sun, 06 Nov 68 08:49:37 GMT", "Sun, 06 Nov 69 8:49:37 GMT"],
)
def test_http_dates(spark, text):
    want = parsedate_to_datetime(text)
    want = want.replace(tzinfo=UTC) if want.tzinfo is None else want.astimezone(UTC)
    (got,) = spark.createDataFrame([(text,)], "t string").select(F.unix_seconds(http_date(F.col("t"))).alias("s")).first()
    assert datetime.fromtimestamp(got, UTC) == want


@pytest.mark.parametrize("text", ["soon", "", "Sun, 41 Nov 1994 08:49:37 GMT", "Sun, 06 Xxx 1994 08:49:37 GMT", "06 Nov 1994", "120", "Sun, 06 Nov 1994 08:49:37 XYZ"])
def test_what_is_no_http_date(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(http_date(F.col("t")).alias("s")).first().s is None


def test_heartbeats_are_no_updates(spark):
    rows = [("a", 5, 4, "update", 1), ("a", 5, 5, "update", 2), ("a", 6, None, "update", 3), ("a", 7, 6, "snapshot", 4)]
    frame = spark.createDataFrame(rows, "k string, seq long, prev_seq long, kind string, t long")
    assert [tuple(r) for r in books.update_counts(frame, ["k"], "t", 10).collect()] == [("a", 10, 2)]


def test_features_of_invalid_books_are_null(spark):
    features = spark.createDataFrame([("a", 10, 1.0, 3), ("a", 20, 2.0, 4), ("a", 40, 3.0, 5), ("b", 10, 4.0, 6)], "k string, window_end_ns long, mid double, updates long")
    messages = spark.createDataFrame([("a", 1, 5, True), ("a", 2, 9, False), ("a", 3, 11, True), ("a", 4, 40, True), ("a", 5, 40, False)], "k string, seq long, t long, valid boolean")
    got = books.only_valid(features, books.valid_at_ends(messages, ["k"], "seq", "t", 10), ["k"], ["updates"]).collect()
    assert sorted((r.k, r.window_end_ns, r.mid, r.updates, r.valid) for r in got) == [("a", 10, None, 3, False), ("a", 20, 2.0, 4, True), ("a", 40, None, 5, False), ("b", 10, None, 6, False)]


@pytest.mark.parametrize("rule", list(books.CONTINUITY))
def test_stretches_do_not_matter(spark, rule):
    rng, rows, seq = random.Random(3), [], 0
    for i in range(400):
        before, seq = seq, seq + rng.choice([1, 1, 1, 4])
        kind = "snapshot" if i in (90, 95, 300) else "update"
        rows.append(("k" if i % 5 else "l", seq, rng.choice([before] * 30 + [before - 1, 0, None]), rng.choice([before + 1] * 30 + [before + 2, before - 3, None]), kind))
    frame = spark.createDataFrame(rows, "k string, seq long, prev_seq long, first_seq long, kind string")
    one, many = (sorted((r.seq, r.segment, r["break"], r.valid) for r in books.validated(frame, ["k"], ["seq"], rule, width).collect()) for width in (1 << 40, 7))
    assert one == many and len(one) == 400


def test_places_and_digest_of_a_trace(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(9), rng.randrange(300), i) for i in range(500)]
    frame = spark.createDataFrame(rows, "due int, event long, part long").repartition(7)
    placed = trace_places(frame, "due", "event", "part", width=16)
    assert {(r.due, r.event, r.part): r.place for r in placed.collect()} == {row: i for i, row in enumerate(sorted(rows), 1)}
    hexed = placed.withColumn("d", F.sha2(F.col("part").cast("string"), 256))
    (got,) = ordered.order_digest(hexed, [], "place", "d", block=6, levels=2).collect()
    level = [sha256(str(p).encode()).hexdigest() for _, _, p in sorted(rows)]
    hashed = lambda parts: sha256("".join(parts).encode()).hexdigest()
    for _ in range(2):
        level = [hashed(level[i : i + 6]) for i in range(0, len(level), 6)]
    assert (got.digest, got.rows) == (hashed(level), 500)
    swapped = hexed.withColumn("place", F.when(F.col("place") < 3, 3 - F.col("place")).otherwise(F.col("place")))
    assert ordered.order_digest(swapped, [], "place", "d", block=6, levels=2).first().digest != got.digest


def test_oldest_open_by_sweep(spark):
    rng = random.Random(6)
    records = [(rng.choice("ab"), a := rng.randrange(200), a + rng.choice([0, 1, 3, 9, 60])) for _ in range(150)] + [("a", 150, None), ("c", 5, 7), ("c", 20, 30)]
    samples = [(k, t) for k in "abcd" for t in range(0, 320, 3)]
    got = telemetry.oldest_open_age(spark.createDataFrame(records, "k string, a long, d long"), spark.createDataFrame(samples, "k string, at long"), ["k"], "a", "d", "at", 20, 11).collect()
    want = set()
    for k, t in samples:
        first = min((a for q, a, d in records if q == k and a <= t and (d is None or t < d)), default=None)
        want.add((k, t, None if first is None else t - first, first is not None and t - first > 20))
    assert len(got) == len(samples) and {tuple(r) for r in got} == want


def test_turnover_of_another_revision_ranks_nobody(spark):
    catalog = spark.createDataFrame([("x", 2), ("y", 2), ("z", 3)], "instrument_key string, catalog_revision int")
    revisions = spark.createDataFrame([(1, 0, 10), (2, 10, 20), (3, 20, 30)], "catalog_revision int, valid_from_ns long, valid_to_ns long")
    seen = [("x", 2, 5, 12), ("x", 2, 7, 15), ("x", 2, 99, 20), ("x", 1, 50, 5), ("y", 1, 8, 9), ("z", 2, 3, 12), ("z", 3, 4, 20)]
    observed = spark.createDataFrame([(k, r, v, "Q", t) for k, r, v, t in seen], "instrument_key string, catalog_revision int, turnover long, turnover_currency string, turnover_observed_at_ns long")
    got = {r.instrument_key: (r.turnover, r.turnover_observed_at_ns) for r in universe.bound_turnover(catalog, observed, revisions, ["instrument_key"]).collect()}
    assert got == {"x": (7, 15), "y": (None, None), "z": (4, 20)}


def test_egress_changes(spark):
    e = [("k", t, "e", None, "exchange", 0, g) for t, g in ((1, "p"), (2, "q"), (3, "q"), (4, "p"), (11, "q"))] + [("k", 3, "e", "reconnect", "exchange", 0, "z")]
    events = spark.createDataFrame(e, "k string, t long, x string, control_kind string, time_source string, latency_ns long, egress_id string")
    grid = spark.createDataFrame([("k", 0, 30)], "k string, start_ns long, end_ns long")
    got = {r.window_start_ns: (r.input_count, r.egress_count, r.egress_changes) for r in windows.quality_windows(grid, events, ["k"], "t", 10).collect()}
    assert got == {0: (4, 2, 2), 10: (1, 1, 0), 20: (0, 0, 0)}


def test_rendezvous_by_blocks_of_buckets(spark):
    keys = spark.createDataFrame([(f"key{i % 40}",) for i in range(50)] + [(None,)], "k string")
    buckets = spark.createDataFrame([(f"b{i}",) for i in range(23)] + [("b3",), (None,)], "b string")
    got = [(r.k, r.b) for r in universe.rendezvous(keys, "k", buckets, "b", block=4).collect()]
    best = lambda k: max((sha256(f"{k}\0b{i}".encode()).hexdigest(), f"b{i}") for i in range(23))[1]
    assert len(got) == 51 and all(b == best(k) for k, b in got if k is not None)
    assert sorted(map(str, got)) == sorted(str((r.k, r.b)) for r in universe.rendezvous(keys, "k", buckets, "b").collect()) or any(k is None for k, _ in got)
    with pytest.raises(ValueError, match="bucket"):
        universe.rendezvous(keys, "k", buckets.limit(0), "b")
