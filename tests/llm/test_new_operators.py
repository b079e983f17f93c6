"""Fingerprints, collocations and periodic runs against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tickloom.llm import collocations, fingerprints, periodic, queries

EXTRA = ["'x' _id", "1 n", "'y' words", "2 fingerprint", "'z' part", "3 guest", "'q' runs", "0 _hash", "4 phrase"]


def prose(seed, n, words=None):
    rng = random.Random(seed)
    words = words or [a + b for a in ("tion", "the", "on", "é", "re", "sch", "ou", "an") for b in ("er", "e", "ing", "ä", "st", "x", "nd")]
    return " ".join(rng.choice(words) for _ in range(n))


# ---- periodic runs ----


def brute_runs(w, least=6, exponent=4):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, exponent * q):
                stretch = (start, i + q - start)
                found[stretch] = min(q, found.get(stretch, q))
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("least,exponent", [(6, 4), (3, 3), (10, 5)])
def test_runs_of_random_words(least, exponent):
    rng = random.Random(least)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(0, 4)):
            kinds, w = rng.randint(1, 4), []
            while len(w) < rng.randint(0, 60):
                unit = [bytes([97 + rng.randrange(kinds)]) for _ in range(rng.randint(1, 5))]
                w += unit * (rng.randint(1, 9) if rng.random() < 0.4 else 1)
            texts.append(w)
        assert periodic._block_runs(texts, least, exponent) == [brute_runs(w, least, exponent) for w in texts]


def test_one_word_text_is_not_quadratic():
    assert periodic._block_runs([[b"a"] * 200_000, [b"a", b"b"] * 70_000], 6, 4) == [[(0, 200_000, 1)], [(0, 140_000, 2)]]


def test_periodic_query(spark, tmp_path):
    rows = [(i, prose(i, 3 + i % 90)) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "a " * 3000), (204, "a  b\tc\x0b" * 9 + "x"), (204, "a  b\tc\x0b" * 9 + "x"), (204, "other"), (None, "z " * 9)]
    rows += [(205, "ä ä " * 6), (206, "A a " * 5)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *EXTRA).write.parquet(f"{tmp_path}/documents.parquet")
    got = collections.Counter(tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect())
    want = collections.Counter()
    planted = 0
    for i, text in rows:
        w = (text or "").encode().split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            planted += 1
        runs = brute_runs(w)
        drop = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), b" ".join(x for k, x in enumerate(w) if k not in drop))]
        want[(i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digests)] += 1
    assert planted >= 5 and got == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.periodic_runs(empty).columns == ["doc_id", "n_words", "runs", "collapsed"] and periodic.periodic_runs(empty).isEmpty()


# ---- fingerprints ----


def brute_bin(window):
    width = len(window)
    sums = [round(c * math.log2(c) * 65536) if c else 0 for c in range(width + 1)]
    return sum(sums[c] for c in collections.Counter(window).values()) * 1000 // sums[width]


def brute_levels(text):
    return [lv for lv in fingerprints.LEVELS if text and lv.from_chars <= len(text) < lv.to_chars]


def windows(raw, width):
    return [raw[i : i + width] for i in range(len(raw) - width + 1)]


def brute_ranks(texts):
    out = {}
    for lv in fingerprints.LEVELS:
        counts = collections.Counter(brute_bin(w) for t in texts if lv in brute_levels(t) for w in windows(t.encode(), lv.width))
        order = sorted(range(1001), key=lambda b: (b > 1000 * (1 - fingerprints.WEAK), counts[b], b))
        out[lv.width] = {b: r for r, b in enumerate(order)}
    return out


def brute_selected(raw, lv, ranks):
    begin = lambda w: (int.from_bytes(w[:4], "big") * 0x9E3779B1 & 0xFFFFFFFF) >> 20
    keys = [(ranks[lv.width][brute_bin(w)], begin(w), i % lv.width, i) for i, w in enumerate(windows(raw, lv.width))]
    votes = collections.Counter(min(keys[i : i + lv.width])[3] for i in range(len(keys) - lv.width + 1))
    chosen = sorted(i for i, v in votes.items() if v >= lv.votes)
    if keys and not chosen:
        chosen = [k[3] for k in keys if k[0] == min(keys)[0]]
    return list(dict.fromkeys(raw[i : i + lv.width] for i in chosen))


FINGERED = ["", "a", "abc", "abcd", "häß", "a" * 3000, "ab" * 200, prose(1, 10), prose(2, 30), prose(3, 90), prose(4, 400), prose(5, 3000), "0123456789abcdef" * 40 + prose(6, 50)]


def test_selected_windows():
    ranks = brute_ranks(FINGERED)
    table = {}
    for lv in fingerprints.LEVELS:
        mine = [t.encode() for t in FINGERED if lv in brute_levels(t)]
        table[lv.width] = fingerprints.rarity(fingerprints.entropy_counts(mine, lv.width))
        assert table[lv.width].tolist() == [ranks[lv.width][b] for b in range(1001)]
        for raw, found in zip(mine, fingerprints.features(mine, lv, table[lv.width]), strict=True):
            alone = [fingerprints.features([w], fingerprints.Level(lv.width, 1, 0, 1 << 62), table[lv.width])[0][0] for w in brute_selected(raw, lv, ranks)]
            if len(raw) >= lv.width:
                assert found.tolist() == [int(x) for x in alone]
    for text, digest in zip(FINGERED, fingerprints.digests(FINGERED, table), strict=True):
        again = fingerprints.read(fingerprints.written(digest))
        assert [(d.width, d.count, d.bits.tolist()) for d in again] == [(d.width, d.count, d.bits.tolist()) for d in digest]
        assert fingerprints.likeness(digest, again) == pytest.approx(1)
        assert bool(digest) == bool(text)


def test_likeness_by_hand():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 240).astype(np.uint64)
    one, two = fingerprints.bloom_chain(32, h[:160]), fingerprints.bloom_chain(32, np.concatenate([h[:80], h[160:240]]))
    bits = lambda x: {int(v) >> 10 * k & 1023 for v in x for k in range(5)}

    def share(a, b):
        chance = len(a) * len(b) / 1024
        return max(0.0, (len(a & b) - chance) / (max(len(a), len(b)) - chance))

    a, b = [bits(h[:80]), bits(h[80:160])], [bits(h[:80]), bits(h[160:240])]
    want = (sum(max(share(x, y) for y in b) for x in a) + sum(max(share(x, y) for x in a) for y in b)) / 4
    assert fingerprints.likeness([one], [two]) == pytest.approx(want, abs=1e-6)
    assert fingerprints.likeness([one], []) == 0 and fingerprints.likeness([], []) == 1


def test_fingerprint_query(spark, tmp_path):
    texts = FINGERED + [prose(i, 40 + 7 * i) for i in range(60)] + [None, FINGERED[10]]
    rows = list(enumerate(texts)) + [(5, "second with this number"), (5, "second with this number"), (None, "no number")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *EXTRA)
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    texts_of = dict(enumerate(texts))
    for i in range(6, len(texts) - 1):  # where neither neighbour repeats its number
        text, below = texts_of[i] or "", texts_of[i - 1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + below[:third]
        (r,) = by_id[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        mine, other = fingerprints.read(r.fingerprint), fingerprints.read(r.edited_fingerprint)
        assert r.near_edited == pytest.approx(fingerprints.likeness(mine, other), abs=1e-6)
        if i - 1 != 5:
            assert r.near_next == pytest.approx(fingerprints.likeness(mine, fingerprints.read(by_id[i - 1][0].fingerprint)), abs=1e-6)
        if len(text) > 300 and i > 12:  # text 12 keeps little but its repeated part
            assert r.near_edited > 0.25 and r.near_edited > r.near_next
    last = by_id[None][0]  # its next is the first again
    first = texts_of[len(texts) - 1]
    assert last.edited_sha256 == hashlib.sha256(("no number"[:6] + first[:3]).encode()).hexdigest()
    assert by_id[10][0].fingerprint == by_id[len(texts) - 1][0].fingerprint
    assert sorted(r.n_chars for r in by_id[5]) == [23, 23, 3000]
    for n in (0, 1):
        few = fingerprints.neighbour_likeness(frame.filter("doc_id = 9").limit(n)).collect()
        assert len(few) == n and all(r.near_next == 1 for r in few)
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(frame.filter("doc_id > 5")).collect()}
    assert set(plain) == set(range(6, len(texts)))


# ---- collocations ----


def brute_phrases(rows, max_words=3, least=10, share=50, best=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = tuple(x for x in re.split("[ \t]+", piece) if x)
            n[lang or "und"] += len(w)
            for k in range(1, max_words + 1):
                f[lang or "und"].update(w[i : i + k] for i in range(len(w) - k + 1))
    out = set()
    for lang, found in f.items():
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            inside = (q[i : i + len(p)] == p and 100 * b >= share * a for q, b in candidates.items() if len(q) > len(p) for i in range(len(q) - len(p) + 1))
            if not any(inside):
                score, k = min((10**6 * a * a // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:best], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def phrase_rows():
    rng = random.Random(9)
    common = ["a", "b", "of", "the", "Große", "internationalisation", "internationalisatioN", "x\x00y", " ", "extraordinarily-long-words"]
    rows = []
    for i in range(250):
        piece = lambda: " ".join(rng.choice(common) if rng.random() < 0.8 else f"rare{rng.randrange(4000)}" for _ in range(rng.randint(0, 9)))
        rows.append((rng.choice([".", ", ", "\n", "!? "]).join(piece() for _ in range(5)), rng.choice(["en", "de", None])))
    line = "one line that many of the documents share and which is quite long, with an end"
    rows += [(f"{prose(i, 3)}\n{line}\n{'so ' * (i % 7)}", "en") for i in range(40)]
    return rows + [(None, "en"), ("", None), (" . , ", "de"), ("single", "fr"), ("k l " * 3000, "xx")] + [("same text here", "yy")] * 30


@pytest.mark.parametrize("max_words,hot", [(3, False), (3, True), (5, False)])
def test_collocations(spark, monkeypatch, max_words, hot):
    monkeypatch.setattr(collocations, "GATHERED_WORDS", 700)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 900)
    if hot:  # every node that is there more than once counts as hot
        monkeypatch.setattr(collocations, "_hot_nodes", lambda texts, node, n, seed: [tuple(r) for r in collocations._edges(texts, n, seed).groupBy(*node).count().filter("count > 1").drop("count").collect()])
    rows = phrase_rows()
    frame = spark.createDataFrame(rows, "text string, lang string").selectExpr("*", "1 w1", "'p' words", "2 f", "'x' part", "3 n", "'d' doc_id")
    best = 40 if max_words == 3 else 2000
    got = collocations.collocations(frame, max_words=max_words, best=best)
    assert {tuple(r) for r in got.collect()} == brute_phrases(rows, max_words, best=best)
    assert dict(got.dtypes) == {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"}


def test_paths_are_whole(spark):
    line = " ".join(f"w{i}" for i in range(40))
    texts = spark.createDataFrame([(f"{line}. {i}", "en") for i in range(12)], "text string, lang string")
    counts = collocations._gram_counts(texts, 3, 10, 0)
    paths = collocations._paths(counts.filter("size(words) = 3"), counts.filter("size(words) = 2"), 3).collect()
    assert [(len(p.words), p.f) for p in paths] == [(40, 12)]


def test_collocations_of_nothing_and_shared_numbers(spark, monkeypatch):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).isEmpty()
    rows = [("alphabetical beginnings", "en"), ("continually differently", "en")] * 12
    frame = spark.createDataFrame(rows, "text string, lang string")
    texts = frame.select("text", "lang")
    plain, seeds = collocations._gram_counts, []
    monkeypatch.setattr(collocations, "_gram_counts", lambda *a: seeds.append(a[3]) or plain(*a))
    words = collocations._long_words
    clash = lambda t, seed: words(t, seed).unionByName(words(t, seed).withColumn("word", collocations.F.lit("another"))) if seed == 0 else words(t, seed)
    monkeypatch.setattr(collocations, "_long_words", clash)
    got = {tuple(r) for r in collocations.collocations(texts).collect()}
    assert seeds == [0, 1] and got == brute_phrases(rows)
    one = np.frombuffer(b"internationalisation extraordinarily\n", np.uint8)
    assert (collocations.word_numbers(one, 0)[3] < 0).all() and (collocations.word_numbers(one, 0)[3] != collocations.word_numbers(one, 1)[3]).all()


def test_wide_grams_are_added_up_in_halves():
    rng = np.random.default_rng(2)
    number, lang = rng.integers(1, 1 << 60, 3000), rng.integers(0, 5000, 3000).astype(np.int32)
    number[1000:1500] = number[:500]
    lang[1000:1500] = lang[:500]
    left = rng.integers(1, 7, 3000).astype(np.int8)
    left[-6:] = np.arange(6, 0, -1)
    columns, times = collocations.added_up(lang, number, left, 6)
    got = collections.Counter()
    for row, n in zip(zip(*columns, strict=True), times, strict=True):
        got[tuple(map(int, row))] += int(n)
    want = collections.Counter((int(lang[i]), *[int(number[i + k]) if left[i] > k else 0 for k in range(6)]) for i in range(3000))
    assert got == want
