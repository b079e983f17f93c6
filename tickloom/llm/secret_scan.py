"""Secret scans with multipart credential linking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textops import keyed, text_of


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _any(*words: str) -> str:
    return "(?:" + "|".join(_either_case(w) for w in words) + ")"


# The base kinds.
ASSIGN = (
    "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]{12,}"  # 16 and more; a shorter run has no long enough match within
HEX = "[0-9a-f]{32,}"
MIN_VALUE = 8
# The parts that count only in company.
IDENT = _any("user_?name", "user", "login", "client_?id", "account_?id", "account") + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=@-]+"""
WEAK = _any("pwd", "passphrase", "pass", "credentials?", "private_?key", "access_?key", "secret_?key", "password", "passwd", "secret", "token", "api_?key") + r"""["']?\x20*[:=]\x20*["']?[^\x00-\x20"',;]{4,}"""
ENDPOINT = _any("https", "http", "ftps", "ftp", "ssh", "postgresql", "postgres", "mysql", "mongodb", "redis", "amqp") + r"""://[^\x00-\x20"'<>]+"""
#: Kinds in the order in which spans of one start are listed.
KINDS = ["assign", "access", "hex", "ident", "weak", "endpoint"]
BASE = KINDS[:3]
NAMES, SECRETS = ["access", "ident"], ["assign", "hex", "weak"]
#: A scope: parts of one block of text (between blank lines) whose starts are at most so many code points apart.
SCOPE = 300
BLANK = r"\n[\x20\x09\x0D]*\n"

# What a text must hold for a kind's pattern to match anywhere; spares most texts the search.
_NEEDS = {
    "assign": ["pass", "secret", "token", "api"],
    "access": None,
    "hex": None,
    "ident": ["user", "login", "client", "account"],
    "weak": ["pwd", "pass", "credential", "key", "secret", "token"],
    "endpoint": ["://"],
}
_FOUND = [*KINDS, "blank"]  # blank lines are no parts, but bound the blocks
_PATTERNS = dict(zip(_FOUND, [ASSIGN, ACCESS, f"(?<![0-9a-f]){HEX}", IDENT, WEAK, ENDPOINT, BLANK], strict=True))


def _may_match(kind: str) -> Column:
    if kind == "access":
        return F.contains("_text", F.lit("AKIA"))
    if kind == "hex":
        return F.lit(True)
    if kind == "blank":  # of use only where something may be linked
        return _may_match("ident") | _may_match("weak") | F.contains("_lower", F.lit("://"))
    found = reduce(lambda a, b: a | b, [F.contains("_lower", F.lit(w)) for w in _NEEDS[kind]])
    return found & (F.contains("_text", F.lit(":")) | F.contains("_text", F.lit("=")))


def _matches(kind: str) -> Column:
    """Array of the kind's matches in order: the code points before each since the one before, its own
    length, and the length of the assigned value. Matches and the pieces between them alternate."""
    matches = F.col(f"_{kind}")
    before = F.slice(F.split("_text", F.lit(_PATTERNS[kind]), -1), F.lit(1), F.size(matches))
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) if kind == "assign" else F.lit(MIN_VALUE)
    measured = F.zip_with(matches, before, lambda m, b: F.struct(F.length(b).alias("gap"), F.length(m).alias("len"), value(m).alias("value")))
    return F.when(
        F.size(matches) > 0,
        F.transform(measured, lambda m, i: F.struct(F.lit(_FOUND.index(kind)).alias("kind"), i.alias("at"), m["gap"].alias("gap"), m["len"].alias("len"), m["value"].alias("value"))),
    )


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: <id_col>, n_assign, n_access, n_hex, base_sha256, spans (text
    kind:start:end by start, comma-joined), found (the same as an array of structs), links (array of the
    credentials put together: secret, and a name or an endpoint, each with kind, start and end), link_spans (the links as sorted
    texts secret+part, comma-joined).

    Base kinds are reported wherever they match, leftmost and without overlaps in a kind. The weak kinds
    (account names, short or oddly named secrets, endpoints) are parts of credentials. A part's scope is its
    block of text (blank lines part blocks), as far as starts lie within SCOPE code points of its own. A name is reported with a
    secret in its scope, a weak secret (outside base matches) with a name or an endpoint, an endpoint with both. Whether a scope has
    them is told by windows over its range.

    An interval join then links each secret with each name and each endpoint of its scope: a link is a secret and one of them, or
    null where the scope has none of the two kinds. The join is by block and stretch of SCOPE code points, in which a secret looks
    into its own and the two beside it; a scope holds no more parts than so many code points have room for, so that the
    pairs grow with the text's length, not with its square.

    Defined cases: null and empty texts have no spans, and the digest of the empty text; rows that
    repeat an identifier give a row each; other columns are ignored.
    """
    texts = keyed(docs, id_col, text_col).select(
        "_row", "_id", text_of(f"_{text_col}").alias("_text"), F.lower(text_of(f"_{text_col}")).alias("_lower")
    )
    none = F.array().cast("array<string>")
    matched = texts.select(
        "_row", "_id", "_text",
        *[F.when(_may_match(k), F.regexp_extract_all("_text", F.lit(_PATTERNS[k]), F.lit(0))).otherwise(none).alias(f"_{k}") for k in _FOUND],
    )
    empty = F.array().cast("array<struct<kind:int,at:int,gap:int,len:int,value:int>>")
    so_far = Window.partitionBy("_row", "_id", "kind").orderBy("at")
    parts = (
        matched.select("_row", "_id", F.concat(*[F.coalesce(_matches(k), empty) for k in _FOUND]).alias("_parts"))
        .select("_row", "_id", F.explode_outer("_parts").alias("_p"))
        .select("_row", "_id", "_p.*")
        .repartition("_row")  # serves all windows and the grouping below
        .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far))
        .withColumn("start", F.col("end") - F.col("len"))
        .filter(F.col("kind").isNull() | (F.col("value") >= MIN_VALUE) | (F.col("at") == 0))
        .withColumn("kind", F.when(F.col("value") >= MIN_VALUE, F.col("kind")))  # a failing match stands for its row
        .select("_row", "_id", "kind", "start", "end")
    )
    doc = Window.partitionBy("_row", "_id").orderBy("start")
    is_base = F.col("kind") < len(BASE)
    number = KINDS.index
    # A weak match that touches a base match of the same place says nothing new.
    before = F.max(F.when(is_base, F.col("end"))).over(doc.rangeBetween(Window.unboundedPreceding, 0)) > F.col("start")
    after = F.min(F.when(is_base, F.col("start"))).over(doc.rangeBetween(0, Window.unboundedFollowing)) < F.col("end")
    fresh = parts.withColumn("_shadowed", F.coalesce(before | after, F.lit(False)) & (F.col("kind") == number("weak")))
    blocks = fresh.withColumn("_block", F.count(F.when(F.col("kind") == _FOUND.index("blank"), True)).over(doc.rangeBetween(Window.unboundedPreceding, 0)))
    block = Window.partitionBy("_row", "_id", "_block").orderBy("start")

    def near(kinds: list[str]) -> Column:
        """Whether a part of these kinds is in the scope."""
        part = F.when(F.col("kind").isin([number(k) for k in kinds]) & ~F.col("_shadowed"), True)
        return F.count(part).over(block.rangeBetween(-SCOPE, SCOPE)) > 0

    linked = blocks.withColumns({"_secret": near(SECRETS), "_name": near(NAMES), "_place": near(["endpoint"])})
    has = F.col
    is_secret = F.col("kind").isin([number(k) for k in SECRETS]) & ~F.col("_shadowed") & (has("_name") | has("_place"))
    kept = is_base | (
        F.when(F.col("kind") == number("ident"), has("_secret"))
        .when(F.col("kind") == number("weak"), ~F.col("_shadowed") & (has("_name") | has("_place")))
        .when(F.col("kind") == number("endpoint"), has("_secret") & has("_name"))
    )
    span = F.struct("start", "kind", "end")
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    text = lambda spans: F.array_join(F.transform(spans, one), ",")
    # The interval join. Only parts whose scope has something to link with take part in it.
    at = ["_row", "_block"]
    stretch = F.floor(F.col("start") / SCOPE)
    secrets = linked.filter(is_secret).select(*at, F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("_stretch"), span.alias("secret"))
    company = linked.filter(F.col("kind").isin([number(k) for k in [*NAMES, "endpoint"]]) & has("_secret"))
    company = company.select(*at, stretch.alias("_stretch"), (F.col("kind") == number("endpoint")).alias("_endpoint"), span.alias("part"))
    pairs = secrets.join(company, [*at, "_stretch"]).filter(F.abs(F.col("part.start") - F.col("secret.start")) <= SCOPE)
    links = pairs.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("secret", F.when(~F.col("_endpoint"), F.col("part")).alias("name"), F.when(F.col("_endpoint"), F.col("part")).alias("endpoint")))).alias("_links")
    )
    spans = linked.groupBy("_row", "_id").agg(
        *[F.count(F.when(F.col("kind") == number(k), True)).alias(f"n_{k}") for k in BASE],
        F.sort_array(F.collect_list(F.when(is_base, span))).alias("_base"),
        F.sort_array(F.collect_list(F.when(kept, span))).alias("_all"),
    )
    told = lambda s: F.when(s.isNotNull(), F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    no_links = F.array().cast("array<struct<secret:struct<start:bigint,kind:int,end:bigint>,name:struct<start:bigint,kind:int,end:bigint>,endpoint:struct<start:bigint,kind:int,end:bigint>>>")
    spans = spans.join(links, "_row", "left").withColumn("_links", F.coalesce(F.col("_links"), no_links))
    linked_text = F.array_sort(F.transform("_links", lambda x: F.concat(one(x["secret"]), F.lit("+"), one(F.coalesce(x["name"], x["endpoint"])))))
    return spans.select(
        F.col("_id").alias(id_col),
        *[f"n_{k}" for k in BASE],
        F.sha2(text(F.col("_base")), 256).alias("base_sha256"),
        text(F.col("_all")).alias("spans"),
        F.transform("_all", told).alias("found"),
        F.transform("_links", lambda x: F.struct(*[told(x[n]).alias(n) for n in ("secret", "name", "endpoint")])).alias("links"),
        F.array_join(linked_text, ",").alias("link_spans"),
    )


def oracle_sql() -> str:
    """The same in DuckDB SQL."""

    def spans(kind: str) -> str:
        pattern = {"hex": HEX}.get(kind, _PATTERNS[kind]).replace("'", "''")
        length = f"length(regexp_extract(m, '{pattern}', 2))" if kind == "assign" else str(MIN_VALUE)
        return f"""
  SELECT doc_id, {_FOUND.index(kind)} AS kind, before + sum(gap + len) OVER (PARTITION BY doc_id ORDER BY i) - len AS start,
         before + sum(gap + len) OVER (PARTITION BY doc_id ORDER BY i) AS stop, {length} AS value
  FROM (SELECT doc_id, i, 0 AS before, ms[i] AS m, length(ms[i]) AS len, length(ps[i]) AS gap
        FROM (SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, regexp_split_to_array(text, '{pattern}') AS ps FROM t)))"""

    order = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS))
    number = KINDS.index
    ids = lambda *kinds: ", ".join(str(number(k)) for k in kinds)
    near = lambda *kinds: f"count(*) FILTER (WHERE kind IN ({ids(*kinds)}) AND NOT shadowed) OVER s > 0"
    told = lambda x: f"(CASE {x}.kind {order} END || ':' || {x}.start || ':' || {x}.stop)"
    said = f"CASE kind {order} END || ':' || start || ':' || stop"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT doc_id, kind, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM ({' UNION ALL '.join(map(spans, _FOUND))}) WHERE value >= {MIN_VALUE}),
fresh AS (
  SELECT *, kind = {number('weak')} AND (
      coalesce(max(CASE WHEN kind < 3 THEN stop END) OVER (PARTITION BY doc_id ORDER BY start RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > start, false)
      OR coalesce(min(CASE WHEN kind < 3 THEN start END) OVER (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) < stop, false)) AS shadowed
  FROM parts),
linked AS (
  SELECT *, {near('assign', 'hex', 'weak')} AS secret, {near('access', 'ident')} AS named, {near('endpoint')} AS placed
  FROM (SELECT *, count(*) FILTER (WHERE kind = {len(KINDS)}) OVER (PARTITION BY doc_id ORDER BY start) AS block FROM fresh)
  WINDOW s AS (PARTITION BY doc_id, block ORDER BY start RANGE BETWEEN {SCOPE} PRECEDING AND {SCOPE} FOLLOWING)),
kept AS (
  SELECT * FROM linked WHERE kind < {len(KINDS)} AND CASE kind WHEN {number('ident')} THEN secret WHEN {number('weak')} THEN NOT shadowed AND (named OR placed)
    WHEN {number('endpoint')} THEN secret AND named ELSE true END),
pairs AS (
  SELECT a.doc_id, string_agg({told('a')} || '+' || {told('b')}, ',' ORDER BY encode({told('a')} || '+' || {told('b')})) AS links
  FROM linked a JOIN linked b ON a.doc_id = b.doc_id AND a.block = b.block AND abs(a.start - b.start) <= {SCOPE}
  WHERE a.kind IN ({ids(*SECRETS)}) AND NOT a.shadowed AND b.kind IN ({ids(*NAMES, 'endpoint')}) GROUP BY a.doc_id)
SELECT t.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg({said}, ',' ORDER BY start, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg({said}, ',' ORDER BY start, kind), '') AS spans, coalesce(any_value(pairs.links), '') AS link_spans
FROM t LEFT JOIN kept ON kept.doc_id = t.doc_id LEFT JOIN pairs ON pairs.doc_id = t.doc_id GROUP BY t.doc_id"""
