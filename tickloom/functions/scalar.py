"""Column functions: keys, hours, digests, redaction, request outcomes, book arithmetic."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


# Keys and times


def encode_key(key: Column | str) -> Column:
    """UTF-8 percent encoding that leaves only letters, digits, '-', '.' and '~' as they are; reversible."""
    text = F.url_encode(_c(key))
    for a, b in (("+", "%20"), ("*", "%2A"), ("_", "%5F"), ("%7E", "~")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def decode_key(text: Column | str) -> Column:
    return F.url_decode(F.replace(_c(text), F.lit("+"), F.lit("%2B")))


def floor_to(ns: Column | str, interval_ns: Column | int) -> Column:
    """Start of the half-open, epoch-aligned window that holds a time."""
    interval = F.lit(interval_ns) if isinstance(interval_ns, int) else interval_ns
    return _c(ns) - F.pmod(_c(ns), interval)


def storage_hour(ns: Column | str) -> Column:
    """UTC hour of a time as yyyy/MM/dd/HH (session time zone UTC)."""
    return F.date_format(F.timestamp_seconds(_whole(_c(ns), SECOND)), "yyyy/MM/dd/HH")


def _whole(a: Column, b: int) -> Column:
    return ((a - F.pmod(a, F.lit(b))) / b).cast("long")


def choose_time(
    event_ns: Column | str, received_ns: Column | str, past_ns: int = 7 * DAY, future_ns: int = 300 * SECOND
) -> tuple[Column, Column]:
    """Effective time and its source: the exchange's time if it is present and within the skew bounds
    (inclusive) of the receive time, else the receive time."""
    event, received = _c(event_ns), _c(received_ns)
    fits = (event >= received - past_ns) & (event <= received + future_ns)
    source = (
        F.when(event.isNull(), "receive_missing").when(fits, "exchange").otherwise("receive_outlier")
    )
    return F.when(fits, event).otherwise(received), source


def cadence_phase(key: Column | str, interval_ns: int) -> Column:
    """Start offset of a periodic job in its interval: the first 128 bits of the key's digest, as a fraction of the interval.

    The fraction is multiplied 32 bits at a time from the lowest, carrying what exceeds them, so that all is exact.
    """
    digest, carry = F.sha2(_c(key), 256), F.lit(0).cast("decimal(38,0)")
    for at in (25, 17, 9, 1):
        part = F.conv(F.substring(digest, at, 8), 16, 10).cast("decimal(10,0)")
        whole = (part * F.lit(interval_ns).cast("decimal(19,0)") + carry).cast("decimal(38,0)")
        carry = ((whole - F.pmod(whole, F.lit(1 << 32).cast("decimal(38,0)"))) / F.lit(1 << 32).cast("decimal(10,0)")).cast("decimal(38,0)")
    return carry.cast("long")


# Digests


def row_digest(*columns: Column | str) -> Column:
    """SHA-256 of a row: each value tagged as null or text with its length, so that no two rows run together."""
    parts = [F.coalesce(F.concat(F.length(_c(c).cast("string")).cast("string"), F.lit(":"), _c(c).cast("string")), F.lit("~")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def checksum_text(number: Column | str) -> Column:
    """A level's price or quantity in a book checksum: no decimal point, no leading zeros."""
    return F.regexp_replace(F.replace(_c(number), F.lit("."), F.lit("")), "^0+", "")


def is_json(text: Column | str) -> Column:
    """Whether a text is a JSON value with finite numbers only. What strings say does not count."""
    values = F.regexp_replace(_c(text), F.lit(r'"(?:[^"\\]|\\.)*"'), F.lit('""'))
    return F.try_parse_json(_c(text)).isNotNull() & ~F.rlike(values, F.lit(r"NaN|Infinity|INF"))


# Redaction. Names whose values are hidden.

QUERY_NAMES = [
    "access_key", "access_key_id", "access_token", "api_key", "apikey", "authorization", "client_secret",
    "ossaccesskeyid", "password", "security-token", "secret", "secret_key", "session_token", "sig", "signature",
    "token", "x-amz-credential", "x-amz-security-token", "x-amz-signature", "x-oss-security-token",
]
HEADER_NAMES = [
    "access-key", "access-passphrase", "access-sign", "api-key", "api-sign", "authorization", "cookie",
    "ok-access-key", "ok-access-passphrase", "ok-access-sign", "proxy-authorization", "set-cookie",
    "x-amz-security-token", "x-api-key", "x-bapi-api-key", "x-bapi-sign", "x-mbx-apikey", "x-oss-security-token",
]


ASSIGNED_WORDS = ["SECRET", "TOKEN", "PASSWORD", "PASSWD", "API_KEY", "ACCESS_KEY"]

# A quoted text on one line, in which a backslash takes the next character along.
_QUOTED = "(?:" + "|".join(rf"{q}(?:[^{q}\\\r\n]|\\[^\r\n])*{q}" for q in "\"'") + ")"


def _one_of(names: list[str], spell: Callable[[str], str] = str) -> str:
    """Any of the names, longer ones first."""
    return "(?:" + "|".join(map(spell, sorted(names, key=lambda n: (-len(n), n)))) + ")"


def _percent(name: str) -> str:
    """A name as it may stand in a query: any character as itself or percent-encoded, in either case."""
    return "".join(f"(?:{c}|" + "|".join(sorted({f"%{ord(v):x}" for v in (c, c.upper())})) + ")" for c in name)


def redaction_steps() -> list[tuple[str, str]]:
    """Pattern and replacement of each step. What introduces a secret is kept, and all of its value hidden."""
    headers, bare = _one_of(HEADER_NAMES), r"[^\s,;&]+"
    places = [
        (r"[?&]" + _one_of(QUERY_NAMES, _percent) + "=", r"[^\s&]*"),
        (rf"\b{headers}\s*:\s*", r"[^\r\n]+"),  # a header, whose value may begin on the next line
        (rf"[\"']{headers}[\"']\s*[:,]\s*b?", _QUOTED),  # a header in a printed mapping or list of pairs
        (rf"\b\w*{_one_of(ASSIGNED_WORDS)}\w*\s*=\s*", f"(?:{_QUOTED}|{bare})"),
        (r"\bauth[ \t]*=[ \t]*", rf"\([ \t]*b?{_QUOTED}[ \t]*,[ \t]*b?{_QUOTED}[ \t]*\)"),  # user and password
    ]
    urls = [(r"(?i)socks5h?://\S+", "[REDACTED_PROXY]"), (r"(?i)\b(https?|wss?)://[^\s/?#]*@", "$1://")]
    return urls + [(f"(?i)({before}){value}", "$1[REDACTED]") for before, value in places]


def redacted(text: Column | str) -> Column:
    """A text without credentials in URLs, queries, headers (also printed ones), assignments and authentication pairs."""
    return reduce(lambda t, s: F.regexp_replace(t, F.lit(s[0]), F.lit(s[1])), redaction_steps(), _c(text))


# Requests


def request_outcome(status: Column | str, explicit_ban: Column | None = None) -> Column:
    """ban, throttle, backoff or do_not_retry, from the HTTP status or an exchange's own ban notice."""
    banned = F.lit(False) if explicit_ban is None else F.coalesce(explicit_ban, F.lit(False))
    return (
        F.when(banned | (_c(status) == 418), "ban")
        .when(_c(status) == 429, "throttle")
        .when(_c(status).isin(408, 425, 500, 502, 503, 504), "backoff")
        .otherwise("do_not_retry")
    )


def http_date(text: Column) -> Column:
    """The forms that mail parsers take: `Sun, 6 Nov 1994 08:49:37 GMT` (also without the day's name, with an offset such as +0100, and
    with two digits of the year), `Sunday, 06-Nov-94 08:49:37 GMT` and `Sun Nov  6 08:49:37 1994`. Two digits of a year are 2000 to 2068
    up to 68, else 1969 to 1999. Null for anything else."""
    first = r"^(?:[A-Za-z]+, *)?([0-9]{1,2})[ -]([A-Za-z]{3})[ -]([0-9]{2}|[0-9]{4}) +([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?) *([+-][0-9]{4}|[A-Za-z]{1,3})?$"
    last = r"^[A-Za-z]{3} ([A-Za-z]{3}) +([0-9]{1,2}) ([0-9]{2}:[0-9]{2}:[0-9]{2}) ([0-9]{4})$"
    part = lambda pattern, n: F.regexp_extract(F.trim(text), pattern, n)
    is_last = F.rlike(F.trim(text), F.lit(last))
    year = F.when(is_last, part(last, 4)).otherwise(part(first, 3))
    full = F.when(F.length(year) == 2, F.concat(F.when(year <= "68", "20").otherwise("19"), year)).otherwise(year)
    clock = F.when(is_last, part(last, 3)).otherwise(part(first, 4))
    clock = F.when(F.length(clock) - F.length(F.replace(clock, F.lit(":"))) == 1, F.concat(clock, F.lit(":00"))).otherwise(clock)
    day, month = F.when(is_last, part(last, 2)).otherwise(part(first, 1)), F.initcap(F.when(is_last, part(last, 1)).otherwise(part(first, 2)))
    zone = F.when(is_last, F.lit("")).otherwise(part(first, 5))
    at = F.try_to_timestamp(F.concat_ws(" ", day, month, full, clock, F.lit("+0000")), F.lit("d MMM yyyy H:mm:ss Z"))
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    minutes = F.when(F.rlike(zone, F.lit("^[+-]")), sign * (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 4, 2).cast("int"))).otherwise(0)
    known = F.upper(zone).isin("", "GMT", "UTC", "UT", "Z") | F.rlike(zone, F.lit("^[+-]"))
    return F.when(known, F.timestamp_micros(F.unix_micros(at) - minutes.cast("long") * 60_000_000))


def retry_after_ns(value: Column | str, now_ns: Column | str, max_digits: int = 9) -> Column:
    """A Retry-After header as a delay: seconds, or an HTTP date; null if it is neither."""
    text = _c(value)
    seconds = F.when(F.length(text) <= max_digits, text.cast("long") * SECOND)
    date = http_date(text)
    until = F.when(date.isNotNull(), F.greatest(F.lit(0).cast("long"), F.unix_micros(date) * 1000 - _c(now_ns)))
    return F.when(F.rlike(text, F.lit(r"^[0-9]+$")), seconds).otherwise(until)


# Storage


def disk_state(free_bytes: Column | str, total_bytes: Column | str, low: tuple[float, int], critical: tuple[float, int]) -> Column:
    """The more conservative of a free-space ratio and a free-bytes bound, for two states."""
    below = lambda bound: (_c(free_bytes) < F.lit(bound[0]) * _c(total_bytes)) | (_c(free_bytes) < bound[1])
    return F.when(below(critical), "critical").when(below(low), "low").otherwise("ok")


def transform_of(mode: Column | str, suffix: Column | str, size: Column | str, least: int = 4096) -> Column:
    """How an archiver stores a file: as it is if already compressed, small or told so, else compressed."""
    packed = _c(suffix).isin("zst", "gz", "parquet", "zip")
    return F.when(_c(mode) == "passthrough", "passthrough").when(packed | (_c(size) < least), "passthrough").otherwise("zstd")


# Derived quantities


def turnover(quote: Column | str, base: Column | str, price: Column | str) -> tuple[Column, Column]:
    """Turnover in quote units and how it was found: given, or base volume times a reference price."""
    derived = _c(base) * _c(price)
    method = F.when(_c(quote).isNotNull(), "quote_volume").when(derived.isNotNull(), "base_times_price")
    return F.coalesce(_c(quote), derived), method


def contract_quantity(size: Column | str, contract_value: Column | str, value_currency: Column | str, base: Column | str, price: Column | str) -> Column:
    """A derivative's size in base units: contracts times their value, which may be stated in quote units; null where the
    price is zero."""
    notional = _c(size) * _c(contract_value)
    return F.when(_c(value_currency) == _c(base), notional).otherwise(F.try_divide(notional, _c(price)))


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def microprice(bid: Column, bid_qty: Column, ask: Column, ask_qty: Column) -> Column:
    """The mid weighted by the other side's quantity; null where there is none."""
    return F.try_divide(bid * ask_qty + ask * bid_qty, bid_qty + ask_qty)


def imbalance(bid: Column, ask: Column) -> Column:
    """The share by which one side outweighs the other; null where both are zero."""
    return F.try_divide(bid - ask, bid + ask)


def distance_bps(price: Column, reference: Column) -> Column:
    """Distance in hundredths of a percent; null for a reference of zero."""
    return F.try_divide(price - reference, reference) * 10_000


# Exact arithmetic, arrays, maps, JSON


def ceil_ratio(a: Column | str, b: Column | str) -> Column:
    """a / b rounded up, for whole numbers of which b is positive; in integers throughout."""
    up = _c(a) + _c(b) - 1
    return ((up - F.pmod(up, _c(b))) / _c(b)).cast("long")


def quotient_text(a: Column | str, b: Column | str, digits: int) -> Column:
    """a / b rounded half to even to so many digits (at most 18), as text, exactly: for whole numbers of up to 38 digits over ones
    of up to 18, whose quotient has up to 32 digits before the point. Null where b is zero or either is null.

    Long division in two parts: the whole quotient, which is a multiple of b divided by b and so comes out even, and the digits
    behind the point from what is left, both far from the 38 digits that decimals have.
    """
    if not 0 <= digits <= 18:
        raise ValueError("0 to 18 digits")
    wide = "decimal(38,0)"
    top, low = F.abs(_c(a).cast(wide)), F.nullif(F.abs(_c(b).cast("decimal(18,0)")), F.lit(0).cast("decimal(18,0)"))
    left = top % low
    whole = ((top - left) / low).cast(wide)
    shifted = left.cast("decimal(18,0)") * F.lit(10**digits).cast("decimal(19,0)")
    rest = shifted % low
    behind = ((shifted - rest) / low).cast(wide)
    odd = (behind if digits else whole) % 2 == 1
    up = (rest * 2 > low) | ((rest * 2 == low) & odd)
    behind = behind + F.when(up & F.lit(digits > 0), 1).otherwise(0)
    over = behind == F.lit(10**digits).cast(wide)
    whole = whole + F.when((over & F.lit(digits > 0)) | (up & F.lit(digits == 0)), 1).otherwise(0)
    behind = F.when(over, F.lit(0).cast(wide)).otherwise(behind)
    text = F.concat(whole.cast("string"), F.lit("."), F.lpad(behind.cast("string"), digits, "0")) if digits else whole.cast("string")
    negative = ((_c(a) < 0) != (_c(b) < 0)) & ((whole > 0) | (behind > 0))
    return F.when(negative, F.concat(F.lit("-"), text)).otherwise(text)


def half_even(a: Column | str, b: Column | str, digits: int) -> Column:
    """a / b rounded half to even, from an exact quotient (see quotient_text()) of numbers with up to six digits behind the point."""
    whole = lambda c: (_c(c).cast("decimal(38,6)") * 1_000_000).cast("decimal(38,0)")
    return quotient_text(whole(a), whole(b), digits).cast(f"decimal(38,{digits})")


def added(a: Column | str, b: Column | str) -> Column:
    """Element-wise sum of two arrays; a missing element counts as zero."""
    return F.zip_with(_c(a), _c(b), lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def steps(values: Column | str) -> Column:
    """Differences of neighbouring elements."""
    v = _c(values)
    return F.when(F.size(v) < 2, F.slice(v, 1, 0)).otherwise(F.zip_with(F.slice(v, F.lit(2), F.size(v) - 1), F.slice(v, F.lit(1), F.size(v) - 1), lambda b, a: b - a))


def first_true(flags: Column | str) -> Column:
    """Index (from 0) of the first true element, or null."""
    at = F.array_position(_c(flags), F.lit(True))
    return F.when(at > 0, at - 1)


def wire_symbols(names: Column | str, symbols: Column | str) -> Column:
    """Map from channel to the symbol used on it."""
    return F.map_from_arrays(_c(names), _c(symbols))


def canonical_json(*columns: Column | str) -> Column:
    """Compact JSON of some columns in the given order; null fields are left out."""
    return F.to_json(F.struct(*columns))


def packed_digest(c: Column | str) -> Column:
    """A SHA-256 in lowercase hex as its 32 bytes, any other text as more bytes than that: equal just where the texts are, at half the
    width. unpacked_digest() gives the text."""
    text = F.col(c) if isinstance(c, str) else c
    return F.when(text.rlike(r"^[0-9a-f]{64}\z"), F.unhex(text)).otherwise(F.encode(F.concat(F.lit(" " * 33), text), "UTF-8"))


def unpacked_digest(c: Column | str) -> Column:
    """The text of a packed_digest()."""
    data = F.col(c) if isinstance(c, str) else c
    return F.when(F.octet_length(data) == 32, F.lower(F.hex(data))).otherwise(F.decode(F.substring(data, 34, 1 << 30), "UTF-8"))
