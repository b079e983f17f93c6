"""Book replay as a stream: continuity, validity, levels and checksum text of each message, from keyed state; and, for batches with many
messages of a key, from a table of books that one batch leaves to the next, with a fold for each segment."""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalar import floor_to
from ..operators.books import CONTINUITY, segment_ends, segmented

#: Messages whose numbers fall into one block are folded together where a batch brings a key more rows than one chunk.
BLOCK = 1000
OUT = (
    "{keys}, seq long, time_ns long, segment long, valid boolean, break boolean, late boolean, text string, computed long, matches boolean, "
    "ended array<struct<side:string,price:string,quantity:string,since:long,until:long,at:long>>, placed array<struct<side:string,price:string,quantity:string>>"
)
#: Numbers of messages that are one stretch of a key's history, in which replaying() counts authorities.
STRETCH = 10_000
_INPUT = ["seq", "time_ns", "kind", "prev_seq", "first_seq", "bids", "asks", "checksum"]


def breaks(rule: str, row: dict, last: int | None, seen: int | None, place: int) -> bool:
    """The row-wise form of CONTINUITY: whether an update breaks its segment, of which `last` and `seen` are the last and the
    largest number before it, and `place` its place (from 1)."""
    seq, previous, first = row["seq"], row["prev_seq"], row["first_seq"]
    if last is None:
        return False
    if rule == "okx":
        return previous is not None and previous != last
    if rule == "binance_spot":
        return first is not None and seq > seen and first > seen + 1
    if rule == "binance_futures":
        if place == 2:
            return first is not None and not first <= last <= seq
        return previous is not None and previous != last
    if rule == "bitget":
        if previous is None or previous == 0:
            return False
        return not previous < last < seq if place == 2 else previous != last
    return rule == "kraken_futures" and seq <= last


def _number(text: str) -> str:
    return text.replace(".", "").lstrip("0")


class _Book:
    """The levels of one instrument, and which of them changed since they were read."""

    def __init__(self, levels: Iterator[tuple[tuple, tuple]]):
        self.levels: dict[tuple[str, str], tuple[str, int, int]] = {tuple(k): tuple(v) for k, v in levels}
        self.kept = dict(self.levels)
        self.order = {s: sorted((self.rank(s, p), p, _number(p) + _number(v[0])) for (side, p), v in self.levels.items() if side == s) for s in ("bid", "ask")}

    @staticmethod
    def rank(side: str, price: str) -> float:
        return -float(price) if side == "bid" else float(price)

    def remove(self, side: str, price: str) -> tuple[str, int, int] | None:
        gone = self.levels.pop((side, price), None)
        if gone is not None:
            order = self.order[side]
            del order[bisect_left(order, (self.rank(side, price), price))]
        return gone

    def put(self, side: str, price: str, quantity: str, time: int, seq: int) -> None:
        self.levels[side, price] = (quantity, time, seq)
        insort(self.order[side], (self.rank(side, price), price, _number(price) + _number(quantity)))

    def clear(self) -> list[tuple[str, str, tuple[str, int, int]]]:
        gone = [(s, p, v) for (s, p), v in self.levels.items()]
        self.levels.clear()
        self.order = {"bid": [], "ask": []}
        return gone

    def text(self, depth: int) -> str:
        return "".join([text for s in ("ask", "bid") for _, _, text in self.order[s][:depth]])


def _fold(row: dict, now: list, book: _Book, rule: str, depth: int | None) -> dict:
    """What a message gives; changes the book and `now`: segment, last and largest number, place, validity, number up to which all is folded."""
    segment, last, seen, place, valid, through = now
    seq, time = row["seq"], row["time_ns"]
    out = {"seq": seq, "time_ns": time, "text": None, "computed": None, "matches": None, "ended": [], "placed": [], "late": False}
    if through is not None and seq <= through:
        return out | {"segment": segment, "valid": None, "break": None, "late": True}
    broke = False
    if row["kind"] == "snapshot":
        segment, place, valid = segment + 1, 0, True
        last = seen = None
        out["ended"] = [(s, p, q, since, None, at) for s, p, (q, since, at) in book.clear()]
    place += 1
    if row["kind"] != "snapshot":
        broke = breaks(rule, row, last, seen, place)
        valid = valid and not broke
    for side, changes in (("bid", row["bids"]), ("ask", row["asks"])):
        for price, quantity in dict(changes).items():  # of several changes of a price the last one counts
            gone = book.remove(side, price)
            if gone is not None:
                out["ended"].append((side, price, gone[0], gone[1], time, gone[2]))
            if float(quantity) > 0:
                book.put(side, price, quantity, time, seq)
                out["placed"].append((side, price, quantity))
        if depth is not None:
            for _, price, _ in book.order[side][depth:]:
                gone = book.remove(side, price)
                out["ended"].append((side, price, gone[0], gone[1], time, gone[2]))
    if depth is not None:
        out["text"] = book.text(10)
        out["computed"] = zlib.crc32(out["text"].encode())
        out["matches"] = row["checksum"] == out["computed"]
    now[:] = [segment, seq, seq if seen is None else max(seen, seq), place, valid, seq]
    return out | {"segment": segment, "valid": valid and segment > 0, "break": broke}


class BookReplay(StatefulProcessor):
    """See replayed()."""

    def __init__(self, keys: list[str], rule: str, depth: int | None):
        self.keys, self.rule, self.depth = keys, rule, depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.control = handle.getValueState("control", "segment long, last long, seen long, place long, valid boolean, through long")
        self.levels = handle.getMapState("levels", "side string, price string", "quantity string, since long, at long")
        self.parked = handle.getMapState("parked", "block long", "rows string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = list(self.control.get()) if self.control.exists() else [0, None, None, 0, True, None]
        book = _Book(self.levels.iterator() if self.levels.exists() else iter(()))
        for part in self._in_order(rows):
            made = [_fold(row, now, book, self.rule, self.depth) for row in part]
            yield pd.DataFrame([{**dict(zip(self.keys, key, strict=True)), **r} for r in made])
        self.control.update(tuple(now))
        for k in book.kept.keys() - book.levels.keys():
            self.levels.removeKey(k)
        for k, v in book.levels.items():
            if book.kept.get(k) != v:
                self.levels.updateValue(k, v)

    def close(self) -> None:
        pass

    def _in_order(self, chunks: Iterator[pd.DataFrame]) -> Iterator[list[dict]]:
        """A batch's rows of a key, in order. Rows of more than one chunk are parked in the state by blocks of their numbers, so that
        only a block is held at a time."""

        def plain(chunk: pd.DataFrame) -> list[dict]:
            chunk = chunk[_INPUT]
            rows = chunk.astype(object).where(chunk.notna(), None).to_dict("records")
            for row in rows:
                for c in ("seq", "time_ns", "prev_seq", "first_seq", "checksum"):
                    row[c] = None if row[c] is None else int(row[c])
                for c in ("bids", "asks"):
                    row[c] = [] if row[c] is None else [[str(x) for x in level] for level in row[c]]
            return rows

        first = next(chunks)
        second = next(chunks, None)
        if second is None:
            yield sorted(plain(first), key=lambda r: r["seq"])
            return
        blocks = set()
        for chunk in chain((first, second), chunks):
            blocks |= self._park(plain(chunk))
        for block in sorted(blocks):
            rows = json.loads(self.parked.getValue((block,))[0])
            self.parked.removeKey((block,))
            yield sorted(rows, key=lambda r: r["seq"])

    def _park(self, rows: list[dict]) -> set[int]:
        by_block: dict[int, list[dict]] = {}
        for row in rows:
            by_block.setdefault(row["seq"] // BLOCK, []).append(row)
        for block, mine in by_block.items():
            before = json.loads(self.parked.getValue((block,))[0]) if self.parked.containsKey((block,)) else []
            self.parked.updateValue((block,), (json.dumps(before + mine),))
        return set(by_block)


def replayed(messages: DataFrame, keys: list[str], rule: str, depth: int | None = None) -> DataFrame:
    """A row for each message (seq, time_ns, kind, prev_seq, first_seq, bids, asks, checksum) of a stream: its segment, whether it
    breaks it, whether the book is valid, and what it did to the levels: `placed`, and `ended` with since when and until when they
    stood (`at`: the message that placed them; an authority ends levels with no time of its own).

    With a depth, each side is trimmed to it after each message, and `text` is that of the best ten asks and bids, `computed` its
    CRC-32. A message whose number is not above all that were folded before is given back as `late` and changes nothing.

    State: the levels of each book, and six numbers. The stream needs a state store with column
    families, which results(states=True) sets while it runs.
    """
    if rule not in CONTINUITY:
        raise ValueError(f"no rule {rule}")
    kinds = dict(messages.dtypes)
    rows = messages.select(*keys, *_INPUT).groupBy(*keys)
    out = OUT.format(keys=", ".join(f"{k} {kinds[k]}" for k in keys))
    return rows.transformWithStateInPandas(BookReplay(keys, rule, depth), out, "Append", "None")


_LEVEL = {"side": "string", "price": "string", "quantity": "string", "since": "long", "at": "long"}
_LEFT = f"place long, levels array<struct<{','.join(f'{n}:{t}' for n, t in _LEVEL.items())}>>, left boolean"


def _same(a: list, b: list) -> F.Column:
    return reduce(lambda x, y: x & y, [p.eqNullSafe(q) for p, q in zip(a, b, strict=True)])


def _numbered(batch: DataFrame, books: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Adds each message's segment, counted on from the books that the batches before left. The kind of late ones becomes `late`."""
    known = books.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("segment").alias("_segment"), F.col("seq").alias("_through"))
    rows = batch.select(*keys, *_INPUT).join(known, _same([F.col(k) for k in keys], [F.col(f"_k{i}") for i in range(len(keys))]), "left")
    rows = rows.withColumns({"_tie": F.xxhash64(*_INPUT), "_stretch": floor_to("seq", width)})
    before = F.lag("seq").over(Window.partitionBy(*keys, "_stretch").orderBy("seq", "_tie"))
    late = F.coalesce(F.col("seq") <= F.col("_through"), F.lit(False)) | F.coalesce(F.col("seq") == before, F.lit(False))
    rows = segmented(rows.withColumn("kind", F.when(late, "late").otherwise(F.col("kind"))), keys, ["seq", "_tie"], width)
    return rows.select(*keys, *_INPUT, "_tie", (F.col("segment") + F.coalesce("_segment", F.lit(0))).alias("segment"))


def _plain(column: pa.Array) -> list:
    """A column's values, whole numbers as such beside nulls too; lists are cut out of their values by offsets."""
    if column.null_count == len(column):
        return [None] * len(column)
    if pa.types.is_list(column.type) and not pa.types.is_struct(column.type.value_type):
        ends, there = column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False).tolist()
        values, ends = _plain(column.values[int(ends[0]) : int(ends[-1])]), (ends - ends[0]).tolist()
        return [values[a:b] if t else None for a, b, t in zip(ends, ends[1:], there, strict=False)]
    return column.to_pylist() if pa.types.is_nested(column.type) else column.to_pandas(integer_object_nulls=True).tolist()


def _segments(keys: list[str], rule: str, depth: int | None, out: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Folds messages that come by key, segment and number, each segment after the book that was left of it, if there is one. Gives a
    row for each message, and one for the book that a segment leaves. One book and one batch of rows are held at a time."""
    level = lambda *names: pa.list_(pa.struct([(n, pa.int64() if n in ("since", "until", "at") else pa.string()) for n in names]))
    kinds = {n: pa.int64() for n in ("seq", "time_ns", "segment", "computed", "place")} | {n: pa.bool_() for n in ("valid", "break", "late", "matches", "left")}
    kinds |= {"text": pa.string(), "ended": level("side", "price", "quantity", "since", "until", "at"), "placed": level("side", "price", "quantity"), "levels": level(*_LEVEL)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now, book, schema = None, [], None, None

        def left() -> tuple:
            levels = [(*k, *v) for k, v in book.levels.items()]
            found = dict(zip(keys, at, strict=False)) | {"segment": now[0], "seq": now[1], "place": now[3], "valid": now[4], "levels": levels, "left": True}
            return tuple(found.get(n) for n in out)

        def frame(made: list[tuple]) -> pa.RecordBatch:
            columns = zip(*made, strict=True) if made else [()] * len(out)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            schema = schema or pa.schema([(n, kinds[n] if n in kinds else batch.schema.field(n).type) for n in out])
            made, names = [], batch.schema.names
            for values in zip(*map(_plain, batch.columns), strict=True):
                row = dict(zip(names, values, strict=True))
                mine = (*[row[k] for k in keys], row["segment"])
                if mine != at:
                    if at is not None:
                        made.append(left())
                    fixed = dict(zip(keys, mine, strict=False)) | {"left": False}
                    at, now, book = mine, [row["segment"] - (row["kind"] == "snapshot"), None, None, 0, True, None], _Book(iter(()))
                if row["left"]:
                    now = [row["segment"], row["seq"], row["seq"], row["place"], row["valid"], row["seq"]]
                    book = _Book(((x["side"], x["price"]), (x["quantity"], x["since"], x["at"])) for x in row["levels"])
                else:
                    row["bids"], row["asks"] = row["bids"] or [], row["asks"] or []
                    given = fixed | _fold(row, now, book, rule, depth)
                    made.append([given.get(n) for n in out])
            yield frame(made)
        if at is not None:
            yield frame([left()])

    return run


def replaying(keys: list[str], rule: str, root: str, depth: int | None = None, width: int = STRETCH) -> Callable[[DataFrame, int], DataFrame]:
    """What a stream of messages does with each batch (see results() and run_available()): replayed() for keys with many messages, as
    its unit of work is a segment, not a key. An authority replaces all state, so a batch's segments are numbered first, by stretches
    of `width` numbers, and then folded apart; only the first of a key goes on from the book that the batch before left of it.

    The state is a table: under <root>/batch=<n>, beside the rows (see told()), lies the book that each segment left (see books_left()).
    What a batch writes depends on its rows and the books of the batch before, so that a batch that is run again writes the same.
    A segment's messages are folded as they are read from a sorted partition: a task holds one book and one batch of rows. Gives keys,
    segment and seq (the last number) of the books that the batch left.
    """
    if rule not in CONTINUITY:
        raise ValueError(f"no rule {rule}")

    def replay(batch: DataFrame, number: int) -> DataFrame:
        spark = batch.sparkSession
        schema = _stored(batch.select(*keys))
        path = f"{root}/batch={number}"
        before = spark.read.schema(schema).parquet(f"{root}/batch={number - 1}") if number else spark.createDataFrame([], schema)
        books = _newest(before, keys)
        rows = _numbered(batch, books, keys, width).withColumn("left", F.lit(False)).unionByName(books, allowMissingColumns=True)
        rows = rows.repartition(*keys, "segment").sortWithinPartitions(*keys, "segment", F.desc("left"), "seq", "_tie").drop("_tie")
        out = [x.split()[0] for x in schema.split(", ")]
        rows.mapInArrow(_segments(keys, rule, depth, out), schema).write.mode("overwrite").parquet(path)
        return _newest(spark.read.schema(schema).parquet(path), keys).select(*keys, "segment", "seq")

    return replay


def _stored(keys: DataFrame) -> str:
    return f"{OUT.format(keys=', '.join(f'{k} {t}' for k, t in keys.dtypes))}, {_LEFT}"


def _newest(stored: DataFrame, keys: list[str]) -> DataFrame:
    """The book of each key's last segment."""
    kept = ["seq", "segment", "place", "valid", "levels", "left"]
    found = stored.filter("left").groupBy(*keys).agg(F.max_by(F.struct(*kept), "segment").alias("_b"))
    return found.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in kept])


def told(spark: SparkSession, root: str) -> DataFrame:
    """The rows of replayed(), from what replaying() stored. Levels that an authority ended are not in its row's `ended`: they are those
    in books_left() of the segment before."""
    return spark.read.parquet(root).filter("NOT left").drop("batch", "left", "place", "levels")


def books_left(spark: SparkSession, keys: list[str], root: str) -> DataFrame:
    """The book that each segment left when it ended, or that it has now: keys, segment, seq (its last number), valid, levels."""
    kept = ["seq", "valid", "levels"]
    found = spark.read.parquet(root).filter("left").groupBy(*keys, "segment").agg(F.max_by(F.struct(*kept), "batch").alias("_b"))
    return found.select(*keys, "segment", *[F.col(f"_b.{c}").alias(c) for c in kept])


def level_lifetimes(replay: DataFrame, keys: list[str], end: int) -> DataFrame:
    """How long each level stood, from the rows of replayed(): the stream's twin of lifetimes(). A level that no message took away
    stands until the next segment begins, or until just after the instrument's last message."""
    rows = replay.filter("NOT late")
    until = segment_ends(rows, keys, "time_ns", end)
    last = rows.groupBy(*keys).agg(F.max("time_ns").alias("_last"))
    mine = lambda c: F.col(f"_x.{c}")
    ended = rows.select(*keys, F.explode("ended").alias("_x")).select(*keys, *[mine(c).alias(c) for c in ("side", "price", "quantity", "since", "until", "at")])
    placed = rows.select(*keys, "seq", "segment", "time_ns", F.explode("placed").alias("_x"))
    placed = placed.select(*keys, "segment", F.col("seq").alias("at"), F.col("time_ns").alias("since"), mine("side").alias("side"), mine("price").alias("price"), mine("quantity").alias("quantity"))
    closed = ended.filter(F.col("until").isNotNull()).select(*keys, "at", "side", "price", "quantity", "until")
    same = [*keys, "at", "side", "price", "quantity"]
    stood = placed.join(closed.groupBy(*same).agg(F.max("until").alias("until")), same, "left")
    stood = stood.join(until.withColumnRenamed("until", "_until"), [*keys, "segment"]).join(last, keys)
    to = F.coalesce("until", F.least("_until", F.col("_last") + 1))
    return stood.select(*keys, "segment", "side", F.col("price").cast("decimal(18,9)").alias("price"), F.col("quantity").cast("decimal(18,9)").alias("quantity"), F.col("since").alias("from_ns"), to.alias("to_ns")).filter("from_ns < to_ns")
