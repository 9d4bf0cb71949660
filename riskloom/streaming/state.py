"""History features on a stream, from state that is kept per customer.

The batch operators of ``operators.history`` see all rows at once. Here a customer's state lives in RocksDB, is restored
from the checkpoint, and holds no more than is needed:

* the rows of seconds that the watermark has not passed, because a row counts all others of its second;
* sums per second, in hours, as far back as the longest span reaches; a timer clears them once that time has passed
  without a further transaction;
* the running sum of every span, so that a new second costs what enters and leaves and not the whole span;
* the last row, and the values seen before (beneficiary, state), which have no end.

A row is handed on once its second is closed, so results equal the batch result on closed seconds. Rows later than the
watermark are dropped by Spark, as with any stateful operator. A row without a time is handed on at once, counts
nothing, is counted nowhere and is no one's previous row. State is keyed, so one customer's rows of a micro-batch pass
through one task one after the other; what is held of them is numbers.

There are three layouts of the same state. Kept in parts, as above, a micro-batch reads and writes only what it touches, and
every part costs a message to the JVM and back. Kept whole (``WholeHistory``), all parts of a customer are one value that comes
with the rows: no messages, but a customer's value is read and written as a whole in every micro-batch it has a part in. Kept in
groups (``grouped.GroupHistory``), all of many customers is one value, and they are worked on together as columns.
"""

import itertools
import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from riskloom.functions import geo
from riskloom.functions.measures import cents
from riskloom.operators import history
from riskloom.streaming.grouped import GroupHistory

HOUR = 3600
PREVIOUS = ("epoch", "purchase_latitude", "purchase_longitude", "purchase_state")
#: Spans in seconds, and whether a row's own second belongs to them.
SPANS = {"day": (history.DAY, True), "month": (30 * history.DAY, False)}
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: How times are written in the text of columns that are only passed on.
PASSED = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: The column in which a row passes to Python and back as one text, so that whole numbers beside nulls stay what they are.
ROW = "_row"
#: Groups into which customers are dealt: a checkpoint is bound to their number.
GROUPS = 1024
FEATURES = (
    "transactions_last_24h long, accumulated_amount_24h double, avg_transaction_amount_30d double, prev_timestamp long, "
    "prev_latitude double, prev_longitude double, prev_state string")


def _text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _order(row: Row) -> tuple:
    """Time, then transaction, then all other values, nulls first."""
    return (row.epoch, *[(v is not None, v) for v in row])


@dataclass
class Spans:
    """Sums of rows, amounts and cents per second, and over each span up to the last second that was added.

    ``hours`` has by hour the seconds and their sums, in order. ``load`` fetches an hour that is not held here; hours
    that were changed and hours that no span reaches any more are named by ``changed`` and ``gone``.
    """

    spans: list[tuple[int, bool]]
    kept: list[int] = field(default_factory=list)
    totals: list[list[int]] = field(default_factory=list)
    load: object = None
    hours: dict[int, list[list[int]]] = field(default_factory=dict)
    changed: set[int] = field(default_factory=set)
    gone: set[int] = field(default_factory=set)

    def __post_init__(self):
        self.totals = self.totals or [[0, 0, 0, 0] for _ in self.spans]  # sums, and the first second that is in them

    def _hour(self, hour: int) -> list[list[int]]:
        if hour not in self.hours:
            self.hours[hour] = self.load(hour)
        return self.hours[hour]

    def add(self, second: int, own: list[int]) -> list[list[int]]:
        """Add the sums of a later second; the sums of every span as that second sees them."""
        seen = []
        for total, (span, now) in zip(self.totals, self.spans, strict=True):
            low = second - span
            for hour in self.kept:
                if hour * HOUR >= low:
                    break
                if (hour + 1) * HOUR <= total[3]:
                    continue
                for at, *sums in self._hour(hour):
                    if total[3] <= at < low:
                        total[:3] = [a - b for a, b in zip(total[:3], sums, strict=True)]
            total[3] = max(total[3], low)
            after = [a + b for a, b in zip(total[:3], own, strict=True)]
            seen.append(after if now else total[:3])
            total[:3] = after
        reach = min(total[3] for total in self.totals)
        for hour in [h for h in self.kept if (h + 1) * HOUR <= reach]:
            self.kept.remove(hour)
            self.hours.pop(hour, None)
            self.changed.discard(hour)
            self.gone.add(hour)
        hour = second // HOUR
        if hour not in self.kept:
            self.kept.append(hour)
            self.hours[hour] = []
            self.gone.discard(hour)
        self._hour(hour).append([second, *own])
        self.changed.add(hour)
        return seen


class History(StatefulProcessor):
    """Features of each transaction of a customer, in the order of time and transaction."""

    def __init__(self, key: str, carried: StructType, firsts: dict[str, str]):
        self.key, self.names, self.firsts = key, carried.names, firsts
        self.carried = carried
        self.retention = max(span for span, _ in SPANS.values())

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", self.carried)
        self.last = handle.getValueState("last", "epoch long, purchase_latitude double, purchase_longitude double, purchase_state string")
        self.sums = handle.getValueState("sums", "kept array<long>, totals array<array<long>>, ends long")
        self.hours = handle.getMapState("hours", "hour long", "seconds array<array<long>>")
        self.seen = handle.getMapState("seen", "name string, value string", "epoch long")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held, earliest = [], None
        for row in rows:
            if row.epoch is None:
                yield self._made(key, row, [0, 0, 0], [0, 0, 0], None, dict.fromkeys(self.firsts, False))
                continue
            held.append(tuple(row[name] for name in self.names))
            earliest = row.epoch if earliest is None else min(earliest, row.epoch)
        if held:
            self.open.appendList(held)
            self.handle.registerTimer((earliest + 1) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # Every call on state goes to the JVM and back, which costs more than all else here, so none is made twice.
        until = timerValues.getCurrentWatermarkInMs() // 1000  # seconds before it are closed
        made = Row(*self.names)
        rows = [made(*r) for r in self.open.get()]
        closed = sorted((r for r in rows if r.epoch < until), key=_order)
        waiting = [tuple(r) for r in rows if r.epoch >= until]
        if closed:
            yield from self._closed(key, closed)
            if waiting:
                self.open.put(waiting)
                self.handle.registerTimer((min(r[self.names.index("epoch")] for r in waiting) + 1) * 1000)
            else:
                self.open.clear()
        elif not rows and (sums := self.sums.get()) is not None and sums[2] < until:
            self.sums.clear()
            self.hours.clear()

    def _closed(self, key, rows: list[Row]) -> Iterator[Row]:
        kept, totals, ends = self.sums.get() or ([], [], None)
        stored = set(kept)
        spans = Spans(list(SPANS.values()), list(kept), [list(t) for t in totals], lambda h: [list(s) for s in self.hours.getValue((h,))[0]])
        last = self.last.get()
        previous = None if last is None else tuple(last)
        known: set[tuple[str, str]] = set()
        at = 0
        while at < len(rows):
            to = at
            while to < len(rows) and rows[to].epoch == rows[at].epoch:
                to += 1
            amounts = [r["_cents"] for r in rows[at:to] if r["_cents"] is not None]
            day, month = spans.add(rows[at].epoch, [to - at, len(amounts), sum(amounts)])
            for row in rows[at:to]:
                first = {}
                for name, value in ((name, row[column]) for name, column in self.firsts.items()):
                    first[name] = value is not None and (name, value) not in known and not self.seen.containsKey((name, value))
                    if value is not None:
                        known.add((name, value))
                    if first[name]:
                        self.seen.updateValue((name, value), (row.epoch,))
                yield self._made(key, row, day, month, previous, first)
                previous = tuple(row[name] for name in PREVIOUS)
            at = to
        self.last.update(previous)
        for hour in spans.changed:
            self.hours.updateValue((hour,), (spans.hours[hour],))
        for hour in spans.gone & stored:
            self.hours.removeKey((hour,))
        if ends is not None:
            self.handle.deleteTimer(ends * 1000)
        ends = rows[-1].epoch + self.retention + 1
        self.handle.registerTimer(ends * 1000)
        self.sums.update((spans.kept, spans.totals, ends))

    def _made(self, key, row, day: list[int], month: list[int], previous: tuple | None, first: dict[str, bool]) -> Row:
        values = {name: row[name] for name in self.names}
        values["transactions_last_24h"] = day[0]
        values["accumulated_amount_24h"] = day[2] / 100.0 if day[1] else None
        values["_month_amounts"], values["_month_cents"] = month[1], month[2]
        for name, value in zip(("prev_timestamp", "prev_latitude", "prev_longitude", "prev_state"), previous or [None] * 4, strict=True):
            values[name] = value
        return Row(**{self.key: key[0]}, **values, **first)


class Value:
    """One value of a customer's state, in memory."""

    def __init__(self, value=None):
        self.value = value

    def get(self):
        return self.value

    def update(self, value) -> None:
        self.value = value

    def clear(self) -> None:
        self.value = None


class Named:
    """Values of a customer's state by name, in memory."""

    def __init__(self, values: dict):
        self.values = values

    def containsKey(self, name) -> bool:
        return name in self.values

    def getValue(self, name):
        return self.values[name]

    def updateValue(self, name, value) -> None:
        self.values[name] = value

    def removeKey(self, name) -> None:
        del self.values[name]

    def clear(self) -> None:
        self.values.clear()


class Untimed:
    """Stands for timers where the next time at which a customer is looked at follows from the state."""

    def registerTimer(self, at: int) -> None:
        pass

    def deleteTimer(self, at: int) -> None:
        pass


class WholeHistory(History):
    """``History`` with all state of a customer in one text, which Spark hands over together with the customer's rows and
    takes back with the results, so that no part of it is asked for by a message of its own."""

    def restore(self, kept: str | None) -> None:
        """Take up the state of a customer, None for a new one."""
        rows, last, sums, hours, seen = json.loads(kept) if kept else ([], None, None, [], [])
        made = Row(*self.names)
        self.handle = Untimed()
        self.open = [made(*r) for r in rows]
        self.last, self.sums = Value(last), Value(sums)
        self.hours = Named({(hour,): (seconds,) for hour, seconds in hours})
        self.seen = Named({(name, value): (epoch,) for name, value, epoch in seen})

    def kept(self) -> str:
        """The state as ``restore`` takes it."""
        hours = [[hour, seconds] for (hour,), (seconds,) in self.hours.values.items()]
        seen = [[*name, epoch] for name, (epoch,) in self.seen.values.items()]
        return _text([self.open, self.last.get(), self.sums.get(), hours, seen])

    def next_time(self) -> int | None:
        """The watermark in ms that must be passed before there is something to do without further rows."""
        if self.open:
            return (min(r.epoch for r in self.open) + 1) * 1000 - 1
        sums = self.sums.get()
        return None if sums is None else (sums[2] + 1) * 1000 - 1

    def added(self, key, rows: list[Row]) -> Iterator[Row]:
        """Hold rows until their second is closed; those without a time are handed on."""
        for row in rows:
            if row.epoch is None:
                yield self._made(key, row, [0, 0, 0], [0, 0, 0], None, dict.fromkeys(self.firsts, False))
            else:
                self.open.append(row)

    def advanced(self, key, watermark: int) -> Iterator[Row]:
        """The rows of seconds that the watermark, in ms, has closed."""
        until = watermark // 1000  # seconds before it are closed
        closed = sorted((r for r in self.open if r.epoch < until), key=_order)
        if closed:
            self.open = [r for r in self.open if r.epoch >= until]
            yield from self._closed(key, closed)
        elif not self.open and (sums := self.sums.get()) is not None and sums[2] < until:
            self.sums.clear()
            self.hours.clear()

    def run(self, key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        self.restore(state.get[0] if state.exists else None)
        made, rows = Row(*self.names), []
        if not state.hasTimedOut:
            texts = (json.loads(text) for frame in frames for text in frame[ROW])
            rows = [made(*[row[name] for name in self.names]) for row in texts]
        out = itertools.chain(self.added(key, rows), self.advanced(key, state.getCurrentWatermarkMs()))
        while part := [_text(row.asDict()) for row in itertools.islice(out, 10_000)]:
            yield pd.DataFrame({ROW: part})
        state.update((self.kept(),))
        at = self.next_time()
        if at is not None:
            state.setTimeoutTimestamp(max(at, state.getCurrentWatermarkMs()))


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """A stream that is started inside keeps its state in RocksDB; the session's setting is put back afterwards."""
    name, provider = STORE
    before = spark.conf.get(name, None)
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def with_history(
    transactions: DataFrame, firsts: dict[str, str] | None = None, lateness: str = "10 minutes", key: str = "customer_id",
    time: str = "event_time", keep: list[str] | None = None, whole: bool = False, groups: int | None = None,
) -> DataFrame:
    """A stream of transactions with what their customers did before; start it inside ``rocksdb``.

    ``keep`` names columns that are handed on (all by default); columns that are computed here replace given ones.
    ``firsts`` maps names of flags to columns: the flag says that the customer's row is the first with that value.
    With ``whole`` all state of a customer is one value: several times cheaper where there are many customers with up to
    thousands of rows in the longest span; without it a micro-batch reads and writes only the hours that it touches.
    With ``groups`` customers are dealt into so many groups, and all state of a group is one value: cheapest by far where a
    micro-batch has rows of many customers. Their number stays with the checkpoint; a task holds a group's rows and state.
    """
    firsts = firsts or {}
    computed = {f.name for f in StructType.fromDDL(FEATURES).fields} | set(firsts) | {"epoch"}
    keep = [c for c in (transactions.columns if keep is None else keep) if c not in computed and c not in (key, time)]
    read = ["transaction_id", *PREVIOUS[1:], *firsts.values()]
    # columns that nothing here reads pass through state and Python as one text
    passed = [c for c in keep if c not in read]
    given = {c: transactions.schema[c] for c in passed}
    narrow = transactions.withWatermark(time, lateness).select(
        key, time, F.unix_seconds(time).alias("epoch"), *dict.fromkeys(read), cents("amount").alias("_cents"),
        *([F.to_json(F.struct(*passed), PASSED).alias("_passed")] if passed else []))
    carried = StructType([narrow.schema["epoch"], narrow.schema["transaction_id"]] + [
        f for f in narrow.schema.fields if f.name not in (key, time, "epoch", "transaction_id")])
    made = StructType([narrow.schema[key], *carried.fields])
    for f in [*StructType.fromDDL(FEATURES.replace("avg_transaction_amount_30d double", "_month_amounts long, _month_cents long")).fields]:
        made = made.add(f)
    for name in firsts:
        made = made.add(name, "boolean")
    if groups:
        return _in_groups(transactions, firsts, lateness, key, time, read, passed, groups)
    if whole:
        as_text = F.to_json(F.struct(key, *carried.names), PASSED | {"ignoreNullFields": "false"}).alias(ROW)
        found = narrow.select(key, time, as_text).groupBy(key).applyInPandasWithState(
            WholeHistory(key, carried, firsts).run, f"{ROW} string", "kept string", "append", GroupStateTimeout.EventTimeTimeout)
        rows = found.select(F.from_json(ROW, made, PASSED).alias(ROW)).select(f"{ROW}.*")
    else:
        rows = narrow.groupBy(key).transformWithState(History(key, carried, firsts), made, "Append", "EventTime")
    if passed:
        rows = rows.withColumn("_passed", F.from_json("_passed", StructType(list(given.values())), PASSED)).select("*", "_passed.*").drop("_passed")
    average = F.round(F.try_divide(F.col("_month_cents") / F.lit(100.0), F.col("_month_amounts")), 2)
    return rows.withColumn("avg_transaction_amount_30d", average).withColumn(time, F.timestamp_seconds("epoch")).drop(
        "_month_amounts", "_month_cents", "_cents")


def _in_groups(
    transactions: DataFrame, firsts: dict[str, str], lateness: str, key: str, time: str, read: list[str], passed: list[str], groups: int,
) -> DataFrame:
    """``with_history`` with the state of a group of customers as one value. What is only handed on, and what a later row
    asks of the row before it, pass through state and Python as two texts."""
    whole, own = cents("amount"), [key, "epoch", *dict.fromkeys(read), *passed]
    timed = transactions.withWatermark(time, lateness).withColumn("epoch", F.unix_seconds(time))
    values = {f"_first_{k}": F.col(c).cast("string") for k, c in enumerate(firsts.values())}
    narrow = timed.select(
        F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("_group"), time, F.col("epoch").isNotNull().alias("_timed"),
        F.coalesce("epoch", F.lit(0)).alias("_at"), F.to_json(F.struct(key), PASSED).alias("_key"),
        F.to_json(F.struct(*own), PASSED).alias("_own"), F.to_json(F.struct(*PREVIOUS), PASSED).alias("_place"),
        whole.isNotNull().alias("_has"), F.coalesce(whole, F.lit(0).cast("long")).alias("_cents"),
        *[v.alias(n) for n, v in values.items()])
    flagged = "".join(f", `{name}` boolean" for name in firsts)
    work = GroupHistory(read, list(firsts), list(SPANS.values()), groups)
    found = narrow.groupBy("_group").applyInPandasWithState(
        work.run, "_own string, _before string, transactions_last_24h long, accumulated_amount_24h double, _month_amounts long, "
        f"_month_sum double{flagged}", "kept binary", "append", GroupStateTimeout.EventTimeTimeout)
    shape = StructType([timed.schema[c] for c in own])
    place = StructType([timed.schema[c] for c in PREVIOUS])
    parsed = found.withColumns({"_own": F.from_json("_own", shape, PASSED), "_before": F.from_json("_before", place, PASSED)})
    average = F.round(F.try_divide("_month_sum", "_month_amounts"), 2)
    names = ("prev_timestamp", "prev_latitude", "prev_longitude", "prev_state")
    return parsed.select(
        *[F.col("_own")[c].alias(c) for c in [key, "epoch", *dict.fromkeys(read)]], "transactions_last_24h", "accumulated_amount_24h",
        *[F.col("_before")[c].alias(n) for n, c in zip(names, PREVIOUS, strict=True)], *firsts, *[F.col("_own")[c].alias(c) for c in passed],
        average.alias("avg_transaction_amount_30d"), F.timestamp_seconds(F.col("_own")["epoch"]).alias(time))


def with_movement(rows: DataFrame, distance=geo.planar_km) -> DataFrame:
    """Time, distance and speed since the previous transaction, from the columns that ``with_history`` adds."""
    return history.moved(rows, distance)
