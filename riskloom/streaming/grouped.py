"""Stream history of many customers at once: customers are dealt into groups, and all state of a group is one value.

A call for each customer costs more than the work on its rows where there are many customers with few rows. Here a call sees a
whole group: its rows and its state are columns, put in order, added up and searched together, whoever they belong to. The
state is what ``state.History`` keeps, written as compressed Arrow columns:

* the rows of seconds that the watermark has not passed;
* sums per customer and second as far back as the longest span reaches;
* the last row of every customer, and the values it was seen with, which have no end.

What is only handed on is text and is not looked into. A group's value is read and written as a whole in every micro-batch
that has rows of it, so there should be groups enough for one to fit a task with ease, and few enough to have many customers each.
"""

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming.state import GroupState

#: Columns in which a row waits until its second is closed; the values that are looked for come after them.
WAITING = {"_at": pa.int64(), "_key": pa.string(), "_own": pa.string(), "_place": pa.string(), "_has": pa.bool_(), "_cents": pa.int64()}
#: Rows of a result that are handed to Spark together.
PART = 20_000
_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")
_LONG = 1 << 62


def _objects(values) -> np.ndarray:
    found = np.empty(len(values), dtype=object)
    found[:] = values
    return found


def _exact(values: np.ndarray) -> np.ndarray:
    """Whole numbers in a type in which all of them together can be added up."""
    return values if np.abs(values.astype(float)).sum() < _LONG else values.astype(object)


class Held:
    """The state of one group, in memory."""

    def __init__(self, firsts: int):
        self.keys, self.last = _objects([]), _objects([])
        self.code, self.second, self.n, self.a, self.c = (np.array([], dtype=np.int64) for _ in range(5))
        self.seen = [(np.array([], dtype=np.int64), _objects([])) for _ in range(firsts)]
        self.open: pd.DataFrame | None = None


class GroupHistory:
    """Features of each transaction of a group's customers, each customer's in the order of time and transaction."""

    def __init__(self, read: list[str], firsts: list[str], spans: list[tuple[int, bool]], groups: int):
        self.read, self.firsts, self.spans, self.groups = read, firsts, spans, groups
        self.values = [f"_first_{k}" for k in range(len(firsts))]
        self.waiting = WAITING | dict.fromkeys(self.values, pa.string())
        self.retention = max(span for span, _ in spans)

    # --- the value ----------------------------------------------------------------------------------

    def kept(self, held: Held) -> bytes:
        columns = {
            "keys": pa.array(held.keys, pa.string()), "last": pa.array(held.last, pa.string()),
            "code": pa.array(held.code, pa.int64()), "second": pa.array(held.second, pa.int64()),
            "n": pa.array(held.n, pa.int64()), "a": pa.array(held.a, pa.int64()),
            # a sum may be beyond a long
            "high": pa.array(held.c >> 32, pa.int64()), "low": pa.array(held.c & 0xFFFFFFFF, pa.int64()),
        }
        for k, (code, value) in enumerate(held.seen):
            columns |= {f"seen_code_{k}": pa.array(code, pa.int64()), f"seen_{k}": pa.array(value, pa.string())}
        if held.open is not None and len(held.open):
            columns |= {name: pa.array(held.open[name].to_numpy(), kind) for name, kind in self.waiting.items()}
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in columns.values()]
        schema = pa.schema([pa.field(n, v.type) for n, v in zip(columns, lists, strict=True)], metadata={"groups": str(self.groups)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=_ZSTD) as out:
            out.write_batch(pa.record_batch(lists, schema=schema))
        return sink.getvalue().to_pybytes()

    def restore(self, kept: bytes | None) -> Held:
        held = Held(len(self.firsts))
        if kept is None:
            return held
        batch = pa.ipc.open_stream(bytes(kept)).read_next_batch()
        groups = int(batch.schema.metadata[b"groups"])
        if groups != self.groups:
            raise ValueError(f"the checkpoint has customers in {groups} groups, not {self.groups}")
        column = lambda name: batch.column(name).flatten().to_numpy(zero_copy_only=False)
        held.keys, held.last = column("keys"), _objects(column("last"))
        held.code, held.second, held.n, held.a = (column(name) for name in ("code", "second", "n", "a"))
        high, low = column("high"), column("low")
        wide = len(high) > 0 and np.abs(high).max() >= 1 << 30
        held.c = (high.astype(object) if wide else high) * (1 << 32) + low
        held.seen = [(column(f"seen_code_{k}"), column(f"seen_{k}")) for k in range(len(self.firsts))]
        if "_at" in batch.schema.names:
            held.open = pd.DataFrame({name: column(name) for name in self.waiting})
        return held

    # --- a micro-batch ------------------------------------------------------------------------------

    def run(self, key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = self.restore(state.get[0] if state.exists else None)
        watermark = state.getCurrentWatermarkMs()
        rows = None if state.hasTimedOut else pd.concat(list(frames), ignore_index=True)
        for found in self.advanced(held, rows, watermark):
            for at in range(0, len(found), PART):
                yield found.iloc[at:at + PART]
        state.update((self.kept(held),))
        following = self.next_time(held)
        if following is not None:
            state.setTimeoutTimestamp(max(following, watermark))

    def advanced(self, held: Held, rows: pd.DataFrame | None, watermark: int) -> Iterator[pd.DataFrame]:
        """Take up rows; those without a time are handed on, and those of seconds that the watermark, in ms, has closed."""
        until = watermark // 1000  # seconds before it are closed
        if rows is not None and len(rows):
            timed = rows["_timed"].to_numpy(dtype=bool)
            if not timed.all():
                yield self._untimed(rows[~timed])
            arrived = rows.loc[timed, list(self.waiting)]
            held.open = arrived if held.open is None else pd.concat([held.open, arrived], ignore_index=True)
        if held.open is not None and len(held.open):
            closed = held.open["_at"].to_numpy() < until
            if closed.any():
                ready, held.open = held.open[closed], held.open[~closed]
                yield self._closed(held, ready)
        still = held.second >= until - self.retention
        if not still.all():
            held.code, held.second, held.n, held.a, held.c = (v[still] for v in (held.code, held.second, held.n, held.a, held.c))

    def next_time(self, held: Held) -> int | None:
        """The watermark in ms that must be passed before there is something to do without further rows."""
        if held.open is not None and len(held.open):
            return (int(held.open["_at"].min()) + 1) * 1000 - 1
        return (int(held.second.max()) + self.retention + 1) * 1000 - 1 if len(held.second) else None

    def _untimed(self, rows: pd.DataFrame) -> pd.DataFrame:
        none = np.full(len(rows), np.nan)
        return self._made(rows["_own"].to_numpy(), _objects([None] * len(rows)), np.zeros(len(rows), dtype=np.int64), none,
                          np.zeros(len(rows), dtype=np.int64), none, [np.zeros(len(rows), dtype=bool) for _ in self.firsts])

    def _made(self, own, before, day, amount, amounts, total, firsts) -> pd.DataFrame:
        return pd.DataFrame({
            "_own": own, "_before": before, "transactions_last_24h": day, "accumulated_amount_24h": amount,
            "_month_amounts": amounts, "_month_sum": total, **dict(zip(self.firsts, firsts, strict=True))})

    def _ordered(self, code: np.ndarray, rows: pd.DataFrame) -> np.ndarray:
        """Places of rows by customer, time, transaction and all other values, nulls first. Texts are only looked into where
        rows share customer and second."""
        at = rows["_at"].to_numpy()
        order = np.lexsort((at, code))
        same = (code[order][1:] == code[order][:-1]) & (at[order][1:] == at[order][:-1])
        if not same.any():
            return order
        own, cents, has = (rows[c].to_numpy() for c in ("_own", "_cents", "_has"))

        def place(row: int) -> tuple:
            values = json.loads(own[row])
            found = [values.get(name) for name in self.read]
            return (*[(v is not None, isinstance(v, str), v) for v in found], has[row], cents[row], own[row])

        begins = np.flatnonzero(np.r_[True, ~same])
        ends = np.r_[begins[1:], len(order)]
        for begin, end in zip(begins[ends - begins > 1], ends[ends - begins > 1], strict=True):
            order[begin:end] = sorted(order[begin:end], key=place)
        return order

    def _closed(self, held: Held, rows: pd.DataFrame) -> pd.DataFrame:
        known = len(held.keys)
        codes, keys = pd.factorize(np.concatenate([held.keys, rows["_key"].to_numpy()]))
        order = self._ordered(codes[known:], rows)
        code, rows = codes[known:][order].astype(np.int64), rows.iloc[order]
        last = np.concatenate([held.last, _objects([None] * (len(keys) - known))])
        held.keys = _objects(keys)

        place = rows["_place"].to_numpy()
        new_key = np.r_[True, code[1:] != code[:-1]]
        before = np.concatenate([_objects([None]), place[:-1]])
        before[new_key] = last[code[new_key]]
        end = np.r_[new_key[1:], True]
        last[code[end]] = place[end]
        held.last = last

        day, month = self._summed(held, code, rows)
        found = [self._seen(held, k, code, rows[name].to_numpy()) for k, name in enumerate(self.values)]
        return self._made(
            rows["_own"].to_numpy(), before, day[0].astype(np.int64), np.where(day[1] > 0, (day[2] / 100.0).astype(float), np.nan),
            month[1].astype(np.int64), (month[2] / 100.0).astype(float), found)

    def _summed(self, held: Held, code: np.ndarray, rows: pd.DataFrame) -> list[list[np.ndarray]]:
        """Rows, amounts and cents of each span as every row sees them."""
        at, has, cents = rows["_at"].to_numpy(), rows["_has"].to_numpy(dtype=np.int64), rows["_cents"].to_numpy()
        begins = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (at[1:] != at[:-1])])
        sizes = np.diff(np.r_[begins, len(code)])
        cents = _exact(np.concatenate([held.c, cents]))[len(held.c):]
        own_code, own_at = code[begins], at[begins]
        all_code, all_at = np.concatenate([held.code, own_code]), np.concatenate([held.second, own_at])
        order = np.lexsort((all_at, all_code))
        held.code, held.second = all_code[order], all_at[order]
        held.n = np.concatenate([held.n, sizes])[order]
        held.a = np.concatenate([held.a, np.add.reduceat(has, begins)])[order]
        held.c = np.concatenate([held.c.astype(cents.dtype), np.add.reduceat(cents, begins)])[order]

        # customer and second as one number; the seconds of a customer lie together
        low = int(held.second.min())
        width = int(held.second.max()) - low + 2
        kind = np.int64 if (int(held.code.max()) + 1) * width < _LONG else object
        line = held.code.astype(kind) * width + (held.second - low)
        own = own_code.astype(kind) * width
        upto = [np.concatenate([np.zeros(1, dtype=v.dtype), np.cumsum(v)]) for v in (held.n, held.a, held.c)]
        sums = []
        for span, now in self.spans:
            first = np.searchsorted(line, own + np.maximum(own_at - span - low, 0), "left")
            after = np.searchsorted(line, own + (own_at - low), "right" if now else "left")
            sums.append([np.repeat(v[after] - v[first], sizes) for v in upto])
        return sums

    def _seen(self, held: Held, k: int, code: np.ndarray, values: np.ndarray) -> np.ndarray:
        """For each row whether it is the first of its customer with its value."""
        seen_code, seen = held.seen[k]
        value, different = pd.factorize(np.concatenate([seen, values]))
        pair = np.concatenate([seen_code, code]) * (len(different) + 1) + value
        first = ((value >= 0) & ~pd.Series(pair).duplicated().to_numpy())[len(seen):]
        held.seen[k] = np.concatenate([seen_code, code[first]]), np.concatenate([seen, values[first]])
        return first
