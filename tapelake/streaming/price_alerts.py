"""The price-alert detector on a stream, with its memory in the state store."""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tapelake.functions import fixedpoint as fp
from tapelake.operators.alerts import AlertRules, Baseline

_OUTPUT = (
    "symbol string, severity string, direction string, price double, baseline_price double, change double, us bigint"
)
_COLUMNS = ["symbol", "severity", "direction", "price", "baseline_price", "change", "us"]
_NEVER = -1
#: Trades are released by slots of so many seconds; alerts are late by one slot at most.
SLOT_SECONDS = 60
#: Lengths of the slots that trades wait in, in those: with 60 seconds 64 days, a day, an hour and a minute.
SPANS = (64 * 1440, 1440, 60, 1)
#: Trades of a symbol that are put into slots at once, and that a slot longer than the shortest takes.
HELD_ROWS = 100_000
#: Alerts of a symbol that are put out at once.
OUT_ROWS = 10_000


class AlertProcessor(StatefulProcessor):
    """Holds trades back until the watermark passes them, then feeds them to the detector in event-time order.

    Trades wait in slots of time, in the pieces in which they arrived: an arrival adds pieces and reads none. A trade goes
    into the longest slot that has not begun by the watermark and has room, so those far ahead of it, as when a stream
    catches up, share few slots, and those near it wait in the shortest. A timer stands at the earliest end of a short slot
    inside each slot; the first to expire releases all that the watermark has passed, slot by slot, and puts what is left
    of a longer slot into shorter ones. So a trade is moved three times at most, and a release costs what is due and
    one list of the slots held.
    """

    def __init__(self, rules: AlertRules, slot_seconds: int = SLOT_SECONDS, held_rows: int = HELD_ROWS):
        self.rules, self.held_rows = rules, held_rows
        self.lengths = [slot_seconds * 1_000_000 * n for n in SPANS]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", "price double, since_us bigint, alerted_us bigint")
        self.pieces = handle.getValueState(
            "pieces", "level array<int>, slot array<bigint>, pieces array<bigint>, rows array<bigint>"
        )
        self.waiting = handle.getMapState(
            "waiting",
            "level int, slot bigint, piece bigint",
            "us array<bigint>, trade_id array<string>, price array<double>",
        )

    def _held(self) -> dict[tuple[int, int], tuple[int, int]]:
        """Pieces and rows by level and slot."""
        if not self.pieces.exists():
            return {}
        return {(level, slot): (pieces, rows) for level, slot, pieces, rows in zip(*self.pieces.get())}

    def _hold(self, held: dict[tuple[int, int], tuple[int, int]]) -> None:
        if held:
            self.pieces.update(tuple(map(list, zip(*((*slot, *size) for slot, size in held.items())))))
        else:
            self.pieces.clear()

    def _passed(self, timer_values, at_ms: int | None = None) -> int | None:
        """The start of the shortest slot the watermark is in, in microseconds; what is before it is due."""
        now = at_ms if timer_values is None else timer_values.getCurrentWatermarkInMs()
        return None if now is None else now * 1000 // self.lengths[-1] * self.lengths[-1]

    def _place(self, us: np.ndarray, trade_id: np.ndarray, price: np.ndarray, held: dict, passed: int | None) -> None:
        """Add trades to the slots held; without a known watermark to the shortest."""
        shortest = len(self.lengths) - 1
        todo = [(shortest if passed is None else 0, np.arange(len(us)))] if len(us) else []
        while todo:
            level, at = todo.pop()
            length = self.lengths[level]
            slots = us[at] // length
            order = np.argsort(slots, kind="stable")
            for part in np.split(at[order], np.flatnonzero(np.diff(slots[order])) + 1):
                slot = int(us[part[0]] // length)
                pieces, rows = held.get((level, slot), (0, 0))
                if level < shortest and (slot * length < passed or rows + len(part) > self.held_rows):
                    todo.append((level + 1, part))
                    continue
                if not pieces:
                    self.handle.registerTimer((slot * length + self.lengths[-1]) // 1000)
                self.waiting.updateValue((level, slot, pieces), tuple(c[part].tolist() for c in (us, trade_id, price)))
                held[level, slot] = pieces + 1, rows + len(part)

    def _removed(self, level: int, slot: int, pieces: int) -> list[tuple[int, str, float]]:
        """The trades of a slot in order."""
        rows = []
        for piece in range(pieces):
            rows.extend(zip(*self.waiting.getValue((level, slot, piece))))
            self.waiting.removeKey((level, slot, piece))
        rows.sort(key=itemgetter(0, 1))
        return rows

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, passed, some = self._held(), self._passed(timerValues), []

        def place() -> None:
            batch = pd.concat(some)
            columns = batch["us"].to_numpy(np.int64), batch["trade_id"].to_numpy(object), batch["price"].to_numpy(np.float64)
            self._place(*columns, held, passed)
            some.clear()

        for batch in rows:
            some.append(batch)
            if sum(map(len, some)) >= self.held_rows:
                place()
        if some:
            place()
        self._hold(held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, passed = self._held(), self._passed(timerValues, expiredTimerInfo.getExpiryTimeInMs())
        due = sorted((slot * self.lengths[level], level, slot) for level, slot in held)
        due = due[: bisect_left(due, passed, key=itemgetter(0))]
        if not due:
            return
        state = Baseline()
        if self.memory.exists():
            price, since_us, alerted_us = self.memory.get()
            state = Baseline(price, since_us, None if alerted_us == _NEVER else alerted_us)
        # Ordered trades of the slots that are open at a time: at most one of each length, with how many are used up.
        runs, out = [], []

        def release(until: int) -> None:
            """Replay the trades of all runs before a time."""
            rows = []
            for run in runs:
                end = bisect_left(run[1], until, run[0], key=itemgetter(0))
                rows += run[1][run[0] : end]
                run[0] = end
            if len(runs) > 1:
                rows.sort(key=itemgetter(0, 1))
            us, price = np.array([row[0] for row in rows], np.int64), np.array([row[2] for row in rows], np.float64)
            for i, severity, base, change in state.replay(price, us, self.rules):
                out.append((key[0], severity, "UP" if price[i] > base else "DOWN", price[i], base, change, us[i]))

        for start, level, slot in due:
            release(start)
            runs = [run for run in runs if run[0] < len(run[1])]
            runs.append([0, self._removed(level, slot, held.pop((level, slot))[0])])
            if len(out) >= OUT_ROWS:
                yield pd.DataFrame(out, columns=_COLUMNS)
                out.clear()
        release(passed)
        rest = [row for run in runs for row in run[1][run[0] :]]
        if rest:
            us, trade_id, price = zip(*rest)
            self._place(np.array(us, np.int64), np.array(trade_id, object), np.array(price, np.float64), held, passed)
        self._hold(held)
        self.memory.update((state.price, state.since_us, _NEVER if state.alerted_us is None else state.alerted_us))
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS)

    def close(self) -> None:
        pass


def price_alert_stream(trades: DataFrame, rules: AlertRules = AlertRules()) -> DataFrame:
    """Alerts of a stream with a watermark on ``event_time``; needs the RocksDB state store."""
    keyed = trades.select("symbol", "trade_id", "price", F.unix_micros("event_time").alias("us"), "event_time")
    found = keyed.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=AlertProcessor(rules), outputStructType=_OUTPUT, outputMode="Append", timeMode="EventTime"
    )
    return found.select(
        "symbol",
        "severity",
        "direction",
        "price",
        "baseline_price",
        fp.round_half_up(F.col("change") * 100.0, 4).alias("pct_change"),
        F.timestamp_micros("us").alias("timestamp"),
        F.lit("price_movement").alias("alert_type"),
    )


# Executors need not have this package: the functions their tasks run are sent with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
