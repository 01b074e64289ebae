"""Price alerts: moves of a symbol away from its baseline, by event time."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.session import scratch_folder


@dataclass(frozen=True)
class AlertRules:
    """Fixed values of the detector: baseline life and cooldown in seconds, tiers as fractions."""

    baseline_seconds: float = 300.0
    cooldown_seconds: float = 60.0
    medium: float = 0.02
    high: float = 0.05
    critical: float = 0.10

    def severity(self, change: float) -> str | None:
        if change >= self.critical:
            return "CRITICAL"
        if change >= self.high:
            return "HIGH"
        return "MEDIUM" if change >= self.medium else None

    @property
    def quiet_seconds(self) -> float:
        """A silence longer than this always ends in a reset that no earlier trade can influence."""
        return max(self.baseline_seconds, self.cooldown_seconds)


@dataclass
class Baseline:
    """What one symbol remembers: the price moves are measured from, since when, and the last alert."""

    price: float | None = None
    since_us: int = 0
    alerted_us: int | None = None

    def observe(self, price: float, at_us: int, rules: AlertRules) -> tuple[str, float, float] | None:
        """Take the next trade; an alert is (severity, baseline price, fractional change)."""
        if self.price is None or at_us - self.since_us > rules.baseline_seconds * 1e6:
            self.price, self.since_us = price, at_us
            return None
        if self.price == 0:
            self.price = price
            return None
        change = abs(price - self.price) / self.price
        severity = rules.severity(change)
        if severity is None:
            return None
        if self.alerted_us is not None and at_us - self.alerted_us < rules.cooldown_seconds * 1e6:
            return None
        base = self.price
        self.price, self.since_us, self.alerted_us = price, at_us, at_us
        return severity, base, change


    def replay(self, price: np.ndarray, at_us: np.ndarray, rules: AlertRules) -> list[tuple[int, str, float, float]]:
        """``observe`` over a run of trades, as (position, alert).

        Trades that change nothing are skipped in blocks once a baseline has held for a few of them: between two
        changes there is nothing to remember, so the next change is a search.
        """
        out, i, n, held = [], 0, len(price), 0
        prices, times = price.tolist(), at_us.tolist()
        life, pause = rules.baseline_seconds * 1e6, rules.cooldown_seconds * 1e6
        while i < n:
            if held >= _PATIENCE and self.price:
                end = int(np.searchsorted(at_us, self.since_us + life, side="right"))
                if self.alerted_us is not None:
                    i = max(i, int(np.searchsorted(at_us, self.alerted_us + pause, side="left")))
                i, block = min(i, end), 2 * _PATIENCE
                while i < end:
                    moved = np.abs(price[i : min(i + block, end)] - self.price) / self.price >= rules.medium
                    if moved.any():
                        i += int(moved.argmax())
                        break
                    i, block = min(i + block, end), block * 2
                if i >= n:
                    break
            before = self.since_us, self.price
            alert = self.observe(prices[i], times[i], rules)
            held = held + 1 if (self.since_us, self.price) == before else 0
            if alert is not None:
                out.append((i, *alert))
            i += 1
        return out


# Trades a baseline has to hold for before the next change is searched for in blocks.
_PATIENCE = 32

# Baseline lives in a block, and those before it that are replayed to guess its state.
LIVES, WARM = 24, 3


def with_segments(trades: DataFrame, gap_seconds: float) -> DataFrame:
    """Number stretches of trading of each symbol (``us`` is the time in microseconds).

    A stretch ends where an hour's first trade follows a silence longer than ``gap_seconds``. Only the first and last
    trade of each hour are looked at, so the trades themselves are neither sorted nor ranked.
    """
    hour = F.floor(F.col("us") / F.lit(3_600_000_000)).cast("bigint")
    rows = trades.withColumn("_hour", hour)
    along = Window.partitionBy("symbol").orderBy("_hour")
    hours = (
        rows.groupBy("symbol", "_hour")
        .agg(F.min("us").alias("_first"), F.max("us").alias("_last"))
        .withColumn("_silence", F.col("_first") - F.lag("_last").over(along))
        .withColumn("_starts", F.coalesce(F.col("_silence") > F.lit(int(gap_seconds * 1e6)), F.lit(True)).cast("bigint"))
        .select("symbol", "_hour", F.sum("_starts").over(along).alias("segment"))
    )
    return rows.join(hours, ["symbol", "_hour"]).drop("_hour")


def _blocks(rows: DataFrame, rules: AlertRules, lives: int, warm: int) -> DataFrame:
    """Cut stretches into blocks of time; a block also gets the trades just before it, to guess the state it starts in."""
    life = int(rules.quiet_seconds * 1e6)
    length = lives * life
    block = F.expr(f"(us - pmod(us, {length})) div {length}")
    late = F.pmod("us", F.lit(length)) >= length - warm * life
    both = F.array(F.struct(block.alias("block"), F.lit(False).alias("warm")), F.struct((block + 1).alias("block"), F.lit(True).alias("warm")))
    own = F.array(both[0])
    cut = rows.withColumn("at", F.explode(F.when(late, both).otherwise(own)))
    return cut.select("symbol", "segment", "at.block", "at.warm", "price", "us", "trade_id")


def _settled(state: Baseline, at_us: int, rules: AlertRules) -> tuple[float | None, int | None, int | None]:
    """What of a state can still matter to a trade at ``at_us`` or later."""
    price, since = state.price, state.since_us
    if price is None or at_us - since > rules.baseline_seconds * 1e6:
        price, since = None, None
    alerted = state.alerted_us
    if alerted is not None and at_us - alerted >= rules.cooldown_seconds * 1e6:
        alerted = None
    return price, since, alerted


_STATE = [f"{end}_{c}" for end in ("entry", "exit") for c in ("price", "since", "alerted")]
_KEY = ["symbol", "segment", "block"]
_ALERT = ["severity", "direction", "price", "baseline_price", "change"]
_REPLAY_SCHEMA = (
    "symbol string, segment bigint, block bigint, us bigint, severity string, direction string, price double, "
    "baseline_price double, change double, entry_price double, entry_since bigint, entry_alerted bigint, "
    "exit_price double, exit_since bigint, exit_alerted bigint"
)


def _replayed(rows: DataFrame, rules: AlertRules) -> DataFrame:
    """Alerts of each block, and one row without a severity that says in which state it started and ended.

    Rows carry the state a block starts in, or none: then its warm rows, or nothing, come first.
    """

    def frame(found: list[tuple]) -> pd.DataFrame:
        names = [*_KEY, "us", *_ALERT, *_STATE]
        whole = ["segment", "block", "us", *[c for c in _STATE if not c.endswith("price")]]
        return pd.DataFrame(found, columns=names, dtype=object).astype(dict.fromkeys(whole, "Int64"))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, entry, first = None, Baseline(), None, None

        def ended() -> list[tuple]:
            if first is None:
                return []  # a block with warm rows only
            return [(*key, first, *(None,) * 5, *entry, state.price, state.since_us, state.alerted_us)]

        for batch in batches:
            keys = [batch[c].to_numpy() for c in _KEY]
            warm, price, us = (batch[c].to_numpy() for c in ("warm", "price", "us"))
            parts = [*keys, warm]
            new = np.any([c[1:] != c[:-1] for c in parts], axis=0)
            cuts = [0, *(np.flatnonzero(new) + 1), len(batch)]
            out = []
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                now = tuple(c[start] for c in keys)
                if now != key:
                    out += ended() if key is not None else []
                    key, state, entry, first = now, Baseline(), None, None
                    given = batch.iloc[start][["entry_price", "entry_since", "entry_alerted"]]
                    if not given.isna().all():
                        base, since, alerted = (None if pd.isna(x) else x for x in given)
                        state = Baseline(base, 0 if since is None else int(since), None if alerted is None else int(alerted))
                if first is None and not warm[start]:
                    first, entry = us[start], _settled(state, us[start], rules)
                for i, severity, base, change in state.replay(price[start:stop], us[start:stop], rules):
                    if not warm[start]:
                        p = price[start + i]
                        out.append((*key, us[start + i], severity, "UP" if p > base else "DOWN", p, base, change, *(None,) * 6))
            yield frame(out)
        if key is not None:
            yield frame(ended())

    ordered = rows.repartition(*_KEY).sortWithinPartitions(*_KEY, F.desc("warm"), "us", "trade_id").drop("trade_id")
    return ordered.mapInPandas(fold, _REPLAY_SCHEMA)


def _misjudged(found: DataFrame, rules: AlertRules) -> DataFrame:
    """Blocks that did not start as the block before them ended, with the state they start in."""
    along = Window.partitionBy("symbol", "segment").orderBy("block")
    states = found.filter("severity is null").withColumn("earlier", F.lag(F.struct("exit_price", "exit_since", "exit_alerted")).over(along))
    old = F.col("us") - F.col("earlier.exit_since") > F.lit(rules.baseline_seconds * 1e6)
    cool = F.col("us") - F.col("earlier.exit_alerted") >= F.lit(rules.cooldown_seconds * 1e6)
    true = states.select(
        *_KEY,
        *[F.col(c).alias(f"was_{c}") for c in _STATE[:3]],
        F.when(~old, F.col("earlier.exit_price")).alias("entry_price"),
        F.when(~old & F.col("earlier.exit_price").isNotNull(), F.col("earlier.exit_since")).alias("entry_since"),
        F.when(~cool, F.col("earlier.exit_alerted")).alias("entry_alerted"),
        F.col("earlier").isNotNull().alias("follows"),
    )
    same = F.lit(True)
    for c in _STATE[:3]:
        same = same & F.col(c).eqNullSafe(F.col(f"was_{c}"))
    return true.filter(F.col("follows") & ~same).select(*_KEY, *_STATE[:3])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def price_alerts(trades: DataFrame, rules: AlertRules = AlertRules(), lives: int = LIVES, warm: int = WARM) -> DataFrame:
    """Replay trades in event-time order and return the alerts.

    The detector's memory makes a symbol sequential inside a stretch of trading. Stretches are cut into blocks of ``lives``
    baseline lives that are replayed side by side, each from the state that a replay of the ``warm`` lives before it ends
    in. That guess is mostly right, since replays from different states meet at their first common alert or reset. Then
    the chain is checked: a block that did not start as the block before it ended is replayed from that end, until every
    block starts where the last one stopped. So the result is that of one replay, whatever was guessed. Blocks are
    written to the shared scratch folder in between, as the checks need them.
    """
    rows = trades.select("symbol", "trade_id", "price", F.unix_micros("timestamp").alias("us"))
    rows = _blocks(with_segments(rows, rules.quiet_seconds), rules, lives, warm)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in zip(_STATE, ("double", "bigint", "bigint"))]
    found = _written(_replayed(rows.select("*", *nothing), rules), "alert-blocks")
    while True:
        wrong = _written(_misjudged(found, rules), "alert-starts")
        if wrong.isEmpty():
            break
        again = _replayed(rows.filter("not warm").join(wrong, _KEY), rules)
        found = _written(found.join(wrong.select(*_KEY), _KEY, "left_anti").unionByName(again), "alert-blocks")
    return found.filter("severity is not null").select(
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
