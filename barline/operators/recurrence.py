"""EMA, MACD and Wilder RSI: recurrences over each symbol's bars, in blocks that run at once.

The state is a flat record of numbers, so batches and streams share it. Carry ``exact``
never rounds or resets it. Carry ``daily_rounded`` starts each landing date from the rounded
outputs of the calendar day before, or cold where there are none. ``blocks.scan`` spreads a
symbol's history over tasks and gives what one ordered pass gives, to the last bit.
"""

from __future__ import annotations

from functools import partial
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.operators.blocks import day_number, scan

EMAS = (7, 20, 12, 26)
SIGNAL = 9
RSI = 6
OUTPUTS = ["ema7", "ema20", "ema12", "ema26", "macd", "signal", "histogram", "rsi6", "rsi_ag", "rsi_al"]
PLACES = {"ema7": 4, "ema20": 4, "ema12": 2, "ema26": 2, "macd": 2, "signal": 2, "histogram": 2, "rsi6": 2, "rsi_ag": 6, "rsi_al": 6}

#: Numbers of an average: value (none before its seed), sum and count of the warm-up.
_AVERAGES = [*(f"ema{n}" for n in EMAS), "signal"]
STATE = [*(f"{a}_{x}" for a in _AVERAGES for x in ("value", "sum", "count")), "close", "ag", "al", "gains", "losses", "diffs"]


def empty_state() -> dict[str, float | None]:
    return {k: 0.0 if k.endswith(("_sum", "_count")) or k in ("gains", "losses", "diffs") else None for k in STATE}


def _average(s: dict, name: str, period: int, x: float) -> float | None:
    """SMA of the first ``period`` values, then ``(x - last) * 2 / (period + 1) + last``."""
    last = s[f"{name}_value"]
    if last is None:
        s[f"{name}_sum"] += x
        s[f"{name}_count"] += 1
        if s[f"{name}_count"] < period:
            return None
        value = s[f"{name}_sum"] / period
        s[f"{name}_sum"], s[f"{name}_count"] = 0.0, 0.0
    else:
        value = (x - last) * (2 / (period + 1)) + last
    s[f"{name}_value"] = value
    return value


def step(s: dict, close: float) -> dict[str, float | None]:
    """Moves the state ahead by one bar and returns its outputs, not rounded."""
    out: dict[str, float | None] = dict.fromkeys(OUTPUTS)
    for n in EMAS:
        out[f"ema{n}"] = _average(s, f"ema{n}", n, close)
    if out["ema12"] is not None and out["ema26"] is not None:
        out["macd"] = out["ema12"] - out["ema26"]
        out["signal"] = _average(s, "signal", SIGNAL, out["macd"])
        if out["signal"] is not None:
            out["histogram"] = out["macd"] - out["signal"]
    last, s["close"] = s["close"], close
    if last is None:
        return out
    gain, loss = max(close - last, 0.0), max(last - close, 0.0)
    if s["ag"] is None or s["al"] is None:
        s["gains"] += gain
        s["losses"] += loss
        s["diffs"] += 1
        if s["diffs"] < RSI:
            return out
        s["ag"], s["al"] = s["gains"] / RSI, s["losses"] / RSI
        s["gains"] = s["losses"] = s["diffs"] = 0.0
    else:
        s["ag"], s["al"] = (s["ag"] * (RSI - 1) + gain) / RSI, (s["al"] * (RSI - 1) + loss) / RSI
    out["rsi_ag"], out["rsi_al"] = s["ag"], s["al"]
    out["rsi6"] = 100.0 if s["al"] == 0 else 0.0 if s["ag"] == 0 else 100.0 - 100.0 / (1.0 + s["ag"] / s["al"])
    return out


def _total(start: float, x: list[float]) -> float:
    """Added one after the other, as ``step`` does; ``sum`` would carry what rounding loses."""
    for v in x:
        start += v
    return start


def _averaged(s: dict, name: str, period: int, x: np.ndarray) -> tuple[np.ndarray, int]:
    """``_average`` of each of ``x`` in turn, and the place of the first that has a value."""
    out, first, last = np.full(len(x), np.nan), 0, s[f"{name}_value"]
    if last is None:
        first = period - 1 - int(s[f"{name}_count"])
        seed = x[: first + 1].tolist()
        s[f"{name}_sum"], s[f"{name}_count"] = _total(s[f"{name}_sum"], seed), s[f"{name}_count"] + len(seed)
        if len(seed) <= first:
            return out, len(x)
        last = out[first] = s[f"{name}_sum"] / period
        s[f"{name}_sum"], s[f"{name}_count"] = 0.0, 0.0
    begun = len(x) and s[f"{name}_value"] is None
    k = 2 / (period + 1)
    values = list(accumulate(x[first + bool(begun) :].tolist(), lambda last, v: (v - last) * k + last, initial=float(last)))
    out[first + bool(begun) :] = values[1:]
    s[f"{name}_value"] = values[-1]
    return out, first


def _wilder(last: float, x: np.ndarray) -> list[float]:
    return list(accumulate(x.tolist(), lambda last, v: (last * (RSI - 1) + v) / RSI, initial=last))


def advance(s: dict, close: np.ndarray) -> dict[str, np.ndarray]:
    """``step`` for each close in turn, column by column: the same numbers, NaN for none."""
    n, out = len(close), {c: np.full(len(close), np.nan) for c in OUTPUTS}
    if not n:
        return out
    first = {}
    for p in EMAS:
        out[f"ema{p}"], first[p] = _averaged(s, f"ema{p}", p, close)
    at = max(first[12], first[26])
    out["macd"][at:] = out["ema12"][at:] - out["ema26"][at:]
    out["signal"][at:], _ = _averaged(s, "signal", SIGNAL, out["macd"][at:])
    out["histogram"] = out["macd"] - out["signal"]
    before, s["close"] = s["close"], float(close[-1])
    change = np.diff(close, prepend=np.nan if before is None else before)
    at = int(before is None)
    gain, loss = np.maximum(change, 0.0), np.maximum(-change, 0.0)
    ag, al = out["rsi_ag"], out["rsi_al"]
    if s["ag"] is None or s["al"] is None:
        end = at + RSI - int(s["diffs"])
        for k, x in (("gains", gain), ("losses", loss)):
            s[k] = _total(s[k], x[at:end].tolist())
        s["diffs"] += max(min(end, n) - at, 0)
        if end > n:
            return out
        ag[end - 1], al[end - 1] = s["gains"] / RSI, s["losses"] / RSI
        s["gains"] = s["losses"] = s["diffs"] = 0.0
        s["ag"], s["al"] = float(ag[end - 1]), float(al[end - 1])
        at = end
    for k, x, into in (("ag", gain, ag), ("al", loss, al)):
        values = _wilder(s[k], x[at:])
        into[at:], s[k] = values[1:], values[-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        rsi = np.where(al == 0, 100.0, np.where(ag == 0, 0.0, 100.0 - 100.0 / (1.0 + ag / al)))
    out["rsi6"] = np.where(np.isnan(ag), np.nan, rsi)
    return out


def half_up(x: float | None, places: int) -> float | None:
    return None if x is None else int(x * 10**places + 0.5) / 10**places


def _half_up(x: np.ndarray, places: int) -> np.ndarray:
    """``half_up`` of each; zero has no sign."""
    return np.trunc(x * 10**places + 0.5) / 10**places + 0.0


def next_day(last: dict[str, float | None] | None, close: float | None) -> dict[str, float | None]:
    """A day's first state: from the rounded outputs of the last bar of the day before, if there was one."""
    s = empty_state()
    if last is not None:
        for a in _AVERAGES:
            s[f"{a}_value"] = last[a]
        s["close"], s["ag"], s["al"] = close, last["rsi_ag"], last["rsi_al"]
    return s


#: What a day takes over from the one before, besides the close.
CARRIED = [*_AVERAGES, "rsi_ag", "rsi_al"]


class _Exact:
    """What ``scan`` carries through a symbol's bars."""

    def __init__(self, first: list[float | None] | None):
        self.s = dict(zip(STATE, first, strict=True)) if first else empty_state()

    def state(self) -> list[float | None]:
        return [self.s[k] for k in STATE]

    def run(self, close: np.ndarray, day: np.ndarray) -> dict[str, np.ndarray]:
        known = ~np.isnan(close)
        if known.all():
            return advance(self.s, close)
        out = {c: np.full(len(close), np.nan) for c in OUTPUTS}
        for c, x in advance(self.s, close[known]).items():
            out[c][known] = x
        return out


class _Daily:
    """The same where a day starts from rounded outputs; only these pass from day to day."""

    def __init__(self, first: list[float | None] | None):
        self.day, close, *carried = first or [None] * (2 + len(CARRIED))
        self.last = dict(zip(CARRIED, carried, strict=True)) if close is not None else None
        self.close = None if close is None or np.isnan(close) else close
        self.within = empty_state()

    def state(self) -> list[float | None]:
        return [self.day, self.close, *((self.last or {}).get(c) for c in CARRIED)]

    def run(self, close: np.ndarray, day: np.ndarray) -> dict[str, np.ndarray]:
        out = {c: np.full(len(close), np.nan) for c in OUTPUTS}
        edges = [0, *(np.flatnonzero(np.diff(day)) + 1).tolist(), len(close)] if len(close) else [0]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if day[lo] != self.day:
                follows = self.day is not None and day[lo] - self.day == 1
                self.within, self.day = next_day(self.last if follows else None, self.close), float(day[lo])
            known = lo + np.flatnonzero(~np.isnan(close[lo:hi]))
            if len(known):
                for c, x in advance(self.within, close[known]).items():
                    out[c][known] = _half_up(x, PLACES[c])
                self.close = float(close[known[-1]])
                self.last = {c: None if np.isnan(v := float(out[c][known[-1]])) else v for c in CARRIED}
        return out


class _Ema:
    """One average alone."""

    def __init__(self, first: list[float | None] | None, period: int):
        self.period, self.name = period, f"ema{period}"
        self.s = dict(zip(("x_value", "x_sum", "x_count"), first or (None, 0.0, 0.0), strict=True))

    def state(self) -> list[float | None]:
        return list(self.s.values())

    def run(self, close: np.ndarray, day: np.ndarray) -> dict[str, np.ndarray]:
        out, known = np.full(len(close), np.nan), ~np.isnan(close)
        out[known], _ = _averaged(self.s, "x", self.period, close[known])
        return {self.name: out}


def ema(bars: DataFrame, period: int, previous: DataFrame | None = None, value: str = "close_price", **sizes: int) -> DataFrame:
    """``bars`` with ema<period> of ``value``: null until ``period`` values are seen, then their mean, then smoothed.

    ``previous`` (symbol, prev_ema) gives a symbol a value to go on from; null or no row starts it cold.
    """
    if period < 1:
        raise ValueError("a period is 1 at least")
    first = None
    if previous is not None:
        first = previous.where("prev_ema is not null").select("symbol", F.array(F.col("prev_ema").cast("double"), F.lit(0.0), F.lit(0.0)).alias("first"))
    return scan(bars, partial(_Ema, period=period), [f"ema{period}"], value=value, first=first, **sizes)


def indicators(bars: DataFrame, carry: str = "exact", previous: DataFrame | None = None, **sizes) -> DataFrame:
    """``bars`` with OUTPUTS, in order of group_id (and day, for days) within each symbol.

    Blocks of bars run at once and are held against each other, see ``blocks.scan``, which also
    takes ``sizes``; jobs run when this is called. ``previous`` (symbol, landing_date and prev_
    columns of CARRIED and close_price; one row per symbol and day, as ``prev_day_state`` gives)
    holds what a day takes over; days then do not depend on each other, and nothing runs yet.
    """
    if carry not in ("exact", "daily_rounded"):
        raise ValueError(f"no such carry: {carry}")
    if previous is None:
        return scan(bars, _Exact, OUTPUTS, **sizes) if carry == "exact" else scan(bars, _Daily, OUTPUTS, by_day=True, **sizes)
    if carry != "daily_rounded":
        raise ValueError("only days take over stored outputs")
    given = [F.col(f"prev_{c}").cast("double") for c in ("close_price", *CARRIED)]
    told = previous.where(F.coalesce(*given).isNotNull())
    # a day whose stored close is null takes over nothing but its averages
    first = told.select("symbol", "landing_date", F.array((day_number() - 1).cast("double"), F.coalesce(given[0], F.lit(float("nan"))), *given[1:]).alias("first"))
    return scan(bars, _Daily, OUTPUTS, by_day=True, first=first)
