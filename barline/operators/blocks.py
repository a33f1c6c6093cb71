"""Recurrences over a symbol's bars in blocks that run at once, exact to the last bit.

A block is a span of slots, or of days. Each starts from a guess: the state that the last
bars of the block before it (its halo) lead to from nothing. As these recurrences forget,
that is mostly the true state, bit for bit. Each block tells the state that it started from
and the one that it ended with. Where a block did not start with what the block before it
ended with, it runs again from there, together with those after it that failed too. When all
ends meet, every block has run from the true state, so rows equal those of one ordered pass.
After ROUNDS rounds, what is left of a symbol from its first failed block on runs as one.

A task streams through its blocks in Arrow batches. Between rounds only the blocks that run
again move. States are one row a block; a window over these is the only work by symbol alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.plans import storage

#: Slots of a block, and of the halo before it.
SPAN, HALO = 4096, 768
#: Days of a block, and of the halo before it.
SPAN_DAYS, HALO_DAYS = 32, 6
ROUNDS = 3

_UNIT = ["_unit", "_block", "_halo", "_first", "_day"]
_STATES = T.StructType([T.StructField("_block", T.LongType()), T.StructField("_start", T.ArrayType(T.DoubleType())), T.StructField("_end", T.ArrayType(T.DoubleType()))])


def day_number() -> Column:
    """A landing date's number; rows without one are a day of their own."""
    return F.coalesce(F.unix_date("landing_date"), F.lit(-1_000_000))


def _codes(x: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Numbers that are equal where neighbouring values are."""
    return x.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)


def _runner(carrier: Callable, names: list[str], outputs: list[str], value: str) -> Callable:
    """Units (runs of blocks), sorted, to their bars with outputs, and a row of states for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = symbol = block = start = carried = kinds = None
        states: list[tuple] = []

        def told() -> None:
            if block is not None:
                states.append((symbol, block, start, carried.state()))

        def state_rows() -> pa.RecordBatch:
            n = len(states)
            cols = [pa.array([s[0] for s in states], kinds[c]) if c == "symbol" else pa.nulls(n, kinds[c]) for c in names]
            cols += [pa.nulls(n, pa.float64()) for _ in outputs]
            cols += [pa.array([s[1] for s in states], pa.int64()), *(pa.array([s[k] for s in states], pa.list_(pa.float64())) for k in (2, 3))]
            states.clear()
            return pa.RecordBatch.from_arrays(cols, [*names, *outputs, "_block", "_start", "_end"])

        for b in batches:
            if not b.num_rows:
                continue
            kinds = {c: b.column(c).type for c in names}
            at, units, blocks, halo, day = _codes(b.column("symbol")), *(b.column(c).to_numpy(zero_copy_only=False) for c in ("_unit", "_block", "_halo", "_day"))
            x = b.column(value).cast(pa.float64()).to_numpy(zero_copy_only=False)
            new = np.ones(len(x), bool)
            new[1:] = (np.diff(at) != 0) | (np.diff(units) != 0) | (np.diff(blocks) != 0) | (halo[1:] != halo[:-1])
            edges = [*np.flatnonzero(new).tolist(), len(x)]
            out = {c: np.full(len(x), np.nan) for c in outputs}
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                here = (b.column("symbol")[lo].as_py(), int(units[lo]))
                if here != unit:
                    told()
                    unit, symbol, block = here, here[0], None
                    carried = carrier(b.column("_first")[lo].as_py())
                if not halo[lo] and block != blocks[lo]:
                    told()
                    block, start = int(blocks[lo]), carried.state()
                for c, v in carried.run(x[lo:hi], day[lo:hi]).items():
                    out[c][lo:hi] = v
            own = b.filter(pa.array(~halo))
            n, none = own.num_rows, pa.nulls(own.num_rows, pa.list_(pa.float64()))
            cols = [own.column(c) for c in names] + [pa.array(out[c][~halo], from_pandas=True) for c in outputs]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(blocks[~halo], pa.int64()), none, none], [*names, *outputs, "_block", "_start", "_end"]) if n else state_rows()
            if states:
                yield state_rows()
        told()
        if states:
            yield state_rows()

    return run


def scan(
    bars: DataFrame,
    carrier: Callable,
    outputs: list[str],
    value: str = "close_price",
    by_day: bool = False,
    first: DataFrame | None = None,
    span: int | None = None,
    halo: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """``bars`` with ``outputs`` of what ``carrier`` carries through each symbol's ``value``.

    ``carrier(first)`` makes the state from a list of numbers, or from nothing; its ``run(values,
    days)`` moves on, and ``state()`` tells it as such a list. ``first`` (symbol, first) gives the
    state to start a symbol from; with a landing_date, that of each symbol and day, and then no day
    follows from another. Tables between rounds are written below ``folder``, and the result reads them.
    """
    spark, names = bars.sparkSession, bars.columns
    size, tail = span or (SPAN_DAYS if by_day else SPAN), halo if halo is not None else (HALO_DAYS if by_day else HALO)
    order = ["_day", "group_id"] if by_day else ["group_id"]
    run = _runner(carrier, names, outputs, value)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in bars.schema.fields), *(T.StructField(c, T.DoubleType()) for c in outputs), *_STATES.fields])

    def ran(rows: DataFrame) -> DataFrame:
        rows = rows.select(*names, *_UNIT).repartition("symbol", "_unit").sortWithinPartitions("symbol", "_unit", *order)
        return rows.mapInArrow(run, schema)

    keyed = bars.withColumn("_day", day_number() if by_day else F.lit(0))
    never = F.lit(None).cast("array<double>")
    if first is not None and "landing_date" in first.columns:
        told = first.select("symbol", "landing_date", F.col("first").alias("_first"))
        days = keyed.join(told, ["symbol", "landing_date"], "left").withColumns({"_unit": F.col("_day").cast("long"), "_block": F.col("_day").cast("long"), "_halo": F.lit(False)})
        return ran(days).where("_start is null").select(*names, *outputs)

    folder = folder or storage.scratch(spark)
    place = F.col("_day") if by_day else F.coalesce("group_id", F.lit(0))
    block = F.floor(place / size).cast("long")
    own, next_ = F.struct(block.alias("b"), F.lit(False).alias("h")), F.struct((block + 1).alias("b"), F.lit(True).alias("h"))
    placed = keyed.withColumn("_at", F.explode(F.when(F.pmod(place, F.lit(size)) >= size - tail, F.array(own, next_)).otherwise(F.array(own))))
    placed = placed.withColumns({"_unit": F.col("_at.b"), "_block": F.col("_at.b"), "_halo": F.col("_at.h")})
    if first is None:
        placed = placed.withColumn("_first", never)
    else:
        placed = placed.join(first.select("symbol", F.col("first").alias("_first")), "symbol", "left")
    current = storage.stored(ran(placed), f"{folder}/0")
    one = Window.partitionBy("symbol").orderBy("_block")  # one row a block
    for n in range(1, ROUNDS + 1):
        states = current.where("_start is not null").select("symbol", "_block", F.col("_start"), F.lag("_end").over(one).alias("before"), F.row_number().over(one).alias("i"))
        wrong = states.where("before is not null and not (before <=> _start)")
        if wrong.isEmpty():
            break
        wrong = storage.stored(wrong, f"{folder}/wrong-{n}")
        if n < ROUNDS:  # runs of failed blocks
            island = wrong.withColumn("run", F.col("i") - F.row_number().over(one))
            again = island.withColumn("_unit", F.min("_block").over(Window.partitionBy("symbol", "run")))
            given = again.where("_block = _unit").select("symbol", "_unit", F.col("before").alias("_first"))
            again = again.select(F.col("symbol").alias("s"), F.col("_block").alias("k"), "_unit")
        else:
            given = wrong.groupBy("symbol").agg(F.min("_block").alias("_unit"), F.min_by("before", "_block").alias("_first"))
            again = states.select("symbol", "_block").join(given.select(F.col("symbol").alias("s"), "_unit"), F.col("symbol").eqNullSafe(F.col("s")) & (F.col("_block") >= F.col("_unit")))
            again = again.select("s", F.col("_block").alias("k"), "_unit")
        again = storage.stored(again, f"{folder}/again-{n}")
        here = F.col("symbol").eqNullSafe(F.col("s")) & (F.col("_block") == F.col("k"))
        rows = current.where("_start is null").join(again, here).withColumns({"_halo": F.lit(False), "_day": day_number() if by_day else F.lit(0)})
        rows = rows.join(given.select(F.col("symbol").alias("g"), F.col("_unit").alias("u"), "_first"), F.col("symbol").eqNullSafe(F.col("g")) & (F.col("_unit") == F.col("u")))
        done = storage.stored(ran(rows), f"{folder}/{n}")
        current = current.join(again.select("s", "k"), here, "left_anti").unionByName(done)
    return current.where("_start is null").select(*names, *outputs)
