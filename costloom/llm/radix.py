"""Distributed LSD radix sort: final ranks of all rows by a composite key of integers, without a range sort.

The key's parts become digits of equal width, least significant first. Every pass is a stable counting sort on one digit:
rows lie in blocks of at most ``BLOCK`` rows of known order; counts per block and digit, summed up over the digits and then over
the blocks of a digit, give the place of the first row with a digit in a block, and a row's place is that plus the number
of rows with its digit before it in its block. The next pass cuts the new places into blocks again, all of them full but
the last, so no key, however frequent, makes a task larger. After the last pass places are ranks.

A pass shuffles the narrow rows once. Each is written to the shared checkpoint folder, so places stay what they are when an executor
is lost. The windows see one row per digit, and one row per block for each digit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from .common import checkpointed, fresh

BLOCK = 1 << 16
DIGIT_BITS = 12


def _digits(parts: list[tuple[Column, int]], width: int) -> list[Column]:
    """Digits of ``width`` bits of the composite key, least significant first. ``parts``: (value from 0 on, its bits),
    most significant first."""
    out, at = [], 0
    spans = []
    for value, bits in reversed(parts):
        spans.append((value, at, bits))
        at += bits
    for low in range(0, at, width):
        digit = F.lit(0).cast("long")
        for value, start, bits in spans:
            take_from, take_to = max(low, start), min(low + width, start + bits)
            if take_from < take_to:
                mask = (1 << (take_to - take_from)) - 1
                piece = F.shiftrightunsigned(value, take_from - start).bitwiseAND(F.lit(mask).cast("long"))
                digit = digit + F.shiftleft(piece, take_from - low)
        out.append(digit.cast("int"))
    return out


def _ranker(order: list[str], at: str, digit: str, start: str, schema: T.StructType):
    """Places of one block's rows, from the block's rows and the first place of each of its digits."""

    def run(rows, starts):
        import pyarrow as pa

        place, digits = rows[at].to_numpy(), rows[digit].to_numpy()
        by_place = np.argsort(place, kind="stable")
        digits = digits[by_place]
        counts = np.bincount(digits)
        sorted_ = np.argsort(digits, kind="stable")  # the counting sort of the block
        first = np.cumsum(counts) - counts
        within = np.empty(len(digits), np.int64)
        within[sorted_] = np.arange(len(digits)) - first[digits[sorted_]]
        base = np.zeros(len(counts), np.int64)
        base[starts[digit].to_numpy()] = starts[start].to_numpy()
        rows = rows.take(pa.array(by_place))
        return pa.table([*(rows[c] for c in order), pa.array(base[digits] + within)], schema=pa_schema(schema))

    def pa_schema(s):
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(s)

    return run


def ranked(rows: DataFrame, keys: list[str], descending: tuple[str, ...] = (), name: str = "rank", block: int = BLOCK,
           bits: int = DIGIT_BITS) -> DataFrame:
    """``rows`` with their rank from 1 on by the long columns ``keys``; nulls come last in either direction.

    Rows that are equal in all keys get ranks in the order in which they were written. Keys may span all of the
    long range: each is shifted by its least value, which one aggregate finds.
    """
    kept, held = rows.columns, list(rows.columns)
    at, group, digit, start, before = (held.append(n := fresh(f"__{c}", held)) or n for c in ("at", "block", "digit", "start", "before"))
    name = fresh(name, kept)
    rows = checkpointed(rows)
    bounds = rows.agg(*(f(c).alias(f"{i}{f.__name__}") for i, c in enumerate(keys) for f in (F.min, F.max)), F.count("*").alias("n")).first()
    parts = []
    for i, c in enumerate(keys):
        low, high = bounds[f"{i}min"], bounds[f"{i}max"]
        if low is None:
            continue
        span = high - low + 1  # the value of a null
        # Differences past the long range wrap around and are read as unsigned.
        wrap = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
        if span >= 1 << 64:
            parts.append((F.col(c).isNull().cast("long"), 1))
            null = 0
        else:
            null = wrap(span)
        plain = _minus(F.lit(high), F.col(c)) if c in descending else _minus(F.col(c), F.lit(low))
        parts.append((F.coalesce(plain, F.lit(null).cast("long")), min(64, span.bit_length())))
    total = sum(n for _, n in parts)
    passes = -(-total // bits)
    placed = rows.select(*kept, F.monotonically_increasing_id().alias(at))
    schema = T.StructType([*rows.schema.fields, T.StructField(at, T.LongType(), True)])
    if not passes:
        parts, passes, total = [(F.lit(0).cast("long"), 1)], 1, 1
    for value in _digits(parts, -(-total // passes)):
        dealt = placed.select(*kept, at, F.shiftrightunsigned(at, block.bit_length() - 1).alias(group), value.alias(digit))
        counts = dealt.groupBy(group, digit).agg(F.count("*").alias(before))
        counts = checkpointed(counts)
        sums = counts.groupBy(digit).agg(F.sum(before).alias(start)).select(
            digit, F.coalesce(F.sum(start).over(W.orderBy(digit).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(start))
        along = W.partitionBy(digit).orderBy(group).rowsBetween(W.unboundedPreceding, -1)
        starts = counts.select(group, digit, F.coalesce(F.sum(before).over(along), F.lit(0)).alias(before)).join(sums, digit).select(
            group, digit, (F.col(start) + F.col(before)).alias(start))
        fn = _ranker(kept, at, digit, start, schema)
        placed = checkpointed(dealt.groupBy(group).cogroup(starts.groupBy(group)).applyInArrow(fn, schema))
    return placed.select(*kept, (F.col(at) + 1).alias(name))


def _minus(a: Column, b: Column) -> Column:
    """``a - b`` of longs, wrapping round: both halves apart, as plain subtraction raises past the range."""
    low = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    a, b = a.cast("long"), b.cast("long")
    less = low(a) - low(b)
    high = low(F.shiftrightunsigned(a, 32)) - low(F.shiftrightunsigned(b, 32)) + F.shiftright(less, 32)
    return F.shiftleft(high, 32).bitwiseOR(low(less))
