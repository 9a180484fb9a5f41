"""Modification times out of server ETags."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType


_SECOND, _SINCE_1601 = 10_000_000, 11_644_473_600
#: Plausible times begin in 1996 and end a day after the capture, in seconds since 1970.
_FROM, _DAY = 820_454_400, 86_400
#: Up to here, in 2057, the two highest bytes of a plausible time are 1 and one of two digits.
_HIGH_BYTES = (1 << 57) // _SECOND - _SINCE_1601


def _plausible(digits: np.ndarray, length: int, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and their plausible ticks since 1970, of rows (columns of ``digits``) of one length, cut in every way."""
    rows, ticks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    highest = (1,) if (until < _HIGH_BYTES).all() else (1, 2)
    next_highest = (2,) if highest == (1,) else (1, 2)
    for way in product(*[(1, 2)] * 6, next_highest, highest):
        if sum(way) != length:
            continue
        at, fits, total = 0, np.ones(digits.shape[1], bool), np.zeros(digits.shape[1], np.uint64)
        for i, width in enumerate(way):
            byte = digits[at]
            if width == 2:
                fits &= byte != 0
                byte = (byte << np.uint64(4)) | digits[at + 1]
            total |= byte << np.uint64(8 * i)
            at += width
        fits &= total >= np.uint64((_FROM + _SINCE_1601) * _SECOND)
        since = total - np.uint64(_SINCE_1601 * _SECOND)
        seconds, rest = since // np.uint64(_SECOND), since % np.uint64(_SECOND)
        fits &= (seconds < until) | ((seconds == until) & (rest == 0))
        rows.append(np.flatnonzero(fits))
        ticks.append(since[fits])
    return np.concatenate(rows), np.concatenate(ticks)


def _ticks(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for codes, captures in batches:
        n = len(codes)
        lengths = pc.utf8_length(codes).fill_null(0).to_numpy(zero_copy_only=False)
        text = pc.utf8_rpad(codes.fill_null(""), 16, "0").cast(pa.large_string())
        chars = np.frombuffer("".join(text.to_pylist()).encode(), np.uint8).reshape(n, 16).T.astype(np.uint64)
        digits = np.where(chars > 57, chars - 87, chars - 48)
        known = captures.is_valid().to_numpy(zero_copy_only=False)
        until = np.maximum(captures.fill_null(-_DAY).to_numpy().astype(np.int64) + _DAY, 0).astype(np.uint64)
        rows, ticks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for length in range(8, 17):
            which = np.flatnonzero((lengths == length) & known)
            if len(which):
                found, held = _plausible(digits[:, which], length, until[which])
                rows.append(which[found])
                ticks.append(held)
        row, tick = np.concatenate(rows), np.concatenate(ticks)
        order = np.lexsort((tick, row))
        row, tick = row[order], tick[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (tick[1:] != tick[:-1])
        row, tick = row[first], tick[first]
        ends = np.searchsorted(row, np.arange(n + 1))
        parts = pa.StructArray.from_arrays([pa.array((tick // np.uint64(_SECOND)).astype(np.int64)), pa.array((tick % np.uint64(_SECOND)).astype(np.int32))], ["seconds", "ticks"])
        yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)


@F.arrow_udf(ArrayType(StructType().add("seconds", LongType()).add("ticks", IntegerType())))
def _plausible_times(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    yield from _ticks(batches)


def _with_times(rows: DataFrame) -> DataFrame:
    """Adds ``_times``, the plausible times in their order: whole seconds since 1970 and ticks of 100 ns."""
    code = F.lower(F.regexp_extract("etag", r'^(?:W/)?"?([0-9a-fA-F]{8,16}):', 1))
    return rows.withColumn("_times", _plausible_times(code, F.col("capture_seconds").cast("bigint")))


def etag_candidates(rows: DataFrame) -> DataFrame:
    """Adds ``candidates`` (sorted array of seconds since 1970, decimal) to rows of (etag, capture_seconds).

    The hexadecimal part is cut into eight bytes in every way: a byte takes one digit, or two if the first isn't 0. Times from
    1996 to a day after the capture are plausible. Each row is worked out where it is: nothing is joined or shuffled.
    """
    times = F.transform("_times", lambda t: (t["seconds"].cast("decimal(13,0)") + t["ticks"].cast("decimal(7,0)") * F.lit(Decimal("0.0000001"))).cast("decimal(20,7)"))
    return _with_times(rows).withColumn("candidates", F.coalesce(times, F.array().cast("array<decimal(20,7)>"))).drop("_times")


def precise_time(time):
    """ISO time with nine digits of seconds and ticks of 100 ns."""
    return F.concat(F.date_format(F.timestamp_seconds(time["seconds"]), "yyyy-MM-dd'T'HH:mm:ss."), F.rpad(F.lpad(time["ticks"].cast("string"), 7, "0"), 9, "0"), F.lit("Z"))


def exact_modification(rows: DataFrame) -> DataFrame:
    """``rows`` (etag, capture_seconds, modified_seconds, server) with modified_precise and modified_candidates (ISO times, sorted).

    With a modification time, candidates of the ETag in that second count; without one, all plausible ones, and only of servers
    that make such ETags. A single candidate is the time; of several, the first is it as well if its fraction ends in zeros as a whole
    second does, but only without a modification time.
    """
    with_times = _with_times(rows)
    dated = F.col("modified_seconds").isNotNull()
    fitting = F.filter(F.coalesce("_times", F.array().cast("array<struct<seconds:bigint,ticks:int>>")), lambda c: F.when(dated, c["seconds"] == F.col("modified_seconds")).otherwise(F.coalesce(F.lower("server").contains("microsoft-iis"), F.lit(False))))
    out = with_times.withColumn("candidates", F.transform(F.when(F.col("etag").isNotNull(), fitting), precise_time))
    several = F.size("candidates") > 1
    first = F.get("candidates", F.lit(0))
    exact = F.when(F.size("candidates") == 1, first).when(several & ~dated & first.endswith("0000000000Z"), first)
    return out.withColumns({"modified_precise": exact, "modified_candidates": F.when(several, F.col("candidates"))}).drop("candidates", "_times")
