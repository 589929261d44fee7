"""Moving medians over wide windows: a sorted window slides over the rows of each key, as Arrow batches bring them.

A row costs a search in the window and a shift of part of it, where lags and leads would cost a column for each of its places.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_medians(values: Sequence[int | None], lo: int, hi: int, before: int, after: int) -> list[int | None]:
    """Medians of the windows from `before` places before to `after` places after each place in lo..hi; nulls are left out.

    Of an even count the mean of the middle two, cut to an integer; of none null.
    """
    first, past = max(0, lo - before), min(len(values), lo + after)
    window = sorted(v for v in values[first:past] if v is not None)
    out: list[int | None] = []
    for i in range(lo, hi):
        if i + after < len(values) and values[i + after] is not None:
            insort(window, values[i + after])
        gone = values[i - before - 1] if i - before - 1 >= first else None
        if gone is not None:
            del window[bisect_left(window, gone)]
        n = len(window)
        if n == 0:
            out.append(None)
        elif n % 2:
            out.append(window[n // 2])
        else:
            total = window[n // 2 - 1] + window[n // 2]
            out.append(total // 2 if total >= 0 else -(-total // 2))
    return out


def wide_median(df: DataFrame, value: str, *, by: str, order: list[str], size: int) -> DataFrame:
    """df with `value` replaced by the median of the `size` values around it (fewer at the ends) in order, for each key.

    The same as median.median_filter, for windows too wide for lags. Rows are sorted by key and order; a task keeps
    the rows that wait for those after them and as many before, `size` together. Null keys are one key.
    """
    before, after = size // 2, size - size // 2 - 1
    names, kind = df.columns, pa.int64()
    at = names.index(value)

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, 0  # rows of the last key that may still be looked at; of these so many have gone out

        def finish(table: pa.Table, done: int, last: bool) -> tuple[list[pa.RecordBatch], pa.Table, int]:
            keys = table.column("_key").combine_chunks()
            n = table.num_rows
            same = pc.fill_null(pc.equal(keys[1:], keys[:-1]), False).to_numpy(zero_copy_only=False) | (pc.is_null(keys[1:]).to_numpy(zero_copy_only=False) & pc.is_null(keys[:-1]).to_numpy(zero_copy_only=False))
            starts = [0, *[i + 1 for i, x in enumerate(same) if not x], n]
            values, out, keep = table.column(value).to_pylist(), [], n
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                lo = done if a == 0 else 0
                hi = b - a if last or b < n else max(lo, b - a - after)
                found = sliding_medians(values[a:b], lo, hi, before, after)
                if found:
                    rows = table.slice(a + lo, hi - lo).select(names).set_column(at, value, pa.array(found, kind))
                    out += rows.combine_chunks().to_batches()
                if b == n:
                    keep = a + max(0, hi - before)
                    done = hi - max(0, hi - before)
            return out, table.slice(keep), done

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                table = pa.concat_tables([held, table]).combine_chunks() if held is not None and held.num_rows else table
                out, held, done = finish(table, done, False)
                yield from out
        if held is not None and held.num_rows:
            yield from finish(held, done, True)[0]

    schema = df.withColumn(value, F.col(value).cast("long")).schema
    keyed = df.select(*[F.col(c).cast("long").alias(c) if c == value else F.col(c) for c in names], F.col(by).alias("_key"))
    return keyed.repartition("_key").sortWithinPartitions("_key", *order).mapInArrow(slide, schema)
