"""Rolling moments over spans of time, in time that does not grow with the rows of a span.

Spark evaluates a sliding range anew for every row, which is quadratic where readings are dense. Here the rows of a task
pass once in order, with only those of the longest span kept. A frame of rows ``lo..hi`` is two runs that meet at a boundary
between aligned blocks: the end of one block and the beginning of the next. Running sums that start anew at every
boundary give both, for blocks of 1, 2, 4, ... rows. Nothing is subtracted that is not in the frame, so nothing cancels.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

# Rows that are worked on at a time, at least; more where a span holds more.
STEP = 1 << 16


def _runs(x: np.ndarray, d: np.ndarray, here: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Running sums of ``x`` and ``d`` and running squared deviations of ``d`` along the last axis."""
    n = np.cumsum(here, axis=1)
    s = np.cumsum(d, axis=1)
    mean = s / np.maximum(n, 1)
    before = np.zeros_like(mean)
    before[:, 1:] = mean[:, :-1]
    return np.cumsum(x, axis=1), s, np.cumsum(np.where(here, (d - before) * (d - mean), 0.0), axis=1)


def moments(x: np.ndarray, here: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, sum and squared deviations from the mean of the values ``lo..hi`` (both included) that are ``here``."""
    x = np.where(here, x, 0.0)
    upto = np.concatenate([[0], np.cumsum(here)])
    n = upto[hi + 1] - upto[lo]
    total, squares = x[hi].copy(), np.zeros(len(hi))
    squares[~np.isfinite(total)] = np.nan
    top = int((hi - lo).max(initial=0)).bit_length()
    level = np.minimum(np.frexp((lo ^ hi).astype(float))[1] - 1, top)  # of the boundary within the frame; -1 for a frame of one row
    # near each value one that is finite, so that deviations are small
    known = here & np.isfinite(x)
    near = x[np.maximum.accumulate(np.where(known, np.arange(len(x)), 0))]
    near = np.where(np.isfinite(near), near, 0.0)
    for k in range(top + 1):
        at = np.flatnonzero(level == k)
        if not len(at):
            continue
        size, blocks = 1 << k, -(-len(x) >> k)
        fill = blocks * size - len(x)
        v, there = np.pad(x, (0, fill)).reshape(blocks, size), np.pad(here, (0, fill)).reshape(blocks, size)
        centre = near[np.arange(blocks) * size]
        following = np.append(centre[1:], 0.0)
        with np.errstate(invalid="ignore"):
            first = _runs(v, np.where(there, v - centre[:, None], 0.0), there)
            second = _runs(v[:, ::-1], np.where(there, v - following[:, None], 0.0)[:, ::-1], there[:, ::-1])
            after, before = hi[at], lo[at]
            s1, d1, q1 = (r[:, ::-1].ravel()[before] for r in second)
            s2, d2, q2 = (r.ravel()[after] for r in first)
            middle = upto[(after >> k) << k]
            n1, n2 = middle - upto[before], upto[after + 1] - middle
            apart = d2 / np.maximum(n2, 1) - d1 / np.maximum(n1, 1)
            total[at] = s1 + s2
            squares[at] = q1 + q2 + np.where((n1 > 0) & (n2 > 0), apart * apart * (n1 * n2 / np.maximum(n1 + n2, 1)), 0.0)
    # a frame of one repeated value has deviation 0 whatever lies around it
    places = np.where(here, np.arange(len(x)), -1)
    earlier = np.concatenate([[-1], np.maximum.accumulate(places)[:-1]]) if len(x) else places
    changes = np.cumsum(here & ((earlier < 0) | (x != x[np.maximum(earlier, 0)])))
    coming = np.minimum.accumulate(np.where(here, np.arange(len(x)), len(x))[::-1])[::-1]
    start = np.minimum(coming[lo], hi)
    same = (changes[hi] == changes[start]) & np.isfinite(total)
    return n, total, np.where(same, 0.0, squares)


def spans(
    batches: Iterable[pa.RecordBatch], time: str, begins: str, made: Sequence[tuple[str, str, str, int]],
) -> Iterator[pa.RecordBatch]:
    """The same rows with the ``made`` columns (name, column, "mean" or "std", span in units of ``time``) in place of ``begins``.

    Rows come in the order of ``time`` within groups; ``begins`` marks the first row of each. A frame ends with the last row of the
    same time and begins just after the time a span ago. Rows without a time are frames of their own.
    """
    widest = max(span for *_, span in made)
    names = list(dict.fromkeys(column for _, column, _, _ in made))
    tail = (np.empty(0, np.int64), {c: (np.empty(0), np.empty(0, bool)) for c in names})
    waiting: list[tuple[np.ndarray, pa.RecordBatch]] = []
    last: int | None = None
    held, need = 0, STEP

    def gaps(batch: pa.RecordBatch) -> np.ndarray:
        """Time since the row before, no more than just out of reach."""
        nonlocal last
        # rows without a time come first
        at = batch.column(time).fill_null(-(1 << 62)).to_numpy(zero_copy_only=False)
        before = np.concatenate([[at[0] if last is None else last], at[:-1]])
        last = int(at[-1])
        apart = np.where((at > -(1 << 62)) & (before == -(1 << 62)), widest + 1, np.minimum(at - np.where(before == -(1 << 62), at, before), widest + 1))
        return np.where(batch.column(begins).to_numpy(zero_copy_only=False), widest + 1, apart)

    def work(ends: bool) -> Iterator[pa.RecordBatch]:
        nonlocal tail, waiting, held, need
        rows = pa.Table.from_batches([b for _, b in waiting])
        gap, old = tail
        m = len(gap)
        gap = np.concatenate([gap, *[g for g, _ in waiting]])
        at = np.cumsum(gap)
        done = len(at) if ends else max(m, int(np.searchsorted(at, at[-1], "left")))
        own = at[m:done]
        hi = np.searchsorted(at, own, "right") - 1
        lows = {span: np.searchsorted(at, own - span, "right") for span in {s for *_, s in made}}
        kept = int(np.searchsorted(at, at[-1] - widest, "right"))
        out, values = {}, {}
        for c in names:
            column = rows.column(c).combine_chunks().cast(pa.float64())
            here = np.concatenate([old[c][1], column.is_valid().to_numpy(zero_copy_only=False)])
            x = np.concatenate([old[c][0], column.fill_null(0.0).to_numpy(zero_copy_only=False)])
            values[c] = (x[kept:done], here[kept:done])
            for span, lo in lows.items():
                wanted = [(name, stat) for name, source, stat, s in made if source == c and s == span]
                if not wanted or done == m:
                    continue
                n, total, squares = moments(x, here, lo, hi)
                for name, stat in wanted:
                    if stat == "mean":
                        out[name] = pa.array(total / np.maximum(n, 1), mask=n < 1)
                    else:
                        out[name] = pa.array(np.sqrt(squares / np.maximum(n - 1, 1)), mask=n < 2)
        if done > m:
            ready = rows.slice(0, done - m).drop_columns([begins])
            for name, *_ in made:
                ready = ready.append_column(name, out[name])
            yield from ready.combine_chunks().to_batches(max_chunksize=10_000)
        tail = (gap[kept:done], values)
        rest = rows.slice(done - m).combine_chunks().to_batches()
        waiting = [(gap[done:], rest[0])] if rest and rest[0].num_rows else []
        held = len(at) - done
        need = max(STEP, len(tail[0]), 2 * held)

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append((gaps(batch), batch))
        held += batch.num_rows
        if held >= need:
            yield from work(False)
    if waiting:
        yield from work(True)
