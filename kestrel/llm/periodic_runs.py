"""Periodic runs of words, by recursive frequency splitting and lag scans.

A run of period q is a stretch of words in which words q apart are equal and q is the least
such number; it qualifies with at least ``MIN_LENGTH`` words and ``MIN_PERIODS`` periods. Every
word of a qualifying run stands in it ``MIN_PERIODS`` times at least, so a word that occurs less
often within a segment is in none of its runs and splits it. The pieces are split again by
their own counts until nothing changes (the largest piece takes over the counts of its
segment, less those of what was cut off, so the work is n log^2 n however deep this goes).

Surviving segments are scanned lag by lag. Below ``SHORT_LAG`` all words are compared with
those a lag apart. From there on windows of q words are compared by hash at every q-th word: a
run of three periods covers two whole neighbouring windows, so a lag costs m / q steps and all
lags m log m. Every hit is extended word by word; no run rests on a hash.

Words are dictionary codes of Arrow arrays: Python touches no word. Every document is worked
on where it lies, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 24
MIN_PERIODS = 3
SHORT_LAG = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: powers never vanish modulo 2^64


def segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [lo, hi) in which every word occurs ``MIN_PERIODS`` times or more: outside of
    them lies no word of a qualifying run."""
    n = len(codes)
    if n < MIN_LENGTH:
        return []
    codes = codes.astype(np.int64)
    places = np.sort(codes * n + np.arange(n))  # the positions of each word, in order
    out, todo = [], [(0, n)]
    while todo:
        lo, hi = todo.pop()
        size = hi - lo
        words, which, counts = np.unique(codes[lo:hi], return_inverse=True, return_counts=True)
        cuts = lo + np.flatnonzero(counts[which] < MIN_PERIODS)
        while len(cuts):
            ends = np.concatenate([cuts, [hi]])
            begins = np.concatenate([[lo], cuts + 1])
            long = np.flatnonzero(ends - begins >= MIN_LENGTH)
            if not len(long):
                lo = hi
                break
            big = long[np.argmax((ends - begins)[long])]
            todo += [(int(begins[i]), int(ends[i])) for i in long if i != big]
            start, stop = int(begins[big]), int(ends[big])
            if stop - start <= size // 2:
                todo.append((start, stop))
                lo = hi
                break
            # More than half is left: only words that were cut off can have become rare.
            gone = np.unique(np.concatenate([codes[lo:start], codes[stop:hi]]))
            first = np.searchsorted(places, gone * n + start)
            count = np.searchsorted(places, gone * n + stop) - first
            rare = np.flatnonzero((count > 0) & (count < MIN_PERIODS))
            lo, hi = start, stop
            cuts = np.sort(np.concatenate(
                [places[first[rare][count[rare] > i] + i] % n for i in range(MIN_PERIODS - 1)]))
        if hi > lo:
            out.append((lo, hi))
    return sorted(out)


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements of two arrays of one length are equal."""
    at, step = 0, 64
    while at < len(a):
        unequal = np.flatnonzero(a[at:at + step] != b[at:at + step])
        if len(unequal):
            return at + int(unequal[0])
        at += step
        step *= 2
    return len(a)


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """All qualifying runs of one segment: (start, end, period)."""
    m = len(words)
    found: dict[tuple[int, int], int] = {}  # lags ascend: the first period of a stretch is its least
    for q in range(1, min(SHORT_LAG, m // MIN_PERIODS + 1)):
        equal = np.concatenate([[False], words[q:] == words[:-q], [False]])
        turns = np.flatnonzero(equal[1:] != equal[:-1])
        for start, stop in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if stop - start + q >= max(MIN_LENGTH, MIN_PERIODS * q):
                found.setdefault((start, stop + q), q)
    if m < MIN_PERIODS * SHORT_LAG:
        return [(s, e, q) for (s, e), q in found.items()]
    power = np.full(m + 1, _BASE)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * power[:-1], dtype=np.uint64)])
    for q in range(SHORT_LAG, m // MIN_PERIODS + 1):
        ends = sums[::q]
        windows = ends[1:] - ends[:-1]
        same = windows[:-1] * power[q] == windows[1:]
        if not same.any():
            continue
        hits = same.nonzero()[0] * q
        for (start, stop), period in found.items():
            if q % period == 0:  # this stretch has lag q as well, and no longer one has
                hits = hits[(hits < start) | (hits + 2 * q > stop)]
        done = 0
        for j in hits.tolist():
            if j + 2 * q <= done:
                continue  # in the stretch that the last hit gave
            stop = j + q + _reach(words[j:m - q], words[j + q:])
            start = j - _reach(words[:j][::-1], words[q:j + q][::-1])
            if stop >= j + 2 * q:
                done = stop
                if stop - start >= max(MIN_LENGTH, MIN_PERIODS * q):
                    found.setdefault((start, stop), q)
    return [(s, e, q) for (s, e), q in found.items()]


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all qualifying runs of a sequence, by start, then period."""
    return sorted((lo + start, stop - start, period) for lo, hi in segments(codes)
                  for start, stop, period in lag_scan(codes[lo:hi]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for the words of a run behind its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def words_of(text: str | Column = "text") -> Column:
    """The words of a text; none of a null one."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")),
                                F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(docs: DataFrame, words: str = "words", key: str = "doc_id") -> DataFrame:
    """key, n_words, runs (start, length, period; by start, then period) and collapsed: the
    words joined by single spaces, without those in a run behind its first period.

    ``words`` is an array of strings (``words_of`` gives it for a text). One row per input
    row, repeated rows included; a null or empty array has no runs and an empty text, a
    null key stays null, an empty table gives no rows, and other columns are ignored whatever
    their names. Nulls within an array count as empty words.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = batch.column(0), batch.column(1)
            offsets = lists.offsets.to_numpy()
            flat = lists.values
            codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(flat) else np.empty(0, np.int64)
            keep = np.ones(len(codes), bool)
            sizes, starts, lengths, periods = [0], [], [], []
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                own = runs_of(codes[lo:hi])
                if own:
                    keep[lo:hi] = kept_words(hi - lo, own)
                    s, n, p = zip(*own)
                    starts += s
                    lengths += n
                    periods += p
                sizes.append(len(starts))
            ends = np.concatenate([[0], np.cumsum(keep)])
            left = pa.ListArray.from_arrays(pa.array(ends[offsets], pa.int32()), flat.filter(pa.array(keep)))
            runs = pa.StructArray.from_arrays(
                [pa.array(v, pa.int64()) for v in (starts, lengths, periods)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.diff(offsets), pa.int64()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), runs),
                 pa.compute.binary_join(left, " ")], ["key", "n_words", "runs", "collapsed"])

    import pyarrow.compute  # noqa: F401 - pa.compute in the workers
    empty = F.array().cast("array<string>")
    given = F.transform(F.coalesce(F.col(words).cast("array<string>"), empty), lambda w: F.coalesce(w, F.lit("")))
    return docs.select(F.col(key).alias("key"), given.alias("words")) \
               .mapInArrow(run, f"key {kind}, n_words bigint, runs {RUNS}, collapsed string") \
               .withColumnRenamed("key", key)


def longest_by_exponent(runs: str | Column = "runs") -> Column:
    """The run with the greatest length / period, compared exactly; ties by start, period."""
    runs = F.col(runs) if isinstance(runs, str) else runs

    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        # Runs come by start and period, so of equal ones the first stays.
        return F.when(left >= right, a).otherwise(b)

    return F.when(F.size(runs) > 0, F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))),
                                                F.element_at(runs, 1), better))
