"""Periodic runs of words: divide and conquer on interned word ids, with Z-functions at each midpoint.

A run is a stretch of words with smallest period q and length at least max(least, 2 * q) that no neighbouring word extends with
that period. Runs that cross a midpoint show as lengths of common prefixes and suffixes with the words on either side of it.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import bounded, tidy

#: Fewest words of a run.
LEAST = 12
#: Common prefixes up to so many words are found for all positions at once.
SHORT = 8
#: Positions inside a known stretch that are settled together.
MOST_AT_ONCE = 256
#: Distinct words that are remembered between texts.
REMEMBERED = 1 << 20
RUNS = "array<struct<start:long,length:long,period:long>>"
DIGEST = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def common(a: np.ndarray, x: int, y: int) -> int:
    """How many values from x on equal those from y on."""
    most, n, size = len(a) - max(x, y), 0, 32
    while n < most:
        k = min(size, most - n)
        other = a[x + n : x + n + k] != a[y + n : y + n + k]
        at = int(other.argmax())
        if other[at]:
            return n + at
        n, size = n + k, min(4 * size, 1 << 16)
    return n


def z_function(a: np.ndarray) -> np.ndarray:
    """For each position the length of the longest common prefix of ``a`` and what begins there.

    Short prefixes are compared a word at a time for all positions that are still in agreement. Longer ones use the last stretch
    [left, right) that equals a prefix: values within it follow from those at the prefix, up to the first that goes on beyond it.
    Where the prefix begins with a repetition of period q, a whole stretch of the same repetition is settled at once.
    """
    n = len(a)
    z = np.zeros(n, np.int64)
    if not n:
        return z
    z[0] = n
    at = np.flatnonzero(a[1:] == a[0]) + 1
    z[at] = 1
    for k in range(1, SHORT):
        at = at[at + k < n]
        if not len(at):
            return z
        at = at[a[at + k] == a[k]]
        z[at] = k + 1
    i = left = right = q = run = 0  # a[:run] has period q and a[:run + 1] has not
    while i < len(at):
        j = int(at[i])
        if j < right:
            till = min(int(np.searchsorted(at, min(right, j + left))), i + MOST_AT_ONCE)
            places = at[i:till]
            known, room = z[places - left], right - places
            z[places] = np.minimum(known, room)
            i = till
            for x in np.flatnonzero(known == room):
                if more := common(a, right, int(room[x])):
                    i += int(x) + 1 - len(places)
                    places = places[: x + 1]
                    left = int(places[-1])
                    right += more
                    z[left] += more
                    break
            if not q and (twice := z[places] >= places).any():
                q = int(places[twice.argmax()])
                run = q + int(z[q])
            continue
        z[j] = SHORT + common(a, j + SHORT, SHORT)
        i, left, right = i + 1, j, j + int(z[j])
        if not q and z[j] >= j:
            q, run = j, right
            base, stop = 0, run
        elif q and z[j] >= run:
            base, stop = j, j + q + common(a, j + q, j)
        else:
            continue
        till = int(np.searchsorted(at, stop))
        places = at[i:till]
        rest, room = (places - base) % q, stop - places
        known = np.where(rest == 0, run, z[rest])
        z[places] = np.minimum(known, room)
        for x in np.flatnonzero(known == room):
            z[places[x]] += common(a, stop, int(room[x]))
        if len(places) and (ends := places + z[places]).max() > right:
            left, right = int(places[ends.argmax()]), int(ends.max())
        i = till
    return z


def last_equal(a: np.ndarray, width: int) -> np.ndarray:
    """For each position the last earlier one from which ``width`` equal values begin (by digest, so at least all of these), or -1."""
    n = len(a) - width + 1
    if n < 2:
        return np.full(max(n, 0), -1)
    digest = np.zeros(n, np.uint64)
    for k in range(width):
        digest = digest * np.uint64(0x9E3779B97F4A7C15) + a[k : k + n].astype(np.uint64) + np.uint64(1)
    order = np.argsort(digest, kind="stable")
    same = digest[order[1:]] == digest[order[:-1]]
    out = np.full(n, -1)
    out[order[1:][same]] = order[:-1][same]
    return out


def _crossing(a: np.ndarray, low: int, mid: int, high: int, least: int) -> np.ndarray:
    """(start, end, period) of repetitions in a[low:high] at ``mid`` that do not go on beyond that part."""
    apart = np.array([-1], a.dtype)
    part, right, left = a[low:high], a[mid:high], a[low:mid][::-1]
    ahead = z_function(np.concatenate([right, apart, part]))[len(right) + 1 :]
    behind = z_function(np.concatenate([left, apart, part[::-1]]))[len(left) + 1 :][::-1]
    out = []
    h = mid - low
    p = np.arange(1, high - mid + 1)  # the right side holds a period
    f, b = np.append(ahead[h + 1 :], 0), behind[h:]
    ok = f + b >= np.maximum(p, least - p)
    out.append(np.stack([mid - b[ok], mid + p[ok] + f[ok], p[ok]], 1))
    p = np.arange(1, h + 1)  # the left side does
    f, b = ahead[:h][::-1], np.append(behind[: h - 1][::-1], 0)
    ok = f + b >= np.maximum(p, least - p)
    out.append(np.stack([mid - p[ok] - b[ok], mid + f[ok], p[ok]], 1))
    found = np.concatenate(out)
    s, e, p = found.T
    longer = (s == low) & (low > 0) & (a[s - 1] == a[s - 1 + p])
    x = np.minimum(e, len(a) - 1)
    longer |= (e == high) & (high < len(a)) & (a[x] == a[x - p])
    return found[~longer]


def word_runs(a: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of all runs, by start and then period.

    A part without two equal stretches of half of ``least`` words holds no run and is not cut further.
    """
    width = (least + 1) // 2
    seen = last_equal(a, width)
    found, parts = [], [(0, len(a))]
    while parts:
        low, high = parts.pop()
        if high - low < least or seen[low : high - width + 1].max() < low:
            continue
        mid = (low + high) // 2
        found.append(_crossing(a, low, mid, high, least))
        parts += [(low, mid), (mid, high)]
    if not found:
        return np.zeros((0, 3), np.int64)
    s, e, p = np.concatenate(found).T
    order = np.lexsort((p, e, s))
    s, e, p = s[order], e[order], p[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, p = s[new], e[new], p[new]
    order = np.lexsort((p, s))
    return np.stack([s, e - s, p], 1)[order]


def stays(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words are in no run beyond its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:n]) == 0


class Words:
    """Words as numbers; what is remembered is bounded."""

    def __init__(self):
        self.ids: defaultdict[bytes, int] = defaultdict(count().__next__)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.ids) > REMEMBERED:
            self.ids = defaultdict(count().__next__)
        return np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The places of words of which the last ones repeat with a period, for one id in ten by its crc32; else None."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n or doc_id is None:
        return None
    g = h // 10
    a = g % n
    return np.concatenate([np.arange(a), a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))])


def _worker(each: Callable[[int | None, list[bytes], np.ndarray], tuple], schema: pa.Schema):
    """Batches of (doc_id, text as bytes) to rows of ``schema``; bytes are split at ASCII white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for b in batches:
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words = text.as_py().split()
                rows.append(each(key, words, known.numbers(words)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)] if rows else [pa.array([], t) for t in schema.types], schema=schema)
        tidy()

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))


def find_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period, by start and then period; word numbers from 0).

    Null and blank texts have no words and no runs; texts are taken whole at any length; repeated rows stay; an empty table gives
    no rows; other columns are not looked at. One pass without a shuffle; a text takes memory for about twenty numbers a word.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))])

    def each(key, words, a):
        return key, len(words), [{"start": s, "length": n, "period": p} for s, n, p in word_runs(a, least).tolist()]

    return _texts(docs, id_col, text_col).mapInArrow(_worker(each, schema), f"doc_id long, n_words long, runs {RUNS}")


def collapse_runs(docs: DataFrame, least: int = LEAST, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with all columns; texts with runs keep each run's first period only, their words joined by one space.

    Null texts and texts without runs stay as they are."""

    @F.pandas_udf("string")
    def collapsed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Words()
        for texts in batches:
            out = []
            for t in texts:
                words = t.encode("utf-8", "surrogatepass").split() if t else []
                runs = word_runs(known.numbers(words), least)
                out.append(b" ".join(w for w, k in zip(words, stays(len(words), runs), strict=True) if k).decode("utf-8", "surrogatepass") if len(runs) else t)
            yield pd.Series(out, dtype=object)

    return bounded(docs).withColumn(text_col, collapsed(F.col(text_col)))


def run_digests(docs: DataFrame, least: int = LEAST, tails: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_runs, the longest run's start, length, period and exponent_milli (nulls without one), and
    digests of all runs and of the words that stay. ``tails`` first makes the last words of one id in ten periodic.

    Edge cases are those of ``find_runs``; a null id has no periodic tail."""

    def each(key, words, a):
        if tails and (at := periodic_tail(key, len(words))) is not None:
            words, a = [words[i] for i in at.tolist()], a[at]
        runs = word_runs(a, least)
        listed = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist()).encode()).hexdigest()
        if not len(runs):
            return key, 0, None, None, None, None, listed, hashlib.sha256(b" ".join(words)).hexdigest()
        s, n, p = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
        kept = b" ".join(w for w, k in zip(words, stays(len(words), runs).tolist(), strict=True) if k)
        return key, len(runs), s, n, p, 1000 * n // p, listed, hashlib.sha256(kept).hexdigest()

    names = DIGEST.replace(" long", "").replace(" string", "").split(", ")
    schema = pa.schema([(c, pa.string() if c.endswith("sha256") else pa.int64()) for c in names])
    return _texts(docs, id_col, text_col).mapInArrow(_worker(each, schema), DIGEST)
