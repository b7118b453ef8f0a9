"""Benchmark items inside documents, up to an edit budget: exact pieces propose, Myers' bit-parallel distance verifies."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .memory import bounded

#: Share of an item's length that may be edited, and the bytes of items that are looked for in one pass over the documents.
EDIT_RATE, BLOCK_BYTES = 0.08, 4_000_000
MATCH = "array<struct<item:string,edits:int,start:int,end:int>>"
#: Rows up to which a list is broadcast; beyond, it is joined by a shuffle.
MOST_BROADCAST = 1_000_000


def cut(item: str, pieces: int) -> list[tuple[int, str]]:
    """``pieces`` parts of near equal length with their offsets."""
    at = [len(item) * i // pieces for i in range(pieces + 1)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:], strict=False) if b > a]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to any substring of ``text``, and the first end where it is reached."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Finds all items of one block in a text. By the pigeonhole principle an occurrence with at most k edits leaves one of
    k + 1 disjoint pieces untouched, so no occurrence within the budget is missed."""

    def __init__(self, items: list[tuple[int | str, str]], rate: float = EDIT_RATE):
        self.items = [(key, text, int(len(text) * rate)) for key, text in items]
        self.forward = [masks(t) for _, t, _ in self.items]
        self.backward = [masks(t[::-1]) for _, t, _ in self.items]
        at: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, k) in enumerate(self.items):
            for offset, piece in cut(text, k + 1):
                at.setdefault(piece, []).append((n, offset))
        self.tree = ahocorasick.Automaton()
        for piece, where in at.items():
            self.tree.add_word(piece, (len(piece), where))
        if at:
            self.tree.make_automaton()
        self.empty = not at

    def find(self, text: str | None) -> list[tuple[int | str, int, int, int]]:
        """(item, edits, start, end) of the best, then leftmost, occurrence of every item in the text."""
        if not text or self.empty:
            return []
        starts: dict[int, list[int]] = {}
        for end, (size, where) in self.tree.iter(text):
            for n, offset in where:
                starts.setdefault(n, []).append(end + 1 - size - offset)
        out = []
        for n, own in starts.items():
            key, item, k = self.items[n]
            m, best = len(item), None
            own = sorted(set(own))
            i = 0
            while i < len(own):
                first = last = own[i]
                while i < len(own) and own[i] - last <= 2 * k + 1:
                    last = own[i]
                    i += 1
                a, b = max(0, first - k), min(len(text), last + m + k)
                if b - a < m - k:
                    continue
                edits, end = myers(self.forward[n], m, text[a:b])
                if edits <= k and (best is None or edits < best[0]):
                    best = (edits, a + end)
            if best:
                edits, end = best
                low = max(0, end - m - k)
                _, back = myers(self.backward[n], m, text[low:end][::-1])
                out.append((key, edits, end - back, end))
        return sorted(out)


def _named(items: DataFrame) -> DataFrame:
    """(item, item_id, text) of the items that can match; ``item`` is the digest of the text."""
    some = items.filter(F.col("text").isNotNull() & (F.col("text") != ""))
    return some.select(F.md5(F.col("text").cast("binary")).alias("item"), "item_id", "text")


def _blocks(items: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """(item, text) of the distinct item texts, in blocks of about BLOCK_BYTES; one block is held at a time."""
    texts = _named(items).select("item", "text").distinct()
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, ceil(total / BLOCK_BYTES))
    for b in range(n):
        block = texts.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b).collect()
        if block:
            yield sorted((r["item"], r["text"]) for r in block)


def _matches(block: list[tuple[str, str]], rate: float):
    @F.pandas_udf(MATCH)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Matcher(block, rate)
        for texts in batches:
            yield pd.Series([[{"item": a, "edits": b, "start": c, "end": d} for a, b, c, d in m.find(t)] for t in texts], dtype=object)

    return found


def benchmark_matches(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row and item found in it: doc_id, item_id, edits, start, end (code points, end exclusive).

    An item counts as found where its edit distance to some part of the whole text is at most ``rate`` of its length. Null or
    empty items and documents match nothing; items with equal texts are all listed, each id of a text once; an id that several
    texts share is listed for each of them that is found; repeated document rows are listed each; an item with a null id is
    listed with a null id; empty tables give no rows; other columns are not looked at. Items go through the documents in blocks
    of a fixed number of bytes, each in a pass whose matches are written before the next block is read, so what the driver and
    the workers hold stays bounded.
    """
    docs, found, blocks = bounded(docs), None, _blocks(items)
    block = next(blocks, None)
    while block:
        part = docs.select(F.col(id_col).alias("doc_id"), F.explode(_matches(block, rate)(F.col(text_col))).alias("m")).select("doc_id", "m.*")
        block = next(blocks, None)
        if found is not None or block:
            part = materialize(part)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit(None).cast("long").alias("item_id"), *[F.lit(None).cast("int").alias(c) for c in ("edits", "start", "end")]).limit(0)
    every = _named(items).select("item", "item_id").distinct()
    every = F.broadcast(every) if every.count() <= MOST_BROADCAST else every
    return found.join(every, "item").select("doc_id", "item_id", "edits", "start", "end")


def drop_contaminated(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no item is found.

    Rows with null or empty texts stay, and repeated rows go or stay together; without items all rows stay."""
    blocks = _blocks(items)
    block, more = next(blocks, None), next(blocks, None)
    if not block:
        return docs
    docs, text = bounded(docs), F.coalesce(F.col(text_col), F.lit(""))
    if not more:
        return docs.filter(F.size(_matches(block, rate)(text)) == 0)
    key, gone = F.md5(text.cast("binary")), None
    while block:
        part = materialize(docs.select(key.alias("key"), text.alias("text")).filter(F.size(_matches(block, rate)(F.col("text"))) > 0).select("key").distinct())
        gone = part if gone is None else gone.unionByName(part)
        block, more = more, next(blocks, None)
    gone = materialize(gone.distinct())
    gone = F.broadcast(gone) if gone.count() <= MOST_BROADCAST else gone
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    return rows.join(gone, "key", "left_anti").select("row.*")
