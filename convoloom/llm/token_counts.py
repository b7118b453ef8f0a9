"""Byte-level BPE token counts by rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import bounded

#: The pre-token pattern of the byte-level vocabulary (a fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pieces a worker remembers before it starts anew, and symbols merged in one array.
REMEMBERED, SYMBOLS_A_BLOCK = 400_000, 4_000_000


def _byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in the vocabulary file, by the rule that made them."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankMerger:
    """Counts the symbols that survive all merges, for many pre-tokens at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = _byte_letters()
        self.first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made
        self.special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special_re = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pre = regex.compile(PRE_TOKEN)
        self.odd_space = regex.compile(r" (?=\s|$)")
        self.inner: dict[str, int] = {}
        self.outer: dict[str, int] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank[at], len(self.keys))

    def merge_block(self, words: list[bytes]) -> np.ndarray:
        """Surviving symbols of each word. Every round merges each word's lowest-rank pair, at all its places."""
        n = np.array([len(w) for w in words], np.int64)
        out = n.copy()
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), n)
        none = len(self.keys)
        while len(symbols) > 1:
            rank = np.full(len(symbols), none, np.int64)
            same = owner[:-1] == owner[1:]
            at = np.flatnonzero(same)
            rank[at] = self._ranks(symbols[at], symbols[at + 1])
            starts = np.flatnonzero(np.r_[True, ~same])
            lowest = np.minimum.reduceat(rank, starts)
            alive = np.repeat(lowest < none, np.diff(np.r_[starts, len(symbols)]))
            if not alive.any():
                break
            if not alive.all():  # words without a pair left are done
                symbols, owner, rank = symbols[alive], owner[alive], rank[alive]
                starts = np.flatnonzero(np.r_[True, owner[:-1] != owner[1:]])
                lowest = lowest[lowest < none]
            sizes = np.diff(np.r_[starts, len(symbols)])
            hit = rank == np.repeat(lowest, sizes)
            # In a run of touching hits (the pair of a symbol with itself) every second one is taken, from the left.
            run = np.flatnonzero(hit)
            if len(run) > 1:
                fresh = np.r_[True, np.diff(run) != 1]
                head = np.maximum.accumulate(np.where(fresh, np.arange(len(run)), 0))
                take = (np.arange(len(run)) - head) % 2 == 0
                run = run[take]
            symbols[run] = self.made[rank[run]]
            keep = np.ones(len(symbols), bool)
            keep[run + 1] = False
            symbols, owner = symbols[keep], owner[keep]
            ids, left = np.unique(owner, return_counts=True)
            out[ids] = left
        return out

    def _learn(self, pieces: Iterable[str], table: dict[str, int], lead: str) -> None:
        """Counts for pieces that are new; ``lead`` is the space that the split took away."""
        new = [p for p in pieces if p not in table]
        if not new:
            return
        cut = [self.pre.findall(lead + p) for p in new]
        tokens = list(dict.fromkeys(t for c in cut for t in c))
        count: dict[str, int] = {}
        block: list[bytes] = []
        names: list[str] = []
        size = 0
        for t in tokens:
            block.append(t.encode("utf-8", "surrogatepass"))
            names.append(t)
            size += len(block[-1])
            if size >= SYMBOLS_A_BLOCK:
                count.update(zip(names, self.merge_block(block).tolist(), strict=True))
                block, names, size = [], [], 0
        if block:
            count.update(zip(names, self.merge_block(block).tolist(), strict=True))
        for p, c in zip(new, cut, strict=True):
            table[p] = sum(count[t] for t in c)

    def count(self, texts: Iterable[str | None]) -> list[int]:
        parts: list[list[str]] = []
        extra: list[int] = []
        for t in texts:
            t = t or ""
            if self.special_re is not None and any(s in t for s in self.special):
                cut = self.special_re.split(t)
                parts.append([c for c in cut if c])
                extra.append(len(cut) - 1)
            else:
                parts.append([t] if t else [])
                extra.append(0)
        split: list[list[tuple[str, list[str]]]] = []
        firsts: set[str] = set()
        rest: set[str] = set()
        for segments in parts:
            own = []
            for s in segments:
                if self.odd_space.search(s):  # a space before white space is cut by the pattern itself
                    pieces = [m for m in self._cut_at_words(s)]
                else:
                    pieces = s.split(" ")
                own.append((pieces[0], pieces[1:]))
                firsts.add(pieces[0])
                rest.update(pieces[1:])
            split.append(own)
        if len(self.inner) > REMEMBERED:
            self.inner.clear()
        if len(self.outer) > REMEMBERED // 8:
            self.outer.clear()
        self._learn(firsts, self.outer, "")
        self._learn(rest, self.inner, " ")
        inner = self.inner.__getitem__
        return [x + sum(self.outer[a] + sum(map(inner, b)) for a, b in own) for x, own in zip(extra, split, strict=True)]

    @staticmethod
    def _cut_at_words(s: str) -> list[str]:
        """Cut only at spaces that stand before something other than white space; the rest is left to the pattern."""
        return regex.split(r" (?=\S)", s)


@lru_cache(maxsize=2)
def merger(path: str) -> RankMerger:
    return RankMerger(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    ``vocabulary`` is the path of a byte-level BPE file that every worker can read. Special strings inside a text are one token
    each. Null and empty texts have 0 bytes and 0 tokens; whole texts are counted whatever their length; repeated rows stay;
    an empty table gives no rows; other columns are not looked at. One pass, no shuffle; memory is one Arrow batch and a
    bounded table of known pieces.
    """

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = merger(vocabulary)
        for texts in batches:
            out: list[int] = []
            for i in range(0, len(texts), 1000):
                out += m.count(texts.iloc[i : i + 1000])
            yield pd.Series(out, dtype="int64")

    t = bounded(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return t.select("doc_id", F.octet_length("t").cast("long").alias("n_bytes"), tokens("t").alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
