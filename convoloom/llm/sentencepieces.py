"""SentencePiece encoding and decoding with forward states shared by words that begin alike.

Distinct marked words are sorted, which lays them out in the depth-first order of their trie: from one word to the next only
the part behind the common prefix is computed anew. For a unigram model the state of a prefix is the best score and its last
piece (Viterbi). For a merge model sums of scores do not give the library's result, so the state is the last piece of the
prefix's encoding: it is the one piece that ends there and, next to the last piece before it, is left alone by the merges.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import bounded, tidy

MARK = "▁"
UNIGRAM = 1
#: Distinct words, and twice as many piece pairs, that a worker remembers before it starts anew.
REMEMBERED = 200_000
UNKNOWN_PENALTY = 10.0


def _model_type(proto: bytes) -> int:
    """Field 3 of the trainer spec (field 2) of a serialized model: 1 unigram, 2 merges."""

    def fields(buf: bytes) -> Iterator[tuple[int, object]]:
        i = 0

        def varint() -> int:
            nonlocal i
            shift = value = 0
            while True:
                b = buf[i]
                i += 1
                value |= (b & 127) << shift
                shift += 7
                if b < 128:
                    return value

        while i < len(buf):
            key = varint()
            kind = key & 7
            if kind == 0:
                yield key >> 3, varint()
            else:
                n = {1: 8, 5: 4}.get(kind) or varint()
                yield key >> 3, buf[i : i + n]
                i += n

    for number, value in fields(proto):
        if number == 2:
            return next((v for n, v in fields(value) if n == 3), UNIGRAM)
    return UNIGRAM


class PieceCoder:
    """Encodes and decodes with one model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kind = _model_type(sp.serialized_model_proto())
        self.ids, self.score, self.bytes_of = {}, [], []
        self.byte_id = [0] * 256
        self.unknown = sp.unk_id()
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            self.score.append(sp.get_score(i))
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_id[b] = i
                self.bytes_of.append(bytes([b]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.ids[piece] = i
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self.fallback = any(self.byte_id)
        self.longest = max(map(len, self.ids))
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces that go on behind a word's end are not supported")
        self.least = min(self.score) - UNKNOWN_PENALTY
        #: Ids of pieces and, from the vocabulary's size on, of characters without one.
        self.local, self.names = dict(self.ids), {i: p for p, i in self.ids.items()}
        self.words: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.surface = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.size_of = np.array([len(b) for b in self.bytes_of], np.int64)
        self.start_of = np.cumsum(self.size_of) - self.size_of
        self.odd = re.compile(f"{MARK}|^ | $|  ")
        self.unit = re.compile(f"{MARK}+[^{MARK}]*")

    def merged(self, text: str) -> list[str]:
        """The pieces that the merges leave of ``text``: the best-scored neighbour pair first, leftmost on a tie."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(parts):
                joined = parts[a] + parts[b]
                if joined in self.ids:
                    heapq.heappush(heap, (-self.score[self.ids[joined]], a, b, joined))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, joined = heapq.heappop(heap)
            if parts[a] is None or b >= len(parts) or parts[b] is None or after[a] != b or parts[a] + parts[b] != joined:
                continue
            parts[a], parts[b] = joined, None
            after[a] = after[b]
            if after[a] < len(parts):
                before[after[a]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [p for p in parts if p is not None]

    def _stable(self, left: int, right: int) -> bool:
        """Whether merging the joined pieces gives just these two, or the right one alone if there is none before; remembered."""
        a, b = self.names.get(left, ""), self.names[right]
        known = self.pairs[left << 32 | right] = self.merged(a + b) == [a, b] if a else self.merged(b) == [b]
        return known

    def _unknown(self, c: str) -> int:
        i = self.local[c] = len(self.score) + len(self.local)
        self.names[i] = c
        return i

    def _forward(self, words: list[str]) -> Iterator[list[int]]:
        """The pieces, as local ids, of each of the sorted words; states of the shared prefix stay on the stack."""
        nothing = (1 << 31) - 1
        last: list[int] = [nothing]
        size: list[int] = [0]
        best: list[float] = [0.0]
        previous, pairs, local = "", self.pairs, self.local
        lengths = [*[n for n in (2, 3, 4, 1) if n <= self.longest], *range(5, self.longest + 1)]
        for w in words:
            common = 0
            for x, y in zip(previous, w, strict=False):
                if x != y:
                    break
                common += 1
            del last[common + 1 :], size[common + 1 :]
            if self.kind == UNIGRAM:
                del best[common + 1 :]
            for end in range(common + 1, len(w) + 1):
                if self.kind == UNIGRAM:
                    top, n, own = best[end - 1] + self.least, 1, local.get(w[end - 1])
                    own = self._unknown(w[end - 1]) if own is None else own
                    for start in range(max(0, end - self.longest), end):
                        i = self.ids.get(w[start:end])
                        if i is not None and best[start] + self.score[i] > top:
                            top, n, own = best[start] + self.score[i], end - start, i
                    best.append(top)
                    last.append(own)
                    size.append(n)
                    continue
                for n in lengths:  # only one piece fits, so the commonest lengths are tried first
                    if n > end:
                        continue
                    i = local.get(w[end - n : end])
                    if i is None:
                        if n > 1:
                            continue
                        i = self._unknown(w[end - 1])
                    key = last[end - n] << 32 | i
                    known = pairs.get(key)
                    if known is None:
                        known = self._stable(last[end - n], i)
                    if known:
                        last.append(i)
                        size.append(n)
                        break
                else:
                    raise AssertionError("no piece ends here")
            previous = w
            out, at = [], len(w)
            while at:
                out.append(last[at])
                at -= size[at]
            out.reverse()
            yield out

    def _packed(self, pieces: list[int]) -> bytes:
        """The library's ids as 32-bit integers; a character without a piece gives those of its bytes."""
        if max(pieces) < len(self.score):
            return np.array(pieces, np.int32).tobytes()
        out: list[int] = []
        for p in pieces:
            if p < len(self.score):
                out.append(p)
            elif self.fallback:
                out += [self.byte_id[b] for b in self.names[p].encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, np.int32).tobytes()

    def pack(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as 32-bit integers; the mark of the first word is put before the text as the library does."""
        cut: list[list[str]] = []
        for t in texts:
            if not t:
                cut.append([])
            elif self.odd.search(t):
                cut.append([u[1:] for u in self.unit.findall(MARK + t.replace(" ", MARK))])
            else:
                cut.append(t.split(" "))
        if len(self.words) > REMEMBERED:
            self.words.clear()
        if len(self.pairs) > 2 * REMEMBERED:
            self.pairs.clear()
        new = sorted({u for units in cut for u in units} - self.words.keys())
        for u, pieces in zip(new, self._forward([MARK + u for u in new]), strict=True):
            self.words[u] = self._packed(pieces)
        get = self.words.__getitem__
        return [b"".join(map(get, units)) for units in cut]

    def encode_batch(self, texts: Iterable[str | None]) -> list[list[int]]:
        """Ids of each text."""
        return [np.frombuffer(b, np.int32).tolist() for b in self.pack(texts)]

    def decode(self, ids: Iterable[int] | np.ndarray) -> str:
        """The text of the ids, without the space that stands for the first mark."""
        at = np.asarray(ids if isinstance(ids, np.ndarray) else list(ids), np.int64)
        n = self.size_of[at]
        place = np.repeat(self.start_of[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.surface[place].tobytes().decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", rows_a_block: int = 500) -> DataFrame:
    """One row per input row: doc_id, n_pieces, ids (as the library gives them) and round_trip (decoding them gives the text).

    ``model`` is a path that every worker can read. Null text counts as empty and has no ids; whole texts are encoded; repeated
    rows stay; an empty table gives no rows; other columns are not looked at. One pass without a shuffle; memory is a block of
    rows and bounded tables of known words.
    """
    rows = bounded(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, rows_a_block):
                part = batch.slice(at, rows_a_block)
                texts = [t or "" for t in part.column(1).to_pylist()]
                packed = c.pack(texts)
                ids = [np.frombuffer(b, np.int32) for b in packed]
                sizes = [len(x) for x in ids]
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(packed), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array([c.decode(x) == t for x, t in zip(ids, texts, strict=True)], pa.bool_())],
                    names=["doc_id", "n_pieces", "ids", "round_trip"],
                )
        tidy()

    return rows.mapInArrow(run, f"doc_id {kind}, n_pieces long, ids array<int>, round_trip boolean")


def decode_pieces(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: doc_id and the text of its ids; null ids give null text."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = coder(model)
        for ids in batches:
            yield ids.map(lambda x: None if x is None else c.decode(x))

    return encoded.select(F.col(id_col).alias("doc_id"), text(F.col(ids_col)).alias("text"))
