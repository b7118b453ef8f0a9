"""Token log-probabilities from a log-bilinear model trained with noise-contrastive estimation.

Counts of all training tokens stay in a table that is sharded by word. Words with at least HEAD_SHARE of all tokens (so at most
1 / HEAD_SHARE of them) and a count of HEAD_COUNT have vectors of their own and are looked up map-side; all others join the table. A word's class is the
word itself for the SINGLES most frequent ones and one of BUCKETS by the last letters for the others. One log-bilinear model
predicts the class, or the end of a text, from the classes of the two tokens before; a second one predicts the word inside its
bucket from the class of the token before, where all words without a vector are one entry; inside that they have their
discounted shares. Softmax sums come from matrix products over every context, so probabilities are normalised.

Documents are dealt to units by a hash, a unit trains on all its windows in order, and the models of all units are averaged, so
the result does not depend on how the input is partitioned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import ceil, log, log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .memory import bounded, tidy

#: Classes of one word, and classes by the last SUFFIX bytes; widths of the vectors for classes and for words in their bucket.
SINGLES, BUCKETS, SUFFIX = 800, 128, 3
WIDTH, INNER = 24, 8
NOISE, INNER_NOISE, BATCH = 64, 32, 2048
#: Least share of all tokens, and least count, of a word with vectors of its own.
HEAD_SHARE, HEAD_COUNT = 1e-6, 3
#: Training tokens of a unit, and how many times every unit trains on its windows.
UNIT_TOKENS, ROUNDS = 4_000_000, 2
#: Words counted in a task before the counts are handed on, tokens scored in one array operation, and tokens whose equal windows
#: are trained on together.
WORDS_A_FLUSH, TOKENS_A_BLOCK, TOKENS_A_CHUNK = 400_000, 100_000, 4_000_000
SMOOTH = 0.1
#: Tokens that one example stands for at most.
MOST_WEIGHT = 8


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lowered; bytes change case and split in ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 10; a null id counts as empty text, which does."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; the end of a text is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(count.keys()), pa.string()), pa.array(list(count.values()), pa.int64())], names=["word", "n"])
            count.clear()
            return out

        count: Counter[bytes] = Counter()
        for batch in batches:
            for t in batch.column(0):
                count.update(words_of(t.as_py()))
                count[b""] += 1
                if len(count) > WORDS_A_FLUSH:
                    yield flush()
        if count:
            yield flush()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Ids: 0 .. v classes of words, v+1 the end, v+2 what stands before the first token (context only)."""

    v: int
    inputs: np.ndarray  # (v + 3, width)
    outputs: np.ndarray  # (v + 2, width)
    bias: np.ndarray
    near: np.ndarray  # (width, width): one token back
    far: np.ndarray  # two tokens back

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.outputs, self.bias, self.near, self.far]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Model(self.v, *out)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        return self.inputs @ self.near, self.inputs @ self.far

    def sums(self) -> np.ndarray:
        """Log of the softmax sum for every (two back, one back): one matrix product for each token two back."""
        one, two = self.contexts()
        out = np.empty((len(two), len(one)), np.float32)
        for i in range(len(two)):
            s = (one + two[i]) @ self.outputs.T + self.bias
            top = s.max(axis=1, keepdims=True)
            out[i] = (top + np.log(np.exp(s - top).sum(axis=1, keepdims=True)))[:, 0]
        return out


def start_model(unigram: np.ndarray, seed: int = 11) -> Model:
    """Small random vectors and the unigram log-probabilities as biases."""
    v = len(unigram) - 2
    rng = np.random.default_rng(seed)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    eye = np.eye(WIDTH, dtype=np.float32)
    return Model(v, small(v + 3, WIDTH), small(v + 2, WIDTH), np.log(unigram).astype(np.float32), eye + small(WIDTH, WIDTH), 0.5 * eye + small(WIDTH, WIDTH))


def windows(ids: list[np.ndarray], v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(two back, one back, token) at all places of all texts, each closed by the end, and the places of each text."""
    n = np.array([len(x) + 1 for x in ids], np.int64)
    parts: list[np.ndarray] = []
    begin, end = np.full(2, v + 2, np.int32), np.full(1, v + 1, np.int32)
    for x in ids:
        parts += [begin, x, end]
    s = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    at = np.repeat(np.cumsum(n + 2) - n - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return s[at - 2], s[at - 1], s[at], n


def weighted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every distinct key, with weights that sum to its count. A key that is seen more than MOST_WEIGHT times is given several
    times, so no example outweighs a batch."""
    key, c = np.unique(key, return_counts=True)
    times = -(-c // MOST_WEIGHT)
    return np.repeat(key, times), np.repeat(c / times, times).astype(np.float32)


def examples(two: np.ndarray, one: np.ndarray, token: np.ndarray, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(two back, one back, token, weight) of the distinct windows."""
    key, weight = weighted((two.astype(np.int64) * (v + 3) + one) * (v + 3) + token)
    return key // (v + 3) ** 2, key // (v + 3) % (v + 3), key % (v + 3), weight


def _gathered(ids: np.ndarray, grad: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the rows of ``grad`` by id. Sixteen-bit ids are sorted by radix, so they are cut to that where they fit."""
    out = np.zeros((rows, grad.shape[1]), np.float32)
    ids = ids.astype(np.uint16) if rows <= 1 << 16 else ids
    order = np.argsort(ids, kind="stable")
    own = ids[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    out[own[first]] = np.add.reduceat(grad[order], first, axis=0)
    return out


def _beside(grad: np.ndarray, last: np.ndarray) -> np.ndarray:
    return np.concatenate((grad, last[:, None]), axis=1)


def _pulls(good: np.ndarray, bad: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the scores of the true and of the noise words; ``good`` and ``bad`` are used up."""
    with np.errstate(over="ignore"):  # a quotient by infinity is zero
        np.exp(good, out=good)
        np.exp(np.negative(bad, out=bad), out=bad)
    good += 1
    bad += 1
    np.divide(share, good, out=good)
    np.divide(-share[:, None], bad, out=bad)
    return good, bad


def descend(model: Model, noise: np.ndarray, two: np.ndarray, one: np.ndarray, token: np.ndarray, rng: np.random.Generator, state: dict[str, list[np.ndarray]], rate: float = 0.005, weight: np.ndarray | None = None) -> None:
    """Noise-contrastive steps over the given examples; the noise words of a batch are shared, so scores are matrix products.

    ``weight`` says how many tokens an example stands for; the gradients are divided by its mean over all examples."""
    weight = np.ones(len(token), np.float32) if weight is None else weight / weight.mean()
    shift = np.log(NOISE * noise).astype(np.float32)
    grown = np.cumsum(noise)

    m1, m2 = state["m1"], state["m2"]
    for at in range(0, len(token), BATCH):
        a, b, w = two[at : at + BATCH], one[at : at + BATCH], token[at : at + BATCH]
        k = np.minimum(np.searchsorted(grown, rng.random(NOISE) * grown[-1]), len(noise) - 1)
        near, far = model.contexts()
        h = near[b]
        h += far[a]
        ow, ok = model.outputs[w], model.outputs[k]
        share = weight[at : at + BATCH]
        lift = model.bias - shift
        dg, db = _pulls(np.einsum("ij,ij->i", h, ow) + lift[w], h @ ok.T + lift[k], share)
        dh = db @ ok
        dh += dg[:, None] * ow
        n, rows, seen = len(w), len(model.outputs), len(model.inputs)
        go = _gathered(w, _beside(dg[:, None] * h, dg), rows) + _gathered(k, _beside(db.T @ h, db.sum(axis=0)), rows)
        # Gradients of the contexts are summed by class before they go through the matrices.
        d1, d2 = _gathered(b, dh, seen), _gathered(a, dh, seen)
        grads = [d1 @ model.near.T + d2 @ model.far.T, go[:, :-1], go[:, -1], model.inputs.T @ d1, model.inputs.T @ d2]
        state["t"][0] += 1
        t = float(state["t"][0][0])
        for p, g, x, y in zip(model.parts(), grads, m1, m2, strict=True):
            g = g / n
            x *= 0.9
            x += 0.1 * g
            g *= g
            y *= 0.99
            g *= 0.01
            y += g
            step = np.sqrt(y / (1 - 0.99**t))
            step += 1e-6
            np.divide(x, step, out=step)
            step *= rate / (1 + t / 2000) / (1 - 0.9**t)
            p += step


@dataclass
class Vocabulary:
    """Codes of words: the SINGLES most frequent ones, then the entries of the buckets in order, the last of each standing for
    all words without a vector."""

    words: list[bytes]  # by falling count
    counts: np.ndarray
    ends: int
    rare: np.ndarray  # tokens without a vector by bucket

    def __post_init__(self):
        self.singles = k = min(SINGLES, len(self.words))
        self.v = k + BUCKETS - 1
        own = np.array([bucket_of(w) for w in self.words[k:]], np.int64)
        order = np.argsort(own, kind="stable")
        size = np.bincount(own, minlength=BUCKETS) + 1
        self.start = np.concatenate(([0], np.cumsum(size)))  # of each bucket's entries
        self.rare_entry = self.start[1:] - 1
        self.bucket = np.repeat(np.arange(BUCKETS), size)
        self.entry_count = np.empty(len(self.bucket))
        self.entry_count[self.rare_entry] = np.maximum(self.rare, 0.5)
        place = np.empty(len(own), np.int64)
        place[order] = np.setdiff1d(np.arange(len(self.bucket)), self.rare_entry, assume_unique=True)
        self.entry_count[place] = self.counts[k:]
        self.code = np.concatenate((np.arange(k), k + place)).astype(np.int32)  # of each word
        self.class_of = np.concatenate((np.arange(k), k + self.bucket)).astype(np.int32)  # of each code
        self.is_rare = np.zeros(k + len(self.bucket), bool)
        self.is_rare[k + self.rare_entry] = True

    def unigram(self) -> np.ndarray:
        """Shares of all classes and the end."""
        whole = np.concatenate((self.counts[: self.singles], np.add.reduceat(self.entry_count, self.start[:-1]), [max(self.ends, 0.5)]))
        return whole / whole.sum()

    def encoder(self):
        """A function from words to codes."""
        get, rare = dict(zip(self.words, self.code.tolist(), strict=True)).get, (self.singles + self.rare_entry).tolist()

        def encode(words: list[bytes]) -> np.ndarray:
            out = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = rare[bucket_of(words[i])]
            return out

        return encode


def bucket_of(word: bytes) -> int:
    return crc32(word[-SUFFIX:]) % BUCKETS


def bucket_column(word: Column) -> Column:
    """``bucket_of`` in Spark."""
    raw = word.cast("binary")
    return (F.crc32(F.when(F.octet_length(raw) > SUFFIX, F.substring(raw, -SUFFIX, SUFFIX)).otherwise(raw)) % BUCKETS).cast("int")


@dataclass
class Inner:
    """Scores of a bucket's entries from the class of the token before."""

    context: np.ndarray  # (v + 3, INNER)
    entries: np.ndarray  # (entries, INNER)
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.entries, self.bias]

    def sums(self, start: np.ndarray) -> np.ndarray:
        """Log of the softmax sum for every (class before, bucket)."""
        out = np.empty((len(self.context), len(start) - 1), np.float32)
        for j, (a, b) in enumerate(zip(start[:-1], start[1:], strict=True)):
            for at in range(0, len(out), 128):
                s = self.context[at : at + 128] @ self.entries[a:b].T + self.bias[a:b]
                top = s.max(axis=1, keepdims=True)
                out[at : at + 128, j] = (top + np.log(np.exp(s - top).sum(axis=1, keepdims=True)))[:, 0]
        return out


def start_inner(vocabulary: Vocabulary, seed: int = 12) -> Inner:
    """Small random vectors; biases are the log-shares inside the bucket."""
    rng = np.random.default_rng(seed)
    share = vocabulary.entry_count / np.add.reduceat(vocabulary.entry_count, vocabulary.start[:-1])[vocabulary.bucket]
    small = lambda *shape: (rng.standard_normal(shape) * 0.05).astype(np.float32)
    return Inner(small(vocabulary.v + 3, INNER), small(len(share), INNER), np.log(share).astype(np.float32))


def descend_inner(model: Inner, start: np.ndarray, noise: np.ndarray, before: np.ndarray, entry: np.ndarray, weight: np.ndarray, rng: np.random.Generator, squares: list[np.ndarray], rate: float = 0.05) -> None:
    """Noise-contrastive steps inside the buckets, with noise from the same bucket; step sizes fall with the gradients seen.

    ``noise`` holds each entry's share of its bucket; examples are sorted by entry, so buckets follow each other."""
    weight = weight / weight.mean()
    edges = np.searchsorted(entry, start)
    for j in rng.permutation(len(start) - 1):
        low, high = int(start[j]), int(start[j + 1])
        if high - low < 2 or edges[j] == edges[j + 1]:
            continue
        grown = np.cumsum(noise[low:high])
        shift = np.log(INNER_NOISE * noise[low:high]).astype(np.float32)
        out, bias = model.entries[low:high], model.bias[low:high]
        order = rng.permutation(np.arange(edges[j], edges[j + 1]))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            b, w, share = before[pick], entry[pick] - low, weight[pick]
            k = np.minimum(np.searchsorted(grown, rng.random(INNER_NOISE) * grown[-1]), high - low - 1)
            h = model.context[b]
            ow, ok = out[w], out[k]
            dg, db = _pulls(np.einsum("ij,ij->i", h, ow) + (bias - shift)[w], h @ ok.T + (bias - shift)[k], share)
            go, gb = _gathered(w, dg[:, None] * h, high - low), np.bincount(w, dg, high - low).astype(np.float32)
            np.add.at(go, k, db.T @ h)
            np.add.at(gb, k, db.sum(axis=0))
            gc = _gathered(b, dg[:, None] * ow + db @ ok, len(model.context))
            for p, g, q in ((model.context, gc, squares[0]), (out, go, squares[1][low:high]), (bias, gb, squares[2][low:high])):
                g /= len(pick)
                q += g * g
                p += rate * g / (np.sqrt(q) + 1e-4)


def pack_documents(rows: DataFrame, vocabulary: Vocabulary, units: int) -> DataFrame:
    """(unit, mark, doc_id, held_out, codes, tail, times) of (doc_id, held_out, text) rows, sorted by unit and mark: the codes of a
    text's words, and its distinct words without a vector with their counts. Unit and mark of what is learnt from follow from id
    and text; other rows are dealt in turn."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, press, turn = vocabulary.encoder(), zstandard.ZstdCompressor(level=1), 0
        is_rare = vocabulary.is_rare
        for batch in batches:
            marks, codes, tails, times = [], [], [], []
            for key, held, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = t.as_py()
                turn += 1
                marks.append(turn if held else xxhash.xxh3_64_intdigest(f"{key}:{text}".encode("utf-8", "surrogatepass")) >> 1)
                words = words_of(text)
                own = encode(words)
                tail = Counter(words[i] for i in np.flatnonzero(is_rare[own]).tolist())
                codes.append(press.compress(own.tobytes()))
                tails.append(b" ".join(tail))
                times.append(list(tail.values()))
            unit = pa.array([m % units for m in marks], pa.int64())
            columns = [unit, pa.array(marks, pa.int64()), batch.column(0), batch.column(1), pa.array(codes, pa.binary()), pa.array(tails, pa.string()), pa.array(times, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["unit", "mark", "doc_id", "held_out", "codes", "tail", "times"])
        tidy()

    schema = f"unit long, mark long, doc_id {kind}, held_out boolean, codes binary, tail string, times array<int>"
    return rows.mapInArrow(run, schema).repartition("unit").sortWithinPartitions("unit", "mark")


def train(packed: DataFrame, vocabulary: Vocabulary, units: int, rounds: int = ROUNDS) -> tuple[Model, Inner]:
    """Every round each unit trains on the windows of its documents, from the same models, and the results are averaged by tokens.

    Every window of a chunk takes part with its count as the weight of its gradient, so the work follows the number of different
    windows, plus one example for MOST_WEIGHT repeats. Only rows of the size of the models reach the driver, one a round.
    """
    unigram = vocabulary.unigram()
    outer, inner = start_model(unigram), start_inner(vocabulary)
    v, k, start = vocabulary.v, vocabulary.singles, vocabulary.start
    noise = unigram / unigram.sum()
    share = vocabulary.entry_count / np.add.reduceat(vocabulary.entry_count, start[:-1])[vocabulary.bucket]
    class_of, entries = vocabulary.class_of, len(vocabulary.bucket)
    flat = lambda outer, inner: np.concatenate([p.ravel() for p in (*outer.parts(), *inner.parts())])

    def filled(values: np.ndarray) -> tuple[Model, Inner]:
        own = outer.filled(values)
        parts, at = [], sum(p.size for p in own.parts())
        for p in inner.parts():
            parts.append(values[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return own, Inner(*parts)

    def learn(begin: np.ndarray, nth: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unit, unpress = None, zstandard.ZstdDecompressor()
            total, weight = np.zeros(0), 0.0
            waiting: list[np.ndarray] = []
            held = 0

            def step() -> None:
                codes = waiting
                a, b, w, n = windows([class_of[c] for c in codes], v)
                x, y, z, m = examples(a, b, w, v)
                order = rng.permutation(len(z))
                descend(own, noise, x[order], y[order], z[order], rng, state, weight=m[order])
                every = np.concatenate([np.append(c, 0) for c in codes])
                at = np.flatnonzero((every >= k) & (w != v + 1))
                if len(at):
                    key, m = weighted((every[at].astype(np.int64) - k) * (v + 3) + b[at])
                    descend_inner(deep, start, share, key % (v + 3), key // (v + 3), m, rng, squares)

            def ended() -> None:
                nonlocal total, weight
                if waiting:
                    step()
                if seen:
                    total = (total if len(total) else np.zeros(len(begin))) + flat(own, deep).astype(np.float64) * seen
                    weight += seen

            seen = 0
            for batch in batches:
                for u, packed in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                    if u != unit:
                        ended()
                        unit, waiting, held, seen = u, [], 0, 0
                        own, deep = filled(begin)
                        rng = np.random.default_rng([nth, u])
                        state = {"m1": [np.zeros_like(p) for p in own.parts()], "m2": [np.zeros_like(p) for p in own.parts()], "t": [np.zeros(1)]}
                        squares = [np.zeros_like(p) for p in deep.parts()]
                    waiting.append(np.frombuffer(unpress.decompress(packed.as_py()), np.int32))
                    held += len(waiting[-1]) + 1
                    seen += len(waiting[-1]) + 1
                    if held >= TOKENS_A_CHUNK:
                        step()
                        waiting, held = [], 0
            ended()
            if weight:
                yield pa.RecordBatch.from_arrays([pa.array([unit]), pa.array([weight]), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], names=["unit", "weight", "model"])
            tidy()

        return run

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight, unit = np.zeros(0), 0.0, 0
        for batch in batches:
            for u, w, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                m = np.frombuffer(m.as_buffer(), np.float32) * w
                total, weight, unit = total + m if len(total) else m, weight + w, u
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array([unit]), pa.array([weight]), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], names=["unit", "weight", "model"])

    schema = "unit long, weight double, model binary"
    packed = packed.filter(~F.col("held_out")).select("unit", "mark", "codes")
    for nth in range(rounds):
        models = packed.mapInArrow(learn(flat(outer, inner), nth), schema)
        # A tree of sums: about the root of their number in each task.
        parts = models.repartition(max(2, ceil(units**0.5)), "unit").sortWithinPartitions("unit").mapInArrow(add, schema)
        got = parts.repartition(1).sortWithinPartitions("unit").mapInArrow(add, schema).collect()
        if got:
            outer, inner = filled(np.frombuffer(got[0]["model"], np.float32))
    return outer, inner


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, unit_tokens: int = UNIT_TOKENS, model: bool = True) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (which is left out without
    ``model``, and then nothing is trained).

    Base and model learn from the rows that are not held out. ``score`` is the log10 probability of the text's words and its
    end. Null text counts as empty (one token, the end); a null id is held out; repeated rows stay, and are counted each; an
    empty table gives no rows; other columns are not looked at. Without training rows every word is unknown.
    """
    rows = bounded(docs).select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = materialize(count_words(rows.filter(~F.col("held_out")).select("text")))
    seen = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
    tokens, words = int(seen["tokens"] or 0), int(seen["words"])
    is_word = F.col("word") != ""
    ends = counts.filter(~is_word).first()
    ends = int(ends["n"]) if ends else 0
    # Head words number 1 / HEAD_SHARE at most, and their bytes that many times the mean of a token.
    in_head = F.col("n") >= max(HEAD_COUNT, tokens * HEAD_SHARE)
    head_rows = counts.filter(in_head & is_word).toPandas().sort_values(["n", "word"], ascending=[False, True], kind="stable")
    tail_counts = counts.filter(~in_head & is_word).withColumn("bucket", bucket_column(F.col("word")))

    # Tokens and words without a vector in every bucket, and the discount that leaves room for words never seen.
    shares = materialize(tail_counts.groupBy("bucket").agg(F.sum("n").alias("tokens"), F.count("*").alias("words"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")))
    by = shares.collect()
    n1, n2 = (sum(r[c] for r in by) for c in ("n1", "n2"))
    cut = n1 / (n1 + 2 * n2) if n1 else 0.5
    rare = np.zeros(BUCKETS)
    for r in by:
        rare[r["bucket"]] = r["tokens"]
    vocabulary = Vocabulary([w.encode("utf-8", "surrogatepass") for w in head_rows["word"]], head_rows["n"].to_numpy(float), ends, rare)
    units = max(1, ceil(tokens / unit_tokens))
    packed = materialize(pack_documents(rows, vocabulary, units)).withColumn("row", F.monotonically_increasing_id())
    v, k, class_of, is_rare = vocabulary.v, vocabulary.singles, vocabulary.class_of, vocabulary.is_rare
    if model:
        outer, inner = train(packed, vocabulary, units, rounds)
        one, two = outer.contexts()
        logz, outputs, bias = outer.sums(), outer.outputs, outer.bias
        inner_logz = inner.sums(vocabulary.start)
    bucket = vocabulary.bucket

    total = log10(tokens + SMOOTH * (words + 1))
    base_of = np.zeros(len(class_of))
    base_of[vocabulary.code] = np.log10(vocabulary.counts + SMOOTH) - total
    base_end = log10(ends + SMOOTH) - total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()

        def modelled(codes: list[np.ndarray], code: np.ndarray, n: np.ndarray) -> np.ndarray:
            a, b, w, places = windows([class_of[c] for c in codes], v)
            first = np.cumsum(places) - places
            logp = np.empty(len(w))
            every = np.insert(code, np.cumsum(n), -1)  # the ends
            for i in range(0, len(w), TOKENS_A_BLOCK):
                s = slice(i, i + TOKENS_A_BLOCK)
                h = one[b[s]]
                h += two[a[s]]
                logp[s] = np.einsum("ij,ij->i", h, outputs[w[s]]) + bias[w[s]] - logz[a[s], b[s]]
                at = np.flatnonzero(every[s] >= k)
                entry, before = every[s][at] - k, b[s][at]
                logp[i + at] += np.einsum("ij,ij->i", inner.context[before], inner.entries[entry]) + inner.bias[entry] - inner_logz[before, bucket[entry]]
            return np.add.reduceat(logp, first) / log(10)

        def block(part: pa.RecordBatch, codes: list[np.ndarray]) -> pa.RecordBatch:
            n = np.array([len(c) for c in codes], np.int64)
            code = np.concatenate(codes)
            edge = np.concatenate(([0], np.cumsum(n)))
            sums = lambda x: (c := np.concatenate(([0.0], np.cumsum(x))))[edge[1:]] - c[edge[:-1]]
            known = sums(~is_rare[code]).astype(np.int64) + (ends > 0)
            columns = [part.column(0), part.column(1), part.column(2), pa.array(n + 1), pa.array(known), pa.array(sums(base_of[code]) + base_end), pa.array(modelled(codes, code, n) if model else np.zeros(len(n)))]
            return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "head_score"])

        for batch in batches:
            codes, start, size = [], 0, 0
            for i, packed in enumerate(batch.column(3)):
                codes.append(np.frombuffer(unpress.decompress(packed.as_py()), np.int32))
                size += len(codes[-1]) + 1
                if size >= TOKENS_A_BLOCK or i + 1 == batch.num_rows:
                    yield block(batch.slice(start, i + 1 - start), codes)
                    codes, start, size = [], i + 1, 0
        tidy()

    half = packed.select("row", "doc_id", "held_out", "codes").mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, head_known long, head_base double, head_score double")
    # One row for a word of a document, however often it is there.
    lookups = packed.filter(F.col("tail") != "").select("row", F.inline(F.arrays_zip(F.split("tail", " ").alias("word"), F.col("times"))))
    n, times = F.coalesce(F.col("n"), F.lit(0)), F.col("times")
    found = lookups.join(tail_counts.select("word", "n").hint("shuffle_hash"), "word", "left").withColumn("bucket", bucket_column(F.col("word")))
    found = found.join(F.broadcast(shares.select("bucket", "tokens", "words")), "bucket", "left")
    # In a bucket without such words all of the entry's mass is the unknown word's.
    share = F.when(n > 0, n - F.lit(float(cut))).otherwise(F.lit(float(cut)) * F.col("words")) / F.col("tokens")
    tails = found.groupBy("row").agg(
        F.sum(F.when(n > 0, times).otherwise(0).cast("long")).alias("known"),
        F.sum(times * (F.log10(n + SMOOTH) - F.lit(total))).alias("base"),
        F.sum(times * F.coalesce(F.log10(F.greatest(share, F.lit(1e-12))), F.lit(0.0))).alias("rare"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    scored = half.join(tails, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + zero("known")).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + zero("base")).alias("base_score"), (F.col("head_score") + zero("rare")).alias("score"),
    )
    return scored if model else scored.drop("score")
