"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text, cut at quantiles of each language.

Tokens are UTF-16 units, so an n-gram of ORDER of them is one long and every script is told apart. Counts of the trusted text
stay in tables that are sharded by n-gram. Documents are read in units of about UNIT_CHARS characters; the distinct n-grams of a
unit are joined to the counts, and what they get meets the unit's texts, compressed, in a shuffle by unit. No table is sent to
all workers but those with a row for each token at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .memory import bounded, tidy

ORDER, BITS = 4, 16
#: Characters of a unit, and those handled in one array operation.
UNIT_CHARS, CHARS_A_BLOCK = 8_000_000, 250_000
#: Distinct n-grams held in a task before they are handed on, and rows of a batch that leaves a worker.
GRAMS_A_FLUSH, ROWS_A_BATCH = 1_000_000, 100_000
#: Characters of average text that are mixed into a document's mean, which steadies short ones.
PRIOR_CHARS = 200
#: The cut: this quantile of each language's trusted rows that the model has not seen, one in HELD_OUT. Its distance from the
#: median is drawn up to that of all languages with the weight of so many rows, for languages with few.
QUANTILE, HELD_OUT, PRIOR_ROWS = 0.99, 3, 20
#: Lists up to so many rows are broadcast; larger ones are joined by a shuffle, by language in SALTS parts.
MOST_IDS_BROADCAST, MOST_LANGUAGES_BROADCAST, SALTS = 1_000_000, 10_000, 32


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each token and at each text's end, and the number of these places of each text."""
    pad = "\0" * (ORDER - 1)
    coded = [t.replace("\0", "\1").encode("utf-16-le", "surrogatepass") for t in texts]
    n = np.array([len(c) // 2 + 1 for c in coded], np.int64)
    edge = (pad + "\0").encode("utf-16-le")
    u = np.frombuffer(edge[2:] + edge.join(coded) + edge[:2], np.uint16).astype(np.uint64)
    key = np.zeros(len(u) - ORDER + 1, np.uint64)
    for j in range(ORDER):
        key = key << np.uint64(BITS) | u[j : len(u) - ORDER + 1 + j]
    first = np.cumsum(n + ORDER - 1) - n - (ORDER - 1)
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return key[at].view(np.int64), n


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block: list[str] = []
    size = 0
    for t in texts:
        block.append(t)
        size += len(t) + 1
        if size >= CHARS_A_BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def count_grams(texts: DataFrame) -> DataFrame:
    """(gram, n) of all texts: each task's distinct ones, summed by gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(key), ROWS_A_BATCH):
                part = slice(at, at + ROWS_A_BATCH)
                yield pa.RecordBatch.from_arrays([pa.array(key[part]), pa.array(n[part])], names=["gram", "n"])

        for batch in batches:
            for block in _blocks(_texts(batch.column(0))):
                own, c = np.unique(grams(block)[0], return_counts=True)
                key, back = np.unique(np.concatenate((key, own)), return_inverse=True)
                n = np.bincount(back, np.concatenate((n, c)), len(key)).astype(np.int64)
                if len(key) > GRAMS_A_FLUSH:
                    yield from flush()
                    key, n = key[:0], n[:0]
        yield from flush()
        tidy()

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney from how many n-grams have a count of 1 to 4."""
    few = level.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in few)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    return [float(np.clip(i - (i + 1) * y * b / a, 0, i)) if a else 0.0 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def gram_logs(counts: DataFrame, needed: DataFrame) -> DataFrame:
    """(gram, logp): natural log-probability of the last token of every needed gram.

    Each order's counts join the distinct needed n-grams of that order by n-gram and by context; the lowest falls back on equal
    shares of all tokens. Tables of single tokens have 2 ** BITS rows at most and are broadcast.
    """
    tail = lambda k: F.col("gram") if k == ORDER else F.col("gram").bitwiseAND((1 << (BITS * k)) - 1)
    levels = {ORDER: counts.select("gram", "n")}
    wanted = {ORDER: needed.select("gram").distinct()}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = materialize(levels[k + 1].groupBy(tail(k).alias("gram")).agg(F.count("*").alias("n")))
        wanted[k] = wanted[k + 1].select(tail(k).alias("gram")).distinct()
    lower = None
    for k in range(1, ORDER + 1):
        few = F.broadcast if k == 1 else lambda df: df
        d = _discounts(levels[k])
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        level = levels[k].withColumn("cut", cut)
        before = F.shiftrightunsigned("gram", BITS)
        context = level.groupBy(before.alias("before")).agg(F.sum("n").alias("total"), F.sum("cut").alias("spare"))
        context = F.broadcast(context) if k <= 2 else context
        own = level.select("gram", (F.col("n") - F.col("cut")).alias("rest"))
        out = wanted[k].withColumn("before", before).join(few(own), "gram", "left").join(context, "before", "left")
        if lower is None:
            out = out.withColumn("low", F.lit(1.0 / (1 << BITS)))
        else:
            lower = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("low"))
            out = out.withColumn("suffix", tail(k - 1)).join(F.broadcast(lower) if k == 2 else lower, "suffix")
        # With no discount at all (tiny corpora) a little mass still goes to the lower order.
        mass = F.when(F.col("spare") > 0, F.col("spare")).otherwise(0.5)
        seen = (F.coalesce("rest", F.lit(0.0)) + mass * F.col("low")) / (F.col("total") - F.col("spare") + mass)
        lower = out.select("gram", F.when(F.col("total").isNull(), F.col("low")).otherwise(seen).alias("p"))
        lower = materialize(lower)
    return lower.select("gram", F.log(F.greatest("p", F.lit(1e-30))).alias("logp"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and never labelled bad or toxic."""
    good = F.min((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
    return labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(good.alias("good")).filter("good").select("doc_id")


def unseen(doc_id: Column) -> Column:
    """Whether the model does not learn from a trusted row, which then takes part in the choice of thresholds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0


def train(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(gram, n) of the trusted text that the model learns from."""
    ids = materialize(trusted_ids(labels).filter(~unseen(F.col("doc_id"))))
    ids = F.broadcast(ids) if ids.count() <= MOST_IDS_BROADCAST else ids.hint("merge")
    texts = bounded(docs).select("doc_id", "text").filter(F.col("text").isNotNull())
    return materialize(count_grams(texts.join(ids, "doc_id", "left_semi").select("text")))


class _Unit:
    """Rows of one task up to UNIT_CHARS bytes of text. Its id follows from what it holds, so two passes over the same partitions
    give the same units, and units that share an id share their texts."""

    def __init__(self):
        self.rows: list[pa.RecordBatch] = []
        self.size = 0
        self.mark = xxhash.xxh3_64()

    def id(self) -> int:
        return self.mark.intdigest() - (1 << 63)


def _units(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[_Unit]:
    """The units of a task; their cuts do not depend on how rows come in batches."""
    unit = _Unit()
    for batch in batches:
        start = 0
        for i, (key, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(text_at), strict=True)):
            raw = t.as_buffer() if t.is_valid else b""
            unit.size += len(raw) + 1
            unit.mark.update(f"{key}:{len(raw)}:".encode())
            unit.mark.update(raw)
            if unit.size >= UNIT_CHARS:
                unit.rows.append(batch.slice(start, i + 1 - start))
                yield unit
                start, unit = i + 1, _Unit()
        if start < batch.num_rows:
            unit.rows.append(batch.slice(start))
    if unit.rows:
        yield unit


def unit_grams(rows: DataFrame) -> DataFrame:
    """(unit, grams) of rows (doc_id, lang, text): the distinct n-grams of every unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _units(batches, 2):
            own = np.zeros(0, np.int64)
            for part in unit.rows:
                for block in _blocks(_texts(part.column(2))):
                    own = np.union1d(own, grams(block)[0])
            offsets = pa.array(np.array([0, len(own)], np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([unit.id()]), pa.ListArray.from_arrays(offsets, pa.array(own))], names=["unit", "grams"])
        tidy()

    return rows.mapInArrow(run, "unit long, grams array<long>")


def _packed(rows: DataFrame) -> DataFrame:
    """(unit, rows): the rows of every unit as a compressed stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
        for unit in _units(batches, 2):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, unit.rows[0].schema, options=options) as out:
                out.write_table(pa.Table.from_batches(unit.rows).combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array([unit.id()]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["unit", "rows"])
        tidy()

    return rows.mapInArrow(run, "unit long, rows binary")


def score(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, lang, places, logp) of every row: the places of its text, its end among them, and their natural log-probability.

    The documents are read twice and have to come in the same partitions, as files do; an error says so if they do not."""
    rows = bounded(docs).select("doc_id", "lang", "text")
    asked = materialize(unit_grams(rows))
    logs = gram_logs(counts, asked.select(F.explode("grams").alias("gram")))
    none = lambda kind: F.lit(None).cast(kind)
    answers = asked.select("unit", F.explode("grams").alias("gram")).join(logs, "gram").select("unit", "gram", "logp", none("binary").alias("rows"))
    parts = answers.unionByName(_packed(rows).select("unit", none("long").alias("gram"), none("double").alias("logp"), "rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, keys, logs = None, [], []
        for batch in batches:
            # A unit's answers come before its rows; here are the places where one of both ends.
            ids = batch.column(0).to_numpy()
            full = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            stops = np.flatnonzero(np.r_[(ids[1:] != ids[:-1]) | full[1:] | full[:-1], True]) + 1
            for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True):
                if ids[a] != unit:
                    unit, keys, logs = ids[a], [], []
                if full[a]:
                    yield from scored(np.concatenate(keys or [np.zeros(0, np.int64)]), np.concatenate(logs or [np.zeros(0)]), batch.column(3)[a].as_buffer())
                else:
                    keys.append(batch.column(1).slice(a, b - a).to_numpy())
                    logs.append(batch.column(2).slice(a, b - a).to_numpy())
        tidy()

    def scored(keys: np.ndarray, logs: np.ndarray, packed: pa.Buffer) -> Iterator[pa.RecordBatch]:
        order = np.argsort(keys)
        keys, logs = keys[order], logs[order]
        for part in pa.ipc.open_stream(packed):
            places, logp = [np.zeros(0, np.int64)], [np.zeros(0)]
            for block in _blocks(_texts(part.column(2))):
                key, n = grams(block)
                own, back = np.unique(key, return_inverse=True)
                at = np.searchsorted(keys, own).clip(0, max(len(keys) - 1, 0))
                if not len(keys) or (keys[at] != own).any():
                    raise RuntimeError("the documents came in other partitions on a second reading; write them to a table first")
                total = np.concatenate(([0.0], np.cumsum(logs[at][back])))
                edge = np.cumsum(n)
                places.append(n)
                logp.append(total[edge] - total[edge - n])
            columns = [part.column(0), part.column(1), pa.array(np.concatenate(places)), pa.array(np.concatenate(logp))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", "places", "logp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    dealt = parts.repartition("unit").sortWithinPartitions("unit", F.col("rows").isNotNull())
    return dealt.mapInArrow(run, f"doc_id {kind}, lang string, places long, logp double")


def _beside(rows: DataFrame, by: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``by`` has for their language; a frequent language is spread over SALTS keys."""
    if by.count() <= MOST_LANGUAGES_BROADCAST:
        return rows.join(F.broadcast(by), "language", "left")
    by = by.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "places", "logp"), F.lit(SALTS)).cast("int")).join(by, ["language", "salt"], "left").drop("salt")


def judge(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """``scored`` rows with ``perplexity``, the ``threshold`` of their language and ``kept``.

    Means come from all trusted rows of a language, thresholds from those that the model has not seen (PRIOR_ROWS, QUANTILE); a
    language that lacks either takes that of all languages.
    """
    rows = scored.withColumn("language", F.coalesce(F.col("lang"), F.lit("")))
    ids = materialize(trusted_ids(labels))
    trusted = materialize(rows.join(F.broadcast(ids) if ids.count() <= MOST_IDS_BROADCAST else ids, "doc_id", "left_semi"))
    mean = (F.sum("logp") / F.sum("places")).alias("mean")
    means = materialize(trusted.groupBy("language").agg(mean))
    whole = trusted.agg(mean).first()["mean"]
    whole = F.lit(-1e9 if whole is None else float(whole))
    loss = -(F.col("logp") + PRIOR_CHARS * F.coalesce(F.col("mean"), whole)) / (F.col("places") + PRIOR_CHARS)
    fresh = trusted.filter(unseen(F.col("doc_id")))
    fresh = trusted if fresh.isEmpty() else fresh
    steady = materialize(_beside(fresh, means).withColumn("loss", loss))
    cuts = F.percentile_approx("loss", [0.5, QUANTILE], 10_000)
    own = materialize(steady.groupBy("language").agg(cuts.alias("q"), F.count("*").alias("n")).select("language", F.col("q")[0].alias("middle"), (F.col("q")[1] - F.col("q")[0]).alias("reach"), "n"))
    top = steady.agg(cuts.alias("q")).first()["q"] or [0.0, 1e9]
    pooled = _beside(steady, own).agg(F.percentile_approx(F.col("loss") - F.col("middle"), QUANTILE, 10_000).alias("q")).first()["q"]
    pooled = F.lit(float(pooled or 0.0))
    reach = (F.col("n") * F.col("reach") + PRIOR_ROWS * F.greatest("reach", pooled)) / (F.col("n") + PRIOR_ROWS)
    by = materialize(means.join(own.select("language", (F.col("middle") + reach).alias("limit")), "language", "left"))
    limit = F.coalesce(F.col("limit"), F.lit(float(top[1])))
    out = _beside(rows, by).withColumns({"loss": loss, "limit": limit})
    return out.withColumns({"perplexity": F.exp("loss"), "threshold": F.exp("limit"), "kept": F.col("loss") <= F.col("limit") + 1e-9}).drop("mean", "loss", "limit")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: doc_id, lang, n_chars, log10_probability, perplexity, threshold, kept.

    ``n_chars`` counts UTF-16 units. ``perplexity`` is per character, with PRIOR_CHARS characters of the language's average mixed
    in; a row is kept up to its language's threshold. Null text counts as empty, which is average and kept; null or untrusted
    languages take the threshold over all languages; without trusted text all is kept. Repeated rows stay; an empty table gives
    no rows; other columns are not looked at. Three scans of the documents.
    """
    got = judge(materialize(score(docs, train(docs, labels))), labels)
    log10 = (F.col("logp") / F.lit(float(np.log(10)))).alias("log10_probability")
    return got.select("doc_id", "lang", (F.col("places") - 1).alias("n_chars"), log10, "perplexity", "threshold", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``classify`` keeps.

    Nulls, repeats and empty tables as there. The verdict follows from text and language, so rows meet the texts that go by
    their digest and language: by broadcast up to a checked count, by a shuffle beyond it."""
    language, key = F.coalesce(F.col("lang"), F.lit("")), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    marked = docs.select(F.struct("doc_id", key.alias("key")).alias("doc_id"), "lang", "text")
    scored = materialize(score(marked, train(docs, labels)).withColumns({"key": F.col("doc_id.key"), "doc_id": F.col("doc_id.doc_id")}))
    gone = materialize(judge(scored, labels).filter(~F.col("kept")).select("key", "language").distinct())
    gone = F.broadcast(gone) if gone.count() <= MOST_IDS_BROADCAST else gone
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"), language.alias("language"))
    return rows.join(gone, ["key", "language"], "left_anti").select("row.*")
