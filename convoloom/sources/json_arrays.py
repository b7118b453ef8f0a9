"""Large JSON arrays in parts: a file is read by as many tasks as it has splits, and written as files that are arrays each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import last_wins

#: Kinds of pieces: an item within a split; what precedes a split's first item border, and follows its last; a split without one.
WHOLE, HEAD, TAIL, MIDDLE = range(4)
SUMMARY = "file string, start long, quotes int, outside long, inside long, first string"
PIECES = "file string, start long, n long, kind int, piece binary"


def structure(text: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Of the bytes of JSON text: by how much each changes the depth, which are commas outside of strings, and the number of quotes.

    ``inside`` is 1 if the text begins within a string. A quote after an odd number of backslashes is part of a string.
    """
    quote = text == ord('"')
    back = text == ord("\\")
    if back.any():
        at = np.arange(len(text))
        other = np.maximum.accumulate(np.where(back, -1, at))
        at = np.flatnonzero(quote)
        at = at[(at > 0) & back[at - 1]]
        quote[at[(at - 1 - other[at - 1]) % 2 == 1]] = False
    outside = (np.cumsum(quote) + inside) % 2 == 0
    opened, closed = (text == ord("{")) | (text == ord("[")), (text == ord("}")) | (text == ord("]"))
    return np.where(outside, opened.astype(np.int8) - closed, 0), outside & (text == ord(",")), int(quote.sum())


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes, pa.RecordBatch]]:
    """(split, text, batch) of consecutive rows of a split; each record is followed by the comma that it was cut at."""
    for b in batches:
        files, starts = b.column("file").to_pylist(), b.column("start").to_numpy()
        new = np.flatnonzero([i == 0 or files[i] != files[i - 1] or starts[i] != starts[i - 1] for i in range(len(files))])
        for low, high in zip(new, [*new[1:], len(files)], strict=True):
            part = b.slice(low, high - low)
            yield (files[low], int(starts[low])), b",".join(part.column("value").to_pylist()) + b",", part


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split the parity of its quotes, and its change of depth if it begins outside or inside of a string."""
    found: dict[tuple[str, int], list] = {}
    for split, text, _ in _splits(batches):
        s = found.setdefault(split, [0, 0, 0, text.lstrip(b"\xef\xbb\xbf \t\r\n,")[:1].decode("latin-1")])
        bytes_ = np.frombuffer(text, np.uint8)
        for inside in (0, 1):
            steps, _, quotes = structure(bytes_, (inside + s[0]) % 2)
            s[1 + inside] += int(steps.sum())
        s[0] = (s[0] + quotes) % 2
    rows = [(*split, *s) for split, s in found.items()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True)], SUMMARY.replace(" string", "").replace(" long", "").replace(" int", "").split(", "))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts every split at the commas of depth 1, given the state that it begins in."""
    split, rest, n = None, [], 0
    depth = inside = 0

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "start", "n", "kind", "piece"])

    def last() -> tuple:
        return (*split, n, TAIL if n else MIDDLE, b"".join(rest))

    for now, text, part in _splits(batches):
        rows = []
        if now != split:
            if split:
                rows.append(last())
            split, rest, n = now, [], 0
            inside, depth = part.column("in_string")[0].as_py(), part.column("depth")[0].as_py()
        steps, commas, quotes = structure(np.frombuffer(text, np.uint8), inside)
        borders = np.flatnonzero(commas & (depth + np.cumsum(steps, dtype=np.int64) == 1))
        inside, depth = (inside + quotes) % 2, depth + int(steps.sum())
        at = 0
        for border in borders.tolist():
            rest.append(text[at:border])
            rows.append((*split, n, WHOLE if n else HEAD, b"".join(rest)))
            rest, n, at = [], n + 1, border + 1
        rest.append(text[at:])
        if rows:
            yield batch(rows)
    if split:
        yield batch([last()])


def array_items(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, value): the JSON text of every item of the arrays at ``path``, a file, folder or pattern.

    Spark cuts files at commas into splits as it cuts lines. One pass gives each split's quotes and brackets, running sums over the
    splits of a file give the state that each begins in, and a second pass cuts the splits at the commas between items. Only the pieces at
    both ends of a split are shuffled, to be joined. ``position`` rises with the place in the file. A task holds a split's current batch and
    item. Files that hold no array, or nothing, give no rows; of broken JSON the rows are whatever lies between such commas.
    """
    lines = spark.read.option("lineSep", ",").text(path)
    lines = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    found = lines.mapInArrow(_summaries, SUMMARY)
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("in_string", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")).withColumn("delta", F.when(F.col("in_string") == 1, F.col("inside")).otherwise(F.col("outside")))
    states = found.select("file", "start", "in_string", F.coalesce(F.sum("delta").over(before), F.lit(0)).cast("long").alias("depth"), (F.first("first").over(order) == "[").alias("is_list"))
    known = lines.join(F.broadcast(states), ["file", "start"], "left").filter(F.coalesce("is_list", F.raise_error(F.lit("splits of a file changed between two readings")).cast("boolean")))
    pieces = known.select("value", "file", "start", "in_string", "depth").mapInArrow(_pieces, PIECES)
    inner = pieces.filter(F.col("kind") == WHOLE).select("file", (F.col("start") + F.col("n")).alias("position"), F.col("piece").cast("string").alias("value"))
    ends = pieces.filter(F.col("kind") != WHOLE).withColumn("begins", (F.col("kind") == TAIL).cast("int"))
    line = Window.partitionBy("file").orderBy("start", "begins").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("item", F.sum("begins").over(line))
    whole = ends.groupBy("file", "item").agg(F.array_sort(F.collect_list(F.struct("start", "begins", "n", "piece"))).alias("x"))
    text = F.aggregate(F.transform("x", lambda p: p["piece"].cast("string")), F.lit(""), lambda a, b: F.concat(a, b))
    first = F.when(F.col("item") == 0, F.regexp_replace(text, r"^[﻿\s]*\[", "")).otherwise(text)
    newest = F.max("item").over(Window.partitionBy("file"))
    joined = whole.withColumn("newest", newest).select(
        "file", (F.col("x")[0]["start"] + F.when(F.col("item") == 0, 0).otherwise(F.col("x")[0]["n"])).alias("position"),
        F.when(F.col("item") == F.col("newest"), F.regexp_replace(first, r"\]\s*,?\s*$", "")).otherwise(first).alias("value"),
    )
    return inner.unionByName(joined).filter(F.length(F.trim("value")) > 0)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str, position: str = "position") -> DataFrame:
    """The items of the arrays at ``path`` as rows of ``schema``, with their ``position``; items of another form are rows of nulls."""
    items = array_items(spark, path).select(F.col("position").alias(position), F.from_json("value", schema).alias("__r"))
    return items.select("__r.*", position)


def read_keyed_array(spark: SparkSession, path: str, schema: T.StructType | str, key: str = "id") -> DataFrame:
    """One row a key of the array in one file; the last item with a key wins, items without one go."""
    rows = read_json_array(spark, path, schema, "__at")
    return last_wins(rows.filter(F.col(key).isNotNull()), key, "__at").drop("__at")


def write_json_array(df: DataFrame, path: str, value: Column | None = None) -> None:
    """K9: a folder of text files each of which is a JSON array of its partition's rows, an item a line; readers take them as one. Spark's
    commit makes them visible together. ``value`` is the JSON text of a row, and all its columns stand in for it."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])) if value is None else value

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mark = None, "["
        for b in batches:
            items = b.column("value").to_pylist()
            if not items:
                continue
            if held is not None:
                items.insert(0, held)
            out, held = [x + "," for x in items[:-1]], items[-1]
            if out:
                out[0], mark = mark + out[0], ""
                yield pa.RecordBatch.from_arrays([pa.array(out)], ["value"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([f"{mark}{held}]"])], ["value"])

    df.select(text.alias("value")).filter(F.col("value").isNotNull()).mapInArrow(lines, "value string").write.mode("overwrite").text(path)
