"""Near-equal texts by a chosen-path join over word shingles.

Every set walks down a random tree: at a node it goes to the shared tokens whose hash under that node is small, so two sets meet
in a bucket only by sharing all tokens of its path. The walk is repeated RUNS times. The first EARLY runs, and then one text of
each cluster in every bucket, hang what looks alike (size and minwise sketch) together, so that a group of near copies is one
cluster before any bucket is searched. Buckets that still hold several clusters are compared outright if they are small, and
split by a further token otherwise. All pairs of distinct texts inside a cluster are then counted exactly, in blocks, with no
pair ever written out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..operators.components import forest as _forest
from ..session import materialize
from .memory import bounded, tidy

SHINGLE, SIMILARITY = 5, 0.8
#: Children a node has on average, depth of the tree, and the recall that the number of runs is set for.
BRANCHES, DEPTH, RECALL = 2.0, 3, 0.999999
#: Runs whose buckets are looked through first, at their first text only.
EARLY = 2
#: Buckets up to this size are compared outright.
SMALL = 64
#: Bytes of a sketch, and how many have to agree: a pair at the least similarity falls below with probability under 1e-6.
SKETCH, AGREE = 48, 24
#: Texts of a block when a large bucket or cluster is compared block by block.
BUCKET_BLOCK, CLUSTER_BLOCK = 2048, 1024
#: Rows up to which a list is broadcast; beyond, it is joined by a shuffle.
MOST_BROADCAST = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20240117)
_MULTIPLY = _RNG.integers(0, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, SKETCH, dtype=np.uint64)


def runs_for(recall: float = RECALL, similarity: float = SIMILARITY, branches: float = BRANCHES, depth: int = DEPTH) -> int:
    """Runs after which a pair at the least similarity has met at the deepest level with the given probability.

    Such a pair shares at least ``similarity`` of the larger set, so a shared node has that share of its ``branches`` children
    in common on average; the chance to reach a level follows from the one before (a branching process)."""
    reach = 1.0
    for _ in range(depth):
        reach = 1 - exp(-branches * similarity * reach)
    return ceil(log(1 - recall) / log(1 - reach))


RUNS = runs_for()
_ROOTS = _RNG.integers(0, 2**63, RUNS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's runs of SHINGLE words; a shorter text is one run, a text without words none."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    code = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        out = _mix(out ^ code[j : j + len(out)]) + _ODD
    return np.unique(_mix(out))


def sketch(s: np.ndarray) -> bytes:
    """One byte of each of SKETCH minwise hashes."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        least = np.minimum(least, (s[at : at + 4096, None] * _MULTIPLY + _ADD).min(axis=0))
    return ((least >> np.uint64(20)) & np.uint64(255)).astype(np.uint8).tobytes()


def paths(s: np.ndarray, depth: int = DEPTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level the nodes reached and the place of each one's parent among the nodes of the level before."""
    out = []
    nodes = _ROOTS
    limit = np.uint64(min(2**64 - 1, int(2**64 * min(1.0, BRANCHES / max(len(s), 1)))))
    for _ in range(depth):
        parent, token = [], []
        step = max(1, 2_000_000 // max(len(s), 1))
        for at in range(0, len(nodes), step):
            p, t = np.nonzero(((s[None, :] ^ nodes[at : at + step, None]) * _ODD) <= limit)
            parent.append(p + at)
            token.append(t)
        parent, token = np.concatenate(parent) if parent else np.zeros(0, np.int64), np.concatenate(token) if token else np.zeros(0, np.int64)
        nodes = _mix(_mix(nodes[parent] + _ODD) ^ s[token])
        out.append((nodes, parent))
    return out


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else [], kind))


def _new(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """(rid, shingles) of the texts with words, up to 1000 at a time; a task passes over texts that it has just seen."""
    seen: set[int] = set()
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part, out = batch.slice(at, 1000), []
            for rid, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                if rid not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    seen.add(rid)
                    s = shingle_set(text.as_py())
                    if len(s):
                        out.append((rid, s))
            yield out


def _features(rows: DataFrame) -> DataFrame:
    """(rid, n, sketch, early, p1) of the distinct texts: the buckets of the first level, those of the EARLY runs in front."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _new(batches):
            walks = [paths(s, 1)[0] for _, s in texts]
            columns = [
                pa.array([rid for rid, _ in texts], pa.int64()), pa.array([len(s) for _, s in texts], pa.int32()), pa.array([sketch(s) for _, s in texts], pa.binary()),
                pa.array([int((root < EARLY).sum()) for _, root in walks], pa.int32()), _lists([nodes.view(np.int64) for nodes, _ in walks], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["rid", "n", "sketch", "early", "p1"])
        tidy()

    return rows.mapInArrow(run, "rid long, n int, sketch binary, early int, p1 array<long>").dropDuplicates(["rid"])


def _deep(rows: DataFrame) -> DataFrame:
    """(rid, level, above, path) of the texts: their nodes below the first level, each with its parent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _new(batches):
            for k in range(1, DEPTH):
                walks = [(rid, walk[k - 1][0], *walk[k]) for rid, walk in ((rid, paths(s, k + 1)) for rid, s in texts)]
                if walks:
                    ids = np.repeat(np.array([w[0] for w in walks], np.int64), [len(w[2]) for w in walks])
                    above = np.concatenate([before[parent] for _, before, _, parent in walks]).view(np.int64)
                    nodes = np.concatenate([w[2] for w in walks]).view(np.int64)
                    level = np.full(len(ids), k + 1, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(level), pa.array(above), pa.array(nodes)], names=["rid", "level", "above", "path"])
        tidy()

    return rows.mapInArrow(run, "rid long, level int, above long, path long")


def _alike(n1: np.ndarray, s1: np.ndarray, n2: np.ndarray, s2: np.ndarray) -> np.ndarray:
    """Whether two lists of equal length pass the size and sketch filter, place by place."""
    small, large = np.minimum(n1, n2), np.maximum(n1, n2)
    return (small >= SIMILARITY * large) & ((s1 == s2).sum(axis=1) >= AGREE)


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["src", "dst"])


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def _compare_small(rows: DataFrame) -> DataFrame:
    """Edges between the clusters in the buckets of ``rows`` (path, cluster, n, sketch), each of which has at most about SMALL texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def edges(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            path, cluster, n = (t.column(i).to_numpy() for i in range(3))
            marks = _sketches(t.column(3))
            a, b = [], []
            d = 1
            at = np.arange(len(path))
            while True:
                at = at[at + d < len(path)]
                at = at[path[at] == path[at + d]]
                if not len(at):
                    break
                own = at[cluster[at] != cluster[at + d]]
                for i in range(0, len(own), 200_000):
                    p = own[i : i + 200_000]
                    hit = p[_alike(n[p], marks[p], n[p + d], marks[p + d])]
                    a.append(cluster[hit])
                    b.append(cluster[hit + d])
                d += 1
            return _edge_batch(*_forest(np.concatenate(a) if a else np.zeros(0, np.int64), np.concatenate(b) if b else np.zeros(0, np.int64)))

        for batch in batches:
            t = pa.Table.from_batches([batch])
            if rest is not None:
                t = pa.concat_tables([rest, t])
            last = t.column(0)[t.num_rows - 1].as_py()
            path = t.column(0).to_numpy()
            cut = int(np.searchsorted(path, last)) if len(path) else 0  # rows are sorted by path
            rest = t.slice(cut)
            if cut:
                yield edges(t.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield edges(rest)
        tidy()

    return rows.repartition("path").sortWithinPartitions("path", "cluster").mapInArrow(run, "src long, dst long")


def _compare_blocks(rows: DataFrame) -> DataFrame:
    """Edges between the clusters of probes and members of (path, mb, pb) groups; ``probe`` tells which a row is. What a group has
    joined counts as one cluster for the rest of it, so it gives fewer edges than it has clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def edges(t: pa.Table) -> Iterator[pa.RecordBatch]:
            t = t.combine_chunks()
            n, probe = t.column(4).to_numpy(), t.column(6).to_numpy(zero_copy_only=False)
            ids, own = np.unique(t.column(3).to_numpy(), return_inverse=True)
            marks = _sketches(t.column(5))
            members, probes = np.flatnonzero(~probe), np.flatnonzero(probe)
            root = np.arange(len(ids))
            for at in range(0, len(probes), 64):
                p = probes[at : at + 64]
                same = np.zeros((len(p), len(members)), np.uint8)
                for j in range(SKETCH):
                    same += marks[p, j][:, None] == marks[members, j][None, :]
                joined = root[own]
                hit = (same >= AGREE) & (np.minimum(n[p][:, None], n[members]) >= SIMILARITY * np.maximum(n[p][:, None], n[members])) & (joined[p][:, None] != joined[members])
                x, y = np.nonzero(hit)
                moved, to = _forest(joined[p[x]], joined[members[y]])
                step = np.arange(len(ids))
                step[moved] = to
                root = step[root]
            moved = np.flatnonzero(root != np.arange(len(ids)))
            if len(moved):
                yield _edge_batch(ids[moved], ids[root[moved]])

        def groups(t: pa.Table, final: bool) -> tuple[list[pa.Table], pa.Table]:
            keys = [t.column(i).to_numpy() for i in range(3)]
            new = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]) if t.num_rows else np.zeros(0, np.int64)
            stops = [*new[1:].tolist(), t.num_rows]
            done = [t.slice(a, b - a) for a, b in zip(new.tolist(), stops, strict=True)]
            return (done, t.slice(0, 0)) if final else (done[:-1], done[-1] if done else t)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            done, rest = groups(t if rest is None else pa.concat_tables([rest, t]), False)
            for g in done:
                yield from edges(g)
        if rest is not None and rest.num_rows:
            for g in groups(rest, True)[0]:
                yield from edges(g)
        tidy()

    return rows.repartition("path", "mb", "pb").sortWithinPartitions("path", "mb", "pb").mapInArrow(run, "src long, dst long")


def _like(n1: str, s1: str, n2: str, s2: str):
    """The size and sketch filter as a column."""

    @F.pandas_udf("boolean")
    def like(n1, s1, n2, s2):
        import pandas as pd

        join = lambda s: np.frombuffer(b"".join(s), np.uint8).reshape(-1, SKETCH)
        return pd.Series(_alike(n1.to_numpy(), join(s1), n2.to_numpy(), join(s2)))

    return like(n1, s1, n2, s2)


def _few(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if there are at most MOST_BROADCAST."""
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows


def _with_clusters(feat: DataFrame, clusters: DataFrame) -> DataFrame:
    """``feat`` with the cluster of each text; a text that nothing hangs on is its own."""
    return feat.join(_few(clusters), "rid", "left").withColumn("cluster", F.coalesce("cluster", "rid"))


def _clusters(edges: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(rid, cluster) after ``edges`` have joined the clusters before."""
    if before is not None:
        edges = edges.unionByName(before.select(F.col("rid").alias("src"), F.col("cluster").alias("dst")))
    return materialize(connected_components(edges).select(F.col("id").alias("rid"), F.col("component").alias("cluster")))


def _first_stars(feat: DataFrame) -> DataFrame:
    """Edges from the texts of the EARLY runs' buckets to the first text there, where they look like it."""
    rows = feat.select("rid", "n", "sketch", F.explode(F.slice("p1", 1, F.col("early"))).alias("path"))
    first = rows.groupBy("path").agg(F.count("*").alias("c"), F.min(F.struct("rid", "n", "sketch")).alias("first")).filter("c > 1").drop("c")
    near = rows.join(_few(materialize(first)), "path").filter(F.col("rid") != F.col("first.rid"))
    return near.filter(_like("n", "sketch", "first.n", "first.sketch")).select(F.col("rid").alias("src"), F.col("first.rid").alias("dst"))


def _cluster_stars(feat: DataFrame, clusters: DataFrame) -> DataFrame:
    """Edges between clusters that meet in a bucket of any run: one text of each, which differs by bucket, against that of the
    largest there, where they look alike. A cluster is one row of a bucket, however many of its texts are in it."""
    rows = _with_clusters(feat.select("rid", "p1"), clusters).select("rid", "cluster", F.explode("p1").alias("path"))
    one = F.min(F.struct(F.xxhash64("rid", "path").alias("h"), "rid"))["rid"]
    there = rows.groupBy("path", "cluster").agg(one.alias("rid"), F.count("*").alias("c"))
    mixed = there.groupBy("path").agg(F.count("*").alias("k"), F.max(F.struct("c", "rid"))["rid"].alias("top")).filter("k > 1").select("path", "top")
    pairs = there.join(_few(materialize(mixed)), "path").filter(F.col("rid") != F.col("top")).select("rid", "top").distinct()
    marks = feat.select("rid", "n", "sketch")
    tops = feat.select(F.col("rid").alias("top"), F.col("n").alias("tn"), F.col("sketch").alias("ts"))
    pairs = materialize(pairs)
    pairs = pairs.join(marks, "rid").join(_few(materialize(tops.join(_few(pairs.select("top").distinct()), "top", "left_semi"))), "top")
    return pairs.filter(_like("n", "sketch", "tn", "ts")).select(F.col("rid").alias("src"), F.col("top").alias("dst"))


def _candidate_clusters(rows: DataFrame, feat: DataFrame) -> DataFrame:
    """(rid, cluster) so that every pair that met in a bucket of some run and passes the filter is in one cluster.

    What the stars have joined needs no further look, so only buckets with several clusters are searched. One of up to SMALL
    texts is compared outright. In a larger one, texts outside its largest cluster are compared with all members here, block by
    block, if they are at most half. Other large buckets are split by a further token, and what no token splits is compared in
    blocks too.
    """
    found = _clusters(_first_stars(feat))
    found = _clusters(_cluster_stars(feat, found), found)
    marks = _with_clusters(feat, found)
    texts, above, edges = marks.select("rid", "n", "sketch", "cluster", F.explode("p1").alias("path")), None, []
    for level in range(1, DEPTH + 1):
        if level > 1:
            if level == 2:
                waiting = materialize(there.join(_few(above), "path", "left_semi").select("rid").distinct())
                deep = materialize(_deep(rows.join(_few(waiting), "rid", "left_semi")))
            texts = deep.filter(F.col("level") == level).join(_few(above.withColumnRenamed("path", "above")), "above", "left_semi").select("rid", "path")
            texts = texts.join(marks.select("rid", "n", "sketch", "cluster"), "rid")
        counts = texts.groupBy("path").agg(F.min("cluster").alias("a"), F.max("cluster").alias("b"), F.count("*").alias("c"))
        counts = materialize(counts.filter("a < b").select("path", "c"))
        # A parent that sends a text here twice, or two parents that do, count it twice; that only moves the limit.
        send = F.broadcast if counts.count() <= MOST_BROADCAST else lambda df: df
        edges.append(_compare_small(texts.join(send(counts.filter(F.col("c") <= SMALL).select("path")), "path", "left_semi").select("path", "cluster", "n", "sketch")))
        big = counts.filter(F.col("c") > SMALL).select("path")
        if big.isEmpty():
            break
        there = materialize(texts.join(send(big), "path", "left_semi").select("path", "rid", "cluster", "n", "sketch").distinct())
        sizes = _outside(there)
        if level < DEPTH:
            split = F.col("left") > F.greatest(F.lit(SMALL), F.col("c") / 2)
            above, sizes = materialize(sizes.filter(split).select("path")), sizes.filter(~split)
        edges.append(_settle(there, send(sizes)))
        if level == DEPTH or above.isEmpty():
            break
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return _clusters(out, found)


def _outside(there: DataFrame) -> DataFrame:
    """(path, c, top, left): how many members a bucket has, its largest cluster, and how many members are outside of that."""
    own = there.groupBy("path", "cluster").agg(F.count("*").alias("c"))
    sizes = own.groupBy("path").agg(F.sum("c").alias("c"), F.max(F.struct("c", "cluster")).alias("most"))
    return materialize(sizes.select("path", "c", F.col("most.cluster").alias("top"), (F.col("c") - F.col("most.c")).alias("left")))


def _settle(there: DataFrame, sizes: DataFrame) -> DataFrame:
    """Edges inside the large buckets of ``sizes``: the members outside of the largest cluster against all members, in blocks."""
    placed = there.join(sizes, "path").withColumns({"blocks": F.ceil(F.col("c") / BUCKET_BLOCK).cast("int"), "pblocks": F.ceil(F.col("left") / BUCKET_BLOCK).cast("int")})
    placed = materialize(placed)
    block = lambda n: F.pmod(F.xxhash64("rid"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    members = placed.select("path", block(F.col("blocks")).alias("mb"), every(F.col("pblocks")).alias("pb"), "cluster", "n", "sketch", F.lit(False).alias("probe"))
    probes = placed.filter(F.col("cluster") != F.col("top")).select("path", every(F.col("blocks")).alias("mb"), block(F.col("pblocks")).alias("pb"), "cluster", "n", "sketch", F.lit(True).alias("probe"))
    return _compare_blocks(members.unionByName(probes))


def _checked_join(left: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Join with a list of keys that is broadcast if it has at most MOST_BROADCAST rows."""
    return left.join(F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys, on, how)


def _exact(sets: DataFrame) -> DataFrame:
    """(key, root, links) partly summed: ``sets`` has (cluster, bi, bj, side, key, s) and the pairs of a block pair are counted
    by one product of incidence matrices, built for a slice of the tokens at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def count(t: pa.Table) -> pa.RecordBatch:
            t = t.combine_chunks()
            side = t.column(3).to_numpy()
            key = np.array(t.column(4).to_pylist(), dtype=object)
            sets = [np.frombuffer(s, np.uint64) for s in t.column(5).to_pylist()]
            n = np.array([len(s) for s in sets], np.int64)
            diagonal = t.column(1)[0].as_py() == t.column(2)[0].as_py()
            left = np.flatnonzero(side == 0)
            right = left if diagonal else np.flatnonzero(side == 1)
            shared = np.zeros((len(left), len(right)), np.float32)
            owner = np.repeat(np.arange(len(sets)), n)
            token, at, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            keep = often[at] > 1  # tokens of one text alone add nothing
            owner, at = owner[keep], at[keep]
            order = np.argsort(at, kind="stable")
            owner, at = owner[order], at[order]
            place = np.full(len(sets), -1)
            step = 4096
            low = 0
            rank = np.cumsum(np.r_[0, at[1:] != at[:-1]]) if len(at) else at
            while low < len(at):
                high = int(np.searchsorted(rank, rank[low] + step))
                own, col = owner[low:high], rank[low:high] - rank[low]
                place[:] = -1
                place[left] = np.arange(len(left))
                x = np.zeros((len(left), step), np.float32)
                mine = place[own] >= 0
                x[place[own[mine]], col[mine]] = 1
                if diagonal:
                    y = x
                else:
                    place[:] = -1
                    place[right] = np.arange(len(right))
                    y = np.zeros((len(right), step), np.float32)
                    mine = place[own] >= 0
                    y[place[own[mine]], col[mine]] = 1
                shared += x @ y.T
                low = high
            both = n[left][:, None] + n[right][None, :]
            hit = shared.astype(np.float64) >= SIMILARITY * (both - shared) - 1e-9
            if diagonal:
                np.fill_diagonal(hit, False)
            links = np.zeros(len(sets), np.int64)
            links[left] += hit.sum(axis=1)
            if not diagonal:
                links[right] += hit.sum(axis=0)
            root = np.arange(len(sets))
            a, b = np.nonzero(hit)
            moved, to = _forest(left[a], right[b])
            root[moved] = to
            own = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays([pa.array(key[own], pa.string()), pa.array(key[root[own]], pa.string()), pa.array(links[own])], names=["key", "root", "links"])

        def groups(t: pa.Table, final: bool) -> tuple[list[pa.Table], pa.Table]:
            cluster, bi, bj = (t.column(i).to_numpy() for i in range(3))
            new = np.flatnonzero(np.r_[True, (cluster[1:] != cluster[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])]) if t.num_rows else np.zeros(0, np.int64)
            done = [t.slice(a, b - a) for a, b in zip(new.tolist(), [*new[1:].tolist(), t.num_rows], strict=True)]
            return (done, t.slice(0, 0)) if final else (done[:-1], done[-1] if done else t)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            done, rest = groups(t if rest is None else pa.concat_tables([rest, t]), False)
            for g in done:
                yield count(g)
        if rest is not None and rest.num_rows:
            for g in groups(rest, True)[0]:
                yield count(g)
        tidy()

    return sets.repartition("cluster", "bi", "bj").sortWithinPartitions("cluster", "bi", "bj").mapInArrow(run, "key string, root string, links long")


def _member_sets(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster, key, s): one row for each distinct text of a cluster, with its shingles."""
    rows = docs.select("rid", "key", "text")
    near = rows.join(F.broadcast(clusters) if clusters.count() <= MOST_BROADCAST else clusters, "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            cluster, key, sets = [], [], []
            for c, k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if k not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    seen.add(k)
                    cluster.append(c)
                    key.append(k)
                    sets.append(shingle_set(t.as_py()).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int64()), pa.array(key, pa.string()), pa.array(sets, pa.binary())], names=["cluster", "key", "s"])
        tidy()

    return near.select("cluster", "key", "text").mapInArrow(run, "cluster long, key string, s binary").groupBy("cluster", "key").agg(F.first("s").alias("s"))


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, least_id, class_id, class_key, n_links, n_copies) of every distinct text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = bounded(docs).select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumns({"rid": F.xxhash64("text"), "key": F.md5(F.col("text").cast("binary"))})
    feat = materialize(_features(rows.select("rid", "text")))
    clusters = _candidate_clusters(rows.select("rid", "text"), feat)
    sets = materialize(_member_sets(rows, clusters))
    sizes = sets.groupBy("cluster").agg(F.ceil(F.count("*") / CLUSTER_BLOCK).cast("int").alias("blocks"))
    placed = sets.join(sizes, "cluster").withColumn("b", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    blocked = placed.select(
        "cluster", "b", "key", "s",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("b"), o).alias("bi"), F.greatest(F.col("b"), o).alias("bj")))).alias("z"),
    ).select("cluster", "z.bi", "z.bj", F.when(F.col("b") == F.col("z.bi"), 0).otherwise(1).alias("side"), "key", "s")
    linked = materialize(_exact(blocked))
    links = linked.groupBy("key").agg(F.sum("links").alias("n_links"))
    groups = connected_components(linked.select(F.col("key").alias("src"), F.col("root").alias("dst")))
    # Rows without an id come last in the choice of a class's document.
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("key").alias("key"))
    texts = rows.groupBy("key").agg(F.count("*").alias("n_copies"), F.min(order).alias("least"))
    texts = texts.join(groups.withColumnRenamed("id", "key"), "key", "left").join(links, "key", "left").withColumn("group", F.coalesce("component", "key"))
    best = texts.groupBy("group").agg(F.min("least").alias("best"))
    return materialize(
        texts.join(best, "group").select("key", F.col("least.id").alias("least_id"), F.col("best.id").alias("class_id"), F.col("best.key").alias("class_key"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies")
    )


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, class_id, n_links (other distinct texts at Jaccard similarity 0.8 or more over sets of
    five-word shingles) and n_copies (rows with an equal text).

    Rows with equal texts and rows that links join, directly or through others, have one class: its least doc_id. Words are cut
    at ASCII white space and compared as they are. Texts of one to four words are one shingle; texts without words, and null
    ones, which count as empty, link to nothing but share a class with equal texts. Ids may be null (class ids then come from
    other rows of the class, if any) or repeat. An empty table gives no rows; other columns are not looked at. A pair at the
    least similarity is missed with probability under 2e-6; no pair is listed that is not one.
    """
    classes = _classes(docs, id_col, text_col).select("key", "class_id", "n_links", "n_copies")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("key"))
    return slim.join(classes, "key").select("doc_id", "class_id", "n_links", "n_copies")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their class: one for each.

    It is the class's row with the least id, of several texts under that id the one with the least md5; rows without an id come
    last, and of rows equal in id and text any one stays. Other columns keep their names and values."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("key"))
    classes = _classes(docs, id_col, text_col)
    unique = rows.groupBy("id", "key").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    # What goes: texts that do not stand for their class, and rows of the text that does under another id.
    gone = classes.filter(F.col("key") != F.col("class_key")).select("key")
    several = classes.filter((F.col("key") == F.col("class_key")) & (F.col("n_copies") > 1)).select("key", "class_id", F.lit(True).alias("many"))
    several = F.broadcast(several) if several.count() <= MOST_BROADCAST else several
    out = _checked_join(rows, gone, "key", "left_anti").join(several, "key", "left").filter(F.col("many").isNull() | F.col("id").eqNullSafe(F.col("class_id")))
    if not unique:
        out = out.dropDuplicates(["key"])
    return out.select("row.*")
