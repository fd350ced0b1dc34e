"""Near duplicates among embeddings by a pivot-permutation index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.near_dedup import components
from dayfold.llm.tables import Scratch, need

# Up to this many long lists, some tens of MB, their numbers of blocks are broadcast.
MOST_BROADCAST = 500_000
# Pairs that are looked at together in a task.
CHUNK = 256
LEAST_PIVOTS, MOST_PIVOTS = 16, 2048


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1, scaled by their largest component first so that no square leaves the doubles."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def spread(candidates: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the candidates, each the farthest from those before it.

    Drawn at random, many reference points would lie in the largest group of near copies, where they order
    vectors by noise; the farthest ones take one there.
    """
    taken = [0]
    nearest = candidates @ candidates[0]
    while len(taken) < min(count, len(candidates)):
        following = int(nearest.argmin())
        if nearest[following] > 1 - 1e-9:
            break
        taken.append(following)
        nearest = np.maximum(nearest, candidates @ candidates[following])
    return candidates[taken]


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """Per vector the numbers of its ``count`` nearest pivots, nearest first, equal ones by number.

    Vectors of another length than the pivots' are filled up with zeros or cut for this; their lists are apart.
    """
    width = min(vectors.shape[1], pivots.shape[1])
    near = vectors[:, :width] @ pivots[:, :width].T
    return np.argsort(-near, axis=1, kind="stable")[:, :count].astype("int32")


def shared_counts(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many pivots each row of ``left`` shares with each of ``right``."""
    out = np.zeros((len(left), len(right)), "uint8")
    for a in left.T:
        for b in right.T:
            out += a[:, None] == b[None, :]
    return out


def first_shared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest pivot that the rows of a pair share."""
    none = np.int32(np.iinfo("int32").max)
    out = np.full(len(left), none, "int32")
    for a in left.T:
        out = np.minimum(out, np.where((a[:, None] == right).any(1), a, none))
    return out


def list_links(
    vectors: np.ndarray, signs: np.ndarray, side: np.ndarray, two: bool, pivot: int, shared: int, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs (a, b) of one pivot list, or of two blocks of one where ``two``.

    A pair is a candidate if it shares enough pivots, and is looked at in the list of the first one it shares.
    """
    first, second = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if two else (np.arange(len(side)),) * 2
    found = []
    for start in range(0, len(first), CHUNK):
        own = first[start : start + CHUNK]
        candidate = shared_counts(signs[own], signs[second]) >= shared
        if not two:
            candidate &= own[:, None] < second[None, :]
        a, b = np.nonzero(candidate)
        if len(a) > 64 * len(own):
            good = (vectors[own] @ vectors[second].T)[a, b] >= least
        else:
            good = np.einsum("ij,ij->i", vectors[own[a]], vectors[second[b]]) >= least
        a, b = own[a[good]], second[b[good]]
        mine = first_shared(signs[a], signs[b]) == pivot
        found.append((a[mine], b[mine]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2


def roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``count`` rows reaches through the pairs."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column, all of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted rows cut where a key changes."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changes = np.zeros(batch.num_rows, bool)
        for c in columns:
            changes[1:] |= c[1:] != c[:-1]
        changes[0] = last is not None and last != tuple(c[0] for c in columns)
        last = tuple(c[-1] for c in columns)
        start = 0
        for at in np.flatnonzero(changes):
            if at > start:
                kept.append(batch.slice(start, at - start))
            if kept:
                yield pa.Table.from_batches(kept).combine_chunks()
            kept, start = [], at
        kept.append(batch.slice(start))
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: components known and finite, and one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def embedding_near_dedup(
    vectors: DataFrame,
    least: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    pivots: int | None = None,
    nearest: int = 6,
    shared: int = 2,
    block: int = 2048,
) -> DataFrame:
    """Per row its id, ``n_links`` (other rows linked), ``component_id`` (smallest id reachable) and ``kept``.

    Rows with equal labels are linked if the cosine of their vectors is ``least`` or more.

    Every different vector is described by its ``nearest`` pivots in order and stands in the list of each. Vectors that
    meet in lists and share at least ``shared`` pivots are candidates, and their cosine decides. Copies of one vector count as
    one entry. A list of more than ``block`` vectors is compared block against block, so no task holds
    more than two blocks, and only counts and the trees of linked vectors leave it, never pairs. The work in a list
    grows with the square of its length. Pivots are far apart from each other, chosen from a bounded sample (four times
    their number, by a hash of the vectors); by default they are about the square root of the number of
    different vectors, from 16 to 2048. All vectors are indexed.

    The index is approximate: a pair with a cosine of exactly 0.98 shares fewer than 2 of 6 pivots once in some
    thousand cases (README); no pair below ``least`` is linked.

    Rows whose label is NULL, or whose vector is NULL, empty, zero or has a component that is NULL or not
    finite, are linked with nothing and are their own component. Vectors of different length are not compared. Rows that
    share an id are vectors of their own. A NULL id is never the smallest; a row without any id in its component has a NULL
    ``component_id`` and is kept. Other columns are left out. An empty table gives no rows.
    """
    need(vectors, [id_col, vector_col, label_col])
    if id_col in ("n_links", "component_id", "kept"):
        raise ValueError(f"the id {id_col!r} has the name of a result")
    scratch = Scratch(vectors.sparkSession, "embeddings")
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    ).withColumn("good", usable(F.col("vector")) & F.col("label").isNotNull())
    good = rows.where("good").select("id", "label", "vector")
    different = good.groupBy("label", "vector").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    nodes = scratch.write(different.withColumn("node", F.monotonically_increasing_id()))
    partial = _linked(nodes, scratch, least, pivots, nearest, shared, block)

    links = partial.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(partial.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    known = (
        nodes.select("node", "first_id", "copies")
        .join(links, "node", "left")
        .join(classes, "node", "left")
        .select(
            "node",
            "first_id",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("class_id", "node").alias("class_id"),
        )
    )
    # Written, so that AQE can split the join at a class with very many vectors.
    known = scratch.write(known)
    smallest = scratch.write(known.groupBy("class_id").agg(F.min("first_id").alias("component_id")))
    decided = scratch.write(known.join(smallest, "class_id").select("node", "n_links", "component_id"))
    of_vectors = scratch.write(nodes.select("label", "vector", "node").join(decided, "node").drop("node"))
    out = good.join(of_vectors, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where("NOT good").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _linked(
    nodes: DataFrame, scratch: Scratch, least: float, pivots: int | None, nearest: int, shared: int, block: int
) -> DataFrame:
    """Links of the ``nodes`` by list: (node, links to other rows, root: the smallest node it is linked to there)."""
    wanted = pivots or int(min(MOST_PIVOTS, max(LEAST_PIVOTS, math.sqrt(nodes.count()))))
    sample = nodes.orderBy(F.xxhash64("vector"), "node").select("vector").limit(4 * wanted).toArrow()["vector"]
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("links", T.LongType()), T.StructField("root", T.LongType())])
    if not len(sample):
        return scratch.write(nodes.sparkSession.createDataFrame([], schema))
    width = max(len(v) for v in sample)
    points = np.zeros((len(sample), width))
    for n, v in enumerate(sample.to_pylist()):
        points[n, : len(v)] = v
    points = spread(unit(points), wanted)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("vector").value_lengths().to_numpy()
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                signs = nearest_pivots(unit(_matrix(part.column("vector")).astype("float64")), points, nearest)
                offsets = pa.array(np.arange(len(signs) + 1) * signs.shape[1], pa.int32())
                listed = pa.ListArray.from_arrays(offsets, pa.array(signs.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, listed], names=[*part.schema.names, "signs"])

    # The label as one number per label and length of vectors, so that lists have plain keys.
    apart = F.xxhash64("label", F.size("vector")).alias("part")
    described = nodes.select("node", "copies", "vector", "label", apart)
    shape = T.StructType([*described.schema.fields, T.StructField("signs", T.ArrayType(T.IntegerType()))])
    stored = scratch.write(described.mapInArrow(describe, shape))
    postings = stored.withColumn("pivot", F.explode("signs"))
    long = scratch.write(
        stored.select("part", F.explode("signs").alias("pivot"))
        .groupBy("part", "pivot")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > block)
        .select("part", "pivot", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    if long.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        long = F.broadcast(long)
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    met = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(
            F.least("own", other).alias("i"), F.greatest("own", other).alias("j"), (other < F.col("own")).cast("int").alias("side")
        ),
    )
    keys = ["part", "pivot", "i", "j"]
    lists = (
        postings.join(long, ["part", "pivot"], "left")
        .withColumn("own", own)
        .select("part", "pivot", "node", "copies", "vector", "label", "signs", F.explode(met).alias("met"))
        .select("part", "pivot", "met.*", "node", "copies", "vector", "label", "signs")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, keys):
            if group.num_rows < 2:
                continue
            pivot, i, j = (group[k][0].as_py() for k in ("pivot", "i", "j"))
            nodes = group["node"].to_numpy()
            order = np.argsort(nodes, kind="stable")
            nodes, copies, side = nodes[order], group["copies"].to_numpy()[order], group["side"].to_numpy()[order]
            vectors = unit(_matrix(group["vector"].combine_chunks()).astype("float64"))[order]
            signs = _matrix(group["signs"].combine_chunks())[order]
            a, b = list_links(vectors, signs, side, i != j, pivot, shared, least)
            labels = group["label"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)[order]
            if labels.any():  # two labels of one hash
                same = labels[a] == labels[b]
                a, b = a[same], b[same]
            if not len(a):
                continue
            links = np.zeros(len(nodes), "int64")
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            has = links > 0
            root = nodes[roots(len(nodes), a, b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[has]), pa.array(links[has]), pa.array(root[has])], names=["node", "links", "root"]
            )

    dealt = lists.repartition(*keys).sortWithinPartitions(*keys)
    return scratch.write(dealt.mapInArrow(compare, schema))
