"""Exact ranked lexical search by sparse ball trees."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.decontaminate import words_column
from dayfold.llm.tables import Scratch, known_text, need

# ASCII letters and digits, A-Z made small, and all bytes beyond ASCII are in terms; others end them.
FOLD = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))
# Relative allowance for the rounding of sums in doubles. A sum of a million of them is off by 10^-10 at most.
ROUNDING = 1e-9


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(FOLD).split()


def weight(documents: int, df: int) -> int:
    """The weight of a term in ``df`` of so many documents."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Sparse:
    """Rows of (column, value) entries; every row has one at least."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray):
        self.starts, self.columns, self.values = starts, columns, values

    def take(self, rows: np.ndarray) -> Sparse:
        sizes = np.diff(np.append(self.starts, len(self.columns)))[rows]
        starts = np.cumsum(sizes) - sizes
        entries = np.repeat(self.starts[rows] - starts, sizes) + np.arange(sizes.sum())
        return Sparse(starts, self.columns[entries], self.values[entries])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.values * dense[self.columns], self.starts)

    def row(self, n: int, width: int) -> np.ndarray:
        out, one = np.zeros(width), self.take(np.array([n]))
        out[one.columns] = one.values
        return out


class BallTree:
    """A block of documents, halved between far points until at most ``leaf`` are together.

    Terms are put into segments: those that weigh most in the same upper subtree and are about equally frequent.
    A node has a centre and, per segment, a radius that no document of it exceeds, rounding included. One
    radius over all terms is too wide to prune anything where documents share few of their terms.
    """

    def __init__(self, rows: Sparse, width: int, leaf: int):
        self.children: list[tuple[int, int] | None] = []
        self.leaves: dict[int, tuple[np.ndarray, Sparse]] = {}
        self.members: list[Sparse] = []
        centres: list[np.ndarray] = []
        self.width, self.leaf = width, leaf
        norms = np.add.reduceat(rows.values.astype("float64") ** 2, rows.starts)
        self._grow(np.arange(len(rows.starts)), rows, norms, centres)
        self.centre = np.array(centres)
        self.segment = self._segments(np.bincount(rows.columns, minlength=width))
        self.radius = np.array([self._radii(m, c) for m, c in zip(self.members, self.centre)])
        self.members = []

    def _grow(self, own: np.ndarray, rows: Sparse, norms: np.ndarray, centres: list[np.ndarray]) -> int:
        centre = np.bincount(rows.columns, weights=rows.values, minlength=self.width) / len(own)
        me = len(self.children)
        self.children.append(None)
        self.members.append(rows)
        centres.append(centre)
        if len(own) <= self.leaf:
            self.leaves[me] = own, rows
            return me
        far = rows.row(int((norms - 2 * rows.dot(centre)).argmax()), self.width)
        opposite = rows.row(int((norms - 2 * rows.dot(far)).argmax()), self.width)
        order = np.argsort(rows.dot(far - opposite), kind="stable")
        left, right = np.sort(order[: len(own) // 2]), np.sort(order[len(own) // 2 :])
        self.children[me] = (
            self._grow(own[left], rows.take(left), norms[left], centres),
            self._grow(own[right], rows.take(right), norms[right], centres),
        )
        return me

    def _segments(self, frequency: np.ndarray, depth: int = 4, per_octave: int = 3) -> np.ndarray:
        level = [0]
        for _ in range(depth):
            level = [child for node in level for child in (self.children[node] or (node,))]
        rank = np.argsort(np.argsort(-frequency, kind="stable"), kind="stable")
        band = (np.log2(rank + 1) * per_octave).astype("int64")
        place = self.centre[level].argmax(0) * (band.max() + 1) + band
        return np.unique(place, return_inverse=True)[1]

    def _radii(self, rows: Sparse, centre: np.ndarray) -> np.ndarray:
        """Per segment the largest distance of a row from the centre."""
        count, segments = len(rows.starts), int(self.segment.max()) + 1
        of = np.repeat(np.arange(count), np.diff(np.append(rows.starts, len(rows.columns))))
        values, at = rows.values.astype("float64"), centre[rows.columns]
        apart = np.bincount(
            of * segments + self.segment[rows.columns],
            weights=(values - 2 * at) * values,
            minlength=count * segments,
        ).reshape(count, segments)
        size = np.bincount(self.segment, weights=centre**2, minlength=segments)
        far = np.add.reduceat(values**2, rows.starts).max()
        slack = ROUNDING * np.where(size > 0, size + 4 * far, 0)
        return np.sqrt(np.maximum(apart.max(0) + size, 0) + slack)

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """Per node a number that no document of it scores above for a query of these terms."""
        lengths = np.sqrt(np.bincount(self.segment[terms], minlength=self.radius.shape[1]))
        return (self.centre[:, terms].sum(1) + self.radius @ lengths) * (1 + ROUNDING)


class Best:
    """The k best (score, id) so far, equal scores by smaller id, NULL ids last."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        good = np.flatnonzero(scores >= self.least)
        if not len(good):
            return
        if len(good) > self.k:
            # Below the k-th best score of these no row is needed.
            good = good[scores[good] >= np.partition(scores[good], -self.k)[-self.k]]
        found = zip(scores[good].tolist(), ids.take(pa.array(good)).to_pylist())
        self.rows = heapq.nsmallest(self.k, [*self.rows, *found], key=lambda x: (-x[0], x[1] is None, x[1]))
        if len(self.rows) == self.k:
            self.least = self.rows[-1][0]


def search_block(
    tree: BallTree, ids: pa.Array, terms: np.ndarray, best: Best, at: dict[int, int] | None = None
) -> None:
    """Add a block's best documents for the terms, nodes of the highest bound first, until no bound reaches the k-th."""
    bounds = tree.bounds(terms)
    wanted = np.zeros(tree.width, "int64")
    wanted[terms] = 1
    open_nodes = [(-bounds[0], 0)]
    while open_nodes and -open_nodes[0][0] >= best.least:
        _, node = heapq.heappop(open_nodes)
        if tree.children[node]:
            for child in tree.children[node]:
                heapq.heappush(open_nodes, (-bounds[child], child))
            continue
        own, rows = tree.leaves[node]
        best.add(rows.dot(wanted), ids.take(pa.array(own)))
        if at is not None:
            at["leaves"] = at.get("leaves", 0) + 1


def _vectors(index: dict[bytes, int]):
    """Texts to the counts of the query terms in them, and the number of all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, lengths, terms, counts = [], [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = terms_of(text.as_py())
                found = Counter(map(index.get, words))
                found.pop(None, None)
                sizes.append(len(words))
                lengths.append(len(found))
                terms.extend(found)
                counts.extend(found.values())
            offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                names=["id", "n", "terms", "counts"],
            )

    return count


def _search(items: Sequence[tuple], weights: np.ndarray, documents: int, total: int, k: int, block: int, leaf: int):
    """Blocks of vectors to the k best rows of each item (key, id, terms) in a task's share."""
    queries = [np.array(sorted(terms), "int64") for _, _, terms in items]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for ids, n, starts, terms, counts in _blocks(batches, block):
            norm = 10 + (90 * n * documents) // total
            of = np.repeat(np.arange(len(n)), np.diff(np.append(starts, len(terms))))
            values = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * norm[of]))
            here, columns = np.unique(terms, return_inverse=True)
            tree = BallTree(Sparse(starts, columns, values), len(here), leaf)
            place = np.full(len(weights), -1)
            place[here] = np.arange(len(here))
            for query, own in zip(queries, best):
                known = place[query]
                known = known[known >= 0]
                if len(known):
                    search_block(tree, ids, known, own)
        rows = [(key, item, id, score) for (key, item, _), own in zip(items, best) for score, id in own.rows]
        if rows:
            keys, names, found, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(names, item_type),
                    pa.array(found, ids.type),
                    pa.array(scores, pa.int64()),
                ],
                names=["key", "item", "id", "score"],
            )

    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(items.item_type)
    return find


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple]:
    """Vectors in blocks of up to ``block`` rows; those without any query term score nothing."""

    def joined(parts: list[pa.RecordBatch]) -> tuple:
        table = pa.Table.from_batches(parts).combine_chunks()
        terms, counts = (table.column(name).combine_chunks() for name in ("terms", "counts"))
        offsets = terms.offsets.to_numpy()
        ids = table.column("id").combine_chunks()
        return (
            ids,
            table.column("n").to_numpy(),
            (offsets[:-1] - offsets[0]).astype("int64"),
            terms.flatten().to_numpy(),
            counts.flatten().to_numpy(),
        )

    kept, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, block - rows)
            batch = batch.slice(part.num_rows)
            kept.append(part)
            rows += part.num_rows
            if rows == block:
                yield joined(kept)
                kept, rows = [], 0
    if rows:
        yield joined(kept)


class _Items(list):
    """Items (key, id, terms) of one round, with the Spark type of their ids."""

    def __init__(self, rows: Sequence[tuple], item_type: T.DataType):
        super().__init__(rows)
        self.item_type = item_type


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_terms: int = 10_000,
    block: int = 8192,
    leaf: int = 64,
) -> DataFrame:
    """The ``k`` documents of the highest score for each item: (item, ``rank`` from 1, id, ``score``).

    A score is the sum, over the item's distinct terms, of an integer weight that falls with the number of
    documents holding the term, times an integer that rises with its count in the document and falls with the
    document's length. Only scores above 0 count; equal ones are ranked by ascending id.

    Documents are read as vectors over the terms of the items. Each task builds ball trees over its blocks of
    vectors and searches them for every item, best bound first: a bound is the inner product with the node's
    centre plus, per segment of terms, radius times the query's length, raised by more than rounding can take away;
    a node is left out only if its bound is below the k-th exact score. Scores at the leaves are 64-bit integers. What a
    task passes on is ``k`` rows per item.

    Items are searched in rounds of about ``most_terms`` terms, which bounds what goes to the tasks; each round
    reads the texts once. NULL and empty texts and items without terms give no rows. Every row of the
    items is ranked for itself, so a repeated item is answered as often as it stands there; repeated document rows are
    ranked one by one; rows with a NULL id come last among equal scores. Other columns are ignored. Empty tables give no rows.
    """
    need(docs, [id_col, text_col])
    need(items, [item_col, item_text_col])
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    names = {id_col, item_col}
    if len(names) < 2 or names & {"rank", "score"}:
        raise ValueError(f"the ids {id_col!r} and {item_col!r} need names of their own")
    terms = F.array_distinct(words_column(known_text(item_text_col)))
    asked = scratch.write(
        items.select(F.monotonically_increasing_id().alias("key"), F.col(item_col).alias("item"), terms.alias("terms"))
        .where(F.size("terms") > 0)
    )
    rounds = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // most_terms)
    texts = docs.select(F.col(id_col).alias("id"), known_text(text_col).alias("text"))
    out_schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("item", items.schema[item_col].dataType),
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    found = spark.createDataFrame([], out_schema)
    for n in range(rounds):
        part = F.pmod(F.xxhash64("key"), F.lit(rounds)) == n
        # About most_terms terms, whatever the tables hold.
        own = [(r.key, r.item, [t.encode() for t in r.terms]) for r in asked.where(part).collect()]
        if own:
            found = found.unionByName(_one_round(texts, own, out_schema, k, block, leaf, scratch))
    ranked = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
    )


def _one_round(
    texts: DataFrame, own: list[tuple], out_schema: T.StructType, k: int, block: int, leaf: int, scratch: Scratch
) -> DataFrame:
    index = {term: n for n, term in enumerate(dict.fromkeys(t for _, _, terms in own for t in terms))}
    schema = T.StructType(
        [
            out_schema["id"],
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
        ]
    )
    vectors = scratch.write(texts.mapInArrow(_vectors(index), schema))
    documents, total = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    frequencies = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(index), "int64")
    for term, df in frequencies:
        weights[term] = weight(documents, df)
    items = _Items([(key, item, [index[t] for t in terms]) for key, item, terms in own], out_schema["item"].dataType)
    search = _search(items, weights, documents, total or 1, k, block, leaf)
    return vectors.where(F.size("terms") > 0).mapInArrow(search, out_schema)
