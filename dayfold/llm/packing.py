"""Best-fit packing of token sequences."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.tables import Scratch, known_text, need

# How a byte-level tokenizer of this kind cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_names() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder:
    """Token ids of whole texts by a byte-level BPE file of the tokenizers library.

    If the file numbers its tokens in the order of its merges, ids follow from the
    ranks alone and a faster library for ranked vocabularies finds the same ids;
    any other file is left to the tokenizers library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.ranked = self._ranked(json.load(file))

    def _ranked(self, spec: dict):
        import tiktoken

        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        vocab, names = model.get("vocab"), _byte_names()
        if model.get("type") != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel":
            return None
        if before.get("add_prefix_space") or not before.get("use_regex", True) or model.get("ignore_merges"):
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocab.get(a + b) != 256 + n for n, (a, b) in enumerate(pairs)):
            return None
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(names[c] for c in word): n for word, n in vocab.items() if word not in special}
        return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        if self.ranked is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranked.encode(text, allowed_special="all", disallowed_special=())
        return np.array(ids, dtype="<u4")


def pieces_of(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """The token pieces of every document: id, piece, start, length, ids_crc32.

    A document is its tokens and ``end_id``. Only one longer than ``capacity`` is
    cut; its first piece takes the odd length and all others are full. With
    ``keep_ids`` the token ids are returned too. NULL text counts as empty, which
    is one piece with ``end_id`` alone.
    """
    need(docs, [id_col, text_col])
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[list] = [[] for _ in schema.names]
                source = []
                for n, ids in enumerate(map(encoder.encode, part.column(1).to_pylist())):
                    ids = np.concatenate([ids, end])
                    first = len(ids) % capacity or min(capacity, len(ids))
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for piece, (low, high) in enumerate(zip(cuts, cuts[1:])):
                        own = ids[low:high]
                        source.append(n)
                        rows[1].append(piece)
                        rows[2].append(low)
                        rows[3].append(high - low)
                        rows[4].append(zlib.crc32(own.tobytes()))
                        if keep_ids:
                            rows[5].append(own.astype("int32"))
                arrays = [part.column(0).take(pa.array(source, type=pa.int64()))]
                kinds = [None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                arrays += [pa.array(r, type=k) for r, k in zip(rows[1:], kinds[1:])]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(F.col(id_col).alias("id"), known_text(text_col).alias("text")).mapInArrow(encode, schema)


@dataclass
class Placement:
    """Where runs of ranked pieces go: run i starts at rank ``rank[i]``."""

    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def best_fit_runs(counts: dict[int, int], capacity: int) -> Placement:
    """Sweep the lengths downwards and give every run of equal pieces its gaps.

    ``counts`` has the number of pieces of each length, so at most ``capacity``
    entries whatever the data; ranks number the pieces from the longest down. Each
    sweep takes the successor of the length among the gaps (the narrowest gap
    that holds it), settles who gets it by rank, narrows those gaps, and goes
    on until the run is placed; without a successor, new sequences are opened.
    """
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    ranks, sequences, offsets, rank, opened = [], [], [], 0, 0
    for length in sorted(counts, reverse=True):
        left, gap = counts[length], length
        while left:
            while gap <= capacity and not gaps[gap]:
                gap += 1
            if gap > capacity:
                new = -(-left // (capacity // length))
                gaps[capacity].append((opened, new))
                opened += new
                gap = capacity
            first, free = gaps[gap].pop()
            each = gap // length
            filled = min(free, left // each)
            taken = each
            if not filled:
                filled, taken = 1, left
            for k in range(taken):
                ranks.append(rank)
                sequences.append(first)
                offsets.append(capacity - gap + k * length)
                rank += filled
            left -= filled * taken
            gaps[gap - taken * length].append((first, filled))
            if free > filled:
                gaps[gap].append((first + filled, free - filled))
    as_array = lambda x: np.array(x, dtype="int64")
    return Placement(as_array(ranks), as_array(sequences), as_array(offsets), opened)


def best_fit_pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pack the token pieces of ``docs`` into sequences of at most ``capacity`` tokens.

    Spark encodes the texts and range-sorts the pieces, longest first; a piece's
    rank is its place in its range plus the sizes of the ranges before. Lengths
    are whole numbers up to ``capacity``, so the sorted pieces are at most
    ``capacity`` runs of equal length and the sweeps of best fit match runs of pieces
    with runs of gaps (see :func:`best_fit_runs`). They need only the counts per
    length and per range, which is all that reaches the driver; each piece then finds its
    run by its rank. Equal lengths are sorted by id and piece, so a hot length
    spreads over ranges.

    Returns per piece: the id, piece, start, length, ids_crc32, sequence_id, offset
    (and ids with ``keep_ids``). Repeated rows are packed as often as they occur. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.write(pieces_of(docs, tokenizer, capacity, end_id, id_col, text_col, keep_ids))
    order = [F.col("length").desc(), F.col("id"), F.col("piece"), F.col("tag")]
    ranges = (
        pieces.withColumn("tag", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("tag")
    )
    place = F.monotonically_increasing_id()
    ranked = scratch.write(
        ranges.withColumns({"range": F.shiftright(place, 33).cast("int"), "place": place.bitwiseAND(F.lit(2**33 - 1))})
    )
    scratch.drop(pieces)
    counts = ranked.groupBy("range", "length").count().groupBy("length").agg(F.sum("count").alias("n")).collect()
    sizes = {r["range"]: r["count"] for r in ranked.groupBy("range").count().collect()}
    starts, total = {}, 0
    for part in sorted(sizes):
        starts[part], total = total, total + sizes[part]
    found = spark.sparkContext.broadcast((starts, best_fit_runs({r["length"]: r["n"] for r in counts}, capacity)))
    names = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    schema = T.StructType([ranked.schema[n] for n in names])
    schema = schema.add("sequence_id", T.LongType()).add("offset", T.LongType())

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, runs = found.value
        for rows in batches:
            rank = rows["range"].map(first).to_numpy("int64") + rows["place"].to_numpy("int64")
            run = np.searchsorted(runs.rank, rank, side="right") - 1
            rows["sequence_id"] = runs.sequence[run] + rank - runs.rank[run]
            rows["offset"] = runs.offset[run]
            yield rows.drop(columns=["range", "place"])

    return ranked.mapInPandas(settle, schema).withColumnRenamed("id", id_col)
