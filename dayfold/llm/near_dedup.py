"""Near duplicates by order MinHash, verified by banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.licenses import TO_WORDS
from dayfold.llm.tables import Scratch, known_text, need


def words_of(text: str) -> list[bytes]:
    """Words of digits, letters (A-Z as a-z) and characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(TO_WORDS).split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive words; of all words where there are fewer."""
    if not words:
        return np.empty(0, dtype="uint64")
    own = _hash_words(words)
    size = min(size, len(own))
    out = np.zeros(len(own) - size + 1, dtype="uint64")
    for n in range(size):
        out = (out ^ own[n : n + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _hash_words(words: list[bytes]) -> np.ndarray:
    """Stable hashes of words, all at once: polynomial sums over the joined bytes."""
    data = np.frombuffer(b" ".join(words) + b" ", dtype="uint8").astype("uint64")
    ends = np.cumsum(np.fromiter(map(len, words), dtype="int64", count=len(words)) + 1)
    starts = ends - np.diff(ends, prepend=0)
    place = np.arange(len(data), dtype="uint64") - np.repeat(starts, np.diff(ends, prepend=0)).astype("uint64")
    mixed = (data + np.uint64(1)) * (place * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0xA0761D6478BD642F))
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xE7037ED1A0B428DB)
    mixed ^= mixed >> np.uint64(30)
    return np.add.reduceat(mixed, starts)


def order_minhash(shingles: np.ndarray, sketches: int, sampled: int, seed: int = 1) -> np.ndarray:
    """One key per sketch: ``sampled`` minimum occurrence-labelled shingles in text order.

    The n-th occurrence of a shingle is a label of its own, so repeats count. Each sketch orders
    the labelled shingles by another hash, takes the smallest and puts them back in text order
    before they are joined to a key, which therefore tells order as well as content.
    """
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    runs = np.diff(np.concatenate((starts, [len(ordered)])))
    occurrence = np.empty(len(shingles), dtype="uint64")
    occurrence[order] = np.arange(len(shingles)) - np.repeat(starts, runs)
    labelled = (shingles ^ (occurrence * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9FB21C651E98DF25)
    labelled ^= labelled >> np.uint64(32)
    keys = np.empty(sketches, dtype="uint64")
    few = min(sampled, len(labelled))
    mixers = np.random.default_rng(seed).integers(1, 2**63, size=(sketches, 2), dtype="uint64") | np.uint64(1)
    for n, (a, b) in enumerate(mixers):
        mixed = (labelled ^ b) * a
        mixed ^= mixed >> np.uint64(32)
        mixed *= b
        mixed ^= mixed >> np.uint64(29)
        least = np.argpartition(mixed, few - 1)[:few] if few < len(mixed) else np.arange(len(mixed))
        key = n + 1
        for hashed in labelled[np.sort(least)].tolist():
            key = (key ^ hashed) * 0x9E3779B97F4A7C15 % 2**64
            key ^= key >> 31
        keys[n] = key
    return keys


def aligned_similarity(a: Sequence, b: Sequence, least: float) -> float:
    """Similarity of two sequences by the best alignment, or 0.0 below ``least``.

    With m aligned equal items, it is m / (len(a) + len(b) - m). At ``least``, so many items must be
    aligned that no aligned pair is further off the diagonal than the items left out; the
    alignment is sought in this band only. It is the bit-parallel longest common subsequence.
    """
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    if len(a) > len(b):
        a, b = b, a
    most = len(a) / len(b)
    if most < least:
        return 0.0
    needed = int(np.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9))
    places: dict = {}
    for n, item in enumerate(a):
        places[item] = places.get(item, 0) | (1 << n)
    band_below = len(a) - needed  # items of a that may be left out
    band_above = len(b) - needed
    everything = (1 << len(a)) - 1
    state = everything
    for n, item in enumerate(b):
        here = places.get(item)
        if here is None:
            continue
        low, high = n - band_above, n + band_below + 1
        if high < len(a):
            here &= (1 << high) - 1
        if low > 0:
            here = here >> low << low
        if here:
            matched = state & here
            state = ((state + matched) | (state - matched)) & everything
    found = len(a) - state.bit_count()
    return found / (len(a) + len(b) - found) if found >= needed else 0.0


def shingle_counts(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall into each of 256 bins by their hash, at most 255 a bin."""
    bins = (shingles * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(56)
    return np.minimum(np.bincount(bins.astype("int64"), minlength=256), 255).astype("uint8")


def unlike_pairs(left: tuple, right: tuple | None, sketch: int, least: float) -> tuple[np.ndarray, ...]:
    """Pairs of members of a bucket that may be similar and have different classes, by places.

    A side is (class codes, shingle numbers, keys, counts by bin); without ``right``, pairs are within ``left``.
    Pairs that share an earlier key are left to its bucket. Of two texts with m aligned shingles, a + b - 2 m are
    not aligned, and their counts cannot differ by more. Returns the places and that difference.
    """
    class_a, n_a, keys_a, counts_a = left
    class_b, n_b, keys_b, counts_b = right or left
    needed = np.ceil(least * (n_a[:, None] + n_b[None, :]) / (1 + least) - 1e-9)
    open_pairs = (class_a[:, None] != class_b[None, :]) & (needed <= np.minimum(n_a[:, None], n_b[None, :]))
    if right is None:
        open_pairs &= np.triu(np.ones(open_pairs.shape, bool), 1)
    for s in range(sketch):
        open_pairs &= keys_a[:, None, s] != keys_b[None, :, s]
    a, b = np.nonzero(open_pairs)
    most = n_a[a] + n_b[b] - 2 * needed[a, b]
    apart = np.empty(len(a), dtype="int64")
    for at in range(0, len(a), 8192):
        part = slice(at, at + 8192)
        apart[part] = np.abs(counts_a[a[part]].astype("int16") - counts_b[b[part]]).sum(axis=1)
    good = apart <= most
    return a[good], b[good], apart[good]


def first_of_groups(groups: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Places of the ``limit`` least by ``order`` of each group."""
    by_group = np.lexsort((order, groups))
    ordered = groups[by_group]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    rank = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(ordered)]))))
    return by_group[rank < limit]


def similar(a: str, b: str, size: int, least: float) -> bool:
    """Whether the shingle sequences of two texts align to at least ``least``."""
    shingles = []
    for text in (a, b):
        hashes = shingle_hashes(words_of(text), size)
        shingles.append(hashes)
    x, y = shingles
    shared = np.intersect1d(x, y)
    # No alignment has more pairs than there are shared items, counted with repeats.
    most = min(int(np.isin(x, shared).sum()), int(np.isin(y, shared).sum()))
    if most < least * (len(x) + len(y) - most):
        return len(x) == len(y) == 0
    return aligned_similarity(x.tolist(), y.tolist(), least) >= least


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    least: float = 0.8,
    sketches: int = 14,
    sampled: int = 2,
    seed: int = 1,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The class of near duplicates of every row: ``class_id`` and ``links``.

    Texts are near duplicates if their sequences of ``size``-word shingles align to a similarity of
    at least ``least`` (see :func:`aligned_similarity`); classes are the connected components.

    1. Texts with the same words form one node, named by the number of its first row (the one with the smallest id), as an id may repeat.
    2. Each node has ``sketches`` order MinHash keys of ``sampled`` shingles. Two texts of similarity s share
       a given key with a chance near s ** sampled, so at 0.8 they miss all 14 once in a million pairs.
    3. A bucket holds the nodes that share a key. Each node is first paired with the smallest and the largest of
       its bucket and with those of the nodes that share the next key too, and the next two. Buckets are
       reduced in map tasks first. Distinct pairs are verified by alignment, and links joined to classes by rounds of
       smallest neighbours, which shrink the links left in each round.
    4. Buckets whose nodes are not of one class by then are cut into bands of length and these into blocks, and all pairs of nodes
       of different classes in the same or neighbouring bands are looked at, block against block (see :func:`unlike_pairs`). A round verifies the most alike pairs of each
       two classes of two blocks; while pairs are left, the next round takes more of those that
       are still of different classes. So every pair that shares a key is aligned, ruled out by its counts or of one
       class by other links.

    Returns per row the id, ``class_id`` (the smallest id of the class), ``links`` (verified links of its node)
    ``keep`` (true for one row of each class) and the columns of ``carry``, which should be narrow. NULL text counts as empty; texts without words
    are one class. Rows with a NULL id are classes of their own with ``class_id`` NULL, and kept. Of rows that
    repeat an id and its words one is kept; texts that differ but share an id are nodes of their own, so that two classes may
    have the same ``class_id``.
    Other columns are ignored; an empty table gives no rows.
    """
    need(docs, [id_col, text_col, *carry])
    clash = {"class_id", "links", "keep"} & {id_col, *carry}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results")
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    id_type = docs.schema[id_col].dataType
    carried = [f"c{n}" for n in range(len(carry))]
    given = docs.select(
        F.col(id_col).alias("id"),
        known_text(text_col).alias("text"),
        *[F.col(c).alias(own) for c, own in zip(carry, carried)],
        F.xxhash64(known_text(text_col)).alias("mark"),
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            digests, keys, numbers, counts = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                shingles = shingle_hashes(words, size)
                own = order_minhash(shingles, sketches, sampled, seed) if len(shingles) else np.empty(0, "uint64")
                keys.append(own.view("int64").tolist())
                numbers.append(len(shingles))
                counts.append(shingle_counts(shingles).tobytes())
            made = [
                pa.array(digests, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(numbers, pa.int64()),
                pa.array(counts, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *made, *batch.columns[2:]], names=["id", "same", "keys", "n", "counts", *carried, "mark"]
            )

    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("same", T.BinaryType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
            T.StructField("n", T.LongType()),
            T.StructField("counts", T.BinaryType()),
            *[f for f in given.schema if f.name in (*carried, "mark")],
        ]
    )
    sketched = scratch.write(
        given.where("id IS NOT NULL").mapInArrow(sketch, schema).withColumn("tag", F.monotonically_increasing_id())
    )
    nodes = scratch.write(
        sketched.groupBy("same").agg(
            F.first("keys").alias("keys"),
            F.first("n").alias("n"),
            F.first("counts").alias("counts"),
            F.min(F.struct("id", "tag", "mark")).alias("first"),
        )
        .select("same", F.col("first.tag").alias("node"), "first.id", "first.mark", "keys", "n", "counts")
    )

    def following(n: Column, s: int) -> Column:
        return F.element_at("keys", ((n + s) % sketches + 1).cast("int"))

    # Bucket names carry the sketch's number, refined by the next key and the next two.
    def bucket(span: int) -> Column:
        return F.transform(
            "keys",
            lambda key, n: F.xxhash64(n, F.lit(span), key, *[following(n, s) for s in range(1, span)]),
        )

    members = nodes.select("node", F.explode(F.concat(*[bucket(s) for s in (1, 2, 3)])).alias("bucket"))
    members = scratch.write(members)
    ends = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    heads = scratch.write(ends.where("low < high"))
    met = members.join(heads, "bucket").select("node", F.explode(F.array("low", "high")).alias("head"))
    # Either order of a pair is one pair; the smaller number is the head.
    pairs = met.where("node != head").select(
        F.least("node", "head").alias("head"), F.greatest("node", "head").alias("node")
    )
    pairs = scratch.write(pairs.distinct())
    scratch.drop(members, heads)

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select("node").unionAll(pairs.select(F.col("head").alias("node"))).distinct()
        wanted = scratch.write(wanted.join(nodes, "node").select("node", "id", "mark"))
        found = _marked(given.select("id", "mark", "text"), wanted).join(wanted, ["id", "mark"])
        texts = scratch.write(found.groupBy("node").agg(F.min("text").alias("text")))
        links = scratch.write(_verified(pairs, texts, size, least))
        scratch.drop(texts, wanted)
        return links

    links = verified(pairs)
    classes = scratch.write(components(links, scratch))
    rest, limit = None, FIRST_PAIRS
    while True:
        open_pairs, rest = _open_pairs(nodes, classes, bucket(1), rest, limit, least, scratch)
        if open_pairs is None:
            break
        more = verified(open_pairs)
        links = links.unionByName(more)
        stars = classes.select(F.col("node").alias("a"), F.col("class_id").alias("b"))
        classes = scratch.write(components(stars.unionByName(more), scratch))
        if rest is None:
            break
        limit *= 8
    links = scratch.write(links.distinct(), links.count())

    counted = links.select("a").unionAll(links.select(F.col("b").alias("a"))).groupBy("a").agg(
        F.count(F.lit(1)).alias("links")
    )
    labels = nodes.join(counted.withColumnRenamed("a", "node"), "node", "left")
    labels = labels.join(classes, "node", "left").select(
        "same",
        "node",
        "id",
        F.coalesce("class_id", "node").alias("class"),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("links"),
    )
    number = nodes.count()
    labels = scratch.write(labels, number)
    firsts = scratch.write(labels.groupBy("class").agg(F.min(F.struct("id", "node")).alias("first")), number)
    labels = scratch.write(
        labels.join(firsts, "class").select(
            "same", F.col("first.id").alias("class_id"), "links", F.col("first.node").alias("kept_tag")
        ),
        number,
    )
    out = sketched.drop("keys", "n", "counts").join(labels, "same")
    out = out.select("id", "class_id", "links", (F.col("tag") == F.col("kept_tag")).alias("keep"), *carried)
    nameless = given.where("id IS NULL").select(
        "id", F.col("id").alias("class_id"), F.lit(0).cast("bigint").alias("links"), F.lit(True).alias("keep"), *carried
    )
    return out.unionByName(nameless).toDF(id_col, "class_id", "links", "keep", *carry)


# Members of a block of a bucket, and pairs of two classes of two blocks in the first round.
BLOCK = 1024
FIRST_PAIRS = 4


def length_band(n: Column, least: float) -> Column:
    """A band of shingle numbers; texts similar to at least ``least`` are in the same band or in neighbouring ones.

    Of two such texts the shorter has at least ``least`` times the shingles of the longer. Bands are a little wider
    than that, so that rounding cannot move a text two bands on.
    """
    return F.floor(F.log(n.cast("double")) / F.lit(math.log((1 + 1e-6) / max(least, 1e-9))))


def _open_pairs(
    nodes: DataFrame,
    classes: DataFrame,
    buckets: Column,
    rest: DataFrame | None,
    limit: int,
    least: float,
    scratch: Scratch,
) -> tuple[DataFrame | None, DataFrame | None]:
    """Pairs (head, node) of different classes in the same bucket, and the slots (bucket, slot) where ``limit`` left out some.

    Slot s of a bucket is for the pairs within length band s and those of band s and the next; no others can be
    similar. Only slots in ``rest`` are looked at, if it is given. None stands for no pairs or no slots.
    """
    known = nodes.join(classes, "node", "left").select(
        "node", F.coalesce("class_id", "node").alias("class"), "n", "keys", "counts"
    )
    known = scratch.write(known)
    members = known.select(
        "node",
        "class",
        length_band(F.col("n"), least).alias("band"),
        F.posexplode(F.transform(buckets, lambda b: b)).alias("sketch", "bucket"),
    )
    # Most buckets are of one class and left out before their members are given slots.
    several = members.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    several = scratch.write(several.where("low < high").select("bucket"))
    members = scratch.write(
        members.join(several, "bucket").withColumn("slot", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    )
    looked_at = members if rest is None else members.join(rest, ["bucket", "slot"], "left_semi")
    own = F.col("band") == F.col("slot")
    mixed = looked_at.groupBy("bucket", "slot").agg(
        F.ceil(F.count_if(own) / BLOCK).alias("blocks"),
        F.ceil(F.count_if(~own) / BLOCK).alias("upper"),
        F.min("class").alias("low"),
        F.max("class").alias("high"),
    )
    mixed = scratch.write(mixed.where("blocks > 0 AND low < high").drop("low", "high"))
    placed = members.drop("class").join(mixed, ["bucket", "slot"])
    # A salt for each bucket, so that no two nodes meet in one block everywhere. Blocks of the upper band are numbered
    # behind the others, and meet only those.
    salted = F.xxhash64("node", "bucket")
    block = F.when(own, F.pmod(salted, "blocks")).otherwise(F.col("blocks") + F.pmod(salted, "upper"))
    last = F.when(own, F.col("blocks") + F.col("upper") - 1).otherwise(F.col("blocks") - 1)
    placed = placed.withColumn("block", block).withColumn("last", last)
    # A node's sketches are fetched once for all its places.
    places = scratch.write(
        placed.groupBy("node").agg(F.collect_list(F.struct("bucket", "slot", "sketch", "block", "last")).alias("places"))
    )
    # Blocks, not members, are repeated for every other block.
    one = (
        places.join(known, "node")
        .select(F.explode("places").alias("place"), F.struct("node", "class", "n", "keys", "counts").alias("own"))
        .groupBy("place")
        .agg(F.collect_list("own").alias("own"))
        .select("place.*", "own")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")))
    )
    met = (
        one.groupBy(
            "bucket", "slot", "sketch", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
        )
        .agg(F.collect_list("own").alias("sides"))
        # A block that has no members leaves its partner alone.
        .where((F.col("low") == F.col("high")) | (F.size("sides") == 2))
    )

    def side(own: pa.StructArray, codes: np.ndarray) -> tuple:
        numbers = own.field("n").to_numpy(zero_copy_only=False)
        keys = own.field("keys").flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)
        counts = np.frombuffer(b"".join(own.field("counts").to_pylist()), dtype="uint8").reshape(len(own), -1)
        return codes, numbers, keys, counts

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3))
            for bucket, slot, sketch, lists in slots:
                parts = [p.values for p in lists.values]
                every = pa.concat_arrays([p.field("class") for p in parts])
                codes = every.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype("int64")
                if codes.max() == 0:
                    continue
                sides = [side(parts[0], codes[: len(parts[0])])]
                if len(parts) > 1:
                    sides.append(side(parts[1], codes[len(parts[0]) :]))
                a, b, apart = unlike_pairs(sides[0], sides[1] if len(sides) > 1 else None, sketch, least)
                if not len(a):
                    continue
                x, y = sides[0][0][a], sides[-1][0][b]
                taken = first_of_groups(np.minimum(x, y) * len(codes) + np.maximum(x, y), apart, limit)
                yield pa.RecordBatch.from_arrays(
                    [
                        parts[0].field("node").take(pa.array(a[taken])),
                        parts[-1].field("node").take(pa.array(b[taken])),
                        pa.array([bucket] * len(taken), pa.int64()),
                        pa.array([slot] * len(taken), pa.int64()),
                        pa.array([len(taken) < len(a)] * len(taken), pa.bool_()),
                    ],
                    names=["head", "node", "bucket", "slot", "more"],
                )

    schema = T.StructType(
        [
            T.StructField("head", T.LongType()),
            T.StructField("node", T.LongType()),
            T.StructField("bucket", T.LongType()),
            T.StructField("slot", T.LongType()),
            T.StructField("more", T.BooleanType()),
        ]
    )
    found = scratch.write(met.select("bucket", "slot", "sketch", "sides").mapInArrow(compare, schema))
    scratch.drop(known, several, members, places, mixed)
    number = found.count()
    rest = scratch.write(found.where("more").select("bucket", "slot").distinct(), number)
    pairs = found.select(F.least("head", "node").alias("head"), F.greatest("head", "node").alias("node"))
    return pairs.distinct() if number else None, None if rest.isEmpty() else rest


# Bits of the map of wanted marks: so many for each, and at most.
BITS_EACH = 64
MOST_BITS = 1 << 28


def _marked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``mark`` may be in ``wanted``: all that are, and about one in ``BITS_EACH`` of the others.

    Where ``wanted`` is too long to be broadcast, its join would shuffle every text. A map with a bit for each
    residue of the marks has ``MOST_BITS`` / 8 bytes at most, so it is always broadcast; the exact join follows.
    """
    bits = min(max(BITS_EACH * wanted.count(), 1 << 15), MOST_BITS)
    bit = F.pmod("mark", F.lit(bits))
    maps = wanted.groupBy(F.bitmap_bucket_number(bit).alias("__map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("__bits")
    )
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        texts.withColumn("__map", F.bitmap_bucket_number(bit))
        .join(F.broadcast(maps), "__map")
        .where(F.getbit(byte, (place % 8).cast("int")) == 1)
        .select(texts.columns)
    )


def _verified(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs whose texts are similar, as links (a, b)."""
    left = pairs.join(texts.withColumnRenamed("text", "x"), "node")
    both = left.join(texts.withColumnsRenamed({"node": "head", "text": "y"}), "head")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            good = pa.array([similar(x, y, size, least) for x, y in texts], pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(good)

    return both.select("head", "node", "x", "y").mapInArrow(verify, "a bigint, b bigint")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``links`` (a, b): node and ``class_id``, the smallest node of its component.

    Rounds of large and small stars: each node ties its larger neighbours, then its smaller ones, to
    the smallest neighbour. Components become stars in a number of rounds that grows with the
    logarithm of their size. A hot node is a key of grouped minima and joins only.
    """
    edges = scratch.write(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        number, settled = _stars(edges)
        if settled:
            break
        # No table of a round has more rows than both ends of its edges.
        most = 2 * number
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that AQE can split the join at a node with very many neighbours.
        least = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), most)
        large = scratch.write(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), most
        )
        least_small = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), most)
        small = large.join(least_small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        following = small.unionByName(least_small.select("u", F.col("m").alias("v"))).distinct()
        following = scratch.write(following, most)
        scratch.drop(edges, large, least, least_small)
        edges = following
    # Every node but the smallest of a component is now tied to that one alone.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("class_id"))


def _stars(edges: DataFrame) -> tuple[int, bool]:
    """The number of ``edges`` (u, v), and whether each u has one edge and no v is a u: then no round changes them."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    of_node = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    number, torn = of_node.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if(F.expr("up > 1 OR up + down > 1"))).first()
    return number, torn == 0
