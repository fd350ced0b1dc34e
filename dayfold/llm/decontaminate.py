"""Benchmark decontamination by a distributed positional inverted index."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.tables import Scratch, known_text, need

# Characters up to DEL that are in no word, and the letters made small.
APART = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
LARGE, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Up to this many terms, some tens of MB, a list of terms is broadcast; a longer one is joined by shuffle.
MOST_BROADCAST = 500_000


def _list(terms: DataFrame) -> DataFrame:
    """``terms``, a written table, to be broadcast if it is counted to be small."""
    return F.broadcast(terms) if terms.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else terms


def words_column(text: Column) -> Column:
    """The words of a text as an array, A-Z made small; characters beyond ASCII are in words."""
    plain = F.translate(text, LARGE + APART, SMALL + " " * len(APART))
    return F.array_remove(F.split(plain, " "), "")


@dataclass
class Index:
    """Stored postings (term, id, position) of training texts for the terms that queries look up."""

    postings: DataFrame

    @staticmethod
    def build(words: DataFrame, terms: DataFrame, scratch: Scratch) -> Index:
        """Index the ``terms`` (term) in ``words`` (id, words); other words need no postings."""
        rows = words.select("id", F.posexplode("words").alias("position", "term"))
        found = rows.join(_list(scratch.write(terms)), "term", "left_semi")
        return Index(scratch.write(found.select("term", "id", "position")))

    def starts(self, rarest: DataFrame) -> DataFrame:
        """The lists of ``rarest`` (phrase, term, offset), moved back by the offset: id, phrase, start."""
        moved = self.postings.join(rarest, "term")
        start = F.col("position") - F.col("offset")
        return moved.select("id", "phrase", start.alias("start")).where("start >= 0")

    def meeting(self, starts: DataFrame, others: DataFrame) -> DataFrame:
        """The ``starts`` at which every term of ``others`` (phrase, term, offset) is in its place.

        The candidates look their terms up, so a frequent term's list is met by the few candidates
        and not multiplied by phrases.
        """
        wanted = starts.join(others, "phrase").withColumn("position", F.col("start") + F.col("offset"))
        found = wanted.join(self.postings, ["id", "term", "position"], "left_semi")
        met = found.groupBy("id", "phrase", "start").agg(F.count_distinct("offset").alias("met"))
        needed = others.groupBy("phrase").agg(F.count(F.lit(1)).alias("needed"))
        checked = starts.join(needed, "phrase", "left").join(met, ["id", "phrase", "start"], "left")
        return checked.where(F.coalesce("met", F.lit(0)) >= F.coalesce("needed", F.lit(0))).select(*starts.columns)

    def near(self, listed: DataFrame, slop: int) -> DataFrame:
        """Starts (id, phrase, start) where ``needed`` of the lists of ``listed`` are at most ``slop`` words off.

        ``listed`` has (phrase, term, offset, rank, needed). A posting stands for the starts around it; those of
        one start are merged as bits of the ranks that are met.
        """
        bit = F.expr("shiftleft(1L, rank - 1)").alias("bit")
        moved = self.postings.join(listed, "term").select(
            "id", "phrase", "needed", (F.col("position") - F.col("offset")).alias("start"), bit
        )
        # Most texts have too few of a phrase's terms anywhere; their starts need not be multiplied.
        anywhere = moved.groupBy("id", "phrase").agg(
            F.bit_or("bit").alias("met"), F.max("needed").alias("needed"), F.collect_list(F.struct("start", "bit")).alias("own")
        )
        around = (
            anywhere.where(F.bit_count("met") >= F.col("needed"))
            .select("id", "phrase", "needed", F.explode("own").alias("own"))
            .select(
                "id", "phrase", "needed", "own.bit", F.explode(F.sequence(F.col("own.start") - slop, F.col("own.start") + slop)).alias("start")
            )
        )
        met = around.groupBy("id", "phrase", "start").agg(F.bit_or("bit").alias("met"), F.max("needed").alias("needed"))
        return met.where(F.bit_count("met") >= F.col("needed")).select("id", "phrase", "start")


def term_counts(words: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of ``terms`` (term) occurs in ``words``; map tasks count first."""
    rows = words.select(F.explode("words").alias("term")).join(_list(terms), "term", "left_semi")
    counts = rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return terms.join(counts, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """All windows of ``size`` words of ``items`` (item, words); shorter items are one window each.

    Columns ``window`` (its words), ``item`` and ``at`` (the place in the item).
    """
    length = F.size("words")
    first = F.sequence(F.lit(0), F.greatest(length - size, F.lit(0)))
    return (
        items.where(length > 0)
        .select("item", "words", F.explode(first).alias("at"))
        .select("item", "at", F.slice("words", F.col("at") + 1, size).alias("window"))
    )


class Phrases:
    """The distinct windows of a benchmark with their rarest terms in a training corpus."""

    def __init__(self, items: DataFrame, words: DataFrame, size: int, lists: int, scratch: Scratch):
        windows = scratch.write(windows_of(items, size).select("item", "window", F.xxhash64("window").alias("phrase")))
        self.items = windows.select("phrase", "window", "item").distinct()
        self.windows = scratch.write(windows.select("phrase", "window").distinct())
        placed = self.windows.select("phrase", F.posexplode("window").alias("offset", "term"))
        terms = scratch.write(placed.select("term").distinct())
        counts = scratch.write(term_counts(words, terms))
        by_count = Window.partitionBy("phrase").orderBy("n", "offset")
        ranked = placed.join(counts, "term").withColumns(
            {"rank": F.row_number().over(by_count), "least": F.min("n").over(Window.partitionBy("phrase"))}
        )
        self.ranked = scratch.write(ranked.select("phrase", "term", "offset", "rank", "least"))
        # A phrase with a term that no text has occurs nowhere.
        self.rarest = self.ranked.where((F.col("least") > 0) & (F.col("rank") <= lists)).drop("least")

    def terms(self) -> DataFrame:
        return self.rarest.select("term").distinct()


def _prepared(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str,
    text_col: str,
    item_col: str,
    item_text_col: str,
    others: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    need(docs, [id_col, text_col])
    need(benchmark, [item_col, item_text_col])
    more = [F.col(c).alias(f"c{n}") for n, c in enumerate(others)]
    texts = docs.select(F.col(id_col).alias("id"), known_text(text_col).alias("text"), *more)
    items = benchmark.select(F.col(item_col).alias("item"), words_column(known_text(item_text_col)).alias("words"))
    return texts, items, texts.where("id IS NOT NULL").select("id", words_column(F.col("text")).alias("words"))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    lists: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The words of every document that lie in passages of the benchmark.

    A passage is a window of ``size`` consecutive words of an item; shorter items are one window.
    Terms of windows are counted over all documents, and postings are stored for the ``lists`` rarest
    of each. The list of the rarest, moved back by its offset, gives candidate starts; those at which the
    others of them are in place too are compared with the whole window in the text. All of it are joins
    and grouped sums: windows and terms grow with the benchmark, candidates with what is found.

    Returns one row per document: the id, ``n_words``, ``n_hit`` (words inside any window), ``n_items``,
    ``items`` (sorted texts of the ids of the items that have such windows) and ``contaminated``. NULL text has no words; items
    with a NULL id are matched, but not listed. Rows with a NULL id are checked like others; repeated rows are
    checked each; other columns are ignored; an empty table gives no rows, and an empty benchmark no hits.
    """
    scratch = Scratch(docs.sparkSession, "contamination")
    names = (id_col, text_col, item_col, item_text_col)
    checked, phrases = _checked(docs, benchmark, size, lists, names, (), scratch)
    found = F.array_distinct(F.transform("hits", lambda h: F.struct(h["phrase"], h["window"])))
    checked = scratch.write(
        checked.select("id", "n_words", "n_hit", found.alias("found"), F.monotonically_increasing_id().alias("row"))
    )
    found = checked.select("row", F.explode("found").alias("f")).select("row", "f.phrase", "f.window")
    listed = scratch.write(phrases.items.where("item IS NOT NULL"))
    named = found.join(listed, ["phrase", "window"]).select("row", F.col("item").cast("string").alias("item"))
    named = scratch.write(named.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))
    out = checked.drop("found").join(named, "row", "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_hit",
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    lists: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with their columns, that have no word in a passage of the benchmark.

    As :func:`find_contamination`, with the same rules for NULL, empty and repeated rows; a NULL text stays NULL.
    """
    scratch = Scratch(docs.sparkSession, "contamination")
    names = (id_col, text_col, item_col, item_text_col)
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    marked = docs.withColumn("__no_text", F.col(text_col).isNull())
    checked, _ = _checked(marked, benchmark, size, lists, names, [*others, "__no_text"], scratch)
    text = F.when(~F.col(f"c{len(others)}"), F.col("text"))
    kept = {id_col: F.col("id"), text_col: text} | {c: F.col(f"c{n}") for n, c in enumerate(others)}
    return checked.where("n_hit = 0").select([kept[c].alias(c) for c in docs.columns])


def _checked(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int,
    lists: int,
    names: tuple[str, str, str, str],
    others: Sequence[str],
    scratch: Scratch,
) -> tuple[DataFrame, Phrases]:
    """Every row with ``n_words``, ``n_hit`` and ``hits``, and the phrases looked for."""
    texts, items, _ = _prepared(docs, benchmark, *names, others)
    # A hash of the id and the text names a row, so that NULL and repeated ids are no trouble.
    texts = texts.withColumn("row", F.xxhash64("id", "text"))
    words = texts.select(F.col("row").alias("id"), words_column(F.col("text")).alias("words"))
    phrases = Phrases(items, words, size, lists, scratch)
    index = Index.build(words, phrases.terms(), scratch)
    starts = scratch.write(index.starts(phrases.rarest.where("rank = 1")))
    met = index.meeting(starts, phrases.rarest.where("rank > 1"))
    candidates = scratch.write(
        met.join(phrases.windows, "phrase")
        .groupBy(F.col("id").alias("row"))
        .agg(F.collect_set(F.struct("start", "phrase", "window")).alias("candidates"))
    )
    scratch.drop(starts, index.postings)
    kept = [c for c in texts.columns if c != "row"]
    is_there = lambda c: F.slice("words", c["start"] + 1, F.size(c["window"])) == c["window"]
    checked = (
        texts.join(candidates, "row", "left")
        .select(*kept, words_column(F.col("text")).alias("words"), "candidates")
        .select(
            *kept,
            F.size("words").cast("bigint").alias("n_words"),
            F.when(F.col("candidates").isNotNull(), F.array_sort(F.filter("candidates", is_there))).alias("hits"),
        )
    )
    return checked.withColumn("n_hit", F.coalesce(_covered(F.col("hits")), F.lit(0)).cast("bigint")), phrases


def _covered(hits: Column) -> Column:
    """How many places the intervals from ``start``, sorted by it, cover together."""
    start = F.struct(F.lit(0).alias("until"), F.lit(0).alias("total"))

    def add(so_far: Column, hit: Column) -> Column:
        end = (hit["start"] + F.size(hit["window"])).cast("int")
        new = F.greatest(end - F.greatest(hit["start"].cast("int"), so_far["until"]), F.lit(0))
        return F.struct(F.greatest(so_far["until"], end).alias("until"), (so_far["total"] + new).alias("total"))

    return F.aggregate(hits, start, add, lambda s: s["total"])


def find_near_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    share: float = 0.8,
    slop: int = 2,
    lists: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Proximity matches: passages of the benchmark in which words were changed, put in or left out.

    A window (as in :func:`find_contamination`) is near a start if at least ``share`` of its words stand in the text at most
    ``slop`` words off their places, counted from that start. Each place of the window counts once; the words
    may be in another order within the slop, and the start may lie before the text, where the first words are missing.

    Terms that no document has are the rarest ones and cannot be met. If a window of n words may lack
    n - m of them, any ``lists`` of its terms (more if n - m is not smaller) have at least lists - (n - m) that are met. So the postings of
    the rarest ``lists`` terms alone give the candidates, and no match is lost; all words of a candidate are then looked
    up in the text. Candidates grow with the postings of terms that are rare in their window.

    Returns one row per different (id, text) of the documents and item with matches: the id, the item, ``window_words``
    (of one window), ``n_windows`` (its different windows that are near), ``most_met`` (the most words met in one of them) and
    ``first_start`` (the smallest start of a match in the text, from 0). NULL and empty texts have no words and no matches. Rows and
    items with a NULL id are matched like others and returned with it; repeated rows and items count once; other columns are
    ignored; empty tables give no rows. A window has at most 63 words.
    """
    if not (1 <= size <= 63 and 0 < share <= 1 and slop >= 0 and lists >= 1):
        raise ValueError("size must be 1 to 63, share above 0 and at most 1, slop at least 0, lists at least 1")
    texts, items, _ = _prepared(docs, benchmark, id_col, text_col, item_col, item_text_col)
    scratch = Scratch(docs.sparkSession, "near-passages")
    texts = texts.withColumn("row", F.xxhash64("id", "text"))
    words = texts.select(F.col("row").alias("id"), words_column(F.col("text")).alias("words"))
    phrases = Phrases(items, words, size, lists, scratch)
    lengths = phrases.windows.select("phrase", F.size("window").alias("n")).groupBy("phrase").agg(F.max("n").alias("n"))
    least = F.ceil(F.round(F.col("n") * share, 6)).cast("int")
    taken = F.least(F.greatest(F.lit(lists), F.col("n") - least + 1), F.col("n"))
    listed = phrases.ranked.join(lengths.withColumns({"least_met": least, "taken": taken}), "phrase")
    listed = listed.where("rank <= taken").select(
        "phrase", "term", "offset", "rank", (F.col("taken") - F.col("n") + F.col("least_met")).alias("needed")
    )
    listed = scratch.write(listed)
    index = Index.build(words, listed.select("term").distinct(), scratch)
    starts = index.near(listed, slop).groupBy(F.col("id").alias("row"), "phrase").agg(F.collect_list("start").alias("starts"))
    candidates = scratch.write(
        starts.join(phrases.windows, "phrase")
        .groupBy("row")
        .agg(F.collect_list(F.struct("phrase", "window", "starts")).alias("candidates"))
    )
    scratch.drop(index.postings)

    def met_at(window: Column, start: Column) -> Column:
        """How many words of ``window`` are near their places from ``start`` on."""

        def is_near(term: Column, offset: Column) -> Column:
            first = F.greatest(start + offset - slop, F.lit(0)).cast("int")
            length = F.greatest((start + offset + slop + 1).cast("int") - first, F.lit(0))
            return F.array_contains(F.slice("words", first + 1, length), term)

        return F.size(F.filter(window, is_near))

    def looked_up(c: Column) -> Column:
        met = F.transform(c["starts"], lambda s: F.struct(met_at(c["window"], s).alias("met"), s.alias("start")))
        enough = F.filter(met, lambda m: m["met"] >= F.ceil(F.round(F.size(c["window"]) * F.lit(share), 6)))
        return F.struct(c["phrase"].alias("phrase"), c["window"].alias("window"), enough.alias("met"))

    # Written, as Spark would else put the splitting of the text into the lambdas, and do it anew for every word looked up.
    texts = scratch.write(
        texts.join(candidates, "row").select("id", "row", words_column(F.col("text")).alias("words"), "candidates")
    )
    scratch.drop(candidates)
    met = F.filter(F.transform("candidates", looked_up), lambda f: F.size(f["met"]) > 0)
    # And so is what was found, as the array would be made again to leave out empty ones.
    found = scratch.write(texts.select("id", "row", met.alias("found")))
    scratch.drop(texts)
    found = found.select("id", "row", F.explode("found").alias("f")).select(
        "id", "row", "f.phrase", "f.window", F.array_max("f.met.met").alias("met"), F.array_min("f.met.start").alias("start")
    )
    named = found.join(phrases.items, ["phrase", "window"])
    return (
        named.groupBy("row", "id", "item")
        .agg(
            F.max(F.size("window")).alias("window_words"),
            F.count_distinct("window").alias("n_windows"),
            F.max("met").alias("most_met"),
            F.min("start").cast("bigint").alias("first_start"),
        )
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "window_words", "n_windows", "most_met", "first_start")
    )
