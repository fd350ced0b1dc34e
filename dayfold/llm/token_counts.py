"""Token counts by a count-only Viterbi search over a unigram vocabulary."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.tables import known_text, need

SPACE = "▁"  # stands for a blank in vocabulary files of this kind
UNKNOWN_PENALTY = 10.0  # fixed value: an unknown character scores this much below the worst piece
# Entries of a worker's table, beyond which it starts anew, and the longest one kept: at most 26 million characters.
SEGMENTS_IN_MEMORY, LONGEST_IN_MEMORY = 400_000, 64


@dataclass
class Vocabulary:
    """Pieces with their scores; unknown characters fall back to bytes or to one unknown piece."""

    scores: dict[str, float]
    bytes_fallback: bool

    @property
    def unknown_score(self) -> float:
        return min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY

    @property
    def breaks_at_spaces(self) -> bool:
        """Whether no piece has a blank behind another character."""
        return not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.scores)


def read_vocabulary(path: str) -> Vocabulary:
    """The ordinary pieces of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    scores = {model.id_to_piece(i): model.get_score(i) for i in ids if not any(is_(i) for is_ in special)}
    return Vocabulary(scores, any(model.is_byte(i) for i in ids))


class Counter:
    """Piece counts of best segmentations.

    The automaton names every piece that ends at a character, longest first. A
    later one replaces the best so far only if its score is higher, so of equal
    scores the longest last piece wins, as in the tokenizers' own search. Only the
    best score and the count up to each place are kept.
    """

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.scores, self.bytes_fallback = vocabulary.scores, vocabulary.bytes_fallback
        self.unknown = vocabulary.unknown_score
        self.by_segment = vocabulary.breaks_at_spaces
        self.find = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.find.add_word(piece, (len(piece), score))
        self.find.make_automaton()
        self.segments = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.known: dict[str, tuple[int, float]] = {}

    def segment(self, text: str) -> tuple[int, float]:
        """Count and score of the best segmentation of ``text``."""
        best, count, run = [0.0], [0], [False]
        reached, known = 0, self.scores
        for last, (size, score) in self.find.iter(text) if len(known) else ():
            end = last + 1
            while reached < end:
                # Every place before ``end`` has all its candidates now but the unknown one.
                self._settle(text, reached, best, count, run)
                best.append(float("-inf"))
                count.append(0)
                run.append(False)
                reached += 1
            candidate = best[end - size] + score
            if candidate > best[end]:
                best[end], count[end], run[end] = candidate, count[end - size] + 1, False
        while reached < len(text):
            self._settle(text, reached, best, count, run)
            best.append(float("-inf"))
            count.append(0)
            run.append(False)
            reached += 1
        self._settle(text, reached, best, count, run)
        return count[-1], best[-1]

    def _settle(self, text: str, end: int, best: list, count: list, run: list) -> None:
        """Offer the unknown character that ends at ``end``, after all pieces that do."""
        if not end or text[end - 1] in self.scores:
            return
        candidate = best[end - 1] + self.unknown
        if candidate > best[end]:
            pieces = len(text[end - 1].encode("utf-8", "surrogatepass")) if self.bytes_fallback else not run[end - 1]
            best[end], count[end], run[end] = candidate, count[end - 1] + pieces, True

    def count(self, text: str) -> tuple[int, float]:
        """Pieces and score of a whole text with a blank put before it; nothing for an empty one."""
        if not text:
            return 0, 0.0
        text = SPACE + text.replace(" ", SPACE)
        if not self.by_segment:
            return self.segment(text)
        pieces, total, known = 0, 0.0, self.known
        if SPACE * 2 not in text and text[-1] != SPACE:
            parts = [SPACE + part for part in text[1:].split(SPACE)]
        else:
            parts = self.segments.findall(text)
        for part in parts:
            found = known.get(part)
            if found is None:
                found = self.segment(part)
                if len(part) <= LONGEST_IN_MEMORY:
                    if len(known) >= SEGMENTS_IN_MEMORY:
                        known.clear()
                    known[part] = found
            pieces += found[0]
            total += found[1]
        return pieces, total


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``n_tokens`` and ``token_score`` of every whole text, without a shuffle.

    The vocabulary file gives pieces and scores; a text's tokens are those of the
    segmentation with the highest sum of scores. Where no piece has a blank behind another
    character, a text falls into segments at its blanks whose best
    segmentations are independent, and a worker remembers those it has seen.

    NULL and empty text have 0 tokens and score 0. Repeated rows are counted each;
    other columns are ignored; an empty table gives no rows.
    """
    need(docs, [id_col, text_col])
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("token_score", T.DoubleType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(read_vocabulary(vocabulary))
        for batch in batches:
            found = [counter.count(text) for text in batch.column(1).to_pylist()]
            arrays = [
                batch.column(0),
                pa.array([n for n, _ in found], type=pa.int64()),
                pa.array([s for _, s in found], type=pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(F.col(id_col), known_text(text_col).alias("__text")).mapInArrow(count, schema)
