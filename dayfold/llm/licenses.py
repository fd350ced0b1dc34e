"""Licence notices and identifier expressions in texts."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.spdx import EXCEPTIONS, LICENSES
from dayfold.llm.tables import known_text, need

# Phrases that count as base notices, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notice phrases and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person": "mit",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "boost software license": "bsl",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

# Identifiers (lower case) and their labels; others take those of their families below.
IDENTIFIERS = {
    "mit": "mit",
    "mit-0": "mit",
    "apache-2.0": "apache-2",
    "bsd-2-clause": "bsd",
    "bsd-3-clause": "bsd",
    "isc": "isc",
    "zlib": "zlib",
    "unlicense": "public-domain",
    "cc0-1.0": "cc0",
    "cc-by-4.0": "cc-by",
    "cc-by-sa-4.0": "cc-by-sa",
    "cc-by-nc-4.0": "cc-by-nc",
    "cc-by-nd-4.0": "cc-by-nd",
    "gpl-2.0": "gpl",
    "gpl-2.0-only": "gpl",
    "gpl-2.0-or-later": "gpl",
    "gpl-3.0": "gpl",
    "gpl-3.0-only": "gpl",
    "gpl-3.0-or-later": "gpl",
    "lgpl-2.1-only": "lgpl",
    "lgpl-2.1-or-later": "lgpl",
    "lgpl-3.0-only": "lgpl",
    "lgpl-3.0-or-later": "lgpl",
    "agpl-3.0-only": "agpl",
    "agpl-3.0-or-later": "agpl",
    "mpl-2.0": "mpl",
    "epl-2.0": "epl",
    "bsl-1.0": "bsl",
}

# Identifiers of other versions of a family, and its label.
FAMILIES = [
    (re.compile(r"(gpl|lgpl|agpl|mpl|epl)-[0-9].*"), None),
    (re.compile(r"bsd-[0-9]-clause(-[a-z]+)?"), "bsd"),
    (re.compile(r"apache-2\.[0-9]+"), "apache-2"),
    (re.compile(r"cc-by-(nc|nc-nd|nc-sa)-[0-9].*"), "cc-by-nc"),
    (re.compile(r"cc-by-sa-[0-9].*"), "cc-by-sa"),
    (re.compile(r"cc-by-nd-[0-9].*"), "cc-by-nd"),
    (re.compile(r"cc-by-[0-9].*"), "cc-by"),
]

# Labels under which a text may be used, unless others are given.
PERMISSIVE = frozenset({"mit", "apache-2", "bsd", "isc", "zlib", "bsl", "cc0", "cc-by", "public-domain"})

TAG = "spdx license identifier"
TAG_TEXT = re.compile(r"spdx[- ]license[- ]identifier\s*:[ \t]*")
LINE = re.compile(r"[^\r\n]*")
# A line of an expression whose brackets are open: marks of comments, then words, brackets and signs of identifiers.
GOES_ON = re.compile(r"(?:\r\n|\r|\n)[ \t#*/;!%-]*([a-z0-9.+() \t/*-]+)(?=[\r\n]|\Z)")
SLASH = re.compile(r"(?<=[a-z0-9.+)])/(?=[a-z0-9(])")
TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")
PRECEDENCE = {"with": 3, "and": 2, "or": 1}

# Bytes outside words become blanks and A-Z small; everything else stays.
TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def label_of(identifier: str) -> str | None:
    """The label of an identifier, or that of its family for another version."""
    own = identifier.removesuffix("+")
    if own in IDENTIFIERS:
        return IDENTIFIERS[own]
    for pattern, label in FAMILIES:
        if found := pattern.fullmatch(own):
            return label or found[1]
    return None


def _is_exception(token: str) -> bool:
    return token in EXCEPTIONS or "exception" in token


def _is_operand(token: str, after_with: bool) -> bool:
    """Listed or well-formed identifiers, and exceptions behind ``with``."""
    if after_with:
        return _is_exception(token)
    own = token.removesuffix("+")
    return (
        own in IDENTIFIERS
        or own in LICENSES
        or token in LICENSES
        or own.startswith("licenseref-")
        or re.search(r"-[0-9]+(\.[0-9]+)*(-|$)", own) is not None
    )


def complete_prefix(text: str) -> tuple[list[str], bool]:
    """The tokens of the longest start of ``text`` that is a whole expression, and whether it binds to more.

    Behind an operator or a bracket any word is an operand, though an unknown one, if an operator, a
    closing bracket or the end follows; before other words it belongs to a sentence and ends the expression. A
    start that ``and`` or ``with`` ties to something left out binds to more, and so does what stands in a bracket
    that is not a whole expression. A slash between words is ``or``.
    """
    found = TOKEN.findall(SLASH.sub(" or ", text))
    tokens, depth, operand, whole = [], 0, True, 0
    for token, behind in zip(found, [*found[1:], ")"]):
        if operand:
            if token == "(":
                depth += 1
            elif _is_operand(token, bool(tokens) and tokens[-1] == "with"):
                operand = False
            elif tokens and token not in PRECEDENCE and token != ")" and (behind == ")" or behind in PRECEDENCE):
                operand = False
            else:
                break
        elif token == ")" and depth:
            depth -= 1
        elif token in PRECEDENCE:
            operand = True
        else:
            break
        tokens.append(token)
        if not operand and not depth:
            whole = len(tokens)
    if not whole and tokens and tokens[0] == "(":
        return complete_prefix(" ".join(found[1:]))[0], True
    return tokens[:whole], found[whole : whole + 1] in (["and"], ["with"])


def tag_texts(text: str) -> Iterator[str]:
    """What stands behind each identifier tag to the end of its line, or to the line in which its brackets close."""
    for found in TAG_TEXT.finditer(text):
        start = end = found.end()
        while True:
            line = LINE.match(text, end)
            end = line.end()
            depth = text.count("(", start, end) - text.count(")", start, end)
            following = GOES_ON.match(text, end) if depth > 0 else None
            if not following:
                break
            end = following.start(1)
        yield text[start:end]


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands in their order, each operator behind its operands."""
    out: list[str] = []
    waiting: list[str] = []
    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif token in PRECEDENCE:
            while waiting and PRECEDENCE.get(waiting[-1], 0) >= PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
        else:
            out.append(token)
    return out + waiting[::-1]


@dataclass
class Terms:
    """What an expression stands for: labels, whether it may be used, and its text."""

    labels: set[str] = field(default_factory=set)
    allowed: bool = False
    text: str = ""


def evaluate(postfix: list[str], allowed: frozenset[str]) -> Terms:
    """``or`` offers a choice, ``and`` binds to both, ``with`` adds an exception to a licence."""
    stack: list[Terms] = []
    for token in postfix:
        if token not in PRECEDENCE:
            label = label_of(token)
            stack.append(Terms({label} if label else set(), label in allowed, token))
            continue
        right, left = stack.pop(), stack.pop()
        text = f"({left.text} {token} {right.text})"
        if token == "with":
            # What an unknown exception says is not known, so it is not usable.
            stack.append(Terms(left.labels, left.allowed and _is_exception(right.text), text))
        elif token == "and":
            stack.append(Terms(left.labels | right.labels, left.allowed and right.allowed, text))
        else:
            stack.append(Terms(left.labels | right.labels, left.allowed or right.allowed, text))
    return stack.pop() if stack else Terms()


class Scanner:
    """All notices of one text in a single pass of an Aho-Corasick automaton."""

    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str], allowed: frozenset[str]):
        import ahocorasick

        self.base, self.notices, self.allowed = dict(base), dict(notices), allowed
        self.find = ahocorasick.Automaton()
        for phrase in {*base, *notices, TAG}:
            # As the text, phrases are read byte by byte, with a blank around each word.
            self.find.add_word(f" {phrase} ".encode().decode("latin-1"), phrase)
        self.find.make_automaton()

    def scan(self, text: str) -> tuple:
        words = text.encode("utf-8", "surrogatepass").translate(TO_WORDS).split()
        line = f" {b' '.join(words).decode('latin-1')} "
        starts, base_labels, labels, expressions, at, word = [], set(), set(), [], 0, 0
        certain, usable = 1.0, None
        # Sorted by start, the words before each hit are counted on from the last.
        hits = sorted((end - len(phrase.encode()) - 1, phrase) for end, phrase in self.find.iter(line))
        for start, phrase in hits:
            word += line.count(" ", at, start)
            at = start
            if phrase in self.base:
                starts.append(word)
                base_labels.add(self.base[phrase])
                certain *= 0.1
            if phrase in self.notices:
                labels.add(self.notices[phrase])
                certain *= 0.3
        if any(phrase == TAG for _, phrase in hits):
            for found in tag_texts(text.lower()):
                tokens, binds = complete_prefix(found)
                terms = evaluate(to_postfix(tokens), self.allowed)
                if terms.text:
                    expressions.append(terms.text)
                    labels |= terms.labels
                    # What an expression is tied to and is not read may forbid anything.
                    own = terms.allowed and not binds
                    usable = own if usable is None else usable and own
                    certain *= 0.05 if terms.labels else 0.5
        labels |= base_labels
        if usable is None and labels:
            usable = labels <= self.allowed
        return (
            len(words),
            len(starts),
            starts[0] if starts else None,
            starts[-1] if starts else None,
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels)),
            1.0 - certain,
            ";".join(expressions),
            usable,
        )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: Mapping[str, str] = BASE,
    notices: Mapping[str, str] = NOTICES,
    allowed: frozenset[str] = PERMISSIVE,
) -> DataFrame:
    """Licence notices of every text, found in one pass and without a shuffle.

    Texts are lower-cased in A-Z and read as words of digits, letters a-z and
    characters beyond ASCII. ``n_base`` counts all places of the ``base`` phrases, also
    overlapping ones, and ``first_word`` and ``last_word`` are their first and last start.
    ``labels`` adds those of ``notices`` and of identifier tags, whose and/or/with
    expressions are parsed (unknown operands and exceptions have no label and are not usable; nor is an expression that
    is tied to words beyond it); ``expressions`` has them in brackets (several joined by
    semicolons), ``usable`` tells whether ``allowed`` satisfies all expressions (without
    any: covers all labels), and NULL where nothing was found. ``score`` grows with the number and
    kind of the finds and is 0 without any.

    NULL and empty text have no words and no finds. Repeated rows are scanned
    each; other columns are ignored; an empty table gives no rows.
    """
    need(docs, [id_col, text_col])
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_base", T.LongType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
            T.StructField("base_labels", T.StringType()),
            T.StructField("labels", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("expressions", T.StringType()),
            T.StructField("usable", T.BooleanType()),
        ]
    )
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.string(), pa.bool_()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, allowed)
        for batch in batches:
            rows = [scanner.scan(text) for text in batch.column(1).to_pylist()]
            found = [pa.array([r[n] for r in rows], type=kind) for n, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], names=schema.names)

    return docs.select(F.col(id_col), known_text(text_col).alias("__text")).mapInArrow(scan, schema)
