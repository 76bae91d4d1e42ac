"""Licence scan: an Aho-Corasick automaton finds notice phrases and
identifier tags; a shunting-yard parser evaluates the licence expression
behind a tag.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased. The words are joined by single blanks and every phrase is
searched with a blank at both ends, so one pass over the text finds all places
of all phrases at word borders, overlapping ones included.

An expression is what follows a tag and a colon on the tag's line; the tags'
places come from the automaton, however their words are joined. It is made of
licence identifiers joined by ``or`` < ``and`` < ``with`` and brackets; ``with``
stands between two plain identifiers, a licence and its exception. It is turned
into postfix form and evaluated on restriction levels: ``or`` takes the freer
side (the left one of equals), ``and`` both and the stricter level, ``with``
lowers a copyleft level by one. What is left is the reduced expression: the
licences that bind whoever chooses the freest way, joined by ``AND``. Words
behind a complete expression are no part of it.

Defined cases: null and empty texts have no words, no places, no labels and
score 0; a tag without a well-formed expression gives the label
``spdx-invalid``; the result columns ``n_words``, ``places``, ``expressions``
and ``score`` replace columns of the same name.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from wordmill.llm.common import long_rows, quoted, unused_name, utf8

# The phrases every scan has, with their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Further notice phrases.
MORE_PHRASES = {
    "affero general public license": "agpl",
    "lesser general public license": "lgpl",
    "apache license": "apache",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons": "creative-commons",
    "public domain": "public-domain",
    "free documentation license": "gfdl",
    "no part of this publication may be reproduced": "no-reproduction",
}
TAG_PHRASES = {"spdx license identifier": "spdx", "license expression": "license-expression"}
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
BEHIND_TAG = re.compile(rb"[ \t]*:([^\r\n]*)")

# How sure one place of a label makes a notice.
CERTAINTY = {"gpl": 0.6, "cc-by": 0.6, "reserved": 0.5, "public-domain": 0.3, "creative-commons": 0.5}
OTHER_CERTAINTY = 0.6
EXPRESSION_CERTAINTY = 0.9

# Restriction level of an identifier by its start; the longest start counts.
LEVELS = {"cc0": 0, "unlicense": 0, "0bsd": 0, "mit": 1, "bsd": 1, "apache": 1, "isc": 1, "zlib": 1, "cc-by": 1}
LEVELS |= {"lgpl": 2, "mpl": 2, "epl": 2, "cddl": 2, "cc-by-sa": 2, "gpl": 3, "agpl": 4}
UNKNOWN_LEVEL = 5

# Every byte that is not part of a word becomes a blank; A-Z become a-z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def level(identifier: str) -> int:
    """Restriction level of one licence identifier."""
    starts = [s for s in LEVELS if identifier == s or identifier.startswith((s + "-", s + "+"))]
    return LEVELS[max(starts, key=len)] if starts else UNKNOWN_LEVEL


def postfix(expression: str) -> list[str] | None:
    """The expression in postfix order (shunting-yard), or None if it is not
    well formed. Reading stops behind a complete expression and at the first
    character of no token, such as a closing comment mark."""
    out: list[str] = []
    stack: list[str] = []
    before = ""  # the token before
    at = 0
    while (m := TOKEN.match(expression, at)) is not None:
        at, token = m.end(), m[1].lower()
        operand_next = before in ("", "(") or before in PRECEDENCE
        if token == "(":
            if before == "with":
                return None
            if not operand_next:
                break
            stack.append(token)
        elif token == ")":
            if operand_next or "(" not in stack:
                return None
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif token in PRECEDENCE:
            # An exception belongs to a plain licence identifier.
            if operand_next or token == "with" and (before == ")" or stack[-1:] == ["with"]):
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
        else:
            if not operand_next:
                break
            out.append(token)
        before = token
    if before in ("", "(") or before in PRECEDENCE or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(tokens: list[str]) -> tuple[int, list[str], list[str]]:
    """Restriction level, all licence identifiers, and the licences of the
    reduced expression, of a postfix expression."""
    stack: list[tuple[int, list[str]]] = []
    names: list[str] = []
    for i, token in enumerate(tokens):
        if token not in PRECEDENCE:
            stack.append((level(token), [token]))
            if tokens[i + 1 : i + 2] != ["with"]:
                names.append(token)
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            lower = left[0] - 1 if 2 <= left[0] <= 4 else left[0]
            stack.append((lower, [f"{left[1][0]} WITH {right[1][0]}"]))
        elif token == "or":
            stack.append(left if left[0] <= right[0] else right)
        else:
            stack.append((max(left[0], right[0]), left[1] + [x for x in right[1] if x not in left[1]]))
    rank, chosen = stack[0]
    return rank, names, sorted(chosen)


class Scanner:
    def __init__(self, phrases: dict[str, tuple[str, bool]]):
        self.automaton = ahocorasick.Automaton()
        for phrase, (label, base) in phrases.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, label, base))
        self.automaton.make_automaton()

    def places(self, body: bytes) -> tuple[int, list[tuple[int, str, bool]]]:
        """Number of words; start word, label and base mark of every place,
        in order."""
        words = body.translate(WORD_BYTES).split()
        joined = f" {b' '.join(words).decode('utf-8', 'replace')} "
        found = sorted((end - size + 1, label, base) for end, (size, label, base) in self.automaton.iter(joined))
        out, word, at = [], 0, 0
        for start, label, base in found:
            word += joined.count(" ", at, start)
            at = start
            out.append((word, label, base))
        return len(words), out


def expressions(body: bytes, places: list[tuple[int, str, bool]]) -> list[dict]:
    """The expressions behind the tags among the places of a text."""
    lengths = {label: len(phrase.split()) for phrase, label in TAG_PHRASES.items()}
    starts = [(word, lengths[label]) for word, label, _ in places if label in lengths]
    if not starts:
        return []
    wanted = {w for start, n in starts for w in (start, start + n - 1)}
    spans = {i: m.span() for i, m in enumerate(WORD.finditer(body)) if i in wanted}
    out = []
    for start, n in starts:
        begin, end = spans[start][0], spans[start + n - 1][1]
        behind = BEHIND_TAG.match(body, end)
        if behind is None or b"\n" in body[begin:end] or b"\r" in body[begin:end]:
            continue
        text = behind[1].decode("utf-8", "replace").strip()
        tokens = postfix(text)
        rank, names, chosen = evaluate(tokens) if tokens else (UNKNOWN_LEVEL, [], [])
        out.append({"expression": text, "valid": bool(tokens), "level": rank, "licenses": names, "reduced": " AND ".join(chosen)})
    return out


PLACE = StructType([StructField("word", LongType()), StructField("label", StringType()), StructField("base", BooleanType())])
EXPRESSION = StructType(
    [
        StructField("expression", StringType()),
        StructField("valid", BooleanType()),
        StructField("level", IntegerType()),
        StructField("licenses", ArrayType(StringType())),
        StructField("reduced", StringType()),
    ]
)
SCAN = StructType(
    [
        StructField("n_words", LongType()),
        StructField("places", ArrayType(PLACE)),
        StructField("expressions", ArrayType(EXPRESSION)),
        StructField("score", DoubleType()),
    ]
)
ARROW_SCAN = pa.struct(
    [
        ("n_words", pa.int64()),
        ("places", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))),
        (
            "expressions",
            pa.list_(
                pa.struct(
                    [
                        ("expression", pa.string()),
                        ("valid", pa.bool_()),
                        ("level", pa.int32()),
                        ("licenses", pa.list_(pa.string())),
                        ("reduced", pa.string()),
                    ]
                )
            ),
        ),
        ("score", pa.float64()),
    ]
)


def scan_text(scanner: Scanner, body: bytes) -> dict:
    n_words, places = scanner.places(body)
    tagged = expressions(body, places)
    doubt = 1.0
    for label in sorted({label for _, label, _ in places} - set(TAG_PHRASES.values())):
        doubt *= 1 - CERTAINTY.get(label, OTHER_CERTAINTY)
    if any(e["valid"] for e in tagged):
        doubt *= 1 - EXPRESSION_CERTAINTY
    return {
        "n_words": n_words,
        "places": [{"word": w, "label": label, "base": base} for w, label, base in places],
        "expressions": tagged,
        "score": round(1 - doubt, 9),
    }


def scan_licenses(docs: DataFrame, text_col: str = "text", more_phrases: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``places`` (word, label, base), ``expressions``
    (text, valid, level, licenses, reduced) and ``score`` (0: no notice found, towards
    1: surely licensed text)."""
    long_rows(docs)
    phrases = {p: (label, False) for p, label in {**MORE_PHRASES, **TAG_PHRASES, **(more_phrases or {})}.items()}
    phrases |= {p: (label, True) for p, label in BASE_PHRASES.items()}

    @F.arrow_udf(SCAN)
    def scan(batches: pa.Array) -> pa.Array:
        scanner = Scanner(phrases)
        return pa.array([scan_text(scanner, body) for body in batches.to_pylist()], ARROW_SCAN)

    found = unused_name(docs, "license_scan")
    scanned = docs.withColumn(found, scan(utf8(quoted(text_col))))
    return scanned.withColumns({f.name: F.col(found)[f.name] for f in SCAN.fields}).drop(found)


def labels(places: str = "places", exprs: str = "expressions", base_only: bool = False) -> F.Column:
    """Distinct labels of a scan, sorted and joined by commas."""
    of_places = F.filter(places, lambda p: p["base"]) if base_only else F.col(places)
    names = F.transform(of_places, lambda p: p["label"])
    if not base_only:
        flat = F.flatten(F.transform(exprs, lambda e: F.when(e["valid"], e["licenses"]).otherwise(F.array(F.lit("spdx-invalid")))))
        names = F.concat(names, flat)
    return F.array_join(F.array_sort(F.array_distinct(names)), ",")


def strictest(field: str, exprs: str = "expressions") -> F.Column:
    """``level`` or ``reduced`` of the strictest well-formed expression (the
    first of equals by its reduced form); null without one."""
    ranked = F.transform(F.filter(exprs, lambda e: e["valid"]), lambda e: F.struct((-e["level"]).alias("rank"), e["reduced"].alias("reduced"), e["level"].alias("level")))
    return F.array_min(ranked)[field]
