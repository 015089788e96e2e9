"""License scans: an Aho-Corasick automaton over normalized words, and an expression parser.

A text is brought to its words with one blank between and around them, so a phrase of words
is a plain substring that begins and ends at blanks, and one automaton finds all notice
phrases and the words that open an identifier tag. The words' places tell where in the
original text a tag's expression begins; a shunting-yard parser reads it as far as it goes and
evaluates AND, OR, WITH and brackets: the terms are permissive if a choice of the OR branches
holds permissive licences only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.common import FOLD_ALNUM, read_table, tidy
from strandlake.session import shipped

# The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Further notice phrases, in words, with labels of their own.
NOTICES = {
    "permission is hereby granted free of charge": "notice-mit",
    "licensed under the apache license": "notice-apache",
    "redistribution and use in source and binary forms": "notice-bsd",
    "gnu general public license": "notice-gpl",
    "gnu lesser general public license": "notice-lgpl",
    "gnu affero general public license": "notice-agpl",
    "mozilla public license": "notice-mpl",
    "creative commons attribution": "notice-cc",
    "all rights reserved": "notice-reserved",
    "this is free and unencumbered software": "notice-unlicense",
}
TAG_WORDS = "spdx license identifier"
# Licences taken as permissive when an expression is evaluated.
PERMISSIVE = frozenset(("mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "unlicense", "cc0-1.0", "0bsd"))
# Licence names without a digit or hyphen; any other plain word isn't a licence's name.
PLAIN_NAMES = frozenset((
    "beerware", "curl", "fair", "intel", "isc", "json", "libpng", "mit", "naumen", "ncsa", "none", "openssl", "postgresql",
    "ruby", "sleepycat", "unlicense", "vim", "wtfpl", "x11", "xnet", "zed", "zlib",
))
TOKEN = re.compile(rb"[ \t]*(\(|\)|[A-Za-z0-9](?:[A-Za-z0-9.+:-]*[A-Za-z0-9+])?)")
_COLON = re.compile(rb"[ \t]*:")
_RANK = {"or": 1, "and": 2, "with": 3}


class ExpressionError(ValueError):
    """The text isn't a licence expression."""


def _licence(token: str) -> bool:
    return token in PLAIN_NAMES or "-" in token or any(c.isdigit() for c in token)


def _tokens(raw: bytes, at: int) -> Iterator[str]:
    """Names, operators and brackets in lower case, with nothing but blanks between them."""
    while m := TOKEN.match(raw, at):
        yield m[1].decode().lower()
        at = m.end()


def to_postfix(raw: bytes | str, at: int = 0) -> list[str]:
    """Shunting-yard: WITH binds closest, then AND, then OR.

    Reads from ``at`` as far as the expression goes: prose behind it, a sentence's full stop or
    comma, or the end of the line end it, and an operator that no licence follows isn't part of it.
    """
    out, held, operand = [], [], False
    depth = 0
    raw = raw.encode() if isinstance(raw, str) else raw
    for token in _tokens(raw, at):
        if token in _RANK:
            if not operand:
                break
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[token]:
                out.append(held.pop())
            held.append(token)
            operand = False
        elif token == "(":
            if operand:
                break
            held.append(token)
            depth += 1
        elif token == ")":
            if not depth or not operand:
                break
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            depth -= 1
        elif operand or not _licence(token):
            break
        else:
            out.append(token)
            operand = True
    if not operand and out and held and held[-1] in _RANK:
        held.pop()  # an operator before prose
        operand = True
    if not operand or depth:
        raise ExpressionError(raw[at : at + 80])
    while held:
        out.append(held.pop())
    return out


def evaluate(postfix: list[str], permissive: frozenset[str] = PERMISSIVE) -> tuple[bool, list[str]]:
    """(whether some choice of the OR branches is permissive, the licences and exceptions named)."""
    stack: list[tuple[bool, str]] = []
    names: list[str] = []
    for token in postfix:
        if token not in _RANK:
            stack.append((token.rstrip("+") in permissive, token))
            names.append(token)
            continue
        b, a = stack.pop(), stack.pop()
        if token == "with":  # an exception only adds permissions
            stack.append((a[0], f"{a[1]} with {b[1]}"))
        else:
            stack.append(((a[0] and b[0]) if token == "and" else (a[0] or b[0]), ""))
    return stack[0][0], names


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", {TAG_WORDS: TAG_WORDS})):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
    found.make_automaton()
    return found


def scan_text(text: str | None, automaton: ahocorasick.Automaton) -> dict:
    """Base places, labels, tags' expressions and a score for one text."""
    raw = (text or "").encode("utf-8", "replace").translate(FOLD_ALNUM)
    words = raw.split()
    out = {"n_words": len(words), "places": [], "base_labels": set(), "labels": set(), "expressions": [], "score": 0.0}
    if not (b"licen" in raw or b"reserved" in raw or b" nc" in raw or b"creative" in raw or b"unencumbered" in raw or b"redistribution" in raw or b"granted" in raw):
        return out  # no phrase can stand here; single words only, as blanks aren't collapsed yet
    joined = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace")
    at = words_before = 0
    notices, tags = 0, []
    for end, (kind, label, size) in automaton.iter(joined):
        if kind == "notice":
            notices += 1
            out["labels"].add(label)
            continue
        start = end - size + 1
        if start >= at:
            words_before += joined.count(" ", at, start)
        else:
            words_before -= joined.count(" ", start, at)
        at = start
        if kind == "tag":
            tags.append(words_before + size_in_words(label) - 1)
        else:
            out["places"].append(words_before)
            out["base_labels"].add(label)
            out["labels"].add(label)
    if tags:
        original = text.encode("utf-8", "replace")
        last_words = iter(tags)  # the places of the tags' last words, ascending
        wanted = next(last_words)
        for i, word in enumerate(_WORD.finditer(raw)):
            if i != wanted:
                continue
            found = _read_expression(original, word.end())
            if found:
                out["expressions"].append(found)
                out["labels"].update(f"spdx:{n}" for n in found["names"])
                out["labels"].add("terms:permissive" if found["permissive"] else "terms:other")
            wanted = next(last_words, None)
            if wanted is None:
                break
    weight = 2.0 * len(out["base_labels"]) + notices + 3.0 * len(out["expressions"])
    out["score"] = weight / (weight + 1.0)
    return out


_WORD = re.compile(rb"[^ ]+")


def size_in_words(phrase: str) -> int:
    return len(phrase.split(" "))


def _read_expression(raw: bytes, at: int) -> dict | None:
    """The expression behind a tag that ends at ``at``: in postfix form, evaluated, with the names in it; None if there is none."""
    colon = _COLON.match(raw, at)
    if not colon:
        return None
    try:
        postfix = to_postfix(raw, colon.end())
    except ExpressionError:
        return None
    permissive, names = evaluate(postfix)
    return {"expression": " ".join(postfix), "permissive": permissive, "names": names}


SCAN = (
    "doc_id long, n_words long, places array<long>, base_labels array<string>, labels array<string>, "
    "expressions array<struct<expression:string,permissive:boolean>>, score double"
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): words, base places, labels, evaluated tag expressions, score.

    ``expressions`` holds each tag's expression in postfix form and whether its terms are
    permissive; labels are those of the phrases, ``spdx:`` with a licence's name for each name in
    an expression, and ``terms:permissive`` or ``terms:other`` as it evaluates. A null text is
    empty: no words, no labels, score 0. A tag without an expression adds no label. Other columns
    are ignored whatever their names; every input row gives one row, repeated ones and those
    with equal or null ids too; an empty table gives none. A text is held by one worker as a
    whole, several times over.
    """
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        expression = pa.struct([("expression", pa.string()), ("permissive", pa.bool_())])
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(pa.int64())), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("expressions", pa.list_(expression)), ("score", pa.float64())])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = scan_text(text.as_py(), automaton)
                expressions = [{k: e[k] for k in ("expression", "permissive")} for e in found["expressions"]]
                rows.append(found | {"doc_id": doc_id, "expressions": expressions, "base_labels": sorted(found["base_labels"]), "labels": sorted(found["labels"])})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return shipped(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCAN)


def report(docs: DataFrame) -> DataFrame:
    """The digest of ``scan_licenses``: counts, first and last base place, labels as text, score, and evaluated expressions as text."""
    value = lambda e: F.concat(e["expression"], F.when(e["permissive"], F.lit("=permissive")).otherwise(F.lit("=other")))
    return scan_licenses(docs).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
        F.array_join(F.transform("expressions", value), ",").alias("expressions"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read_table(spark, sf_dir, "documents"))
