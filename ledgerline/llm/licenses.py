"""License scans: identifier tags and notice phrases by Aho-Corasick, expressions by a shunting yard."""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import as_bytes, batch_of, pieces, type_of

# Fixed values of the task: phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Further notice phrases of this scan.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by": "cc-by",
    "creative commons": "cc",
    "boost software license": "bsl",
    "isc license": "isc",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
_TAG_LINE = re.compile(rb"spdx-license-identifier\s*:[ \t]*([^\r\n]*)")
#: Families whose texts may be trained on; the policy is a parameter of ``scan``.
ALLOWED = frozenset({"mit", "apache", "bsd", "isc", "bsl", "cc-by", "public-domain", "cc0", "unlicense", "zlib"})
#: Exceptions that make a copyleft licence usable.
EXCEPTIONS = frozenset({"classpath-exception-2.0", "gcc-exception-3.1", "llvm-exception"})
_FAMILIES = ("cc-by-nc", "cc-by-sa", "cc-by", "cc0", "apache", "lgpl", "agpl", "gpl", "bsd", "mpl", "epl", "bsl", "mit", "isc")
_RANK = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[a-z0-9.+:_-]+")

_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_WORDS = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def family(identifier: str) -> str:
    """The label of an identifier: its family if known, else itself."""
    for name in _FAMILIES:
        if identifier == name or identifier.startswith(name + "-"):
            return name
    return identifier


def postfix(expression: str) -> list[str] | None:
    """Tokens in postfix order (with before and before or), or None if the expression is not well formed."""
    text = expression.lower()
    tokens = _TOKEN.findall(text)
    if not tokens or _TOKEN.sub("", text).strip():
        return None
    out: list[str] = []
    held: list[str] = []
    operand = True
    for token in tokens:
        if token == "(" or (token not in _RANK and token != ")"):
            if not operand:
                return None
            if token == "(":
                held.append(token)
            else:
                out.append(token)
                operand = False
            continue
        if operand:
            return None
        if token == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
            continue
        while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[token]:
            out.append(held.pop())
        held.append(token)
        operand = True
    if operand or "(" in held:
        return None
    return out + held[::-1]


def evaluate(expression: str, allowed: Iterable[str] = ALLOWED) -> tuple[bool, set[str]] | None:
    """Whether some reading of the expression is allowed, and its labels; None if malformed.

    ``or`` leaves the choice to the reader, ``and`` binds to both sides, and
    ``with`` grants what its left side grants, or more if the exception is a
    known one.
    """
    order = postfix(expression)
    if order is None:
        return None
    stack: list[tuple[bool, set[str], str]] = []
    for token in order:
        if token not in _RANK:
            name = family(token)
            stack.append((name in allowed, {name}, token))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            if not right[2] or not left[2]:
                return None
            stack.append((left[0] or right[2] in EXCEPTIONS, left[1], ""))
        elif token == "and":
            stack.append((left[0] and right[0], left[1] | right[1], ""))
        else:
            stack.append((left[0] or right[0], left[1] | right[1], ""))
    return stack[0][0], stack[0][1]


def automaton(phrases: dict[str, tuple]):
    """Aho-Corasick over words between blanks, so that a phrase matches whole words only."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for phrase, value in phrases.items():
        out.add_word(f" {phrase} ", value)
    out.make_automaton()
    return out


def scan_text(raw: bytes, machine, allowed: frozenset[str]) -> tuple:
    """All result columns of one text but its id."""
    words = raw.translate(_WORDS).lower().split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    base: set[str] = set()
    labels: set[str] = set()
    n_base, first, last, seen, at, tags = 0, None, None, -1, 0, False
    starts, notices = [], []
    for end, (kind, label, size) in machine.iter(line):
        if kind == "tag":
            tags = True
        elif kind == "base":
            base.add(label)
            starts.append(end - size + 1)
        else:
            notices.append((end - size, end, label))
    # a notice inside a longer one ("cc by" in "cc by nc") says nothing of its own
    labels |= base
    reach = -1
    for _, end, label in sorted(notices, key=lambda n: (n[0], -n[1])):
        if end > reach:
            labels.add(label)
            reach = end
    for start in sorted(starts):
        seen += line.count(" ", at, start)
        at = start
        n_base += 1
        first, last = (seen if first is None else first), seen
    verdicts, malformed = [], 0
    if tags:
        for found in _TAG_LINE.findall(raw.lower()):
            text = re.sub(r"\s*(\*/|-->|#\})\s*$", "", found.decode("utf-8", "replace")).strip()
            result = evaluate(text, allowed)
            if result is None:
                malformed += 1
            else:
                verdicts.append(result[0])
                labels |= result[1]
    score = 1.0 if verdicts else 0.9 if base else 0.6 if labels else 0.3 if malformed else 0.0
    usable = all(verdicts) and not malformed if verdicts or malformed else labels <= allowed
    return (
        len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score,
        len(verdicts), malformed, usable,
    )


def scan(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: Iterable[str] = ALLOWED
) -> DataFrame:
    """Licences named in every whole text.

    ``n_base``, ``first_word`` and ``last_word`` tell where base phrases stand;
    ``labels`` adds further notices and the licences of tagged expressions;
    ``usable`` is the policy's verdict: tagged expressions decide, else the
    notices, and a text that names no licence is usable. A null or empty text
    has no words, no labels and score 0. Rows are independent; none is moved.
    """
    allowed = frozenset(allowed)
    schema = pa.schema(
        [
            ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
            ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
            ("n_expressions", pa.int64()), ("n_malformed", pa.int64()), ("usable", pa.bool_()),
        ]
    )
    phrases = {p: ("notice", label, len(p) + 1) for p, label in NOTICES.items()}
    phrases |= {p: ("base", label, len(p) + 1) for p, label in BASE.items()}
    phrases[TAG] = ("tag", "", len(TAG) + 1)

    def scanned(batches):
        machine = automaton(phrases)
        for batch in pieces(batches):
            rows = [scan_text(raw, machine, allowed) for raw in as_bytes(batch.column("text"))]
            made = batch_of(schema, *(zip(*rows) if rows else [[]] * len(schema)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made.columns], names=["doc_id", *schema.names])

    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        scanned,
        f"doc_id {type_of(df, id_col)}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, n_expressions long, n_malformed long, usable boolean",
    )
