"""License scans: Aho-Corasick over word streams, a shunting-yard parser for expressions.

One automaton holds every phrase. It runs once over each document's *word stream* (lower-cased
words joined by one space), so a phrase matches whatever separates its words. A hit of an
identifier tag (``SPDX-License-Identifier``) or of a trigger (``licensed under``) is followed,
in the raw text, by a licence expression, which a shunting-yard parser turns into postfix form
and evaluates.

Null and empty texts have no words: counts 0, positions null, labels '' and score 0. Repeated
rows each get their own result; an empty table gives an empty result. Ties in the score keep the strongest
evidence. Very long texts are read whole, in time in proportion to their length (an expression is read up to the
first word that cannot belong to it). Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sylvan.llm.common import map_text, pick

# ---- fixed values -----------------------------------------------------------------------
# The base phrases and labels of the contract.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notice phrases of the method (words as in the word stream) and their labels.
NOTICES = {
    "affero general public license": "agpl",
    "apache license": "apache",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "creative commons": "creative-commons",
    "eclipse public license": "epl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "proprietary and confidential": "proprietary",
    "public domain": "public-domain",
    "redistribution and use in source and binary forms": "bsd",
    "the unlicense": "unlicense",
}
TAGS = ("spdx license identifier",)
TRIGGERS = ("licensed under", "released under", "distributed under", "available under")
# Known identifiers (lower case) and how free their terms are: 1 permissive, 0.6 weak copyleft,
# 0.4 strong copyleft, 0.2 non-commercial or no derivatives.
KNOWN = {
    "0bsd": 1.0,
    "agpl-3.0": 0.4,
    "agpl-3.0-only": 0.4,
    "agpl-3.0-or-later": 0.4,
    "apache-2.0": 1.0,
    "bsd-2-clause": 1.0,
    "bsd-3-clause": 1.0,
    "bsl-1.0": 1.0,
    "cc-by-4.0": 1.0,
    "cc-by-nc-4.0": 0.2,
    "cc-by-nd-4.0": 0.2,
    "cc-by-sa-4.0": 0.6,
    "cc0-1.0": 1.0,
    "epl-2.0": 0.6,
    "gpl-2.0": 0.4,
    "gpl-2.0-only": 0.4,
    "gpl-2.0-or-later": 0.4,
    "gpl-3.0": 0.4,
    "gpl-3.0-only": 0.4,
    "gpl-3.0-or-later": 0.4,
    "isc": 1.0,
    "lgpl-2.1": 0.6,
    "lgpl-3.0": 0.6,
    "mit": 1.0,
    "mpl-2.0": 0.6,
    "unlicense": 1.0,
    "zlib": 1.0,
}
# More identifiers by family, each version with and without -only and -or-later.
_FAMILIES = {
    1.0: ["afl-3.0", "apache-1.0", "apache-1.1", "artistic-2.0", "bsd-4-clause", "bsd-3-clause-clear", "cc-by-1.0", "cc-by-2.0", "cc-by-2.5",
          "cc-by-3.0", "curl", "ecl-2.0", "mit-0", "ms-pl", "ncsa", "ofl-1.1", "openssl", "postgresql", "psf-2.0", "python-2.0", "upl-1.0",
          "wtfpl", "x11", "zpl-2.1"],
    0.6: ["cc-by-sa-1.0", "cc-by-sa-2.0", "cc-by-sa-2.5", "cc-by-sa-3.0", "cddl-1.0", "cddl-1.1", "cpl-1.0", "epl-1.0", "eupl-1.1", "eupl-1.2",
          "ipl-1.0", "mpl-1.0", "mpl-1.1", "ms-rl",
          *(f"lgpl-{v}{end}" for v in ("2.0", "2.1", "3.0") for end in ("", "-only", "-or-later"))],
    0.4: ["cecill-2.1", "osl-3.0", *(f"{kind}{end}" for kind in ("agpl-1.0", "gpl-1.0") for end in ("", "-only", "-or-later"))],
    0.2: [f"cc-by-{kind}-{v}" for kind in ("nc", "nd", "nc-sa", "nc-nd") for v in ("1.0", "2.0", "2.5", "3.0", "4.0")],
}
KNOWN |= {name: value for value, names in _FAMILIES.items() for name in names}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
# ------------------------------------------------------------------------------------------

#: Terms of an identifier that is not in KNOWN.
UNKNOWN_TERMS = 0.3
#: Strength of the evidence: a tag with a valid expression, an expression after a trigger, a
#: notice phrase of the method, a base phrase.
TAG_SCORE, TRIGGER_SCORE, NOTICE_SCORE, BASE_SCORE = 1.0, 0.9, 0.8, 0.6

_FOLD = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b) if (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80) else 0x20
    for b in range(256)
)
_RAW_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: White space with line ends and the comment leaders after them.
_WRAP = rb"[ \t\f\v]*+(?:(?:\r\n?|\n)[ \t]*+(?:\*++(?!/)|//[/!]?+|#++|;++|--|%++|>++)?+[ \t\f\v]*+)*+"
_OPERAND = rb"([()]|[A-Za-z0-9][A-Za-z0-9.:+-]*)"
_TOKEN, _WRAPPED = re.compile(rb"[ \t]*" + _OPERAND), re.compile(_WRAP + _OPERAND)
_LEAD = re.compile(_WRAP + rb"[:=]?" + _WRAP + rb"""["']*""" + _WRAP + rb"(?:(?:the|an?)(?=\s)" + _WRAP + rb")?", re.I)
#: The form of a public identifier: a name, a version, perhaps what goes with it.
_FORM = re.compile(r"[A-Z][A-Za-z]*(?:-[A-Za-z]+)*-\d+\.\d+(?:\.\d+)*(?:-[A-Za-z]+)*\+?|LicenseRef-[A-Za-z0-9.-]+")


def parse(tokens: Iterable[str]) -> tuple[list[str], int]:
    """Postfix form of the longest valid expression that ``tokens`` begins with, and its length.

    Shunting-yard: operands go to the output; an operator first moves those of higher or equal
    rank there; parentheses bound a part. A prefix counts as valid where an operand or a
    closing parenthesis ends it with nothing left open. Tokens are taken one by one, up to the first that
    no expression can go on with; a valid prefix is remembered by its lengths (outside parentheses no more
    than one operator of each rank waits), so the time grows with the tokens taken.
    """
    best: tuple[int, list[str], int] = (0, [], 0)
    out: list[str] = []
    ops: list[str] = []
    operand_next, depth = True, 0
    for i, tok in enumerate(tokens):
        low = tok.lower()
        if operand_next:
            if tok == "(":
                ops.append(tok)
                depth += 1
                continue
            if tok == ")" or low in PRECEDENCE:
                break
            out.append(tok)
            operand_next = False
        elif low in PRECEDENCE:
            while ops and ops[-1] != "(" and PRECEDENCE[ops[-1]] >= PRECEDENCE[low]:
                out.append(ops.pop())
            ops.append(low)
            operand_next = True
        elif tok == ")" and depth:
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
            depth -= 1
        else:
            break
        if not operand_next and not depth:
            best = (len(out), ops[::-1], i + 1)
    return out[: best[0]] + best[1], best[2]


def evaluate(postfix: list[str]) -> float:
    """How free the terms are: ``or`` lets the reader choose (max), ``and`` binds both (min),
    ``with`` adds an exception, which loosens the terms halfway to 1."""
    stack: list[float] = []
    for tok in postfix:
        if tok in PRECEDENCE:
            b, a = stack.pop(), stack.pop()
            stack.append(max(a, b) if tok == "or" else min(a, b) if tok == "and" else (a + 1) / 2)
        else:
            stack.append(KNOWN.get(tok.lower().rstrip("+"), UNKNOWN_TERMS))
    return stack[0]


def expression_at(raw: bytes, pos: int, known_only: bool) -> tuple[str, list[str], float] | None:
    """The licence expression at ``pos``: its text, its identifiers, its value."""
    start, pos = pos, _LEAD.match(raw, pos).end()
    # prose on the line after an empty tag is no identifier
    known_only = known_only or b"\n" in raw[start:pos] or b"\r" in raw[start:pos]
    tokens: list[str] = []

    def read() -> Iterator[str]:
        """The tokens, as far as they are asked for; a full stop that ends a sentence ends them."""
        at, depth = pos, 0
        while m := (_WRAPPED if depth > 0 or not tokens or tokens[-1].lower() in PRECEDENCE else _TOKEN).match(raw, at):
            tok = m[1].decode("ascii")
            tokens.append(tok.rstrip(".:-"))
            depth += (tok == "(") - (tok == ")")
            at = m.end()
            yield tokens[-1]
            if tokens[-1] != tok:
                return

    postfix, n = parse(read())
    ids = [t for t in postfix if t not in PRECEDENCE]
    if not ids or known_only and ids[0].lower().rstrip("+") not in KNOWN and not _FORM.fullmatch(ids[0]):
        return None
    return " ".join(tokens[:n]), ids, evaluate(postfix)


def _automaton():
    import ahocorasick

    auto = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, *TAGS, *TRIGGERS}:
        auto.add_word(f" {phrase} ", phrase)
    auto.make_automaton()
    return auto


def scan(raw: bytes, auto) -> dict:
    """All findings of one text (see ``license_scan`` for the fields)."""
    words = raw.translate(_FOLD).split()
    stream = f" {b' '.join(words).decode('utf-8', 'replace')} " if words else ""
    base, first, last, base_labels, labels, expressions, score, terms = 0, None, None, set(), set(), [], 0.0, None
    spots: list[tuple[int, str]] = []
    at = seen = 0
    for end, phrase in auto.iter(stream):
        begin = end - len(phrase) - 1  # of the blank before the phrase
        if begin >= at:
            seen += stream.count(" ", at, begin)
            at = begin
            word = seen
        else:
            word = seen - stream.count(" ", begin, at)
        if phrase in BASE:
            base += 1
            first = word if first is None else min(first, word)
            last = word if last is None else max(last, word)
            base_labels.add(BASE[phrase])
            score = max(score, BASE_SCORE)
        elif phrase in NOTICES:
            labels.add(NOTICES[phrase])
            score = max(score, NOTICE_SCORE)
        else:
            spots.append((word + phrase.count(" "), phrase))
    if spots:
        ends = [m.end() for m in _RAW_WORD.finditer(raw)]
        for word, phrase in spots:
            tag = phrase in TAGS
            found = expression_at(raw, ends[word], known_only=not tag)
            if found:
                text, ids, value = found
                expressions.append(text)
                labels.update(x.lower() for x in ids)
                score = max(score, TAG_SCORE if tag else TRIGGER_SCORE)
                terms = value if terms is None else min(terms, value)
    return {
        "n_words": len(words),
        "n_base": base,
        "first_word": first,
        "last_word": last,
        "base_labels": sorted(base_labels),
        "labels": sorted(base_labels | labels),
        "expressions": expressions,
        "terms": terms,
        "score": score,
    }


FIELDS = [
    ("n_words", T.LongType()),
    ("n_base", T.LongType()),
    ("first_word", T.LongType()),
    ("last_word", T.LongType()),
    ("base_labels", T.ArrayType(T.StringType())),
    ("labels", T.ArrayType(T.StringType())),
    ("expressions", T.ArrayType(T.StringType())),
    ("terms", T.DoubleType()),
    ("score", T.DoubleType()),
]


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: word and base-phrase counts, the smallest and largest start of a
    base phrase, labels (arrays), the licence expressions found, ``terms`` (the least free value
    among them; null without one) and the evidence ``score``. A map-only pass; the automaton is
    built once per task."""

    made = []

    def per_slice(texts: list[bytes]) -> dict[str, list]:
        if not made:
            made.append(_automaton())
        rows = [scan(t, made[0]) for t in texts]
        return {n: [r[n] for r in rows] for n, _ in FIELDS}

    return map_text(pick(df, doc_id=id_col, text=text_col), per_slice, FIELDS)
