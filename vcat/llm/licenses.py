"""License scans with Aho-Corasick and a shunting-yard parser (operator 10).

A text's words (digits, letters, anything beyond ASCII; A to Z lower-cased) are laid out with single spaces, and one automaton finds base phrases,
notice phrases and identifier tags in all texts of a batch. Behind a tag, the expression up to the line's end is parsed with
precedence WITH, AND, OR into postfix form and evaluated: its licences become labels, its grade is the best of alternatives and the worst
of what holds together; an exception leaves the grade of its licence. What is no identifier of a licence or, behind WITH, of an exception, makes the expression ``invalid``.

``score``: the worst grade of all statements found, from 1 (permissive) to 0; 0 where nothing is said, or no more than that rights are reserved.

Defined results: null text: empty, no words. Expression that can't be parsed: label ``invalid``, grade 0. Repeated rows: each judged. Null ids stay.
Empty table: no rows. Other columns are ignored. Texts are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vcat.llm.textbytes import NOT_WORD, chunks, data

# Phrases and labels of the contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Phrases of licence notices, the licence each of them names.
NOTICES = {
    "apache license version 2 0": "apache-2.0", "gnu affero general public license": "agpl", "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0", "gnu lesser general public license": "lgpl", "mozilla public license": "mpl",
    "cc by 4 0": "cc-by-4.0", "cc by sa 4 0": "cc-by-sa-4.0", "cc by nc 4 0": "cc-by-nc-4.0", "cc by nd 4 0": "cc-by-nd-4.0", "cc0 1 0": "cc0-1.0",
    "permission is hereby granted free of charge": "mit", "redistribution and use in source and binary forms": "bsd", "all rights reserved": "reserved",
}
RESERVED = "reserved"
TAGS = ("spdx license identifier", "license expression")
#: Grade of a licence by the first prefix that fits; others have UNKNOWN.
GRADES = (("mit", 1.0), ("apache", 1.0), ("bsd", 1.0), ("isc", 1.0), ("cc0", 1.0), ("unlicense", 1.0), ("cc-by-nc", 0.2), ("cc-by-nd", 0.2), ("cc-by-sa", 0.6),
          ("cc-by", 0.9), ("lgpl", 0.6), ("mpl", 0.7), ("epl", 0.7), ("agpl", 0.3), ("gpl", 0.4), ("reserved", 0.0))
UNKNOWN = 0.1
# Identifiers of licences and of exceptions, by families with their versions; a licence's name may be marked as "only", "or later" or with a plus.
KNOWN = re.compile(
    r"(mit(-0)?|apache-(1\.0|1\.1|2\.0)|0bsd|bsd-[1234]-clause(-patent|-clear|-attribution)?|isc|unlicense|zlib|ncsa|x11|wtfpl|postgresql|python-2\.0(\.1)?|psf-2\.0|openssl|ruby|vim|curl"
    r"|artistic-(1\.0|2\.0)|bsl-1\.0|upl-1\.0|blueoak-1\.0\.0|afl-[123]\.[01]|ms-(pl|rl)|osl-[123]\.0|ecl-2\.0|ofl-1\.[01]|odbl-1\.0|odc-by-1\.0|pddl-1\.0"
    r"|(gpl|agpl)-[123]\.0|lgpl-(2\.0|2\.1|3\.0)|gfdl-1\.[123]|mpl-(1\.0|1\.1|2\.0)|epl-[12]\.0|eupl-1\.[012]|cddl-1\.[01]|cecill-(1\.[01]|2\.[01]|b|c)|sspl-1\.0|busl-1\.1"
    r"|cc0-1\.0|cc-by(-nc)?(-sa|-nd)?-[1234]\.[05]|licenseref-[a-z0-9.-]+|none|noassertion)(-only|-or-later|\+)?")
EXCEPTIONS = re.compile(r"[a-z0-9.+-]+-exception(-[0-9.]+)?|linux-syscall-note|llgpl|(gpl|lgpl)-cc-1\.0|swift-exception|llvm-exception|exceptionref-[a-z0-9.-]+")
_BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")


def grade(licence: str) -> float:
    return next((g for p, g in GRADES if licence.startswith(p)), UNKNOWN)


def to_postfix(text: str) -> list[str]:
    """Shunting yard. Stops where the text is no more an expression; ValueError if what was read isn't a whole one."""
    out, stack, want, at = [], [], True, 0
    while m := _TOKEN.match(text, at):
        token = m[1].lower().rstrip(".:") if m[1] not in "()" else m[1]
        if want and token == "(":
            stack.append(token)
        elif want and token not in _BINDS and token != ")":
            out.append(token)
            want = False
        elif not want and token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break  # a bracket around the tag itself
            stack.pop()
        elif not want and token in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            want = True
        elif want:
            raise ValueError(token)
        else:
            break  # other words after a whole expression
        at = m.end()
    if want or "(" in stack:
        raise ValueError("incomplete")
    return out + stack[::-1]


def evaluate(text: str) -> tuple[set[str], float]:
    """Licences of an expression and its grade; ValueError if it is none, or names what is no licence or exception."""
    stack: list[tuple[set[str], float]] = []
    for token in to_postfix(text):
        if token not in _BINDS:
            stack.append(({token}, grade(token)))
            continue
        (right, y), (left, x) = stack.pop(), stack.pop()
        if token == "with":
            if len(left) > 1 or not EXCEPTIONS.fullmatch(*right):
                raise ValueError(*right)
            stack.append((left, x))
        else:
            stack.append((left | right, max(x, y) if token == "or" else min(x, y)))
    labels, value = stack.pop()
    for token in labels:
        if not KNOWN.fullmatch(token):
            raise ValueError(token)
    return labels, value


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            key = f" {phrase} "
            a.add_word(key, [*a.get(key, []), (kind, label, phrase.count(" ") + 1)])
    a.make_automaton()
    return a


_SPACED = np.where(NOT_WORD, 32, np.arange(256)).astype(np.uint8)
_SPACED[65:91] = np.arange(97, 123)
_GAP_OR_BREAK = 10


def _scan_chunk(automaton, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, dict[int, list]]:
    """(words of each text, {row: [(kind, label, first word, byte behind the phrase)]})."""
    n = len(ends) - 1
    word = ~NOT_WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[ends] = True
    starts = np.flatnonzero(word & (~np.concatenate(([False], word[:-1])) | edge[:-1]))
    closes = np.flatnonzero(word & (~np.concatenate((word[1:], [False])) | edge[1:])) + 1
    first = np.searchsorted(starts, ends)
    counts = np.diff(first)
    # a space before and after each word, a line break between texts; the byte of a word's space tells its number
    size = np.bincount(np.searchsorted(starts, np.flatnonzero(word), "right") - 1, minlength=len(starts)) if len(starts) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n), counts)
    opens = np.concatenate(([True], owner[1:] != owner[:-1])) if len(starts) else np.zeros(0, bool)
    at = np.cumsum(size + 1 + 2 * opens) - size  # places where words begin: a text opens with a break and a space
    spaced = np.full(int(at[-1] + size[-1] + 1) if len(starts) else 0, 32, np.uint8)
    shift = np.repeat(at - starts, size)
    inside = np.flatnonzero(word)
    spaced[inside + shift] = _SPACED[raw[inside]]
    spaced[at[opens] - 2] = _GAP_OR_BREAK
    found: dict[int, list] = {}
    for end, hits in automaton.iter(spaced.tobytes().decode("latin-1")):
        last = int(np.searchsorted(at, end, "right")) - 1  # the word before the closing space
        for kind, label, width in hits:
            w = last - width + 1
            row = int(owner[w])
            found.setdefault(row, []).append((kind, label, w - int(first[row]), int(closes[last])))
    return counts, found


_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
           "places array<struct<label: string, word: long>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton()
    kinds = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    for batch in batches:
        texts = batch.column(1).fill_null("")
        for i, j in chunks(texts):
            raw, ends = data(texts.slice(i, j - i))
            counts, found = _scan_chunk(automaton, raw, ends)
            rows = []
            for r in range(j - i):
                base, words, own, grades, places = set(), [], set(), [], []
                for kind, label, w, behind in found.get(r, ()):
                    if kind == "base":
                        base.add(label)
                        words.append(w)
                        grades.append(grade(label))
                        places.append({"label": label, "word": w})
                    elif kind == "notice":
                        own.add(label)
                        if label != RESERVED:
                            grades.append(grade(label))
                        places.append({"label": label, "word": w})
                    else:
                        rest = raw[behind:ends[r + 1]]
                        stop = np.flatnonzero(rest == 10)
                        line = rest[:stop[0] if len(stop) else len(rest)].tobytes().decode(errors="replace")
                        try:
                            labels, g = evaluate(line.lstrip(": \t\"'"))
                        except ValueError:
                            labels, g = {"invalid"}, 0.0
                        own |= labels
                        grades.append(g)
                        places += [{"label": x, "word": w} for x in sorted(labels)]
                rows.append((len(words), min(words, default=None), max(words, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), min(grades, default=0.0), places))  # rights reserved are the default: they say nothing beside a licence
            cols = list(zip(*rows))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(counts, pa.int64()), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row per document: counts and places of base phrases, labels, ``score`` and all ``places`` found."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan, _SCHEMA)
