"""License scans: ordered signature rules over the words of a text.

A rule is a regular expression over lower-case words with one blank between, a keyword without which
it cannot match, and a priority.  One pass of an automaton finds which keywords a text has; a rule runs
only if its keyword occurs.  ``signatures`` has the rules written out by hand; ways to name a license, by family and version,
add to them.  Where detections overlap, a rule of higher priority takes its words first,
and a detection whose words lie within those of one already kept is dropped.  The three base phrases are
found at all their places and are never dropped.

Null and empty texts have no words and no labels; extra columns are ignored by the query and handed on by
``scan`` in the struct ``row``; repeated rows are scanned as often as they occur.  The work grows with a text's length
and, for each rule, with its detections, not with their square.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .shared import by_batch, in_row, table
from .signatures import SIGNATURES

# fixed values: the base phrases and their labels
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# fixed values: label, words of the name, versions
FAMILIES = (
    ("agpl", "gnu affero general public license", "3"),
    ("apache", "apache license", "1 1.1 2"),
    ("artistic", "artistic license", "1 2"),
    ("boost", "boost software license", "1"),
    ("bsd-2", "bsd 2 clause", ""),
    ("bsd-3", "bsd 3 clause", ""),
    ("cddl", "common development and distribution license", "1 1.1"),
    ("epl", "eclipse public license", "1 2"),
    ("eupl", "european union public licence", "1.1 1.2"),
    ("fdl", "gnu free documentation license", "1.1 1.2 1.3"),
    ("gpl", "gnu general public license", "1 2 3"),
    ("isc", "isc license", ""),
    ("lgpl", "gnu lesser general public license", "2.1 3"),
    ("lgpl", "gnu library general public license", "2"),
    ("lppl", "latex project public license", "1.3"),
    ("mit", "mit license", ""),
    ("mpl", "mozilla public license", "1 1.1 2"),
    ("ms-pl", "microsoft public license", ""),
    ("odbl", "open data commons open database license", "1"),
    ("ofl", "sil open font license", "1.1"),
    ("osl", "open software license", "3"),
    ("psf", "python software foundation license", "2"),
    ("ruby", "ruby license", ""),
    ("unlicense", "unlicense", ""),
    ("upl", "universal permissive license", "1"),
    ("vim", "vim license", ""),
    ("wtfpl", "do what the fuck you want to public license", "2"),
    ("zlib", "zlib license", ""),
    ("zpl", "zope public license", "2 2.1"),
)

# fixed values: ways to name a license, how sure each is, and its priority
PHRASINGS = (
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}(?: {version})", 0.98, 90),
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}", 0.95, 80),
    (r"{name}(?: {version}) or (?:any )?later", 0.97, 85),
    (r"{name}(?: {version})", 0.9, 60),
    (r"(?:subject to|governed by|see|under) (?:the )?{name}", 0.85, 50),
    (r"{name}", 0.7, 30),
)

# fixed values: label, short identifier, versions, and whether it says a license with just a version beside it
SHORT = (
    ("agpl", "agpl", "1 3", True),
    ("apache", "apache", "1 1.1 2", False),
    ("artistic", "artistic", "1 2", False),
    ("boost", "bsl", "1", True),
    ("bsd", r"(?<!clause )bsd(?! \d clause )", "", False),
    ("bsd-0", "0bsd", "", False),
    ("bsd-2", "bsd 2 clause", "", False),
    ("bsd-2", "2 clause bsd", "", False),
    ("bsd-3", "bsd 3 clause", "", False),
    ("bsd-3", "3 clause bsd", "", False),
    ("cddl", "cddl", "1 1.1", True),
    ("epl", "epl", "1 2", True),
    ("eupl", "eupl", "1 1.1 1.2", True),
    ("fdl", "gfdl", "1.1 1.2 1.3", True),
    ("fdl", "fdl", "1.1 1.2 1.3", True),
    ("gpl", "gpl", "1 2 3", True),
    ("isc", "isc", "", False),
    ("lgpl", "lgpl", "2 2.1 3", True),
    ("lppl", "lppl", "1 1.1 1.2 1.3a 1.3c 1.3", True),
    ("mit", "mit", "", False),
    ("mpl", "mpl", "1 1.1 2", True),
    ("ms-pl", "ms pl", "", False),
    ("odbl", "odbl", "1", True),
    ("ofl", "ofl", "1 1.1", True),
    ("osl", "osl", "1 1.1 2 2.1 3", True),
    ("psf", "psf", "2", True),
    ("psf", "python", "2", False),
    ("ruby", "ruby", "", False),
    ("unlicense", "unlicense", "", False),
    ("upl", "upl", "1", True),
    ("vim", "vim", "", False),
    ("wtfpl", "wtfpl", "1 2", True),
    ("zlib", "zlib", "", False),
    ("zpl", "zpl", "1.1 2 2.1", True),
)

# fixed values: ways to use a short identifier, keyword if not the identifier, how sure each is, and its priority
SHORT_PHRASINGS = (
    (r"spdx license identifier {name}{version}{range}", "spdx license identifier", 0.99, 99),
    (r"spdx license identifier {name}", "spdx license identifier", 0.97, 98),
    (r"spdx license identifier {operand}{name}{version}{range}", "spdx license identifier", 0.97, 97),
    (r"spdx license identifier {operand}{name}", "spdx license identifier", 0.95, 96),
    (r"spdx license identifier {operand}{operand}{name}{version}{range}", "spdx license identifier", 0.97, 95),
    (r"spdx license identifier {operand}{operand}{name}", "spdx license identifier", 0.95, 94),
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}{version}{range}", "", 0.97, 89),
    (r"(?:licensed|released) under (?:the )?(?:terms of (?:the )?)?{name}", "", 0.93, 79),
    (r"{name}{version}{range} licen[cs]ed?", "", 0.93, 70),
    (r"{name}{version} (?:only|or (?:any )?(?:later|newer))", "", 0.95, 69),
    (r"{name} licen[cs]ed?", "", 0.85, 54),
)
BARE = (r"{name}{version}", "", 0.85, 53)
OPERAND = "(?:or later |(?!(?:or|and) )[^ ]+ ){1,4}(?:or|and) "  # of an SPDX expression
RANGE = "(?: only| or (?:any )?(?:later|newer))?"

# fixed values: rules written out: label, expression, keyword, sureness, priority
WRITTEN = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby granted", 0.97, 92),
    ("mit", r"under the mit license", "mit", 0.95, 81),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", "redistribution", 0.96, 92),
    ("bsd-3", r"neither the name of .{1,80}? nor the names of its contributors", "contributors", 0.95, 91),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose", "permission to use", 0.95, 91),
    ("public-domain", r"(?:released|dedicated|placed) (?:in)?to the public domain", "public domain", 0.9, 70),
    ("public-domain", r"(?:is in|under) the public domain", "public domain", 0.8, 40),
    ("cc0", r"(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?", "cc", 0.9, 70),
    ("cc0", r"creative commons zero", "creative commons", 0.9, 70),
    ("proprietary", r"all rights reserved", "all rights reserved", 0.6, 20),
    ("proprietary", r"(?:confidential and proprietary|proprietary and confidential)", "proprietary", 0.8, 60),
    ("no-derivatives", r"no part of this (?:work|book|publication) may be reproduced", "may be reproduced", 0.8, 60),
)
CC_TERMS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
CC_NAMES = {"by": "attribution", "sa": "sharealike", "nd": "noderivatives", "nc": "noncommercial"}

@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    keyword: bytes
    score: float
    priority: int
    base: bool = False


def _rule(label, expression, keyword, score, priority) -> Rule:
    return Rule(label, re.compile(rf"(?<= )(?:{expression})(?= )".encode()), keyword.encode(), score, priority)


def rules() -> list[Rule]:
    """All rules, highest priority first: those written out, and family by version by phrasing, by long and short name."""
    made = [_rule(*w) for w in WRITTEN]
    made += [_rule(label, expression, keyword, score, priority)
             for label, score, priority, pairs in SIGNATURES for keyword, expression in pairs]
    for terms in CC_TERMS:
        label, spelled = "cc-" + terms.replace(" ", "-"), " ".join(CC_NAMES[t] for t in terms.split())
        for version in ("1", "2", "2.5", "3", "4"):
            v = version.replace(".", " ") + ("" if "." in version else "(?: 0)?")
            made.append(_rule(f"{label}-{version}", f"cc {terms} {v}", f"cc {terms}", 0.97, 75 + len(terms)))
            made.append(_rule(f"{label}-{version}", f"creative commons {spelled}(?: license)? {v}", "creative commons", 0.97,
                              75 + len(terms)))
        made.append(_rule(label, f"cc {terms}", f"cc {terms}", 0.8, 30 + len(terms)))
        made.append(_rule(label, f"creative commons {spelled}", "creative commons", 0.8, 30 + len(terms)))
    for family, name, versions in FAMILIES:
        for phrasing, score, priority in PHRASINGS:
            if "{version}" not in phrasing:
                made.append(_rule(family, phrasing.format(name=name), name, score, priority))
                continue
            for version in versions.split():
                spelled = "(?:version |v)?" + version.replace(".", " ") + ("" if "." in version else "(?: 0)?")
                made.append(_rule(f"{family}-{version}", phrasing.format(name=name, version=spelled), name, score, priority))
    for family, name, versions, alone in SHORT:
        plain = re.sub(r"\(\?[^)]*\)", "", name)
        for phrasing, keyword, score, priority in (*SHORT_PHRASINGS, *([BARE] if alone else ())):
            if "{version}" not in phrasing:
                made.append(_rule(family, phrasing.format(name=name, operand=OPERAND), keyword or plain, score, priority))
                continue
            for version in versions.split():
                # "gpl 3 0", "gplv3", "gpl version 3", but 2 is not the beginning of 2.1
                spelled = " ?(?:version |v)?" + version.replace(".", " ") + ("" if "." in version else "(?: 0)?") + r"(?! \d[a-c]? )"
                made.append(_rule(f"{family}-{version}", phrasing.format(name=name, version=spelled, range=RANGE, operand=OPERAND),
                                  keyword or plain, score, priority))
    return sorted(made, key=lambda r: (-r.priority, r.label, r.pattern.pattern))


_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_BASE = [(label, f" {phrase} ".encode(), len(phrase.split())) for phrase, label in BASE]


@lru_cache(maxsize=1)
def _gate() -> tuple[list[Rule], ahocorasick.Automaton]:
    """The rules in order, and an automaton that finds in one pass which keywords a text has."""
    ordered, found = rules(), ahocorasick.Automaton()
    by_keyword: dict[str, list[int]] = {}
    for k, rule in enumerate(ordered):
        by_keyword.setdefault(rule.keyword.decode("latin-1"), []).append(k)
    for keyword, numbers in by_keyword.items():
        found.add_word(keyword, tuple(numbers))
    found.make_automaton()
    return ordered, found


def detections(text: str | None) -> tuple[int, list[tuple[str, int, int, float, bool]]]:
    """Number of words, and (label, first word, last word, score, base) of what was found."""
    ordered, gate = _gate()
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    found: list[tuple[str, int, int, float, bool]] = []
    if not words:
        return 0, found
    plain = b" " + b" ".join(words) + b" "
    blanks = np.flatnonzero(np.frombuffer(plain, np.uint8) == 0x20)
    for label, phrase, n in _BASE:
        places, at = [], plain.find(phrase)
        while at >= 0:
            places.append(at)
            at = plain.find(phrase, at + 1)
        for first in np.searchsorted(blanks, places).tolist():
            found.append((label, first, first + n - 1, 1.0, True))
    present = {numbers for _, numbers in gate.iter(plain.decode("latin-1"))}
    if present:
        kept = np.zeros((2, 0), np.int64)
        for rule in (ordered[k] for k in sorted(k for numbers in present for k in numbers)):
            spans = np.array([m.span() for m in rule.pattern.finditer(plain)], np.int64).reshape(-1, 2).T
            if not spans.size:
                continue
            new = spans[:, ~_within(spans, kept)]
            first, end = np.searchsorted(blanks, new[0]) - 1, np.searchsorted(blanks, new[1])
            found += [(rule.label, a, b, rule.score, False) for a, b in zip(first.tolist(), (end - 1).tolist())]
            kept = _outermost(np.concatenate([kept, new], 1))
    return len(words), sorted(found, key=lambda d: (d[1], -d[2], d[0]))


def _outermost(spans: np.ndarray) -> np.ndarray:
    """Spans that lie in no other one, in order: starts and ends both rise."""
    spans = spans[:, np.lexsort((-spans[1], spans[0]))]
    reach = np.maximum.accumulate(spans[1])
    return spans[:, np.concatenate([[True], spans[1, 1:] > reach[:-1]])[: spans.shape[1]]]


def _within(spans: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Which spans lie in one of ``kept`` (outermost ones): the last that starts no later reaches furthest."""
    at = np.searchsorted(kept[0], spans[0], "right") - 1
    inside = np.zeros(spans.shape[1], bool)
    some = np.flatnonzero(at >= 0)
    inside[some] = kept[1, at[some]] >= spans[1, some]
    return inside


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns), ``n_words`` and ``detections`` (label, first, last, score, base)."""
    item = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()),
                      ("base", pa.bool_())])
    names = item.names

    def work(rows):
        results = [detections(t) for t in rows.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [rows.column("row"), pa.array([n for n, _ in results], pa.int64()),
             pa.array([[dict(zip(names, d)) for d in found] for _, found in results], pa.list_(item))],
            names=["row", "n_words", "detections"])

    whole = in_row(docs).select("row", F.col(f"row.`{text}`").alias("text"))
    added = StructType.fromDDL(
        "n_words long, detections array<struct<label: string, first: long, last: long, score: double, base: boolean>>")
    return by_batch(whole, work, StructType([*whole.select("row").schema, *added]))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = "filter(detections, d -> d.base)"
    names = "concat_ws(',', array_sort(array_distinct(transform({}, d -> d.label))))"
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).selectExpr(
        "row.doc_id", "n_words", f"cast(size({base}) as long) as n_base",
        f"array_min(transform({base}, d -> d.first)) as first_word",
        f"array_max(transform({base}, d -> d.first)) as last_word",
        names.format(base) + " as base_labels", names.format("detections") + " as labels",
        "coalesce(array_max(transform(detections, d -> d.score)), 0D) as score")
