"""License scans: ordered signature rules behind a keyword prefilter.

The rules are hand-written signatures of license bodies, headers, links and notices
(``license_rules.SIGNATURES``), tag lines with identifiers, and families of license names with their
versions and phrasings. Each has a label, a priority and up to two keywords, the longest words that all
of its matches hold. One pass of a keyword automaton over a few megabytes of texts tells which texts hold
which keywords, and a text is searched by the rules of its keywords alone. Detections that lie within a
detection of higher priority, or of a longer one of equal priority, are suppressed by sorted sweeps, so the work
grows as n log n with a text's detections.

Besides, three fixed phrases are counted over the text's words. Defined cases: a null text is empty; a
text without any detection has empty labels and score 0; a very long text is searched whole, in time that
grows linearly; rows without an id and repeated rows are scanned each; other columns of the documents don't
matter; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.llm import _text as t
from tidelog.llm.license_rules import IDENTIFIERS, LINK, NAME, REFERENCE, SIGNATURES, TAG

#: fixed phrases and labels
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: label stem, name patterns, versions (empty: none)
FAMILIES: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("apache", (r"apache(?: software)? licen[cs]e",), ("1.0", "1.1", "2.0")),
    ("mit", (r"(?:the )?mit(?: \(?expat\)?)? licen[cs]e", r"expat licen[cs]e"), ()),
    ("gnu-gpl", (r"gnu general public licen[cs]e", r"gnu gpl", r"gpl"), ("1.0", "2.0", "3.0")),
    ("gnu-lgpl", (r"gnu lesser general public licen[cs]e", r"gnu library general public licen[cs]e", r"lgpl"), ("2.0", "2.1", "3.0")),
    ("gnu-agpl", (r"gnu affero general public licen[cs]e", r"agpl"), ("1.0", "3.0")),
    ("gnu-fdl", (r"gnu free documentation licen[cs]e", r"gfdl"), ("1.1", "1.2", "1.3")),
    ("mpl", (r"mozilla public licen[cs]e", r"mpl"), ("1.0", "1.1", "2.0")),
    ("epl", (r"eclipse public licen[cs]e",), ("1.0", "2.0")),
    ("cddl", (r"common development and distribution licen[cs]e", r"cddl"), ("1.0", "1.1")),
    ("cpl", (r"common public licen[cs]e",), ("1.0",)),
    ("eupl", (r"european union public licen[cs]e", r"eupl"), ("1.0", "1.1", "1.2")),
    ("artistic", (r"artistic licen[cs]e",), ("1.0", "2.0")),
    ("bsd", (r"bsd licen[cs]e", r"bsd-style licen[cs]e"), ()),
    ("bsd-2-clause", (r"(?:simplified|2-clause|two-clause) bsd licen[cs]e", r"bsd 2-clause"), ()),
    ("bsd-3-clause", (r"(?:new|revised|modified|3-clause|three-clause) bsd licen[cs]e", r"bsd 3-clause"), ()),
    ("isc", (r"isc licen[cs]e",), ()),
    ("zlib", (r"zlib(?:/libpng)? licen[cs]e",), ()),
    ("boost", (r"boost software licen[cs]e",), ("1.0",)),
    ("python", (r"python software foundation licen[cs]e", r"psf licen[cs]e"), ("2.0",)),
    ("php", (r"php licen[cs]e",), ("3.0", "3.01")),
    ("ofl", (r"(?:sil )?open font licen[cs]e",), ("1.0", "1.1")),
    ("unlicense", (r"the unlicense", r"released into the public domain"), ()),
    ("public-domain", (r"(?:in|into) the public domain", r"public domain dedication"), ()),
    ("wtfpl", (r"do what the fuck you want to public licen[cs]e", r"wtfpl"), ("2.0",)),
    ("ms-pl", (r"microsoft public licen[cs]e", r"ms-pl"), ()),
    ("osl", (r"open software licen[cs]e",), ("2.0", "2.1", "3.0")),
    ("afl", (r"academic free licen[cs]e",), ("2.0", "2.1", "3.0")),
    ("odbl", (r"open data(?:base)? (?:commons )?(?:open database )?licen[cs]e", r"odbl"), ("1.0",)),
    ("pddl", (r"public domain dedication and licen[cs]e", r"pddl"), ("1.0",)),
    ("cc0", (r"cc0", r"creative commons zero"), ("1.0",)),
    ("cc-by-sa", (r"cc[ -]by-sa", r"creative commons attribution[- ]share ?alike(?: licen[cs]e)?"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", (r"cc[ -]by-nc", r"creative commons attribution[- ]non-?commercial(?: licen[cs]e)?"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", (r"cc[ -]by-nd", r"creative commons attribution[- ]no ?derivatives(?: licen[cs]e)?"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", (r"cc[ -]by-nc-sa", r"creative commons attribution[- ]non-?commercial[- ]share ?alike(?: licen[cs]e)?"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd", (r"cc[ -]by-nc-nd", r"creative commons attribution[- ]non-?commercial[- ]no ?derivatives(?: licen[cs]e)?"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-attribution", (r"cc[ -]by", r"creative commons attribution(?: licen[cs]e)?"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("commercial", (r"proprietary and confidential", r"commercial licen[cs]e agreement", r"all rights are reserved"), ()),
)
#: what makes a name a reference, right before it
_UNDER = re.compile(r"(?:(?:is|are) )?(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?$")
_UNDER_MOST = 80
#: a version that is written on to a name, as in gplv3
_JOINED = r"(?=v\d+(?:\.\d+)*\b|(?<!\d)\d(?:\.\d)?\b)"
#: a tag line: in a source file, or in a package's description
_TAGS = re.compile(r"(?:spdx-license-identifier:|licen[cs]e[\"']? ?[:=])\s{0,4}[\"'(\[]{0,2}([a-z0-9][\w.+-]{1,30}(?: (?:or|and|with) [\w.+-]{2,40}){0,4})")
#: words that are too common to be keywords
_COMMON = frozenset("and any are been but by data fair for from has have his how its just may most non not only open or part see sell some such than that the their them then this under use was were will with work you your".split())
_WORD = re.compile(r"\w+")
_CC_BY = re.compile(rb"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by")


class Rule(NamedTuple):
    keywords: tuple[str, ...]
    label: str
    priority: int
    pattern: re.Pattern
    #: of a name: versions that have labels of their own; None for a signature
    versions: tuple[str, ...] | None
    #: whether it is matched in the text as it is
    raw: bool


class Detection(NamedTuple):
    start: int
    end: int
    label: str
    priority: int


def _alternatives(pattern: str) -> list[str]:
    """The pattern's alternatives outside of any group."""
    out, depth = [""], 0
    for c in pattern:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def keywords(pattern: str) -> tuple[str, ...]:
    """The two longest literal words, not too common ones, that every match of the pattern holds."""
    p = pattern.replace(r"\.", ".")
    p = re.sub(r"\[[^]]*\](?:\{[^}]*\})?[?*+]*|\\\w(?:\{[^}]*\})?[?*+]*", "\0", p)
    while (less := re.sub(r"\([^()]*\)[?*+]*", "\0", p)) != p:
        p = less
    p = re.sub(r".[?*]", "\0", p)
    words = sorted({w for w in re.findall(r"[\w./-]{2,}", p) if w not in _COMMON}, key=lambda w: (-len(w), w))
    return tuple(w for w in words[:2] if len(w) > 2) or tuple(words[:1])


@lru_cache(1)
def rules() -> list[Rule]:
    """All rules in the order in which they count: highest priority first."""
    out = [Rule(keywords(x), label, priority, re.compile(rf"{x}(?!\w)"), None, priority == LINK) for label, priority, pattern in SIGNATURES for x in _alternatives(pattern)]
    for stem, names, versions in FAMILIES:
        for name in names:
            out.append(Rule(keywords(name), stem, NAME, re.compile(rf"{name}(?:\b|{_JOINED})(?:(?:,? ?(?:version|v|v\.)?[ -]?)(\d+(?:\.\d+)*)\b)?"), versions, True))
    return sorted(out, key=lambda r: -r.priority)


@lru_cache(1)
def _automaton() -> tuple[ahocorasick.Automaton, dict[str, list[Rule]], list[Rule]]:
    """The keywords' automaton, the rules by their first keyword, and those without any."""
    by, rest, words = defaultdict(list), [], {"licen", "spdx-license", "license", "reserved"}
    for r in rules():
        (by[r.keywords[0]] if r.keywords else rest).append(r)
        words.update(r.keywords)
    found = ahocorasick.Automaton()
    for w in words - {"cc"}:  # two letters of many words: looked for with its neighbour instead
        found.add_word(w, w)
    found.make_automaton()
    return found, by, rest


def held_keywords(text: str) -> set[str]:
    return {w for _, w in _automaton()[0].iter(text)} | ({"cc"} if _CC_BY.search(text.encode()) else set())


class _Words:
    """A text's words with single spaces between them, and where they come from; a wide gap is a line end."""

    def __init__(self, text: str):
        spans = [m.span() for m in _WORD.finditer(text)]
        at = np.array(spans, np.int64).reshape(-1, 2)
        wide = at[1:, 0] - at[:-1, 1] > 12
        self.text = "".join([x for (s, e), w in zip(spans, [*wide.tolist(), False], strict=True) for x in (text[s:e], "\n" if w else " ")]) if spans else ""
        self.raw = at[:, 0]
        size = at[:, 1] - at[:, 0] + 1
        self.start = np.cumsum(size) - size

    def place(self, k: int) -> int:
        """Where the character at k of the words stands in the text."""
        i = int(np.searchsorted(self.start, k, "right")) - 1
        return int(self.raw[i]) + k - int(self.start[i])


def detect(text: str, held: set[str] | None = None) -> list[Detection]:
    """The detections in a lower-case text that no other contains; ``held``: the keywords in it."""
    held = held_keywords(text) if held is None else held
    _, by, rest = _automaton()
    found: list[Detection] = []
    if "licen" in held or "spdx-license" in held:
        for m in _TAGS.finditer(text):
            for x in re.finditer(r"[\w.+-]+", m[1]):
                if label := IDENTIFIERS.get(re.sub(r"(?:-only|-or-later|\+)$|[.]$", "", x[0])):
                    found.append(Detection(m.start(1) + x.start(), m.start(1) + x.end(), label, TAG))
    words: _Words | None = None
    for r in [*rest, *[r for w in held for r in by.get(w, ())]]:
        if not all(k in held for k in r.keywords):
            continue
        if not r.raw and words is None:
            words = _Words(text)
        where = text if r.raw else words.text
        for m in r.pattern.finditer(where):
            s, e, label, priority = m.start(), m.end(), r.label, r.priority
            if s and (where[s - 1].isalnum() or where[s - 1] == "_"):
                continue
            if r.versions is not None:
                v = m[1] and (m[1] if "." in m[1] else f"{m[1]}.0")
                if v in r.versions:
                    label, priority = f"{label}-{v}", priority + 5
                elif m[1]:
                    e = m.end(1) - len(m[1])
                if under := _UNDER.search(text, max(0, s - _UNDER_MOST), s):
                    s, priority = under.start(), priority + REFERENCE - NAME
            elif not r.raw:
                s, e = words.place(s), words.place(e - 1) + 1
            found.append(Detection(s, e, label, priority))
    return suppressed(found)


def suppressed(found: list[Detection]) -> list[Detection]:
    """Without those that lie within one of higher priority, or within a longer or earlier-named one of the same."""
    groups = defaultdict(list)
    for d in found:
        groups[d.priority].append(d)
    starts: list[int] = []  # of all detections of higher priority, sorted
    reach: list[int] = []  # how far any of them reaches up to that start
    higher: list[tuple[int, int]] = []
    kept: list[Detection] = []
    for priority in sorted(groups, reverse=True):
        furthest = -1
        for d in sorted(groups[priority], key=lambda d: (d.start, -d.end, d.label)):
            k = bisect_right(starts, d.start)
            if d.end > furthest and not (k and reach[k - 1] >= d.end):
                kept.append(d)
            furthest = max(furthest, d.end)
        higher = sorted(higher + [(d.start, d.end) for d in groups[priority]])
        starts, reach, furthest = [s for s, _ in higher], [], -1
        for _, e in higher:
            furthest = max(furthest, e)
            reach.append(furthest)
    return sorted(kept)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its words, the fixed phrases' places, and labels with a score.

    The score is 1 - 1 / (1 + w), w adding up the priorities of the detections over 60 and one third
    for each place of a fixed phrase; 0 without any.
    """
    t.tuned(docs.sparkSession)
    phrases = [(p.split(), label) for p, label in PHRASES]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _automaton()[0]
        for b in batches:
            for lo, hi, raw, off in t.chunks(b.column(1)):
                data = t.LOWER[raw]
                _, _, border = t.words(data, off, t.ALNUM)
                n = hi - lo
                base, first, last = np.zeros(n, np.int64), [None] * n, [None] * n
                base_labels, labels, score = [""] * n, [""] * n, np.zeros(n)
                whole = data.tobytes().decode()
                start = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[off] if len(data) else off  # in characters
                held: dict[int, set[str]] = defaultdict(set)
                hits = list(keys.iter(whole))
                for m in _CC_BY.finditer(data.tobytes()):
                    d = int(np.searchsorted(off, m.start(), "right")) - 1
                    if m.end() <= off[d + 1]:
                        held[d].add("cc")
                of = np.searchsorted(start, np.array([at for at, _ in hits], np.int64), "right") - 1
                for (at, w), d in zip(hits, of.tolist(), strict=True):
                    if at - len(w) + 1 >= start[d]:  # not across two texts
                        held[d].add(w)
                for d in sorted(held):
                    text = whole[start[d] : start[d + 1]]
                    places = []
                    if held[d] & {"reserved", "license", "cc"}:  # each phrase has one of these
                        w = word.findall(text)
                        places = [(i, label) for p, label in phrases for i in range(len(w) - len(p) + 1) if w[i] == p[0] and w[i : i + len(p)] == p]
                    own = {label for _, label in places}
                    found = detect(text, held[d])
                    base[d] = len(places)
                    if places:
                        first[d], last[d] = min(places)[0], max(places)[0]
                    base_labels[d], labels[d] = ",".join(sorted(own)), ",".join(sorted(own | {x.label for x in found}))
                    weight = sum(x.priority for x in found) / 60 + len(places) / 3
                    score[d] = 1 - 1 / (1 + weight)
                yield pa.record_batch(
                    [b.column(0).slice(lo, n), pa.array(np.diff(border)), pa.array(base), pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(base_labels), pa.array(labels), pa.array(score)],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
