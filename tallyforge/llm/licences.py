"""Licence scan by conditional compression.

Each word that mentions licensing is a cue. Around it, as far as the longest notice reaches on both sides, every notice is
looked for by its wording: its words must stand there in order, nearly all of them and close together, and those that tell
it from the other notices must all be there. Every notice found is reported, also several in one line, unless its words
are part of a longer one (the two-clause text in the three-clause one). Its block is compressed alone and with each notice
as zstandard raw dictionary, which tells by how much it shrinks it and which notice comes next. Lines with cues that belong
to no notice are reported unconfirmed with the notice that shrinks them most. Differences are reported.

Texts are read whole in the task that has them; equal blocks are scored once and remembered, up to a bound.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from importlib.resources import files

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices of public licences, as their authors ask to state them, and whole texts.
WHOLE_TEXTS = (
    "MIT", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "0BSD", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1",
    "LGPL-3.0", "MPL-2.0", "CC0-1.0",
)
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0"
    ),
    # The opening alone does not tell the number of clauses.
    "BSD-opening": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met"
    ),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright to this work under CC0 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "all-rights-reserved": "All rights reserved.",
}
NOTICES |= {f"{n}-whole": files("tallyforge.llm.licence_texts").joinpath(f"{n}.txt").read_text("utf-8") for n in WHOLE_TEXTS}
CUES = (
    "licen", "copyright", "all rights reserved", "permission is hereby", "permission to use", "redistribution and use", "cc by",
    "cc0", "spdx",
)
# Words of a cue may stand on two lines, with the marks of a comment between.
_CUE = re.compile("|".join(cue.replace(" ", r"[\W_]+") for cue in CUES), re.IGNORECASE)
_CUE_HEADS = sorted({cue.split(" ")[0] for cue in CUES})
# Share of the notice's words that must stand in the block in order.
LEAST_WORDS = 0.85
# Words of a whole text; share of its words that another one must have to be told from it word by word.
WHOLE_WORDS, ALIKE = 60, 0.75
# Characters of a text whose words are held at once, beside what a notice reaches.
PART_CHARS = 1 << 18
# Blocks remembered, and their longest.
REMEMBERED, REMEMBERED_CHARS = 100_000, 2000
_WORD = re.compile(r"[\w]+(?:[.\-][\w]+)*")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@dataclass(frozen=True)
class Verdict:
    licence: str
    reduction: float
    runner_up: str
    agreement: float
    missing: list[str]
    added: list[str]
    confirmed: bool


@dataclass(frozen=True)
class Found:
    """A notice in a text: its place in characters, and the places of its words."""

    name: str
    start: int
    end: int
    places: frozenset[int]
    agreement: float
    missing: list[str]
    added: list[str]


class NoticeRanker:
    """Notices as raw dictionaries, and the words that tell each from the others like it."""

    def __init__(self, notices: dict[str, str] = NOTICES) -> None:
        self.words = {name: words_of(text) for name, text in notices.items()}
        self.plain = zstandard.ZstdCompressor(level=9, write_content_size=False)
        self.given = {}
        for name, text in notices.items():
            notice = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            notice.precompute_compress(level=9)
            self.given[name] = zstandard.ZstdCompressor(level=9, dict_data=notice, write_content_size=False, write_dict_id=False)
        self.bags = {name: Counter(own) for name, own in self.words.items()}
        short = [set(own) for own in self.words.values() if len(own) <= WHOLE_WORDS]
        common = set.intersection(*short) if short else set()
        self.telling = {}
        for name, own in self.words.items():
            if len(own) <= WHOLE_WORDS:
                rare = {w for w in own if w not in common and sum(w in other for other in short) <= len(short) // 3}
            else:
                alike = [
                    bag
                    for other, bag in self.bags.items()
                    if other != name and (self.bags[name] & bag).total() >= ALIKE * len(own)
                ]
                rare = {w for bag in alike for w in own if w not in bag}
            self.telling[name] = rare
        # Twice the longest notice: line marks and words between its own may spread it.
        self.reach = max([400, *(2 * len(text) for text in notices.values())])
        own_cues = [w for name, text in notices.items() if not _CUE.search(text) for w in self._any_of(name, self.bags[name])]
        self.own_cues = re.compile(rf"\b(?:{'|'.join(map(re.escape, sorted(set(own_cues))))})\b", re.IGNORECASE) if own_cues else None
        self.known: dict[str, tuple[int, list[tuple[int, str]]]] = {}
        self.judged: dict[str, Verdict] = {}

    def _any_of(self, name: str, bag: Counter) -> list[str]:
        """Words of the notice of which one at least stands wherever it is confirmed; the rarest by ``bag``."""
        own = self.words[name]
        if self.telling[name]:
            return [min(sorted(self.telling[name]), key=lambda w: bag[w])]
        lost = int(len(own) * (1 - LEAST_WORDS) + 1e-9)
        return sorted(set(sorted(own, key=lambda w: (bag[w], w))[: lost + 1]))

    def ranked(self, block: str) -> tuple[int, list[tuple[int, str]]]:
        """Compressed size of the block, and with each notice, smallest first."""
        if block in self.known:
            return self.known[block]
        data = block.encode("utf-8", "replace")
        out = len(self.plain.compress(data)), sorted((len(c.compress(data)), name) for name, c in self.given.items())
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(block) <= REMEMBERED_CHARS:
            self.known[block] = out
        return out

    def scan(self, text: str) -> list[tuple[int, str, Verdict]]:
        """Place, block and verdict of every notice in the text, and of every run of lines with cues outside of them."""
        lowered = text.lower()
        cues = [m.span() for m in _CUE.finditer(text)] if any(head in lowered for head in _CUE_HEADS) else []
        # Words of notices without a cue only say where to look.
        places = cues + [m.span() for m in self.own_cues.finditer(text)] if self.own_cues else cues
        found = []
        for start, end in _merged([(max(0, a - self.reach), min(len(text), b + self.reach)) for a, b in places]):
            for part in range(start, end, PART_CHARS):
                found += self._notices(text, part, min(end, part + PART_CHARS + 2 * self.reach))
        out = []
        kept = _without_parts(found)
        for f in kept:
            block = text[f.start : f.end]
            alone, ranked = self.ranked(block)
            second = next((other for _, other in ranked if other != f.name), "")
            size = next(size for size, other in ranked if other == f.name)
            out.append((f.start, block, Verdict(f.name, 1 - size / alone, second, f.agreement, f.missing, f.added, True)))
        spans = _merged([(f.start, f.end) for f in kept])
        free = [c for c in cues if not any(a < c[1] and c[0] < b for a, b in spans)]
        for start, end in _merged([self._lines(text, a, b, spans) for a, b in free]):
            block = text[start:end]
            out.append((start, block, self._nearest(block)))
        return sorted(out, key=lambda row: (row[0], row[2].licence))

    def _lines(self, text: str, first: int, last: int, spans: list[tuple[int, int]]) -> tuple[int, int]:
        """Lines of a cue with the break behind them, as far as a notice reaches and outside of the spans."""
        start = max(text.rfind("\n", 0, first) + 1, first - self.reach, *(b for _, b in spans if b <= first), 0)
        end = text.find("\n", last)
        end = len(text) if end < 0 else end
        return start, min(end, last + self.reach, *(a for a, _ in spans if a >= last), len(text))

    def _nearest(self, block: str) -> Verdict:
        if block in self.judged:
            return self.judged[block]
        alone, ranked = self.ranked(block)
        # The best by compression, then notices within a byte of it, by wording.
        near = [name for size, name in ranked if size <= ranked[0][0] + 1]
        words = words_of(block)
        compared = [(*self._compare(name, words)[:3], name) for name in near]
        agreement, missing, added, name = min(compared, key=lambda c: (-c[0], len(c[2]), c[3]))
        second = next((other for _, other in ranked if other != name), "")
        size = next(size for size, other in ranked if other == name)
        out = Verdict(name, 1 - size / alone, second, agreement, missing, added, False)
        if len(self.judged) >= REMEMBERED:
            self.judged.clear()
        if len(block) <= REMEMBERED_CHARS:
            self.judged[block] = out
        return out

    def _notices(self, text: str, start: int, end: int) -> list[Found]:
        """All notices confirmed in a part of a text."""
        matches = [m.span() for m in _WORD.finditer(text, start, end)]
        words = [text[a:b].lower() for a, b in matches]
        bag, at, out = Counter(words), defaultdict(list), []
        for k, word in enumerate(words):
            at[word].append(k)
        for name, own in self.words.items():
            if not self.telling[name] <= bag.keys() or (self.bags[name] & bag).total() < LEAST_WORDS * len(own):
                continue
            slack, used = len(own) // 2 + 12, set()
            anchors = set(self._any_of(name, bag))
            pairs = [(p, a) for a, word in enumerate(own) if word in anchors for p in at[word]]
            for p, a in sorted(pairs):
                if p in used:
                    continue
                low, high = max(0, p - a - slack), p + len(own) - a + slack
                near = Counter(words[low:high])
                if not self.telling[name] <= near.keys() or (self.bags[name] & near).total() < LEAST_WORDS * len(own):
                    continue
                agreement, missing, added, places = self._compare(name, words[low:high])
                if agreement < LEAST_WORDS or not self.telling[name] <= {words[low + k] for k in places}:
                    continue
                places = [low + k for k in places]
                used.update(places)
                span = matches[places[0]][0], matches[places[-1]][1]
                out.append(Found(name, *span, frozenset(matches[k][0] for k in places), agreement, missing, added))
        return out

    def _compare(self, name: str, found: list[str]) -> tuple[float, list[str], list[str], list[int]]:
        """Share of the notice's words in the block in order, words missing, words added between them, places of its words."""
        own = self.words[name]
        # In whole texts of thousands of words a run is not begun at the commonest words, only continued over them.
        blocks = SequenceMatcher(None, own, found, autojunk=len(own) > 1000).get_matching_blocks()
        kept = sum(b.size for b in blocks)
        missing, added, places, at = [], [], [], None
        for a, b, size in blocks:
            missing += own[0 if at is None else at[0] : a]
            if at is not None and a < len(own):
                added += found[at[1] : b]
            at = a + size, b + size
            places += range(b, b + size)
        return kept / max(1, len(own)), missing, added, places


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch with one character between, as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def _without_parts(found: list[Found]) -> list[Found]:
    """One of equal finds, none whose words are nearly all those of a longer one."""
    kept: list[Found] = []
    for f in sorted(found, key=lambda f: (-len(f.places), -f.agreement, f.name, f.start)):
        near = [other for other in kept if other.start < f.end and f.start < other.end]
        if not any(len(f.places & other.places) >= LEAST_WORDS * len(f.places) for other in near):
            kept.append(f)
    return kept


SCHEMA = (
    "doc_id long, start int, block string, licence string, reduction double, runner_up string, agreement double,"
    " missing array<string>, added array<string>, confirmed boolean"
)


def scan(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row for each notice, and each run of other lines with cues, of each row of ``docs``; see ``SCHEMA``.

    start is the block's place in the text in characters: a confirmed block begins with the first word of the notice and
    ends with its last, and other blocks are lines. Null and empty texts and texts without a cue give no row;
    repeated rows give repeated rows; a null id stays null; of equally good notices the first by name wins; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = NoticeRanker(notices)
        names = [part.strip().split(" ")[0] for part in SCHEMA.split(",")]
        text_list = pa.list_(pa.string())
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.float64(), text_list,
                 text_list, pa.bool_()]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                for start, block, v in ranker.scan(text.as_py() or ""):
                    rows.append((doc_id.as_py(), start, block, v.licence, v.reduction, v.runner_up, v.agreement,
                                 v.missing, v.added, v.confirmed))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
