"""Licence scans: known sentences by identifier, then rules over the identifiers in order."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, chunks, texts

# Sentences as licences print them, normalised; groups become part of the identifier.
SENTENCES = (
    ("SpdxTag", r"spdx license identifier (?P<spdx>[a-z0-9.+ -]+)"),
    ("GplFree", r"(?:this program|this library|[a-z0-9 ]+) is free software you can redistribute it and/?(?: )?or modify it under the terms of the (?P<fam>gnu (?:affero |lesser |library )?general public license) as published by the free software foundation(?: either)? version (?P<ver>[0-9.]+)(?P<later> of the license or at your option any later version)?(?: of the license)?"),
    ("GplHope", r"(?:this program|this library|[a-z0-9 ]+) is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("GplSee", r"see the gnu (?:affero |lesser |library )?general public license for more details"),
    ("GplReceived", r"you should have received a copy of the gnu (?:affero |lesser |library )?general public license along with this (?:program|library)(?: if not .*)?"),
    ("GplUnder", r"(?:this (?:work|program|software|library|file|project|code) is |released |distributed |available )?licensed under the (?P<fam>gnu (?:affero |lesser |library )?general public license)(?: version| v)? ?(?P<ver>[0-9.]+)?(?P<later> or(?: at your option)?(?: any)? later(?: version)?)?"),
    ("ApacheUnder", r"(?:(?:this (?:work|program|software|library|file|project|code) is )?licensed|released|distributed|available) under the apache license(?: version| v)? ?(?P<ver>[0-9.]+)(?: the license)?"),
    ("ApacheMayNot", r"you may not use this file except in compliance with the license"),
    ("ApacheObtain", r"you may obtain a copy of the license at(?: .*)?"),
    ("ApacheUnless", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("ApacheSee", r"see the license for the specific language governing permissions and limitations under the license"),
    ("MitUnder", r"(?:(?:this (?:work|program|software|library|file|project|code) is )?licensed|released|distributed|available) under the (?:terms of the )?mit license"),
    ("MitPermission", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/?(?: )?or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("MitNotice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("MitAsIs", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("MitLiability", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("IscPermission", r"permission to use copy modify and/?(?: )?or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("IscAsIs", r"the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("BsdUnder", r"(?:(?:this (?:work|program|software|library|file|project|code) is )?licensed|released|distributed|available) under the (?P<num>[0-9]|two|three|four)?(?: )?(?:clause )?bsd license"),
    ("BsdRedistribution", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("BsdSource", r"(?:[0-9] )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("BsdBinary", r"(?:[0-9] )?redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/?(?: )?or other materials provided with the distribution"),
    ("BsdEndorse", r"(?:[0-9] )?neither the name of .* nor the names of (?:its|their) contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BsdAsIs", r"this software is provided by the (?:copyright holders and contributors|author and contributors|author) as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("BsdLiability", r"in no event shall the (?:copyright (?:holder|owner)(?:s)? or contributors|author or contributors|author) be liable for any direct indirect incidental special exemplary or consequential damages .*"),
    ("MplSubject", r"this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?(?P<ver>[0-9.]+)"),
    ("MplObtain", r"if a copy of the mpl was not distributed with this file you can obtain one at .*"),
    ("CcUnder", r"(?:(?:this (?:work|program|text|page|document|article|content) is )?licensed|released|distributed|available) under (?:a |the )?(?:cc|creative commons) (?P<cc>attribution(?: (?:noncommercial|share ?alike|noderivatives|noderivs))*|[a-z]+(?: (?:by|nc|nd|sa))*)(?: license| international| unported)* ?(?P<ver>[0-9.]+)?(?: license| international(?: license)?| unported(?: license)?)?"),
    ("Unlicense", r"this is free and unencumbered software released into the public domain"),
    ("PublicDomain", r"(?:this (?:work|program|software|text|page|document|code) is |released |placed |dedicated )(?:in|into|to) the public domain"),
    ("AllRights", r"(?:copyright .* )?all rights reserved"),
    ("SeeFile", r"see the license file(?: .*)? for (?:details|more information|licensing information)"),
)

# Rules in order; the first that fits takes its sentences. "?" marks sentences that may lack.
RULES = (
    ("BSD-3-Clause", ("BsdRedistribution", "BsdSource", "BsdBinary", "BsdEndorse", "BsdAsIs?", "BsdLiability?")),
    ("BSD-2-Clause", ("BsdRedistribution", "BsdSource", "BsdBinary", "BsdAsIs?", "BsdLiability?")),
    ("MIT", ("MitPermission", "MitNotice", "MitAsIs?", "MitLiability?")),
    ("ISC", ("IscPermission", "IscAsIs?")),
    ("{fam}", ("GplFree", "GplHope?", "GplSee?", "GplReceived?")),
    ("Apache-{ver}", ("ApacheUnder", "ApacheMayNot?", "ApacheObtain?", "ApacheUnless?", "ApacheSee?")),
    ("MPL-{ver}", ("MplSubject", "MplObtain?")),
    ("{fam}", ("GplUnder", "GplHope?", "GplSee?", "GplReceived?")),
    ("MIT", ("MitUnder",)),
    ("BSD-{num}-Clause", ("BsdUnder",)),
    ("CC-{cc}", ("CcUnder",)),
    ("{spdx}", ("SpdxTag",)),
    ("Unlicense", ("Unlicense",)),
    ("Public-domain", ("PublicDomain",)),
    ("All-rights-reserved", ("AllRights",)),
    ("See-file", ("SeeFile",)),
)

# A text that holds none of these words holds no sentence of the above; words may be wrapped, or hold a comment mark between them.
MARK = re.compile(
    r"licen[sc]|copyright|permi(?:t|ss)|redistribut|warrant|public[^a-z0-9]+domain|free[^a-z0-9]+software|liable|provided|reserved"
    r"|mpl|\bcc\b|creative[^a-z0-9]+commons", re.I)

_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("licences", pa.string()), ("sentences", pa.string()), ("n_known", pa.int64()), ("n_left", pa.int64()),
])
FOUND = "doc_id long, licences string, sentences string, n_known long, n_left long"

_FAMILY = {"gnu general public license": "GPL", "gnu lesser general public license": "LGPL",
           "gnu library general public license": "LGPL", "gnu affero general public license": "AGPL"}
_NUMBER = {"two": "2", "three": "3", "four": "4"}
_CC = {"attribution": "BY", "noncommercial": "NC", "sharealike": "SA", "noderivatives": "ND", "noderivs": "ND"}
# A normalised text is one string. Between words stands a blank, or what the place is: a wrap or the end of a sentence, the end of
# a paragraph, the begin of a known sentence.
_UNIT, _PARAGRAPH, _KNOWN = b"\n", b"\f", b"\r"
_GAP, _END = r"[ \n\f\r]", r"(?=[\n\f\r]|\Z)"


def _over_lines(pattern: str) -> str:
    """The pattern for words wrapped anywhere; what it leaves open at its end stops with the line or sentence."""
    return re.sub(r"(\[[^]]*\])|( \.\*)|( )", lambda m: m[1] or (r"[ \n\f][^\f\r]+?" if m[2] else _GAP), pattern)


@dataclass(frozen=True)
class _Sentence:
    """A sentence as one pattern, or as a head, an open part, and a tail.

    The open part ends as early as it can, before the next known sentence and with its paragraph. Tails are looked up in a
    list made once per text, so that no start searches its paragraph again.
    """

    name: str
    whole: re.Pattern | None
    head: re.Pattern | None
    tail: re.Pattern | None
    # Whether the head alone, or the open part alone, may lack.
    bare_tail: bool = False
    bare_open: bool = False

    @classmethod
    def of(cls, name: str, pattern: str) -> _Sentence:
        for form, bare_tail, bare_open in ((r"\(\?:(.*) \.\* \)\?(.+)", True, False), (r"(.+)\(\?: \.\*\)\? (.+)", False, True),
                                           (r"(.+) \.\* (.+)", False, False)):
            parts = re.fullmatch(form, pattern)
            if parts:
                head, tail = map(_over_lines, parts.groups())
                return cls(name, None, re.compile(head.encode()), re.compile(rf"(?:{tail}){_END}".encode()), bare_tail, bare_open)
        return cls(name, re.compile(rf"(?:{_over_lines(pattern)}){_END}".encode()), None, None)


class _Edges:
    """Where paragraphs end and known sentences begin; the latter are found from the last to the first."""

    def __init__(self, laid: bytes) -> None:
        self.paragraphs = [m.start() for m in re.finditer(_PARAGRAPH, laid)]
        self.known: list[int] = []

    def mark(self, at: int) -> None:
        self.known.append(-at)

    def next(self, at: int, size: int) -> int:
        """The first edge at or after ``at``, else ``size``."""
        k, j = bisect.bisect_left(self.paragraphs, at), bisect.bisect_right(self.known, -at)
        return min(self.paragraphs[k] if k < len(self.paragraphs) else size, -self.known[j - 1] if j else size)


class _Tails:
    """Starts and ends of one tail in a text, each after a gap or at the begin."""

    def __init__(self, pattern: re.Pattern, laid: bytes) -> None:
        found = [(m.start(), m.end()) for m in re.compile(rb"(?<![^ \n\f\r])" + pattern.pattern).finditer(laid)]
        self.starts, self.ends = [a for a, _ in found], [b for _, b in found]

    def end(self, least: int, most: int) -> int | None:
        """The end of the first tail that starts between the two places."""
        k = bisect.bisect_left(self.starts, least)
        return self.ends[k] if k < len(self.starts) and self.starts[k] <= most else None


_COMPILED = tuple(_Sentence.of(name, pattern) for name, pattern in SENTENCES)
_ANY = re.compile(b"|".join(
    re.sub(rb"\(\?P<[a-z]+>", b"(?:", p.pattern) for s in _COMPILED for p in (s.whole, s.head, s.tail if s.bare_tail else None) if p))
_EDGE = re.compile(r"(?<=[.!?;:])\s+")
_NOISE = re.compile(r"[^a-z0-9./+-]+")
_COMMENT = re.compile(r"^[\s/*#;%>-]+|[\s*/]+$")


def normalise(sentence: str) -> str:
    """Lower case, words only, one blank between; no dot at the end of a word."""
    words = _NOISE.sub(" ", sentence.lower()).replace("-", " ").split()
    return " ".join(w for w in (w.strip("./") for w in words) if w)


def _laid_out(text: str) -> tuple[bytearray, list[int]]:
    """The normalised text, and where its lines and the sentences inside them begin."""
    out, starts, gap = bytearray(), [], b""
    for line in text.split("\n"):
        blank = True
        for sentence in _EDGE.split(_COMMENT.sub("", line)):
            words = normalise(sentence).encode()
            if words:
                out += gap
                starts.append(len(out))
                out += words
                gap, blank = _UNIT, False
        if blank and out:
            gap = _PARAGRAPH
    return out, starts


def known_sentences(text: str) -> list[tuple[str, dict[str, str]]]:
    """The known sentences of a text in order: within a line, or wrapped over any number of following lines.

    From the last start to the first, so that the open part of a sentence never runs over another one.
    """
    laid, starts = _laid_out(text)
    edges, tails = _Edges(laid), {}
    found: dict[int, tuple[int, str, dict[str, str]]] = {}

    def end_of(sentence: _Sentence, at: int) -> int | None:
        if sentence.name not in tails:
            tails[sentence.name] = _Tails(sentence.tail, laid)
        head = sentence.head.match(laid, at)
        end = None
        if head and laid[head.end() : head.end() + 1] in (b" ", _UNIT, _PARAGRAPH, _KNOWN):
            gap = head.end()
            if sentence.bare_open:
                end = tails[sentence.name].end(gap + 1, gap + 1)
            if end is None and laid[gap : gap + 1] != _KNOWN:
                end = tails[sentence.name].end(gap + 3, edges.next(gap + 1, len(laid)) + 1)
        return tails[sentence.name].end(at, at) if end is None and sentence.bare_tail else end

    for at in reversed(starts):
        if not _ANY.match(laid, at):
            continue
        for sentence in _COMPILED:
            match = sentence.whole.match(laid, at) if sentence.whole else None
            end = match.end() if match else None if sentence.whole else end_of(sentence, at)
            if end is not None:
                groups = match.groupdict() if match else {}
                held = {k: " ".join(bytes(v).decode().split()) for k, v in groups.items() if v}
                found[at] = end, sentence.name, held
                if at:
                    laid[at - 1 : at] = _KNOWN
                    edges.mark(at - 1)
                break
    out, end = [], 0
    for at in starts:
        if at >= end and at in found:
            end, name, held = found[at]
            out.append((name, held))
    return out


def _name(template: str, held: dict[str, str]) -> str:
    if template == "{fam}":
        version = held.get("ver", "")
        version = f"-{version if '.' in version else version + '.0'}" if version else ""
        return _FAMILY[held["fam"]] + version + ("-or-later" if held.get("later") else "")
    if template == "CC-{cc}":
        parts = [_CC.get(p, p.upper()) for p in held["cc"].replace("share alike", "sharealike").split()]
        return "-".join(["CC", *parts, *([held["ver"]] if "ver" in held else [])])
    if template == "{spdx}":
        return held["spdx"].replace(" ", "-")
    if template == "BSD-{num}-Clause":
        number = held.get("num")
        return f"BSD-{_NUMBER.get(number, number)}-Clause" if number else "BSD"
    return template.format(**held)


def match_rules(found: list[tuple[str, dict[str, str]]]) -> tuple[list[str], int]:
    """Licences in the order of their sentences, and how many sentences no rule takes."""
    ids = [name for name, _ in found]
    free = [True] * len(ids)
    hits: list[tuple[int, str]] = []
    for template, steps in RULES:
        for start in range(len(ids)):
            at, used = start, []
            for step in steps:
                name = step.rstrip("?")
                if at < len(ids) and free[at] and ids[at] == name:
                    used.append(at)
                    at += 1
                elif not step.endswith("?"):
                    used = []
                    break
            if used:
                hits.append((start, _name(template, found[start][1])))
                for k in used:
                    free[k] = False
    return [name for _, name in sorted(hits)], sum(free)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        rows = []
        for doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(2))):
            found = known_sentences(text) if MARK.search(text) else []
            names, left = match_rules(found)
            rows.append((doc_id, ",".join(dict.fromkeys(names)), ",".join(n for n, _ in found), len(found), left))
        if rows:
            yield batch_of(_FOUND, **dict(zip(_FOUND.names, map(list, zip(*rows)))))


def scan_licences(docs: DataFrame) -> DataFrame:
    """``FOUND``: one row per document with the licences its text names, in order.

    Sentences are normalised (case, punctuation, comment marks, line wraps), taken
    as long as they go, and mapped to identifiers; rules are tried in order and take their sentences.
    A null or empty text has no licences (empty strings). Rows map to rows.
    """
    plain = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(_scan, FOUND)
