"""Licence scans by sentence rules.

A text is cut into sentences; each is normalised (lower case, letters and digits only, one space) and looked up among
sentences known from licences, which gives it an identifier: first in a table of exact sentences, which is made from
licence texts (`licence_texts`), then among patterns, for sentences with slots such as version numbers and names of
holders. A document is then a sequence of identifiers, and a licence is recognised where an ordered rule matches the
sequence: its identifiers in order, with at most `gap` other sentences between two. Longer rules go first and use up their
sentences, so a full text isn't reported again as each of its parts. A licence's first sentences alone are a rule too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .licence_texts import TEXTS
from .shared import picked, trimmed

# Sentences of public licences with slots, normalised, as patterns that match a whole sentence.
SENTENCES = {
    "apache-notice": r"(?:this (?:file|work|software|project) is )?licen[cs]ed under the apache licen[cs]e(?: version)? 2(?: 0)?(?: the licen[cs]e)?",
    "apache-use": r"you may not use this file except in compliance with the licen[cs]e",
    "apache-copy": r"you may obtain a copy of the licen[cs]e at(?: https?)?(?: www apache org licenses license 2 0(?: txt)?)?",
    "apache-basis": r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": r"see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e",
    "gpl-notice": r"(?:this (?:work|file|program|software|project) is )?licen[cs]ed under the(?: terms of the)? gnu (?P<kind>lesser |library |affero )?general public licen[cs]e(?: version (?P<version>[123](?: [01])?))?(?P<later> or(?: at your option)? any later version)?",
    "gpl-free": r"(?:.+ )?is free software you can redistribute it and or modify it under the terms of the gnu (?P<kind>lesser |library |affero )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version (?P<version>[123](?: [01])?)(?: of the licen[cs]e)?(?: as published by the free software foundation)?(?P<later> or at your option any later version)?",
    "gpl-hope": r"(?:.+ )?is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": r"see the gnu (?:lesser |library |affero )?general public licen[cs]e for more details",
    "gpl-copy": r"you should have received a copy of the gnu (?:lesser |library |affero )?general public licen[cs]e(?: along)?(?: with .+)?",
    "mit-notice": r"(?:(?:this (?:work|file|software|project) is )?(?:released|licen[cs]ed|distributed|available) under )?(?:the )?(?:terms of the )?mit licen[cs]e",
    "mit-grant": r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-notice": r"(?:this (?:work|file|software|project) is )?(?:released|licen[cs]ed|distributed) under (?:the |a )?(?:terms of the )?(?:(?P<clauses>[023]) clause |new |modified |simplified )?bsd(?: (?P<clauses2>[023]) clause)?(?: style)? licen[cs]e",
    "bsd-grant": r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": r"neither the names? of .+ nor the names of (?:its|their|other) contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": r"this software is provided by .+ as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liable": r"in no event shall .+ be liable for any direct indirect incidental special exemplary or consequential damages .+ even if advised of the possibility of such damage",
    "cc-notice": r"(?:(?:this (?:work|file|text|article|content) is )?licen[cs]ed under )?(?:a |the )?(?:creative commons|cc) (?P<parts>(?:by|attribution)(?:(?: |-)(?:nc|noncommercial|non commercial|sa|sharealike|share alike|nd|noderivs|noderivatives|no derivatives))*)(?: (?P<version>[1234] [0-9]))?(?: (?:international|unported|generic))?(?: licen[cs]e)?",
    "cc0-notice": r"(?:(?:this (?:work|file|text) is )?(?:licen[cs]ed|released|dedicated) (?:under|to) )?(?:the )?(?:creative commons zero|cc0)(?: 1 0)?(?: universal)?(?: licen[cs]e)?",
    "mpl-notice": r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?(?P<version>2 0|1 1)",
    "mpl-copy": r"if a copy of the mpl was not distributed with this file you can obtain one at https? (?:www )?mozilla org mpl 2 0",
    "mpl-1": r"the contents of this file are subject to the mozilla public licen[cs]e version (?P<version>1 [01]) the licen[cs]e you may not use this file except in compliance with the licen[cs]e",
    "epl-notice": r"(?:.+ )?(?:this program and )?the accompanying materials are made available under the terms of the eclipse public licen[cs]e v?(?:ersion )?(?P<version>[12] 0)(?: which accompanies this distribution)?(?: and| which)?(?: is available at .+)?",
    "named-notice": r"(?:.+ )?(?:released|licen[cs]ed|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?P<name>isc|zlib|boost software|unlicen[cs]e|artistic|eclipse public|mozilla public)(?: licen[cs]e)?(?: (?:version |v)?(?P<version>[12] [01]))?(?: licen[cs]e)?",
    "spdx": r"spdx licen[cs]e identifier (?P<id>[a-z0-9 ]+)",
    "reserved": r"all rights reserved",
    "copyright": r"(?:copyright )?(?:c )?(?:copyright )(?:c )?[12][0-9]{3}(?:(?!licen[cs]e|permission).)*",
}


@dataclass(frozen=True)
class Rule:
    """A licence and the sentence identifiers that make it, in order. {name} in the licence stands for what the first sentence says."""

    licence: str
    sentences: tuple[str, ...]


#: Rules are tried from the longest; equal ones in this order.
RULES = (
    Rule("Apache-2.0", ("apache-notice", "apache-use", "apache-copy", "apache-basis", "apache-see")),
    Rule("Apache-2.0", ("apache-notice", "apache-use")),
    Rule("Apache-2.0", ("apache-notice",)),
    Rule("GPL", ("gpl-free", "gpl-hope", "gpl-see", "gpl-copy")),
    Rule("GPL", ("gpl-free", "gpl-hope", "gpl-see")),
    Rule("GPL", ("gpl-free",)),
    Rule("GPL", ("gpl-notice",)),
    Rule("MIT", ("mit-notice", "mit-grant", "mit-keep", "mit-as-is")),
    Rule("MIT", ("mit-grant", "mit-keep", "mit-as-is")),
    Rule("MIT", ("mit-grant", "mit-keep")),
    Rule("MIT", ("mit-notice",)),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liable")),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liable")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("BSD", ("bsd-notice",)),
    Rule("CC", ("cc-notice",)),
    Rule("CC0-1.0", ("cc0-notice",)),
    Rule("MPL", ("mpl-notice", "mpl-copy")),
    Rule("MPL", ("mpl-notice",)),
    Rule("MPL", ("mpl-1",)),
    Rule("EPL", ("epl-notice",)),
    Rule("NAMED", ("named-notice",)),
    Rule("SPDX", ("spdx",)),
    Rule("Proprietary", ("copyright", "reserved")),
)

_KNOWN = [(name, re.compile(pattern)) for name, pattern in SENTENCES.items()]
# Identifiers of licences that a notice may name in words.
NAMES = {"isc": "ISC", "zlib": "Zlib", "boost software": "BSL-1.0", "unlicense": "Unlicense", "unlicence": "Unlicense", "artistic": "Artistic", "eclipse public": "EPL", "mozilla public": "MPL"}
#: A sentence without any of these words matches no pattern, and most texts have none at all.
_HINT = re.compile(r"licen[cs]e|permission|redistribut|copyright|warrant|reserved|creative commons|\bcc\b|\bcc0|gnu|notice|mozilla|applicable law|neither the name|\bmit\b|software", re.I)
_END = re.compile(r"(?<=[.!?])(?<!\b[vV]\.)[\x20\x09-\x0D]+|(?<=:)[\x20\x09]*\n[\x20\x09-\x0D]*|\n[\x20\x09]*\n[\x20\x09-\x0D]*")
_PART = re.compile(r"(?<=;)[\x20\x09-\x0D]+")
_LINE = re.compile(r"\n")
_OTHER = re.compile(r"[\W_]+")


def normalised(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip()


def sentences(text: str, end: re.Pattern = _END, at: int = 0, stop: int | None = None) -> Iterator[tuple[int, int]]:
    """Spans of sentences: cut after an end mark and white space, but for v. before a number, and at empty lines."""
    stop = len(text) if stop is None else stop
    for m in end.finditer(text, at, stop):
        if m.start() > at:
            yield at, m.start()
        at = m.end()
    if at < stop:
        yield at, stop


def _base() -> tuple[dict[str, str], tuple[Rule, ...]]:
    """Identifiers of the exact sentences of the licence texts, and the rules they make: a whole text, and what tells it by itself: its first sentence that no other text has."""
    exact, chains, owners = {}, {}, {}
    for licence, text in TEXTS.items():
        for a, b in sentences(text.strip()):
            line = normalised(text.strip()[a:b])
            if " " not in line or not _HINT.search(line):  # the number of an item, or a sentence that isn't looked up
                continue
            if line not in exact:
                pattern = next((name for name, p in _KNOWN if p.fullmatch(line)), None)
                exact[line] = pattern or f"{licence.lower()}-{len(chains.get(licence, ())) + 1}"
            chains.setdefault(licence, []).append(exact[line])
            owners.setdefault(exact[line], set()).add(licence)
    rules = []
    for licence, chain in chains.items():
        first = next((c for c in chain if len(owners[c]) == 1 and c not in SENTENCES), None)
        rules += [Rule(licence, tuple(chain)), *([Rule(licence, (first,))] if first and len(chain) > 1 else [])]
    # what a pattern knows needs no entry
    return {line: name for line, name in exact.items() if name not in SENTENCES}, tuple(rules)


EXACT, _FROM_TEXTS = _base()
RULES += _FROM_TEXTS


def _recognised(text: str, a: int, b: int) -> tuple[str, dict] | None:
    if not _HINT.search(text, a, b):
        return None
    line = normalised(text[a:b])
    if (known := EXACT.get(line)) is not None:
        return known, {}
    return next(((name, m.groupdict()) for name, pattern in _KNOWN if (m := pattern.fullmatch(line))), None)


def identified(text: str) -> list[tuple[int, str, dict, int, int]]:
    """(number of the sentence, identifier, what the pattern read, start, end) of the known sentences, in order.

    A sentence that isn't known is tried again in its parts between semicolons, since some notices join two sentences by
    one while others have one inside, and such a part line by line, since headings and notices often end without a mark.
    """
    if not _HINT.search(text):
        return []
    out, k = [], 0
    for a, b in sentences(text):
        k += 1
        if known := _recognised(text, a, b):
            out.append((k, *known, a, b))
        elif _HINT.search(text, a, b):
            for c, d in sentences(text, _PART, a, b):
                k += 1
                if (c, d) != (a, b) and (known := _recognised(text, c, d)):
                    out.append((k, *known, c, d))
                elif _HINT.search(text, c, d):
                    for x, y in sentences(text, _LINE, c, d):
                        k += 1
                        if (x, y) != (c, d) and (known := _recognised(text, x, y)):
                            out.append((k, *known, x, y))
    return out


def _named(rule: Rule, read: dict) -> str:
    version = (read.get("version") or "").replace(" ", ".")
    if rule.licence == "GPL":
        kind = {"lesser": "LGPL", "library": "LGPL", "affero": "AGPL"}.get((read.get("kind") or "").strip(), "GPL")
        version = version + ".0" if version and "." not in version else version
        return kind + (f"-{version}" + ("-or-later" if read.get("later") else "-only") if version else "")
    if rule.licence == "BSD" and (n := read.get("clauses") or read.get("clauses2")):
        return f"{n}BSD" if n == "0" else f"BSD-{n}-Clause"
    if rule.licence == "CC":
        parts = read["parts"].replace("-", " ").replace("attribution", "by").replace("non commercial", "nc").replace("noncommercial", "nc").replace("share alike", "sa").replace("sharealike", "sa").replace("no derivatives", "nd").replace("noderivatives", "nd").replace("noderivs", "nd")
        return "-".join(["CC", *parts.upper().split(), *([version] if version else [])])
    if rule.licence in ("MPL", "EPL"):
        return f"{rule.licence}-{version}"
    if rule.licence == "NAMED":
        name = NAMES[read["name"]]
        return f"{name}-{version}" if version and "-" not in name else name
    if rule.licence == "SPDX":
        return "SPDX:" + read["id"].strip().replace(" ", "-")
    return rule.licence


def match(found: list[tuple[int, str, dict, int, int]], gap: int = 3, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(licence, start, end) of each rule matched, in order of text. Sentences serve one match; a rule takes the earliest that fit."""
    used, out = set(), []
    where: dict[str, list[int]] = {}
    for i, x in enumerate(found):
        where.setdefault(x[1], []).append(i)
    for rule in sorted(rules, key=lambda r: -len(r.sentences)):
        for first in where.get(rule.sentences[0], ()):
            if first in used:
                continue
            chain = [first]
            for name in rule.sentences[1:]:
                last = chain[-1]
                nxt = next((i for i in range(last + 1, min(len(found), last + 2 + gap)) if i not in used and found[i][1] == name and found[i][0] - found[last][0] <= gap + 1), None)
                if nxt is None:
                    break
                chain.append(nxt)
            else:
                used.update(chain)
                out.append((_named(rule, found[first][2]), found[first][3], found[chain[-1]][4]))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def _scan(gap: int):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known, hits = [], []
            for text in b.column("text"):
                found = identified(text.as_py() or "")
                known.append([x[1] for x in found])
                hits.append([{"licence": n, "start": a, "end": e} for n, a, e in match(found, gap)])
            kind = pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(known, pa.list_(pa.string())), pa.array(hits, kind)], ["doc_id", "sentences", "matches"])

    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = 3) -> DataFrame:
    """For each row of docs: doc_id, sentences (identifiers of its known sentences in order), matches (licence, start, end in code points) and licences (distinct, sorted).

    Null and empty texts have none. Repeated rows are scanned alike; an empty table gives an empty result; further columns are ignored.
    """
    rows = picked(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(_scan(gap), "doc_id long, sentences array<string>, matches array<struct<licence:string,start:long,end:long>>")
    return out.withColumn("licences", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"]))))
