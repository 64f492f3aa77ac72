"""License scans by patience alignment.

Words that occur once in the text and once in the template are anchors; the longest
increasing run of them is kept; the gaps between anchors are aligned the same way, and equal words next to an
anchor join it.  A gap without anchors gets its longest common run.  Texts are aligned in regions that overlap so
far that every copy of a template lies whole in one.  A template's coverage is the share of its words that are aligned.  The phrases that name a licence must stand in the text whole, however much else is covered.
"""

import bisect
import math
import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from ratelake.llm.runtime import small_batches

#: Share of a template's words that must be aligned.
COVERAGE = 0.8
#: Words that may stand between a template's words, besides as many as the template has itself.
LEAST_ROOM = 8
#: Regions of a template start at most this part of it apart.
STEPS = 16

# Short notices and the beginnings of grants and headers, with their deciding phrases.
_NOTICES = {
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",
                 "GNU Affero General Public License", "version 3|License 3"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Apache License", "Version 2.0|License 2.0"),
    "Apache-2.0-header": ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                          "compliance with the License. You may obtain a copy of the License at "
                          "http://www.apache.org/licenses/LICENSE-2.0", "Apache License", "Version 2.0|License 2.0"),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "BSD 2-Clause License"),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "BSD 3-Clause License"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",
                "GNU General Public License", "version 2|License 2"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "GNU General Public License", "version 3|License 3"),
    "ISC": ("Released under the ISC License.", "ISC License"),
    "LGPL-2.1": ("This work is licensed under the GNU Lesser General Public License, version 2.1.",
                 "GNU Lesser General Public License", "version 2.1|License 2.1"),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",
                 "GNU Lesser General Public License", "version 3|License 3"),
    "MIT": ("Released under the MIT License.", "MIT License"),
    "MIT-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction",
                  "deal in the Software without restriction"),
    "MPL-2.0": ("Licensed under the Mozilla Public License, Version 2.0.", "Mozilla Public License", "Version 2.0|License 2.0"),
    "MPL-2.0-header": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                       "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
                       "Mozilla Public License v 2.0"),
}
for _mark, _name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                     ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                     ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    _NOTICES[f"CC-{_mark}-4.0"] = f"Licensed under CC {_mark} 4.0.", f"CC {_mark} 4.0"
    _NOTICES[f"CC-{_mark}-4.0-header"] = (f"This work is licensed under a Creative Commons {_name} 4.0 International License.",
                                          f"Creative Commons {_name} 4.0")
for _mark, _name, _version in (("AGPL-3.0", "Affero General", "3"), ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"),
                               ("LGPL-2.0", "Library General", "2"), ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3")):
    # With and without "any later version".
    _NOTICES[f"{_mark}-header"] = (
        "is free software you can redistribute it and/or modify it under the terms of the "
        f"GNU {_name} Public License as published by the Free Software Foundation, either version {_version} of the License",
        f"GNU {_name} Public License", f"version {_version}|License {_version}")

#: Deciding phrases of the whole texts in ``license_texts``, registered as ``<name>-text``.
_TEXTS = {
    "0BSD": ("with or without fee is hereby granted the software is provided",),
    "Apache-2.0": ("Apache License Version 2.0", "Submission of Contributions"),
    "Artistic-1.0": ("The Artistic License", "Standard Version"),
    "BSD-2-Clause": ("with the distribution this software is provided",),
    "BSD-3-Clause": ("|".join(f"with the distribution {k} {w}" for k in ("", "3", "c", "iii")
                              for w in ("neither the name", "neither the names", "the name", "the names")),),
    "BSD-4-Clause": ("advertising materials mentioning features or use",),
    "BSL-1.0": ("any person or organization obtaining a copy",),
    "CC-BY-SA-4.0": ("Attribution-ShareAlike 4.0 International",),
    "CC0-1.0": ("CC0 1.0 Universal",),
    "GFDL-1.2": ("GNU Free Documentation License Version 1.2",),
    "GFDL-1.3": ("GNU Free Documentation License Version 1.3",),
    "GPL-1.0": ("GNU General Public License Version 1",),
    "GPL-2.0": ("GNU General Public License Version 2",),
    "GPL-3.0": ("GNU General Public License Version 3",),
    "ISC": ("with or without fee is hereby granted provided that",),
    "LGPL-2.0": ("GNU Library General Public License Version 2",),
    "LGPL-2.1": ("GNU Lesser General Public License Version 2.1",),
    "LGPL-3.0": ("GNU Lesser General Public License Version 3",),
    "MIT": ("deal in the Software without restriction", "shall be included in all"),
    "MPL-1.1": ("Mozilla Public License Version 1.1",),
    "MPL-2.0": ("Mozilla Public License Version 2.0",),
    "NCSA": ("deal with the Software without restriction",),
    "OFL-1.1": ("SIL Open Font License Version 1.1",),
    "Unlicense": ("free and unencumbered software released into the public domain",),
    "Zlib": ("Altered source versions must be plainly marked",),
}
_FOLDER = Path(__file__).parent / "license_texts"

#: Common notices, headers and whole texts of licences.
TEMPLATES = {name: text for name, (text, *_) in _NOTICES.items()} | {
    f"{name}-text": (_FOLDER / f"{name}.txt").read_text("utf-8") for name in _TEXTS}
#: Phrases of a template that name its licence: each must stand in the text word by word, its last word aligned.  ``|`` parts
#: wordings of which one is enough.
DECIDING = {name: tuple(phrases) for name, (_, *phrases) in _NOTICES.items()} | {
    f"{name}-text": phrases for name, phrases in _TEXTS.items()}
FOUND = "doc_id long, license string, coverage double, n_matched long, first_word long, last_word long, n_words long"


def words_of(text):
    return re.findall(r"[a-z0-9]+(?:[.'-][a-z0-9]+)*", text.lower())


def increasing(pairs):
    """The longest run of (text place, template place), sorted by the first, that rises in the second: patience piles."""
    tops, at, back = [], [], []
    for i, (_, b) in enumerate(pairs):
        pile = bisect.bisect_left(tops, b)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            at.append(i)
        elif b < tops[pile]:
            tops[pile], at[pile] = b, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(text, template):
    """Aligned places (text, template) in order.

    A gap without a word that is unique on both sides gets its longest common run of words.
    """
    out, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        here, there = {}, {}
        for j in range(c, d):
            there.setdefault(template[j], []).append(j)
        for i in range(a, b):
            if text[i] in there:
                here.setdefault(text[i], []).append(i)
        anchors = increasing(sorted((p[0], there[w][0]) for w, p in here.items() if len(p) == 1 and len(there[w]) == 1))
        if not anchors:
            # Template places of a text place in falling order, so that each joins a run once.
            out += increasing([(i, j) for i in range(a, b) for j in reversed(there.get(text[i], ()))])
            continue
        for (i, j), (k, m) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]):
            # The gap in front of each anchor, and the anchor itself.
            todo.append((i + 1, k, j + 1, m))
        out += anchors
    return sorted(out)


def regions(places, words, template, need):
    """Ranges of ``places`` (where ``words`` has words of the template) that may cover ``need`` words of it.

    A copy with its inserted words spans at most the template and room for as many words again (``LEAST_ROOM`` at
    least).  Regions start at places that hold a word of the template, a sixteenth of a template apart at most, and are
    longer by that step, so each such copy lies whole in one of them wherever it stands.
    """
    size = len(template)
    step = max(1, size // STEPS)
    length = size + max(size, LEAST_ROOM) + step - 1
    left, shared, a, b, last = Counter(template), 0, 0, 0, None
    for k, first in enumerate(places):
        if last is not None and first < last + step:
            continue
        last = first
        for i in range(a, k):
            left[words[places[i]]] += 1
            shared -= left[words[places[i]]] > 0
        a = k
        while b < len(places) and places[b] < first + length:
            shared += left[words[places[b]]] > 0
            left[words[places[b]]] -= 1
            b += 1
        if shared >= need:
            yield a, b


def tightened(found, where, words):
    """The alignment with its words drawn to the middle one: each as near to its inner neighbour as the text allows."""
    out, middle = list(found), len(found) // 2
    for k in range(middle - 1, -1, -1):
        at = where[words[out[k][0]]]
        out[k] = at[bisect.bisect_left(at, out[k + 1][0]) - 1], out[k][1]
    for k in range(middle + 1, len(out)):
        at = where[words[out[k][0]]]
        out[k] = at[bisect.bisect_right(at, out[k - 1][0])], out[k][1]
    return out


def decided(found, words, deciding):
    """Whether each deciding phrase, in one of its wordings, stands whole in the text where the alignment is."""
    return all(any(words[i - len(phrase) + 1:i + 1] == phrase for phrase in wordings for i, _ in found
                   if words[i] == phrase[-1] and i >= len(phrase) - 1) for wordings in deciding)


def best_alignment(words, template, need, deciding=()):
    """The alignment of the most words, and of those the shortest, then the first.

    Empty below ``need`` words or without the deciding phrases, lists of wordings in words.
    """
    where = {w: [] for w in template}
    for i, w in enumerate(words):
        if w in where:
            where[w].append(i)
    places = sorted(i for at in where.values() for i in at)
    best, rank = [], (0, 0)
    for a, b in regions(places, words, template, need):
        region = places[a:b]
        found = align([words[i] for i in region], template)
        if len(found) < max(need, rank[0]):
            continue
        found = tightened([(region[i], j) for i, j in found], where, words)
        now = len(found), found[0][0] - found[-1][0]
        if now > rank and decided(found, words, deciding):
            best, rank = found, now
            if len(found) == len(template) == found[-1][0] - found[0][0] + 1:
                break
    return best


def scan(templates, least, words_of, best_alignment, deciding):
    """Task body: the templates that each text covers."""

    def body(batches):
        known = {name: words_of(t) for name, t in sorted(templates.items())}
        phrases = {name: [[words_of(w) for w in p.split("|")] for p in deciding.get(name, ())] for name in known}
        counts = {name: Counter(t) for name, t in known.items()}
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text or "")
                present = set(words)
                for name, template in known.items():
                    if not all(any(present.issuperset(w) for w in wordings) for wordings in phrases[name]):
                        continue
                    need = max(1, math.ceil(least * len(template) - 1e-9))
                    if not template or sum(n for w, n in counts[name].items() if w in present) < need:
                        continue
                    found = best_alignment(words, template, need, phrases[name])
                    if found:
                        rows.append((doc, name, len(found) / len(template), len(found), found[0][0], found[-1][0], len(words)))
            kind = (pa.int64(), pa.string(), pa.float64(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kind)],
                names=["doc_id", "license", "coverage", "n_matched", "first_word", "last_word", "n_words"])

    return body


def scan_licenses(docs: DataFrame, templates: dict = TEMPLATES, coverage: float = COVERAGE,
                  deciding: dict | None = None) -> DataFrame:
    """One row for each document and template that it covers, with the place of the first best alignment.

    Words are runs of letters and digits in lower case.  Others may stand between those of a template, as many as it
    has itself.  Null and empty texts cover nothing; repeated rows are scanned each; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    if deciding is None:
        deciding = DECIDING if templates is TEMPLATES else {}
    return small_batches(docs.select("doc_id", "text")).mapInArrow(
        scan(templates, coverage, words_of, best_alignment, deciding), FOUND)
