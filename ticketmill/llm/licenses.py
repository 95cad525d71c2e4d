"""License scans by patience alignment (operator 5).

A template and a text are aligned by the words that are unique to both: the longest
increasing subsequence of their places anchors the alignment, equal words at both ends are
matched, and each gap between anchors is aligned the same way. Coverage is the share of the
template's words that are matched.

In a long text the places of the template's words are searched first for stretches that
hold enough of them, a necessary condition for the coverage asked for. A license that a text
holds several times is found each time. A finding ends at ``STRETCH`` times the words of its
template, so a license that foreign words draw out further is lost.

Coverage alone would take a sibling for a license, as names and versions are few words. So
the words of ``NAMES`` must all be aligned, with none but ``HARMLESS`` words between them.

Of findings that overlap, the one with more matched words stays, then the tighter one, then
the first template.

Defined results: null and empty texts have no finding. Repeated rows give their findings
each. Words are runs of letters and digits, lower-cased, ``v3`` counts as ``3``. Other columns
are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from ticketmill.llm.common import arrow_map, as_texts, id_and_text

MIN_COVERAGE = 0.8
# A finding spans at most so many times the words of its template.
STRETCH = 1.5

# --- fixed values -----------------------------------------------------------
_SHARED_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_SHARED_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so"
)
_MIT_NOTICE = (
    ", subject to the following conditions: The above copyright notice and this permission notice shall be included in "
    "all copies or substantial portions of the Software."
)
_MIT_END = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_VERBATIM = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_FSF_STREET = "Free Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA "
_FSF_SITE = "Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> "
# Notices of widely used licenses, in their usual wording; whole texts of the short ones (``-text``) and the opening of
# the long ones (``-opening``).
TEMPLATES = {
    "0bsd-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted. " + _ISC_END
    ),
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "agpl-3.0-opening": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software "
    "Foundation, Inc. <https://fsf.org/> " + _VERBATIM,
    "apache-2.0-opening": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION"
    ),
    "bsd-2-clause": "Released under the BSD 2-Clause License",
    "bsd-2-clause-text": _SHARED_BSD_START + _SHARED_BSD_END,
    "bsd-3-clause-text": (
        _SHARED_BSD_START + "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. "
        + _SHARED_BSD_END
    ),
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0",
    "cc0-1.0-opening": (
        "CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES. "
        "DISTRIBUTION OF THIS DOCUMENT DOES NOT CREATE AN ATTORNEY-CLIENT RELATIONSHIP."
    ),
    "epl-2.0-opening": (
        "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE "
        '("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT\'S ACCEPTANCE OF THIS '
        "AGREEMENT."
    ),
    "gpl-2.0-opening": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 " + _FSF_STREET + _VERBATIM,
    "gpl-3.0-opening": "GNU GENERAL PUBLIC LICENSE " + _FSF_SITE + _VERBATIM,
    "isc": "Released under the ISC License",
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_END
    ),
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "lgpl-2.1-opening": (
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 " + _FSF_STREET + _VERBATIM
    ),
    "lgpl-3.0-opening": "GNU LESSER GENERAL PUBLIC LICENSE " + _FSF_SITE + _VERBATIM,
    "mit-0-text": _MIT_GRANT + ". " + _MIT_END,
    "mit-full-text": _MIT_GRANT + _MIT_NOTICE + " " + _MIT_END,
    "mpl-2.0-opening": (
        'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that '
        "creates, contributes to the creation of, or owns Covered Software."
    ),
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
        "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        'this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
        "be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. This notice may not be removed or altered from any source "
        "distribution."
    ),
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License."
    ),
    "bsd-3-clause": "Released under the BSD 3-Clause License",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}
# What tells a template from its siblings: phrases of the template.
NAMES = {
    "0bsd-text": ("is hereby granted. THE SOFTWARE IS PROVIDED",),
    "agpl-3.0": ("GNU Affero General Public License, version 3",),
    "agpl-3.0-opening": ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3",),
    "apache-2.0-opening": ("Apache License Version 2.0",),
    "bsd-2-clause": ("BSD 2-Clause License",),
    "bsd-2-clause-text": (
        "are permitted provided that the following conditions",
        "provided with the distribution. THIS SOFTWARE IS PROVIDED BY",
    ),
    "bsd-3-clause-text": (
        "are permitted provided that the following conditions",
        "provided with the distribution. Neither the name of",
        "may be used to endorse or promote products derived from this software",
        "specific prior written permission. THIS SOFTWARE IS PROVIDED BY",
    ),
    "cc-by-nc-nd-4.0": ("CC BY-NC-ND 4.0",),
    "cc-by-nc-sa-4.0": ("CC BY-NC-SA 4.0",),
    "cc-by-nd-4.0": ("CC BY-ND 4.0",),
    "cc0-1.0-opening": ("CC0 1.0 Universal",),
    "epl-2.0-opening": ("Eclipse Public License - v 2.0",),
    "gpl-2.0-opening": ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991",),
    "gpl-3.0-opening": ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "isc": ("ISC License",),
    "isc-text": ("provided that the above copyright notice and this permission notice appear in all copies",),
    "lgpl-2.1": ("GNU Lesser General Public License, version 2.1",),
    "lgpl-2.1-opening": ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1",),
    "lgpl-3.0-opening": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "mit-0-text": ("is furnished to do so. THE SOFTWARE IS PROVIDED",),
    "mit-full-text": (
        "is furnished to do so, subject to the following conditions",
        "portions of the Software. THE SOFTWARE IS PROVIDED",
    ),
    "mpl-2.0-opening": ("Mozilla Public License Version 2.0",),
    "apache-2.0": ("Apache License, Version 2.0",),
    "apache-2.0-header": ("Apache License, Version 2.0",),
    "bsd-3-clause": ("BSD 3-Clause License",),
    "cc-by-4.0": ("CC BY 4.0",),
    "cc-by-nc-4.0": ("CC BY-NC 4.0",),
    "cc-by-sa-4.0": ("CC BY-SA 4.0",),
    "gpl-2.0": ("GNU General Public License, version 2",),
    "gpl-3.0": ("GNU General Public License, version 3",),
    "gpl-3.0-header": ("GNU General Public License as published by the Free Software Foundation, either version 3",),
    "lgpl-3.0": ("GNU Lesser General Public License, version 3",),
    "mit": ("MIT License",),
    "mpl-2.0": ("Mozilla Public License, v. 2.0",),
}
# Words that names are written with or without.
HARMLESS = frozenset(
    "license licence version v the new or revised software open source gpl lgpl agpl mpl as published by free foundation "
    "either".split()
)
# Numbers that the clauses of a whole text may have.
ENUMERATORS = frozenset("1 2 3 4 a b c d i ii iii iv".split())
# ----------------------------------------------------------------------------

_WORD = re.compile(r"[^\W_]+")
_VERSION = re.compile(r"^v(?=[0-9]+$)")


def words_of(text: str) -> list[str]:
    return [_VERSION.sub("", word) for word in _WORD.findall(text.lower())]


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    top_at: list[int] = []
    before = [-1] * len(values)
    for at, value in enumerate(values):
        pile = bisect_left(tops, value)
        before[at] = top_at[pile - 1] if pile else -1
        tops[pile : pile + 1] = [value]
        top_at[pile : pile + 1] = [at]
    chain = []
    at = top_at[-1] if top_at else -1
    while at >= 0:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def patience_pairs(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched places (text, template), both ascending."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {word: at for at, word in enumerate(text[a:b], a) if in_text[word] == 1}
        shared = [(place[word], at) for at, word in enumerate(template[c:d], c) if in_template[word] == 1 and word in place]
        anchors = [shared[at] for at in longest_increasing([one for one, _ in shared])]
        pairs += anchors
        if anchors:
            borders = [(a - 1, c - 1), *anchors, (b, d)]
            gaps += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(borders, borders[1:])]
    return sorted(pairs)


def _place(phrase: list[str], template: list[str]) -> range:
    """Where a phrase stands first in its template."""
    at = next(at for at in range(len(template)) if template[at : at + len(phrase)] == phrase)
    return range(at, at + len(phrase))


class Scanner:
    """Finds templates in texts."""

    def __init__(
        self,
        templates: Mapping[str, str] = TEMPLATES,
        min_coverage: float = MIN_COVERAGE,
        names: Mapping[str, tuple[str, ...]] | None = None,
    ):
        if names is None:  # other templates have other names
            names = NAMES if templates == TEMPLATES else {}
        self.templates = {name: words_of(text) for name, text in templates.items()}
        self.counts = {name: Counter(words) for name, words in self.templates.items()}
        self.needed = {name: -(-int(1000 * min_coverage) * len(words) // 1000) for name, words in self.templates.items()}
        self.names = {
            name: [_place(words_of(phrase), words) for phrase in names.get(name, ())]
            for name, words in self.templates.items()
        }
        self.vocabulary = {word for words in self.templates.values() for word in words}

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """Findings by place: template, coverage, first word, end, matched words."""
        words = words_of(text)
        present = self.vocabulary.intersection(words)
        found = []
        for name, counts in self.counts.items():
            if sum(count for word, count in counts.items() if word in present) >= self.needed[name]:
                found += self._occurrences(name, words)
        found.sort(key=lambda one: (-one[4], one[3] - one[2], one[0], one[2]))
        chosen: list[tuple[str, float, int, int, int]] = []
        for one in found:
            if all(one[3] <= other[2] or other[3] <= one[2] for other in chosen):
                chosen.append(one)
        return sorted(chosen, key=lambda one: one[2])

    def _is_named(self, name: str, text: list[str], pairs: list[tuple[int, int]]) -> bool:
        """Whether the phrases of the template are aligned with no foreign word among them."""
        template = self.templates[name]
        place = {in_template: in_text for in_text, in_template in pairs}
        harmless = HARMLESS | ENUMERATORS if name.endswith("-text") else HARMLESS
        for phrase in self.names[name]:
            if any(at not in place and template[at] not in harmless for at in phrase):
                return False
            places = {place[at] for at in phrase if at in place}
            between = range(min(places), max(places))
            if any(at not in places and text[at] not in harmless for at in between):
                return False
        return True

    def _occurrences(self, name: str, words: list[str]) -> Iterator[tuple[str, float, int, int, int]]:
        template, counts, needed = self.templates[name], self.counts[name], self.needed[name]
        hits = [at for at, word in enumerate(words) if word in counts]
        widest = int(STRETCH * len(template)) + 1
        inside: Counter[str] = Counter()
        enough = low = floor = 0
        for high, at in enumerate(hits):
            word = words[at]
            inside[word] += 1
            enough += inside[word] <= counts[word]
            # Drop what is too far back, and what is there more often than needed.
            while low < high and (
                hits[low] < floor or hits[low] <= at - widest or inside[words[hits[low]]] > counts[words[hits[low]]]
            ):
                gone = words[hits[low]]
                inside[gone] -= 1
                enough -= inside[gone] < counts[gone]
                low += 1
            if enough < needed or hits[low] < floor:
                continue
            first, end = hits[low], min(len(words), hits[low] + widest)
            pairs = patience_pairs(words[first:end], template)
            if pairs and pairs[0][0]:  # a stray word before must not shorten the stretch at its end
                first += pairs[0][0]
                end = min(len(words), first + widest)
                pairs = patience_pairs(words[first:end], template)
            if len(pairs) >= needed and self._is_named(name, words[first:end], pairs):
                start, stop = first + pairs[0][0], first + pairs[-1][0] + 1
                yield name, len(pairs) / len(template), start, stop, len(pairs)
                floor = stop


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    min_coverage: float = MIN_COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_licenses, and the findings by place with first and end word."""
    kind = pa.list_(
        pa.struct(
            [
                ("license", pa.string()),
                ("coverage", pa.float64()),
                ("first_word", pa.int64()),
                ("end_word", pa.int64()),
                ("matched", pa.int64()),
            ]
        )
    )
    names = [field.name for field in kind.value_type]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, min_coverage)
        for batch in batches:
            found = [scanner.scan(text) for text in as_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(one) for one in found], pa.int64()),
                    pa.array([[dict(zip(names, finding)) for finding in one] for one in found], kind),
                ],
                names=["doc_id", "n_licenses", "findings"],
            )

    return arrow_map(
        id_and_text(docs, id_col, text_col),
        scan,
        "doc_id long, n_licenses long, findings array<struct<license: string, coverage: double, first_word: long, "
        "end_word: long, matched: long>>",
    )
