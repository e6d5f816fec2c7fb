"""License scans: winnowed fingerprints of templates, then banded sequence alignment.

Texts and templates are sequences of words: runs of letters and digits in lower
case. Hashes of neighbouring words of each template are winnowed - of each
window of them the smallest is kept - into an inverted index; a short notice
keeps at least one. A text is looked up in it at all its places, so a shared
stretch of window plus gram length can't pass unseen. Hits near each other in
text and diagonal make a candidate, whose stretch of the text is aligned with
the template, within a band, by words; matched words over the template's words
are the coverage, and the first and last matched word give the span. Words between
are free, but not inside the phrases that name a license (``NAMING``): without
"version 3" or "GNU General Public License" in one piece it is another one.

Templates are few and bounded (``TEMPLATE_WORDS``); the index goes to the tasks.

Results are defined as follows. A null or empty text holds no license. Of
overlapping spans the one that covers more matched words stays, then the one of
the higher coverage, then the first template by name. Spans are in code points,
end exclusive. Templates without a word are refused. Equal rows give equal rows.
"""

from __future__ import annotations

import re
from bisect import bisect
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from orderflow.llm.common import map_texts

#: Words per gram and grams per winnowing window.
GRAM = 3
WINDOW = 4
#: Words that a text may have added or left out, in all, at most: a band's half width. Shorter
#: templates may drift by a quarter of their words.
DRIFT = 12
#: Matched words over the template's words that a license needs. A template of fewer than
#: ``SHORT`` words must be there whole, as "released under the ... license" says nothing.
LEAST_COVERAGE = 0.8
SHORT = 10
#: Words of all templates together.
TEMPLATE_WORDS = 200_000

_WORD = re.compile(r"[^\W_]+")

# Texts of public licenses and of the notices that name them.
_WARRANTY = (
    " in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
    " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
)
_GNU_NOTICE = (
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of the"
    " {name} as published by the Free Software Foundation, either version {version} of the License, or (at"
    " your option) any later version. This {thing} is distributed" + _WARRANTY
)
_GNU_ONLY_NOTICE = (
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of the"
    " {name} version {version} as published by the Free Software Foundation. This {thing} is distributed"
    + _WARRANTY
)
_GNU = {
    "gpl-2.0": ("program", "GNU General Public License", "2"),
    "gpl-3.0": ("program", "GNU General Public License", "3"),
    "lgpl-2.1": ("library", "GNU Lesser General Public License", "2.1"),
    "lgpl-3.0": ("program", "GNU Lesser General Public License", "3"),
    "agpl-3.0": ("program", "GNU Affero General Public License", "3"),
}
_BSD_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met: 1. Redistributions of source code must retain"
    " the above copyright notice, this list of conditions and the following disclaimer. 2."
    " Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided"
    " with the distribution. "
)
_BSD_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following"
    " acknowledgement: This product includes software developed by the organization. "
)
_BSD_ENDORSEMENT = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
    " promote products derived from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR"
    " IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND"
    " FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR"
    " CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL"
    " DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,"
    " DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER"
    " IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT"
    " OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_CC = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nc": "Attribution-NonCommercial",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
_CC_NOTICES = {"3.0": "3.0 Unported", "4.0": "4.0 International"}

TEMPLATES = {
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
        " writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License."
    ),
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-line-plain": "Licensed under the Apache License 2.0.",
    "apache-2.0-line-short": "Licensed under Apache 2.0.",
    "apache-2.0-line-released": "Released under the Apache License, Version 2.0.",
    "apache-2.0-line-released-plain": "Released under the Apache License 2.0.",
    "bsd-2-clause": _BSD_CLAUSES + _BSD_DISCLAIMER,
    "bsd-3-clause": _BSD_CLAUSES + "3. " + _BSD_ENDORSEMENT + _BSD_DISCLAIMER,
    "bsd-4-clause": _BSD_CLAUSES + _BSD_ADVERTISING + "4. " + _BSD_ENDORSEMENT + _BSD_DISCLAIMER,
    "apache-2.0-line-tag": "under the Apache-2.0 license",
    **{f"cc-{kind}-{v}-line": f"Licensed under CC {kind.upper()} {v}." for kind in _CC for v in _CC_VERSIONS},
    **{
        f"cc-{kind}-{v}-notice": f"This work is licensed under a Creative Commons {name} {rest} License."
        for kind, name in _CC.items()
        for v, rest in _CC_NOTICES.items()
    },
    "cc0-1.0-line": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    **{
        f"{key}-notice": _GNU_NOTICE.format(thing=thing, name=name, version=version)
        for key, (thing, name, version) in _GNU.items()
    },
    **{
        f"{key}-only-notice": _GNU_ONLY_NOTICE.format(thing=thing, name=name, version=version)
        for key, (thing, name, version) in _GNU.items()
    },
    **{f"{key}-name": f"{name} v{version}" + ".0" * (version in "23") for key, (_, name, version) in _GNU.items()},
    **{f"{key}-line-tag": f"Licensed under {key.split('-')[0]}v{version}" for key, (_, _, version) in _GNU.items()},
    "mit-line-is": "is MIT licensed",
    **{
        f"{key}-line": f"This work is licensed under the {name}, version {version}."
        for key, (_, name, version) in _GNU.items()
    },
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
        " fee is hereby granted, provided that the above copyright notice and this permission notice"
        " appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES"
        " WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN"
        " NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES"
        " OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF"
        " CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
        " PERFORMANCE OF THIS SOFTWARE."
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the \"Software\"), to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
        " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions: The above copyright"
        " notice and this permission notice shall be included in all copies or substantial portions of"
        " the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR"
        " IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
        " PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE"
        " LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
        " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS"
        " IN THE SOFTWARE."
    ),
    "mit-line": "Released under the MIT License.",
    "mit-line-licensed": "Licensed under the MIT License.",
    "mit-line-distributed": "Distributed under the MIT License.",
    "mit-line-available": "Available under the MIT License.",
    "mit-line-short": "Licensed under MIT.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy"
        " of the MPL was not distributed with this file, You can obtain one at"
        " https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy,"
        " modify, publish, use, compile, sell, or distribute this software, either in source code form or"
        " as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In"
        " jurisdictions that recognize copyright laws, the author or authors of this software dedicate any"
        " and all copyright interest in the software to the public domain. We make this dedication for the"
        " benefit of the public at large and to the detriment of our heirs and successors. We intend this"
        " dedication to be an overt act of relinquishment in perpetuity of all present and future rights to"
        " this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY"
        " KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS"
        " FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY"
        " CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING"
        " FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    # What follows its colon is an expression of licenses, see ``expression``.
    "spdx": "SPDX-License-Identifier",
}

# The same without what follows the grant, as it is often quoted; the whole text counts more words.
for _name, _rest in (("mit", "THE SOFTWARE IS"), ("isc", "THE SOFTWARE IS"), ("unlicense", "In jurisdictions")):
    TEMPLATES[f"{_name}-grant"] = TEMPLATES[_name].split(f" {_rest}")[0]
for _name in ("bsd-2-clause", "bsd-3-clause"):
    TEMPLATES[f"{_name}-conditions"] = TEMPLATES[_name].removesuffix(_BSD_DISCLAIMER)

#: Phrases that tell a template from its neighbours: its span must have each of them in one stretch.
NAMING = {
    **{f"{key}-notice": (name, f"version {version} of") for key, (_, name, version) in _GNU.items()},
    **{f"{key}-only-notice": (f"{name} version {version} as",) for key, (_, name, version) in _GNU.items()},
    **{f"{key}-line": (name, f"version {version}") for key, (_, name, version) in _GNU.items()},
    **{f"{key}-name": (TEMPLATES[f"{key}-name"],) for key in _GNU},
    **{f"{key}-line-tag": (TEMPLATES[f"{key}-line-tag"],) for key in _GNU},
    **{f"cc-{kind}-{v}-line": (f"CC {kind} {v}",) for kind in _CC for v in _CC_VERSIONS},
    **{f"cc-{kind}-{v}-notice": (f"Creative Commons {name} {v}",) for kind, name in _CC.items() for v in _CC_NOTICES},
    "spdx": (TEMPLATES["spdx"],),
    **{name: ("MIT License",) for name in TEMPLATES if name.startswith("mit-line")},
    "mit-line-is": (TEMPLATES["mit-line-is"],),
    **{name: ("Apache License",) for name in TEMPLATES if name.startswith("apache-")},
    "mit-line-short": ("under MIT",),
    "apache-2.0-line-short": ("under Apache 2.0",),
    "apache-2.0-line-tag": (TEMPLATES["apache-2.0-line-tag"],),
    "apache-2.0-notice": ("Apache License, Version 2.0",),
    "bsd-3-clause": ("endorse or promote",),
    "bsd-3-clause-conditions": ("endorse or promote",),
    "bsd-4-clause": ("advertising materials", "endorse or promote"),
    "mpl-2.0-notice": ("Mozilla Public License, v. 2.0",),
}


@dataclass
class Match:
    license: str
    start: int
    end: int
    matched: int
    coverage: float


_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.:-]*\+?)")


def expression(text: str, at: int) -> list[tuple[str, int, int]]:
    """Licenses of the SPDX expression that begins there: name, start and end of each.

    ``AND``, ``OR`` and ``WITH`` join whole identifiers, with parentheses or
    without. An identifier need not be known, but must have a capital or a
    digit, as words of a sentence mostly don't. An exception belongs to the name
    of its license, and the plus of a GNU license is "or later".
    """
    found: list[tuple[str, int, int]] = []
    operand = True
    while token := _TOKEN.match(text, at):
        word, start = token[1], token.start(1)
        if not operand and word in ("AND", "OR", "WITH"):
            operand, exception, after = True, word == "WITH", token.end()
        elif operand and word not in ("AND", "OR", "WITH", ")") and (word == "(" or re.search("[A-Z0-9]", word)):
            after = token.end()
            if word != "(":
                name = word if word.endswith("+") else word.rstrip(".:-")
                after -= len(word) - len(name)
                operand = False
                if found and exception:
                    license, start, _ = found.pop()
                    found.append((f"{license}-with-{name.lower()}", start, after))
                else:
                    name = name.lower()
                    later = name.endswith("+") and name[:-1] in _GNU
                    found.append((f"spdx-{name[:-1]}-or-later" if later else f"spdx-{name}", start, after))
                exception = False
        elif not operand and word == ")":
            after = token.end()
        else:
            break
        at = after
    return found


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places kept by winnowing: of each window the smallest hash, the last among equals."""
    count = len(hashes)
    if not count:
        return np.empty(0, dtype=np.int64)
    window = min(window, count)
    views = np.lib.stride_tricks.sliding_window_view(hashes[::-1], window)
    return np.unique(count - 1 - (np.argmin(views, axis=1) + np.arange(len(views))))


class TemplateIndex:
    """Templates as word numbers, and the winnowed grams of each."""

    def __init__(
        self,
        templates: dict[str, str],
        least: float = LEAST_COVERAGE,
        naming: dict[str, tuple[str, ...]] = NAMING,
    ):
        self.names = sorted(templates)
        split = [list(map(str.lower, _WORD.findall(templates[name]))) for name in self.names]
        if not all(split):
            raise ValueError("a template has no word")
        if sum(map(len, split)) > TEMPLATE_WORDS:
            raise ValueError("the templates exceed their bound")
        # Word 0 is any word that no template has.
        self.words = {w: i for i, w in enumerate(sorted(set().union(*split)), 1)}
        self.codes = [np.array([self.words[w] for w in words], dtype=np.int64) for words in split]
        self.naming = [
            [" ".join(["", *map(str.lower, _WORD.findall(phrase)), ""]) for phrase in naming.get(name, ())]
            for name in self.names
        ]
        lengths = np.array(list(map(len, self.codes)), dtype=np.int64)
        self.drift = np.clip(lengths // 4, 1, DRIFT)
        self.needed = np.where(lengths < SHORT, lengths, np.ceil(least * lengths - 1e-9)).astype(np.int64)
        entries = []
        for number, codes in enumerate(self.codes):
            size = min(GRAM, len(codes))
            grams = self._grams(codes, size)
            mixed = (grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)
            entries += [(size, int(grams[p]), number, int(p)) for p in winnow(mixed)]
        self.tables = {}
        for size in {e[0] for e in entries}:
            own = sorted(e[1:] for e in entries if e[0] == size)
            self.tables[size] = tuple(np.array(c, dtype=np.int64) for c in zip(*own))

    def _grams(self, codes: np.ndarray, size: int) -> np.ndarray:
        """Neighbouring words as one number each; -1 where a word is none of the templates'."""
        count = max(0, len(codes) - size + 1)
        grams, known = np.zeros(count, dtype=np.int64), np.ones(count, dtype=bool)
        for i in range(size):
            part = codes[i : i + count]
            grams = grams * (len(self.words) + 1) + part
            known &= part > 0
        return np.where(known, grams, -1)

    def search(self, text: str | None) -> list[Match]:
        """Licenses in a text."""
        if not text:
            return []
        words = list(map(str.lower, _WORD.findall(text)))
        numbers = self.words
        codes = np.fromiter((numbers.get(w, 0) for w in words), dtype=np.int64, count=len(words))
        if not np.any(codes):
            return []
        found = []
        for template, low, high in self._candidates(codes):
            aligned = self._align(codes, self.codes[template], low, high, int(self.drift[template]))
            if aligned and aligned[2] >= self.needed[template] and self._named(words, template, *aligned[:2]):
                found.append((template, *aligned))
        if not found:
            return []
        return self._settled(text, found)

    def _named(self, words: list[str], template: int, first: int, last: int) -> bool:
        """Whether the naming phrases of the template stand in the stretch, each in one piece."""
        if not self.naming[template]:
            return True
        stretch = " ".join(["", *words[first : last + 1], ""])
        return all(phrase in stretch for phrase in self.naming[template])

    def _candidates(self, codes: np.ndarray):
        """Template and diagonals of each cluster of hits."""
        for size, (grams, templates, places) in self.tables.items():
            own = self._grams(codes, size)
            at = np.flatnonzero(own >= 0)
            low, high = np.searchsorted(grams, own[at], "left"), np.searchsorted(grams, own[at], "right")
            times = high - low
            total = int(times.sum())
            if not total:
                continue
            entry = np.repeat(low, times) + np.arange(total) - np.repeat(np.cumsum(times) - times, times)
            template, diagonal = templates[entry], np.repeat(at, times) - places[entry]
            order = np.lexsort((diagonal, template))
            template, diagonal = template[order], diagonal[order]
            # Hits further apart than words may drift are other candidates.
            fresh = np.append(True, (np.diff(template) != 0) | (np.diff(diagonal) > self.drift[template[1:]]))
            edges = np.append(np.flatnonzero(fresh), total)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                # A long chain of hits, as repeats make, is aligned in overlapping bands.
                step = 2 * int(self.drift[template[a]])
                for start in range(int(diagonal[a]), int(diagonal[b - 1]) + 1, step):
                    yield int(template[a]), start, min(start + step, int(diagonal[b - 1]))

    @staticmethod
    def _align(codes: np.ndarray, template: np.ndarray, low: int, high: int, drift: int):
        """First and last matched word of the text, and the words matched in order, within the band."""
        low, high = low - drift, high + drift
        width = high - low + 1
        padded = np.full(width + len(template), -1, dtype=np.int64)
        a, b = max(low, 0), min(low + len(padded), len(codes))
        if b <= a:
            return None
        padded[a - low : b - low] = codes[a:b]
        score = np.zeros((len(template) + 1, width + 1), dtype=np.int64)
        for i, word in enumerate(template, 1):
            same = padded[i - 1 : i - 1 + width] == word
            # Along the diagonal a match; from the next diagonal a template word is left out;
            # from the one before, a word of the text.
            best = np.maximum(score[i - 1, :width] + same, score[i - 1, 1:])
            score[i, :width] = np.maximum.accumulate(best)
        matched = int(score[-1, :width].max())
        if not matched:
            return None
        d, first, last = int(np.argmax(score[-1, :width])), None, None
        i = len(template)
        while i and score[i, d]:
            # From the earliest end, each match as late as can be: the shortest span.
            if padded[i - 1 + d] == template[i - 1] and score[i - 1, d] + 1 == score[i, d]:
                first = low + i - 1 + d
                last = first if last is None else last
                i -= 1
            elif score[i - 1, d + 1] == score[i, d]:
                i, d = i - 1, d + 1
            else:
                d -= 1
        return first, last, matched

    @staticmethod
    def _expressed(text: str, tag: Match) -> list[Match]:
        """Every license of a tag's expression, the first from the tag on."""
        colon = re.compile("[ \t]*:").match(text, tag.end) if tag.license == "spdx" else None
        licenses = expression(text, colon.end()) if colon else []
        starts = [tag.start, *[start for _, start, _ in licenses[1:]]]
        words = lambda a, b: len(_WORD.findall(text[a:b]))
        return [
            Match(name, start, end, words(start, end), 1.0) for start, (name, _, end) in zip(starts, licenses)
        ]

    def _settled(self, text: str, found: list[tuple]) -> list[Match]:
        """Spans that don't overlap, those of more matched words first."""
        spans = [m.span() for m in _WORD.finditer(text)]
        kept, result = [], []
        order = sorted(set(found), key=lambda f: (-f[3], -f[3] / len(self.codes[f[0]]), f[0], f[1], f[2]))
        for template, first, last, matched in order:
            at = bisect(kept, (first, last))
            if (at and kept[at - 1][1] >= first) or (at < len(kept) and kept[at][0] <= last):
                continue
            kept.insert(at, (first, last))
            coverage = matched / len(self.codes[template])
            match = Match(self.names[template], spans[first][0], spans[last][1], matched, coverage)
            result += self._expressed(text, match) or [match]
        return sorted(result, key=lambda m: m.start)


MATCHES = ArrayType(
    StructType(
        [
            StructField("license", StringType()),
            StructField("start", LongType()),
            StructField("end", LongType()),
            StructField("matched", LongType()),
            StructField("coverage", DoubleType()),
        ]
    )
)


def scan_licenses(
    df: DataFrame,
    id_col: str,
    text_col: str,
    templates: dict[str, str] | None = None,
    least_coverage: float = LEAST_COVERAGE,
) -> DataFrame:
    """Every row's id and the ``licenses`` of its text: name, span, matched words, coverage."""
    index = TemplateIndex(templates or TEMPLATES, least_coverage)
    sent = df.sparkSession.sparkContext.broadcast(index)

    def start():
        search = sent.value.search
        return lambda texts: [[[vars(m) for m in search(t)] for t in texts]]

    return map_texts(df, id_col, text_col, [StructField("licenses", MATCHES)], start)
