from __future__ import annotations

import random
import re

import numpy as np
import pytest

from orderflow.llm.common import pick
from orderflow.llm.licenses import GRAM, TEMPLATES, WINDOW, TemplateIndex, scan_licenses, winnow
from orderflow.llm.queries import op2_license_scans

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\W_]+")


def words_of(text):
    return [w.lower() for w in WORD.findall(text or "")]


def common_in_order(a, b):
    """Length of the longest common subsequence, by the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        after = [0]
        for j, y in enumerate(b):
            after.append(row[j] + 1 if x == y else max(after[j], row[j + 1]))
        row = after
    return row[-1]


def test_winnowing_keeps_one_of_each_window():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 50):
        hashes = rng.integers(0, 9, n).astype(np.uint64)
        kept = set(winnow(hashes).tolist())
        for i in range(max(0, n - WINDOW + 1)):
            window = hashes[i : i + WINDOW]
            assert i + max(np.flatnonzero(window == window.min())) in kept
        assert (n > 0) == bool(kept)


def test_every_template_is_found_where_it_stands():
    index = TemplateIndex(TEMPLATES)
    for name, template in TEMPLATES.items():
        text = f"é🙂 Some words before. {template.upper()} and after"
        best = max(index.search(text), key=lambda m: m.matched)
        assert (best.license, best.coverage) == (name, 1.0)
        assert words_of(text[best.start : best.end]) == words_of(template)


def test_changed_notices_against_the_full_table():
    rng = random.Random(2)
    index = TemplateIndex(TEMPLATES)
    for name in ("mit", "gpl-3.0-notice", "bsd-2-clause"):
        words = words_of(TEMPLATES[name])
        for share in (0.0, 0.04, 0.5):
            changed = [w for w in words if rng.random() >= share]
            for _ in range(int(len(words) * min(share, 0.1))):
                changed.insert(rng.randrange(len(changed)), "other")
            own = [m for m in index.search("start " + " ".join(changed) + " end") if m.license == name]
            if common_in_order(words, changed) >= 0.9 * len(words):
                assert len(own) == 1 and own[0].matched == common_in_order(words, changed)
            for m in own:
                assert m.matched <= common_in_order(words, changed)
            if share == 0.5:
                assert not own


def test_short_lines_must_be_whole_and_spans_do_not_overlap():
    index = TemplateIndex(TEMPLATES)
    assert index.search("Released under the Apache License") == []
    line = "Released under the MIT License."
    text = f"{line} {line}\nLicensed under CC BY-NC 4.0. x " + TEMPLATES["apache-2.0-notice"]
    found = index.search(text)
    assert [m.license for m in found] == ["mit-line", "mit-line", "cc-by-nc-4.0-line", "apache-2.0-notice"]
    assert all(a.end <= b.start for a, b in zip(found, found[1:]))
    with pytest.raises(ValueError):
        TemplateIndex({"none": "..."})


def test_no_template_is_taken_for_its_neighbour():
    index = TemplateIndex(TEMPLATES)
    for name, template in TEMPLATES.items():
        found = index.search(f"Some words before. {template}\n\nand after")
        assert [(m.license, m.coverage) for m in found] == [(name, 1.0)]


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("Licensed under the MIT License", ["mit-line-licensed"]),
        ("This project is licensed under the MIT License.", ["mit-line-licensed"]),
        ("Released under the MIT No Attribution License", []),
        ("Licensed under CC BY-ND 4.0", ["cc-by-nd-4.0-line"]),
        ("Licensed under CC BY-NC-ND 4.0", ["cc-by-nc-nd-4.0-line"]),
        ("Licensed under CC BY-XY 4.0", []),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", ["spdx-gpl-2.0-or-later"]),
        ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", ["spdx-cc-by-nc-sa-4.0"]),
        ("SPDX-License-Identifier: MIT OR Apache-2.0.", ["spdx-mit", "spdx-apache-2.0"]),
        ("SPDX-License-Identifier: MIT-Modern-Variant */", ["spdx-mit-modern-variant"]),
        ("SPDX-License-Identifier: GPL-2.0+", ["spdx-gpl-2.0-or-later"]),
        ("SPDX-License-Identifier: Apache-2.0+ AND BSL-1.0", ["spdx-apache-2.0+", "spdx-bsl-1.0"]),
        ("SPDX-License-Identifier: (MIT AND (ISC OR LicenseRef-x)) OR 0BSD\nOR MIT", ["spdx-mit", "spdx-isc", "spdx-licenseref-x", "spdx-0bsd"]),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", ["spdx-gpl-2.0-only-with-classpath-exception-2.0", "spdx-mit"]),
        ("SPDX-License-Identifier: MIT and more words", ["spdx-mit"]),
        ("An SPDX-License-Identifier: see the file", ["spdx"]),
        ("This project is MIT licensed.", ["mit-line-is"]),
        ("Licensed under GPLv3", ["gpl-3.0-line-tag"]),
        ("It is under the GNU General Public License v3.0 now", ["gpl-3.0-name"]),
        ("GNU Lesser General Public License v2.1", ["lgpl-2.1-name"]),
        ("Licensed under CC BY-SA 3.0", ["cc-by-sa-3.0-line"]),
        ("Released under the Apache-2.0 license", ["apache-2.0-line-tag"]),
        ("This work is licensed under the GNU Free General Public License, version 3.", []),
        (TEMPLATES["gpl-3.0-notice"].replace("version 3", "version 9"), []),
        (TEMPLATES["lgpl-2.1-notice"].replace("library", "program"), ["lgpl-2.1-notice"]),
        (TEMPLATES["agpl-3.0-notice"].replace("program", "file"), ["agpl-3.0-notice"]),
        (TEMPLATES["bsd-3-clause"].replace("HOLDER", "OWNER"), ["bsd-3-clause"]),
        (TEMPLATES["mit"].split("THE SOFTWARE IS PROVIDED")[0], ["mit-grant"]),
    ],
)
def test_naming_words_decide(text, names):
    assert [m.license for m in TemplateIndex(TEMPLATES).search(text)] == names


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    templates = {"plain": "plain words in a plain line said by no one", "word": "word " * 40, "end": "ß 漢字"}
    rows = scan_licenses(odd_documents, "doc_id", "text", templates).collect()
    texts = [tuple(r) for r in pick(odd_documents, i="doc_id", t="text").collect()]
    assert [r.doc_id for r in rows] == [i for i, _ in texts]
    names = [sorted({m.license for m in r.licenses}) for r in rows]
    assert names == [["plain"], [], [], [], ["plain"], [], ["end"], ["word"], [], [], [], []]
    assert sum(m.matched for m in rows[7].licenses) > 25_000
    assert scan_licenses(no_documents, "doc_id", "text").count() == 0


def test_given_documents(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {r.doc_id: r for r in op2_license_scans(spark, FOLDER).collect()}
    lines = {n: words_of(t) for n, t in TEMPLATES.items() if len(words_of(t)) < 14 and n != "spdx"}
    hits = 0
    for doc in pick(documents, i="doc_id", t="text").collect():
        joined = f" {' '.join(words_of(doc.t))} "
        expected = {n for n, w in lines.items() if f" {' '.join(w)} " in joined}
        names = {s.split(":")[0] for s in found[doc.i].spans.split(",") if s}
        expected |= {f"spdx-{t.lower()}" for t in re.findall(r"SPDX-License-Identifier: ([A-Za-z0-9.-]*[A-Za-z0-9])", doc.t or "")}
        assert expected <= names, doc.i
        if not any(w in joined for w in ("license", "licensed")):
            assert not names
        hits += bool(names)
    assert len(found) == documents.count() and hits > 10


def test_grams_are_shorter_than_the_shortest_line():
    assert min(len(words_of(t)) for t in TEMPLATES.values()) >= GRAM
