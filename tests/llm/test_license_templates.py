"""Operator 9 against regular expressions on word strings."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import types as T

from storepulse.llm import license_templates as lt
from storepulse.llm import queries
from storepulse.llm.frames import ship


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def as_regex(template):
    """The template as a regular expression over words that each end in a space."""
    out = ""
    for part in re.split(r"(<<[^<>]*>>)", template):
        if part == "<<optional>>":
            out += "(?:"
        elif part == "<</optional>>":
            out += ")?"
        elif m := re.fullmatch(r"<<words (\d+) (\d+)>>", part):
            out += r"(?:[^ ]+ ){%s,%s}" % m.groups()
        else:
            out += "".join(re.escape(w) + " " for w in words(part))
    return re.compile(out)


def longest(pattern, w, i):
    return max((k for k in range(i + 1, len(w) + 1) if pattern.fullmatch("".join(x + " " for x in w[i:k]))), default=-1)


TEMPLATES = {"a": "x <<optional>>y <<optional>>z<</optional>><</optional>> x", "b": "x <<words 1 3>> y", "c": "y<<optional>>y y<</optional>>z"}


def test_automata_accept_what_the_expressions_do():
    rng = random.Random(3)
    for name, template in TEMPLATES.items():
        a, pattern = lt.compiled(template), as_regex(template)
        for _ in range(300):
            w = [rng.choice("xyzq") for _ in range(rng.randint(1, 9))]
            h = lt.np.array(lt.word_hashes(" ".join(w)), lt.np.uint64)
            for i in range(len(w)):
                assert a.longest(h, i) == longest(pattern, w, i), (name, w, i)


@pytest.mark.parametrize("bad", ["<<optional>> x", "x <</optional>>", "<<other>> x", "<<words 1 2>>", "<<optional>>x<</optional>>"])
def test_bad_markup_is_an_error(bad):
    with pytest.raises(ValueError):
        lt.compiled(bad)


MIT = re.sub(r"<<.*?>>", "", lt.TEMPLATES["mit-text"])
TEXTS = [
    None, "", "...", "MIT License", "The mit\nlicense, Apache-License and GENERAL public   license; mit license",
    "Released under the MIT License.", "This tool is released under the terms of the MIT license", "Released under an MIT license",
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", "Copyright (c) 2020 Some Öne. All rights reserved",
    "copyright a b c d e f g h i all rights reserved", "pre " * 3000 + MIT + " post" * 3000, MIT.replace("merge", "mend"),
    "licensed under the apache license " * 500, "permit license mit licenses", "general public license general public license",
]


def test_scan(spark, tmp_path):
    ship(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("labels", T.StringType()),
                           T.StructField("places", T.IntegerType())])
    rows = [(i, t, "mine", 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], None, None), (4, TEXTS[4], None, None)]
    docs = spark.createDataFrame(rows, schema).repartition(2)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_license_templates(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    patterns = {k: as_regex(t) for k, t in lt.TEMPLATES.items() if k != "mit-text"}
    for r in got:
        w = words(TEXTS[4 if r["doc_id"] is None else r["doc_id"]])
        base = [(i, label, len(p.split())) for p, label in lt.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        assert r["n_words"] == len(w) and r["n_base"] == len(base)
        starts = [i for i, _, _ in base]
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if base else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x, _ in base}))
        covered = {k for i, _, n in base for k in range(i, i + n)}
        labels = {x for _, x, _ in base}
        if len(w) < 4000:
            for name, p in patterns.items():
                i, line = 0, "".join(x + " " for x in w)
                starts = [0]
                for x in w:
                    starts.append(starts[-1] + len(x) + 1)
                while i < len(w):
                    m = p.match(line, starts[i])
                    if m:
                        e = starts.index(m.end())
                        covered |= set(range(i, e))
                        labels.add(name)
                        i = e
                    else:
                        i += 1
            if "merge" not in w:
                assert r["labels"] == ",".join(sorted(labels))
                assert r["score"] == pytest.approx(len(covered) / len(w) if w else 0)
    by_id = {r["doc_id"]: r["labels"] for r in got}
    assert by_id[14] == "mit-text" and by_id[15] == "" and by_id[10] == "cc-by-nc-4.0"
    assert lt.scan(docs.limit(0)).count() == 0


NOTICES = {
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "gpl,gpl-3.0",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "gpl,gpl-2.0",
    'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\n'
    "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
    "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\n"
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing "
    "permissions and\nlimitations under the License.": "apache,apache-2.0,apache-notice",
    "Licensed under the Apache License.": "apache,apache-notice",
    "Licensed under the Apache License, Version 1.1": "apache,apache-notice",
    "Apache License v2.0": "apache,apache-2.0",
    "All rights reserved.": "all-rights-reserved",
    "Copyright 2020 Some Body. All rights reserved.": "all-rights-reserved",
    "This project is licensed under the MIT License.": "mit,mit-notice",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "cc-by-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "cc-by-nc-4.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "cc-by-sa-4.0",
    "CC BY-SA 4.0": "cc-by-sa-4.0",
    "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0",
    "under version 3 of the GNU General Public License": "gpl,gpl-3.0",
    "GNU Lesser General Public License, version 3": "gpl",
}


def scanned(text):
    scanner = lt.Scanner(lt.PHRASES, [*lt.TEMPLATES.items(), *lt.WORDINGS])
    _, places, share = scanner.scan(lt.pa.array([text]))
    return {p["label"] for p in places[0]}, places[0], share[0]


@pytest.mark.parametrize("notice", NOTICES)
def test_published_notices(notice):
    assert ",".join(sorted(scanned("before " + notice + " after")[0])) == NOTICES[notice]


def test_standard_notices_are_covered_whole():
    for notice in list(NOTICES)[:3]:
        lead = 5 if notice.startswith("This program") else 0  # "This program is free software"
        assert scanned(notice)[2] == pytest.approx(1 - lead / len(words(notice)))


@pytest.mark.parametrize("label", ["mit-text", "apache-2.0-text", "gpl-2.0-text", "gpl-3.0-text"])
def test_license_texts(label):
    text = re.sub(r"<<.*?>>", "", lt.TEMPLATES[label])
    assert len(words(text)) > 100
    labels, places, share = scanned("Some name.\n" + text)
    assert label in labels and share == pytest.approx(1 - 2 / len(words("Some name.\n" + text)))
    assert label not in scanned(text.replace("copies", "pictures"))[0]
