import re

import pytest

from sparkroute.llm import license_scan as ls
from sparkroute.llm.license_rules import compiled

PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
NOTICES = [
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("Released under the MIT License.", "mit"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("GNU Lesser General Public Licence v2.1", "lgpl-2.1"),
    ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("see https://creativecommons.org/licenses/by-sa/4.0/ for it", "cc-by-sa-4.0"),
    ("Copyright (c) 2019 Some Firm Ltd. All rights reserved.", "reserved"),
    ("subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("You may use it under GPL-2.0-or-later", "gpl-2.0-or-later"),
    ("released into the public domain", "public-domain"),
    ("gut mit uns", ""), ("accept by all", ""), ("", ""), ("all rights\n\n*reserved*", "reserved"),
]
TEXTS = [t for t, _ in NOTICES] + [
    None, "cc by cc by-cc-by", "CCÀ BY", "ccby", "Cc\x7fBy 7 all rights reserved. General public license",
    "general public general public license", "İCC BY", " ".join(["cc by"] * 3000) + " x" * 50_000 + " all rights reserved", "x" * 400_000 + " cc by"]


def base(text):
    """n_words, n_base, first, last and labels by comparing every place."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for i in range(len(words)) for p, label in PHRASES.items() if tuple(words[i : i + len(p)]) == p]
    return len(words), len(at), *((at[0][0], at[-1][0]) if at else (None, None)), ",".join(sorted({x[1] for x in at}))


def test_base_like_every_place_and_method_labels(spark):
    rows = [(i % 9 or None, t, "e", 1) for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, found string, n_words int")
    got = ls.labelled(ls.scan(df)).collect()
    key = lambda r: str(tuple(r))
    assert sorted(((r["doc_id"], *r[1:6]) for r in got), key=key) == sorted(((r[0], *base(r[1])) for r in rows), key=key)
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) for r in got)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert ls.scan(df.limit(0)).count() == 0


@pytest.mark.parametrize("text,labels", NOTICES)
def test_labels(spark, text, labels):
    found = ls.scanned(text, ls.Rules())
    assert ",".join(sorted({d["label"] for d in found["found"]} | {b["label"] for b in found["base"]})) == labels


def test_keywords_lose_no_match():
    """Each rule, given a text of its own expression, is let through by its keywords."""
    rules = compiled()
    assert len(rules) > 200 and all(tier in ls.WEIGHTS for _, tier, _, _ in rules)
    for _, _, keywords, expression in rules:
        text = expression.pattern.decode().removeprefix("(?<![^ ])(?:").removesuffix(")(?![^ ])")
        text = re.sub(r"\[\^ \]\+", "word", text).replace("licen[cs]e", "license").replace("[0-9]{2}", "19").replace("{0,12}", "").replace("{0,8}", "").replace("{1,6}", "")
        while "(?:" in text:  # leave out what may be left out, take the first of several
            text = re.sub(r"\(\?:[^()]*\)\?", "", text, count=1) if re.search(r"\(\?:[^()]*\)\?", text) else re.sub(
                r"\(\?:([^()|]*)(\|[^()]*)?\)", r"\1", text, count=1)
        line = b" " + re.sub(r"(.)\?", "", text).encode() + b" "
        assert expression.search(line), (text, expression.pattern)
        assert all(k in line for k in keywords), (text, keywords)


def test_suppression_like_all_pairs():
    import random

    rng = random.Random(2)
    for _ in range(300):
        found = list({(rng.choice("abc"), rng.randrange(1, 4), a, a + rng.randrange(1, 9)) for a in [rng.randrange(20) for _ in range(12)]})
        kept = []
        for d in sorted(found, key=lambda d: (-d[1], d[2], -d[3])):
            if not any(k[2] <= d[2] and d[3] <= k[3] for k in kept):
                kept.append(d)
        assert [d[1:] for d in ls.settled(found)] == sorted((d[1:] for d in kept), key=lambda d: d[1:])


def test_spans(spark):
    found = ls.scanned("Please note: Licensed under the Apache License, Version 2.0, or the MIT License!", ls.Rules())["found"]
    assert [(d["label"], d["first_word"], d["n_words"]) for d in found] == [("apache-2.0", 2, 8), ("mit", 12, 2)]
