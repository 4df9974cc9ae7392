import re

import pytest

from plumbwright.llm import licenses
from plumbwright.llm.license_rules import BASE, OTHER, rules, spaced

RULES = rules()
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(low)


def brute(text):
    """Every rule on every text, with all intervals compared pairwise."""
    words = words_of(text)
    body = " " + "  ".join(words) + " "
    spans, base = [], []
    for r in RULES:
        for m in re.finditer(spaced(r.pattern), body):
            start, end = body[: m.start()].count(" ") // 2, body[: m.end()].count(" ") // 2
            (base if r.base else spans).append((start, end, r))
    key = lambda s: (s[0], -s[1], s[2].priority, s[2].number)
    outer = [s for s in spans if not any(o[0] <= s[0] and s[1] <= o[1] and key(o) < key(s) for o in spans)]
    outer.sort(key=key)
    kept = []
    for i, s in enumerate(outer):
        others = [o for o in outer[max(0, i - 1) : i + 2] if o is not s and o[0] < s[1] and s[0] < o[1]]
        if s[2].label and not any(o[2].priority < s[2].priority for o in others):
            kept.append(s)
    base_labels = {r.label for _, _, r in base}
    labels = base_labels | {r.label for _, _, r in kept}
    starts = [s for s, _, _ in base]
    score = max([r.score for _, _, r in base + kept], default=0.0)
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base_labels)), ",".join(sorted(labels)), score,
    )


TEXTS = [
    "Released under the MIT License. MIT license MIT-License",
    "mit\n\nlicense; the Apache License, Version 2.0 (the \"License\")",
    "This work is licensed under the GNU General Public License, version 3 or any later version.",
    "not licensed under the MIT license, but a driver's license and a license key",
    "my MIT Press book", "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: CC-BY-NC-SA-4.0",
    "licensed under CC BY-NC 4.0. All rights reserved.", "GNU Lesser General Public License v2.1 only, LGPLv2.1",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "GPLv3", "general public", "Mozilla Public Licence 2.0",
    "available under the terms of the Eclipse Public License v2.0 or the apache license 2", "license " * 300, "mit license " * 300,
    "GENERAL PUBLIC LICENSE MIT LICENSE APACHE LICENSE", "creative commons attribution-sharealike 3.0 unported license", "admit license", "mit licenses",
    "éapache license apache licenseé apache.license", "neither the name of the university nor its staff may be used to endorse or promote products",
]


def got(docs):
    cols = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return [(r["doc_id"], tuple(r[c] for c in cols)) for r in licenses.scan(docs).collect()]


def test_scan_equals_brute_force(make):
    rows = list(enumerate(TEXTS))
    assert dict(got(make(rows))) == {i: brute(t) for i, t in rows}


def test_sample_equals_brute_force(sample):
    docs, rows = sample
    found = dict(got(docs))
    assert len(found) == len(rows)
    # Brute force tries 900 rules on each text: all texts that name a licence, and every tenth other one.
    some = [(i, t) for i, t, _ in rows if "licen" in t.lower() or (i % 10 == 0 and len(t) < 20_000)]
    assert len(some) > 15 and all(found[i] == brute(t) for i, t in some)
    for i, text, _ in rows:
        words = words_of(text)
        at = [k for p in BASE for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        assert found[i][:4] == (len(words), len(at), min(at, default=None), max(at, default=None))


def test_labels_by_hand(make):
    found = dict(got(make(list(enumerate(TEXTS)))))
    assert found[0][1:6] == (3, 3, 7, "mit", "mit")
    assert found[2][4:6] == ("gpl", "gpl,gpl-3.0-or-later")
    # A denial suppresses the rule's label; the base phrase stays.
    assert found[3][4:] == ("mit", "mit", 0.6)
    assert found[4][4:] == ("", "", 0.0)
    assert found[5][5] == "gpl-2.0-or-later" and found[6][5] == "cc-by-nc-sa-4.0"
    assert found[16][1:5] == (3, 0, 5, "apache,gpl,mit")
    assert found[18][1] == 0 and found[19][1] == 0 and found[20][1] == 1


@pytest.mark.parametrize("rule", [r for r in RULES if r.keyword not in ("hereby",)][::7])
def test_keyword_is_in_every_match(rule):
    """Shortest and longest readings of the expression hold the keyword, and licence or license where it says so."""
    optional = re.compile(r"\(\?:((?:[^()]|\([^()]*\))*)\)\?")
    for keep in (r"", r"(?:\1)"):
        text = optional.sub(keep, rule.pattern).replace("licen[cs]e", "licence").replace("licen[cs]ed", "licenced").replace(".{1,80}?", "x")
        while m := re.search(r"\(\?:([^()]*)\)\??", text):
            # Each alternative in turn would be 2^n texts; the shortest and the first are tried.
            pick = min(m.group(1).split("|"), key=len) if keep == "" else m.group(1).split("|")[0]
            text = text[: m.start()] + pick + text[m.end() :]
        words = text.replace("?", "").split()
        assert rule.keyword in words or rule.keyword.replace("se", "ce") in words, (text, rule)
        assert not rule.licence or {"licence", "license"} & set(words), (text, rule)


def test_there_are_hundreds_of_ordered_rules():
    assert len(RULES) > 500 and [r.priority for r in RULES] == sorted(r.priority for r in RULES)
    assert {r.label for r in RULES if r.base} == set(BASE.values()) and all(p for _, p in OTHER)
    assert all(0 <= r.score <= 1 for r in RULES)


def test_no_python_in_the_plan(spark, sample):
    docs, _ = sample
    found = licenses.scan(docs)
    text = found._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", text)
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", licenses.rule_table(spark)._jdf.queryExecution().toString())


def test_odd_and_empty_inputs(odd, empty, make):
    rows = got(odd)
    assert len(rows) == 11 and sum(i is None for i, _ in rows) == 1
    assert dict(rows)[1] == (0, 0, None, None, "", "", 0.0) and dict(rows)[6][0] == 30_000
    assert got(empty) == []
    same = got(make([(None, "mit license"), (None, "mit license"), (4, "mit license"), (4, "gplv2")]))
    assert sorted(r[1][1] for r in same) == [0, 1, 1, 1]
    spans = licenses.license_spans(make([(1, "x released under the mit license y")])).collect()
    assert [tuple(r) for r in spans] == [(1, 1, 5, "mit", 0.95)]
