import re

import pytest

from tillpoint.llm.license_rules import BASE, LICENSES, rules
from tillpoint.llm.licenses import scan_licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, found = [], set()
    for label, _, phrase in BASE:
        p = phrase.split()
        at = [k for k in range(len(words)) if words[k:k + len(p)] == p]
        starts += at
        found |= {label} if at else set()
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(found)))


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    out = scan_licenses(docs).collect()
    key = lambda t: str(t)
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                   for r in out], key=key) == sorted([(i, *brute(t)) for i, t in rows], key=key)
    for r in out:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and r.labels == ",".join(sorted(set(r.labels.split(","))))


def test_whole_table(documents):
    check(documents)


def test_edges(edge_docs, no_docs):
    check(edge_docs)
    assert scan_licenses(no_docs).count() == 0


def test_rules_are_many_and_sound():
    known = rules()
    assert len(known) > 250
    for r in known:
        assert re.compile(r.pattern)
    assert len({label for label, *_ in LICENSES}) > 70


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0.", "apache-2"),
    ("under the terms of the GNU Lesser General Public License v2.1 only", "lgpl,lgpl-2-1"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("Creative Commons Attribution-NonCommercial 4.0 International", "cc-by-nc"),
    ("cc by-nc", "cc-by-nc"),
    ("CC BY-NC-SA 4.0", "cc-by-nc,cc-by-nc-sa"),
    ("see http://www.apache.org/licenses/LICENSE-2.0", "apache-2"),
    ("commit to it, mit freundlichen", ""),
    ("ÀUNDER THE MIT LICENSE", "mit"),
])
def test_priorities(spark, text, labels):
    assert scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")
                         ).first().labels == labels


def test_every_rule_passes_gate_and_keyword():
    """A rule that needs a text its gate or keyword keeps away could never fire."""
    from tillpoint.llm.licenses import GATE

    gate = re.compile(GATE.replace("(?i)", ""), re.I)
    for r in rules():
        for text in _samples(r.pattern):
            words = f" {text} "
            if re.search(f"(?<= )(?:{r.pattern})(?= )", words):
                assert gate.search(text), (r, text)


def _samples(pattern):
    """A few texts a rule matches: optional parts left out, first or second alternative."""
    for pick in (0, -1):
        p = pattern
        while (m := re.search(r"\(\?:([^()]*)\)(\?|\{0,5\})?", p)):
            inner = "" if m[2] else m[1].split("|")[pick]
            p = p[:m.start()] + inner + p[m.end():]
        p = re.sub(r"\[([^\]^])[^\]]*\](\{4\})?", lambda m: m[1] * (4 if m[2] else 1), p)
        p = re.sub(r"\[\^ \]\+", "name", p)
        for alternative in p.split("|"):
            yield re.sub(r".\?", "", alternative).strip()
            yield alternative.replace("?", "").strip()


def _every(tree):
    """Every text of a parsed pattern; a repeat at its least and most, a class by its ends."""
    out = [""]
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            more = [chr(arg)]
        elif op == "SUBPATTERN":
            more = _every(arg[3])
        elif op == "BRANCH":
            more = [t for branch in arg[1] for t in _every(branch)]
        elif op == "NOT_LITERAL":
            more = ["x"]
        elif op == "IN":
            more = [chr(c) for k, v in arg for c in (v if str(k) == "RANGE" else (v,))]
        else:
            assert op == "MAX_REPEAT", op
            one, times = _every(arg[2]), {arg[0], min(int(arg[1]), max(arg[0], 1))}
            more = [t * n for n in times for t in (one if n else [""])]
        out = [a + b for a in out for b in more]
    return out


def test_every_match_holds_a_keyword():
    """A notice has its name's keywords, which the name's own rule tries."""
    for r in rules():
        if r.kind != "notice":
            for text in _every(re._parser.parse(r.pattern)):
                assert re.search(f"(?<= )(?:{r.pattern})(?= )", f" {text} "), (r, text)
                assert any(f" {k} ".replace("* ", "") in f" {text} " for k in r.keywords), (r, text)


def test_alternatives_have_their_own_keywords(spark):
    cases = {"Released under the GPLv3": "gpl-3", "GPLv2.": "gpl-2", "GPL3": "gpl-3", "GPL v2": "gpl-2",
             "gplversion 3": "gpl-3", "the Expat License": "mit", "the PSF license": "python-2",
             "OpenRAIL license": "rail", "a Responsible AI License": "rail",
             "Beer-Ware License": "beerware", "for noncommercial use only": "noncommercial",
             "for non-commercial use only": "noncommercial",
             "GNU General Public License as published by the Free Software Foundation; either "
             "version 3": "gpl-3"}
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    out = {r.doc_id: r for r in scan_licenses(docs).collect()}
    for k, (text, label) in enumerate(cases.items()):
        assert out[k].labels == label and out[k].score > 0.5, (text, out[k])
    both = spark.createDataFrame([(1, "gpl gplv3 gpl 3")], "doc_id long, text string")
    assert scan_licenses(both).first().n_found == 3  # two of gpl-3, one of gpl


def test_short_forms(spark):
    cases = {"licensed under Apache-2.0": "apache-2", "LGPLv3": "lgpl-3", "AGPLv3 or later": "agpl-3",
             "MPL 2.0": "mpl-2", "EPL-2.0": "epl-2", "EUPL-1.2": "eupl-1-2", "GFDL 1.3": "gfdl",
             "MIT-licensed": "mit", "LGPL 2.1": "lgpl-2-1", "LGPL-2.1-or-later": "lgpl-2-1",
             "BSD-licensed code": "bsd", "released under the terms of the ISC": "isc",
             "agpl version 3.0": "agpl-3", "commit mit isc vim 2.0, python 2.0 and apache 2.0": "",
             "published by Intel, provided by Ruby": ""}
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    out = {r.doc_id: r for r in scan_licenses(docs).collect()}
    for k, (text, label) in enumerate(cases.items()):
        assert out[k].labels == label and (out[k].score > 0) == bool(label), (text, out[k])


def test_tag_of_every_license_in_a_notice(spark):
    """The SPDX short form of each listed license, as a tag, in a notice and before "licensed"."""
    cases = []
    for label, _, _, tag in LICENSES:
        for words in {_every(re._parser.parse(tag))[0], _every(re._parser.parse(tag))[-1]}:
            short = words.replace(" ", "-").upper()
            cases += [(label, f"SPDX-License-Identifier: {short}"), (label, f"Licensed under {short}."),
                      (label, f"This is {short} licensed.")]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(cases)], "doc_id long, text string")
    out = {r.doc_id: r.labels.split(",") for r in scan_licenses(docs).collect()}
    wrong = [(text, label, out[k]) for k, (label, text) in enumerate(cases) if label not in out[k]]
    assert not wrong, wrong
