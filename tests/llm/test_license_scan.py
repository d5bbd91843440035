import re
from re import _constants as sre, _parser as sre_parser

import pytest

from korpusmill.llm import license_rules
from korpusmill.llm.license_scan import PHRASES, scan_licenses

RULES = license_rules.rules()


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def expected(text):
    words = words_of(text)
    places, base = [], set()
    for phrase, label in PHRASES:
        p = phrase.split(" ")
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    line = " " + " ".join(words) + " " if words else " "
    found = []
    for number, label, priority, _, pattern in RULES:
        found += [(m.start(), -m.end(), priority, number, label) for m in re.finditer(pattern, line)]
    found.sort()
    alive = [x for i, x in enumerate(found) if not any(y[1] <= x[1] and y[2] <= x[2] for y in found[:i])]
    score = max([0.9 if places else 0.0, *(license_rules.WEIGHTS[x[2]] for x in alive)])
    join = lambda s: ",".join(sorted(s))
    return len(words), len(places), min(places, default=None), max(places, default=None), join(base), join(base | {x[4] for x in alive}), score


TEXTS = [
    None, "", " \n", "plain words only", "Released under the MIT License.", "under the mit license under the mit license, under-the-MIT license",
    "under the mit licenses", "xunder the mit license", "Apache License, Version 2.0. See http://www.apache.org/licenses/LICENSE-2.0",
    "cc by nc cc-by-nc-sa 4.0 CC BY NC", "GNU General Public License, version 3 or later; GPL-2.0-only; gplv3", "the GNU Affero General Public License v3",
    "BSD 3-Clause License. Redistribution and use in source and binary forms, with or without modification, are permitted",
    "Licensed under the Foo License. Open source license. All rights reserved. Copyright (c) 2019 2020 Ä",
    "émit license İ mit license", "creative commons attribution noncommercial no derivatives works 4.0", "some rights reserved creative commons",
    "public domain gemeinfrei tous droits réservés", "word " * 30_000 + "mit license " * 2000 + "apache 2.0",
]


def test_matches_brute_force(documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4]), (4, TEXTS[4])]
    out = scan_licenses(documents(rows))
    assert out.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted(((d, *expected(t)) for d, t in rows), key=repr)


@pytest.mark.parametrize(("text", "labels"), [
    ("released under the mit license", "mit"), ("license: mit", "mit"), ("see the gnu lesser general public license v2.1", "lgpl-2.1"),
    ("this is free and unencumbered software released into the public domain", "unlicense"), ("cc by-sa 4.0", "cc-by-sa-4"), ("mit in einem satz", ""),
    ("gnu general public license version 2", "gpl-2"), ("mozilla public license 2.0", "mpl-2"),
])
def test_contained_matches_give_way(documents, text, labels):
    assert scan_licenses(documents([(1, text)])).first()["labels"] == labels


def test_rules_are_many_and_their_keywords_hold():
    assert len(RULES) >= 250
    assert all(re.search(rf"\b{re.escape(keyword)}\b", pattern) for _, _, _, keyword, pattern in RULES)


def forms(parsed):
    """Texts that a parsed pattern matches, with every alternative, every optional part there and not, and gaps that glue words."""
    out = [""]
    for op, arg in parsed:
        if op is sre.LITERAL:
            ways = [chr(arg)]
        elif op is sre.ANY:
            ways = ["z"]
        elif op is sre.IN:
            ways = ["z"] if arg[0][0] is sre.NEGATE else ["7"] if arg[0][0] is sre.CATEGORY else [chr(c) for o, a in arg for c in ([a] if o is sre.LITERAL else a)]
        elif op is sre.NOT_LITERAL:
            ways = ["z"]
        elif op is sre.BRANCH:
            ways = [f for branch in arg[1] for f in forms(branch)]
        elif op is sre.SUBPATTERN:
            ways = forms(arg[-1])
        elif op is sre.MAX_REPEAT:
            ways = [f * n for n in {arg[0], max(1, arg[0])} for f in forms(arg[2])]
        else:
            assert op in (sre.ASSERT, sre.ASSERT_NOT)
            continue
        out = list(dict.fromkeys(o + w for o in out for w in ways))
    return out


def test_every_form_of_every_rule_holds_its_keyword_and_passes_the_gate(documents):
    texts = []
    for _, _, _, keyword, pattern in RULES:
        own = forms(sre_parser.parse(pattern))
        assert own and all(re.fullmatch(f" {pattern} ", f" {t} ") and keyword in t.split(" ") for t in own), (keyword, pattern)
        texts += own[:: max(1, len(own) // 8)] + own[-1:]
    texts += ["unauthorized copying of this file via any medium is strictly prohibited", "CreativeML OpenRAIL-M", "licence ouverte 2.0"]
    texts = list(dict.fromkeys(texts))
    got = {r["doc_id"]: tuple(r)[1:] for r in scan_licenses(documents(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == [expected(t) for t in texts]


def test_empty_table(documents):
    assert scan_licenses(documents([])).collect() == []
