from __future__ import annotations

import random

from salestream.llm import license_scan
from tests.llm.conftest import prose, rows_of


def found(text):
    return [(f[0], text[f[2]:f[2] + f[3]], f[5]) for f in license_scan.Scanner().scan(text)]


def test_every_template_is_found_in_prose():
    for license_id, _, wording in license_scan.TEMPLATES:
        stated = wording.replace("{}", "3.0")
        (one,) = found(f"{prose(1, 300)}\n{stated}\n{prose(2, 300)}")
        assert one[0] == license_id and one[2] == 0 and one[1] == stated.rstrip(".:")


def test_every_template_has_a_cue():
    assert all(license_scan._CUE.search(t) for _, _, t in license_scan.TEMPLATES)


def test_changed_wording_is_reported():
    text = prose(1, 50) + ' Permission is hereby given, free of charge, to every person obtaining a copy of this software ' \
        'and associated documentation files. ' + prose(2, 50)
    (one,) = license_scan.Scanner().scan(text)
    assert one[0] == "MIT" and one[5] == 2 and set(one[6]) == {"granted", "any"} and set(one[7]) == {"given", "every"}


def test_another_license_or_plain_talk_is_none():
    for text in ("", None, "x", prose(3, 2000), "My driving license expired. " * 50, "Licensed under CC BY-ND 4.0.",
                 "Permission to enter was given by the guard, with a fee."):
        assert license_scan.Scanner().scan(text) == []


def test_many_in_a_very_long_line():
    text = " ".join(f"{prose(i, 40 + 97 * (i % 9))} Released under the MIT License. Licensed under CC BY-SA 4.0." for i in range(60))
    assert [f[0] for f in license_scan.Scanner().scan(text)] == ["MIT", "CC-BY-SA"] * 60
    close = "Released under the MIT License. " * 900
    assert len(license_scan.Scanner().scan(close)) == 900


def test_table(docs_of):
    apache = "Licensed under the Apache License, Version 2.0."
    docs = docs_of((1, "a\n" + apache), (2, None), (3, ""), (4, apache), (4, apache), (None, apache), (5, prose(1, 9)))
    assert rows_of(license_scan.scan(docs), "doc_id", "license", "start") == sorted(
        [(1, "Apache-2.0", 2), (4, "Apache-2.0", 0), (4, "Apache-2.0", 0), (None, "Apache-2.0", 0)], key=repr)
    assert rows_of(license_scan.scan(docs.limit(0))) == []


def least_changes(own, words):
    """Brute force: the fewest changes between a template and any stretch, by the textbook table for every start."""
    best = len(own)
    for start in range(len(words)):
        row = list(range(len(words) - start + 1))
        for i, w in enumerate(own, 1):
            after = [i]
            for j, v in enumerate(words[start:], 1):
                after.append(min(row[j] + 1, after[j - 1] + 1, row[j - 1] + (w != v)))
            row = after
        best = min(best, *row[1:])
    return best


def test_changes_are_those_of_brute_force():
    pick = random.Random(4)
    scanner = license_scan.Scanner()
    for i, (license_id, _, wording) in enumerate(license_scan.TEMPLATES):
        if len(wording) > 250:
            continue
        stated = wording.replace("{}", "3.0").split()
        for _ in range(int(len(stated) * 0.1)):
            at = pick.randrange(len(stated))
            stated[at:at + 1] = pick.choice(([], [stated[at], "indeed"], ["other"]))
        text = f"{prose(i, 12)} {' '.join(stated)} {prose(i + 1, 12)}"
        words = [w for w, _, _ in license_scan.wording(text)]
        every = {t: least_changes(own, words) for t, own in enumerate(scanner.words) if len(own) < 60}
        for f in scanner.scan(text):
            assert f[5] == every[f[1]] and max(len(f[6]), len(f[7])) <= f[5] <= len(f[6]) + len(f[7])
        names = set(words)
        if set(license_scan.TEMPLATES[i][1]) <= names and every[i] <= license_scan.MOST_CHANGED * len(scanner.words[i]):
            assert license_id in {f[0] for f in scanner.scan(text)}


def test_a_rejected_stretch_hides_none():
    assert found("Licensed under CC BY-ND 4.0. Licensed under CC BY-SA") == [("CC-BY-SA", "Licensed under CC BY-SA", 1)]
    assert [f[2] for f in found("Licensed under CC BY-SA 4.0. Licensed under CC BY-SA")] == [0, 1]


def whole(license_id):
    return max((t for name, _, t in license_scan.TEMPLATES if name == license_id), key=len)


def test_whole_texts_with_a_clause_left_out_or_added():
    scan = license_scan.Scanner().scan
    (mit,) = scan(whole("MIT").replace("sublicense, ", "").replace("TORT OR OTHERWISE", "TORT, CRIME OR OTHERWISE"))
    assert mit[0] == "MIT" and mit[5] == 2 and mit[6] == ["sublicense"] and mit[7] == ["crime"]
    assert [f[0] for f in scan(whole("BSD-2-Clause"))] == ["BSD-2-Clause"]
    (three,) = scan("\n * " + whole("BSD-3-Clause").replace(" ", "\n * "))
    assert three[0] == "BSD-3-Clause" and three[5] == 0
    (agpl,) = scan("x " + whole("AGPL").replace("{}", "3"))
    assert agpl[0] == "AGPL" and agpl[5] == 0 and agpl[8] == "3"


def test_versions():
    text = "Licensed under the Apache License, Version 2.0. " + prose(5, 400) + \
        " This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-SA"
    assert [(f[0], f[8]) for f in license_scan.Scanner().scan(text)] == [
        ("Apache-2.0", "2.0"), ("GPL", "3"), ("CC-BY-SA", None)]


def test_whole_texts_across_pieces():
    text = "  ".join(f"{whole('MIT')} {prose(i, 20 + 31 * (i % 5))} {whole('BSD-3-Clause')}" for i in range(20))
    assert [(f[0], f[5]) for f in license_scan.Scanner().scan(text)] == [("MIT", 0), ("BSD-3-Clause", 0)] * 20
