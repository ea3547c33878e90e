import random

import pytest

from rivulet.llm.license_scan import TEMPLATES, Scanner, scan_licenses, words_of
from tests.llm.corpora import awkward, frame, sentence

scanner = Scanner(TEMPLATES)


@pytest.mark.parametrize("name", sorted(TEMPLATES))
@pytest.mark.parametrize("form", ["{}", "# {}\n", "{}", "before it {} after it"])
def test_templates_are_found_where_they_stand(name, form):
    rng = random.Random(len(name))
    text = " ".join(sentence(rng, 200)) + ".\n" + form.format(TEMPLATES[name]) + "\n" + " ".join(sentence(rng, 150))
    found = [h for h in scanner(text) if h[4] == 1 and not h[6]]
    assert [h[2] for h in found] == [name]
    begin, end = found[0][:2]
    assert text[begin:end].rstrip(".,") in TEMPLATES[name] and end - begin > len(TEMPLATES[name]) - 6


def test_differences_in_wording_are_named():
    text = TEMPLATES["MIT-grant"].replace("free of charge", "free of any charge").replace("dealt", "deal").replace("obtaining", "getting")
    (hit,) = scanner(text)
    assert hit[2] == "MIT-grant" and hit[5] == "obtaining" and hit[6] == "any getting" and 0.9 < hit[4] < 1


def test_near_templates_are_told_apart():
    names = ["GPL-3.0", "LGPL-3.0", "AGPL-3.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"]
    assert [[h[2] for h in scanner(TEMPLATES[n])] for n in names] == [[n] for n in names]


def test_many_notices_in_one_text():
    rng = random.Random(1)
    order = [rng.choice(sorted(TEMPLATES)) for _ in range(40)]
    text = "\n".join(f"{' '.join(sentence(rng, rng.choice([3, 60])))}\n{TEMPLATES[n]}" for n in order)
    assert [h[2] for h in scanner(text)] == order


def test_notices_one_after_the_other_are_all_found():
    names = ["CC-BY-4.0", "MIT", "Apache-2.0", "GPL-3.0", "CC-BY-SA-4.0", "all-rights-reserved", "LGPL-3.0", "Unlicense"]
    assert [h[2] for h in scanner(" ".join(TEMPLATES[n] for n in names))] == names


@pytest.mark.parametrize(("text", "want"), [
    ("It is under the GNU General Public License, version 2, as is.", "GPL-2.0-name"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 4.", "unknown GPL"),
    ("This work is licensed under the GNU Library General Public License, version 2.", "LGPL-2.0"),
    ("Licensed under the Apache Software License, Version 1.1.", "Apache-1.1"),
    ("Licensed under the Apache License, Version 3.0 (the \"License\"); you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-3.0", "unknown Apache"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0-long"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0-long"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 5.0 International License.", "unknown CC"),
    ("All rights reserved.", "all-rights-reserved"),
])
def test_licenses_of_a_family_are_told_apart(text, want):
    assert [h[2] for h in scanner(text)] == [want]


def plain_exact(text):
    """(begin, end, name) of every template that stands word by word in the text, the longest where they overlap."""
    words = words_of(text)
    plain, found = [w for w, _, _ in words], []
    for name, template in TEMPLATES.items():
        wanted = [w for w, _, _ in words_of(template)]
        for k in range(len(plain) - len(wanted) + 1):
            if plain[k : k + len(wanted)] == wanted:
                found.append((words[k][1], words[k + len(wanted) - 1][2], name))
    taken = []
    for hit in sorted(found, key=lambda h: (h[0] - h[1], h)):
        if all(hit[1] <= t[0] or hit[0] >= t[1] for t in taken):
            taken.append(hit)
    return sorted(taken)


@pytest.mark.parametrize("seed", range(8))
def test_all_exact_notices_are_found_as_by_hand(seed):
    rng = random.Random(seed)
    parts = []
    for _ in range(rng.choice([5, 30])):
        parts.append(TEMPLATES[rng.choice(sorted(TEMPLATES))])
        parts += [" ".join(sentence(rng, rng.choice([1, 5, 50])))] * rng.randrange(2)
    text = " ".join(parts)
    assert [h[:3] for h in scanner(text) if h[4] == 1 and not h[6]] == plain_exact(text)


def test_other_uses_of_the_words_are_left_alone():
    for text in ("He lost his driving licence.", "A permission slip for school, and copyright law.", "Licensed under CC BY-SA 1.0.", ""):
        assert scanner(text) == []


def test_rows(spark):
    rows = [*awkward(), (50, f"a {TEMPLATES['MIT']} b"), (50, f"a {TEMPLATES['MIT']} b"), (None, TEMPLATES["Apache-2.0"])]
    found = scan_licenses(frame(spark, rows, clash=True)).collect()
    assert sorted((r.doc_id or 0, r.license, r.begin) for r in found) == [(0, "Apache-2.0", 0), (50, "MIT", 2), (50, "MIT", 2)]
    assert scan_licenses(frame(spark, [])).collect() == []
