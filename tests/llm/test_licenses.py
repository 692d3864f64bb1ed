from __future__ import annotations

import random
import re

from ordermill.llm.licenses import CUES, SIMILARITY, TEMPLATES, Scanner, fixed, scan_licenses, words
from ordermill.llm.queries import op10_licenses

SCANNER = Scanner(TEMPLATES)


def names(text):
    return [(text[a:b], name, n) for a, b, name, _, _, n in SCANNER.scan(text)]


def test_each_template_is_found_exactly_amid_prose():
    for name, text in TEMPLATES.items():
        doc = f"Thea onon the est. Ing wh ofthe.\n{text}\n\nAnble and of the. Re st."
        got = names(doc)
        assert [(n, d) for _, n, d in got][:1] == [(name, 0)], (name, got)


def test_variants():
    assert names("Licensed under CC BY-NC 4.0.")[0][1:] == ("CC-BY-NC-4.0", 0)
    assert names("LICENSED UNDER THE APACHE LICENSE, VERSION 2.0.")[0][1:] == ("Apache-2.0-notice", 0)
    assert names("intro words. This work is  licensed under the\nGNU General Public License, version 3. More") == [
        ("This work is  licensed under the\nGNU General Public License, version 3.", "GPL-3.0-notice", 0)]
    assert names("Released under the MIT License. Licensed under CC BY 4.0.") == [
        ("Released under the MIT License.", "MIT-notice", 0), ("Licensed under CC BY 4.0.", "CC-BY-4.0", 0)]
    assert names("This work is licensed under the GNU General Public License, version 4.") == []
    assert names("She has a fishing licence. The copyright of songs is a long story.") == []
    got = names("This work was licensed under the GNU General Public License, version 3.")
    assert got[0][1:] == ("GPL-3.0-notice", 2)


def test_white_space_does_not_make_a_block_too_long():
    wide = (" " * 200).join(TEMPLATES["MIT"].split(" "))
    assert [(n, d) for _, n, d in names(wide)] == [("MIT", 0)]
    lines = "\n *  ".join(TEMPLATES["MIT-warranty"].split(" "))
    assert [(n, d) for _, n, d in names(lines)] == [("MIT-warranty", 0)]


def test_linear_on_hostile_texts():
    for text in ("license " * 60_000, "license. " * 30_000, "İ" * 100_000 + "license", "\n" * 100_000 + "copyright", "licen" * 50_000):
        list(SCANNER.scan(text))


def test_odd_rows_and_query(spark, sf_dir, corpus, make_docs):
    lic = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, lic), (3, lic), (None, "a b. " + lic), (4, "x y z. " * 30_000 + lic)]
    got = sorted(((r.doc_id, r.start, r.license) for r in scan_licenses(make_docs(rows)).collect()), key=repr)
    assert got == sorted([(3, 0, "MIT-notice"), (3, 0, "MIT-notice"), (None, 5, "MIT-notice"), (4, 210_000, "MIT-notice")], key=repr)
    assert scan_licenses(make_docs([])).count() == 0
    wordings = {"Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the Apache License, Version 2.0.", "All rights reserved.", lic}
    want = sorted((r.doc_id, r.text.index(w)) for r in corpus.collect() for w in wordings if w in (r.text or ""))
    found = op10_licenses(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.start) for r in found) == want and want
    assert all(r.n_differences == 0 and 0 < r.reduction < 1 for r in found)


def test_wording_inside_a_longer_sentence():
    apache = "licensed under the Apache License, Version 2.0."
    assert names("This project by the Foo team is released under the MIT License.") == [("released under the MIT License.", "MIT-notice", 0)]
    assert names("The code in this repository is " + apache) == [(apache, "Apache-2.0-notice", 0)]
    assert names("Released under the MIT License\nFoo bar baz.") == [("Released under the MIT License", "MIT-notice", 0)]
    bare = TEMPLATES["MIT"].replace(".", "")
    assert names("word " * 5000 + bare + " tail" * 5000) == [(bare, "MIT", 0)]


def test_template_ranked_beyond_the_third():
    text = "You may copy this work under the terms of the sample licence as it was published by its authors."
    near = {f"a{k}": text + f" {word}" for k, word in enumerate(("zebra", "quartz", "jumbo", "vexed", "pygmy"))}
    assert [(name, n) for *_, name, _, _, n in Scanner({**near, "z": text}).scan(text)] == [("z", 0)]


def test_part_of_a_run_and_numbers_around_it():
    grant, warranty = TEMPLATES["Apache-2.0"], TEMPLATES["Apache-2.0-warranty"]
    see = "See the License for the specific language governing permissions and limitations under the License."
    want = [("Apache-2.0", 0), ("Apache-2.0-warranty", 0)]
    for sep in ("\n", "\n\n", " "):
        header = sep.join(["Copyright 2020 Foo Inc.", grant, warranty, see])
        assert [(n, d) for _, n, d in names(header) if not n.endswith("-see")] == want
        commented = "# " + header.replace(" the ", "\n# the ").replace(" rights", "\n# rights")
        assert [(n, d) for _, n, d in names(commented) if not n.endswith("-see")] == want
    assert names("Copyright 2020 Foo Inc.\n" + grant)[0][1:] == ("Apache-2.0", 0)
    assert [n for _, n, _ in names("Copyright (c) 1999-2004, 2 authors. All rights\n * reserved. 17 pages")] == ["All-rights-reserved"]
    assert names("This work is licensed under the GNU General Public License, version 3.1.") == []
    assert names("In 2019 this work is licensed under the GNU General Public License, version 3.0. 4 of 5")[0][1] == "GPL-3.0-notice"


def test_common_licences_and_kinds():
    gpl = TEMPLATES["GPL-3.0-or-later"]
    header = "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as " \
             "published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    for text, want in ((header.format("program", "", "2"), "GPL-2.0-or-later"), (gpl, "GPL-3.0-or-later"),
                       (header.format("library", "Lesser ", "2.1"), "LGPL-2.1-or-later"),
                       (header.format("program", "Affero ", "3"), "AGPL-3.0-or-later"),
                       ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-NC-ND 3.0.", "CC-BY-NC-ND-3.0"),
                       ("// SPDX-License-Identifier: GPL-2.0-or-later\n", "SPDX-GPL-2.0-or-later"),
                       ("# SPDX-License-Identifier: MIT\n#include", "SPDX-MIT")):
        assert [(n, d) for _, n, d in names(text)] == [(want, 0)], text
    for text in ("Licensed under CC BY-SA 9.0.", "SPDX-License-Identifier: BSD-2-Clause-Patent",
                 "SPDX-License-Identifier: MIT-1", "Released under the Foo License."):
        assert names(text) == [], text
    few = {k: v for k, v in TEMPLATES.items() if k in ("CC-BY-NC-4.0", "GPL-3.0-or-later")}
    assert not list(Scanner(few).scan("Licensed under CC BY-NC-SA 4.0. " + gpl.replace("GNU", "GNU Lesser")))


# --- against a search over every window and every template ----------------------

def _fewest(own, wording, at):
    """Words left out of either side, for the windows of ``own`` that start at
    ``at``, by their last word; None where a fixed word would be left out."""
    never = 10 ** 6
    cost = [never if fixed(w) else 1 for w in wording]
    row = [0]
    for c in cost:
        row.append(row[-1] + c)
    out = []
    for word in own[at:]:
        extra = never if fixed(word) else 1
        new = [row[0] + extra]
        for j, (w, c) in enumerate(zip(wording, cost)):
            new.append(min(row[j + 1] + extra, new[j] + c, row[j] if w == word else 2 * never))
        row = new
        out.append(row[-1] if row[-1] < never else None)
    return out


def _brute(text, templates):
    """(words less equal ones, first, last, name, differing) of all windows near
    a template that hold a cue: for each template and last word the one of
    fewest differences, the longest of them."""
    low = text.lower()
    spans = [m.span() for m in re.finditer(r"\w+", low)]
    own = [low[a:b] for a, b in spans]
    cues = set()
    for cue in CUES:
        for m in re.finditer(r"\W+".join(map(re.escape, cue.split())), low):
            cues.add(max([k for k, (a, _) in enumerate(spans) if a <= m.start()], default=0))
    found = []
    for name, wording in templates.items():
        best = {}
        for first in range(len(own)):
            for last, differ in enumerate(_fewest(own, wording, first), first):
                if differ is not None and own[last] in wording and (last not in best or differ < best[last][0]):
                    best[last] = (differ, first)
        for last, (differ, first) in best.items():
            size = last + 1 - first + len(wording)
            goes_on = fixed(own[last]) and re.match(r"\.0*[1-9]|-\w|\+", text[spans[last][1]:])
            if size - differ >= SIMILARITY * size - 1e-9 and any(first <= c <= last for c in cues) and not goes_on:
                found.append((differ - (size - differ) // 2, first, last, name, differ))
    return spans, found


def _check(text, templates, scanner):
    """The scan names windows of the search, the best first, none left over."""
    spans, found = _brute(text, templates)
    places = {a: k for k, (a, _) in enumerate(spans)}
    got = [(places[a], name, differ) for a, _, name, _, _, differ in scanner.scan(text)]
    assert len(got) == len(set(got))
    taken, named = set(), []
    for _, first, last, name, differ in sorted(found, key=lambda f: (f[0], (f[1], f[3], f[4]) not in got, f[1:])):
        if taken.isdisjoint(range(first, last + 1)):
            taken.update(range(first, last + 1))
            named.append((first, name, differ))
    assert sorted(named) == sorted(got), (text, sorted(named), sorted(got))
    return len(got)


def _altered(rng, text):
    words_ = text.split()
    for _ in range(rng.choice((0, 1, 2, 4))):
        at = rng.randrange(len(words_))
        change = rng.randrange(3)
        if change == 0 and len(words_) > 2:
            del words_[at]
        elif change == 1:
            words_.insert(at, rng.choice(("the", "ware", "version", "2", "under", "MIT", "license")))
        else:
            words_[at] = rng.choice(("a", "said", "License,", "3.0", "General"))
    return " ".join(words_)


def test_equal_to_a_search_of_every_window_and_template():
    rng = random.Random(5)
    wordings = {name: words(text) for name, text in sorted(TEMPLATES.items())}
    short = [t for t in TEMPLATES.values() if len(t.split()) <= 14]
    long = [t for t in TEMPLATES.values() if 14 < len(t.split()) <= 45]
    n = 0
    for _ in range(14):
        parts = [_altered(rng, rng.choice(short)) for _ in range(rng.choice((1, 2, 3)))]
        n += _check(rng.choice((" ", "\n", " of and\n")).join(["It was", *parts, "and so on."]), wordings, SCANNER)
    for _ in range(2):
        n += _check("See. " + _altered(rng, rng.choice(long)) + " so.", wordings, SCANNER)
    assert n >= 14


def test_equal_to_the_search_with_templates_that_share_words():
    rng = random.Random(9)
    given = {f"t{k}": " ".join(rng.choice(("licence", "a", "b", "c", "d", "mit", "gpl", "1", "2"))
                               for _ in range(rng.randrange(1, 9))) for k in range(25)}
    wordings, scanner = {name: words(text) for name, text in sorted(given.items())}, Scanner(given)
    n = 0
    for _ in range(150):
        text = " ".join(rng.choice(("licence", "a", "b", "c", "d", "mit", "gpl", "1", "2", "x")) for _ in range(rng.randrange(1, 25)))
        n += _check(text, wordings, scanner)
    assert n >= 100
