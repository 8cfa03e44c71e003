import random
import re

import pytest

from driftline.llm import licenses
from tests.llm import rows as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [
        (k, label)
        for phrase, label in licenses.PHRASES
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    return len(words), places


def test_base_matches_brute_force(spark):
    got = licenses.summary(licenses.scan(R.table(spark))).collect()
    texts = {r[0]: r[1] for r in R.rows()}
    assert len(got) == len(R.rows())
    for r in got:
        n, places = brute(texts[r.doc_id])
        at = [k for k, _ in places]
        assert (r.n_words, r.n_base) == (n, len(places)), r.doc_id
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def plain(words):
    return words.replace("[", "").replace("]", "")


def parts(words):
    """The characters of a notice with whether each is required."""
    out, inside = [], False
    for c in words:
        if c in "[]":
            inside = c == "["
        else:
            out.append((c, inside))
    return out


def edits(words, n):
    """The notice with n letters dropped, doubled or changed in turn, spread over what is not required."""
    chars = parts(words)
    out = [c for c, _ in chars]
    free = [
        i
        for i in range(len(chars))
        if not any(required for _, required in chars[max(0, i - 1) : i + 2])
    ]
    for k in range(n):
        at = free[(2 * k + 1) * len(free) // (2 * n)]
        out[at] = ("", out[at] * 2, "q")[k % 3]
    return "".join(out)


def fewest_edits(words, line):
    """Fewest edits that turn the notice into some stretch of the line, required words whole and untouched."""
    chars, far = parts(words), 10**6
    row = [0] * (len(line) + 1)
    for i, (c, required) in enumerate(chars):
        starts = required and not (i and chars[i - 1][1])
        ends = required and not (i + 1 < len(chars) and chars[i + 1][1])
        new = [far if required else row[0] + 1]
        for j, x in enumerate(line, 1):
            kept = row[j - 1] if x == c else far
            if starts and line[j - 2 : j - 1] != " ":
                kept = far
            if ends and line[j : j + 1] != " ":
                kept = far
            # nothing may be put between required characters
            new.append(kept if required else min(kept, row[j - 1] + 1, row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("k", range(len(licenses.NOTICES)))
def test_notices_are_found_up_to_their_errors_and_not_beyond(k):
    label, text = licenses.NOTICES[k]
    scanner = licenses.Scanner(phrases=(), notices=(licenses.NOTICES[k],))
    most = scanner.notices[0].errors
    for n in range(most + 1):
        line = R.prose(k, 9) + " " + edits(text, n) + ". " + R.prose(k + 50, 9)
        _, spans = scanner.scan(line)
        assert [s[0] for s in spans] == [label], n
        assert spans[0][3] <= n and 8 <= spans[0][1] <= 10
    _, spans = scanner.scan(R.prose(k, 9) + " " + edits(text, 3 * most + 4))
    assert not spans


@pytest.mark.parametrize("k", range(len(licenses.NOTICES)))
def test_random_edits_agree_with_a_plain_table_of_edits(k):
    label, words = licenses.NOTICES[k]
    scanner = licenses.Scanner(phrases=(), notices=(licenses.NOTICES[k],))
    draw, most, text = random.Random(k), scanner.notices[0].errors, plain(words)
    found = 0
    for _ in range(60):
        out = list(text)
        for _ in range(draw.randint(0, most + 2)):
            at = draw.randrange(len(text))
            out[at] = draw.choice(["", out[at] + draw.choice("abcdefg 0123456789"), draw.choice("hijklmnop 0123456789")])
        line = " ".join(f"{R.prose(k, 4)} {''.join(out)} {R.prose(k + 50, 4)}".split())
        want = fewest_edits(words, f" {line} ")
        _, spans = scanner.scan(line)
        found += bool(spans)
        assert bool(spans) == (want <= most), (line, want, spans)
        if spans:
            assert (spans[0][0], spans[0][3]) == (label, want)
    assert 10 < found < 60


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the GNU General Public License version 2.", {"gpl-2.0"}),
        ("Licensed under the GNU General Public License, version 3!", {"gpl-3.0"}),
        ("licensed under the GNU Lesser General Public License version 3", {"lgpl-3.0"}),
        ("licensed under the GNU Lesser General Public License version 2.1", {"lgpl-2.1"}),
        ("licensed under the GNU Affero General Public License version 3", {"agpl-3.0"}),
        ("licensed under the GNU General Public License version 1", set()),
        ("Licensed under CC BY-SA 4.0", {"cc-by-sa"}),
        ("Licensed under CC BY-ND 4.0", {"cc-by-nd"}),
        ("Licensed under CC BY-NC 4.0", {"cc-by-nc"}),
        ("Licensed under CC BY-NC-SA 4.0", {"cc-by-nc-sa"}),
        ("Licensed under CC BY 4.0", {"cc-by"}),
        ("Licensed under CC BY-NC 3.0", set()),
        ("Licensed under the Apache License, Version 1.1", {"apache-1.1"}),
        ("Licensd undr the Apache License, Version 2.0", {"apache-2.0"}),
        ("subject to the terms of the Mozilla Public License, v. 1.1", {"mpl-1.1"}),
        ("subject to the terms of the Mozilla Public License, v. 2.0", {"mpl-2.0"}),
        ("released under the BSD license", {"bsd"}),
        ("released under the ISC license", {"isc"}),
        ("released under the X11 license", {"x11"}),
        ("released under the MIT licence", {"mit"}),
        ("released under the MPL license", set()),
        ("released under the Vim license", set()),
    ],
)
def test_rival_notices_are_told_apart(text, labels):
    _, spans = licenses.Scanner().scan(text)
    assert {s[0] for s in spans if not s[4]} == labels


def test_every_notice_in_a_text_is_a_span():
    short, long = (plain(text) for label, text in licenses.NOTICES if label == "mit")
    scanner = licenses.Scanner()
    _, spans = scanner.scan(f"{short} {long}")
    assert [s[:4] for s in spans] == [("mit", 0, 4, 0), ("mit", 5, 20, 0)]
    _, spans = scanner.scan(f"{short} {R.prose(1, 3)} {short} {short}")
    assert [(s[1], s[2]) for s in spans] == [(0, 4), (8, 12), (13, 17)]
    cut = long.replace("charge", "chrg").replace("person", "prsn")  # two copies start less than the notice's length apart
    _, spans = scanner.scan(f"{cut} {cut}")
    assert [s[:4] for s in spans] == [("mit", 0, 15, 4), ("mit", 16, 31, 4)]


def test_spans_count_words_past_other_scripts():
    n, spans = licenses.Scanner().scan("É日本 - word, All Rights Reserved! all  rights\nreserved")
    exact = [s[:3] for s in spans if s[4]]
    assert n == 8 and exact == [("reserved", 2, 4), ("reserved", 5, 7)]


def test_empty_table(spark):
    assert licenses.summary(licenses.scan(R.table(spark).limit(0))).count() == 0
