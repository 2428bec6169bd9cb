"""Automaton against brute force; licence spans."""

import random
import re

import pytest


from sylvatab.llm import licenses
from sylvatab.llm.queries import op5_licenses

SF = "/root/testdata/sf0.001"

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base(text):
    words = WORD.findall(lowered(text))
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_matching_statistics():
    rng = random.Random(5)
    for _ in range(40):
        texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        automaton = licenses.Automaton(texts)
        stream = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(60)]
        state = length = 0
        for i in range(len(stream)):
            state, length = automaton.step(state, length, stream[i])
            known = [
                n for n in range(i + 2) for t in texts for j in range(len(t) - n + 1) if t[j : j + n] == stream[i + 1 - n : i + 1]
            ]
            assert length == max(known)
            for number, end in [(t, e) for t, ends in automaton.ends[state].items() for e in ends] if length else []:
                assert texts[number][end - length + 1 : end + 1] == stream[i - length + 1 : i + 1]


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MIT License.", {"mit"}),
        ("Licensed under the Apache License, Version 2.0.", {"apache-2"}),
        ("x x Licensed under CC BY-NC 4.0. y", {"cc-by-nc"}),
        ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3"}),
        ("All rights reserved.", {"all-rights-reserved"}),
        ("under the stars the license to thrill", set()),
        # One word changed and one left out: two matches in a chain.
        (
            "Permission is hereby granted, free of charge, to any human obtaining a copy of this software and"
            " documentation files (the Software), to deal in the Software without restriction",
            {"mit"},
        ),
    ],
)
def test_spans(text, labels):
    n, _, spans = licenses.Scanner().scan(text.encode())
    assert {s.label for s in spans} == labels
    assert all(0 <= s.first <= s.last < n and licenses.COVER <= s.cover <= 1 for s in spans)


def test_odd_rows(odd, nothing):
    rows = licenses.scan(odd, keep=["doc_id"]).collect()
    assert sorted((r.n_words for r in rows)) == sorted(base(r.text)[0] for r in odd.collect())
    assert licenses.scan(nothing, keep=["doc_id"]).collect() == []


def test_repeats():
    text = "CC BY-NC cc by nc " * 2000
    n, places, _ = licenses.Scanner().scan(text.encode())
    assert (n, len(places)) == (12000, 4000)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_licenses(spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows} == {
        i: base(t) for i, t in texts.items()
    }
    for r in rows:
        assert set(r.base_labels.split(",")) <= {*r.labels.split(","), ""}
        assert 0 <= r.score <= 1


def covered_by_brute_force(words, template):
    """Most words of a template that one chain of matches covers: all maximal
    matches, found word by word, chained in every way that the gaps allow."""
    matches = []
    for j in range(len(words)):
        for k in range(len(template)):
            n = 0
            while n <= min(j, k) and words[j - n] == template[k - n]:
                n += 1
            if n >= licenses.LEAST_MATCH:
                matches.append((j, k, n))
    longest = {j: max(n for i, _, n in matches if i == j) for j, _, _ in matches}
    kept = sorted((j, k, n) for j, k, n in matches if n == longest[j] and longest.get(j + 1, 0) <= n)
    best = {}
    for j, k, n in kept:
        best[j, k, n] = n
        for (i, m, _), covered in list(best.items()):
            overlap = max(0, i - (j - n), m - (k - n))
            near = (j - n + 1) - i <= licenses.GAP + 1 and (k - n + 1) - m <= licenses.GAP + 1
            if i < j and m < k and near and n > overlap:
                best[j, k, n] = max(best[j, k, n], covered + n - overlap)
    return max(best.values(), default=0)


def test_chains_like_brute_force():
    """Templates whose phrases repeat, in texts with words changed, left out and put in."""
    rng, agreed = random.Random(11), 0
    for _ in range(150):
        template = [rng.choice("abc") for _ in range(rng.randrange(6, 25))]
        words = [rng.choice("abcx") if rng.random() < 0.1 else w for w in template if rng.random() > 0.05]
        words = [rng.choice("abx") for _ in range(rng.randrange(5))] + words
        scanner = licenses.Scanner({}, {"t": [" ".join(template)]})
        spans = scanner.scan(" ".join(words).encode())[2]
        most = covered_by_brute_force(words, template)
        assert bool(spans) == (most >= licenses.COVER * len(template))
        if spans:
            assert max(s.cover for s in spans) == pytest.approx(most / len(template))
            agreed += 1
    assert agreed > 50


def whole(label):
    return max(licenses.all_templates()[label], key=len)


@pytest.mark.parametrize("label", sorted(licenses.all_templates()))
def test_every_template_is_its_own_licence(label):
    for text in licenses.all_templates()[label]:
        spans = licenses.Scanner().scan(f"Copyright 2020 Somebody. {text} int main".encode())[2]
        assert {s.label for s in spans} == {label}
        assert max(s.cover for s in spans) == 1


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        # Comment signs, another name in a clause, a line that was left out.
        ("\n".join(f" * {line}" for line in whole("bsd-3").replace("the copyright holder nor", "Google Inc. nor").split("\n")), {"bsd-3"}),
        ("\n".join(f"// {line}" for line in whole("apache-2").split("\n")), {"apache-2"}),
        (whole("mit").split("\n\n")[2], {"mit"}),
        (whole("unlicense").split("\n\n")[2], {"unlicense"}),
        # Versions and families by their own words.
        (whole("gpl-2"), {"gpl-2"}),
        (whole("gpl-3").replace("program", "library"), {"gpl-3"}),
        ("it under the terms of the GNU General Public License version 2 as published by", {"gpl-2"}),
        ("under the terms of the GNU Affero General Public License", {"agpl"}),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", {"cc-by-nc-sa"}),
        # Two licences in one file.
        (whole("isc") + " and parts of it: " + whole("zlib"), {"isc", "zlib"}),
        ("the software is provided to the author of the license and the copyright notice", set()),
    ],
)
def test_excerpts(text, labels):
    n, _, spans = licenses.Scanner().scan(text.encode())
    assert {s.label for s in spans} == labels
    assert all(0 <= s.first <= s.last < n and 0 < s.cover <= 1 for s in spans)


def test_repeated_licence():
    """Each place is a span; the time is in proportion to the text."""
    text = whole("mit") + " something else " * 10
    _, _, spans = licenses.Scanner().scan((text * 200).encode())
    assert len(spans) == 200 and {s.label for s in spans} == {"mit"}
    n, _, _ = licenses.Scanner().scan(b"the copyright holder the copyright " * 20_000)
    assert n == 100_000
