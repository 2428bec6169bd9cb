"""Licence scans with a suffix automaton of all templates.

The words of all templates make one generalised suffix automaton. A text's
words are streamed through it; the state reached and its ancestors give for each
word and each template the longest match that ends there, and all places of the
template where it stands. Matches that can't be extended and are long enough are
chained in the order of the template, each with the open chain that covers most.
A chain that covers enough of a template, or enough words of it, is a span of that
licence. Of spans that overlap, the one that covers most words stays, then the one
that covers the larger share of its template; this tells versions apart. Of
those that are equal in both, each label keeps one.

Phrases that decide by themselves are found in the same pass: a phrase ends where
its state is the current one or an ancestor of it.

Words are runs of 0-9, a-z and everything beyond ASCII, after A-Z has been
lower-cased. A null text has no words. Texts of any length are streamed whole.
Repeated rows stay; an empty table gives no rows; a text without words has no
phrases and no spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from sylvatab.llm.common import per_text
from sylvatab.llm.licence_texts import templates as all_templates

#: Words of UTF-8 bytes: the class [^\x00-\x2F\x3A-\x60\x7B-\x7F] of code points.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
#: A match has so many words at least to be chained.
LEAST_MATCH = 3
#: Words that may lie between two matches of a chain, in the text or the template.
GAP = 8
#: Share of a template's words that a span covers, or this many of its words.
COVER, ENOUGH = 0.75, 30

#: Phrases that decide by themselves, and their labels. Fixed values.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


class Found(NamedTuple):
    """A span of words, both ends included."""

    label: str
    first: int
    last: int
    cover: float


class Automaton:
    """Suffix automaton of several sequences of words."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: For each state, sequence -> where in it the occurrences end.
        self.ends: list[dict[int, set[int]]] = [{}]
        for number, words in enumerate(sequences):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].setdefault(number, set()).add(place)
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            above = self.ends[self.link[state]]
            for number, places in self.ends[state].items():
                above.setdefault(number, set()).update(places)

    def _state(self, length: int, follow: dict[bytes, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, state: int, word: bytes) -> int:
        """The state after ``word`` whose longest string is one longer than
        ``state``'s; the present one is divided where its is longer."""
        after = self.next[state][word]
        if self.length[after] == self.length[state] + 1:
            return after
        copy = self._state(self.length[state] + 1, dict(self.next[after]), self.link[after])
        self.link[after] = copy
        while state >= 0 and self.next[state].get(word) == after:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def step(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        """State and length of the longest match after one more word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        after = self.next[state].get(word)
        return (0, 0) if after is None else (after, length + 1)


class Scanner:
    """The automaton of phrases and templates; one is made for each task."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] | None = None):
        given = all_templates() if templates is None else templates
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self.templates = [(WORDS.findall(t.encode().lower()), label) for label, texts in given.items() for t in texts]
        self.automaton = Automaton([words for words, _ in [*self.templates, *self.phrases]])
        self.vocabulary = frozenset(w for words, _ in [*self.templates, *self.phrases] for w in words)
        self.ending = self._ending()
        #: For each state, template -> the nearest state, itself or above, that the template has.
        self.holding: dict[int, dict[int, int]] = {}

    def _holding(self, state: int) -> dict[int, int]:
        found = self.holding.get(state)
        if found is None:
            found, above = {}, state
            while above > 0 and self.automaton.length[above] >= LEAST_MATCH:
                for number in self.automaton.ends[above]:
                    if number < len(self.templates):
                        found.setdefault(number, above)
                above = self.automaton.link[above]
            self.holding[state] = found
        return found

    def _ending(self) -> list[tuple[int, ...]]:
        """For each state the phrases that end its strings, as far as they are long enough."""
        own: dict[int, list[int]] = {}
        for number, (words, _) in enumerate(self.phrases):
            state = length = 0
            for word in words:
                state, length = self.automaton.step(state, length, word)
            own.setdefault(state, []).append(number)
        ending = []
        for state in range(len(self.automaton.link)):
            found, above = [], state
            while above > 0:
                found += own.get(above, [])
                above = self.automaton.link[above]
            ending.append(tuple(found))
        return ending

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[Found]]:
        """Number of words; places of phrases (first word, phrase), in order;
        spans of templates."""
        words = WORDS.findall(text.lower())
        hits = [i for i, w in enumerate(words) if w in self.vocabulary]
        places: list[tuple[int, int]] = []
        chains: dict[int, Chains] = {}
        #: template -> length and state of its longest match that ends at the previous word.
        current: dict[int, tuple[int, int]] = {}
        state = length = 0
        previous = -1

        def end(template: int) -> None:
            size, at = current[template]
            if template not in chains:
                chains[template] = Chains(len(self.templates[template][0]))
            chains[template].add(previous, size, self.automaton.ends[at][template])

        for i in hits:
            if i != previous + 1:
                for template in current:
                    end(template)
                current = {}
                state = length = 0
            state, length = self.automaton.step(state, length, words[i])
            if length >= LEAST_MATCH or current:
                longest = {}
                for template, at in self._holding(state).items() if length >= LEAST_MATCH else ():
                    longest[template] = min(length, self.automaton.length[at]), at
                for template, (size, _) in current.items():
                    if longest.get(template, (0, 0))[0] <= size:
                        end(template)
                current = longest
            previous = i
            for number in self.ending[state]:
                size = len(self.phrases[number][0])
                if length >= size:
                    places.append((i - size + 1, number))
        for template in current:
            end(template)
        return len(words), sorted(places), self.best(chains)

    def best(self, chains: dict[int, Chains]) -> list[Found]:
        """Of the spans that overlap, those that cover most."""
        spans = []
        for template, of in chains.items():
            size = of.size
            spans += [(covered, covered / size, -first, last, self.templates[template][1]) for first, last, covered in of.closed()]
        taken: list[tuple[int, int, int, float]] = []  # last word, first word, what it covers
        found = set()
        for covered, cover, start, last, label in sorted(spans, key=lambda s: (-s[0], -s[1], -s[2], s[3], s[4])):
            first = -start
            place = bisect_left(taken, (first,))
            if place < len(taken) and taken[place][1] <= last:
                if taken[place] != (last, first, covered, cover):
                    continue
            else:
                insort(taken, (last, first, covered, cover))
            found.add(Found(label, first, last, cover))
        return sorted(found, key=lambda f: (f.first, f.label, f.last))


class Chains:
    """Chains of one template's matches in a text. Matches come in the order of their ends."""

    def __init__(self, size: int):
        self.size = size
        #: First and last word of the text, last of the template, words covered, whether a longer one goes on from it.
        self.open: list[list] = []
        self.done: list[tuple[int, int, int]] = []

    def _close(self, chain: list) -> None:
        first, last, _, covered, extended = chain
        if not extended and (covered >= COVER * self.size or covered >= ENOUGH):
            self.done.append((first, last, covered))

    def add(self, last: int, length: int, ends: set[int]) -> None:
        """A match that ends at this word of the text and at these of the template."""
        first = last - length + 1
        still = []
        for chain in self.open:
            if first - chain[1] <= GAP + 1:
                still.append(chain)
            else:
                self._close(chain)
        added = []
        for end in sorted(ends):
            start, most, before = end - length + 1, length, None
            for chain in still:
                _, text_end, place, covered, _ = chain
                overlap = max(0, text_end - first + 1, place - start + 1)
                near = start - place <= GAP + 1 and end > place and last > text_end
                if near and length > overlap and covered + length - overlap > most:
                    most, before = covered + length - overlap, chain
            if before is not None:
                before[4] = True
            added.append([first if before is None else before[0], last, end, most, False])
        self.open = still + added

    def closed(self) -> list[tuple[int, int, int]]:
        """First and last word and words covered of every chain that covers enough."""
        for chain in self.open:
            self._close(chain)
        self.open = []
        return self.done


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all others), ``n_words``, ``phrases`` (each
    place: label, first word) and ``spans`` (label, first and last word, share of
    the template covered)."""
    place = pa.struct([("label", pa.string()), ("first", pa.int64())])
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("cover", pa.float64())])

    def make():
        scanner = Scanner()

        def run(contents: list[bytes]) -> list[pa.Array]:
            rows = [scanner.scan(x) for x in contents]
            return [
                pa.array([n for n, _, _ in rows], pa.int64()),
                pa.array(
                    [[{"label": scanner.phrases[p][1], "first": i} for i, p in found] for _, found, _ in rows],
                    pa.list_(place),
                ),
                pa.array([[f._asdict() for f in spans] for _, _, spans in rows], pa.list_(span)),
            ]

        return run

    added = (
        "n_words bigint, phrases array<struct<label:string,first:bigint>>,"
        " spans array<struct<label:string,first:bigint,last:bigint,cover:double>>"
    )
    return per_text(df, make, text, keep or [c for c in df.columns if c != text], added)
