"""Secret scans through an index of trigrams.

From each rule's expression a Boolean query over trigrams is derived that every
match must satisfy. For the texts of a slice, postings (trigram -> texts) are
made for the trigrams that occur in some query; the queries are evaluated on
the postings, and only the texts that come out are searched with the
expression. A rule without mandatory trigrams searches every text.

Trigrams are of UTF-8 bytes with A-Z lower-cased, so that one index serves rules
of either case. A null text is empty. Offsets are code points, the end
exclusive. Texts of any length are searched whole.
"""

from __future__ import annotations

import re
from re import _constants as sre
from re import _parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sylvatab.llm.common import per_text

#: A set of strings longer than this is no longer followed exactly.
EXACT = 64


class Rule(NamedTuple):
    """Finds the matches of ``pattern`` that do not overlap, leftmost first, and
    keeps those whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII


#: Kinds in the order that decides between spans of one start. Fixed values.
BASE = [
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
        re.ASCII | re.IGNORECASE,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # The same as [0-9a-f]+ of 32 or more: a longest run begins where the first match does.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
]
#: Formats of published kinds of secret beside the base.
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}=*", 0, 0, re.ASCII | re.IGNORECASE),
    Rule("url_login", r"[a-z][a-z0-9+]{1,20}://[^\s/:@]+:[^\s/:@]{3,}@[A-Za-z0-9.-]+"),
]


# A query is True (every text), a trigram, or ("and" | "or", queries).
Query = bool | int | tuple[str, frozenset]


def trigrams(text: str) -> list[int]:
    """Codes of the trigrams of a lower-cased string's bytes."""
    b = text.encode().lower()
    return [b[i] << 16 | b[i + 1] << 8 | b[i + 2] for i in range(len(b) - 2)]


def both(*queries: Query) -> Query:
    parts = frozenset(q for q in queries if q is not True)
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("and", parts)


def either(*queries: Query) -> Query:
    parts = frozenset(queries)
    return True if True in parts or not parts else next(iter(parts)) if len(parts) == 1 else ("or", parts)


def of_strings(strings: set[str]) -> Query:
    """What holds for a text that has one of the strings."""
    return either(*[both(*trigrams(s)) for s in strings]) if strings else True


def strings_of(op, arg) -> set[str] | None:
    """All strings that a part of an expression matches, if they are few."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN and len(arg) <= EXACT and all(x is sre.LITERAL for x, _ in arg):
        return {chr(c).lower() for _, c in arg}
    if op is sre.SUBPATTERN:
        return exact(arg[3])
    if op is sre.BRANCH:
        found = [exact(x) for x in arg[1]]
        return None if None in found else set().union(*found)
    if op is sre.MAX_REPEAT and arg[1] <= 4:
        once, out = exact(arg[2]), set()
        if once is None:
            return None
        for n in range(arg[0], arg[1] + 1):
            now = {""}
            for _ in range(n):
                now = {a + b for a in now for b in once}
                if len(now) > EXACT:
                    return None
            out |= now
        return out
    if op is sre.AT:
        return {""}
    return None


def exact(parts) -> set[str] | None:
    found = {""}
    for op, arg in parts:
        more = strings_of(op, arg)
        if more is None:
            return None
        found = {a + b for a in found for b in more}
        if len(found) > EXACT:
            return None
    return found


def of_part(op, arg) -> Query:
    """What a part needs by itself that is not a short list of strings."""
    if op is sre.SUBPATTERN:
        return of_parts(arg[3])
    if op is sre.BRANCH:
        return either(*[of_parts(x) for x in arg[1]])
    if op is sre.MAX_REPEAT and arg[0] >= 1:
        return of_parts(arg[2])
    return True


def of_parts(parts) -> Query:
    """Runs of parts that are lists of strings are joined; what stands between
    adds its own query."""
    needs, run = [], {""}
    for op, arg in parts:
        more = strings_of(op, arg)
        joined = None if more is None else {a + b for a in run for b in more}
        if joined is None or len(joined) > EXACT:
            needs += [of_strings(run), of_part(op, arg)] if more is None else [of_strings(run)]
            run = {""} if more is None else more
        else:
            run = joined
    return both(*needs, of_strings(run))


def trigram_query(pattern: str) -> Query:
    """The Boolean query over trigrams that each match of the pattern satisfies."""
    return of_parts(_parser.parse(pattern))


def needed(query: Query) -> set[int]:
    if query is True:
        return set()
    return {query} if isinstance(query, int) else set().union(*[needed(q) for q in query[1]])


class Scanner:
    """The rules with their queries; one is made for each task."""

    def __init__(self, rules: list[Rule]):
        self.rules = [(r, re.compile(r.pattern, r.flags), trigram_query(r.pattern)) for r in rules]
        wanted = sorted(set().union(*[needed(q) for _, _, q in self.rules]))
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[wanted] = True

    def postings(self, contents: list[bytes]) -> dict[int, set[int]]:
        """The texts that hold each wanted trigram."""
        found: dict[int, set[int]] = {}
        for text, content in enumerate(contents):
            # In parts that share two bytes, so that a very long text needs little more than itself.
            for start in range(0, max(len(content) - 2, 0), 1 << 20):
                b = np.frombuffer(content[start : start + (1 << 20) + 2].lower(), np.uint8).astype(np.uint32)
                codes = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
                for code in set(codes[self.wanted[codes]].tolist()):
                    found.setdefault(code, set()).add(text)
        return found

    def matching(self, query: Query, postings: dict[int, set[int]], every: set[int]) -> set[int]:
        if query is True:
            return every
        if isinstance(query, int):
            return postings.get(query, set())
        parts = [self.matching(q, postings, every) for q in query[1]]
        return set.intersection(*parts) if query[0] == "and" else set.union(*parts)

    def scan(self, contents: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text the spans (start, rule's place, end), in order."""
        postings, every = self.postings(contents), set(range(len(contents)))
        spans: list[list[tuple[int, int, int]]] = [[] for _ in contents]
        decoded: dict[int, str] = {}
        for place, (rule, find, query) in enumerate(self.rules):
            for text in self.matching(query, postings, every):
                if text not in decoded:
                    decoded[text] = contents[text].decode()
                for m in find.finditer(decoded[text]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        spans[text].append((m.start(), place, m.end()))
        return [sorted(x) for x in spans]


def scan(df: DataFrame, rules: list[Rule], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all others) and ``found``: the spans of
    each text, by start, then by the order of the rules."""
    kinds = [r.kind for r in rules]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def make():
        scanner = Scanner(rules)

        def run(contents: list[bytes]) -> list[pa.Array]:
            rows = [
                [{"kind": kinds[place], "start": start, "end": end} for start, place, end in spans]
                for spans in scanner.scan(contents)
            ]
            return [pa.array(rows, pa.list_(kind))]

        return run

    added = "found array<struct<kind:string,start:bigint,end:bigint>>"
    return per_text(df, make, text, keep or [c for c in df.columns if c != text], added)
