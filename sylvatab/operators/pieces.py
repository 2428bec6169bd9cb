"""Search keys: what two strings within a few edits of each other must share.

Three kinds of key, each a number hashed from the block (the genus), the kind and
a text, so that the search is one equi-join:

* kind 1: strings within one edit agree after a character is taken from either or
  both, so both give themselves and themselves without one character.
* kind 2: the same with two characters, for strings up to ``DELETES_UP_TO`` long. Where
  the genus is no part of the hash, strings are longer and two with ``ENDS_FROM``
  characters or more meet by their ends instead (:func:`_end_keys`), a third as many keys.
* kind 3 and more, for ``k`` edits: a string cut into ``m = k div 2 + 1`` parts
  has a part with one edit at most, before which ``2i`` or ``2i + 1 - e`` edits lie
  (``i`` parts before it, ``e`` edits in it). Entries give their parts and these
  without one character, names the substrings that can stand for such a part, whole
  or without one character. The kind is ``m + 1``.

So every pair within ``k`` edits shares a key, and those that share one are few:
their keys are whole strings or, from three edits on, parts of a third or half.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A string of this length without two characters has some 800 forms.
DELETES_UP_TO = 40

#: The ends of strings of this length or more make their keys of kind 2.
ENDS_FROM = 9
#: Characters at the end that may have edits, and for pairs whose shorter string has so
#: many characters at least and at most those at the start that have none if both are there.
ENDING = 8
STARTS = [(9, 10, 1), (11, 14, 3), (15, 1 << 30, 7)]


def edit_limit(key: Column, max_distance: float) -> Column:
    """Edits allowed for a name: a fraction below 1 counts per character and is
    rounded up, a number from 1 on is taken as it is. The share as a fraction
    keeps 0.1 of 70 characters at exactly 7. Never null, like the key."""
    if max_distance >= 1:
        return F.lit(int(max_distance))
    share = Fraction(str(max_distance))
    limit = F.ceil(F.length(key) * share.numerator / F.lit(share.denominator)).cast("int")
    return F.coalesce(limit, F.lit(0))


def limits_near(length: Column, max_distance: float) -> tuple[Column, Column]:
    """The fewest and the most edits that a name within its limit of an entry of this
    length can have as its limit."""
    if max_distance >= 1:
        return F.lit(int(max_distance)), F.lit(int(max_distance))
    share = Fraction(str(max_distance))
    a, b = F.lit(share.numerator), F.lit(share.denominator)
    # A name of length m allows k = ceil(m a / b) edits and is at most k off in length:
    # (length - k) a <= k b for the shortest, (length + k) a > (k - 1) b for the longest.
    fewest = F.ceil(length * a / (a + b)).cast("int")
    return fewest, (F.ceil((length * a + b) / (b - a)) - 1).cast("int")


def genus_of(key: str) -> Column:
    return F.substring_index(key, " ", 1)


def letters(text: str) -> Column:
    """A long with two bits for each of the letters a to z in a column: it occurs,
    and it occurs twice or more. Adding or removing a letter changes one bit at most."""
    one, two = (f"shiftleft({n}L, 2 * (ascii(c) - 97))" for n in (1, 3))
    seen = f"IF(c BETWEEN 'a' AND 'z', x | IF((x & {one}) = 0, {one}, {two}), x)"
    return F.expr(f"aggregate(split({text}, ''), 0L, (x, c) -> {seen})")


def neighbours(text: str) -> Column:
    """A long with a bit, taken from its hash, for each two characters of a column that follow
    each other. Adding or removing a character changes three bits at most, replacing one four."""
    two = f"pmod(xxhash64(substring({text}, i, 2)), 64L)"
    return F.expr(f"aggregate(sequence(1, greatest(1, length({text}) - 1)), 0L, (x, i) -> x | shiftleft(1L, int({two})))")


def search_form(df: DataFrame, match_genus: bool) -> DataFrame:
    """``key`` with ``genus`` (empty where any will do) and ``body``, what follows
    it: a common start does not change the edits."""
    genus = genus_of("key") if match_genus else F.lit("")
    skip = F.length(genus) + 1 if match_genus else F.lit(1)
    return df.select("*", genus.alias("genus"), F.substring(F.col("key"), skip, F.length("key")).alias("body"))


def _hashed(texts: str, kind: str) -> str:
    """Distinct keys of an array of texts."""
    return f"array_distinct(transform({texts}, v -> xxhash64(genus, {kind}, v)))"


def _without_one(text: str, name: str = "i") -> str:
    size = f"length({text})"
    drop = f"concat(substring({text}, 1, {name} - 1), substring({text}, {name} + 1, {size}))"
    return f"IF({size} = 0, array(), transform(sequence(1, greatest(1, {size})), {name} -> {drop}))"


_ONE = f"concat(array(body), {_without_one('body')})"
_TWO = """IF(n < 2, array(), flatten(transform(sequence(1, greatest(1, n - 1)), i ->
  transform(sequence(i + 1, greatest(2, n)), j -> concat(
    substring(body, 1, i - 1), substring(body, i + 1, j - i - 1), substring(body, j + 1, n))))))"""


def _end_keys() -> str:
    """Keys of kind 2 of a body of ``ENDS_FROM`` characters or more.

    Take as many characters from the start of two strings as from the end of them, without
    overlap: the edits at one end are not those at the other. Characters of one
    start that the other does not have are as many as there are edits at most, and
    as many in either; so with the ends. Of two edits, at most one lies at the end,
    and the last characters agree as they are or without one in each, or both do: then
    these agree without two, and the first characters agree as they are.
    """
    last = f"right(body, {ENDING})"
    drop = "concat(substring({0}, 1, i - 1), substring({0}, i + 1, {1}))"
    one = f"transform(sequence(1, {ENDING}), i -> xxhash64(genus, 2, 'end', {drop.format(last, ENDING)}))"
    keys = [f"array(xxhash64(genus, 2, 'end', {last}))", one]
    two = f"""flatten(transform(sequence(1, {ENDING - 1}), i -> transform(sequence(i + 1, {ENDING}), j -> concat(
      substring({last}, 1, i - 1), substring({last}, i + 1, j - i - 1), substring({last}, j + 1, {ENDING})))))"""
    for shortest, longest, start in STARTS:
        first = f"left(body, {start})"
        # A long start tells enough by itself.
        texts = f"transform({two}, v -> concat({first}, v))" if start < ENDING - 1 else f"array({first})"
        within = f"n >= {shortest} AND n <= {longest + 2}"
        keys.append(f"IF({within}, transform({texts}, v -> xxhash64(genus, 2, {shortest}, v)), array())")
    return f"array_distinct(concat({', '.join(keys)}))"


def _two_keys(longest: int, match_genus: bool, short: str = "TRUE") -> str:
    """Keys of kind 2 of a body up to ``longest``. Where ends make keys, pairs with a body
    shorter than ``ENDS_FROM`` still meet by the whole, if ``short`` says that there may be any."""
    whole = _hashed(f"concat({_ONE}, {_TWO})", "2")
    if not match_genus:
        whole = f"""concat(IF(n < {ENDS_FROM} OR n < {ENDS_FROM} + 2 AND {short}, {whole}, array()),
          IF(n >= {ENDS_FROM}, {_end_keys()}, array()))"""
    return f"IF(n <= {longest}, {whole}, array())"


def _size(length: str) -> str:
    """Part i of a string cut into m parts: all have length div m characters, the
    last length mod m of them one more."""
    return f"({length} div m + IF(i >= m - {length} % m, 1, 0))"


def _start(length: str) -> str:
    return f"(i * ({length} div m) + greatest(0, i - (m - {length} % m)))"


_ENTRY_PARTS = f"""transform(sequence(0, m - 1), i ->
  substring(body, int({_start('n')} + 1), int({_size('n')})))"""

# Substrings of a name of length n with k edits that can stand for part i of an entry
# of length s: where they start, how long they are, and whether the part has an edit (p).
_PLACES = f"""flatten(transform(sequence(greatest(0, n - k, shortest), greatest(n + k, shortest)), s ->
  flatten(transform(sequence(0, m - 1), i -> flatten(transform(sequence(-2 * i - 1, 2 * i + 1), t ->
    filter(transform(sequence(0, 3), c -> named_struct(
      'i', i, 'at', int({_start('s')} + t), 'size', int({_size('s')} + IF(c = 0, 0, c - 2)), 'p', IF(c = 0, 0, 1), 'off',
        abs(n - s - t - IF(c = 0, 0, c - 2)), 't', abs(t))),
      x -> x.at >= 0 AND x.size >= 0 AND x.at + x.size <= n AND x.t <= 2 * i + 1 - x.p AND x.off <= k - 2 * i - x.p)))))))"""

_NAME_PARTS = f"""array_distinct(flatten(transform(transform(places, x -> named_struct(
    'i', x.i, 'p', x.p, 'piece', substring(body, x.at + 1, x.size))), x ->
  transform(IF(x.p = 0, array(x.piece), {_without_one('x.piece', 'z')}), v -> xxhash64(genus, m + 1, x.i, v)))))"""


def word_forms(words: DataFrame, of: str, most: int) -> DataFrame:
    """Rows once for each text (``form``) that a word of column ``of`` gives with up to
    ``most`` (one or two) characters left out."""
    n = F.length(of)
    df = words.withColumn("i", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), n - 1 if most > 1 else F.lit(0)))))
    df = df.withColumn("j", F.explode(F.sequence(F.when(F.col("i") == 0, 0).otherwise(F.col("i") + 1), n)))
    form = f"concat(substring({of}, 1, i - 1), substring({of}, i + 1, j - i - 1), substring({of}, j + 1, length({of})))"
    return df.withColumn("form", F.expr(form)).drop("i", "j")


def word_splits(words: DataFrame, kept: DataFrame, start: bool) -> DataFrame:
    """``word`` with each of its starts (or ends) that is a ``word`` of ``kept`` and shorter: ``part``,
    and the ``other`` characters."""
    cut = words.filter("length(word) > 1").select("word", F.explode(F.expr("sequence(1, length(word) - 1)")).alias("i"))
    sides = F.expr("substring(word, 1, i)"), F.expr("substring(word, i + 1, length(word))")
    part, other = sides if start else sides[::-1]
    cut = cut.select("word", part.alias("part"), other.alias("other"))
    return cut.join(kept.select(F.col("word").alias("part")), "part", "left_semi").select("word", "part", "other")


def entry_keys(
    entries: DataFrame, distances: list[float], match_genus: bool, edits: range | None = None
) -> DataFrame:
    """Rows of ``entries`` (in search form) once for each key: ``kind`` and ``h``, for
    searches up to these distances and of names with these edits, any if None. Kinds
    that no name within its limit of the entry looks for are not made; names with
    more than two edits may also be searched within two."""
    kinds = None if edits is None else sorted({kind for k in edits for kind in kinds_of(k)})
    limits = [limits_near(F.length("key"), d) for d in distances]
    df = entries.withColumn("n", F.length("body"))
    df = df.withColumn("fewest", F.least(F.lit(1 << 30), *[x for x, _ in limits]))
    most = F.greatest(F.lit(0), *[x for _, x in limits])
    df = df.withColumn("most", most if edits is None else F.least(F.lit(edits[-1]), most))
    # May a name shorter than ENDS_FROM have two edits?
    short = any(d >= 2 or d < 1 and Fraction(str(d)) * (ENDS_FROM - 1) > 1 for d in distances)
    arrays = []

    def add(kind: int, keys: str, condition: str) -> None:
        if kinds is None or kind in kinds:
            keys = f"IF({condition}, {keys}, array())"
            arrays.append(F.expr(f"transform({keys}, h -> named_struct('kind', {kind}, 'h', h))"))

    add(1, _hashed(_ONE, "1"), "fewest <= 1 AND most >= 1")
    add(2, _two_keys(DELETES_UP_TO, match_genus, str(short)), "most >= 2")
    if kinds is None or max(kinds) > 2:
        parts = f"flatten(transform({_ENTRY_PARTS}, (v, i) -> transform(concat(array(v), {_without_one('v', 'z')}), w -> xxhash64(genus, m + 1, i, w))))"
        # m parts serve 2m - 2 and 2m - 1 edits; two edits only where kind 2 does not.
        counts = "sequence(2, int(greatest(2, most div 2 + 1)))"
        wanted = "" if kinds is None else f" AND array_contains(array({','.join(map(str, kinds))}), m + 1)"
        each = f"transform(array_distinct({parts}), h -> named_struct('kind', m + 1, 'h', h))"
        needed = f"(m = 2 AND n > {DELETES_UP_TO} OR most >= 3 AND m > fewest div 2)"
        arrays.append(F.expr(f"IF(most < 2, array(), flatten(transform(filter({counts}, m -> {needed}{wanted}), m -> {each})))"))
    keys = F.explode(F.concat(*arrays)).alias("x")
    return df.select(*[F.col(f"`{c}`") for c in entries.columns], keys).select("*", "x.kind", "x.h").drop("x")


def name_keys(names: DataFrame, kinds: list[int], match_genus: bool, places: DataFrame | None) -> DataFrame:
    """Rows of ``names`` (in search form, with ``edits`` and ``n``) once for each of the keys
    of these kinds that their edits call for. From kind 3 on, :func:`name_places`
    of the names are needed."""
    df, arrays = names.withColumn("k", F.col("edits")), []
    if 1 in kinds:
        arrays.append(F.expr(f"transform(IF(k = 1, {_hashed(_ONE, '1')}, array()), h -> named_struct('kind', 1, 'h', h))"))
    if 2 in kinds:
        two = f"IF(k = 2, {_two_keys(DELETES_UP_TO + 2, match_genus)}, array())"
        arrays.append(F.expr(f"transform({two}, h -> named_struct('kind', 2, 'h', h))"))
    if places is not None:
        df = df.join(places, ["n", "edits"], "left").withColumn("m", F.expr("int(k div 2 + 1)"))
        parts = f"IF(places IS NULL, array(), {_NAME_PARTS})"
        arrays.append(F.expr(f"transform({parts}, h -> named_struct('kind', m + 1, 'h', h))"))
    keys = F.explode(F.concat(*arrays)).alias("x")
    return df.select(*[F.col(f"`{c}`") for c in names.columns], keys).select("*", "x.kind", "x.h").drop("x")


def name_places(names: DataFrame, kinds: list[int]) -> DataFrame | None:
    """``n``, ``edits`` and ``places``: where names (in search form) may have what stands for a
    part of an entry. That depends on the length and the edits only, so there is a
    row for each of the few pairs of these."""
    if max(kinds) <= 2:
        return None
    df = names.select("n", "edits").distinct().withColumn("k", F.col("edits")).withColumn("m", F.expr("int(k div 2 + 1)"))
    df = df.withColumn("shortest", F.when(F.col("k") == 2, DELETES_UP_TO + 1).otherwise(0))
    df = df.filter(F.expr(f"k >= 2 AND n + k >= shortest AND array_contains(array({','.join(map(str, kinds))}), m + 1)"))
    place = F.expr("array_distinct(transform(x, y -> named_struct('i', y.i, 'at', y.at, 'size', y.size, 'p', y.p)))")
    return df.withColumn("x", F.expr(_PLACES)).select("n", "edits", place.alias("places"))


def kinds_of(edits: int) -> list[int]:
    """The kinds of key that names with these edits need."""
    if edits <= 1:
        return [1]
    return [2, 3] if edits == 2 else [edits // 2 + 2]
