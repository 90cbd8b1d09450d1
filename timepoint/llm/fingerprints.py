"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

A paragraph (a line between two \\n, also an empty one) has a wide vector: ``EXACT`` lanes of
128 hashed bits of the whole paragraph, modulo 2^32, and ``LIKE`` lanes that add +1 or -1, a
hashed bit, for every different run of three words in it, modulo 2^20. A text's vector is the
sum of its paragraphs' vectors, so it doesn't depend on their order, and a paragraph is put in
or taken out by one addition or subtraction: ``added`` and ``removed`` do it to fingerprints.
The cosine of two sums of signs estimates how much of their word runs two texts share; its
standard error is 1 / sqrt(LIKE), and equal fingerprints have likeness 1.

The edit is computed as one: the paragraphs before the cut are summed once, and the text and
its edited form add what they have beyond them.

Only DataFrame functions are used. Each text crosses the network once, to the one joined
with it; of the next document only the characters that the edit takes cross it, and its sums.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import durable
from timepoint.operators.ranking import running_totals

#: Lanes and their hexadecimal digits in a fingerprint; a lane is modulo 16 ** digits.
EXACT, EXACT_DIGITS = 4, 8
LIKE, LIKE_DIGITS = 128, 5
_BITS = 4 * LIKE_DIGITS
_LANE = (1 << _BITS) - 1
RUN = 3
_BLANK = r"[\x20\x09-\x0D]+"
#: Two counts of 32 bits in a long: bits 0 and 32 of a hash that was shifted.
_TWO = 0x0000000100000001
_LOW = 0xFFFFFFFF
_KEEP, _REST, _NEW = 0, 1, 2
_KEY = ("_none", "_id", "_tie")
_PREV = tuple(f"_prev{c}" for c in _KEY)
_META = (*_KEY, *_PREV, "_rows", "n_chars", "edited_sha256")


def _elements(paragraphs: Column) -> Column:
    """Two hashes of each paragraph, first the one of all, then the other, then their word runs'."""

    def runs(paragraph: Column) -> Column:
        words = F.filter(F.split(paragraph, _BLANK), lambda w: w != "")

        def hashed(w: Column) -> Column:
            places = F.sequence(F.lit(0), F.greatest(F.size(w) - RUN, F.lit(0)))
            run = F.transform(places, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(RUN))))
            return F.when(F.size(w) > 0, F.array_distinct(run)).otherwise(F.array().cast("array<bigint>"))

        return _once(words, hashed)

    return F.concat(
        F.transform(paragraphs, lambda p: F.xxhash64(p)),
        F.transform(paragraphs, lambda p: F.xxhash64(F.lit(1), p)),
        F.flatten(F.transform(paragraphs, runs)),
    )


def _summed(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``sums`` per ``keys`` of the paragraphs in ``_p``; rows of one key lie together already.

    They are the exact lanes, two counts of bits in each long, and the number of runs.
    """
    n = F.col("_n_p")
    run = F.col("_at") >= 2 * n
    elements = (
        # the array is a column of its own, or every row that comes of it carries the text
        rows.select(*keys, F.size("_p").alias("_n_p"), _elements(F.col("_p")).alias("_e"))
        .select(*keys, "_n_p", F.posexplode_outer("_e").alias("_at", "_h"))
        .select(
            *keys,
            F.when(F.col("_at") < n, F.col("_h")).otherwise(0).alias("_one"),
            F.when((F.col("_at") >= n) & ~run, F.col("_h")).otherwise(0).alias("_two"),
            F.when(run, F.col("_h")).otherwise(0).alias("_a"),
            F.when(run, F.xxhash64("_h")).otherwise(0).alias("_b"),
            F.when(run, 1).otherwise(0).alias("_runs"),
        )
    )
    exact = [
        F.sum(half)
        for h in ("_one", "_two")
        for half in (F.col(h).bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(h, 32))
    ]
    ones = [
        F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_TWO))) for h in ("_a", "_b") for k in range(32)
    ]
    return elements.groupBy(*keys).agg(F.array(*exact, *ones, F.sum("_runs")).alias("sums"))


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _lanes(sums: Column) -> Column:
    """Lanes of summed elements, two in a long: exact ones, then +1 and -1 counted from bits."""

    def packed(s: Column) -> Column:
        def pair(ones: Column) -> Column:
            n = F.element_at(s, -1)
            return _pair(2 * ones.bitwiseAND(F.lit(_LOW)) - n, 2 * F.shiftrightunsigned(ones, 32) - n)

        exact = [
            F.shiftleft(s[k].bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(s[k + 1].bitwiseAND(F.lit(_LOW)))
            for k in range(0, EXACT, 2)
        ]
        return F.concat(F.array(*exact), F.transform(F.slice(s, EXACT + 1, LIKE // 2), pair))

    return _once(sums, packed)


def _pair(one: Column, two: Column) -> Column:
    """Two lanes in a long, each modulo 2^20."""
    return F.shiftleft(one.bitwiseAND(F.lit(_LANE)), _BITS).bitwiseOR(two.bitwiseAND(F.lit(_LANE)))


def _signs(pair: Column) -> tuple[Column, Column]:
    """Two lanes of a long, as numbers around zero."""
    up = 64 - _BITS
    return F.shiftright(F.shiftleft(pair, up - _BITS), up), F.shiftright(F.shiftleft(pair, up), up)


def _text_of(lanes: Column) -> Column:
    """The fingerprint: every lane in hexadecimal digits of fixed number."""
    exact = F.transform(F.slice(lanes, 1, EXACT // 2), lambda x: F.lpad(F.hex(x), 2 * EXACT_DIGITS, "0"))
    like = F.transform(F.slice(lanes, EXACT // 2 + 1, LIKE // 2), lambda x: F.lpad(F.hex(x), 2 * LIKE_DIGITS, "0"))
    return F.lower(F.array_join(F.concat(exact, like), ""))


def lanes_of(fingerprint: Column) -> Column:
    """The lanes of a fingerprint, two in a long."""

    def cut(n: int, digits: int, start: int) -> Column:
        places = F.sequence(F.lit(start + 1), F.lit(start + 1 + (n - 1) * digits), F.lit(digits))
        half = digits // 2

        def number(at: Column, more: int) -> Column:
            return F.conv(F.substr(fingerprint, at + more, F.lit(half)), 16, 10).cast("long")

        return F.transform(places, lambda at: F.shiftleft(number(at, 0), 4 * half).bitwiseOR(number(at, half)))

    exact = cut(EXACT // 2, 2 * EXACT_DIGITS, 0)
    return F.concat(exact, cut(LIKE // 2, 2 * LIKE_DIGITS, EXACT * EXACT_DIGITS))


def _combined(one: Column, two: Column, sign: int) -> Column:
    def exact(x: Column, y: Column) -> Column:
        high = F.shiftrightunsigned(x, 32) + sign * F.shiftrightunsigned(y, 32)
        low = x.bitwiseAND(F.lit(_LOW)) + sign * y.bitwiseAND(F.lit(_LOW))
        return F.shiftleft(high.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))

    def like(x: Column, y: Column) -> Column:
        (a, b), (c, d) = _signs(x), _signs(y)
        return _pair(a + sign * c, b + sign * d)

    both = F.array(lanes_of(one), lanes_of(two))

    def lanes(l: Column) -> Column:
        n = EXACT // 2
        return F.concat(
            F.zip_with(F.slice(l[0], 1, n), F.slice(l[1], 1, n), exact),
            F.zip_with(F.slice(l[0], n + 1, LIKE // 2), F.slice(l[1], n + 1, LIKE // 2), like),
        )

    return _text_of(_once(both, lanes))


def added(one: Column, two: Column) -> Column:
    """Fingerprint of the paragraphs of both; NULL if either is."""
    return _combined(one, two, 1)


def removed(one: Column, two: Column) -> Column:
    """Fingerprint of the first's paragraphs without the second's; NULL if either is."""
    return _combined(one, two, -1)


def _dot(a: Column, b: Column) -> Column:
    def product(x: Column, y: Column) -> Column:
        (a, b), (c, d) = _signs(x), _signs(y)
        return a * c + b * d

    like = [F.slice(lanes, EXACT // 2 + 1, LIKE // 2) for lanes in (a, b)]
    return F.aggregate(F.zip_with(*like, product), F.lit(0).cast("long"), lambda s, x: s + x).cast("double")


def _likeness(a: Column, b: Column) -> Column:
    def cosine(d: Column) -> Column:
        norm = F.sqrt(d[0]) * F.sqrt(d[1])
        return F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), d[2] / norm))).otherwise(0.0)

    dots = F.array(_dot(a, a), _dot(b, b), _dot(a, b))
    return F.when(a == b, 1.0).otherwise(_once(dots, cosine))


def likeness(one: Column, two: Column) -> Column:
    """0 to 1: how much of their word runs the texts of two fingerprints share; equal ones 1."""
    both = F.array(lanes_of(one), lanes_of(two))
    return _once(both, lambda l: _likeness(l[0], l[1]))


def fingerprints(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys, fingerprint) per row of ``docs``, of the whole text; NULL counts as empty.

    ``keys`` should name rows; rows with equal keys give one fingerprint, of all their
    paragraphs together.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(*keys, F.split(whole, "\n").alias("_p"))
    return _summed(rows, keys).select(
        *keys, _text_of(_lanes(F.col("sums"))).alias("fingerprint")
    )


def _neighbours(named: DataFrame) -> DataFrame:
    """Per document the one before it in the order, and how many characters that one takes.

    Order: descending doc_id, NULL last, equal ids by a hash of their texts; the first follows
    the last. Only ids and lengths are sorted.
    """
    ids = named.groupBy(*_KEY).agg(F.max(F.char_length("text")).alias("_n"))
    order = [F.col("_none"), F.col("_id").desc(), F.col("_tie")]
    placed = durable(
        running_totals(ids.withColumn("_one", F.lit(1)), order, ["_one"]).select(
            *_KEY, "_n", F.col("cum__one").alias("_at")
        )
    )
    n = placed.count()
    if not n:
        return placed.select(*_KEY, *(F.col(c).alias(f"_prev{c}") for c in _KEY), F.col("_n").alias("_takes"))
    before = placed.select(
        (F.col("_at") % n + 1).alias("_at"),
        *(F.col(c).alias(f"_prev{c}") for c in _KEY),
        F.floor(F.col("_n") / 2).cast("int").alias("_takes"),
    )
    return placed.join(before, "_at").select(*_KEY, *_PREV, "_takes")


def edited(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how like both and the next one are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, one row per row of ``docs``. The edited text has its last floor(n_chars / 2)
    code points replaced by the first as many (or all) of the next document's.

    NULL texts are empty. Documents come by descending doc_id, NULL ids last, equal ids by a
    hash of their texts; rows that repeat an id and a text are one document, and each gets its
    result. A sole document follows itself. Two empty texts have likeness 1, an empty one and
    another 0; texts without white space are one run of words each. No documents give no
    rows. Columns beyond doc_id and text aren't looked at.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.select(
        F.col("doc_id").isNull().alias("_none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
        text.alias("text"),
    ).withColumn("_tie", F.xxhash64("text"))
    links = _neighbours(named)
    own = (
        named.groupBy(*_KEY)
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("_rows"))
        .join(links, [*_KEY])
    )
    # asks for the same columns as the other use of ``own``, so that both read one exchange
    start = F.when(F.col("_rows") > 0, F.left("text", "_takes"))
    starts = own.select(
        *(F.col(f"_prev{c}").alias(c) for c in _KEY), start.alias("_start")
    )
    n = F.char_length("text")
    pieces = (
        own.drop("_takes")
        .join(starts, [*_KEY])
        .withColumn("n_chars", n.cast("long"))
        .withColumn("_head", F.left("text", n - F.floor(n / 2).cast("int")))
        .withColumn("edited_sha256", F.sha2(F.concat("_head", "_start"), 256))
        .withColumn("_cut", F.char_length("_head") - F.char_length(F.substring_index("_head", "\n", -1)))
    )
    # whole paragraphs before the cut, then what follows them in the text and in the edited one
    before = F.left("text", F.col("_cut") - 1)
    parts = F.array(
        F.struct(F.lit(_KEEP).alias("piece"), F.when(F.col("_cut") > 0, before).alias("s")),
        F.struct(F.lit(_REST).alias("piece"), F.expr("substring(text, _cut + 1)").alias("s")),
        F.struct(
            F.lit(_NEW).alias("piece"),
            F.concat(F.expr("substring(_head, _cut + 1)"), "_start").alias("s"),
        ),
    )
    # columns of their own, and no filter that Spark would compute them for again (explode_outer)
    pieces = pieces.select(*_META, F.filter(parts, lambda p: p["s"].isNotNull()).alias("_parts"))
    split = pieces.select(*_META, F.explode_outer("_parts").alias("_s")).select(
        *_META, F.col("_s.piece").alias("piece"), F.split("_s.s", "\n").alias("_p")
    )
    sums = _summed(split, (*_META, "piece"))
    by_piece = sums.groupBy(*_META).agg(F.collect_list(F.struct("piece", "sums")).alias("_by"))

    def total(wanted: int) -> Column:
        chosen = F.filter(F.col("_by"), lambda p: p["piece"].isin(_KEEP, wanted))
        zero = F.array_repeat(F.lit(0).cast("long"), EXACT + LIKE // 2 + 1)
        return _lanes(F.aggregate(chosen, zero, lambda s, p: _added(s, p["sums"])))

    # each document's row goes to itself and, with nothing but its lanes, to the one before
    both = by_piece.select(*_META, total(_REST).alias("_own"), total(_NEW).alias("_new")).select(
        F.explode(
            F.array(
                F.struct(
                    *_KEY, F.lit(False).alias("_next"), "_own", "_new", "_rows", "n_chars", "edited_sha256"
                ),
                F.struct(
                    *(F.col(f"_prev{c}").alias(c) for c in _KEY),
                    F.lit(True).alias("_next"),
                    F.col("_own"),
                    F.lit(None).cast("array<bigint>").alias("_new"),
                    F.lit(None).cast("bigint").alias("_rows"),
                    F.lit(None).cast("bigint").alias("n_chars"),
                    F.lit(None).cast("string").alias("edited_sha256"),
                ),
            )
        ).alias("_r")
    ).select("_r.*")
    mine = F.collect_list(F.when(~F.col("_next"), F.struct("_own", "_new", "_rows", "n_chars", "edited_sha256")))
    theirs = F.collect_list(F.when(F.col("_next"), F.col("_own")))
    met = both.groupBy(*_KEY).agg(mine.alias("_mine"), theirs.alias("_theirs")).select(
        *_KEY, F.col("_mine")[0].alias("_m"), F.col("_theirs")[0].alias("_after")
    )
    return met.select(
        F.when(~F.col("_none"), F.col("_id")).alias("doc_id"),
        "_m.n_chars",
        "_m.edited_sha256",
        _text_of(F.col("_m._own")).alias("fingerprint"),
        _text_of(F.col("_m._new")).alias("edited_fingerprint"),
        _likeness(F.col("_m._own"), F.col("_m._new")).alias("near_edited"),
        _likeness(F.col("_m._own"), F.col("_after")).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("_m._rows"))).alias("_copy"),
    ).drop("_copy")


def insertion(fingerprint: Column, paragraphs: list[Column]) -> Column:
    """``fingerprint`` after putting in the texts whose fingerprints are given."""
    return reduce(added, paragraphs, fingerprint)


def deletion(fingerprint: Column, paragraphs: list[Column]) -> Column:
    """``fingerprint`` after taking out the texts whose fingerprints are given."""
    return reduce(removed, paragraphs, fingerprint)
