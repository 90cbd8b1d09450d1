"""Spelling variants: words one code point apart, found in an FM-index by search schemes.

A word that is one inserted, deleted or replaced code point away has either half of the query
unchanged: the first half at its start or the second at its end. So one scheme matches the
first half exactly from the word's start and goes on to the right with at most one error, the
other matches the second half exactly from the word's end and goes on to the left. Both run
on intervals of suffix ranks in an index of the delimited vocabulary; as a scheme starts at a
delimiter, the two directions of the bidirectional index are two plain ones, over the words
and over the words read backwards.

The vocabulary is dealt by halves: a word lies, for each side, under the halves that a query
near it can have, and a query goes to its own two halves. A half with more than ``CHUNK`` words
is split by a hash of the words and its queries visit each part, so the work grows with queries
times parts, never with pairs of words: an index is searched, not scanned. What a visit sends
on is one row, the number of near words and the best of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import ascii_lower, durable

RUN = r"[A-Za-zÀ-ÿ]+"
DRAWN, SHORTEST, RAREST, TIMES = 31, 7, 2, 10
#: Entries of one index on average, and the words of one half that it may hold.
CHUNK = 1 << 15
#: Queries searched together, and the width up to which an interval's symbols are read off.
BATCH, NARROW = 4096, 24


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """(word, n): words of at least ``shortest`` code points that occur ``rarest`` times or more.

    Runs of letters are lower-cased (A-Z only); where 31 divides the CRC-32 of
    "<doc_id>:<run>" one code point, drawn by the same number, is left out. A NULL doc_id reads
    as nothing, a NULL text has no words.
    """
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # a column of its own, which Spark computes once and does not carry the text beside
    lists = docs.select(ids.alias("id"), runs.alias("runs"))
    rows = lists.select("id", F.explode_outer("runs").alias("run")).filter(F.char_length("run") >= shortest)
    rows = rows.withColumn("run", ascii_lower(F.col("run")))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    place = (F.col("h") % F.char_length("run")).cast("int")
    without = F.concat(F.left("run", place), F.substr("run", place + 2))
    words = rows.select(F.when(F.col("h") % DRAWN == 0, without).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= rarest)


def _ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of sum(sizes) places the row it belongs to and its number in the row."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the words, one after the other, and where each word starts (and ends)."""
    data = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return data, np.concatenate(([0], np.cumsum([len(w) for w in words])))


class Index:
    """FM-index of distinct words, each between delimiters, which are the smallest symbol.

    Searched from the end of a word to its start. ``words`` come in code-point order, so the
    suffixes that start with a delimiter have the order of the words behind them.
    """

    def __init__(self, words: list[str]) -> None:
        self.words = words
        data, bounds = letters(words)
        self.alphabet = np.concatenate(([0], np.unique(data)))
        n, k = len(data) + len(words) + 1, len(words)
        text = np.zeros(n, np.int64)
        place = np.arange(len(data)) + 1 + np.repeat(np.arange(k), np.diff(bounds))
        text[place] = np.searchsorted(self.alphabet, data)
        order = self._suffixes(text, k)
        self._size = n
        self.before = text[order - 1]  # the symbol in front of each suffix, in their order
        sigma = len(self.alphabet)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        blocks = n // 64 + 1
        self._bits = np.zeros((sigma, blocks), np.uint64)
        at = np.arange(n)
        np.bitwise_or.at(
            self._bits, (self.before, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64)
        )
        self._ranks = np.zeros((sigma, blocks), np.int64)
        np.cumsum(np.bitwise_count(self._bits[:, :-1]), axis=1, out=self._ranks[:, 1:])

    @staticmethod
    def _suffixes(text: np.ndarray, k: int) -> np.ndarray:
        """Start of every suffix in order, by doubling; delimiters rank by their place."""
        n = len(text)
        rank = text + k
        ends = np.flatnonzero(text == 0)
        rank[ends] = np.append(np.arange(1, k + 1), 0)  # the last has nothing behind it
        rank = np.unique(rank, return_inverse=True)[1]
        step = 1
        while True:
            behind = np.zeros(n, np.int64)
            behind[: n - step] = rank[step:] + 1
            key = rank * (n + 1) + behind
            order = np.argsort(key, kind="stable")
            fresh = np.empty(n, np.int64)
            fresh[order] = np.cumsum(np.append(0, np.diff(key[order]) != 0))
            if fresh[order[-1]] == n - 1:
                return order
            rank, step = fresh, step * 2

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in front of the suffixes before the ``at``-th."""
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._ranks[symbol, block] + np.bitwise_count(self._bits[symbol, block] & below)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of what starts with ``symbol`` and goes on as the intervals given."""
        start = self.starts[symbol]
        return start + self._rank(symbol, low), start + self._rank(symbol, high)

    def symbols(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (row, symbol) that stand in front of an interval, delimiters left out."""
        wide = high - low > NARROW
        rows, k = _ragged(np.where(wide, 0, high - low))
        seen = self.before[low[rows] + k]
        many = np.flatnonzero(wide)
        sigma = len(self.alphabet)
        pairs = np.concatenate(
            [
                np.unique(rows * sigma + seen),
                (many[:, None] * sigma + np.arange(sigma)).ravel(),
            ]
        )
        rows, symbol = pairs // sigma, pairs % sigma
        rows, symbol = rows[symbol > 0], symbol[symbol > 0]
        return rows, symbol

    def coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words as symbols (-1: not in the alphabet) and their bounds."""
        data, bounds = letters(words)
        place = np.searchsorted(self.alphabet, data)
        place = np.where(place < len(self.alphabet), place, 0)
        return np.where(self.alphabet[place] == data, place, -1), bounds

    def near(self, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (query, word) of which the last ``exact`` code points agree and one before differs.

        Exactly one code point is inserted, deleted or replaced; each pair is given once.
        """
        data, bounds = self.coded(queries)
        size = np.diff(bounds)
        end = bounds[1:]

        def symbol_at(q: np.ndarray, used: np.ndarray) -> np.ndarray:
            return data[end[q] - 1 - used]

        q = np.arange(len(queries))
        low, high = np.zeros(len(q), np.int64), np.full(len(q), len(self.words) + 1)
        used = np.zeros(len(q), np.int64)
        # the exact part: every query goes on until its own is used up
        while True:
            going = np.flatnonzero(used < exact[q])
            if not len(going):
                break
            symbol = symbol_at(q[going], used[going])
            low[going], high[going] = self.extend(np.maximum(symbol, 0), low[going], high[going])
            used[going] += 1
            alive = low < high
            alive[going[symbol < 0]] = False
            q, low, high, used = (x[alive] for x in (q, low, high, used))
        found_q, found_w = [], []
        one = tuple(np.empty(0, np.int64) for _ in range(4))  # states that spent their error
        while len(q) or len(one[0]):
            # with the error spent: the rest has to agree, and a delimiter to come
            q1, low1, high1, used1 = one
            done = used1 == size[q1]
            if done.any():
                low2, high2 = self.extend(np.zeros(done.sum(), np.int64), low1[done], high1[done])
                # ranks among delimiters; the first is the last one, with nothing behind it
                hit = (low2 < high2) & (low2 > 0)
                found_q.append(q1[done][hit])
                found_w.append(low2[hit] - 1)
            q1, low1, high1, used1 = (x[~done] for x in one)
            symbol = symbol_at(q1, used1)
            low1, high1 = self.extend(np.maximum(symbol, 0), low1, high1)
            alive = (low1 < high1) & (symbol >= 0)
            q1, low1, high1, used1 = (x[alive] for x in (q1, low1, high1, used1 + 1))
            # without an error so far: spend it here, or go on
            left = used < size[q]
            new = [(q[left], low[left], high[left], used[left] + 1)]  # the word lacks a code point
            if len(q):
                rows, symbol = self.symbols(low, high)
                low3, high3 = self.extend(symbol, low[rows], high[rows])
                alive = low3 < high3
                rows, symbol, low3, high3 = (x[alive] for x in (rows, symbol, low3, high3))
                own = np.full(len(rows), -1)
                inside = left[rows]
                own[inside] = symbol_at(q[rows[inside]], used[rows[inside]])
                # one more in the word; before an equal one it would be the same word again
                extra = symbol != own
                new.append((q[rows][extra], low3[extra], high3[extra], used[rows][extra]))
                other = extra & inside
                new.append((q[rows][other], low3[other], high3[other], used[rows][other] + 1))
            one = tuple(np.concatenate(parts) for parts in zip((q1, low1, high1, used1), *new, strict=True))
            q, low, high, used = (x[left] for x in (q, low, high, used))
            symbol = symbol_at(q, used)
            low, high = self.extend(np.maximum(symbol, 0), low, high)
            alive = (low < high) & (symbol >= 0)
            q, low, high, used = (x[alive] for x in (q, low, high, used + 1))
        if not found_q:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = np.unique(np.concatenate(found_q) * len(self.words) + np.concatenate(found_w))
        return pairs // len(self.words), pairs % len(self.words)


def _part(word: str) -> int:
    """A number of a word's own, by which a crowded half is split; ``near_words`` has it too."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def _answers(side: int, rows: list[tuple]) -> tuple[list, list, list, list]:
    """(word, n_near, form_n, form) per query of one group.

    ``rows`` are (word, n, parts, part): entries of the index have parts 0, queries have the
    number of parts of their half and the one they visit here.
    """
    entries = {word: n for word, n, parts, _ in rows if not parts}
    turn = slice(None, None, -1) if side == 0 else slice(None)
    words = sorted(word[turn] for word in entries)
    index = Index(words)
    counts = np.array([entries[word[turn]] for word in words], np.int64)
    # ties go to the smallest word as it is read, not as the index holds it
    by_word = np.empty(len(words), np.int64)
    by_word[sorted(range(len(words)), key=lambda k: words[k][turn])] = np.arange(len(words))
    numbers = np.array([_part(word[turn]) for word in words], np.int64)
    asked = [row for row in rows if row[2]]
    out: tuple[list, list, list, list] = ([], [], [], [])
    for start in range(0, len(asked), BATCH):
        some = asked[start : start + BATCH]
        queries = [word[turn] for word, *_ in some]
        sizes = np.array([len(word) for word in queries])
        half = sizes // 2 if side == 0 else sizes - sizes // 2
        q, w = index.near(queries, half)
        # each pair counts in one place: in the part that the visit is to, and at the end only
        # if the start does not agree already
        parts, part = (np.array([row[k] for row in some], np.int64) for k in (2, 3))
        here = numbers[w] % parts[q] == part[q]
        if side == 1:
            starts = [some[a][0][: sizes[a] // 2] for a in q.tolist()]
            known = [words[b].startswith(s) for b, s in zip(w.tolist(), starts, strict=True)]
            here &= ~np.array(known, bool)
        q, w = q[here], w[here]
        order = np.lexsort((by_word[w], -counts[w], q))
        q, w = q[order], w[order]
        first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
        out[0].extend(some[k][0] for k in q[first].tolist())
        out[1].extend(np.diff(np.append(first, len(q))).tolist())
        out[2].extend(counts[w[first]].tolist())
        out[3].extend(words[k][turn] for k in w[first].tolist())
    return out


def _searched(dealt: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of every visit that found something; groups come sorted."""
    arrow = pa.schema(
        [("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())]
    )

    def answered(group: tuple[int, int], rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if any(row[2] for row in rows) and any(not row[2] for row in rows):
            out = _answers(group[0], rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            names = ("side", "group", "word", "n", "parts", "part")
            columns = [batch.column(name).to_pylist() for name in names]
            for side, number, *row in zip(*columns, strict=True):
                if group != (side, number):
                    if group is not None:
                        yield from answered(group, rows)
                    group, rows = (side, number), []
                rows.append(tuple(row))
        if group is not None:
            yield from answered(group, rows)

    return dealt.mapInArrow(run, "word string, n_near bigint, form_n bigint, form string")


def near_words(words: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(word, n_near, form, form_n): how many near words a word has, and the most frequent one.

    ``words`` (word, n) must be distinct; ties go to the smaller word in code-point order. Words
    without near ones are left out.
    """
    words = durable(words.select("word", "n"))
    n_words = words.count()
    size = F.char_length("word")

    def halves(side: int, lengths: list) -> list:
        """The halves under which a word stands, for queries as long, shorter or longer by one."""
        out = []
        for length in lengths:
            half = F.floor(length / 2).cast("int")
            text = F.left("word", half) if side == 0 else F.right("word", length - half)
            out.append(text)
        return out

    near_sizes = [size - 1, size, size + 1]
    listed = F.array(
        *(
            F.struct(F.lit(side).alias("side"), F.array_distinct(F.array(*halves(side, near_sizes))).alias("keys"))
            for side in (0, 1)
        )
    )
    entries = (
        words.select("word", "n", F.explode(listed).alias("l"))
        .select("word", "n", "l.side", F.explode("l.keys").alias("half"))
    )
    asked = F.array(
        *(F.struct(F.lit(side).alias("side"), halves(side, [size])[0].alias("half")) for side in (0, 1))
    )
    queries = words.select("word", "n", F.explode(asked).alias("a")).select("word", "n", "a.side", "a.half")
    # only crowded halves have more than one part; there are fewer of them than entries / chunk
    crowded = durable(
        entries.groupBy("side", "half")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > chunk)
        .select("side", "half", F.ceil(F.col("_n") / chunk).cast("int").alias("parts"))
    )
    groups = max(1, -(-4 * n_words // chunk))
    parts = F.coalesce("parts", F.lit(1))
    group = F.pmod(F.xxhash64("half", "part"), F.lit(groups)).cast("int").alias("group")
    own_part = F.pmod(F.crc32(F.col("word").cast("binary")), parts).cast("int")
    placed = entries.join(crowded, ["side", "half"], "left").withColumn("part", own_part)
    placed = placed.select("side", group, "word", "n", F.lit(0).alias("parts"), F.lit(0).alias("part"))
    visits = (
        queries.join(crowded, ["side", "half"], "left")
        .withColumn("parts", parts)
        .select("side", "half", "word", "n", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .select("side", group, "word", "n", "parts", "part")
    )
    dealt = (
        placed.unionByName(visits)
        .repartition(2 * groups, "side", "group")
        .sortWithinPartitions("side", "group")
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    found = _searched(dealt).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    return found.select(
        "word", "n_near", F.col("_best.form").alias("form"), (-F.col("_best.less")).alias("form_n")
    )


def spelling_variants(docs: DataFrame, times: int = TIMES, chunk: int = CHUNK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary.

    A word's form is its near word of largest n (ties: the smaller word) if that has at least
    ``times`` as many occurrences, else NULL; its root is where following forms ends. As forms
    grow by that factor, a chain has no more steps than n has digits, and pointers that jump
    along it halve it each round. No words (NULL or empty texts, an empty table) give no rows;
    columns beyond doc_id and text aren't looked at.
    """
    words = durable(vocabulary(docs))
    near = near_words(words, chunk)
    taken = F.col("form_n") >= times * F.col("n")
    known = durable(
        words.join(near, "word", "left").select(
            "word",
            F.when(taken, F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(taken, F.col("form_n")).alias("form_n"),
        )
    )
    # only words with a form move, and only along words with a form
    ways = known.filter("form is not null").select("word", F.col("form").alias("to"))
    while True:
        ahead = ways.select(F.col("word").alias("to"), F.col("to").alias("_far"))
        ways = durable(ways.join(ahead, "to", "left").select("word", F.coalesce("_far", "to").alias("to"), "_far"))
        moved = not ways.filter("_far is not null").isEmpty()
        ways = ways.drop("_far")
        if not moved:
            break
    return known.join(ways, "word", "left").select(
        "word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n"
    )
