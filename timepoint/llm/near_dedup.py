"""MinHash near-duplicates with sequential Bayesian verification.

1. Every document becomes its set of word shingles and a signature of ``HASHES`` minima.
   Equal sets are one class, carried on by its smallest document.
2. ``BANDS`` bands of the signature are keys; documents sharing a key are candidates. Each
   key is led by the document that shares most keys with others, so a group of copies meets
   under few leaders instead of under every key.
3. The documents under a leader are compared in blocks of bounded size. For each pair the
   signatures are compared batch by batch, and the pair is dropped as soon as the posterior
   probability that its similarity reaches the threshold falls below ``MISS``. Survivors are
   decided on their full sets, exactly. A block returns a spanning forest of its links, never
   its pairs.
4. The links' connected components are the groups.

Chance of missing a link at the threshold itself: (1 - 0.85^5)^25 = 4e-7 that no band is
shared, and ``MISS`` per batch of the comparison. Shingles and words are compared by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import WordHashes, arrow_map, durable, mixed, shingled
from timepoint.llm.components import components

PERCENT = 85
BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS
BATCH = 25
MISS = 1e-5
BLOCK = 64
_COLUMNS_AT_ONCE = 512
_MATRIX = 1 << 16

_MULTIPLIERS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_BAND_SEEDS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(20))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of ``HASHES`` hash functions over a set that is not empty, 32 bits each."""
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), _COLUMNS_AT_ONCE):
        part = shingles[at : at + _COLUMNS_AT_ONCE]
        np.minimum(least, (_MULTIPLIERS[:, None] * part[None, :]).min(axis=1), out=least)
    return least >> np.uint64(32)


def band_keys(minima: np.ndarray) -> np.ndarray:
    keys = _BAND_SEEDS.copy()
    for row in minima.reshape(BANDS, ROWS).T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys.view(np.int64)


def fewest_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """For each batch: the fewest matches so far with which a pair goes on.

    Signatures are compared on one byte per hash, which agree with probability
    p = s + (1 - s) / 256 at similarity s. With a uniform prior the posterior after m of n
    matches is Beta(m + 1, n - m + 1), whose tail beyond p is P(Binomial(n + 1, p) <= m).
    """
    s = percent / 100
    p = s + (1 - s) / 256
    needed = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * p**m * (1 - p) ** (n + 1 - m)
        needed.append(m)
    return needed


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, a 128-bit fingerprint of the set, and its band keys."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        words = WordHashes()
        for batch in batches:
            sizes, low, high, keys = [], [], [], []
            for shingles in map(np.unique, shingled(batch["text"], words)):
                sizes.append(len(shingles))
                both = xxhash.xxh3_128_digest(shingles.tobytes())
                low.append(int.from_bytes(both[:8], "little", signed=True))
                high.append(int.from_bytes(both[8:], "little", signed=True))
                keys.append(band_keys(signature(shingles)) if len(shingles) else None)
            yield {
                "doc_id": batch["doc_id"],
                "n_shingles": sizes,
                "low": low,
                "high": high,
                "bands": keys,
            }

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return arrow_map(
        slim, "doc_id bigint, n_shingles bigint, low bigint, high bigint, bands array<bigint>", work
    )


def _under_leaders(live: DataFrame) -> DataFrame:
    """Documents by leader: (leader, doc), each once, a leader with itself.

    Documents that share a key share that key's leader.
    """
    met = live.groupBy("doc").agg(F.sum("n").alias("met"))
    leaders = durable(
        live.join(met, "doc")
        .groupBy("key")
        .agg(F.max_by("doc", F.struct("met", -F.col("doc"))).alias("leader"))
    )
    return durable(live.join(leaders, "key").select("leader", "doc").distinct())


def _blocks(led: DataFrame, block: int) -> DataFrame:
    """Per document: the block pairs it is compared in, as (leader, i, j, own block)."""
    sizes = durable(
        led.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(
            F.col("leader").alias("leader"),
            F.least("own", j).alias("i"),
            F.greatest("own", j).alias("j"),
            F.col("own").alias("own"),
        ),
    )
    return (
        led.join(sizes, "leader")
        .withColumn("own", own)
        .select("doc", meets.alias("meets"))
        .groupBy("doc")
        .agg(F.flatten(F.collect_list("meets")).alias("meets"))
    )


class _Forest:
    def __init__(self, n: int) -> None:
        self._up = list(range(n))

    def root(self, i: int) -> int:
        up = self._up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self._up[max(a, b)] = min(a, b)
        return a != b


def links_of_block(
    ids: list[int], sets: list[np.ndarray], signs: np.ndarray, sides: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """A spanning forest of the links among documents; two sides are compared across only."""
    n, needed = len(ids), fewest_matches(percent)
    sizes = np.array([len(s) for s in sets], np.int64)
    across = sides.min() != sides.max()
    survivors = []
    step = max(1, 200_000 // n)
    for start in range(0, n, step):
        i, j = np.nonzero(np.arange(start, min(n, start + step))[:, None] < np.arange(n)[None, :])
        i += start
        small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        near = 100 * small >= percent * large
        if across:
            near &= sides[i] != sides[j]
        i, j = i[near], j[near]
        matches = np.zeros(len(i), np.int64)
        for k, fewest in enumerate(needed):
            cut = slice(k * BATCH, (k + 1) * BATCH)
            matches += (signs[i, cut] == signs[j, cut]).sum(axis=1)
            stays = matches >= fewest
            i, j, matches = i[stays], j[stays], matches[stays]
        survivors.append((i, j, matches))
    i, j, matches = map(np.concatenate, zip(*survivors, strict=True))
    order = np.argsort(-matches, kind="stable")
    i, j = i[order], j[order]
    common = _common(sets, i, j)
    forest, found = _Forest(n), []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        if ids[x] == ids[y] or forest.root(x) == forest.root(y):
            continue
        both = common(x, y)
        if 100 * both >= percent * (sizes[x] + sizes[y] - both) and forest.join(x, y):
            found.append((ids[x], ids[y]))
    return found


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray):
    """Size of the intersection of two sets: by matrix where many pairs are asked for."""
    if len(i) > 4 * len(sets):
        shingle, times = np.unique(np.concatenate(sets), return_counts=True)
        shared = shingle[times > 1]  # others are in no intersection
        if len(shared) * len(sets) <= _MATRIX * 256:
            holds = np.zeros((len(sets), len(shared)), np.float32)
            for row, own in enumerate(sets):
                at = np.searchsorted(shared, own)
                at[at == len(shared)] = 0
                holds[row, at[shared[at] == own] if len(shared) else []] = 1
            counts = holds @ holds.T
            return lambda x, y: int(counts[x, y])
    return lambda x, y: len(np.intersect1d(sets[x], sets[y], assume_unique=True))


def _links(docs: DataFrame, meets: DataFrame, percent: int) -> DataFrame:
    """Links among the documents that meet in a block pair."""

    def prepared(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        words = WordHashes()
        for batch in batches:
            rows: list[tuple] = []
            sets = map(np.unique, shingled(batch["text"], words))
            for doc, shingles, meets in zip(batch["doc"], sets, batch["meets"], strict=True):
                if not len(shingles):
                    continue
                sign = signature(shingles).astype(np.uint8).tobytes()
                own = shingles.tobytes()
                rows += [(m["leader"], m["i"], m["j"], m["own"], doc, sign, own) for m in meets]
                if len(rows) >= 2000:
                    yield dict(zip(_ROW, zip(*rows, strict=True), strict=True))
                    rows = []
            if rows:
                yield dict(zip(_ROW, zip(*rows, strict=True), strict=True))

    def compared(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        key, group = None, []

        def links() -> list[tuple[int, int]]:
            if len(group) < 2:
                return []
            signs = np.frombuffer(b"".join(r[1] for r in group), np.uint8).reshape(-1, HASHES)
            sets = [np.frombuffer(r[2], np.uint64) for r in group]
            sides = np.array([r[3] for r in group])
            return links_of_block([r[0] for r in group], sets, signs, sides, percent)

        found: list[tuple[int, int]] = []
        for batch in batches:
            for row in zip(*(batch[c] for c in _ROW), strict=True):
                if row[:3] != key:
                    found += links()
                    key, group = row[:3], []
                group.append((row[4], row[5], row[6], row[3]))
            yield {"a": [x for x, _ in found], "b": [y for _, y in found]}
            found = []
        found = links()
        yield {"a": [x for x, _ in found], "b": [y for _, y in found]}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    rows = arrow_map(
        texts.join(meets, "doc"),
        "leader bigint, i int, j int, own int, doc bigint, sign binary, shingles binary",
        prepared,
    )
    together = rows.repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j", "doc")
    return arrow_map(together, "a bigint, b bigint", compared)


_ROW = ("leader", "i", "j", "own", "doc", "sign", "shingles")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept.

    Documents are linked where 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest doc_id a document reaches and the documents that are
    their own component's smallest are kept. NULL, empty and blank texts have no shingles
    and are linked with nothing; a NULL doc_id is linked with nothing and kept. Repeated rows
    are in one component and each carry its id. Other columns are ignored.
    """
    rows = durable(sketches(docs))
    some = rows.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = durable(
        some.groupBy("low", "high").agg(
            F.min("doc_id").alias("doc"), F.min_by("bands", "doc_id").alias("bands")
        )
    )
    members = classes.select("doc", F.explode("bands").alias("key"))
    counts = durable(members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    live = durable(members.join(counts, "key"))
    meets = durable(_blocks(_under_leaders(live), block))
    grouped = components(durable(_links(docs, meets, percent)))
    reached = durable(
        classes.join(grouped, F.col("doc") == F.col("node"), "left").select(
            "low", "high", F.coalesce("component", "doc").alias("component_id")
        )
    )
    return rows.join(reached, ["low", "high"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), None)
        .otherwise(F.coalesce("component_id", "doc_id"))
        .alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group, the smallest doc_id; same columns.

    Of repeated rows of one doc_id one stays. Rows without a doc_id all stay.
    """
    judged = durable(near_duplicates(docs, percent))
    dropped = judged.filter(~F.col("kept")).select(F.col("doc_id").alias("_dropped"))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.struct("*").alias("row"))
    kept = rows.join(durable(dropped.distinct()), F.col("_id") == F.col("_dropped"), "left_anti")
    repeated = durable(
        judged.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    )
    if repeated.isEmpty():
        return kept.select("row.*")
    again = kept.join(repeated, F.col("_id") == F.col("doc_id"), "left_semi")
    once = again.groupBy("_id").agg(F.first("row").alias("row")).select("row.*")
    single = kept.join(repeated, F.col("_id") == F.col("doc_id"), "left_anti").select("row.*")
    return single.unionAll(once)
