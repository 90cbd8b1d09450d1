"""Helpers shared by the operators: tables, durable intermediates, Arrow maps and word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from timepoint.sources.storage import SHUFFLE_CLEANUP as _CLEANUP
from timepoint.sources.storage import checkpointed

#: Fixed by the contracts: words are runs of anything but these six white-space characters,
#: which are exactly those that ``bytes.split()`` splits at.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Rows that are Python objects at a time, of an Arrow batch that may hold many more.
_ROWS = 1000
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the session's checkpoint folder and read back.

    The folder comes from ``spark.checkpoint.dir``; without it only a local session (tests)
    gets a folder of its own, a cluster is refused. What was shuffled for it is removed as soon
    as the rows are written, as nothing reads it again.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return checkpointed(df.select("*"))  # a new frame takes the setting with it
    finally:
        conf.set(_CLEANUP, before)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def few_at_a_time(column: pa.Array) -> Iterator:
    """The values of an Arrow column; few of them are Python objects at a time."""
    for at in range(0, len(column), _ROWS):
        yield from column.slice(at, _ROWS).to_pylist()


def arrow_map(
    df: DataFrame,
    schema: str | T.StructType,
    work: Callable[[Iterator[dict[str, list]]], Iterator[Mapping[str, object]]],
) -> DataFrame:
    """Run ``work`` over each partition's batches: columns in as lists, columns out as lists.

    A batch a partition yields may hold any number of rows, so ``work`` can carry state from
    batch to batch. Nothing is kept beyond the batch and that state.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = (
            {name: part.column(k).to_pylist() for k, name in enumerate(part.schema.names)}
            for batch in batches
            for part in (batch.slice(at, _ROWS) for at in range(0, batch.num_rows, _ROWS))
        )
        for out in work(lists):
            columns = [
                c.cast(f.type) if isinstance(c := out[f.name], pa.Array) else pa.array(c, type=f.type)
                for f in arrow
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        # the process goes on to other tasks; what Arrow holds in reserve goes back
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, kind)


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (the finaliser of splitmix64)."""
    v = values ^ (values >> np.uint64(30))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v = v * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of a number, modulo 2^64."""
    out = np.full(n, base)
    out[0] = 1
    return np.cumprod(out, out=out)


class WordHashes:
    """64-bit hashes of the words of texts, A-Z lower-cased, for many texts at once.

    A word's hash is a polynomial of its bytes, taken from sums over the whole chunk and
    shifted to a common power, then mixed.
    """

    _BASE = np.uint64(0xD6E8FEB86659FD93)
    _INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))

    def __init__(self) -> None:
        self._powers = self._inverses = powers(self._BASE, 1)

    def chunk(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All words' hashes in order, and where each text's begin and end."""
        parts = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
        data = np.frombuffer(b" " + b" ".join(parts).translate(_LOWERED) + b" ", np.uint8)
        n = len(data)
        if len(self._powers) < n + 1:
            self._powers = powers(self._BASE, 2 * n + 2)
            self._inverses = powers(self._INVERSE, 2 * n + 2)
        blank = _BLANK[data]
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        first, last = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self._powers[:n], out=sums[1:])
        # divided by the power of the word's place, as the base is odd and has an inverse
        hashes = mixed((sums[last] - sums[first]) * self._inverses[first])
        ends = np.cumsum([len(part) + 1 for part in parts])
        bounds = np.concatenate(([0], np.searchsorted(first, ends)))
        return hashes, bounds

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words of one text."""
        return self.chunk([text])[0]


def chunks(texts: list[str | None], size: int = 1 << 18) -> Iterator[tuple[int, list[str | None]]]:
    """Neighbouring texts of about ``size`` characters together, with the first one's place."""
    start = total = 0
    for at, text in enumerate(texts):
        total += len(text or "") + 1
        if total >= size:
            yield start, texts[start : at + 1]
            start, total = at + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def shingle_hashes(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``width`` words; fewer words make one shingle, none makes none."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    # the number of words goes in first, so that a short text differs from a longer shingle
    rolled = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + words[i : n - width + 1 + i])
    return rolled


def shingled(texts: list[str | None], words: WordHashes) -> Iterator[np.ndarray]:
    """The shingle hashes of each text in order."""
    for _, some in chunks(texts):
        hashes, bounds = words.chunk(some)
        rolled = shingle_hashes(hashes) if len(hashes) >= SHINGLE else hashes
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if last - first >= SHINGLE:
                yield rolled[first : last - SHINGLE + 1]
            else:
                yield shingle_hashes(hashes[first:last])
