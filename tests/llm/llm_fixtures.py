from __future__ import annotations

import re
from collections import defaultdict

import pytest

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; as extra columns they must not get in the way.
CLASHING = ("component_id", "kept", "failed", "row", "spans", "left", "copies", "size", "host", "key")


def words(text):
    return WORD.findall(text or "")


def story(seed, n):
    """``n`` words that no other seed has."""
    return " ".join(f"w{seed}x{i * 7919 % 10007}" for i in range(n))


def edge_texts():
    long = story("long", 6000)
    return [
        None,
        "",
        " \n\t ",
        "one",
        "two words",
        story("a", 80),
        story("a", 80),
        story("a", 80).upper(),
        story("b", 300),
        story("b", 300).replace("w", "v", 2),
        long,
        long + " more",
        "the the the " * 50,
        "x" * 20000,
        "Grüße an alle\x00Ωmega \U0001f389 " * 30,
    ]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None, sources=None):
        ids = ids or list(range(len(texts)))
        sources = sources or [f"s{i % 3}" for i in range(len(texts))]
        rows = [
            (i, t, "en", s, None if t is None else len(t))
            for i, t, s in zip(ids, texts, sources, strict=True)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    """NULLs in every column, empty and very long texts, repeated rows, clashing columns."""
    from pyspark.sql import functions as F

    texts = edge_texts()
    docs = make_docs(texts + texts[5:7] + ["no id here", None])
    n = len(texts)
    ids = F.when(F.col("doc_id") < n, F.col("doc_id"))
    ids = ids.when(F.col("doc_id") < n + 2, F.col("doc_id") - n + 5)
    docs = docs.withColumn("doc_id", ids).withColumn(
        "source", F.when(F.col("doc_id") % 4 == 0, None).otherwise(F.col("source"))
    )
    return docs.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


def shingles(text):
    w = words((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(zip(*(w[i:] for i in range(5)), strict=False)) if len(w) >= 5 else frozenset([tuple(w)])


def linked_components(texts, percent=85):
    """Smallest reachable id per id, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    where, up = defaultdict(list), {i: i for i in texts}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for a, b in {(a, b) for own in where.values() for a in own for b in own if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * len(sets[a] | sets[b]):
            ra, rb = root(a), root(b)
            up[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in texts}
