"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document and leaves one bit (set: failed) beside the
measurements it was decided on. Policies are sets of rules, named and versioned; applying
one is a bitwise AND with its mask, so a new policy or an ablation needs the ledger only and
never reads a text again.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import few_at_a_time

#: Fixed by the contract.
SYMBOLS = re.compile(r"[#*$%&|<>]")
MIN_WORDS, REPEAT_PERCENT = 50, 50

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_exclaimed",
    "top_word",
)


#: Rule -> SQL that is true where it fails. A rule's place fixes its bit; new rules go at the end.
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeated_words": f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "symbols": "4 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines >= 4 AND 2 * n_dup_lines > n_lines",
    "shouting": "10 * n_upper > 6 * n_letters",
    "exclaiming": "4 * n_exclaimed > n_words",
    "one_word": "10 * top_word > 3 * n_words",
}
BASE = ("few_words", "repeated_words")
#: Policies by version; a version never changes once published.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "short_words", "long_words", "symbols", "repeated_lines"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << list(RULES).index(rule) for rule in rules)


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``; NULL counts as empty."""
    text = text or ""
    words = re.split(r"[\x20\x09-\x0D]+", text)
    if words and not words[0]:
        words = words[1:]
    if words and not words[-1]:
        words = words[:-1]
    triples = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(triples)) < len(triples):
        times = Counter(triples)
        reach = 0  # words before this place are counted
        for at, triple in enumerate(triples):
            if times[triple] > 1:
                repeated += at + 3 - max(at, reach)
                reach = at + 3
    seen: set[str] = set()
    lines = copies = 0
    for line in text.split("\n"):
        if line.strip("\x20\x09\x0a\x0b\x0c\x0d"):
            lines += 1
            copies += line in seen
            seen.add(line)
    lowered = text.lower()
    letters = sum(map(str.isalpha, text)) if lowered != text else 0
    upper = sum(map(str.isupper, text)) if letters else 0
    return (
        len(words),
        sum(map(len, words)),
        len(SYMBOLS.findall(text)),
        copies,
        repeated,
        lines,
        upper,
        letters,
        sum(word.endswith("!!") for word in words) if "!!" in text else 0,
        max(Counter(words).values(), default=0),
    )


def _measured(text: Column) -> Column:
    """The measurements of each text as one struct."""

    @F.arrow_udf(", ".join(f"{m} long" for m in MEASURES))
    def measured(texts: pa.Array) -> pa.Array:
        rows = [measure(text) for text in few_at_a_time(texts)]
        columns = zip(*rows, strict=True) if rows else [[]] * len(MEASURES)
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=list(MEASURES)
        )

    return measured(text.cast("string"))


def _failed() -> Column:
    """The bits of all rules over measurement columns; a rule's bit is set where it fails."""
    total = F.lit(0).cast("long")
    for bit, failed in enumerate(RULES.values()):
        own = F.when(F.expr(failed), F.lit(1 << bit)).otherwise(F.lit(0))
        total = total.bitwiseOR(own.cast("long"))
    return total


def ledger(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, every measurement and ``failed`` (bit i: rule i failed).

    Rows are independent: repeated rows, NULL ids and other columns of ``docs`` do not
    matter. NULL and empty texts have no words and so fail ``few_words`` only. A whole text
    is read whatever its length; no rows meet, so nothing is shuffled.
    """
    measured = docs.select("doc_id", _measured(F.col("text")).alias("_measured"))
    return measured.select("doc_id", "_measured.*").withColumn("failed", _failed())


def accepted(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that pass a policy, with all their columns as they are."""
    row = docs.select(F.struct("*").alias("row"), _measured(F.col("text")).alias("measured"))
    judged = row.select("row", "measured.*").withColumn("failed", _failed())
    return judged.filter(passes(policy)).select("row.*")


def passes(policy: str = CURRENT, failed: str = "failed") -> Column:
    """True where none of the policy's rules failed."""
    return F.col(failed).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents it fails, fails alone, and the policy without it keeps.

    One aggregate over the ledger, every rule a conditional count on the bits.
    """
    mask = mask_of(POLICIES[policy])
    one = F.lit(1).cast("long")
    failed = F.col("failed").bitwiseAND(F.lit(mask).cast("long"))
    counts = []
    for rule in POLICIES[policy]:
        bit = 1 << list(RULES).index(rule)
        counts += [
            F.count(F.when(failed.bitwiseAND(F.lit(bit).cast("long")) != 0, one)).alias(f"{rule}_f"),
            F.count(F.when(failed == F.lit(bit).cast("long"), one)).alias(f"{rule}_a"),
            F.count(
                F.when(failed.bitwiseAND(F.lit(mask & ~bit).cast("long")) == 0, one)
            ).alias(f"{rule}_k"),
        ]
    report = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.col(f"{rule}_f").alias("n_failed"),
            F.col(f"{rule}_a").alias("n_failed_alone"),
            F.col(f"{rule}_k").alias("n_kept_without"),
        )
        for rule in POLICIES[policy]
    ]
    return rows.agg(*counts).select(F.inline(F.array(*report)))


def base_failed() -> Column:
    return ~passes("base")
