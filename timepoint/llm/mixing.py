"""Mixing sources to target weights by pivotal dependent rounding.

A source of S words that shall give T gives each document T / S copies on average. The whole
part is the same for all its documents; the fraction is rounded by the pivotal method: two
fractional documents meet, words move at random from one to the other until one of the two
has a whole number of copies, and the other goes on with what is left. The words promised
by a pair never change, so a source misses its target by at most one document's fraction.

Pairs meet in a reduction tree: documents in small random chunks, what is left of each chunk
in chunks again, until one per source is left. A chunk is folded by ``aggregate`` over a
sorted array; only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timepoint.llm.common import WORD, durable
from timepoint.operators.ranking import running_totals

WEIGHTS, MOST_COPIES, CHUNK, SEED = (5, 2, 1), 3, 64, 17


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """Per source: n_docs (with words), source_size, target.

    Sources by code point, NULL last, take the weights in turn; targets share the words of
    all sources by weight, stop at ``most`` times the source's own, and what is cut off is
    shared again until no target is above its bound. Each round is one aggregate over the
    sources, of which the driver sees the sums.
    """
    totals = sizes.groupBy("source").agg(
        F.count(F.when(F.col("size") > 0, 1)).alias("n_docs"),
        F.sum("size").alias("source_size"),
        F.lit(1).alias("_one"),
    )
    order = [F.col("source").isNull(), F.encode("source", "utf-8")]
    place = F.pmod(F.col("cum__one") - 1, F.lit(len(weights))).cast("int") + 1
    ranked = (
        running_totals(totals, order, ["_one"])
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place))
        .select(
            "source",
            "n_docs",
            "source_size",
            "weight",
            (F.lit(most) * F.col("source_size")).alias("_bound"),
        )
    )
    ranked = durable(ranked)
    whole = ranked.agg(F.sum("source_size")).first()[0] or 0
    # the bounded sources are those whose bound a common level per weight reaches; the level
    # only rises, so a source that has stopped stays so
    level, stopped = 0.0, -1
    while True:
        at_bound = F.col("_bound") <= F.lit(level) * F.col("weight")
        row = ranked.agg(
            F.count(F.when(at_bound, 1)).alias("n"),
            F.coalesce(F.sum(F.when(at_bound, F.col("_bound"))), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~at_bound, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if row.n == stopped or not row.weight:
            break
        stopped, level = row.n, (whole - row.given) / row.weight
    target = F.least(F.col("_bound").cast("double"), F.lit(float(level)) * F.col("weight"))
    return ranked.select("source", "n_docs", "source_size", target.alias("target"))


def _uniform(*columns: Column) -> Column:
    """In [0, 1), fixed by the values: a task that runs again draws the same."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def _meet(state: Column, row: Column, seed: Column) -> Column:
    """Fold one fractional row into the state (done: decided rows, rest: the open one)."""
    rest = state["rest"]
    a, b = rest["size"].cast("double"), row["size"].cast("double")
    p, q = rest["p"], row["p"]
    to_rest = F.least(a * (1 - p), b * q)  # words that can move to the open row, or from it
    to_row = F.least(a * p, b * (1 - q))
    gains = _uniform(seed, rest["id"], row["id"], rest["at"], row["at"]) * (to_rest + to_row) < to_row
    moved = F.when(gains, to_rest).otherwise(-to_row)
    # one of the two becomes whole: which bound was met says which and how
    rest_whole = F.when(gains, a * (1 - p) <= b * q).otherwise(a * p <= b * (1 - q))
    whole_up = F.when(rest_whole, gains).otherwise(~gains)
    new_p, new_q = p + moved / a, q - moved / b
    decided = F.when(rest_whole, rest).otherwise(row)
    left = F.when(rest_whole, row).otherwise(rest)
    left_p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(rest_whole, new_q).otherwise(new_p)))
    return F.when(
        rest.isNull(), F.struct(state["done"].alias("done"), row.alias("rest"))
    ).otherwise(
        F.struct(
            F.concat(
                state["done"],
                F.array(decided.withField("p", F.when(whole_up, 1.0).otherwise(0.0))),
            ).alias("done"),
            left.withField("p", left_p).alias("rest"),
        )
    )


def _fold(rows: DataFrame, level: int, seed: int) -> DataFrame:
    """Chunks of (source_key, chunk) folded: arrays ``done`` and one ``rest`` each."""
    kind = rows.schema["row"].dataType.simpleString()
    folded = rows.groupBy("source", "chunk").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    start = F.struct(
        F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("rest")
    )
    at = F.lit(seed * 1000 + level)
    return folded.select(
        "source", "chunk", F.aggregate("rows", start, lambda s, r: _meet(s, r, at)).alias("state")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """Copies of every row of ``docs`` so that the sources meet their targets.

    Returns doc_id, size, source_size, target, taken (copies times size) and copies. NULL
    texts have size 0, NULL is a source like others (the last), rows without words are
    taken 0 times, repeated rows are rows of their own, other columns are ignored. The
    draws depend on the seed and the rows alone.
    """
    sizes = durable(docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words().alias("size")))
    targets = durable(source_targets(sizes, weights, most).withColumnRenamed("source", "_source"))
    mean = F.col("target") / F.col("source_size")
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumns(
        {
            "whole": F.when(F.col("size") > 0, F.floor(mean)).otherwise(F.lit(0)).cast("long"),
            "p": F.when(F.col("size") > 0, mean - F.floor(mean)).otherwise(F.lit(0.0)),
        }
    )
    row = F.struct(
        # longer documents meet first, so that what is left over at the end is short
        (-F.col("size")).alias("order"),
        F.xxhash64(F.lit(seed), "doc_id", "size").alias("at"),
        F.col("doc_id").alias("id"),
        "size",
        "whole",
        "source_size",
        "target",
        "p",
    )
    even = rows.filter(F.col("p") <= 0).select(row.alias("row"))
    # a random chunk of about CHUNK rows; each further level has one row per chunk below
    chunks = F.ceil(F.col("n_docs") / F.lit(CHUNK))
    open_rows = rows.filter(F.col("p") > 0).select(
        "source", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), chunks).alias("chunk"), row.alias("row")
    )
    parts = [even]
    n_chunks = targets.agg(F.max(chunks)).first()[0] or 0
    level = 0
    while n_chunks:
        folded = durable(_fold(open_rows, level, seed))
        parts.append(folded.select(F.explode("state.done").alias("row")))
        rest = folded.select("source", "chunk", F.col("state.rest").alias("row"))
        if n_chunks == 1:
            up = _uniform(F.lit(seed + 2), F.col("row.id"), F.col("row.at")) < F.col("row.p")
            last = F.col("row").withField("p", F.when(up, 1.0).otherwise(0.0))
            parts.append(rest.select(last.alias("row")))
            break
        open_rows = rest.select("source", F.floor(F.col("chunk") / CHUNK).alias("chunk"), "row")
        n_chunks, level = -(-n_chunks // CHUNK), level + 1
    decided = parts[0]
    for part in parts[1:]:
        decided = decided.unionAll(part)
    copies = F.col("row.whole") + F.col("row.p").cast("long")
    return decided.select(
        F.col("row.id").alias("doc_id"),
        F.col("row.size").alias("size"),
        F.col("row.source_size").alias("source_size"),
        F.col("row.target").alias("target"),
        (copies * F.col("row.size")).alias("taken"),
        copies.alias("copies"),
    )


def mixed_documents(docs: DataFrame, **settings: object) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; same columns.

    Rows are found again by doc_id; where ids are missing or repeated, rows of one id and
    size are taken together, as often as all of them.
    """
    taken = durable(mix(docs, **settings).select("doc_id", "size", "copies"))
    rows = docs.select("doc_id", F.struct("*").alias("row"))
    ids = taken.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    if ids.count() == taken.count():
        some = taken.filter("copies > 0").select(F.col("doc_id").alias("_taken"), "copies")
        found = rows.join(some, F.col("doc_id") == F.col("_taken"))
    else:
        sums = durable(
            taken.groupBy("doc_id", "size")
            .agg(F.sum("copies").alias("copies"), F.count("*").alias("alike"))
            .filter("copies > 0")
            .select(F.col("doc_id").alias("_taken"), F.col("size").alias("_size"), "copies", "alike")
        )
        # a row of several alike stands for its share; the draw of which gets one more is fixed
        # by a number given within the checkpointed rows
        numbered = durable(
            rows.select("doc_id", "row", n_words("row.text").alias("size"))
        ).withColumn("at", F.xxhash64(F.monotonically_increasing_id()))
        met = numbered.join(
            sums, F.col("doc_id").eqNullSafe(F.col("_taken")) & (F.col("size") == F.col("_size"))
        )
        turn = F.row_number().over(Window.partitionBy("doc_id", "size").orderBy("at"))
        found = met.withColumn("turn", turn).withColumn(
            "copies",
            F.floor(F.col("copies") / F.col("alike"))
            + (F.col("turn") <= F.pmod("copies", "alike")).cast("long"),
        ).filter("copies > 0")
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return found.select("row", F.explode(copies)).select("row.*")
