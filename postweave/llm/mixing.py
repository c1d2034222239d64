"""Mixing sources to target weights: hash-random order, prefix sums of sizes, and a cut at each source's exact budget.

Documents of a source are sorted by a hash. Their order is dealt into hash ranges of two levels, so that sizes are summed per
fine range, fine ranges per coarse range, and coarse ranges per source; a document's prefix is the sum of the three. No window
holds more than a fine range of documents, the fine ranges of a coarse one, or the coarse ranges of a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from postweave.llm.common import SPACED
from postweave.session import pin

WEIGHTS = (5.0, 2.0, 1.0)
FINE_ROWS = 64
COARSE = 1024
_POSITIVE = (1 << 63) - 1


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACED)).cast("long")


def _place(seed: int) -> tuple[Column, Column]:
    """The random key of a document, and a hash that orders documents of one key and id."""
    return (
        F.xxhash64(F.lit(seed), "doc_id", "text").bitwiseAND(F.lit(_POSITIVE)).alias("key"),
        F.xxhash64(F.lit(seed + 1), "text").alias("tie"),
    )


def sized(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, source, size, the random key, and a hash of the text that orders rows of one key."""
    return docs.select(
        "doc_id", "source", words(F.col("text")).alias("size"),
        *_place(seed),
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target: share x all sizes by weight, no target over most x its source's size.

    Weights go round the sources in code point order, null last. Excess over a limit is dealt again by weight among the others;
    that needs a few sums over the sources, and only these sums reach the driver. If every source is at its limit, so it stays.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source, in the order of the sources; ranked in range partitions.
    ordered = pin(per.repartitionByRange(F.col("source").isNull(), F.col("source")).sortWithinPartitions(F.col("source").isNull(), "source"))
    ordered = ordered.withColumn("mid", F.monotonically_increasing_id())
    ordered = ordered.select("source", "source_size", F.shiftright("mid", 33).alias("part"), F.col("mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    starts = ordered.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("at")
    given = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    ranked = pin(ordered.join(starts, "part").select("source", "source_size", given.alias("weight")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    limit = most * F.col("source_size")
    level = 0.0
    while True:
        # Sources at their limit under this level; the rest share what remains.
        full = F.lit(level) * F.col("weight") >= limit
        capped, weight, free = ranked.agg(
            F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.sum((~full).cast("long"))
        ).first()
        if not free:
            break
        higher = (share * total - capped) / weight
        if higher <= level:
            break
        level = higher
    return ranked.select("source", "source_size", F.least(F.lit(level) * F.col("weight"), limit).alias("target"))


def prefixes(sizes: DataFrame) -> DataFrame:
    """Adds `before`: the size of all rows of the same source that come earlier by (key, doc_id, tie)."""
    rows = sizes.count()
    fine = 1 << max(0, math.ceil(math.log2(max(rows, 1) / FINE_ROWS / COARSE)))
    # Equal parts of the key's range: COARSE of them, each of `fine` parts.
    width = max(1, (1 << 63) // (COARSE * fine))
    placed = sizes.withColumn("bin", F.expr(f"key div {width}L"))
    inner = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    bins = placed.groupBy("source", "bin").agg(F.sum("size").alias("total")).withColumn("coarse", F.expr(f"bin div {fine}L"))
    within = Window.partitionBy("source", "coarse").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("source").orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)
    coarse = bins.groupBy("source", "coarse").agg(F.sum("total").alias("total")).select(
        F.col("source").alias("c_source"), F.col("coarse").alias("c_coarse"), F.coalesce(F.sum("total").over(across), F.lit(0)).alias("c_before")
    )
    starts = bins.withColumn("f_before", F.coalesce(F.sum("total").over(within), F.lit(0))).join(
        coarse, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("coarse") == F.col("c_coarse"))
    ).select(F.col("source").alias("s_source"), F.col("bin").alias("s_bin"), (F.col("f_before") + F.col("c_before")).alias("start"))
    return (
        placed.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bin") == F.col("s_bin")))
        .withColumn("before", F.col("start") + F.col("inside"))
        .drop("bin", "inside", "start", "s_source", "s_bin")
    )


def few(per_source: DataFrame, most: int = 100_000) -> DataFrame:
    """A row per source: sent to all tasks up to `most` sources, an ordinary join beyond."""
    kept = pin(per_source)
    return F.broadcast(kept) if kept.count() <= most else kept


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, taken; also epochs, rest, before, key, tie.

    The whole epochs take every document; the last, partial one takes documents in hash order up to the source's budget, the
    document at the cut in part. taken = epochs x size + rest. Null texts have size 0; a null source is a source of its own, the
    last. Repeated rows are documents of their own; which of them the cut meets makes no difference. An empty table gives none.
    """
    sizes = pin(sized(docs, seed))
    goal = few(targets(sizes, weights, share, most).select(F.col("source").alias("g_source"), "source_size", "target"))
    joined = prefixes(sizes).join(goal, F.col("source").eqNullSafe(F.col("g_source")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0)).cast("long")
    left = budget - F.col("epochs") * F.col("source_size") - F.col("before")
    return (
        joined.withColumn("epochs", epochs)
        .withColumn("rest", F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), left)))
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("rest"))
        .select("doc_id", "source", "size", "source_size", "target", "taken", "epochs", "rest", "before", "key", "tie")
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    # The possessive count is matched in a loop, so that many words need no deep stack.
    return F.coalesce(F.regexp_substr(text, F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), n.cast("string"), F.lit("}+"))), F.lit(""))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """The mixed documents with the columns of docs: a row per epoch, and the document at a source's cut up to the cut.

    What a source gives is told by its whole epochs and the last key of the partial one, so texts are not shuffled. Repeated rows
    at the cut share its words evenly. n_chars, if there, follows a text that is cut.
    """
    names = docs.columns
    plan = pin(mix(docs, weights, share, most, seed))
    rest = F.round("target").cast("long") - F.col("epochs") * F.col("source_size")
    copies = plan.where((F.col("before") < rest) & (F.col("size") > 0)).groupBy("source", "key", "doc_id", "tie").agg(
        F.min("before").alias("before"), F.count("*").alias("copies"), F.max(rest).alias("rest")
    )
    cuts = copies.groupBy("source").agg(F.max(F.struct("key", "doc_id", "tie", "before", "copies", "rest")).alias("cut"))
    per = plan.groupBy("source").agg(F.max("epochs").alias("epochs")).alias("p").join(
        cuts.alias("c"), F.expr("p.source <=> c.source"), "left"
    ).select(F.col("p.source").alias("m_source"), "epochs", "cut")
    per = few(per)
    key, tie = _place(seed)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "source", "text", "doc_id", key, tie)
    own = own.join(per, F.col("source").eqNullSafe(F.col("m_source")))
    place, cut = F.struct("key", "doc_id", "tie"), F.struct("cut.key", "cut.doc_id", "cut.tie")
    part = F.when(F.col("cut").isNull() | (place > cut), 0).when(place < cut, 1).otherwise(2)
    rows = own.select("row", "text", "cut", "epochs", part.alias("part")).select(
        "*", F.explode(F.expr("sequence(0, epochs + if(part > 0, 1, 0))")).alias("epoch")
    ).where("epoch > 0")
    share_of_cut = F.expr("(cut.rest - cut.before) div cut.copies")
    text = F.when((F.col("epoch") > F.col("epochs")) & (F.col("part") == 2), first_words(F.col("text"), share_of_cut)).otherwise(F.col("text"))
    rows = rows.select("row", text.alias("given")).where("given <> '' OR given IS NULL")
    changed = {"text": F.col("given"), **({"n_chars": F.length("given").cast(docs.schema["n_chars"].dataType)} if "n_chars" in names else {})}
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in names])
