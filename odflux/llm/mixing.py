"""Mixing sources by temperature.

A source's weight is its token share to the power of an exponent between 0 (all
sources alike) and 1 (as they are). The exponent is found by bisection: the
highest that reaches a target entropy, or the lowest that keeps repetition
within a limit. A source's budget is its weight times the whole; it is filled
with the source's blocks, permuted anew in every epoch by a hash, and the last
block is cut where the budget ends.

All of it is DataFrame expressions. Sums over a source are kept in three steps
(ranges of hashes, blocks in a range, documents in a block), so no task holds a
source. A source that is repeated very often has its epochs dealt to lanes, so
neither an array nor a task holds all of them; the mixture has a row for every
document and epoch. A document without words weighs nothing: it is used once in every epoch
that reaches it, and so is a source of such documents alone. Missing sources are
one source of their own. Repeated rows are documents of their own; documents of
equal hash in a block go by id, then by tokens and text, so a tie between equal
rows does not show. Missing and empty texts have no words. An empty table gives an
empty mixture. Other columns stay; those named mix_tokens, mix_epoch or mix_start
are an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflux.llm.place import stored

GRID = 1 << 20
HALVINGS = 5
BLOCK_DOCS = 512
# Turns of a block that travel in one row, and lanes that a block of more turns is dealt to.
LANE_EPOCHS, LANES = 256, 64
# Up to so many sources their table goes to every task; beyond, it is joined by shuffle.
FEW_SOURCES = 2_000
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """What the exponent has to meet.

    ``entropy``: at least this part of the way from the entropy of the token
    shares to the highest, with as many tokens in all as there are.
    ``repetition``: no source is used more often than this; in all as many
    tokens as use the source repeated least once and whole.
    """

    entropy: float | None = None
    repetition: float | None = None


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: str | Column) -> Column:
    """A source as a key that is never missing."""
    column = F.col(source) if isinstance(source, str) else source
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def hashed(*columns: Column) -> Column:
    """A hash of 32 hexadecimal digits; a missing part is empty."""
    return F.md5(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)).cast("binary"))


def block_of(doc_id: Column, text_hash: Column) -> Column:
    """Block of a document in its source of ``n_blocks``; documents without an id part by their text."""
    digits = F.substring(hashed(F.lit(SEED), F.col("key"), doc_id, text_hash), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.col("n_blocks"))


def source_tokens(docs: DataFrame) -> DataFrame:
    """key, n_docs and tokens of every source; ``docs`` has key and tokens."""
    return docs.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("tokens"))


def _meets(shares: DataFrame, exponents: list[int], target: Target) -> dict[int, bool]:
    """Which exponents meet the target; one row for each comes to the driver."""
    a = F.col("k") / GRID
    power = F.pow("share", a)
    sums = (
        shares.select("share", "largest", F.explode(F.array(*map(F.lit, exponents))).alias("k"))
        .groupBy("k")
        .agg(
            F.sum(power).alias("z"),
            F.sum(power * F.log("share")).alias("slope"),
            F.max(F.pow(F.col("share") / F.col("largest"), a - 1)).alias("repetition"),
            F.sum(-F.col("share") * F.log("share")).alias("h"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    entropy = F.log("z") - a * F.col("slope") / F.col("z")
    if target.entropy is not None:
        met = entropy >= F.col("h") + target.entropy * (F.log("n") - F.col("h")) - 1e-12
    else:
        met = F.col("repetition") <= target.repetition * (1 + 1e-12)
    return {r["k"]: r["met"] for r in sums.select("k", met.alias("met")).collect()}


def exponent(sources: DataFrame, target: Target) -> int:
    """The exponent that meets the target, in parts of ``GRID``; 0 or GRID where none between does.

    Each round asks at once for all exponents that the next halvings may need.
    """
    if (target.entropy is None) == (target.repetition is None):
        raise ValueError("either an entropy or a repetition limit is needed")
    totals = sources.where("tokens > 0").agg(F.sum("tokens").alias("all"), F.max("tokens").alias("most"))
    shares = sources.where("tokens > 0").crossJoin(F.broadcast(totals))  # one row
    shares = shares.select((F.col("tokens") / F.col("all")).alias("share"), (F.col("most") / F.col("all")).alias("largest"))
    # ``low`` to ``high`` brackets the change; entropy is met from 0 up, repetition from GRID down.
    falls = target.entropy is not None
    low, high = 0, GRID
    while high - low > 1:
        step = max(1, (high - low) >> HALVINGS)
        asked = list(range(low + step, high, step))
        met = _meets(shares, asked, target)
        if not met:
            return GRID
        for k in asked:
            if met[k] == falls:
                low = k
            else:
                high = k
                break
    if falls:
        return GRID if _meets(shares, [GRID], target).get(GRID) else low
    return 0 if _meets(shares, [0], target).get(0) else high


def budgets(sources: DataFrame, k: int, target: Target) -> DataFrame:
    """key, n_docs, tokens and quota (tokens to use) of every source."""
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.col("all"), F.lit(k / GRID))).otherwise(0.0)
    totals = F.broadcast(sources.agg(F.sum("tokens").alias("all"), F.max("tokens").alias("most")))  # one row
    weighed = sources.crossJoin(totals).withColumn("power", power)
    z = F.broadcast(weighed.agg(F.sum("power").alias("z")))  # one row
    if target.entropy is not None:
        whole = F.col("all")
    else:
        whole = F.col("most") * F.col("z") / F.pow(F.col("most") / F.col("all"), F.lit(k / GRID))
    quota = F.when(F.col("tokens") > 0, F.round(F.col("power") / F.col("z") * whole)).otherwise(0).cast("long")
    return weighed.crossJoin(z).select("key", "n_docs", "tokens", quota.alias("quota"))


def mix(docs: DataFrame, target: Target, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The documents of the mixture: all columns of ``docs``, with mix_tokens, mix_epoch and mix_start.

    ``docs`` has doc_id, text and source. ``mix_start`` is the place of the document's
    first token in its source's stream.
    """
    taken = {"mix_tokens", "mix_epoch", "mix_start"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns in use: {sorted(taken)}")
    small = docs.select(source_key("source").alias("key"), n_words("text").alias("tokens"), "doc_id", F.xxhash64("text").alias("text_hash"))
    sources = stored(source_tokens(small), "sources")
    plan = budgets(sources, exponent(sources, target), target)
    epochs = F.when(F.col("tokens") == 0, 1).otherwise(F.ceil(F.col("quota") / F.greatest("tokens", F.lit(1)))).cast("long")
    plan = plan.withColumns({"n_blocks": F.ceil(F.col("n_docs") / block_docs).cast("long"), "epochs": epochs})
    plan = stored(plan.withColumn("lanes", F.least(F.ceil(F.col("epochs") / LANE_EPOCHS), F.lit(LANES)).cast("long")), "budgets")

    sizes = plan.where("epochs > 0").select("key", "n_blocks", "lanes")
    sizes = F.broadcast(sizes) if sizes.count() <= FEW_SOURCES else sizes
    placed = small.join(sizes, "key").withColumn("block", block_of(F.col("doc_id"), F.col("text_hash")))
    blocks = placed.groupBy("key", "block").agg(F.sum("tokens").alias("block_tokens"))
    turns = blocks.join(plan, "key")
    turns = turns.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("epochs") - 1) / LANE_EPOCHS))))
    last = F.least((F.col("stretch") + 1) * LANE_EPOCHS, "epochs") - 1
    turns = turns.withColumn("mix_epoch", F.explode(F.sequence(F.col("stretch") * LANE_EPOCHS, last)))
    turns = turns.withColumn("order", hashed(F.lit(SEED), F.col("key"), F.col("mix_epoch"), F.col("block")))
    turns = stored(turns.withColumn("range", F.substring("order", 1, 2)), "turns")
    ranges = turns.groupBy("key", "mix_epoch", "range", "tokens").agg(F.sum("block_tokens").alias("range_tokens"))
    # Every epoch uses the whole source, so it begins where as many whole sources end.
    of_epoch = Window.partitionBy("key", "mix_epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("mix_epoch") * F.col("tokens") + F.coalesce(F.sum("range_tokens").over(of_epoch), F.lit(0))
    ranges = ranges.select("key", "mix_epoch", "range", start.alias("range_start"))
    of_range = Window.partitionBy("key", "mix_epoch", "range").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    starts = turns.join(ranges, ["key", "mix_epoch", "range"]).withColumn(
        "block_start", F.col("range_start") + F.coalesce(F.sum("block_tokens").over(of_range), F.lit(0))
    )
    # Of a whole epoch, documents without words at its end are used too.
    chosen = starts.where((F.col("block_start") < F.col("quota")) | ((F.col("mix_epoch") + 1) * F.col("tokens") <= F.col("quota")))
    chosen = chosen.withColumn("lane", F.col("stretch") % F.col("lanes"))
    chosen = stored(chosen.groupBy("key", "block", "lane", "stretch", "quota", F.col("tokens").alias("all_tokens")).agg(
        F.sort_array(F.collect_list(F.struct("mix_epoch", "block_start"))).alias("turns")  # at most one an epoch of the stretch
    ), "chosen")

    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), source_key("source").alias("key"), n_words("text").alias("mix_tokens"),
        F.xxhash64("text").alias("text_hash"),
    )
    rows = rows.join(sizes, "key").withColumn("block", block_of(F.col("doc.doc_id"), F.col("text_hash")))
    order = [hashed(F.lit(SEED), F.col("doc.doc_id"), F.col("text_hash")), F.col("doc.doc_id"), F.col("mix_tokens"), F.col("doc.text")]
    in_block = Window.partitionBy("key", "block").orderBy(*order)
    rows = rows.withColumn("before", F.sum("mix_tokens").over(in_block.rowsBetween(Window.unboundedPreceding, 0)) - F.col("mix_tokens"))
    rows = rows.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1)))
    rows = rows.join(chosen.drop("stretch"), ["key", "block", "lane"])
    rows = rows.withColumn("turn", F.explode("turns")).withColumn("mix_start", F.col("turn.block_start") + F.col("before"))
    rows = rows.where((F.col("mix_start") < F.col("quota")) | ((F.col("turn.mix_epoch") + 1) * F.col("all_tokens") <= F.col("quota")))
    return rows.select("doc.*", "mix_tokens", F.col("turn.mix_epoch").alias("mix_epoch"), "mix_start")


def mixed_documents(docs: DataFrame, target: Target) -> DataFrame:
    """The documents of the mixture with the columns of ``docs``; a document comes once for every epoch that uses it."""
    return mix(docs, target).select(*docs.columns)
