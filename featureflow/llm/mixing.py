"""Mixing sources to target weights by temperature (DataFrame functions only).

A source's weight is its share of the tokens to the power ``alpha``,
normalised: alpha 1 keeps the natural mixture, 0 makes all sources equal.  The
exponent is bisected to meet a target: an entropy of the weights as a share of
the largest possible one, or a limit on how often any source is repeated.

The weights are realised against a token budget.  Every source is a stream of
epochs; an epoch is a pseudo-random permutation of the source's documents made
of blocks (a hash of the document deals it to a block, another orders it
there).  Whole epochs come as often as they fit, and of the last one as many
whole blocks, then documents of one block, as the budget still holds.  The
cumulated sums run in three levels, each inside the one group that holds the
budget's edge: over groups of blocks, over the blocks of one group, and over the
documents of one block.  A window sees at most a source's documents / 2**20
rows, or BLOCK_GROUP blocks, or one block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import WORD_PATTERN, cut, stored

BLOCK_DOCS = 256                    # documents of a block on average
BLOCK_GROUP = 4096                  # blocks whose tokens are summed before any window
MAX_BROADCAST_SOURCES = 100_000     # sources (about 60 bytes each) that may be broadcast
STEPS = 24                          # halvings of the exponent's interval


def _hash(*parts):
    """60 bits of md5 over the parts' text, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("long")


def _measure(sources: DataFrame, lo: float, hi: float, entropy: float | None, repeats: float | None, budget) -> list:
    """(alpha, ok) at 15 inner points of [lo, hi]: four halvings at a time, in one job over the sources' table."""
    grid = F.array(*[F.lit(lo + (hi - lo) * i / 16) for i in range(1, 16)])
    raised = sources.select("tokens", "share", F.explode(grid).alias("alpha")).withColumn(
        "w", F.pow("share", F.col("alpha")))
    rows = raised.groupBy("alpha").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.log("w")).alias("wl"),
                                       F.max(F.col("w") / F.col("tokens")).alias("most"), F.count("*").alias("n"))
    if entropy is not None:             # entropy falls as alpha grows
        ok = F.log("z") - F.col("wl") / F.col("z") >= F.lit(entropy) * F.log(F.col("n"))
    else:                               # the smallest source's repetition falls as alpha grows
        ok = F.col("most") / F.col("z") * budget <= F.lit(repeats)
    return [(r["alpha"], r["ok"]) for r in rows.select("alpha", ok.alias("ok")).orderBy("alpha").collect()]


def exponent(sources: DataFrame, budget: float, entropy: float | None = None, repeats: float | None = None) -> float:
    """The exponent in [0, 1] that meets the target.

    With ``entropy`` (share of the entropy of equal weights): the largest
    exponent whose weights reach it.  With ``repeats``: the smallest one at
    which no source is seen more than ``repeats`` times within ``budget``
    tokens; 1 if even the natural mixture exceeds it.
    """
    lo, hi = 0.0, 1.0
    for _ in range(STEPS // 4):
        points = _measure(sources, lo, hi, entropy, repeats, budget)
        if entropy is not None:
            good = [a for a, ok in points if ok]
            best = max(good) if good else lo
            lo, hi = best, min([a for a, ok in points if a > best], default=hi)
        else:
            good = [a for a, ok in points if ok]
            best = min(good) if good else hi
            lo, hi = max([a for a, ok in points if a < best], default=lo), best
    return round(lo if entropy is not None else hi, 6)


def _with_plan(rows: DataFrame, plan: DataFrame, few: bool) -> DataFrame:
    """Rows with the numbers of their source; a plan of checked size is broadcast, a larger one shuffled."""
    side = F.broadcast(plan) if few else plan
    return rows.join(side, F.col("source").eqNullSafe(F.col("s"))).drop("s")


def _first_beyond(sums: DataFrame, place: str, before) -> DataFrame:
    """(source, edge, before): per source the first place whose running sum of ``n`` exceeds ``rest``,
    and the sum up to it; ``before`` (an aggregate) is what lies before the source's first place here."""
    start = sums.groupBy(F.col("source").alias("s")).agg(before.alias("start"))
    order = Window.partitionBy("source").orderBy(place)
    return (sums.select("source", place, "n", "rest").join(start, F.col("source").eqNullSafe(F.col("s"))).drop("s")
            .withColumn("upto", F.col("start") + F.sum("n").over(order)).filter("upto > rest")
            .groupBy("source").agg(F.min(place).alias("edge"), F.min(F.col("upto") - F.col("n")).alias("before")))


def mix(docs: DataFrame, budget: int | None = None, entropy: float | None = None, repeats: float | None = None,
        seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        with_text: bool = False) -> DataFrame:
    """One row per drawn copy: (id, source, tokens, epoch, block, place, weight[, text]).

    ``budget`` is in tokens (words; default: the table's own total).  Sorting
    by (epoch, block, place) inside a source gives its permutation; epochs
    start at 0.  A source gets whole documents only and never more than
    floor(weight * budget) tokens.

    A NULL source is a source of its own (NULL).  Rows without words carry no
    tokens: they are left out, as nothing of them can be drawn.  Repeated rows
    are drawn like others; ties of the order hash fall to the smaller id.
    Rows without an id are drawn too, dealt by a hash of their text; rows that
    repeat an id share a block.  An empty table gives an empty result.  Column
    names of ``docs`` cannot clash, as only the named columns are read.  Very
    long texts are counted whole; with ``with_text`` every copy carries its own.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("name one target: entropy or repeats")
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD_PATTERN)), F.lit(0))
    text = F.col(text_col).cast("string")
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words.cast("long").alias("tokens"),
                              F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(text))).alias("key"),
                              *([text.alias("text")] if with_text else [])).filter("tokens > 0"), "mixing-rows")
    sources = cut(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    size = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    total, few = size["t"], size["n"] <= MAX_BROADCAST_SOURCES
    budget = total if budget is None else budget
    sources = sources.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    alpha = exponent(sources, float(budget), entropy, repeats) if total else 1.0
    z = sources.agg(F.sum(F.pow("share", F.lit(alpha))).alias("z")).first()["z"] or 1.0
    weight = F.round(F.pow("share", F.lit(alpha)) / F.lit(z), 9)
    plan = cut(sources.select(
        F.col("source").alias("s"), weight.alias("weight"), F.ceil(F.col("docs") / BLOCK_DOCS).alias("blocks"),
        F.floor(weight * F.lit(float(budget))).cast("long").alias("quota"), F.col("tokens").alias("all"))
        .select("s", "weight", "blocks", F.expr("quota div all").alias("whole"),
                (F.col("quota") % F.col("all")).alias("rest")))
    block = F.pmod(_hash(F.lit(seed), F.lit("block"), F.col("key")), F.col("blocks"))
    blocks = cut(_with_plan(rows, plan, few).groupBy("source", block.alias("block"))
                 .agg(F.sum("tokens").alias("n"), F.first("rest").alias("rest"))
                 .withColumn("group", F.floor(F.col("block") / BLOCK_GROUP)))
    groups = _first_beyond(blocks.groupBy("source", "group").agg(F.sum("n").alias("n"), F.first("rest").alias("rest")),
                           "group", F.lit(0).cast("long"))
    # the first block that no longer fits as a whole, and the tokens before it
    inside_group = blocks.join(groups.withColumnRenamed("source", "g"),
                               F.col("source").eqNullSafe(F.col("g")) & (F.col("group") == F.col("edge"))).drop("g", "edge", "group")
    edge = _first_beyond(inside_group, "block", F.first("before")).withColumnRenamed("source", "e")
    plan = cut(plan.join(edge, F.col("s").eqNullSafe(F.col("e"))).drop("e"))
    dealt = (_with_plan(rows, plan, few).withColumn("block", block)
             .withColumn("place", _hash(F.lit(seed), F.lit("place"), F.col("key"))))
    names = ["id", "source", "tokens", "epoch", "block", "place", "weight"] + ["text"] * with_text
    epochs = F.col("whole") + F.when(F.col("block") < F.col("edge"), 1).otherwise(0)
    whole = (dealt.withColumn("copies", epochs).filter("copies > 0")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))))
    inside = (Window.partitionBy("source", "block").orderBy("place", F.col("id").asc_nulls_first(), "tokens")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    part = (dealt.filter("block = edge").withColumn("run", F.sum("tokens").over(inside))
            .filter(F.col("before") + F.col("run") <= F.col("rest")).withColumn("epoch", F.col("whole")))
    return whole.select(*names).unionByName(part.select(*names))
