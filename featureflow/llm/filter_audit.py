"""Filter interaction audit by a recursive CTE over filter orders.

Every document becomes a mask with one bit per filter it fails; documents of a
part with equal masks are one cell (at most 2**k cells for k filters).  A
recursive CTE then extends filter prefixes with one unused letter at a time:
each level joins the part's cells, carries the bits applied so far and emits
the metrics of the step just added.  A prefix is worked out once, however many
of the k! orders begin with it (325 prefixes for 120 orders of five).

Only cells and prefixes meet in joins; documents are read once and counted
with partial aggregates, so no part, text or id is gathered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import WORD_PATTERN, cut, stored

MAX_FILTERS = 8     # 8! orders; the result has k * k! rows a part

_LEVELS = """
WITH RECURSIVE prefixes AS (
  SELECT part, 0 AS step, '' AS prefix, '' AS letter, 0 AS applied, CAST(0 AS BIGINT) AS kept,
         CAST(0 AS BIGINT) AS removed, CAST(0 AS BIGINT) AS redundant, CAST(0 AS BIGINT) AS unique_fails,
         CAST(0 AS BIGINT) AS good_lost, CAST(0 AS BIGINT) AS toxic_lost
  FROM {cells}
  UNION ALL
  SELECT part, step, prefix, letter, applied,
         aggregate(filter(cells, x -> x.mask & applied = 0), CAST(0 AS BIGINT), (s, x) -> s + x.n),
         aggregate(gone, CAST(0 AS BIGINT), (s, x) -> s + x.n),
         aggregate(filter(cells, x -> x.mask & bit <> 0 AND x.mask & before <> 0), CAST(0 AS BIGINT), (s, x) -> s + x.n),
         aggregate(filter(cells, x -> x.mask = bit), CAST(0 AS BIGINT), (s, x) -> s + x.n),
         aggregate(gone, CAST(0 AS BIGINT), (s, x) -> s + x.good),
         aggregate(gone, CAST(0 AS BIGINT), (s, x) -> s + x.toxic)
  FROM (SELECT part, step, concat(prefix, next.letter) AS prefix, next.letter AS letter, applied AS before,
               next.bit AS bit, applied | next.bit AS applied, cells,
               filter(cells, x -> x.mask & next.bit <> 0 AND x.mask & applied = 0) AS gone
        FROM (SELECT p.part, p.step + 1 AS step, p.prefix, p.applied, c.cells,
                     explode(filter({letters}, l -> p.applied & l.bit = 0)) AS next
              FROM prefixes p JOIN {cells} c ON c.part = p.part)))
SELECT * FROM prefixes WHERE step > 0"""


def quality_filters(text: Column) -> dict[str, Column | None]:
    """The five filters of the audit query; a true condition fails the document, None stands for a repeated text."""
    words = F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": F.size(words) < 200,
            "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            "C": 100 * capitals > 3 * F.length(text),
            "D": text.rlike("[#$%&*|]"),
            "E": None}


def failure_cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | None], id_col: str = "doc_id",
                  text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled quality 1 and toxic 1, per part and failure mask.

    Bit i of the mask belongs to the i-th filter.  A filter given as None fails
    a document whose text (NULL counts as empty) also belongs to a row with a
    smaller id anywhere in the table; texts are compared by SHA-256.  Every row
    is a document of its own: rows with one id, equal texts included, are never
    each other's smaller copy, and a NULL id neither is nor has a smaller one.
    A document has a label if any row of ``labels`` for its id has it.

    Copies are counted before they meet: equal rows of a task are one row, the
    smallest id of a text is a grouped minimum, and documents find it by
    (text, id), so a text or id that holds a third of all rows stays spread.
    """
    bits = F.lit(0)
    for i, condition in enumerate(filters.values()):
        if condition is not None:
            bits = bits + F.when(condition, F.lit(1 << i)).otherwise(F.lit(0))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit(""))
                        .alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), bits.cast("int").alias("mask"))
            .groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")))
    rows = stored(rows, "audit-rows")
    marks = stored(labels.select(F.col("doc_id").cast("long").alias("id"), "quality", "toxic")
                   .filter("quality = 1 OR toxic = 1").groupBy("id")
                   .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")), "audit-labels")
    # NULL ids match nothing; spread them by their text
    spread = F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("spread", spread).join(marks.withColumn("spread", F.lit(0).cast("long")), ["id", "spread"], "left")
    repeated = [i for i, condition in enumerate(filters.values()) if condition is None]
    if repeated:
        first = rows.filter("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(1))
        rows = rows.join(first, ["digest", "id"], "left").withColumn(
            "mask", F.col("mask") + F.when(F.col("first").isNull() & F.col("id").isNotNull(),
                                           F.lit(sum(1 << i for i in repeated))).otherwise(F.lit(0)))
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(F.lit(0))).alias("toxic"))


def prefix_levels(cells: DataFrame, letters: list[str]) -> DataFrame:
    """One row per part and prefix of filters: the metrics of the prefix's last step (see ``audit``).

    The recursion is computed here, once, into the shared checkpoint folder.
    """
    spark = cells.sparkSession
    packed = cut(cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")))
    table = "array(" + ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters)) + ")"
    # Spark stops a recursion at a number of rows unless told otherwise; ours is bounded by the letters
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return cut(spark.sql(_LEVELS.replace("{letters}", table), cells=packed))
    finally:
        spark.conf.set(limit, before)


def audit(cells: DataFrame, letters: list[str]) -> DataFrame:
    """One row per part, order of all filters and step: what the filter at that step does there.

    ``cells`` is (part, mask, n, good, toxic).  Columns: part, filter_order,
    step (from 1), kept (documents left after the step), removed (by it),
    redundant (failing its filter, removed before), unique_fails (failing its
    filter only), good_lost and toxic_lost (labelled ones removed by it),
    shapley (its filter's removed summed over all orders).  Steps that remove
    nothing are there with zeros; a part without documents has no rows, so an
    empty table gives none.
    """
    k = len(letters)
    if not 0 < k <= MAX_FILTERS or len(set(letters)) < k or any(len(x) != 1 or not x.isalnum() for x in letters):
        raise ValueError(f"filters are named by 1 to {MAX_FILTERS} different letters or digits")
    levels = prefix_levels(cells, letters)
    orders_of = F.element_at(F.array(*[F.lit(math.factorial(k - s)) for s in range(1, k + 1)]), F.col("step"))
    shapley = levels.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders_of).alias("shapley"))
    orders = (levels.filter(F.col("step") == k).select("part", F.col("prefix").alias("filter_order"))
              .withColumn("prefix", F.explode(F.transform(F.sequence(F.lit(1), F.lit(k)),
                                                          lambda s: F.substring("filter_order", F.lit(1), s)))))
    return (orders.join(levels, ["part", "prefix"]).join(shapley, ["part", "letter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                    "toxic_lost", "shapley"))


def filter_interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        part_col: str = "lang") -> DataFrame:
    """``audit`` of the five quality filters over whole texts, per value of ``part_col`` (NULL: empty string).

    NULL and empty texts have no words (they fail A) and are equal to each
    other.  Very long texts are read whole.  Other columns of ``docs`` are not
    read, so their names cannot clash.
    """
    filters = quality_filters(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return audit(failure_cells(docs, labels, filters, id_col, text_col, part_col), list(filters))
