"""Mixing sources to target weights (DataFrame functions only).

Every document gets a hash-random key.  The keys of a source are sorted by
range: the first hexadecimal digits of the key name one of ``16 ** RANGE_DIGITS``
ranges, word counts are summed by (source, range), a running sum over the few
ranges of a source gives each range its offset, and a running sum inside the
range gives each document its place.  So a source holding a third of all rows
is spread over all ranges, and no task sorts a whole source.

A source with budget ``b`` and size ``s`` is read ``b // s`` times in full;
the rest is cut at the exact word: documents before the cut are taken once
more, the document on the cut in part, those behind it not at all.

Nulls: a null source is a source of its own (ordered last), a null text has
size 0, a null id is keyed as the empty text.  Repeated rows count one by one.
Documents without words take 0 words and are kept out of the mix.  Texts of any
length are counted whole, in memory for a few copies of the text; a cut falls
between words.  An empty table gives an empty result.  Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

# Fixed values of the mix: weights by rank of the source, and the largest share of its own size a source may reach.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# 4096 key ranges a source.
RANGE_DIGITS = 3


def n_words(text: Column) -> Column:
    """Number of words (null: 0).

    Each word and the white space behind it become one letter, and the letters are counted.  ``regexp_count`` would hold
    an array of all words of a text, several times the text's size.
    """
    letters = F.regexp_replace(text, F.lit(f"{common.WORD}{common.SPACE}*"), F.lit("w"))
    return F.coalesce(F.char_length(F.ltrim(letters, F.lit(common.SPACES))), F.lit(0)).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words (n: at least 1, less than there are) joined by a space, without an array of all words."""
    spaced = F.ltrim(F.regexp_replace(text, F.lit(f"{common.SPACE}+"), F.lit(" ")))
    return F.call_function("substring_index", spaced, F.lit(" "), n.cast("int"))


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def source_targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same and ``target``: all words shared by weight, none above its cap.

    With sources ordered by cap / weight, the words left after the first k caps
    divided by the weights left is a level; the largest one is where resharing
    ends, and a target is the smaller of cap and weight * level.  The windows
    run over one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy("_need", "_rank")
    everything = Window.partitionBy()
    weighed = totals.withColumn("_rank", F.row_number().over(by_name))
    weighed = weighed.withColumn("_weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                         ((F.col("_rank") - 1) % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("_cap", F.col("source_size") * max_epochs)
    weighed = weighed.withColumn("_need", F.col("_cap").cast("double") / F.col("_weight"))
    before = F.coalesce(F.sum("_cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    behind = F.sum("_weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    left = F.sum("source_size").over(everything) - before
    levels = weighed.withColumn("_level", left.cast("double") / behind.cast("double"))
    level = F.max("_level").over(everything)
    return levels.select("source", "source_size",
                         F.least(F.col("_cap").cast("double"), F.col("_weight") * level).alias("target"))


def mix(docs: DataFrame, size: Column, carry: Sequence[str] = (), weights: Sequence[int] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Plan of the mix: doc_id, source, the ``carry`` columns, size, source_size, target, taken, epochs, part.

    ``epochs`` full copies of a document are taken and ``part`` words of one more.
    Ties of the key are ordered by id, size and the carried columns.
    """
    key = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 16)
    sized = docs.select("doc_id", "source", *carry, size.cast("long").alias("_size"), key.alias("_key"))
    sized = sized.withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))

    ranges = sized.groupBy("source", "_range").agg(F.sum("_size").alias("_words"))
    totals = ranges.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = source_targets(totals, weights, max_epochs).withColumn("_src", _source_key(F.col("source"))).drop("source")
    running = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("_offset", F.coalesce(F.sum("_words").over(running), F.lit(0)))
    offsets = offsets.select(_source_key(F.col("source")).alias("_src"), "_range", "_offset").join(targets, "_src")

    inside = Window.partitionBy("_src", "_range").orderBy("_key", "doc_id", "_size", *carry)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_src", _source_key(F.col("source"))).join(offsets, ["_src", "_range"])
    placed = placed.withColumn("_place", F.col("_offset") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))

    budget = F.floor("target").cast("long")
    some = F.col("source_size") > 0
    epochs = F.when(some, F.floor(budget / F.when(some, F.col("source_size")))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("_size"), rest - F.col("_place"))).cast("long")
    return placed.select("doc_id", "source", *carry, F.col("_size").alias("size"), "source_size", "target",
                         (epochs * F.col("_size") + part).alias("taken"), epochs.alias("epochs"), part.alias("part"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixed documents: a row for each copy taken; a copy taken in part has its first words, joined by a space."""
    others = [c for c in common.DOCUMENT_COLUMNS if c not in ("doc_id", "source")]
    plan = mix(docs, n_words(F.col("text")), carry=others)
    cut = first_words(F.col("text"), F.col("part"))
    whole = F.col("epochs") + F.when(F.col("part") == F.col("size"), 1).otherwise(0)
    some = F.when((F.col("part") > 0) & (F.col("part") < F.col("size")), 1).otherwise(0)
    taken = plan.filter(F.col("size") > 0).withColumn("_whole", whole).withColumn("_copies", whole + some).filter("_copies > 0")
    copies = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    in_part = F.col("_copy") > F.col("_whole")
    copies = copies.withColumn("n_chars", F.when(in_part, F.char_length(cut).cast("long")).otherwise(F.col("n_chars")))
    return copies.withColumn("text", F.when(in_part, cut).otherwise(F.col("text"))).select(*common.DOCUMENT_COLUMNS)


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the mix of all documents.  The narrow table of sizes is staged, so texts are read once."""
    docs = common.read_table(spark, sf_dir, "documents")
    sizes = common.staged(docs.select("doc_id", "source", n_words(F.col("text")).alias("words")), "mixing")
    return mix(sizes, F.col("words")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM r),
l AS (SELECT *, CAST((sum(source_size) OVER ())::BIGINT
        - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS DOUBLE)
        / CAST(sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
      FROM w),
t AS (SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs,
        CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size AS rest,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - place)) AS BIGINT) AS taken
FROM p
"""
