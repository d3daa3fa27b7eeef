"""Mix sources to target weights: random order per source, distributed prefix sums, exact budgets.

Sources are ranked by code point, null last, and weigh 5, 2, 1, repeating.  They share 150 % of all
words by weight; a source's target stops at twice its size and the excess is shared again by weight
among the others, until none is above.  That end state is the water level w with
``sum(min(weight * w, 2 * size)) = 1.5 * sum(size)``, found with one sorted prefix sum over sources.

Within a source every document gets a hash-random key (MD5 of its id).  Keys are dealt into ranges,
each range's words are added up, a prefix sum over ranges gives where a range starts, and a prefix
sum inside each range gives where each document starts.  No task sees more than one range.  A range is
a run of hash prefixes, so a hot source is just more ranges; their number follows the row count and is
256 at least.  The number changes no result.

A budget of ``b`` words over a source of ``s`` words is ``b div s`` whole epochs and a last one that
is cut after exactly ``b mod s`` words, inside a document if need be.

Defined cases: a null text, an empty text or one of white space has size 0 and is taken 0 times; a
source whose documents are all empty has target 0; null sources form one source; null doc_ids and
repeated rows are documents like others (equal keys are ordered by id and size, then it makes no
difference which row comes first); an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logweir.llm.common import SPACE, WORD, cut, packed, unpacked, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
ROWS_PER_RANGE = 50_000
LEAST_BITS = 8


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: source, source_size, n_docs, target.  Works on a row per source, not on documents."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_rank = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = (per.withColumn("rank", F.row_number().over(by_rank)).withColumn("weight", weight.cast("long"))
              .withColumn("cap", F.col("source_size") * MOST_EPOCHS))
    # Sources in the order in which a rising level fills them up.
    filling = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("rank").asc())
    up_to, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum("cap").over(up_to), F.lit(0)))
             / F.sum("weight").over(after))
    # The level if all before are full; it holds from the first source that it does not fill.
    ranked = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    holds = F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("weight")).alias("at"), "rank", "level"))).over(everything)
    final = F.col("holds")["level"]
    return (ranked.withColumn("holds", holds)
            .withColumn("target", F.when(final.isNull() | (final * F.col("weight") >= F.col("cap")), F.col("cap").cast("double"))
                        .otherwise(final * F.col("weight")))
            .select("source", "source_size", "n_docs", "target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Every document with the words the mix takes of it: doc_id, source, key, size, source_size, target, taken."""
    sizes = cut(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")).alias("key"),
    ))
    per_source = cut(targets(sizes, weights))
    # Ranges of the first 24 bits of the key; a power of two of them, 256 or as many as the largest source needs.
    most = per_source.agg(F.max("n_docs")).first()[0] or 0
    bits = max(LEAST_BITS, min(24, (most // rows_per_range).bit_length()))
    keyed = sizes.withColumn("part", F.shiftright(F.conv(F.substring("key", 1, 6), 16, 10).cast("int"), 24 - bits))
    by_part = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (keyed.groupBy("source", "part").agg(F.sum("size").alias("words"))
              .select("source", "part", F.coalesce(F.sum("words").over(by_part), F.lit(0)).alias("part_start")))
    inside = (Window.partitionBy("source", "part").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = keyed.withColumn("within", F.sum("size").over(inside) - F.col("size"))
    dealt = (placed.alias("d")
             .join(starts.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.part") == F.col("s.part")))
             .select("d.*", "s.part_start"))
    return (dealt.alias("d")
            .join(per_source.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
            .select("doc_id", "d.source", "key", "size", "source_size", "target",
                    taken(F.col("size"), F.col("source_size"), F.col("target"), F.col("part_start") + F.col("within")).alias("taken")))


def taken(size: Column, source_size: Column, target: Column, start: Column) -> Column:
    budget = F.floor(target + 0.5).cast("long")
    whole = F.when(source_size > 0, F.floor(budget / source_size)).otherwise(0).cast("long")
    rest = budget - whole * source_size
    return (whole * size + F.least(F.greatest(rest - start, F.lit(0)), size)).cast("long")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: a document taken in full once per epoch, and cut after its last word taken.

    Keeps the columns of ``docs``.  Documents of which nothing is taken are not in it.
    """
    # Rows that agree in id, source and size share the words taken of them, so each row is matched once.
    amounts = (mix(docs).groupBy(F.col("doc_id").alias("a_id"), F.col("source").alias("a_source"), F.col("size").alias("a_size"))
               .agg(F.sort_array(F.collect_list("taken"), asc=False).alias("shares")))
    sized = packed(docs).select("row", "body", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"),
                                word_count(F.col("body")).alias("size"))
    twin = Window.partitionBy("doc_id", "source", "size").orderBy("body")
    joined = sized.withColumn("twin", F.row_number().over(twin)).join(
        amounts, F.col("doc_id").eqNullSafe(F.col("a_id")) & F.col("source").eqNullSafe(F.col("a_source")) & (F.col("size") == F.col("a_size")))
    dealt = joined.withColumn("taken", F.element_at("shares", F.col("twin"))).filter("taken > 0")
    epochs = F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1))
    copies = dealt.withColumn("epoch", epochs).withColumn("words", F.least(F.col("taken") - F.col("epoch") * F.col("size"), F.col("size")))
    pieces = F.regexp_extract_all("body", F.lit(f"(?:{SPACE})?{WORD}"), F.lit(0))
    head = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    return unpacked(copies.withColumn("body", F.when(F.col("words") == F.col("size"), F.col("body")).otherwise(head)), docs, text_changed=True)


ORACLE = """
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank FROM per),
weighted AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM ranked),
-- a source stays open while the level that fills those with a smaller ratio leaves it below its cap
levels AS (
  SELECT a.*, (1.5 * (SELECT sum(source_size) FROM per)
               - coalesce((SELECT sum(b.cap) FROM weighted b WHERE (b.cap / b.weight, b.rank) < (a.cap / a.weight, a.rank)), 0))
              / (SELECT sum(b.weight) FROM weighted b WHERE (b.cap / b.weight, b.rank) >= (a.cap / a.weight, a.rank)) AS level
  FROM weighted a),
final AS (SELECT level FROM levels WHERE level * weight < cap ORDER BY cap / weight, rank LIMIT 1),
targets AS (
  SELECT w.source, w.source_size,
         CASE WHEN f.level IS NULL OR f.level * w.weight >= w.cap THEN CAST(w.cap AS DOUBLE) ELSE CAST(f.level * w.weight AS DOUBLE) END AS target
  FROM weighted w LEFT JOIN final f ON TRUE),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + least(greatest(budget % source_size - start, 0), size) END AS BIGINT) AS taken
FROM placed
"""
