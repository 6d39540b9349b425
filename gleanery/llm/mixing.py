"""Mixing of sources to target weights, by Pareto order sampling.

The words of the mix are shared out over the sources by weight. No source gives more than `most` times its words; what it
cannot take is shared out among the others by weight, until none is above. That is a water level: with the sources in order of
capacity by weight, those up to some place are full and all others get their weight times one level.

Within a source, every document is taken whole as often as the source's target holds its words; these copies are certain. What
is left of the target is filled by a sample in which a document's inclusion probability is in proportion to its words, at
most one: documents that reach one are certain as well, so no large document decides by chance how far a source is from its
target. The others get a random number u from their id and text, and are ranked by the odds of u over the odds of their
inclusion probability; the first of them are taken up to the sample's fixed size, which is counted in words. The document on
the border gives its first words only, so each source meets its target to the word.

The border of a source is found by radix: words are summed by source and the next bits of the rank, which combines before the
shuffle, and only rows of the digit that holds the border go on. No window and no task ever sees the documents of a source.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import released, written
from gleanery.sources.files import table

WEIGHTS = (3, 1, 2)
SHARE, MOST, SEED = 1.5, 2, 42
WORD = r"[^\x20\x09-\x0D]+"
BITS = 12  # bits of the rank in a digit
SMALL = 100_000  # sources, of which a table with one row each is broadcast


def counted(batches):
    """Batches whose column `text` is counted: its number of words is added as the last column."""
    for batch in batches:
        size = pc.fill_null(pc.count_substring_regex(batch.column(batch.schema.names.index("text")), pattern=WORD), 0)
        cols, names = [size.cast(pa.int64())], ["size"]
        for name, col in zip(batch.schema.names, batch.columns, strict=True):
            if name != "text":
                cols.append(col)
                names.append(name)
        yield pa.RecordBatch.from_arrays(cols, names)


def by_source(df: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """df joined with a table of one row a source; null is a source. A table of many sources is not broadcast."""
    right = sources.withColumnRenamed("source", "_s")
    return df.join(F.broadcast(right) if few else right, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of rows (source, size). In the order of sources by code point, null last, the weights
    repeat. One task sees one row of three numbers a source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(turn - 1, F.lit(len(weights))) + 1))
    per = per.withColumn("at", F.row_number().over(Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())))
    # full before a row, and weight from the row on
    every = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.select("*", F.sum("source_size").over(every).alias("total"), F.sum("source_size").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("weight").over(Window.orderBy("at").rowsBetween(0, Window.unboundedFollowing)).alias("open"))
    cap = F.lit(float(most)) * F.col("source_size")
    level = (F.lit(float(share)) * F.col("total") - F.lit(float(most)) * (F.col("upto") - F.col("source_size"))) / F.col("open")
    per = per.withColumn("level", F.min_by(F.when(level * F.col("weight") <= cap, level), F.when(level * F.col("weight") <= cap, F.col("at"))).over(every))
    return per.select("source", "source_size", F.coalesce(F.least(cap, F.col("level") * F.col("weight")), cap).alias("target"))


def uniform(key: Column) -> Column:
    """A number within (0, 1) from the first 52 bits of the key's MD5."""
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def inclusion(sized: DataFrame, targets: DataFrame, few: bool) -> DataFrame:
    """The targets with `copies` (certain whole copies of every document), `least` (size from which documents are certain to be
    in the sample), `scale` (inclusion probability a word of all others) and `part` (words that those others give).

    Works on counts by source and size: with sizes in descending order, the certain ones are those up to some place.
    """
    want = F.floor("target")
    goals = targets.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(want / F.greatest("source_size", F.lit(1)))).otherwise(0))
    goals = goals.withColumn("rest", want - F.col("copies") * F.col("source_size"))
    bins = sized.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    down = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    words, squares = F.col("size") * F.col("n"), F.col("size").cast("decimal(18,0)") * F.col("size").cast("decimal(18,0)") * F.col("n")
    sums = bins.select("source", "size", (F.sum(words).over(down) - words).alias("above"), F.sum(squares.cast("decimal(28,0)")).over(up).cast("double").alias("below"))
    sums = by_source(sums, goals.select("source", "rest"), few).withColumn("scale", (F.col("rest") - F.col("above")) / F.col("below"))
    found = sums.filter(F.col("scale") * F.col("size") < 1).groupBy("source").agg(F.max_by(F.struct("size", "scale", (F.col("rest") - F.col("above")).alias("part")), "size").alias("f"))
    out = goals.join(found.select(F.col("source").alias("_s"), "f.*"), F.col("source").eqNullSafe(F.col("_s")), "left")
    return out.select("source", "source_size", "target", F.col("copies").cast("long"), F.coalesce(F.col("size") + 1, F.lit(1)).alias("least"), F.coalesce("scale", F.lit(0.0)).alias("scale"), F.coalesce("part", F.lit(0)).cast("long").alias("part"))


def pareto_rank(u: Column, p: Column) -> Column:
    """Odds of u over odds of p, as x / (1 + x), which is within (0, 1) and ranks alike."""
    x = (u / (1 - u)) * ((1 - p) / p)
    return x / (1 + x)


def borders(ranked: DataFrame, goals: DataFrame, few: bool) -> DataFrame:
    """(source, border, each): rows with a lower rank than the border are taken, those of that rank give `each` words.

    ranked: (source, size, rank). Rows of one rank, as equal rows are, are treated alike: they share what is left evenly.
    """
    left = goals.filter("part > 0").select("source", F.col("part").alias("left"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("d").rowsBetween(Window.unboundedPreceding, 0))
    rows = ranked
    for digit in (F.floor(F.col("rank") * float(1 << BITS)), F.floor(F.col("rank") * float(1 << 2 * BITS)), F.col("rank")):
        sums = rows.groupBy("source", digit.alias("d")).agg(F.sum("size").alias("words"), F.count("*").alias("n")).withColumn("upto", upto)
        past = by_source(sums, left, few).filter(F.col("upto") >= F.col("left"))
        border = past.groupBy("source").agg(F.min_by(F.struct("d", (F.col("left") - F.col("upto") + F.col("words")).alias("left"), "n"), "d").alias("b"))
        border = written(border.select("source", "b.*"), "mix-border")
        left = border.select("source", "left")
        rows = written(by_source(rows, border.select("source", "d"), few).filter(digit == F.col("d")).drop("d"), "mix-rows")
    return border.select("source", F.col("d").alias("border"), F.floor(F.col("left") / F.col("n")).alias("each"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target, copies, taken, and the columns named in keep.

    taken is what the mix takes: `copies` times the whole document and, if more, its first words once again. Null
    and empty texts have no words, and nothing is taken of them; a null source is one of its own. A null id counts as an empty string.
    Repeated rows share one rank and give the same number of words each; so do texts of one id that share it by chance. A table
    without rows, or without words, gives rows with target 0 or none. Other columns are left out whatever their names.
    Very long texts are counted where they lie in the batch. Reruns agree: numbers come from id, text and seed alone.
    """
    text = F.col("text").cast("string")
    doc = F.col("doc_id").cast("long")
    u = uniform(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    rows = docs.select(doc.alias("doc_id"), F.col("source").cast("string").alias("source"), u.alias("u"), text.alias("text"), *(F.col(f"`{c}`").alias(f"keep_{c}") for c in keep))
    schema = ", ".join(["size long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")])
    sized = written(rows.mapInArrow(released(counted), schema), "mix-sizes")
    targets = written(source_targets(sized, weights, share, most), "mix-targets")
    few = targets.count() <= SMALL
    goals = written(inclusion(sized, targets, few), "mix-goals")
    p = F.col("scale") * F.col("size")
    sampled = by_source(sized.select("source", "size", "u"), goals.select("source", "least", "scale", "part"), few).filter("size > 0 and size < least and part > 0")
    border = borders(sampled.select("source", "size", pareto_rank(F.col("u"), p).alias("rank")), goals, few)
    goals = written(goals.join(border.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-goals")
    drawn = (F.col("part") > 0) & (F.col("size") < F.col("least"))
    rank = F.when(drawn & (F.col("size") > 0), pareto_rank(F.col("u"), p))
    extra = F.when(F.col("size") >= F.col("least"), F.col("size")).when(rank < F.col("border"), F.col("size")).when(rank == F.col("border"), F.least("size", "each")).otherwise(0)
    out = by_source(sized, goals, few).withColumn("taken", (F.col("copies") * F.col("size") + extra).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).alias("copies"), "taken", *(F.col(f"`keep_{c}`").alias(c) for c in keep))


def repeated(mixed: DataFrame) -> DataFrame:
    """The documents of a mix with `keep` as often as it takes them: `copy` counts from 0, `words` is how many of the text's
    words count, fewer than all only in the last copy."""
    times = F.col("copies") + F.when(F.col("taken") > F.col("copies") * F.col("size"), 1).otherwise(0)
    rows = mixed.filter("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
    return rows.withColumn("words", F.least("size", F.col("taken") - F.col("copy") * F.col("size")))


def op12_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST('0x' || md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')))[1:13] AS UBIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS weight
  FROM sized GROUP BY source
), turns AS (
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS k FROM per
), sums AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE AS total, (sum(source_size) OVER (ORDER BY k) - source_size)::DOUBLE AS filled, sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS opened FROM turns
), levels AS (
  SELECT *, (1.5::DOUBLE * total - 2.0::DOUBLE * filled) / opened AS lev FROM sums
), level AS (
  SELECT min_by(lev, k) AS lev FROM levels WHERE lev * weight <= 2.0::DOUBLE * source_size
), targets AS (
  SELECT source, source_size, coalesce(least(2.0::DOUBLE * source_size, level.lev * weight), 2.0::DOUBLE * source_size) AS target FROM per, level
), goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS copies FROM targets
), goals2 AS (
  SELECT *, CAST(floor(target) AS BIGINT) - copies * source_size AS rest FROM goals
), bins AS (
  SELECT source, size, count(*) AS n FROM sized WHERE size > 0 GROUP BY source, size
), falling AS (
  SELECT source, size, CAST(sum(size * n) OVER (PARTITION BY source ORDER BY size DESC) - size * n AS BIGINT) AS above,
    (sum(size::HUGEINT * size * n) OVER (PARTITION BY source ORDER BY size))::DOUBLE AS below
  FROM bins
), scales AS (
  SELECT f.source, size, above, rest, (rest - above)::DOUBLE / below AS scale FROM falling f JOIN goals2 g ON f.source IS NOT DISTINCT FROM g.source
), found AS (
  SELECT source, max(size) AS size, max_by(scale, size) AS scale, max_by(rest - above, size) AS part FROM scales WHERE scale * size < 1 GROUP BY source
), every AS (
  SELECT s.doc_id, s.source, s.size, g.source_size, g.target, g.copies, s.size > f.size AS certain, f.part,
    CASE WHEN s.size > 0 AND s.size <= f.size AND f.part > 0 THEN (s.u / (1 - s.u)) * ((1 - f.scale * s.size) / (f.scale * s.size)) END AS x
  FROM sized s JOIN goals2 g ON s.source IS NOT DISTINCT FROM g.source LEFT JOIN found f ON s.source IS NOT DISTINCT FROM f.source
), ranked AS (
  SELECT source, x / (1 + x) AS r, part, sum(size) AS words, count(*) AS n FROM every WHERE x IS NOT NULL GROUP BY ALL
), filled AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY r) AS upto FROM ranked
)
SELECT e.doc_id, e.size, e.source_size, e.target,
  CAST(e.copies * e.size + CASE WHEN e.certain THEN e.size WHEN e.x IS NULL THEN 0 WHEN f.upto < f.part THEN e.size WHEN f.upto - f.words < f.part THEN least(e.size, (f.part - f.upto + f.words) // f.n) ELSE 0 END AS BIGINT) AS taken
FROM every e LEFT JOIN filled f ON e.source IS NOT DISTINCT FROM f.source AND e.x / (1 + e.x) = f.r
"""

QUERIES = {"op12_pareto_mixing": op12_pareto_mixing}
ORACLE = {"op12_pareto_mixing": SQL}
