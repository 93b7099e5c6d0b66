"""Mixing sources to target weights by Pareto order sampling.

Each source has a weight and a target number of words. A document is first
given the whole copies that are certain: as many as the target holds the source
whole, and one more where its inclusion probability reaches 1. The rest of the
target is a sample without replacement, of a size fixed in words. Inclusion is
proportional to a document's size (``_inclusion``): a source's probabilities
times sizes sum to the words that it still needs. Documents are ranked by their
random odds divided by their inclusion odds (Rosén's Pareto sampling) and taken
in that order while they fit; one that doesn't fit is passed over. When none
fits, the smallest that is left is taken if that comes nearer, so a source ends
within half of the smallest document left.

DataFrame functions only. No source is ordered as a whole: ranks are cut
into ``cells`` equal ranges, the ranges' words are summed, and only the
documents of the one range in which a source's target falls are ordered, so a
source that holds a third of all rows costs no large task. What is passed over
is looked at again in rounds, each over the documents that still fit.

Defined results: a null or empty text has size 0 and is taken with 0 words; a
null source is a source of its own, last in order; rows with equal ids are
separate documents and tie-break by text; a text of any length is counted by one
pattern, a row at a time; an empty table gives an empty result; further columns
are kept whatever their names, but for ``keep`` columns of ``mix`` named like its
own results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoengine.llm.common import WORD_PATTERN, save, table

SHARE = 1.5
WEIGHTS = (3, 1, 2)
MAX_REPEAT = 2
SEED = "mix-1"
CELLS = 4096


def n_words(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from a key: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, share: float = SHARE, weights: Sequence[int] = WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from (source, size): the sources, by code
    point with null last, carry ``weights`` in turn and share ``share`` of all
    words; a target stops at ``max_repeat`` times its source's words and the
    excess goes to the others by weight. One row a source, so the ordered
    windows here see sources, not documents."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    per = per.withColumn("_w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn))
    per = per.withColumn("_cap", F.col("source_size") * F.lit(max_repeat))
    # sources whose cap is small for their weight are filled first: going up
    # by cap / weight, a source is capped if the level of what remains passes it
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("_level", (F.sum("source_size").over(everything) * F.lit(float(share))
                                    - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
                         / F.sum("_w").over(onward))
    per = per.withColumn("_capped", F.col("_cap") <= F.col("_w") * F.col("_level"))
    level = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(everything)
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(F.col("_w") * level)
    return per.withColumn("target", target).select("source", "source_size", "target")


#: Rows of a per-source table that are broadcast, at most.
FEW = 100_000


def _by_source(rows: DataFrame, per: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``per``, one row a source: broadcast if the
    counted sources are few, so that a hot source's rows stay where they are."""
    named = per.withColumnRenamed("source", "_source")
    named = F.broadcast(named) if per.count() <= FEW else named
    return rows.join(named, rows["source"].eqNullSafe(named["_source"]), how).drop("_source")


def _inclusion(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with _certain and _rate: documents of a source of size
    _certain or more are certain, others are included with _rate times their
    size; sizes times probabilities sum to _rest. Largest first, a size is certain
    if its probability would reach 1 after all larger ones are; a source has a row
    for each of its sizes here, and squares are summed as decimals, exactly."""
    square = (F.col("size") * F.col("size")).cast("decimal(38,0)")
    sizes = _by_source(sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("_n")), targets.select("source", "_rest"))
    larger = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    words = F.col("_rest") - F.coalesce(F.sum(F.col("size") * F.col("_n")).over(larger), F.lit(0))
    squares = F.sum((square * F.col("_n")).cast("decimal(38,0)")).over(onward).cast("double")
    sizes = sizes.withColumns({"_words": words, "_squares": squares})
    sizes = sizes.withColumn("_sure", (F.col("_words") > 0) & (F.col("size") * F.col("_words") >= F.col("_squares")))
    found = sizes.groupBy("source").agg(
        F.min(F.when(F.col("_sure"), F.col("size"))).alias("_certain"),
        F.max_by(F.when(F.col("_words") > 0, F.col("_words") / F.col("_squares")).otherwise(0.0),
                 F.when(~F.col("_sure"), F.col("size"))).alias("_rate"))
    return _by_source(targets, found, "left")


def _prefix(rows: DataFrame, cells: int) -> DataFrame:
    """``rows`` (source, size, _odds, doc_id, _tie, _rest) with _in: taken in the
    order of _odds while the source's words stay within _rest."""
    rows = rows.withColumn("_cell", F.floor(F.col("_odds") / (1 + F.col("_odds")) * cells).cast("int"))
    sums = rows.groupBy("source", "_cell").agg(F.sum("size").alias("_words"), F.first("_rest").alias("_limit"))
    up = Window.partitionBy("source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # cells, not documents
    sums = sums.withColumn("_before", F.coalesce(F.sum("_words").over(up), F.lit(0)))
    cut = sums.where(F.col("_before") <= F.col("_limit")).groupBy("source").agg(F.max("_cell").alias("_cut"), F.max("_before").alias("_before"))
    placed = _by_source(rows, cut, "left")
    inner = placed.where(F.col("_cell") == F.col("_cut"))
    outer = placed.where(F.col("_cut").isNull() | (F.col("_cell") != F.col("_cut")))
    along = Window.partitionBy("source", "_cell").orderBy("_odds", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = inner.withColumn("_in", F.col("_before") + F.sum("size").over(along) <= F.col("_rest"))
    return inner.unionByName(outer.withColumn("_in", F.coalesce(F.col("_cell") < F.col("_cut"), F.lit(False)))).drop("_cell", "_cut", "_before")


def mix(docs: DataFrame, share: float = SHARE, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT,
        seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        cells: int = CELLS, keep: Sequence[str] = ()) -> DataFrame:
    """One row a document: (doc_id, size, source, source_size, target, copies,
    taken) and the columns named by ``keep``."""
    sized = save(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"),
        uniform(F.col(id_col), seed).alias("_u"), F.xxhash64(F.col(text_col)).alias("_tie"), F.monotonically_increasing_id().alias("_row"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep]), "mix-sizes")
    targets = source_targets(sized, share, weights, max_repeat)
    targets = targets.withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                                 .otherwise(F.lit(0)).cast("long"))
    targets = save(targets.withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")), "mix-targets")
    chances = save(_inclusion(sized, targets), "mix-chances")

    ranked = _by_source(sized, chances)
    chance = F.col("_rate") * F.col("size")
    odds = (F.col("_u") / (1 - F.col("_u"))) / (chance / (1 - chance))
    ranked = ranked.withColumn("_odds", F.when(F.col("size") >= F.col("_certain"), 0.0).when((F.col("size") > 0) & (chance > 0), odds))
    drawn = save(_prefix(ranked.where("_odds is not null"), cells), "mix-drawn")

    # past what didn't fit: the documents that still do, until none does
    order = ("source", "size", "_odds", "doc_id", "_tie", "_row")
    gaps = save(drawn.groupBy("source").agg((F.first("_rest") - F.sum(F.when(F.col("_in"), F.col("size")).otherwise(0))).alias("_gap")), "mix-gaps")
    left, chosen = drawn.where(~F.col("_in")).select(*order), drawn.where("false").select(*order)
    while True:
        fits = _by_source(left, gaps).where(F.col("size") <= F.col("_gap"))
        fits = save(fits.select(*order, F.col("_gap").alias("_rest")), "mix-fits")
        if not fits.limit(1).count():
            break
        step = save(_prefix(fits, cells), "mix-step")
        more = step.where("_in").groupBy("source").agg(F.sum("size").alias("_more"))
        gaps = save(_by_source(gaps, more, "left").select("source", (F.col("_gap") - F.coalesce("_more", F.lit(0))).alias("_gap")), "mix-gaps")
        chosen = chosen.unionByName(step.where("_in").select(*order))
        left = step.where(~F.col("_in")).select(*order)
    chosen = save(chosen.select("_row"), "mix-chosen")

    # none fits any more: the smallest that is left, if that comes nearer
    over = _by_source(drawn.where(~F.col("_in")).join(chosen, "_row", "left_anti"), gaps).where(F.col("size") - F.col("_gap") < F.col("_gap"))
    last = over.groupBy("source").agg(F.min(F.struct("size", "_odds", "doc_id", "_tie", "_row"))["_row"].alias("_row")).select("_row")
    once = drawn.where("_in").select("_row").unionByName(chosen).unionByName(last).withColumn("_once", F.lit(1).cast("long"))
    out = _by_source(sized.join(once, "_row", "left"), targets)
    copies = (F.col("_whole") + F.coalesce("_once", F.lit(0))).cast("int")
    fixed = ("doc_id", "size", "source", "source_size", "target", "copies", "taken")
    return out.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                      (F.col("size") * copies).cast("long").alias("taken"),
                      *[F.col(f"_keep_{c}").alias(c) for c in keep if c not in fixed])


def mixed_rows(docs: DataFrame, **params) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with the
    columns it came with (documents taken 0 times go). Rows are numbered and
    stored first, so that any frame will do."""
    row = next(n for i in range(len(docs.columns) + 1) if (n := f"__mix_row{i}") not in docs.columns)
    numbered = save(docs.withColumn(row, F.monotonically_increasing_id()), "mix-numbered")
    times = mix(numbered, keep=[row], **params).where("copies > 0").select(row, F.col("copies").alias("__copies"))
    each = numbered.join(times, row).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__nth"))
    return each.select(*docs.columns)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source", "source_size", "target", "copies", "taken")


ORACLE = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('{SEED}:' || doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / {float(1 << 52)!r} AS u
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size,
               [{', '.join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT] AS w
        FROM sized GROUP BY source),
levels AS (SELECT *, source_size * {MAX_REPEAT} AS cap,
    (sum(source_size) OVER () * {SHARE!r}::DOUBLE - coalesce(sum(source_size * {MAX_REPEAT}) OVER (ORDER BY source_size * {MAX_REPEAT} / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(w) OVER (ORDER BY source_size * {MAX_REPEAT} / w::DOUBLE, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM per),
targets AS (SELECT source, source_size,
    CASE WHEN cap <= w * level THEN cap::DOUBLE ELSE w * max(level) FILTER (WHERE cap > w * level) OVER () END AS target FROM levels),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
rests AS (SELECT *, target - whole * source_size AS rest FROM parts),
classes AS (SELECT s.source, s.size, count(*) AS n, any_value(rest) AS rest FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
  WHERE size > 0 GROUP BY s.source, s.size),
sums AS (SELECT *, rest - coalesce(sum(size * n) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
    (sum(size::HUGEINT * size * n) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS squares FROM classes),
sures AS (SELECT *, words > 0 AND size * words >= squares AS sure FROM sums),
rates AS (SELECT source, min(size) FILTER (WHERE sure) AS certain,
    max_by(CASE WHEN words > 0 THEN words / squares ELSE 0 END, size) FILTER (WHERE NOT sure) AS rate FROM sures GROUP BY source),
ranked AS (SELECT s.doc_id, s.source, s.size, r.rest, CASE WHEN s.size >= certain THEN 0.0::DOUBLE
    WHEN s.size > 0 AND rate * s.size > 0 THEN (u / (1 - u)) / (rate * s.size / (1 - rate * s.size)) END AS odds
  FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source LEFT JOIN rates c ON s.source IS NOT DISTINCT FROM c.source),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY odds, doc_id) AS place,
    sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id ROWS UNBOUNDED PRECEDING) <= rest AS inside FROM ranked WHERE odds IS NOT NULL),
walk(source, place, gap) AS (
  SELECT source, coalesce(max(place) FILTER (WHERE inside), 0), any_value(rest) - coalesce(sum(size) FILTER (WHERE inside), 0) FROM placed GROUP BY source
  UNION ALL SELECT w.source, min(p.place), any_value(w.gap) - min_by(p.size, p.place)
  FROM walk w JOIN placed p ON w.source IS NOT DISTINCT FROM p.source AND p.place > w.place AND p.size <= w.gap GROUP BY w.source),
ends AS (SELECT source, min(gap) AS gap FROM walk GROUP BY source),
passed AS (SELECT p.*, p.inside OR w.place IS NOT NULL AS fits FROM placed p LEFT JOIN walk w ON p.source IS NOT DISTINCT FROM w.source AND p.place = w.place),
smallest AS (SELECT p.source, min_by(p.place, (p.size, p.odds, p.doc_id)) AS place FROM passed p JOIN ends e ON p.source IS NOT DISTINCT FROM e.source
  WHERE NOT fits AND p.size - e.gap < e.gap GROUP BY p.source),
chosen AS (SELECT p.doc_id, p.source FROM passed p LEFT JOIN smallest m ON p.source IS NOT DISTINCT FROM m.source AND p.place = m.place
  WHERE p.fits OR m.place IS NOT NULL),
copied AS (SELECT s.doc_id, s.size, s.source, r.source_size, r.target, (r.whole + CASE WHEN c.doc_id IS NULL THEN 0 ELSE 1 END)::INT AS copies
  FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source LEFT JOIN chosen c ON s.doc_id = c.doc_id AND s.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source, source_size, target, copies, (size * copies)::BIGINT AS taken FROM copied
"""
