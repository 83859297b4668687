"""Mix sources to target weights by Pareto order sampling, in DataFrame operations only.

A source's share of the mix follows its weight but stops at ``most`` times its
size; what is over goes to the others by weight. Within a source the share is
spread over size classes in the same way, shorter documents first, which gives
every document its expected copies. Whole copies are certain; the rest is an
inclusion probability p. Documents are ranked by u / (1 - u) divided by
p / (1 - p), u a random number fixed by the id, and taken in that order until
the source's words are reached.

The order is never sorted as a whole: documents fall into cells by their rank
value, cells are added up per source, and only the one cell in which the target
is reached is put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aidmatch.llm.common import WORD, numbered_documents, rows_times, whole_text
from aidmatch.workspace import checkpointed, scratch

#: Of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix in percent of all words.
PERCENT = 150
MOST = 2
CELLS = 4096
#: Weight of a size class of documents: classes go by powers of two of the words.
CLASSES = 64
COPIES_AT_ONCE = 10_000


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(source, source_size, nth): ``nth`` counts sources in code point order from 0, null last.

    The order is a distributed sort; only the number of sources in each of its
    partitions is added up in one place.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ordered = checkpointed(
        totals.orderBy(F.col("source").asc_nulls_last()).withColumn("place", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("place", 33))
    parts = ordered.groupBy("part").agg(F.count("*").alias("many"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("start"))
    return ordered.join(starts, "part").select(
        "source", "source_size", (F.col("start") + F.col("place") - F.shiftleft("part", 33)).alias("nth")
    )


def source_targets(sources: DataFrame) -> DataFrame:
    """Add ``target``: the words of each source in the mix."""
    weights = F.array(*map(F.lit, WEIGHTS))
    sources = checkpointed(sources.withColumn(
        "weight", F.element_at(weights, (F.col("nth") % len(WEIGHTS)).cast("int") + 1).cast("bigint")
    ))
    full = F.col("source_size") * MOST
    total = sources.agg(F.sum("source_size")).first()[0]
    if not total:
        return sources.withColumn("target", F.lit(0.0))
    level = 0.0
    while True:  # each turn fills at least one more class of sources up to its bound, and reads one row
        # by division, as the test for the bound below
        capped = full <= F.lit(level) * F.col("weight")
        taken, open_ = sources.agg(
            F.coalesce(F.sum(F.when(capped, full)), F.lit(0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0))
        ).first()
        if not open_:
            break
        up = (total * PERCENT / 100 - taken) / open_
        if up <= level:
            break
        level = up
    return sources.withColumn("target", F.least(full.cast("double"), F.lit(level) * F.col("weight")))


def _expected(sizes: DataFrame) -> DataFrame:
    """(sid, size_class, expected): copies of a document of each class so that the source meets its target."""
    favour = F.lit(CLASSES) - F.col("size_class")
    classes = sizes.filter("size > 0").groupBy("sid", "size_class").agg(
        F.sum(F.col("size") * F.col("n")).alias("words"), F.first("target").alias("target")
    )
    shorter = Window.partitionBy("sid").orderBy("size_class").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy("sid").orderBy("size_class").rowsBetween(0, Window.unboundedFollowing)
    levels = classes.select(
        "sid", "size_class", "target", favour.alias("favour"),
        F.coalesce(F.sum("words").over(shorter), F.lit(0)).alias("below"), F.sum(F.col("words") * favour).over(onward).alias("mass"),
    ).withColumn("level", (F.col("target") - MOST * F.col("below")) / F.col("mass"))
    fits = F.min(F.when(F.col("level") * F.col("favour") <= MOST, F.col("size_class"))).over(Window.partitionBy("sid"))
    first = levels.withColumn("open_from", fits)
    level = F.max(F.when(F.col("size_class") == F.col("open_from"), F.col("level"))).over(Window.partitionBy("sid"))
    copies = F.when(
        F.col("open_from").isNull() | (F.col("size_class") < F.col("open_from")), F.lit(float(MOST))
    ).otherwise(F.least(F.lit(float(MOST)), F.greatest(F.lit(0.0), F.col("level") * F.col("favour"))))
    return first.withColumn("level", level).select("sid", "size_class", copies.alias("expected"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", seed: str = "") -> DataFrame:
    """Every row as ``doc_id, source, size, source_size, target, copies, taken``.

    ``copies`` is 0, 1 or 2, ``taken`` is copies times ``size``. Null or empty
    texts have size 0 and take nothing; null sources are one source; null ids
    are one id. Identical rows are counted together and told apart by a running
    number. The outcome depends on the rows only, so runs agree. An empty table
    gives an empty result.
    """
    sizes = checkpointed(docs.select(
        F.col("doc_id"), F.col(source).alias("source"), F.regexp_count(whole_text(text), F.lit(WORD)).cast("bigint").alias("size")
    ).groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")))
    sources = checkpointed(source_targets(ranked_sources(sizes)).select("source", "source_size", F.col("nth").alias("sid"), "target"))
    known = sizes.join(sources.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named"))).drop("named")
    known = checkpointed(known.withColumn("size_class", F.length(F.bin("size")).cast("int")))

    blocks = F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {COPIES_AT_ONCE}")))
    one = known.withColumn("block", blocks).withColumn("kth", F.explode(F.sequence(
        F.col("block") * COPIES_AT_ONCE, F.least(F.col("n") - 1, F.col("block") * COPIES_AT_ONCE + COPIES_AT_ONCE - 1)
    )))
    name = F.concat(
        F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.when(F.col("kth") == 0, F.lit("")).otherwise(F.concat(F.lit(":"), F.col("kth").cast("string"))),
    )
    u = (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("bigint") + 0.5) / float(1 << 52)
    with_odds = one.join(_expected(known), ["sid", "size_class"], "left").fillna(0.0, ["expected"]).withColumns({
        "u": u, "whole": F.floor("expected"),
    }).withColumn("p", F.col("expected") - F.col("whole")).withColumn(
        "odds", F.when((F.col("p") > 0) & (F.col("size") > 0), F.col("u") * (1 - F.col("p")) / ((1 - F.col("u")) * F.col("p")))
    ).withColumn("cell", F.floor(F.col("odds") / (F.col("odds") + 1) * CELLS).cast("int")).select(
        "doc_id", "source", "sid", "size", "source_size", "target", "kth", "whole", "odds", "cell"
    )
    cells = with_odds.groupBy("sid", "cell").agg(
        F.sum(F.col("whole") * F.col("size")).alias("certain"), F.sum("size").alias("words"), F.first("target").alias("target")
    )
    rest = F.col("target") - F.sum("certain").over(Window.partitionBy("sid"))
    before = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    table = cells.withColumn("rest", rest).filter("cell IS NOT NULL").select(
        "sid", "cell", "rest", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("reached"), "words"
    )
    joined = with_odds.join(checkpointed(table), ["sid", "cell"], "left")
    edge = F.coalesce((F.col("reached") <= F.col("rest")) & (F.col("rest") < F.col("reached") + F.col("words")), F.lit(False))
    upto = Window.partitionBy("sid", "cell").orderBy("odds", "doc_id", "kth").rowsBetween(Window.unboundedPreceding, -1)
    # the document at the edge goes in if that brings the sum nearer to the target
    at_edge = joined.filter(edge).withColumn(
        "more", F.col("reached") + F.coalesce(F.sum("size").over(upto), F.lit(0)) + F.col("size") / 2 <= F.col("rest")
    )
    others = joined.filter(~edge).withColumn("more", F.coalesce(F.col("reached") + F.col("words") <= F.col("rest"), F.lit(False)))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("more").cast("bigint")).otherwise(F.lit(0)).cast("bigint")
    return at_edge.unionByName(others).withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def repeat_by_mix(docs: DataFrame, text: str = "text", source: str = "source", seed: str = "") -> DataFrame:
    """``docs`` with every row as often as the mix takes it, all columns as they were.

    Rows of one id, source and size are alike to the mix; their copies go to
    them in the order of their place in the written table.
    """
    rows = numbered_documents(docs)
    words = F.regexp_count(whole_text(f"doc.{text}"), F.lit(WORD)).cast("bigint")
    keys = ["_mix_id", "_mix_source", "_mix_size"]
    with scratch(docs.sparkSession) as keep:
        numbered = checkpointed(rows.select(
            F.col("doc.doc_id").alias("_mix_id"), F.col(f"doc.{source}").alias("_mix_source"), words.alias("_mix_size"), "row_id"
        ))
        alike = Window.partitionBy(*keys)
        placed = numbered.withColumn("_mix_kth", F.row_number().over(alike.orderBy("row_id")) - 1)
        taken = mix(docs, text, source, seed).select(
            F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size"), "copies"
        ).withColumn("_mix_kth", F.row_number().over(alike.orderBy(F.desc("copies"))) - 1)
        same = [placed[k].eqNullSafe(taken[k]) for k in [*keys, "_mix_kth"]]
        times = keep(placed.join(taken, same).filter("copies > 0").select("row_id", "copies"))
    return rows_times(rows, times, MOST).select("doc.*")


#: The same mix in DuckDB's SQL, each step over all rows at once.
MIX_SQL = """
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         row_number() OVER (PARTITION BY doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) - 1 AS kth
  FROM documents),
sources AS (
  SELECT *, [5, 2, 1][(nth % 3) + 1] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM sizes GROUP BY source)),
level(turn, level) AS (
  SELECT 0, 0::DOUBLE
  UNION ALL
  SELECT turn + 1, (SELECT (sum(source_size) * 150 / 100 - coalesce(sum(source_size * 2) FILTER (WHERE source_size * 2 <= l.level * weight), 0))
                           / nullif(sum(weight) FILTER (WHERE source_size * 2 > l.level * weight), 0) FROM sources)
  FROM level l WHERE turn < 60 AND l.level IS NOT NULL),
targets AS (
  SELECT *, least((source_size * 2)::DOUBLE, (SELECT coalesce(max(level), 0) FROM level) * weight) AS target FROM sources),
known AS (
  SELECT s.*, t.nth AS sid, source_size, target, length(bin(size)) AS size_class
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
classes AS (
  SELECT sid, size_class, 64 - size_class AS favour, sum(size)::BIGINT AS words, any_value(target) AS target
  FROM known WHERE size > 0 GROUP BY sid, size_class),
levels AS (
  SELECT *, (target - 2 * coalesce(sum(words) OVER (PARTITION BY sid ORDER BY size_class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / nullif(sum(words * favour) OVER (PARTITION BY sid ORDER BY size_class ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS level
  FROM classes),
opened AS (SELECT *, min(CASE WHEN level * favour <= 2 THEN size_class END) OVER (PARTITION BY sid) AS open_from FROM levels),
expected AS (
  SELECT sid, size_class, CASE WHEN open_from IS NULL OR size_class < open_from THEN 2e0
         ELSE least(2e0, greatest(0e0, max(CASE WHEN size_class = open_from THEN level END) OVER (PARTITION BY sid) * favour)) END AS expected
  FROM opened),
drawn AS (
  SELECT k.*, floor(expected)::BIGINT AS whole, expected - floor(expected) AS p,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || CASE WHEN kth = 0 THEN '' ELSE ':' || kth END), 1, 13))::BIGINT + 0.5::DOUBLE)
         / 4503599627370496e0 AS u
  FROM (SELECT known.*, coalesce(expected, 0) AS expected FROM known LEFT JOIN expected USING (sid, size_class)) k),
ranked AS (
  SELECT *, CASE WHEN p > 0 AND size > 0 THEN u * (1 - p) / ((1 - u) * p) END AS odds,
         target - sum(whole * size) OVER (PARTITION BY sid) AS rest
  FROM drawn)
SELECT doc_id, size, source_size, target,
       CASE WHEN odds IS NOT NULL AND coalesce(sum(size) OVER (PARTITION BY sid, odds IS NULL ORDER BY odds, doc_id, kth
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 <= rest
            THEN (whole + 1) * size ELSE whole * size END::BIGINT AS taken
FROM ranked
"""
