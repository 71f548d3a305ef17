"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a hash of their id and laid end to end;
the line is cut into blocks of equal numbers of words. The schedule is a row of
slots. Slot i's van der Corput point falls into one source's part of the
cumulative shares; the source's k-th slot takes its k-th block, pass after
pass, up to the source's target. So every stretch of the schedule holds the
sources nearly in proportion. Running sums and ranks go in two levels (within
hash buckets or stretches of slots, then over those), so that a source with a
third of all documents is still spread over the cluster. What a step works out
without texts is written and read again, so that the driver plans, compiles and
follows one step's shuffles at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmap.llm.scratch import scratch_path


# The words' separators, and the sources' weights in code point order.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3

BLOCK_WORDS = 1024
POINT_BITS = 48
STRETCH = 1 << 16


def word_array(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def source_targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row a source: ``src`` (its place), ``source``, ``source_size``, ``target``.

    Sources stand by code point, null last, with ``weights`` repeating. The
    targets share all words by weight, none above ``most`` times its source's size:
    sources in order of size to weight are full as long as their share of what the
    fuller ones leave exceeds that.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.asc_nulls_last("source"))  # one row a source
    rows = by_source.withColumn("src", F.row_number().over(place).cast("long") - 1)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("w", weight).withColumn("full", most * F.col("source_size"))
    # full / w in integers: by the weights' common multiple.
    common = 1
    for w in weights:
        common *= w
    by_need = Window.orderBy((F.col("full") * F.expr(f"{common} div w")).asc(), F.col("src"))
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (rows.withColumn("total", F.sum("source_size").over(everything))
            .withColumn("left", F.col("total") - F.coalesce(F.sum("full").over(before), F.lit(0)))
            .withColumn("w_left", F.sum("w").over(after)))
    rows = rows.withColumn("is_full", F.col("left") * F.col("w") > F.col("full") * F.col("w_left"))
    rows = (rows.withColumn("rest", F.col("total") - F.coalesce(F.sum(F.when(F.col("is_full"), F.col("full"))).over(everything), F.lit(0)))
            .withColumn("w_rest", F.sum(F.when(~F.col("is_full"), F.col("w"))).over(everything)))
    target = F.when(F.col("is_full"), F.col("full").cast("double")).otherwise((F.col("rest") * F.col("w")).cast("double") / F.col("w_rest").cast("double"))
    return rows.select("src", "source", "source_size", target.alias("target"))


def running_total(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over a key's earlier rows, by ``bucket`` and then ``order``."""
    inner = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    totals = totals.select(*keys, bucket, F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_base"))
    inside = df.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return inside.join(totals, [*keys, bucket]).withColumn(out, F.col("_base") + F.col("_in")).drop("_base", "_in")


def van_der_corput(i: Column, n: Column) -> Column:
    """floor(n * point i of the base-2 van der Corput row), exact below 2**15 * 2**48."""
    turned = F.conv(F.reverse(F.lpad(F.bin(i), POINT_BITS, "0")), 2, 10).cast("decimal(20,0)")
    return F.floor(turned * n.cast("decimal(18,0)") / F.lit(1 << POINT_BITS).cast("decimal(20,0)")).cast("long")


def line_places(named: DataFrame, digits: int, most: int = 1 << 16) -> DataFrame:
    """Add ``start``, the words before a row in its source's line, ordered by ``h``.

    Rows of one ``h`` (null or repeated ids, however many) are spread by ``tie``, a hash of size and
    text. Rows alike in all of it stand in one row with their number, and get their places at the end.
    """
    alike = named.groupBy("src", "source", "source_size", "target", "h", "doc_id", "size", "same").agg(F.count("*").alias("n"))
    alike = (alike.withColumn("words", F.col("n") * F.col("size")).withColumn("bucket", F.substring("h", 1, digits))
             .withColumn("tie", F.substring(F.md5(F.concat_ws(":", F.lit(0), "size", "same")), 1, digits)))
    group = ["src", "bucket", "h", "tie"]
    before = Window.partitionBy(*group).orderBy("doc_id", "size", "same").rowsBetween(Window.unboundedPreceding, -1)
    inside = alike.withColumn("inside", F.coalesce(F.sum("words").over(before), F.lit(0)))
    groups = running_total(alike.groupBy(*group).agg(F.sum("words").alias("group_words")), ["src"], "bucket", [F.col("h"), F.col("tie")], "group_words", "base")
    rows = inside.join(groups.drop("group_words"), group)
    rows = rows.withColumn("part", F.explode(F.expr(f"sequence(0, (n - 1) div {most})")))
    rows = rows.withColumn("copy", F.explode(F.expr(f"sequence(part * {most}, least(n, (part + 1) * {most}) - 1)")))
    return (rows.withColumn("start", F.col("base") + F.col("inside") + F.col("copy") * F.col("size"))
            .select("src", "source", "source_size", "target", "h", "tie", "doc_id", "size", "same", "start"))


def written(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """The rows, from a table in the scratch folder."""
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


class Mix:
    """A mix of ``docs``: ``sources``, ``lines`` (the documents' places), ``slots``, ``pieces``.

    Null text: size 0, never taken. Null ids and sources are values like others
    (null sorts last among sources). Repeated rows: each has a place of its own.
    Sources without words: target 0. Empty table: no rows. ``docs`` may have any
    other columns; only ids, texts and sources are read. Reruns agree.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                 weights=WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS, seed: str = "mix"):
        self.spark, self.block = spark, block_words
        word = F.col(text)
        sized = written(spark, "mix-sizes", docs.select(
            F.col(key).alias("doc_id"), F.col(source).alias("source"), F.size(word_array(word)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("null")))).alias("h"),
            F.xxhash64(word).alias("same")))
        n = sized.count()
        digits = max(2, len(f"{n // 2000:x}"))  # about 2,000 documents a bucket
        self.sources = written(spark, "mix-sources", source_targets(sized, weights, most))
        # Words that each source gives, and the slots that takes.
        whole = F.expr(f"(source_size + {block_words - 1}) div {block_words}")
        quota = F.floor("target").cast("long")
        self.plan = (self.sources.where("source_size > 0").withColumn("quota", quota)
                     .withColumn("passes", F.expr("quota div source_size")).withColumn("rest", F.expr("quota % source_size"))
                     .withColumn("blocks", whole).withColumn("need", F.expr(f"passes * blocks + (rest + {block_words - 1}) div {block_words}")))
        named = sized.join(self.sources.select(F.col("source").alias("of"), "src", "source_size", "target"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
        self.lines = written(spark, "mix-lines", line_places(named, digits))

    def slots(self) -> DataFrame:
        """The schedule: slot, src, nth (of its source), pass, block, and the words [first, last) of the source's line."""
        sources = self.plan
        count = sources.agg(F.sum("need")).first()[0] or 0
        place = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)  # one row a source
        parts = sources.withColumn("low", F.coalesce(F.sum("need").over(place), F.lit(0))).withColumn("high", F.col("low") + F.col("need"))
        cell = max(1, count // 4096)
        cells = parts.where("need > 0").select("src", "low", "high", F.explode(F.expr(f"sequence(low div {cell}, (high - 1) div {cell})")).alias("cell"))
        points = self.spark.range(count).select(F.col("id").alias("slot"), van_der_corput(F.col("id"), F.lit(count)).alias("x"))
        points = points.withColumn("cell", F.expr(f"x div {cell}"))
        drawn = points.join(cells, "cell").where("x >= low and x < high").select("slot", "src", F.expr(f"slot div {STRETCH}").alias("stretch"), F.lit(1).cast("long").alias("one"))
        ranked = running_total(drawn, ["src"], "stretch", [F.col("slot")], "one", "nth").select("slot", "src", "nth")
        # The points miss a source's need by a few slots at most; the missing ones come last.
        had = drawn.groupBy("src").agg(F.count("*").alias("had"))
        late = (sources.join(had, "src", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < need")
                .select("src", F.explode(F.expr("sequence(had, need - 1)")).alias("nth")).select(F.lit(count).alias("slot"), "src", "nth"))
        all_slots = ranked.unionByName(late).join(sources.select("src", "need", "passes", "rest", "blocks", "source_size"), "src").where("nth < need")
        b = self.block
        return (all_slots.withColumn("pass", F.expr("nth div blocks")).withColumn("block", F.expr("nth % blocks"))
                .withColumn("first", F.col("block") * b)
                .withColumn("last", F.least(F.col("first") + b, F.when(F.col("pass") == F.col("passes"), F.col("rest")).otherwise(F.col("source_size"))))
                .select("slot", "src", "nth", "pass", "block", "first", "last"))

    def pieces(self) -> DataFrame:
        """The documents' parts by block: src, block, and the words [from, to) of the source's line."""
        b = self.block
        cut = self.lines.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")))
        return cut.withColumn("from", F.greatest(F.col("start"), F.col("block") * b)).withColumn("to", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b))

    def schedule(self) -> DataFrame:
        """The mix itself: for each slot, which words [from_word, to_word) of which documents it takes."""
        rows = self.slots().join(self.pieces().select("src", "block", "doc_id", "start", "from", "to"), ["src", "block"])
        return (rows.withColumn("to", F.least("to", "last")).where("from < to")
                .select("slot", "src", "nth", "doc_id", (F.col("from") - F.col("start")).alias("from_word"), (F.col("to") - F.col("start")).alias("to_word")))

    def taken(self) -> DataFrame:
        """Every document with ``taken``, the words that the schedule takes of it, repeats counted."""
        b = self.block
        # How often each block is taken: whole, and up to where in the pass that stops.
        whole = (F.col("last") == F.least(F.col("first") + b, F.col("source_size")))
        used = (self.slots().join(self.plan.select("src", "source_size"), "src")
                .groupBy("src", "block").agg(F.sum(whole.cast("long")).alias("times"), F.max(F.when(~whole, F.col("last"))).alias("stop")))
        used = written(self.spark, "mix-blocks", used)
        cut = self.pieces().join(used, ["src", "block"], "left")
        words = F.coalesce(F.col("times"), F.lit(0)) * (F.col("to") - F.col("from")) + F.greatest(F.least(F.col("to"), F.coalesce("stop", F.lit(0))) - F.col("from"), F.lit(0))
        keys = ["src", "start", "doc_id", "size", "same", "source", "source_size", "target"]
        taken = cut.groupBy(*keys).agg(F.sum(words).alias("taken"))  # copies of a row differ in start
        return taken.unionByName(self.lines.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken")))


def mix_documents(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **more) -> DataFrame:
    """The mix's rows with the columns of ``docs``: each document as often as it is taken whole,
    and once more cut to its first words where a source's target ends inside it.

    The cut text has one space between words; an ``n_chars`` column follows it.
    Documents the mix takes nothing of are left out. See ``Mix`` for odd input.
    """
    taken = Mix(spark, docs, key, text, source, **more).taken()
    # Rows equal in id, source and text are told apart by what is taken of each, in any order.
    same = Window.partitionBy("_id", "_source", "_size", "_h").orderBy(F.col("_h"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("_id"), F.col(source).alias("_source"),
                       F.size(word_array(F.col(text))).cast("long").alias("_size"), F.xxhash64(F.col(text)).alias("_h"))
    rows = rows.where("_size > 0").withColumn("_n", F.row_number().over(same))
    counts = taken.where("taken > 0").withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "source", "size", "same").orderBy("start")))
    on = F.col("_id").eqNullSafe(F.col("doc_id")) & F.col("_source").eqNullSafe(F.col("source")) & (F.col("_size") == F.col("size")) & (F.col("_h") == F.col("same")) & (F.col("_n") == F.col("n"))
    rows = rows.join(written(spark, "mix-counts", counts.select("doc_id", "source", "size", "same", "n", "taken")), on)
    rows = rows.withColumn("_part", F.expr("taken % size")).withColumn("_copy", F.explode(F.expr("sequence(1, (taken + size - 1) div size)")))
    cut = (F.col("_part") > 0) & (F.col("_copy") > F.expr("taken div size"))
    cut_text = F.when(cut, F.array_join(F.slice(word_array(F.col("row")[text]), F.lit(1), F.greatest(F.col("_part"), F.lit(1)).cast("int")), " ")).otherwise(F.col("row")[text])
    rows = rows.withColumn("_text", cut_text)
    out = []
    for c in docs.columns:
        value = F.col("row")[c]
        if c == text:
            value = F.col("_text")
        elif c == "n_chars":
            value = F.when(cut, F.length("_text").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out)


#: DuckDB SQL for the words taken: what the schedule comes to, by closed form.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
s0 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS src
  FROM d GROUP BY source),
s1 AS (
  SELECT *, 3 * source_size AS most, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s0),
s2 AS (
  SELECT *, total - CAST(coalesce(sum(most) OVER (ORDER BY most * (10 // w), src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest_before,
         CAST(sum(w) OVER (ORDER BY most * (10 // w), src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS w_left
  FROM s1),
s3 AS (SELECT *, rest_before * w > most * w_left AS is_full FROM s2),
s4 AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN CAST(most AS DOUBLE)
              ELSE CAST((total - CAST(coalesce(sum(CASE WHEN is_full THEN most END) OVER (), 0) AS BIGINT)) * w AS DOUBLE)
                   / CAST(CAST(sum(CASE WHEN NOT is_full THEN w END) OVER () AS BIGINT) AS DOUBLE) END AS target
  FROM s3),
p AS (
  SELECT doc_id, size, source_size, target,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0
            ELSE (CAST(floor(target) AS BIGINT) // source_size) * size
                 + greatest(least(start + size, CAST(floor(target) AS BIGINT) % source_size) - start, 0) END AS BIGINT) AS taken
FROM p"""
