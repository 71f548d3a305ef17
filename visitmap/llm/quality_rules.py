"""Quality rules with thresholds learned from the corpus.

All of it is DataFrame expressions. Counts come from array functions over one row's
words, so nothing is shuffled for them. Thresholds come from KLL quantile
sketches, one for each language, source and measure. Sketches are merged upwards, and a
group's quantiles are drawn towards its language's, and those towards the corpus', the more so
the fewer documents it has.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.llm.scratch import scratch_path


# The words' separators, and the characters that count as symbols.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MEASURES = ("symbols_per_word", "dup_line_share", "repeat_share", "chars_per_word")
#: Repeats: most documents have none, so the sketch is of those that have some, and its upper quantile and half of it more is the bound.
TAILS = ("dup_line_share", "repeat_share")
TAIL, TAIL_MARGIN = 0.95, 0.5
#: Where fewer documents than this have a repeat it isn't ordinary, and only ``LEAST`` of it passes.
ORDINARY, LEAST = 0.01, 0.02
SKETCH_K = 1024


def _fresh(df: DataFrame, stem: str) -> str:
    name = f"_{stem}_{uuid.uuid4().hex[:8]}"
    assert name not in df.columns
    return name


def _neighbours(a: str, count: Column, gap: int, f) -> Column:
    """f(a[i], a[i + gap]) for all i that have both."""
    left = F.slice(F.col(a), F.lit(1), F.greatest(count - gap, F.lit(0)))
    right = F.slice(F.col(a), F.lit(1 + gap), F.greatest(count - gap, F.lit(0)))
    return F.zip_with(left, right, f)


def add_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``counts``, a struct of the word, symbol, line and repetition counts.

    ``n_repeat_words``: words in windows of eight words found twice or more in the
    text. Windows are compared by a 64-bit hash. A null text has no words.
    """
    t, words, h, h8, pairs, starts, out = (_fresh(df, x) for x in ("t", "words", "h", "h8", "pairs", "starts", "counts"))
    df = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    trimmed = F.btrim(F.col(t), F.lit(SPACES))
    df = df.withColumn(words, F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(F.array().cast("array<string>")))
    n = F.size(words)
    # Hashes of 2, 4 and then 8 words.
    both = lambda a, b: F.xxhash64(a, b)
    df = df.withColumn(h, _neighbours(words, n, 1, both))
    df = df.withColumn(h8, _neighbours(h, n - 1, 2, both))
    df = df.withColumn(h, F.col(h8)).withColumn(h8, _neighbours(h, n - 3, 4, both))
    # Only texts with a repeated window need the windows in order.
    repeats = F.size(F.array_distinct(F.col(h8))) < F.size(h8)
    df = df.withColumn(pairs, F.when(repeats, F.array_sort(F.transform(F.col(h8), lambda v, i: F.struct(v.alias("h"), i.alias("i"))))))
    same = _neighbours(pairs, F.size(pairs), 1, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.withColumn(starts, F.when(F.col(pairs).isNotNull(), F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))))
    step = _neighbours(starts, F.size(starts), 1, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    repeated = F.when(F.col(starts).isNull(), F.lit(0)).otherwise(F.aggregate(step, F.lit(WINDOW), lambda x, y: x + y))
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    df = df.withColumn(out, lines)
    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join(F.col(words), "")).cast("long").alias("word_chars"),
        (F.size(F.split(F.col(t), SYMBOL)) - 1).cast("long").alias("n_symbols"),
        F.size(out).cast("long").alias("n_lines"),
        (F.size(out) - F.size(F.array_distinct(F.col(out)))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"))
    return df.withColumn("counts", counts).drop(t, words, h, h8, pairs, starts, out)


def base_failed(counts: str = "counts") -> Column:
    c = F.col(counts)
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def measures(counts: str = "counts") -> dict[str, Column]:
    """The measures that get thresholds; null where a text has no word."""
    c = F.col(counts)
    share = lambda a, b: F.when(c[b] > 0, c[a].cast("double") / c[b])
    return {"symbols_per_word": share("n_symbols", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"), "chars_per_word": share("word_chars", "n_words")}


def _quantiles(sketch: Column, at: tuple[float, ...]) -> Column:
    """Null for an empty sketch."""
    values = F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, at)))
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, values)


QUARTILES, UPPER = (0.25, 0.5, 0.75), (TAIL,)
#: What is sketched: the measures (of repeats, the part above zero), and the documents' length.
SKETCHED = {**{k: UPPER if k in TAILS else QUARTILES for k in MEASURES}, "n_words": QUARTILES}


def learn_thresholds(spark: SparkSession, counted: DataFrame, lang: str = "lang", source: str = "source",
                     width: float = 8.0, prior: float = 20.0) -> DataFrame:
    """A row for each language and source: middle of each measure and distance accepted below and above it.

    The distances are ``width`` times those from the median to the quartiles; a quartile isn't known finer than one symbol in
    a document of the group's median length. Repeats start from zero: see ``TAILS`` and ``ORDINARY``. A level's
    quantiles are drawn towards those of the level above it: by half with ``prior`` documents, by a twenty-sixth with five times as many.
    The table is written, so that every later reader sees the same thresholds.
    """
    values = {**measures(), "n_words": F.col("counts")["n_words"].cast("double")}
    counts = [F.count(F.when(~base_failed(), 1)).alias("n"), *[F.count(F.when(~base_failed() & (values[k] > 0), 1)).alias(f"n_{k}") for k in TAILS]]
    sketches = [F.kll_sketch_agg_double(F.when(~base_failed() & (v > 0) if k in TAILS else ~base_failed(), v), F.lit(SKETCH_K)).alias(k) for k, v in values.items()]
    groups = counted.groupBy(F.col(lang).alias("lang"), F.col(source).alias("source")).agg(*counts, *sketches)
    path = scratch_path(spark, "quality-sketches")
    groups.write.parquet(path)
    groups = spark.read.parquet(path)
    sizes = ["n", *[f"n_{k}" for k in TAILS]]
    merged = lambda prefix: [*[F.sum(c).alias(f"{prefix}{c}") for c in sizes], *[F.kll_merge_agg_double(F.col(k)).alias(f"{prefix}{k}") for k in SKETCHED]]
    langs = groups.groupBy(F.col("lang").alias("of_lang")).agg(*merged("lang_"))
    # The corpus' own quantiles are a few numbers.
    whole = groups.agg(*merged("")).select(*sizes, *[_quantiles(F.col(k), at).alias(k) for k, at in SKETCHED.items()]).first()
    rows = groups.join(langs, F.col("lang").eqNullSafe(F.col("of_lang")))

    def drawn(own: Column, size: Column, above: Column) -> Column:
        """A level's value drawn towards that of the level above it, by half with ``prior`` documents."""
        weight = size * size / (size * size + F.lit(prior * prior))
        return weight * F.coalesce(own, above) + (1 - weight) * above

    def quantile(k: str, i: int) -> Column:
        size = f"n_{k}" if k in TAILS else "n"
        above = F.lit(float(whole[k][i]) if whole[k] else 0.0)
        above = drawn(_quantiles(F.col(f"lang_{k}"), SKETCHED[k])[i], F.col(f"lang_{size}"), above)
        return drawn(_quantiles(F.col(k), SKETCHED[k])[i], F.col(size), above)

    def share(k: str) -> Column:
        """Documents with a repeat among all."""
        part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
        above = drawn(part(f"lang_n_{k}", "lang_n"), F.col("lang_n"), F.lit((whole[f"n_{k}"] or 0) / max(whole["n"] or 0, 1)))
        return drawn(part(f"n_{k}", "n"), F.col("n"), above)

    out = [F.col("lang").alias("group_lang"), F.col("source").alias("group_source"), quantile("n_words", 1).alias("typical_words")]
    event = F.lit(1.0) / F.greatest(quantile("n_words", 1), F.lit(1.0))
    for k in MEASURES:
        if k in TAILS:
            mid = below = F.lit(0.0)
            above = F.when(share(k) >= ORDINARY, F.greatest((1 + TAIL_MARGIN) * quantile(k, 0), F.lit(LEAST))).otherwise(F.lit(LEAST))
        else:
            low, mid, high = (quantile(k, i) for i in range(3))
            below, above = width * F.greatest(mid - low, event), width * F.greatest(high - mid, event)
        out += [mid.alias(f"{k}_mid"), below.alias(f"{k}_below"), above.alias(f"{k}_above")]
    path = scratch_path(spark, "quality-thresholds")
    rows.select(*out).write.parquet(path)
    return spark.read.parquet(path)


def judge(counted: DataFrame, thresholds: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Add ``base_failed`` and ``kept``: not failed, and within its group's bands (no band: kept).

    A short document's measures scatter more: its bands are wider by the root of how much shorter it is than
    its group's median document.
    """
    rows = counted.join(thresholds, counted[lang].eqNullSafe(thresholds["group_lang"]) & counted[source].eqNullSafe(thresholds["group_source"]), "left")
    wider = F.greatest(F.lit(1.0), F.sqrt(F.col("typical_words") / F.greatest(F.col("counts")["n_words"], F.lit(1))))
    inside = F.lit(True)
    for k, v in measures().items():
        fits = v <= F.col(f"{k}_mid") + wider * F.col(f"{k}_above")
        if k == "chars_per_word":
            fits = fits & (v >= F.col(f"{k}_mid") - wider * F.col(f"{k}_below"))
        inside = inside & F.coalesce(fits, F.lit(True))
    return rows.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & inside).drop(*thresholds.columns)


def judged_rows(spark: SparkSession, docs: DataFrame, text: str, lang: str, source: str, names: list[str]) -> DataFrame:
    """``row`` (a struct of ``names``), ``counts``, ``base_failed`` and ``kept`` of every document.

    The counted rows are written once and read for the thresholds and again for the verdict.
    """
    row = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("row"),
                      F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    path = scratch_path(spark, "quality-counts")
    add_counts(row).drop("text").write.parquet(path)
    counted = spark.read.parquet(path)
    return judge(counted, learn_thresholds(spark, counted))


def judge_documents(spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                    keep_columns: list[str] | None = None) -> DataFrame:
    """Counts and verdict of every document: ``keep_columns`` (default: all), ``counts``, ``base_failed``, ``kept``.

    Null text: no words, so it fails the base rules. Null language or source: a
    group like another. Repeated rows: each judged, all alike. Empty table: no
    rows. Long texts are counted whole. An input column called like one of the three new ones gives way to it.
    """
    new = ("counts", "base_failed", "kept")
    names = [c for c in (docs.columns if keep_columns is None else keep_columns) if c not in new]
    return judged_rows(spark, docs, text, lang, source, names).select(*[F.col("row")[c].alias(c) for c in names], *new)


def keep_documents(spark: SparkSession, docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that the rules keep, with their own columns, whatever these are called."""
    return judged_rows(spark, docs, text, lang, source, docs.columns).where("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
