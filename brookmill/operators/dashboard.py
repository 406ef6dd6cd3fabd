"""The queries behind an interactive report on the review corpus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.functions.numbers import rounded
from brookmill.functions.text import contains_any, is_set, strip, words

# The names under which a model key may be configured.
KEY_NAMES = (
    "SILICONFLOW_API_KEY",
    "DASHSCOPE_API_KEY",
    "DEEPSEEK_API_KEY",
    "OPENAI_API_KEY",
    "MOONSHOT_API_KEY",
)

# A server log line is shown if it contains any of these, case-sensitive.
LOG_KEYWORDS = ("Error", "error", "WARNING", "ERROR", "started", "listening")


def category_distribution(docs: DataFrame, by: str = "lang") -> DataFrame:
    """``by, n, share``; the total is summed from the group counts, not from a second scan."""
    counts = docs.groupBy(by).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", rounded(F.col("n") / total))


def label_by_category(
    docs: DataFrame, labels: DataFrame, by: str = "lang", label: str = "quality"
) -> DataFrame:
    """Counts per category and label; the text column is never read."""
    return (
        docs.select("doc_id", by)
        .join(labels.select("doc_id", label), "doc_id")
        .groupBy(by, label)
        .agg(F.count("*").alias("n"))
    )


def drill_down(
    docs: DataFrame, dims: Sequence[str] = ("lang", "source"), level: int | None = None
) -> DataFrame:
    """Counts and characters per category, sub-category and in total; ``gid`` tells the level.

    The levels are summed from the same group sums, whose shuffle they share. The total has a row for an
    empty table too, with 0 documents (``rollup`` has none there).
    """
    leaves = docs.groupBy(*dims).agg(
        F.count("*").alias("n"), F.sum("n_chars").alias("chars")
    )
    levels = [(list(dims[:n]), (1 << (len(dims) - n)) - 1) for n in range(len(dims), 0, -1)]
    types = {d: docs.schema[d].dataType for d in dims}

    def at(kept: list[str], gid: int) -> DataFrame:
        sums = leaves.groupBy(*kept).agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))
        keys = [F.col(d) if d in kept else F.lit(None).cast(types[d]).alias(d) for d in dims]
        return sums.select(*keys, F.lit(gid).alias("gid"), F.coalesce("n", F.lit(0)).alias("n"), "chars")

    rolled = reduce(DataFrame.unionByName, [at(kept, gid) for kept, gid in [*levels, ([], (1 << len(dims)) - 1)]])
    return rolled if level is None else rolled.where(F.col("gid") == level)


def cross_filter(
    df: DataFrame, dims: Sequence[str], selected: Mapping[str, object]
) -> DataFrame:
    """``chart, key, n`` for linked charts: a selection filters every chart but its own.

    A row that fails two selections appears in no chart and is dropped in the scan. The rest is counted
    once per combination of ``dims`` before the combinations are spread over the charts.
    """
    unknown = set(selected) - set(dims)
    if unknown:
        raise ValueError(f"not a chart dimension: {', '.join(sorted(unknown))}")
    fails = {d: (~F.coalesce(F.col(d) == F.lit(v), F.lit(False))).cast("int") for d, v in selected.items()}
    failed: Column = reduce(Column.__add__, fails.values(), F.lit(0))
    combos = df.where(failed <= 1).groupBy(*dims).agg(F.count("*").alias("n"))
    charts = F.array(
        *[
            F.struct(
                F.lit(d).alias("chart"),
                F.col(d).cast("string").alias("key"),
                (failed - fails.get(d, F.lit(0)) == 0).alias("shown"),
            )
            for d in dims
        ]
    )
    return (
        combos.select(F.explode(charts).alias("c"), "n")
        .where("c.shown")
        .groupBy("c.chart", "c.key")
        .agg(F.sum("n").alias("n"))
    )


def regex_search(docs: DataFrame, pattern: str, limit: int | None = None) -> DataFrame:
    """Reviews whose whole text matches; with ``limit``, the first page by ``doc_id``.

    The pattern is tried on a constant first: a bad one then fails at once, not inside a task.
    """
    docs.sparkSession.range(1).select(F.lit("").rlike(pattern)).collect()
    hits = docs.where(F.col("text").rlike(pattern)).select("doc_id", "lang", "n_chars")
    return hits if limit is None else hits.orderBy("doc_id").limit(limit)


def word_counts(docs: DataFrame, stop: Sequence[str] = ()) -> DataFrame:
    """``word, n`` over whole texts; map tasks combine, so a frequent word is cheap."""
    tokens = docs.select(F.explode(words(F.col("text"))).alias("word"))
    if stop:
        tokens = tokens.where(~F.col("word").isin(list(stop)))
    return tokens.groupBy("word").agg(F.count("*").alias("n"))


def top_words(docs: DataFrame, k: int = 50, stop: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent words, ties in word order."""
    return word_counts(docs, stop).orderBy(F.desc("n"), "word").limit(k)


def environment_keys(environ: Mapping[str, str]) -> list[tuple[str, str | None]]:
    """The key names with their values in an environment such as ``os.environ``."""
    return [(name, environ.get(name)) for name in KEY_NAMES]


def key_pairs(keys: Sequence[tuple[str, str | None]]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(value).cast("string").alias("value"))
            for name, value in keys
        ]
    )


def key_status(keys: Column) -> Column:
    """Names split into ``configured`` and ``missing``; an empty value counts as missing."""
    def names(keep):
        return F.transform(F.filter(keys, keep), lambda pair: pair["name"])

    return F.struct(
        names(lambda pair: is_set(pair["value"])).alias("configured"),
        names(lambda pair: ~is_set(pair["value"])).alias("missing"),
    )


def system_status(
    docs: DataFrame, keys: Sequence[tuple[str, str | None]] = tuple(environment_keys({}))
) -> DataFrame:
    """One row: is a model key set, is there data, how many records."""
    state = docs.agg(F.count("*").alias("record_count")).withColumn(
        "llm_active", F.size(key_status(key_pairs(keys))["configured"]) > 0
    )
    active = F.col("llm_active")
    return state.select(
        F.when(active, "ok").otherwise("degraded").alias("status"),
        "llm_active",
        F.when(~active, F.lit("API_KEY_MISSING")).alias("reason"),
        (F.col("record_count") > 0).alias("data_files_available"),
        "record_count",
    )


def log_filter(lines: DataFrame, keywords: Sequence[str] = LOG_KEYWORDS) -> DataFrame:
    """Stripped, non-empty lines that contain a keyword; works on batches and streams.

    A stripped line is part of the raw one, so only raw lines with a keyword need stripping.
    """
    stripped = lines.where(contains_any(F.col("line"), keywords)).select(
        strip(F.col("line")).alias("line")
    )
    return stripped.where((F.col("line") != "") & contains_any(F.col("line"), keywords))
