"""Every operator as a named query over a folder of tables; the reference SQL is in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmill.functions.numbers import rounded
from brookmill.functions.text import as_json, char_grams, join_list
from brookmill.operators import attribution, cleaning, dashboard, faults, features, models, profile, splits, tree_shap as shap
from brookmill.operators import sessions as sessions_
from brookmill.operators.ranking import rank_auc as ranked_auc
from brookmill.operators.rule_index import rule_hits, rule_rows
from brookmill.operators.sampling import balanced_sample
from brookmill.operators.search_index import build_index
from brookmill.operators.search_index import indexed_search as search
from brookmill.operators.vocabulary import sparse_vectors, tfidf_entries
from brookmill.session import materialise, shared_path
from brookmill.sources import csv_files, files
from brookmill.sources.models import load_model, save_model
from brookmill.sources.tables import EVENTS, load, spread
from brookmill.streaming import feed, replay, retry, scoring
from brookmill.streaming import sessions as stream_sessions_

Query = Callable[[SparkSession, str], DataFrame]

SALT = "review-log"
PATTERN = r"(?i)\bthe\s+\w+ing\b"
COEFFICIENTS = {"n_chars": 0.001, "n_words": -0.25, "n_digits": 0.5}
FUSED = ("n_chars", "n_words", "n_digits", "email", "phone", "licence", "symbols", "score")
FEATURE_GROUPS = {
    "length": ("n_chars", "n_words"),
    "digits": ("n_digits",),
    "rules": ("email", "phone", "licence", "symbols", "score"),
}
FEATURES = (
    "doc_id BIGINT, email INT, phone INT, licence INT, symbols INT, score DOUBLE"
)
STREAM_ROWS = 10_000
STREAM_FILES = 2
TFIDF_FEATURES = 4_096
REPLAY_CAP = 6_000
RULE_WORDS = 200
SEARCHED = (PATTERN, r"(?i)licen[sc]e\b", r"[0-9]{3}-[0-9]{4}", r"\.\s+The\s", r"copyright|[%*#]{3,}")
TREE_DEPTH = 3
MAX_ATTEMPTS = 3
FEED_LATENESS = "2 days"


def dirty_events(events: DataFrame) -> DataFrame:
    """The event log as raw text with faults put in at fixed places; see ``oracles.DIRTY``."""
    id = F.col("event_id")
    copies = F.when(id % 50 == 0, 2).otherwise(1)
    return events.select(
        F.when(id % 83 == 0, F.concat(F.lit("x"), id)).otherwise(id.cast("string")).alias("event_id"),
        F.when(id % 79 == 0, "yesterday").otherwise(F.col("ts").cast("string")).alias("ts"),
        F.when(id % 97 != 0, F.col("user_id").cast("string")).alias("user_id"),
        F.when(id % 7 == 0, F.concat(F.lit("  "), "event_type", F.lit(" ")))
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.when(id % 89 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        "props",
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    ).drop("copy")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events")


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents for queries that work on the whole text."""
    return spread(_docs(spark, folder), "doc_id")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "labels")


def _lines(events: DataFrame) -> DataFrame:
    return events.select(F.concat("event_type", F.lit(": "), "props").alias("line"))


def _attempts(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id",
        F.to_date("ts").alias("dt"),
        "ts",
        "event_id",
        (F.col("event_type") != "error").alias("ok"),
    )


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "log-csv")
    csv_files.write_csv(dirty_events(_events(spark, folder)), path)
    log = csv_files.read_log(spark, path, EVENTS)
    # The checksum makes the scan parse all fields, so that the flag sees all their errors.
    fields = [c for c in log.columns if c != csv_files.CORRUPT]
    log = log.select(F.col(csv_files.CORRUPT).isNotNull().alias("corrupt"), F.xxhash64(*fields).alias("checksum"))
    return materialise(log, "corrupt-flags").groupBy("corrupt").agg(F.count("*").alias("n"))


def etl_store(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "daily")
    files.write_daily(cleaning.clean_log(dirty_events(_events(spark, folder))), path)
    stored = files.read_daily(spark, path, f"{EVENTS}, k INT")
    return stored.groupBy("dt").agg(
        F.count("*").alias("n"), profile.money_sum("value").alias("amount")
    )


def cross_filter(spark: SparkSession, folder: str) -> DataFrame:
    joined = _docs(spark, folder).select("doc_id", "lang").join(
        _labels(spark, folder).select("doc_id", "quality"), "doc_id"
    )
    return dashboard.cross_filter(joined, ["lang", "quality"], {"lang": "en", "quality": 1})


def _streamed(
    spark: SparkSession,
    source: DataFrame,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    partition_by: tuple[str, ...] = (),
    rows: int = STREAM_ROWS,
    files_per_trigger: int = STREAM_FILES,
) -> str:
    """Stage ``source`` as files of at most ``rows`` rows and stream them in lanes; the output path.

    A batch admits ``files_per_trigger`` files, whatever the size of the source: more data are more batches.
    """
    path = shared_path(spark, "replay")
    replay.stage(source, f"{path}/in", ["ts", "event_id"], rows)

    def run(stream: DataFrame, lane: int) -> None:
        replay.run_batches(stream, f"{path}/out", f"{path}/state/{lane}", transform, partition_by, lane=lane)

    replay.run_lanes(spark, f"{path}/in", schema, files_per_trigger, run)
    return f"{path}/out"


def stream_replay(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    out = _streamed(spark, events, EVENTS, lambda batch: batch)
    return spark.read.schema(f"{EVENTS}, batch_id INT").parquet(out).drop("batch_id")


def stream_label(spark: SparkSession, folder: str) -> DataFrame:
    out = _streamed(spark, _events(spark, folder), EVENTS, scoring.label)
    return spark.read.schema("event_id BIGINT, prediction INT, batch_id INT").parquet(out).drop("batch_id")


def stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    raw = dirty_events(_events(spark, folder))
    schema = ", ".join(f"{c} STRING" for c in raw.columns)
    out = _streamed(spark, raw, schema, cleaning.classify, ("status",))
    stored = spark.read.schema(f"{schema}, reason STRING, batch_id INT, status STRING").parquet(out)
    return cleaning.split_counts(stored)


def stream_retry(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the raw log with its end: good, or dead with its payload, and the attempt that ended it.

    The stream is stopped halfway and started again. An error record fails until its attempt exceeds ``event_id % 5``.
    """
    raw, path = dirty_events(_events(spark, folder)), shared_path(spark, "retry")
    schema, order = ", ".join(f"{c} STRING" for c in raw.columns), ["ts", "event_id"]

    def works(attempt: Column) -> Column:
        fails = F.pmod(F.expr("try_cast(event_id AS BIGINT)"), F.lit(5)) >= attempt
        return ~((F.trim("event_type") == "error") & fails)

    def run(stream: DataFrame, lane: int) -> None:
        retry.run_with_retries(stream, f"{path}/out/lane={lane}", f"{path}/state/{lane}", schema, works, MAX_ATTEMPTS)

    def go_on() -> None:
        replay.run_lanes(spark, f"{path}/in", schema, STREAM_FILES, run)

    first_half = F.crc32("event_id") % 2 == 0
    replay.stage(raw.where(first_half), f"{path}/in", order, STREAM_ROWS)
    go_on()
    replay.stage(raw.where(~first_half), f"{path}/in", order, STREAM_ROWS, "append")
    go_on()
    replay.tick(spark, f"{path}/in", schema, sum(retry.delays(MAX_ATTEMPTS)), STREAM_FILES)
    go_on()
    done = retry.finished(spark, f"{path}/out", schema)
    return done.select("event_id", F.col("kind").alias("status"), "reason", "attempt", "payload")


def live_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Two charts over the reviews that a stream has counted."""
    labels = _labels(spark, folder).select("doc_id", "quality")
    reviews = _docs(spark, folder).select("doc_id", "lang").join(labels, "doc_id", "left")
    return feed.charts(_fed(spark, reviews), "lang", "quality")


def _fed(spark: SparkSession, reviews: DataFrame, rows: int = STREAM_ROWS, files_per_trigger: int = STREAM_FILES) -> DataFrame:
    path, by = shared_path(spark, "feed"), ["lang", "quality"]
    replay.stage(reviews, f"{path}/in", ["doc_id"], rows)
    stream = replay.read_stream(spark, f"{path}/in", "doc_id BIGINT, lang STRING, quality INT", files_per_trigger)
    counts = stream.groupBy(*by).agg(F.count("*").alias("n"))
    return feed.read_feed(spark, f"{path}/out", feed.run_feed(counts, by, f"{path}/out", f"{path}/state"))


def live_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Events per day and type as a stream counts them; some arrive after all others, and those of closed days are told apart."""
    events, delayed = _events(spark, folder), F.col("event_id") % 41 == 0
    path, order = shared_path(spark, "activity"), ["ts", "event_id"]

    def go_on() -> DataFrame:
        stream = replay.read_stream(spark, f"{path}/in", EVENTS, STREAM_FILES)
        counts = feed.windowed_counts(stream, "event_type", lateness=FEED_LATENESS)
        schema = feed.run_feed(counts, ["start", "event_type"], f"{path}/out", f"{path}/state")
        return feed.read_feed(spark, f"{path}/out", schema)

    replay.stage(events.where(~delayed), f"{path}/in", order, STREAM_ROWS)
    go_on()
    replay.stage(events.where(delayed), f"{path}/in", order, STREAM_ROWS, "append")
    counted = go_on()
    admitted = spark.read.schema(EVENTS).parquet(f"{path}/in")
    told = feed.with_late(admitted, counted, F.date_trunc("day", "ts").cast("timestamp_ntz"), "event_type")
    return told.select(F.to_date("start").alias("dt"), "event_type", "n", "late")


def _stream_sessions(spark: SparkSession, parts: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Closed sessions of a stream that admits one part after the other and is then flushed; and all that it admitted.

    The users are dealt out to lanes, streams of their own that run side by side: while the driver plans and commits a batch of one, the
    executors work for the others. Each part ends, in every lane, with a row at its newest time, so that the lanes agree on what is late.
    """
    path, order, gap = shared_path(spark, "sessions"), ["ts", "event_id"], sessions_.SIX_HOURS
    lanes, laned = range(len(replay.LANES)), f"{EVENTS}, lane INT"
    newest = [materialise(stream_sessions_.newest_row(part), "newest") for part in parts]
    closing = stream_sessions_.closing_row(reduce(DataFrame.unionAll, newest), gap)
    merged = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(merged)

    def go_on(lane: int) -> None:
        stream = replay.read_stream(spark, f"{path}/in/lane={lane}", EVENTS, STREAM_FILES)
        stream_sessions_.run_sessions(stream, f"{path}/out", f"{path}/state/{lane}", gap, lane=lane)

    def admit(rows: Callable[[int], DataFrame]) -> None:
        replay.side_by_side(spark, lambda lane: replay.stage(rows(lane), f"{path}/in/lane={lane}", order, STREAM_ROWS, "append"), lanes)
        replay.side_by_side(spark, go_on, lanes)

    spark.conf.set(merged, "true")  # a hot user's events meet in the map tasks first
    try:
        for i, (part, last) in enumerate(zip(parts, newest)):
            part.withColumn("lane", stream_sessions_.user_lane()).write.partitionBy("lane").parquet(f"{path}/split/{i}")
            split = spark.read.schema(laned).parquet(f"{path}/split/{i}")
            admit(lambda lane: split.where(F.col("lane") == lane).drop("lane").unionAll(last))
        admit(lambda lane: closing)
    finally:
        spark.conf.set(merged, before)
    return stream_sessions_.closed_sessions(spark, f"{path}/out"), spark.read.schema(laned).parquet(f"{path}/in").drop("lane")


def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``session_summary``, from a stream."""
    closed, _ = _stream_sessions(spark, [_events(spark, folder)])
    return sessions_.numbered_sessions(closed)


def stream_sessions_late(spark: SparkSession, folder: str) -> DataFrame:
    """Of each user's events, those that came too late for any session: some old ones arrive after all others."""
    events = _events(spark, folder)
    newest = events.agg(F.max("ts")).scalar()
    delayed = (F.col("event_id") % 41 == 0) & (F.col("ts") < newest - F.expr("INTERVAL '5' DAY"))
    closed, admitted = _stream_sessions(spark, [events.where(~delayed), events.where(delayed)])
    return stream_sessions_.late_events(admitted, closed)


def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """All dead letters of the raw log: records that break a rule, and failed records of tasks out of retries."""
    raw = dirty_events(_events(spark, folder))
    _, broken = cleaning.dlq_split(raw)
    log = cleaning.clean_log(raw).drop("k").withColumns(
        {"dt": F.to_date("ts"), "ok": F.col("event_type") != "error"}
    )
    tried = faults.retried_to_death(materialise(log, "clean-log"), ["user_id", "dt"], ["ts", "event_id"])
    spent = cleaning.dead_letters(tried, raw.columns, F.lit("out_of_retries"), F.col("attempt"))
    return broken.unionByName(spent)


def stream_model_label(spark: SparkSession, folder: str) -> DataFrame:
    """A fitted pipeline, saved, loaded and applied to each micro-batch.

    Its only stage cuts the value at the limit, so that SQL can state the labels.
    """
    cut = Bucketizer(splits=[float("-inf"), scoring.LIMIT, float("inf")], inputCol="value", outputCol="prediction")
    path = shared_path(spark, "model")
    save_model(Pipeline(stages=[cut]).fit(_events(spark, folder)), path)
    model = load_model(path)
    out = _streamed(spark, _events(spark, folder), EVENTS, lambda batch: scoring.label(batch, model))
    return spark.read.schema("event_id BIGINT, prediction INT, batch_id INT").parquet(out).drop("batch_id")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled reviews from the first of two accepted places that exists: one CSV row per document, counted by label."""
    place = shared_path(spark, "reviews-csv")
    rows = _docs(spark, folder).select("doc_id", F.col("lang").alias("category"), "n_chars").join(_labels(spark, folder), "doc_id")
    csv_files.write_csv(rows.select("doc_id", "category", F.col("quality").alias("label"), "n_chars"), place)
    accepted = [f"{place}-elsewhere", place]
    if not files.any_file_available(spark, accepted):
        raise FileNotFoundError(place)
    read = csv_files.read_reviews(spark, accepted, "doc_id BIGINT, category STRING, label INT, n_chars BIGINT")
    return read.groupBy("category", "label").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def system_status_active(spark: SparkSession, folder: str) -> DataFrame:
    """The status with one key set, one set to nothing and the others missing, and the names of the latter."""
    keys = dashboard.environment_keys(dict(zip(dashboard.KEY_NAMES, ["a key", ""])))
    missing = dashboard.key_status(dashboard.key_pairs(keys))["missing"]
    return dashboard.system_status(_docs(spark, folder), keys).withColumn("missing", join_list(missing))


def system_status(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.system_status(_docs(spark, folder))


def system_status_json(spark: SparkSession, folder: str) -> DataFrame:
    status = system_status(spark, folder)
    return status.select(as_json(status.columns).alias("payload"))


def feature_fusion(spark: SparkSession, folder: str) -> DataFrame:
    """The rule features travel as a feature-batch CSV, as they would from another job."""
    path = shared_path(spark, "features-csv")
    both = _texts(spark, folder).select("doc_id", *features.number_columns(), *features.rule_columns())
    both = materialise(both, "features")  # the only scan of the texts
    numbers, rules = both.select("doc_id", "n_chars", "n_words", "n_digits"), [c.split()[0] for c in FEATURES.split(", ")]
    csv_files.write_csv(both.select(rules), path)
    batch = csv_files.read_features(spark, path, FEATURES)
    return features.feature_fusion(numbers, _labels(spark, folder), batch)


def indexed_search(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of several patterns over one index; the last asks for nothing that the index could tell."""
    docs = _texts(spark, folder)
    index = build_index(docs)
    found = [search(docs, index, p).select(F.lit(i).alias("pattern"), "doc_id") for i, p in enumerate(SEARCHED)]
    return reduce(DataFrame.unionAll, found)


def rule_table(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of a rule base of rows: the program's rules, and one for each of 200 long words of the corpus."""
    docs = _texts(spark, folder).select("doc_id", "text")
    fixed = rule_rows(docs, features.RULES, {"email": ["@"], "licence": ["licence", "license", "copyright"]})
    words = dashboard.word_counts(docs).where(r"word RLIKE '^[a-z]{7,}$'").orderBy(F.md5("word"), "word").limit(RULE_WORDS)
    learnt = words.select(
        F.concat(F.lit("word:"), "word").alias("rule_id"), F.concat("word", F.lit("[^a-z]")).alias("pattern"), F.lit(0.1).alias("weight"), F.array("word").alias("literals")
    )
    return rule_hits(docs, materialise(fixed.unionAll(learnt), "rules"))


def _inputs(spark: SparkSession, folder: str, *extra: Column) -> DataFrame:
    """All features of every document, from one scan of its text."""
    return _texts(spark, folder).select(
        "doc_id", *features.number_columns(), *features.rule_columns(), *extra
    )


def _with_label(inputs: DataFrame, folder: str) -> DataFrame:
    """The features with the label, if there is one; what is joined holds no text any more."""
    labels = _labels(inputs.sparkSession, folder).select("doc_id", "quality")
    return inputs.join(labels, "doc_id", "left")


def _model_input(spark: SparkSession, folder: str) -> DataFrame:
    """Narrow rows, read by every fit and score: written once."""
    return materialise(_with_label(_inputs(spark, folder), folder), "model-input")


def rf_score(spark: SparkSession, folder: str) -> DataFrame:
    forest = models.random_forest("quality")
    return models.fit_score(_model_input(spark, folder), FUSED, "quality", forest)


def _fused_input(spark: SparkSession, folder: str, size: int = TFIDF_FEATURES) -> DataFrame:
    """The model input with unit-length TF-IDF over the ``size`` commonest character grams, each with an index of its own."""
    entries = tfidf_entries(_docs(spark, folder), size=size)
    joined = sparse_vectors(_model_input(spark, folder), entries, size, name="_weights")
    return Normalizer(inputCol="_weights", outputCol="tfidf").transform(joined).drop("_weights")


def tfidf_vectors(spark: SparkSession, folder: str) -> DataFrame:
    entries = tfidf_entries(_docs(spark, folder), size=TFIDF_FEATURES)
    return entries.withColumn("weight", rounded(F.col("weight")))


def gbt_score(spark: SparkSession, folder: str) -> DataFrame:
    """Balanced boosted trees on TF-IDF and the numeric columns together."""
    trees = models.boosted_trees("quality")
    fused = _fused_input(spark, folder)
    return models.fit_score(fused, [*FUSED, "tfidf"], "quality", trees, balanced=True)


def ablation(spark: SparkSession, folder: str) -> DataFrame:
    labelled = _model_input(spark, folder).where("quality IS NOT NULL")
    trees = models.boosted_trees("quality")
    result = models.ablation(labelled, FEATURE_GROUPS, "quality", trees)
    return result.select(F.array_join("subset", "+").alias("subset"), "metric")


def _checked(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "fold", F.col("prediction").isin(0.0, 1.0).alias("valid"))


def rf_check(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for the scores whatever the trees: one row per document, its fold, a label as prediction."""
    return _checked(rf_score(spark, folder))


def gbt_check(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(gbt_score(spark, folder))


def ablation_check(spark: SparkSession, folder: str) -> DataFrame:
    """All subsets of the groups, each with a metric between 0 and 1, which is 0.5 for the empty one."""
    metric = F.col("metric")
    return ablation(spark, folder).select("subset", ((metric >= 0) & (metric <= 1) & ((F.col("subset") != "") | (metric == 0.5))).alias("valid"))


def best_split(spark: SparkSession, folder: str) -> DataFrame:
    """The best split of all labelled documents by each feature."""
    rows = _model_input(spark, folder).where("quality IN (0, 1)").withColumn("node", F.lit(1))
    return splits.best_splits(rows, FUSED, "quality").drop("node")


def split_tree(spark: SparkSession, folder: str) -> DataFrame:
    rows = _model_input(spark, folder)
    return splits.tree_rows(rows, splits.grow(rows, FUSED, "quality", TREE_DEPTH))


def tree_shap(spark: SparkSession, folder: str) -> DataFrame:
    """Exact Shapley values of the tree of ``split_tree`` for every document."""
    rows = _model_input(spark, folder)
    leaves = shap.grown_leaves(splits.grow(rows, FUSED, "quality", TREE_DEPTH))
    return shap.tree_shap(rows, [(1.0, leaves)]).withColumn("phi", rounded(F.col("phi")))


def stream_tree_score(spark: SparkSession, folder: str) -> DataFrame:
    """The tree of ``split_tree``, trained, stored, loaded, and applied to every document on a stream."""
    rows, path = _model_input(spark, folder), shared_path(spark, "tree")
    splits.tree_rows(rows, splits.grow(rows, FUSED, "quality", TREE_DEPTH)).write.parquet(path)
    nodes = splits.tree_nodes(spark.read.schema(splits.TREE).parquet(path))
    staged, schema = rows.select("doc_id", *FUSED), ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", *FUSED))
    replay.stage(staged, f"{path}-stream/in", ["doc_id"], STREAM_ROWS)
    stream = replay.read_stream(spark, f"{path}-stream/in", schema, STREAM_FILES)
    scored = splits.score(nodes)
    replay.run_batches(stream, f"{path}-stream/out", f"{path}-stream/state", lambda batch: batch.select("doc_id", scored.alias("score")))
    out = spark.read.schema("doc_id BIGINT, score DOUBLE, batch_id INT").parquet(f"{path}-stream/out")
    return out.select("doc_id", rounded(F.col("score")).alias("score"))


def _boosted(spark: SparkSession, folder: str) -> tuple[DataFrame, PipelineModel]:
    rows = _model_input(spark, folder)
    return rows, models.fit(rows.where("quality IS NOT NULL"), FUSED, models.boosted_trees("quality"))


def boosted_shap(spark: SparkSession, folder: str) -> DataFrame:
    """Exact Shapley values of boosted trees for every document."""
    rows, model = _boosted(spark, folder)
    return shap.tree_shap(rows, shap.ensemble_trees(model))


def boosted_shap_check(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: do its values and the mean margin add up to the margin that Spark gives it?

    The values are added where they are worked out, without a shuffle. A constant model would have nothing to explain, and fails.
    """
    rows, model = _boosted(spark, folder)
    trees = shap.ensemble_trees(model)
    values = shap.shapley_columns(trees, {f: F.col(f) for f in FUSED})
    total = F.aggregate(F.array(*values.values()), F.lit(shap.base_value(trees)), lambda a, b: a + b)
    margin = vector_to_array("rawPrediction")[1]
    return model.transform(rows).select("doc_id", (F.abs(total - margin) < 1e-9).alias("adds_up"))


def rank_auc(spark: SparkSession, folder: str) -> DataFrame:
    """How well a fixed linear score ranks the labelled documents: by language, and all."""
    score = sum((F.col(c) * F.lit(w) for c, w in list(COEFFICIENTS.items())[1:]), F.col("n_chars") * F.lit(COEFFICIENTS["n_chars"]))
    numbers = _texts(spark, folder).select("doc_id", "lang", *features.number_columns())
    rows = numbers.select("doc_id", "lang", score.alias("score")).join(_labels(spark, folder), "doc_id")
    each = rows.select(F.explode(F.array(F.col("lang"), F.lit("(all)"))).alias("grp"), "score", "quality")
    return ranked_auc(each, "score", "quality", ["grp"]).withColumn("auc", rounded(F.col("auc"), 9))


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents by language, length class and rule hit."""
    docs = _texts(spark, folder).select("doc_id", "lang", "n_chars", *features.rule_columns())
    joined = docs.join(_labels(spark, folder), "doc_id")
    groups = {
        "category": F.col("lang"),
        "length": F.length(F.col("n_chars").cast("string")),
        "rules": F.col("score") > 0,
    }
    return attribution.cell_ablation(joined, groups, "quality")


def cell_ablation(spark: SparkSession, folder: str) -> DataFrame:
    return _cells(spark, folder).select(
        F.array_join("subset", "+").alias("subset"), rounded(F.col("metric")).alias("metric")
    )


def group_shapley(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.group_shapley(_cells(spark, folder), ["category", "length", "rules"])


def linear_shap(spark: SparkSession, folder: str) -> DataFrame:
    numbers = materialise(features.text_numbers(_texts(spark, folder)), "text-numbers")
    return attribution.linear_shap(numbers, COEFFICIENTS)


def deidentify(spark: SparkSession, folder: str) -> DataFrame:
    """Users are counted first, so each id is hashed once, not once per event."""
    counts = _events(spark, folder).groupBy("user_id").agg(F.count("*").alias("n"))
    return cleaning.deidentify(counts, "user_id", SALT)


# Calling a query builds its plan and may run jobs on the way: fits, streams and intermediate tables.
QUERIES: dict[str, Query] = {
    "category_distribution": lambda s, d: dashboard.category_distribution(_docs(s, d)),
    "label_by_category": lambda s, d: dashboard.label_by_category(_docs(s, d), _labels(s, d)),
    "drill_down": lambda s, d: dashboard.drill_down(_docs(s, d)),
    "cross_filter": cross_filter,
    "regex_search": lambda s, d: dashboard.regex_search(_texts(s, d), PATTERN),
    "top_words": lambda s, d: dashboard.top_words(_texts(s, d), k=50),
    "log_stats": lambda s, d: profile.log_stats(_events(s, d)),
    "etl_daily": lambda s, d: profile.etl_daily(_events(s, d)),
    "etl_store": etl_store,
    "clean_log": lambda s, d: cleaning.clean_log(dirty_events(_events(s, d))),
    "deidentify": deidentify,
    "mask_text": lambda s, d: cleaning.mask_text(_texts(s, d).select("doc_id", "text")),
    "user_features": lambda s, d: profile.user_features(_events(s, d)),
    "sessionize": lambda s, d: sessions_.sessionize(_events(s, d)),
    "session_summary": lambda s, d: sessions_.session_summary(_events(s, d)),
    "retry_numbers": lambda s, d: faults.retry_numbers(
        _attempts(_events(s, d)), ["user_id", "dt"], ["ts", "event_id"]
    ),
    "retry_ledger": lambda s, d: faults.retry_ledger(
        _attempts(_events(s, d)), ["user_id", "dt"], ["ts", "event_id"]
    ),
    "dlq_split": lambda s, d: cleaning.split_counts(
        cleaning.classify(dirty_events(_events(s, d)))
    ),
    "log_filter": lambda s, d: dashboard.log_filter(_lines(_events(s, d))),
    "format_compare": lambda s, d: files.format_compare(_events(s, d)),
    "csv_roundtrip": csv_roundtrip,
    "replay_cap": lambda s, d: replay.replay_cap(
        _events(s, d), ["ts", "event_id"], REPLAY_CAP
    ),
    "stream_replay": stream_replay,
    "stream_label": stream_label,
    "stream_dead_letters": stream_dead_letters,
    "stream_model_label": stream_model_label,
    "stream_retry": stream_retry,
    "live_feed": live_feed,
    "live_activity": live_activity,
    "stream_sessions": stream_sessions,
    "stream_sessions_late": stream_sessions_late,
    "dead_letters": dead_letters,
    "reviews": reviews,
    "rule_table": rule_table,
    "indexed_search": indexed_search,
    "balanced_sample": lambda s, d: balanced_sample(_labels(s, d), "quality", "doc_id"),
    "rule_features": lambda s, d: features.rule_features(_texts(s, d)),
    "feature_sample": lambda s, d: features.feature_sample(_docs(s, d), n=200),
    "feature_fusion": feature_fusion,
    "tfidf_vectors": tfidf_vectors,
    "char_tfidf": lambda s, d: features.char_tfidf(_docs(s, d)),
    "class_weights": lambda s, d: features.class_weights(_labels(s, d), "quality"),
    "rf_score": rf_score,
    "gbt_score": gbt_score,
    "ablation": ablation,
    "rf_check": rf_check,
    "gbt_check": gbt_check,
    "ablation_check": ablation_check,
    "best_split": best_split,
    "split_tree": split_tree,
    "tree_shap": tree_shap,
    "stream_tree_score": stream_tree_score,
    "boosted_shap": boosted_shap,
    "boosted_shap_check": boosted_shap_check,
    "rank_auc": rank_auc,
    "cell_ablation": cell_ablation,
    "group_shapley": group_shapley,
    "linear_shap": linear_shap,
    "system_status": system_status,
    "system_status_json": system_status_json,
    "system_status_active": system_status_active,
}
