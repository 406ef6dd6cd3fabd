"""A rule base as a table: thousands of patterns, each tried only where a literal that it needs occurs.

A rule has literals of which every match contains at least one. One gram of each literal, the one that the fewest documents have, points from
documents to rules. Documents give just their grams that occur in some literal, so texts are neither multiplied by rules nor shuffled by gram.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.functions.text import char_grams
from brookmill.operators.features import Rule
from brookmill.operators.skew import BROADCAST_BYTES, fits, lookup
from brookmill.session import materialise

GRAM = 3
RULES = "rule_id STRING, pattern STRING, weight DOUBLE, literals ARRAY<STRING>"


def rule_rows(df: DataFrame, rules: tuple[Rule, ...], literals: dict[str, list[str]]) -> DataFrame:
    """Rules of the program as rows, with the literals that their matches need."""
    return df.sparkSession.createDataFrame([(r.rule_id, r.pattern, r.weight, literals.get(r.rule_id)) for r in rules], RULES)


def _grams(text: str) -> Column:
    """The distinct grams of a text."""
    return F.array_distinct(char_grams(F.col(text), GRAM))


def _may_match(literals: list[str | None] | None) -> Column:
    """Does ``_text`` hold one of the literals? True if there are none, or one is unknown."""
    if not literals or None in literals:
        return F.lit(True)
    return reduce(Column.__or__, [F.contains(F.lower("_text"), F.lit(part)) for part in literals])


def rule_hits(docs: DataFrame, rules: DataFrame, id: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``id, rule_id, weight`` of every match of a rule in a text; null texts match none, and ids are a key.

    ``rules`` has ``rule_id`` (a key), ``pattern``, ``weight`` and ``literals``: texts in lower case of which every match contains one, in any
    case. A rule with a null or empty list is tried on every text, and one with a literal shorter than three characters is sought in every text; such
    rules should be few. A pattern that Spark cannot read fails.
    """
    literals = rules.select("rule_id", F.explode("literals").alias("literal")).distinct()
    short = literals.where(F.char_length("literal") < GRAM).select("rule_id")
    everywhere = rules.where((F.coalesce(F.size("literals"), F.lit(0)) < 1)).select("rule_id").union(short).distinct()
    indexed = materialise(literals.join(everywhere, "rule_id", "left_anti").select("*", F.explode(_grams("literal")).alias("gram")), "literal-grams")

    wanted = materialise(indexed.select("gram").distinct(), "wanted-grams")
    lower = docs.where(F.col(text).isNotNull()).select(id, F.lower(text).alias("_lower"))
    own = lower.select(id, F.explode(_grams("_lower")).alias("gram"))
    small = fits(wanted, broadcast_bytes)
    found = materialise(own.join(F.broadcast(wanted) if small else wanted, "gram", "left_semi"), "found-grams")

    # Of each literal the gram of the fewest documents; one that no document has rules the literal out.
    frequency = found.groupBy("gram").agg(F.count("*").alias("n"))
    ranked = indexed.join(frequency, "gram", "left").groupBy("rule_id", "literal").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("_rarest")
    )
    anchors = ranked.where("_rarest.n > 0").select("rule_id", F.col("_rarest.gram").alias("gram"), F.col("_rarest.n").alias("n"))
    by_gram = materialise(anchors.groupBy("gram").agg(F.collect_set("rule_id").alias("_rules"), F.max("n").alias("n")), "anchors")
    pointed = lookup(found, by_gram, ["gram"], "n", [id], broadcast_bytes).select(id, F.explode("_rules").alias("rule_id"))

    sought = rules.select("rule_id", "pattern", "weight", "literals")
    pairs = pointed.distinct()
    pairs = pairs.join(F.broadcast(sought) if fits(sought, broadcast_bytes) else sought, "rule_id")
    candidates = pairs.groupBy(F.col(id).alias("_id")).agg(F.collect_list(F.struct(*sought.columns)).alias("_tried"))

    # Most texts with the gram lack the literal. That is told without the pattern, which is compiled for each text where it is a row's.
    texts = docs.where(F.col(text).isNotNull()).select(F.col(id), F.col(text).alias("_text"))
    whole = F.transform(F.array(F.lower("_text")), lambda lower: F.filter("_tried", lambda r: F.exists(r["literals"], lambda part: F.contains(lower, part))))
    hits = F.filter(F.flatten(whole), lambda r: F.regexp_like(F.col("_text"), r["pattern"]))
    pointed_hits = texts.join(candidates, F.col(id) == F.col("_id")).select(id, F.explode(hits).alias("_hit")).select(id, "_hit.rule_id", "_hit.weight")

    # The rules for all texts are few: each becomes a column of one scan, is compiled once, and is tried where one of its short literals stands.
    always = rules.join(everywhere, "rule_id", "left_semi").select(*sought.columns).collect()
    if not always:
        return pointed_hits
    named = [F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.weight).cast("double").alias("weight")) for r in always]
    matches = [F.when(_may_match(r.literals) & F.regexp_like("_text", F.lit(r.pattern).cast("string")), name) for r, name in zip(always, named)]
    each = texts.select(id, F.explode(F.filter(F.array(*matches), lambda hit: hit.isNotNull())).alias("_hit"))
    return pointed_hits.unionAll(each.select(id, "_hit.rule_id", "_hit.weight"))
