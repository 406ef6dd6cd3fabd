"""Language identification: a document as a mixture of languages.

Each language is a distribution over hashed byte trigrams, learnt from labelled text. For a document,
expectation-maximisation finds the proportions that make its trigrams likeliest. The set of languages grows
from the best single one; a further language stays only if it raises the log-likelihood by more than a
penalty, which grows with the logarithm of the number of trigrams (as in the Bayesian information criterion).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructType

from brookmill.llm.common import Rows, map_batches

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
MAX_LANGUAGES = 256
SLICE = 1 << 20
UNKNOWN = "und"

# Letters: a-z with A-Z folded, and every byte of a character outside ASCII. All else parts words.
_LETTER = np.zeros(256, np.uint32)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def gram_counts(text: str) -> np.ndarray:
    """Counts per bucket of the trigrams around every letter, word borders included."""
    data = np.frombuffer(b" " + text.encode() + b" ", np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(data) - 2, SLICE):
        codes = _LETTER[data[start : start + SLICE + 2]]
        left, middle, right = codes[:-2], codes[1:-1], codes[2:]
        key = ((left << 16 | middle << 8 | right) * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
        counts += np.bincount(key[middle > 0], minlength=BUCKETS)
    return counts


@dataclass
class Languages:
    names: list[str]
    likelihood: np.ndarray  # languages x buckets

    def mixture(self, counts: np.ndarray, penalty: float) -> dict[int, float]:
        """Chosen languages and their proportions."""
        seen = np.flatnonzero(counts)
        n = counts[seen].astype(float)
        total = n.sum()
        p = self.likelihood[:, seen]
        single = np.log(p) @ n
        best = int(np.argmax(single))
        chosen, weights, reached = [best], np.ones(1), single[best]
        threshold = penalty * np.log(total + 1)
        while len(chosen) < len(self.names):
            mixed = weights @ p[chosen]
            # The likelihood is concave, so its slope towards a language bounds what that one can gain.
            slopes = p @ (n / mixed) - total
            slopes[chosen] = -np.inf
            offers = []
            for other in np.flatnonzero(slopes > threshold):
                trial = [*chosen, int(other)]
                w = expectation_maximisation(p[trial], n, np.append(weights * 0.8, 0.2))
                offers.append((float(np.log(w @ p[trial]) @ n), -int(other), w))
            if not offers:
                break
            value, other, w = max(offers, key=lambda o: o[:2])
            if value - reached <= threshold:
                break
            chosen, weights, reached = [*chosen, -other], w, value
        return dict(zip(chosen, weights.tolist()))


def expectation_maximisation(p: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Proportions of the rows of ``p`` that make ``n`` draws per column likeliest."""
    weights, total = start, n.sum()
    for _ in range(rounds):
        new = weights * (p @ (n / (weights @ p))) / total
        done = np.abs(new - weights).max() < 1e-3
        weights = new
        if done:
            break
    return weights / weights.sum()


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", max_languages: int = MAX_LANGUAGES) -> Languages:
    """Trigram distributions of every language that ``lang`` names, from all rows of ``docs``.

    Rows with a null language or text teach nothing. Counts are summed in the map tasks first; the driver
    gets one number per language and bucket. More than ``max_languages`` names are refused, not dropped, before any is counted.
    """
    schema = "lang STRING, buckets ARRAY<INT>, counts ARRAY<BIGINT>"

    def count(batches: Rows) -> Rows:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(batch["_lang"], batch["_text"]):
                found = gram_counts(t)
                sums[name] = sums[name] + found if name in sums else found
        used = {name: np.flatnonzero(c) for name, c in sums.items()}
        yield {
            "lang": list(sums),
            "buckets": [u.tolist() for u in used.values()],
            "counts": [sums[name][u].tolist() for name, u in used.items()],
        }

    labelled = docs.select(F.col(lang).alias("_lang"), F.col(text).alias("_text")).dropna()
    if labelled.select("_lang").distinct().limit(max_languages + 1).count() > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages")
    summed = (
        map_batches(labelled, count, schema)
        .select("lang", F.explode(F.arrays_zip("buckets", "counts")).alias("g"))
        .groupBy("lang", "g.buckets")
        .agg(F.sum("g.counts").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("buckets", "n")).alias("grams"))
        .sort("lang")
        .collect()
    )
    counts = np.zeros((len(summed), BUCKETS))
    for i, row in enumerate(summed):
        counts[i, [g[0] for g in row.grams]] = [g[1] for g in row.grams]
    shared = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * BUCKETS)
    smooth = 0.01 * counts.sum(axis=1, keepdims=True) + 50
    return Languages([r.lang for r in summed], (counts + smooth * shared) / (counts.sum(axis=1, keepdims=True) + smooth))


def identify(
    docs: DataFrame,
    languages: Languages,
    id: str = "doc_id",
    text: str = "text",
    penalty: float = 3.0,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """``id, lang_pred, score, mixture`` and the columns of ``keep``: one row per row of ``docs``, no shuffle.

    ``mixture`` lists the chosen languages with their proportions; the largest is the prediction and its
    proportion the score (of equal ones, the first name). A null text, a text without any letter, or
    no learnt language give ``und``, score 0 and an empty mixture. Long texts are counted in slices.
    """
    extra = docs.select(*[c.alias(name) for name, c in (keep or {}).items()]).schema
    schema = StructType().add(id, docs.schema[id].dataType)
    for field in extra:
        schema = schema.add(field)
    schema = schema.add("lang_pred", "string").add("score", "double").add("mixture", MapType(StringType(), DoubleType()))
    broadcast = docs.sparkSession.sparkContext.broadcast(languages)

    def work(batches: Rows) -> Rows:
        model = broadcast.value
        for batch in batches:
            found = []
            for t in batch["_text"]:
                if not t or not model.names or not any(map(str.isalpha, t)):
                    found.append((UNKNOWN, 0.0, []))
                    continue
                counts = gram_counts(t)
                mix = model.mixture(counts, penalty) if counts.any() else {}
                named = sorted(((w, model.names[i]) for i, w in mix.items()), key=lambda x: (-x[0], x[1]))
                score, name = named[0] if named else (0.0, UNKNOWN)
                found.append((name, min(1.0, score), [(m, w) for w, m in named]))
            out = {c: batch[c] for c in (id, *extra.names)}
            yield out | {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "mixture": [f[2] for f in found]}

    rows = docs.select(id, *[c.alias(name) for name, c in (keep or {}).items()], F.col(text).alias("_text"))
    return map_batches(rows, work, schema)
