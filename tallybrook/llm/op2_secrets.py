"""Secrets in texts, in DataFrame functions only: fixed patterns, and character Markov models.

The models tell random strings from ordinary identifiers: each is a table of transition
probabilities between characters, trained from labelled samples, and a candidate string
is a secret if its log-likelihood ratio a transition is high enough. Scoring looks
the ratios up in a constant array, so a row is worked on by itself, without a shuffle.

Candidates are runs of the alphabet, and the pieces that ``/ = - _`` cut them into. A run is
a secret as a whole if it and each of its pieces look random; else those of its pieces
are that do, so that a key within a path is found without the path.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per kind the pattern, the group that counts, and its least length. Runs of
# AKIA... and hex characters are cut to the least length in the pattern itself.
KEYWORD = "(?i:password|passwd|secret|token|api_?key)"
BASE_KINDS = (
    ("assign", KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", "AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", "[0-9a-f]{32,}", 0, 32),
)
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
MARKOV = "markov"
# A candidate has at least this many characters: fewer have too few transitions to tell.
LEAST_LENGTH = 14
# Shorter pieces of a run are not asked whether they look random.
_TELLING = 3
# Log-likelihood ratio (nats a transition) from which a candidate is a secret.
LEAST_RATIO = 0.5
PLACEHOLDER = "[SECRET]"
SPANS = "array<struct<kind:string,start:int,end:int>>"


class Model(NamedTuple):
    """Log-likelihood ratio per pair of characters, random over ordinary, row by row."""

    ratios: tuple[float, ...]


def train(samples: DataFrame, *, value: str = "value", label: str = "label", smoothing: float = 0.5) -> Model:
    """Fit both models: label 1 marks random strings, 0 ordinary identifiers.

    Characters outside the alphabet, null values and null labels do not count. Only the
    counts per pair and label reach the driver: at most 2 * len(ALPHABET) ** 2 of them.
    """
    v = F.col("_v")
    pairs = samples.select(
        samples[f"`{value}`"].cast("string").alias("_v"), samples[f"`{label}`"].cast("int").alias("_l")
    ).where("_l in (0, 1) and length(_v) > 1")
    pairs = pairs.select("_l", F.explode(F.transform(
        F.sequence(F.lit(1), F.length(v) - 1), lambda i: F.substring(v, i, F.lit(2))
    )).alias("_p"))
    counted = pairs.where(F.col("_p").rlike("^[A-Za-z0-9+/_=-]{2}$")).groupBy("_l", "_p").count()
    counts = {(r["_l"], r["_p"]): r["count"] for r in counted.collect()}
    size = len(ALPHABET)
    totals = {(x, a): smoothing * size + sum(counts.get((x, a + b), 0) for b in ALPHABET)
              for x in (0, 1) for a in ALPHABET}
    chance = lambda x, a, b: (counts.get((x, a + b), 0) + smoothing) / totals[x, a]
    return Model(tuple(math.log(chance(1, a, b) / chance(0, a, b)) for a in ALPHABET for b in ALPHABET))


def labelled_samples(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", most: int = 200) -> DataFrame:
    """Samples (value, label) from at most ``most`` documents, those of least hashed id.

    Ordinary: the words of their texts, as they are, joined by an underscore, capitalised
    together, and numbered. Random: digests of their ids in base 64, its URL-safe form, in
    hex and as capitals and digits, as many characters as keys usually have.
    """
    least = docs.select(docs[f"`{doc_id}`"].alias("_id")).where("_id is not null").distinct()
    least = least.orderBy(F.xxhash64("_id"), "_id").limit(most)
    own = docs.select(docs[f"`{doc_id}`"].alias("_id"), docs[f"`{text}`"].cast("string").alias("_t"))
    own = own.join(F.broadcast(least), "_id", "left_semi")
    words = own.select("_id", F.regexp_extract_all("_t", F.lit("[A-Za-z]{3,}"), F.lit(0)).alias("_w"))
    words = words.select("_id", F.posexplode("_w").alias("_i", "_a"), "_w")
    b = F.coalesce(F.get("_w", F.col("_i") + 1), F.lit("name"))
    ordinary = words.select(F.explode(F.array(
        F.col("_a"),
        F.concat_ws("_", F.lower("_a"), F.lower(b), "_i"),
        F.concat(F.initcap("_a"), F.initcap(b)),
        F.concat_ws("-", "_a", b, F.lit(2000) + F.col("_i") % 100),
    )).alias("value"), F.lit(0).alias("label"))
    n = F.explode(F.sequence(F.lit(1), F.lit(20)))
    seeds = least.select("_id", n.alias("_n"))
    digest = F.sha2(F.concat_ws("/", F.col("_id").cast("string"), "_n"), 256)
    coded = F.base64(F.unhex(digest))
    random = seeds.select(F.explode(F.array(
        F.regexp_replace(coded, "=", ""),
        F.translate(coded, "+/=", "-_"),
        F.substring(digest, 1, 40),
        F.translate(F.upper(coded), "+/=", "XYZ"),
    )).alias("value"), F.lit(1).alias("label"))
    return ordinary.union(random)


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of the pattern's matches in code points, kept if the group is long enough."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    matches = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), part.alias("part"))

    def step(acc, m):
        start = acc["at"] + F.length(m["gap"])
        end = start + F.coalesce(F.length(m["whole"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"))
        long = F.coalesce(F.length(m["part"]) >= least, F.lit(False))
        return F.struct(
            end.alias("at"), F.when(long, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out")
        )

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))
    found = F.aggregate(matches, nothing, step, lambda acc: acc["out"])
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(F.array().cast(SPANS))


def log_ratio(value: Column, model: Model) -> Column:
    """Log-likelihood ratio of a string over the alphabet, a transition.

    A transition that repeats counts once, so that one rare pair, repeated, looks no more
    random than it does once.
    """
    size = len(ALPHABET)
    table = F.split(F.lit(",".join(map(repr, model.ratios))), ",").cast("array<double>")
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    follows = F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0)))
    pairs = F.zip_with(codes, follows, lambda a, b: F.when((a >= 0) & (b >= 0), a * size + b))
    total = F.aggregate(
        F.array_distinct(pairs), F.lit(0.0), lambda acc, p: acc + F.coalesce(F.get(table, p), F.lit(0.0))
    )
    return total / F.greatest(F.length(value) - 1, F.lit(1))


def find(docs: DataFrame, model: Model, *, keep=("doc_id",), text: str = "text",
         least_length: int = LEAST_LENGTH) -> DataFrame:
    """The ``keep`` columns, ``base`` and ``spans``: arrays of struct(kind, start, end).

    ``base`` holds the spans of the fixed patterns, by start, then kind in their order.
    ``spans`` adds those that the models find outside of them, kind ``markov``, of at least
    ``least_length`` characters. Offsets are code points, end exclusive. A null text is
    empty and has none; repeated rows stay.
    """
    kept = [docs[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")).alias("_t"))
    base = F.concat(*[_spans(F.col("_t"), *kind) for kind in BASE_KINDS])
    run, piece = f"[A-Za-z0-9+/_=-]{{{least_length},}}", f"[A-Za-z0-9+]{{{least_length},}}"
    rows = rows.withColumns({
        "_b": F.array_sort(base, _in_order), "_c": _spans(F.col("_t"), MARKOV, run, 0, least_length),
    })
    value = lambda span: F.substr("_t", span["start"] + 1, span["end"] - span["start"])
    overlaps = lambda spans, span: F.exists(
        spans, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"])
    )

    def random_run(span):
        whole = value(span)
        pieces = F.regexp_extract_all(whole, F.lit(f"[A-Za-z0-9+]{{{_TELLING},}}"), F.lit(0))
        cut = F.rlike(whole, F.lit("[/_=-]")) & ~overlaps("_b", span)
        each = F.forall(pieces, lambda p: log_ratio(p, model) > 0)
        return F.when(cut, (log_ratio(whole, model) >= LEAST_RATIO) & each).otherwise(False)

    def random_piece(span):
        alone = ~overlaps("_b", span) & ~overlaps("_w", span)
        return F.when(alone, log_ratio(value(span), model) >= LEAST_RATIO).otherwise(False)

    rows = rows.withColumn("_w", F.filter("_c", random_run))
    # no run, no piece
    pieces = F.when(F.size("_c") > 0, _spans(F.col("_t"), MARKOV, piece, 0, least_length)).otherwise(F.array().cast(SPANS))
    rows = rows.withColumn("_p", pieces).withColumn("_m", F.concat("_w", F.filter("_p", random_piece)))
    return rows.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_b").alias("base"),
        F.array_sort(F.concat("_b", "_m"), _in_order).alias("spans"),
    )


_ORDER = [kind[0] for kind in BASE_KINDS] + [MARKOV]


def _in_order(a: Column, b: Column) -> Column:
    rank = lambda s: F.array_position(F.array(*map(F.lit, _ORDER)), s["kind"])
    before = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (rank(a) < rank(b)))
    same = (a["start"] == b["start"]) & (rank(a) == rank(b))
    return F.when(before, -1).when(same, 0).otherwise(1)


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, placeholder: str = PLACEHOLDER) -> Column:
    """The text with each span, or run of overlapping spans, replaced by a placeholder."""

    def step(acc, s):
        gap = F.substr(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(placeholder)).alias("out"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(longer)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
