"""Learned decision lists over text statistics."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import SPACE, SPACE_CHARACTERS, as_row, held, row_columns, whole_text
from tidemark.sources.scratch import new_folder

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
LEAST_WORDS = 50
MOST_REPEATED = 50

# Cuts tried for each feature, rules of a list and conditions of a rule.
CUTS = 32
RULES = 8
CONDITIONS = 3
# One labelled row in so many prunes the rules that the others grow.
PRUNE_FOLD = 3
# A rule must reject this share rightly in both folds, and so many labelled rows.
PRECISION = 0.95
LEAST_COVERED = 3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "capital_share",
    "digit_share", "line_words",
)

Condition = tuple[str, str, float]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``COUNTS`` and the ratios ``FEATURES``, each under ``__``.

    Repeated windows are found by sorting the 64-bit hashes of a text's word
    triples with their places: two different triples of one text share a hash
    with a chance of about n^2 / 2^65. Texts whose hashes are all different
    are not sorted.
    """
    whole = whole_text(text)
    blank = F.translate(whole, SPACE_CHARACTERS, " " * len(SPACE_CHARACTERS))

    def number_of(characters: str) -> Column:
        return (F.length(whole) - F.length(F.translate(whole, characters, ""))).cast("long")

    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(rf"[^{SPACE}]"))
    split = docs.withColumns({
        "__list": F.filter(F.split(blank, " "), lambda w: w != ""), "__lines": lines,
        "__word_chars": F.length(F.translate(whole, SPACE_CHARACTERS, "")).cast("long"),
        "__n_symbols": number_of(SYMBOLS), "__capitals": number_of(CAPITALS), "__digits": number_of(DIGITS),
    })
    triples = split.withColumn("__triples", F.when(F.size("__list") >= 3, F.transform(
        F.slice("__list", F.lit(1), F.greatest(F.size("__list") - 2, F.lit(1))),
        lambda w, k: F.xxhash64(w, F.get("__list", k + 1), F.get("__list", k + 2)),
    )))
    ordered = triples.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__triples")) < F.size("__triples"),
        F.sort_array(F.transform("__triples", lambda h, k: F.struct(h.alias("h"), k.alias("k")))),
    ))
    twice = ordered.withColumn("__starts", F.sort_array(F.transform(
        F.filter("__sorted", lambda x, k: F.coalesce(x["h"] == F.get("__sorted", k - 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get("__sorted", k + 1)["h"], F.lit(False))),
        lambda x: x["k"],
    )))
    # A start covers three words, or as many as there are before the next start.
    covered = F.aggregate(
        F.transform("__starts", lambda s, k: F.least(F.lit(3), F.coalesce(F.get("__starts", k + 1) - s, F.lit(3)))),
        F.lit(0), lambda total, x: total + x,
    )
    counted = twice.withColumns({
        "__n_words": F.size("__list").cast("long"),
        "__n_lines": F.size("__lines").cast("long"),
        "__n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "__n_distinct": F.size(F.array_distinct("__list")),
    }).drop("__list", "__lines", "__triples", "__sorted", "__starts")
    n, chars = F.col("__n_words"), F.col("__word_chars")
    return counted.withColumns({
        "__words": n.cast("double"), "__word_length": _share(chars, n), "__symbol_share": _share(F.col("__n_symbols"), chars),
        "__dup_line_share": _share(F.col("__n_dup_lines"), F.col("__n_lines")), "__repeat_share": _share(F.col("__n_repeat_words"), n),
        "__distinct_share": _share(F.col("__n_distinct"), n), "__capital_share": _share(F.col("__capitals"), chars),
        "__digit_share": _share(F.col("__digits"), chars), "__line_words": _share(n, F.col("__n_lines")),
    }).drop("__capitals", "__digits", "__n_lines", "__n_distinct")


def base_failed() -> Column:
    return (F.col("__n_words") < LEAST_WORDS) | (100 * F.col("__n_repeat_words") > MOST_REPEATED * F.col("__n_words"))


def _test(condition: Condition) -> Column:
    feature, side, cut = condition
    value = F.col(f"__{feature}")
    return F.coalesce(value >= cut if side == ">=" else value < cut, F.lit(False))


def _holds(rule: list[Condition]) -> Column:
    return reduce(and_, map(_test, rule), F.lit(True))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Covered bad rows times the information that the condition adds."""
    if p == 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(labelled: DataFrame) -> list[list[Condition]]:
    """An ordered list of rules, each a conjunction of thresholds that marks bad rows.

    ``labelled`` has the features and ``__bad`` (1: bad). Sequential covering:
    grow one rule on two thirds of the rows no rule covers yet, condition by
    condition by information gain; prune it on the last third by dropping
    final conditions; keep it if it is precise in both. Every step is one
    aggregation over all labelled rows; the driver sees counts for each
    feature, cut and class only.
    """
    probabilities = [k / CUTS for k in range(CUTS + 1)]
    # Values of each class, so that a rare class has cuts of its own; cuts lie midway between neighbours.
    cut_row = labelled.agg(*[
        F.percentile_approx(F.when(F.col("__bad") == y, F.col(f"__{f}")), probabilities, 10_000).alias(f"{f}_{y}")
        for f in FEATURES for y in (0, 1)
    ]).first()
    values = {f: sorted({*(cut_row[f"{f}_0"] or ()), *(cut_row[f"{f}_1"] or ())}) for f in FEATURES}
    cuts = {f: [(a + b) / 2 for a, b in zip(v[:-1], v[1:], strict=True)] for f, v in values.items()}
    if not any(cuts.values()):
        return []

    # The place of each value among its feature's cuts: value >= cuts[k] exactly when place > k.
    def place(feature: str) -> Column:
        value = F.col(f"__{feature}")
        return F.when(value.isNotNull(), F.size(F.filter(F.array(*map(F.lit, cuts[feature])).cast("array<double>"), lambda cut: cut <= value)))

    columns = ["__bad", "__prune", *[f"__{f}" for f in FEATURES]]
    places = held(labelled.select(*columns, F.array(*map(place, FEATURES)).alias("__places")))
    rules: list[list[Condition]] = []
    left = places
    while len(rules) < RULES:
        grow, rule = left.where("NOT __prune"), []
        while len(rule) < CONDITIONS:
            counts = (
                grow.where(_holds(rule)).select("__bad", F.posexplode("__places").alias("feature", "place"))
                .groupBy("feature", "place", "__bad").agg(F.count("*").alias("n")).collect()
            )
            best = _best_condition(counts, cuts)
            if best is None:
                break
            rule.append(best[0])
            if best[1] == 0:
                break
        if not rule:
            break
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        row = left.agg(*[
            F.coalesce(F.sum((_holds(r) & (F.col("__bad") == y) & (F.col("__prune") == fold)).cast("long")), F.lit(0)).alias(f"c_{k}_{y}_{int(fold)}")
            for k, r in enumerate(prefixes) for y in (0, 1) for fold in (False, True)
        ]).first()

        def worth(k: int, row=row) -> tuple[float, int]:
            p, n = row[f"c_{k}_1_1"], row[f"c_{k}_0_1"]
            return ((p - n) / (p + n) if p + n else -1.0, p)

        k = max(range(len(prefixes)), key=lambda k: (*worth(k), -k))
        p, n = row[f"c_{k}_1_1"], row[f"c_{k}_0_1"]
        p0, n0 = row[f"c_{k}_1_0"], row[f"c_{k}_0_0"]
        if p + p0 < LEAST_COVERED or p0 < PRECISION * (p0 + n0) or (p + n and p < PRECISION * (p + n)):
            break
        rules.append(prefixes[k])
        left = left.where(~_holds(prefixes[k]))
    return rules


def _best_condition(counts: list, cuts: dict[str, list[float]]) -> tuple[Condition, int] | None:
    """The condition of most gain, and the good rows it still covers."""
    best, found = 1e-9, None
    for k, feature in enumerate(FEATURES):
        at = {(r["place"], r["__bad"]): r["n"] for r in counts if r["feature"] == k}
        p0, n0 = (sum(v for (_, y), v in at.items() if y == bad) for bad in (1, 0))
        if p0 == 0 or n0 == 0:
            continue
        for c, cut in enumerate(cuts[feature]):
            p, n = (sum(v for (place, y), v in at.items() if y == bad and place is not None and place > c) for bad in (1, 0))
            p_low, n_low = (sum(v for (place, y), v in at.items() if y == bad and place is not None and place <= c) for bad in (1, 0))
            for side, a, b in ((">=", p, n), ("<", p_low, n_low)):
                gain = _gain(a, b, p0, n0)
                if a >= LEAST_COVERED and gain > best:
                    best, found = gain, ((feature, side, cut), b)
    return found


def verdict(rules: list[list[Condition]]) -> Column:
    """True where no rule of the ordered list applies."""
    found = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        found = found.when(_holds(rule), F.lit(False))
    return found.otherwise(F.lit(True))


def train(features: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """Rules learned from rows of ``features`` that pass the base rules and have a quality label; 0 is bad."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select(
        F.col("doc_id").cast("long").alias("__doc"), (1 - F.col("quality")).alias("__bad")
    )
    rows = features.where(~base_failed()).select(F.col("doc_id").cast("long").alias("__id"), *[f"__{f}" for f in FEATURES])
    labelled = rows.join(known, F.col("__id") == F.col("__doc")).withColumn(
        "__prune", F.pmod(F.xxhash64("__id"), F.lit(PRUNE_FOLD)) == 0
    ).drop("__id", "__doc")
    return learn(held(labelled))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every row.

    A row is kept if the base rules pass and no learned rule applies. Null and
    empty texts have no words and fail. Ratios without a denominator are null
    and meet no condition. Labels with null or other values are left out; ids
    with several labels count with each; rows with null ids are judged but not
    learned from. Without labels of both kinds no rule is learned. Other
    columns are not read. An empty table gives an empty result.
    """
    features = held(measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text"))
    rules = train(features, labels)
    return features.select(
        "doc_id", *[F.col(f"__{c}").alias(c) for c in COUNTS], base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps; texts are measured once and written with their statistics."""
    folder = new_folder(docs.sparkSession, "measured")
    measured(docs.select(as_row(docs), F.col("doc_id"), F.col("text"))).drop("text").write.parquet(folder)
    rows = docs.sparkSession.read.parquet(folder)
    return rows.where(~base_failed() & verdict(train(rows, labels))).select(*row_columns(docs.columns))
