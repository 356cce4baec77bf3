"""Quality rules by weak supervision, in DataFrame functions only.

Every rule looks at one signal of a text and votes good, bad or abstains. Which
votes to trust is learned without labels: documents with the same votes are
counted (at most ``3 ** rules`` patterns), and expectation-maximisation on those
counts estimates how often each rule votes either way on good and on bad texts.
The posterior probability that a text is good replaces "all rules must pass".
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genespark.llm.common import WHITE, whole_text
from genespark.session import materialize

SPLIT = "[ \\t-\\r]+"
SYMBOLS = "[#*$%&|<>]+"


def quality_signals(docs: DataFrame) -> DataFrame:
    """Add the counts that rules look at; all are bigint and zero for a null or empty text.

    Words are runs of characters other than space and \\t to \\r; n_words, word_chars
    (code points in words), n_symbols (characters of ``SYMBOLS``), n_lines and
    n_dup_lines (lines with a word; those equal to an earlier one), n_repeat_words
    (words inside 5-word windows that occur at least twice, the first included),
    n_upper (upper-case letters), n_unique (different words), n_marked (words
    that end in two or more signs other than letters and digits).

    Windows are compared by 64-bit hashes within one text.
    """
    size = lambda c: F.size(c).cast("bigint")
    text = whole_text()
    trimmed = F.btrim(text, F.lit(WHITE))
    rows = docs.withColumns({
        "_w": F.filter(F.split(trimmed, SPLIT), lambda x: x != ""),
        "_l": F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")})
    n = F.size("_w")
    rows = rows.withColumn("_h", F.when(n >= 5, F.transform(
        F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(5)]))).otherwise(F.array().cast("array<bigint>")))
    some = F.size(F.array_distinct("_h")) < F.size("_h")
    rows = rows.withColumn("_s", F.when(some, F.array_sort(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")))
    twice = F.filter("_s", lambda x, i: F.coalesce(F.get("_s", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
        F.get("_s", i + 1)["h"] == x["h"], F.lit(False)))
    rows = rows.withColumn("_p", F.array_sort(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "_p", F.struct(F.lit(-5).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(5), x - a["last"])).alias("n")), lambda a: a["n"])
    removed = lambda pattern: (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("bigint")
    return rows.withColumns({
        "n_words": size("_w"), "word_chars": F.length(F.array_join("_w", "")).cast("bigint"), "n_symbols": removed(SYMBOLS),
        "n_lines": size("_l"), "n_dup_lines": size("_l") - size(F.array_distinct("_l")), "n_repeat_words": covered,
        "n_upper": removed("\\p{Lu}+"), "n_unique": size(F.array_distinct("_w")),
        "n_marked": size(F.filter("_w", lambda x: x.rlike("[\\p{L}\\p{N}]([^\\p{L}\\p{N}])\\1+$|[\\p{L}\\p{N}][,.;:]?([!?])\\2+$"))),
    }).drop("_w", "_l", "_h", "_s", "_p")


def rules() -> dict[str, tuple[Column, Column]]:
    """Rule -> (votes good, votes bad) over the signals; it abstains where neither holds."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    symbols, repeats, dup = F.col("n_symbols") / n, F.col("n_repeat_words") / n, F.col("n_dup_lines") / lines
    upper, unique, marked, mean = F.col("n_upper") / chars, F.col("n_unique") / n, F.col("n_marked") / n, F.col("word_chars") / n
    some = F.col("n_words") >= 10
    return {
        "symbols": (symbols <= 0.01, symbols > 0.1),
        "repeats": (some & (repeats <= 0.1), repeats > 0.2),
        "dup_lines": ((F.col("n_lines") >= 3) & (dup <= 0.1), (F.col("n_lines") >= 4) & (dup > 0.5)),
        "upper": (upper <= 0.08, upper > 0.25),
        # long texts repeat more of their words
        "unique": (some & (unique >= F.when(F.col("n_words") <= 200, 0.45).otherwise(0.15)),
                   (F.col("n_words") >= 20) & (unique < F.when(F.col("n_words") <= 200, 0.25).otherwise(0.05))),
        "marked": (marked <= 0.02, marked > 0.1),
        "word_length": (some & mean.between(3, 8), (mean > 12) | (mean < 2)),
        "length": (F.col("n_words") >= 40, F.col("n_words") < 5),
    }


# What is believed before data, worth ``WEIGHT`` documents: how often a rule that votes
# votes bad, on good texts and on texts that are bad in its own or in another rule's way.
BAD_ON_GOOD, BAD_ON_OWN, BAD_ON_OTHER = 0.005, 0.95, 0.25
GOOD_SHARE = 0.8
WEIGHT = 50.0
# Bounds on those rates: a rule that fires more often on good texts describes a kind of
# bad text, and a kind whose own rule fires more rarely is not about that rule.
MOST_ON_GOOD, LEAST_ON_OWN = 0.01, 0.8


def posteriors(patterns: dict[tuple[int, ...], int], rounds: int = 200, settle: float = 1e-9) -> dict[tuple[int, ...], float]:
    """Votes -> probability that a text with these votes is good, by expectation-maximisation.

    ``patterns`` has the number of documents per tuple of votes (1 good, -1 bad,
    0 none). The latent kinds are "good" and one kind of bad text per rule; given
    the kind, rules vote independently, and an abstention says nothing. Estimated
    are each rule's accuracy per kind and the shares of the kinds.
    """
    if not patterns:
        return {}
    rules_ = range(len(next(iter(patterns))))
    kinds = [None, *rules_]
    belief = {k: [BAD_ON_GOOD if k is None else BAD_ON_OWN if k == j else BAD_ON_OTHER for j in rules_] for k in kinds}
    share_0 = {k: GOOD_SHARE if k is None else (1 - GOOD_SHARE) / len(rules_) for k in kinds}
    share, bad, total = dict(share_0), {k: list(v) for k, v in belief.items()}, sum(patterns.values())

    def responsible(pattern: tuple[int, ...]) -> dict:
        weight = {k: share[k] * math.prod(bad[k][j] if v < 0 else 1 - bad[k][j] for j, v in enumerate(pattern) if v) for k in kinds}
        every = sum(weight.values())
        return {k: w / every for k, w in weight.items()}

    for _ in range(rounds):
        mass = dict.fromkeys(kinds, 0.0)
        voted, voted_bad = ({k: [0.0 for _ in rules_] for k in kinds} for _ in range(2))
        for pattern, n in sorted(patterns.items()):
            for k, w in responsible(pattern).items():
                mass[k] += n * w
                for j, v in enumerate(pattern):
                    voted[k][j] += n * w * (v != 0)
                    voted_bad[k][j] += n * w * (v < 0)
        new = {k: (mass[k] + WEIGHT * share_0[k]) / (total + WEIGHT) for k in kinds}
        moved = max(abs(new[k] - share[k]) for k in kinds)
        share = new
        for k in kinds:
            for j in rules_:
                p = (voted_bad[k][j] + WEIGHT * belief[k][j]) / (voted[k][j] + WEIGHT)
                bad[k][j] = min(max(p, LEAST_ON_OWN if k == j else 0.001), MOST_ON_GOOD if k is None else 0.99)
        if moved < settle:
            break
    return {pattern: responsible(pattern)[None] for pattern in patterns}


def judge(signals: DataFrame) -> DataFrame:
    """Add base_failed, posterior and kept to a written table with the signals.

    ``base_failed``: fewer than 10 words, or more than a fifth of them in
    repeated windows. ``kept``: not so, and more likely good than bad. All rows
    stay; repeated rows are judged alike. Columns of these names are replaced.
    """
    votes = {f"_v_{name}": F.when(bad, -1).when(good, 1).otherwise(0) for name, (good, bad) in rules().items()}
    voted = signals.drop("base_failed", "posterior", "kept").withColumns(votes)
    # At most 3 ** rules rows, whatever the size of the table: the counts, and the verdicts that are broadcast.
    counted = voted.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).collect()
    good = posteriors({tuple(r[:-1]): r["n"] for r in counted})
    schema = ", ".join([*(f"{v} int" for v in votes), "posterior double"])
    verdicts = signals.sparkSession.createDataFrame([(*pattern, p) for pattern, p in good.items()], schema)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return voted.join(F.broadcast(verdicts), list(votes)).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)).drop(*votes)


def quality_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and posterior of every document."""
    signals = materialize(quality_signals(docs.select("doc_id", "text")).drop("text"))
    return judge(signals).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
