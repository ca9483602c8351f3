"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document where one statistic of its text is beyond a cutoff. Which
cutoff holds is decided for every stratum and rule on labelled documents: the cutoffs
are tried from loose to strict, each against an exact binomial bound on the share of
good documents it rejects, and the first that fails ends the row. Of the cutoffs that
pass, the one that tells bad documents best from good ones is taken.

With probability ``1 - delta`` no stratum loses more than ``alpha`` of its good
documents: alpha is divided among the rules, delta among all rules of all strata, and
along the cutoffs of a rule a fixed sequence of tests needs no further correction.
All of it is DataFrame operations.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.mixing import _log_choose
from tidemark.session import write_through

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30


class Rule(NamedTuple):
    """Reject where ``scale * numerator / denominator`` is at least (or, ``below``, at most) the cutoff.

    ``cutoffs`` go from loose to strict: what one rejects, the next ones reject too.
    They are given, not learned from the labels that certify them.
    """

    numerator: str
    denominator: str
    scale: int
    below: bool
    cutoffs: tuple[int, ...]


RULES = (
    Rule("n_symbols", "word_chars", 1000, False, (500, 400, 300, 200, 150, 100, 70, 50, 40, 30, 20, 15, 10, 5)),
    Rule("word_chars", "n_words", 100, False, (2000, 1500, 1200, 1000, 900, 800, 750, 700, 650, 600)),
    Rule("word_chars", "n_words", 100, True, (150, 200, 250, 275, 300, 325, 350, 375, 400)),
    Rule("n_dup_lines", "n_lines", 1000, False, (900, 700, 500, 400, 300, 250, 200, 150, 100, 50)),
    Rule("n_repeat_words", "n_words", 1000, False, (300, 250, 200, 150, 100, 70, 50, 30, 10)),
    Rule("n_upper", "word_chars", 1000, False, (900, 700, 500, 400, 300, 250, 200, 150, 120, 100, 80, 60)),
)


def text_statistics(docs: DataFrame, text: str, id: str, stratum: str) -> DataFrame:
    """(id, stratum, and the counts that rules are about) for every row.

    ``n_repeat_words`` counts the words in windows of 8 words that occur twice or more
    in the text. Windows meet by a hash of 64 bits and then by their words.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    n, h, at = F.col("n_words"), F.col("h"), F.col("at")
    # Word by word: a slice of an array copies all of the array first.
    window = lambda p: F.xxhash64(*[F.get("hashes", p + k) for k in range(WINDOW)])

    def same(x: Column, y: Column) -> Column:
        equal = x["h"] == y["h"]
        for k in range(WINDOW):
            equal = equal & (F.get("words", x["p"] + k) == F.get("words", y["p"] + k))
        return F.coalesce(equal, F.lit(False))

    lines = F.split(F.col("text"), "\n")
    rows = docs.select(
        F.col(f"`{id}`").alias("id"),
        F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("")).alias("stratum"),
        body.alias("text"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"),
    )
    rows = rows.select(
        "id", "stratum", "text", "words", F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.filter(lines, lambda line: F.regexp_like(line, F.lit(WORD))).alias("lines"),
    )
    windows = F.when(
        n >= WINDOW, F.transform(F.sequence(F.lit(0), (n - WINDOW).cast("int")), window)
    ).otherwise(F.array().cast("array<long>"))
    rows = rows.withColumn("h", windows)
    # Most texts repeat no window; only for the others are the windows sorted.
    sorted_windows = F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    )
    rows = rows.withColumn("at", F.when(F.size(F.array_distinct(h)) < F.size(h), sorted_windows))
    twice = F.filter(at, lambda x, i: same(x, F.get(at, i - 1)) | same(x, F.get(at, i + 1)))
    rows = rows.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["p"])))
    starts = F.col("starts")
    covered = F.transform(starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.regexp_count("text", F.lit(SYMBOL)),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0), lambda acc, x: acc + x), F.lit(0)),
        "n_lines": F.size("lines"),
        "n_upper": F.regexp_count("text", F.lit("[A-Z]")),
    }
    return rows.select("id", "stratum", *[c.cast("long").alias(name) for name, c in counts.items()])


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def strictness(rule: Rule) -> Column:
    """How many of the rule's cutoffs reject the row: the strictest ones, as the cutoffs are nested."""
    top, bottom = F.col(rule.numerator) * rule.scale, F.col(rule.denominator)
    cutoffs = F.array(*[F.lit(c).cast("long") for c in rule.cutoffs])
    beyond = lambda c: (top <= c * bottom) if rule.below else (top >= c * bottom)
    return F.when(bottom > 0, F.size(F.filter(cutoffs, beyond))).otherwise(0)


def at_most(k: Column, n: Column, alpha: float) -> Column:
    """The probability of at most ``k`` hits in ``n`` trials of probability ``alpha``, from above.

    1 where k is not below the mean. Otherwise the terms shrink faster than a geometric
    row from ``k`` downwards; they are added over 12 standard deviations, and that row
    bounds the rest.
    """
    odds = (1 - alpha) / alpha
    term = F.exp(_log_choose(n.cast("double"), k.cast("double")) + k * F.log(F.lit(alpha)) + (n - k) * F.log(F.lit(1 - alpha)))
    ratio = lambda i: i * odds / (n - i + 1)
    reach = F.least(k, (F.ceil(12 * F.sqrt(n * alpha)) + 64).cast("long"))
    start = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("sum"))

    def add(acc: Column, m: Column) -> Column:
        return F.struct((acc["t"] * ratio(k - m)).alias("t"), (acc["sum"] + acc["t"]).alias("sum"))

    # After the last step t is the first term left out; it is 0 where all terms were added.
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), reach), start, add,
        lambda acc: acc["sum"] + acc["t"] / (1 - F.greatest(ratio(k - reach), F.lit(0.0))),
    )
    return F.when(k >= alpha * n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), term * total))


def certified_cutoffs(
    stats: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, alpha: float = 0.02, delta: float = 0.05
) -> DataFrame:
    """(stratum, rule, cutoff, good, good_rejected, bad, bad_rejected) of the cutoffs in force.

    ``rule`` is the place in ``rules``; a rule without a row is off in that stratum.
    ``stats`` has ``id``, ``stratum``, ``levels``: rows that the base rules keep;
    ``labels`` has ``id`` and ``good``. Every pair of a row and a label is a trial.
    """
    trials = stats.join(labels, "id").select(
        "stratum", F.posexplode("levels").alias("rule", "level"), F.col("good").cast("long").alias("good")
    )
    counted = trials.groupBy("stratum", "rule", "level").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")
    )
    counted = write_through(counted, "trials")
    strata = counted.select("stratum").distinct().count()
    # A group has one entry for each level, at most one more than the rule has cutoffs.
    grouped = counted.groupBy("stratum", "rule").agg(
        F.collect_list(F.struct("level", "good", "bad")).alias("held"), F.sum("good").alias("good"), F.sum("bad").alias("bad")
    )
    cutoffs = F.array(*[F.array(*[F.lit(c) for c in r.cutoffs]) for r in rules])

    def rejected(which: str, j: Column) -> Column:
        # The j-th cutoff from 0 rejects the rows that at least size - j cutoffs reject.
        by = F.filter("held", lambda x: x["level"] >= F.size("cutoffs") - j)
        return F.aggregate(by, F.lit(0).cast("long"), lambda acc, x: acc + x[which])

    tried = (
        grouped.withColumn("cutoffs", F.get(cutoffs, F.col("rule")))
        .select("*", F.posexplode("cutoffs").alias("j", "cutoff"))
        .select(
            "stratum", "rule", "j", "cutoff", "good", "bad",
            rejected("good", F.col("j")).alias("good_rejected"), rejected("bad", F.col("j")).alias("bad_rejected"),
        )
    )
    budget = delta / max(1, strata * len(rules))
    passes = at_most(F.col("good_rejected"), F.col("good"), alpha / len(rules)) <= budget
    benefit = F.col("bad_rejected").cast("double") * F.col("good") - F.col("good_rejected").cast("double") * F.col("bad")
    chosen = (
        tried.withColumn("passes", passes)
        .withColumn("benefit", benefit)
        .groupBy("stratum", "rule")
        .agg(
            F.min(F.when(~F.col("passes"), F.col("j"))).alias("fails"),
            F.sort_array(
                F.collect_list(
                    F.struct(
                        (-F.col("benefit")).alias("order"), "j", "cutoff", "good", "good_rejected", "bad", "bad_rejected"
                    )
                )
            ).alias("tried"),
        )
    )
    usable = F.filter("tried", lambda x: (x["order"] < 0) & (F.col("fails").isNull() | (x["j"] < F.col("fails"))))
    return chosen.select("stratum", "rule", F.get(usable, F.lit(0)).alias("best")).filter(F.col("best").isNotNull()).select(
        "stratum", "rule", "best.j", "best.cutoff", "best.good", "best.good_rejected", "best.bad", "best.bad_rejected"
    )


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    alpha: float = 0.02,
    delta: float = 0.05,
    stratum: str = "lang",
    label: str = "quality",
    text: str = "text",
    id: str = "doc_id",
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rules, kept) for every row.

    ``kept`` is false where the base rules fail: fewer than 20 words, or over 30 % of
    them in repeated windows. Otherwise it is false where a certified rule of the row's
    stratum rejects; ``failed_rules`` lists those. A stratum with too few labels to
    certify a cutoff keeps all that the base rules keep.

    Null texts count as empty, a null stratum as ''. Labels with a null id or value
    certify nothing, a label other than 0 is good. Repeated rows are judged alike, and
    each is a trial if labelled. An empty table gives no rows. Texts are read whole, one
    row in one task. Columns of other names are ignored.
    """
    stats = text_statistics(docs, text, id, stratum)
    stats = write_through(stats.withColumn("levels", F.array(*[strictness(r) for r in rules])), "rule-statistics")
    known = labels.select(F.col("doc_id").alias("id"), (F.col(f"`{label}`") != 0).alias("good")).dropna()
    cutoffs = certified_cutoffs(stats.filter(~base_failed()), known, rules, alpha, delta)
    need = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "j"))).alias("need"))
    # One short row for each stratum with enough labels. Written, so that its size is known before the join.
    need = write_through(need, "cutoffs")
    sizes = F.array(*[F.lit(len(r.cutoffs)) for r in rules])
    beyond = lambda i: F.get("levels", i) >= F.get(sizes, i) - F.try_element_at("need", i)
    failed = F.filter(F.sequence(F.lit(0), F.lit(len(rules) - 1)), lambda i: F.coalesce(beyond(i), F.lit(False)))
    return (
        stats.join(need, "stratum", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("failed_rules", F.when(F.col("need").isNull(), F.array().cast("array<int>")).otherwise(failed))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .select(
            F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "failed_rules", "kept",
        )
    )
