"""Quality rules as weak supervision: rules vote or abstain, their accuracies come from expectation-maximisation."""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm.registry import query, table
from kerbflow.session import store

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WORDS = 8
ROUNDS = 20
THRESHOLD = 0.5
#: What is expected of a rule on good and on bad texts, as so many texts seen before: votes bad and none of a rule that
#: looks for one fault, votes bad and good of any other; and how many texts are good and bad.
FAULT_ON_GOOD, FAULT_ON_BAD = (2.0, 98.0), (30.0, 70.0)
VOTE_ON_GOOD, VOTE_ON_BAD = (3.0, 97.0), (40.0, 60.0)
GOOD, BAD = 8.0, 2.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _covered(starts: Column) -> Column:
    """Words that windows of REPEAT_WORDS words at these starts, in rising order, cover."""
    return F.aggregate(starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), lambda s, at: F.struct(
        (s.n + F.least(F.lit(REPEAT_WORDS), at + REPEAT_WORDS - s.end)).alias("n"), (at + REPEAT_WORDS).alias("end")), lambda s: s.n)


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that stand twice or more in the list.

    Hashes of the windows tell whether any repeats; only then are the windows themselves sorted and compared.
    """
    k = REPEAT_WORDS

    def joined(h: Column, step: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - step), lambda i: F.xxhash64(F.element_at(h, i), F.element_at(h, i + step)))

    def exact(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.struct(
            F.array_join(F.slice(w, i, k), " ").alias("text"), (i - 1).alias("at")))
        return let(F.array_sort(windows), lambda s: _covered(F.array_sort(F.transform(F.filter(s, lambda x, i: (
            ((i > 0) & (F.get(s, i - 1).text == x.text)) | ((i < F.size(s) - 1) & (F.get(s, i + 1).text == x.text)))), lambda x: x.at))))

    def by_hash(w: Column) -> Column:
        ones = F.transform(w, lambda x: F.xxhash64(x))
        return let(let(let(let(ones, lambda h: joined(h, 1)), lambda h: joined(h, 2)), lambda h: joined(h, 4)),
                   lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(exact(w)))

    return let(words, lambda w: F.when(F.size(w) <= k, F.lit(0).cast("long")).otherwise(by_hash(w)))


def measures(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The `keep` columns and the numbers that the rules look at, without a shuffle. A null text has no words."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    without = lambda what: F.length(F.translate(F.col("_t"), what, ""))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    base = docs.select(*keep, t.alias("_t")).select(
        *keep,
        F.size(words_of(F.col("_t"))).cast("long").alias("n_words"),
        without(SPACE).cast("long").alias("word_chars"),
        (F.length("_t") - without(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again"))).alias("_lines"),
        repeated_words(words_of(F.col("_t"))).alias("n_repeat_words"),
        (F.length("_t") - without("!")).cast("long").alias("n_shouts"),
        (F.length("_t") - without(".?")).cast("long").alias("n_stops"),
        (F.length("_t") - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_capitals"),
        F.size(F.array_distinct(words_of(F.col("_t")))).cast("long").alias("n_distinct"),
        F.size(F.filter(words_of(F.col("_t")), lambda w: F.translate(w, SYMBOLS, "") != w)).cast("long").alias("n_symbol_words"))
    return base.select(*keep, "n_words", "word_chars", "n_symbols", F.col("_lines.again").alias("n_dup_lines"), "n_repeat_words",
                       F.col("_lines.n").alias("n_lines"), "n_shouts", "n_stops", "n_capitals", "n_distinct",
                       "n_symbol_words")


#: Rules that look for one fault and never vote good.
FAULTS = {"symbols", "symbol_words", "symbol_chars", "lines", "repeats", "capitals", "shouts"}


def _vote(good: Column | None, bad: Column) -> Column:
    vote = F.when(bad, -1)
    return (vote if good is None else vote.when(good, 1)).otherwise(0)


def votes() -> dict[str, Column]:
    """What each rule says of the measures: 1 good, -1 bad, 0 nothing. A rule that looks for one fault never votes good."""
    c, n = F.col, F.col("n_words")
    return {
        "symbols": _vote(None, 10 * c("n_symbols") > n),
        "symbol_words": _vote(None, 10 * c("n_symbol_words") > n),
        "symbol_chars": _vote(None, 30 * c("n_symbols") > c("word_chars")),
        "lines": _vote(None, 10 * c("n_dup_lines") > 3 * c("n_lines")),
        "repeats": _vote(None, 5 * c("n_repeat_words") > n),
        "capitals": _vote(None, 10 * c("n_capitals") > 3 * c("word_chars")),
        "shouts": _vote(None, 5 * c("n_shouts") > n),
        "word_length": _vote(c("word_chars").between(3 * n, 10 * n), (c("word_chars") < 2 * n) | (c("word_chars") > 14 * n)),
        "variety": _vote((n >= 40) & (F.log(c("n_distinct")) > 0.8 * F.log(n)), (n >= 40) & (F.log(c("n_distinct")) < 0.7 * F.log(n))),
        "stops": _vote((n >= 40) & (100 * c("n_stops") >= n) & (3 * c("n_stops") <= n), (n >= 40) & (200 * c("n_stops") < n)),
        "length": _vote(n >= 50, n < 25),
    }


def log_odds(model: dict, names: list[str]) -> Column:
    """Logarithm of the posterior odds that a text is good, from its votes in columns v_<rule>.

    Not to find a fault is evidence too; any other rule that abstains, as most do on short texts, says nothing.
    """
    out = F.lit(log(model["good"] / (1 - model["good"])))
    for name in names:
        bad, other = (log(g / b) for g, b in zip(*model[name]))
        vote = F.col(f"v_{name}")
        out = out + F.when(vote == -1, bad).when(F.lit(True) if name in FAULTS else vote == 1, other).otherwise(0.0)
    return out


def posterior(model: dict, names: list[str]) -> Column:
    return 1 / (1 + F.exp(-log_odds(model, names)))


def fit_rules(voted: DataFrame, names: list[str], rounds: int = ROUNDS) -> dict:
    """How each rule votes on good and on bad texts, and the share of good ones, by expectation-maximisation.

    Texts with the same votes count together, so every round works on at most 3 ** rules rows and gives one row of sums.
    """
    patterns = store(voted.groupBy(*(f"v_{n}" for n in names)).agg(F.count("*").cast("double").alias("n")), "vote-patterns").coalesce(1)
    share = lambda counts: tuple(c / sum(counts) for c in counts)
    before = {n: (FAULT_ON_GOOD, FAULT_ON_BAD) if n in FAULTS else (VOTE_ON_GOOD, VOTE_ON_BAD) for n in names}
    model = {"good": GOOD / (GOOD + BAD), **{n: tuple(map(share, before[n])) for n in names}}
    for _ in range(rounds):
        p = patterns.withColumn("g", F.col("n") * posterior(model, names)).withColumn("b", F.col("n") - F.col("g"))
        s = p.agg(F.sum("g").alias("g"), F.sum("b").alias("b"), *(
            F.sum(F.when(F.col(f"v_{n}") == v, F.col(k))).alias(f"{k}{v}_{n}") for n in names for k in "gb" for v in (-1, 0, 1))).first()
        seen = lambda n, k, old: share([(s[f"{k}{v}_{n}"] or 0.0) + x for v, x in zip((-1, 0 if n in FAULTS else 1), old)])
        model = {"good": ((s.g or 0.0) + GOOD) / ((s.g or 0.0) + (s.b or 0.0) + GOOD + BAD),
                 **{n: (seen(n, "g", before[n][0]), seen(n, "b", before[n][1])) for n in names}}
    return model


def judge_quality(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The `keep` columns, the measures, base_failed, the posterior probability of good quality, and kept.

    Built of SQL functions only. The measures are taken once and stored; the rules' accuracies come from all rows. Null
    and empty texts have no words and fail the base rule; repeated rows are judged alike; ids are only carried along.
    """
    rules = votes()
    names = list(rules)
    voted = store(measures(docs, keep, text).withColumns({f"v_{n}": v for n, v in rules.items()}), "measures")
    model = fit_rules(voted, names)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return voted.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                        posterior(model, names).alias("p_good")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= THRESHOLD))


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), ["doc_id"]).drop("p_good")
