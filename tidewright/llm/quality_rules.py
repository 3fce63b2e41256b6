"""Quality rules: text statistics per document, failure rates per host, verdicts back to the documents.

Only DataFrame functions. A document fails by itself if it has too few words or too many of its words stand in
windows of words that repeat. Failures are summed by host (a partial sum per task, so a host with a third of
all rows is a few partial rows), each host's rate is shrunk towards the corpus by a beta prior fitted to all
hosts, and hosts whose shrunk rate is too high take their other documents with them.

Defined results: a null text counts as empty; empty texts have no words and fail; a document whose host is null
is judged by itself; repeated rows count once each; an empty table gives an empty result; extra columns are
ignored by `text_statistics` and kept by `keep_good`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import BLANK, BLANKS, NON_BLANK, Scratch, free_names

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: A host is rejected if its shrunk failure rate is above this.
MOST_HOST_RATE = 0.5
#: The prior weighs as much as this many documents at least and at most.
LEAST_PRIOR, MOST_PRIOR = 2.0, 1e6
#: Up to this many rejected hosts are broadcast; more are joined by a shuffle.
MOST_BROADCAST_HOSTS = 50_000

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body) -> Column:
    """body(value) with value computed once per row, also where body uses it inside of a lambda."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK + "+"), "")


def _repeated_words(words: Column, window: int) -> Column:
    """Words inside of windows that occur twice or more.

    Windows are compared by a hash first: distinct hashes prove distinct windows, which settles most texts.
    The others sort their windows as strings, so the count is exact.
    """

    def exact(w: Column) -> Column:
        windows = F.sort_array(
            F.transform(
                F.sequence(F.lit(1), F.size(w) - (window - 1)),
                lambda i: F.struct(F.array_join(F.slice(w, i, window), " ").alias("t"), i.alias("p")),
            )
        )

        def covered(s: Column) -> Column:
            n = F.size(s)
            twice = F.filter(
                F.transform(
                    s,
                    lambda x, j: F.when(
                        ((j > 0) & (F.get(s, j - 1)["t"] == x["t"])) | ((j < n - 1) & (F.get(s, j + 1)["t"] == x["t"])), x["p"]
                    ),
                ),
                lambda p: p.isNotNull(),
            )
            start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
            step = lambda a, p: F.struct(
                (p + window).alias("end"), (a["n"] + p + window - F.greatest(a["end"], p)).alias("n")
            )
            return F.aggregate(F.sort_array(twice), start, step)["n"]

        return _let(windows, covered)

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))
        repeats = _let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(F.size(w) < window, 0).when(repeats, exact(w)).otherwise(0)

    return count(words).cast("long")


def text_statistics(df: DataFrame, text: str = "text", window: int = WINDOW) -> list[Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text column, as longs."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(NON_BLANK)))
    return [
        _let(words_of(t), lambda w: F.struct(F.size(w).cast("long").alias("a"), _repeated_words(w, window).alias("b"))).alias("w"),
        F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ]


def base_failed(n_words: Column, n_repeat_words: Column, least: int = LEAST_WORDS, percent: int = MOST_REPEATED_PERCENT) -> Column:
    return (n_words < least) | (100 * n_repeat_words > percent * n_words)


def host_of(source: Column) -> Column:
    """The host of an address, or the source itself where it is a plain name."""
    host = F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    return F.lower(F.when(host != "", host).otherwise(source))


def _prior_weight(mean: float, spread: float, docs: int, hosts: int) -> float:
    """Documents that the prior counts for.

    `spread` is the mean squared distance of the hosts' rates from the corpus rate, each as often as the host has documents.
    A host of n documents is off by chance by mean * (1 - mean) / n, on that average mean * (1 - mean) * hosts / docs; the
    rest is the variance between hosts, which a beta prior has at mean * (1 - mean) / variance - 1 documents.
    """
    chance = hosts / docs
    if chance >= 1:
        return MOST_PRIOR
    between = (spread - mean * (1 - mean) * chance) / (1 - chance)
    return max(LEAST_PRIOR, min(MOST_PRIOR, mean * (1 - mean) / between - 1)) if between > 1e-12 else MOST_PRIOR


def host_rates(rows: DataFrame, host: str = "host", rules: tuple[str, ...] = ("base_failed",)) -> DataFrame:
    """host, n_docs, and for each rule (a boolean column) its failures n_<rule> and rate_<rule>: shrunk by a beta prior that is
    fitted to the rates of all hosts, with the corpus rate as its mean."""
    failures = [F.sum(F.col(rule).cast("long")).alias(f"n_{rule}") for rule in rules]
    hosts = rows.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n_docs"), *failures)
    hosts = Scratch(rows.sparkSession, "hosts").cut(hosts)
    # A few numbers, whatever the input.
    squares = [F.sum(F.col(f"n_{rule}") * F.col(f"n_{rule}") / F.col("n_docs")).alias(f"s_{rule}") for rule in rules]
    sums = [F.sum(f"n_{rule}").alias(f"n_{rule}") for rule in rules]
    total = hosts.agg(F.sum("n_docs").alias("docs"), F.count("*").alias("hosts"), *sums, *squares).first()
    rates = []
    for rule in rules:
        if not total["hosts"]:
            rates.append(F.lit(0.0).alias(f"rate_{rule}"))
            continue
        mean = total[f"n_{rule}"] / total["docs"]
        # The sum of n * (x - mean)^2 over hosts of n documents and rate x.
        spread = total[f"s_{rule}"] / total["docs"] - mean * mean
        weight = _prior_weight(mean, spread, total["docs"], total["hosts"])
        rates.append(((F.col(f"n_{rule}") + mean * weight) / (F.col("n_docs") + weight)).alias(f"rate_{rule}"))
    return hosts.select("*", *rates)


def judge(docs: DataFrame, keep: list[str], text: str = "text", source: str = "source") -> tuple[DataFrame, str]:
    """The columns `keep` of every row, its statistics, host, base_failed, host_failed and kept, as a struct
    column whose name is returned too. The texts are read once."""
    spark = docs.sparkSession
    (out,) = free_names(docs, "rules")
    scratch = Scratch(spark, "quality-rules")
    statistics = text_statistics(docs, text)
    ruled = docs.select(*[F.col(f"`{c}`") for c in keep], F.struct(*statistics, host_of(F.col(source)).alias("host")).alias(out))
    r = F.col(out)
    ruled = ruled.withColumn(
        out,
        F.struct(
            r["w"]["a"].alias("n_words"),
            r["word_chars"].alias("word_chars"),
            r["n_symbols"].alias("n_symbols"),
            r["n_dup_lines"].alias("n_dup_lines"),
            r["w"]["b"].alias("n_repeat_words"),
            r["host"].alias("host"),
        ),
    )
    ruled = scratch.cut(ruled.withColumn(out, r.withField("base_failed", base_failed(r["n_words"], r["n_repeat_words"]))))
    failed = {"short": r["n_words"] < LEAST_WORDS, "repeats": 100 * r["n_repeat_words"] > MOST_REPEATED_PERCENT * r["n_words"], "any": r["base_failed"]}
    rates = host_rates(ruled.select(r["host"].alias("host"), *[rule.alias(name) for name, rule in failed.items()]), rules=tuple(failed))
    bad = rates.filter(F.greatest(*[F.col(f"rate_{name}") for name in failed]) > MOST_HOST_RATE).select(F.col("host").alias(f"{out}_host"), F.lit(True).alias(f"{out}_bad"))
    if bad.limit(MOST_BROADCAST_HOSTS + 1).count() <= MOST_BROADCAST_HOSTS:
        bad = F.broadcast(bad)
    joined = ruled.join(bad, r["host"] == F.col(f"{out}_host"), "left")
    host_failed = F.coalesce(F.col(f"{out}_bad"), F.lit(False))
    verdict = r.withField("host_failed", host_failed).withField("kept", ~r["base_failed"] & ~host_failed)
    return joined.select(*[F.col(f"`{c}`") for c in keep], verdict.alias(out)), out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: id, the statistics, base_failed, kept, host, host_failed."""
    judged, out = judge(docs, [id_col], text, source)
    r = F.col(out)
    return judged.select(
        id_col, *[r[c].alias(c) for c in [*STATISTICS, "base_failed", "kept", "host", "host_failed"]]
    )


def keep_good(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The rows that pass, with all their columns."""
    judged, out = judge(docs, docs.columns, text, source)
    return judged.filter(F.col(out)["kept"]).drop(out)
