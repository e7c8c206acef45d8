"""Quality rules judged per document and per host.

Each document is tested against four rules. Failures are added up per host, each rule's failure rate is shrunk by a
beta prior fitted to all hosts (method of moments), and a host whose shrunken rate of any rule passes ``max_rate`` is
rejected with all its documents. A host of few documents stays near the common rate, so a handful of failures does not
condemn it.

Defined results: a null text has no words and fails; a null host has no verdict, its documents stand on their own;
an empty table gives no rows; input columns named like an added one are replaced. Very long texts are read whole, and
nothing is compared in pairs: repeated word windows are found by sorting them inside the row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACES, WORD, text_of, without, words_of
from tidewatch.session import materialise

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
VERDICTS = ("base_failed", "host_rejected", "kept")
SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: Bounds of a prior's strength, in documents: r = 1 and r = 0 would give none and infinitely many.
WEAKEST, STRONGEST = 1.0, 1e6


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_window_words(words: Column, n: Column, width: int = WINDOW) -> Column:
    """Words standing in a window of ``width`` words that occurs twice or more in the list, first occurrence included.

    Windows are sorted with their places; a place counts if a neighbour holds the same window. Places in order cover
    ``width`` words each, less what the next one covers again.
    """
    window = lambda i: F.struct(F.concat_ws(" ", *[F.get(words, i + k) for k in range(width)]).alias("w"), i.alias("i"))

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["w"] == x["w"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        reach = F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    found = _let(F.sort_array(F.transform(F.sequence(F.lit(0), n - width), window)), repeated)
    return F.when(n >= width, _let(found, covered)).otherwise(F.lit(0)).cast("long")


def document_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts the rules read."""
    base = without(docs, *COUNTS, "__text", "__words", "__solid", "__lines").withColumn("__text", text_of(docs))
    split = base.withColumns({
        "__words": words_of(F.col("__text")),
        "__solid": F.translate("__text", SPACES, ""),
        "__lines": F.filter(F.split("__text", "\n"), lambda line: line.rlike(WORD)),
    })
    return split.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length("__solid").cast("long"),
        "n_symbols": (F.length("__solid") - F.length(F.translate("__solid", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": repeated_window_words(F.col("__words"), F.size("__words")),
        "n_lines": F.size("__lines").cast("long"),
    }).drop("__text", "__words", "__solid", "__lines")


def rules() -> dict[str, Column]:
    """A document's rule failures, from its counts."""
    return {
        "short": F.col("n_words") < 50,
        "repetitive": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > 20 * F.col("word_chars"),
        "lines": 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"),
    }


def host_verdicts(counted: DataFrame, host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """(host, ``rate_<rule>``..., ``host_rejected``): one row per host; documents are only ever added up.

    Per rule, with N documents of H hosts and a common rate m, the hosts' rates vary by ``v`` (weighted); of that
    ``m(1-m)H/N`` is chance. The rest gives the intra-host correlation r and the prior's strength (1-r)/r, in documents:
    at least ``WEAKEST`` (hosts that agree with themselves alone) and at most ``STRONGEST`` (hosts that do not differ).
    """
    names = list(rules())
    hosts = counted.where(F.col(host).isNotNull()).groupBy(host).agg(F.count("*").alias("__n"), *[F.sum(c.cast("long")).alias(f"__f_{r}") for r, c in rules().items()])
    hosts = materialise(hosts, "host-failures")
    prior = _priors(hosts, names)
    rate = {r: (F.col(f"__f_{r}") + prior[f"strength_{r}"] * prior[f"mean_{r}"]) / (F.col("__n") + prior[f"strength_{r}"]) for r in names}
    judged = hosts.select(F.col(host), *[c.alias(f"rate_{r}") for r, c in rate.items()])
    bad = F.greatest(*[F.col(f"rate_{r}") for r in names]) > max_rate
    return judged.withColumn("host_rejected", bad)


def _priors(hosts: DataFrame, names: list[str]) -> dict[str, Column]:
    """Mean and strength of each rule's prior, fitted to all hosts; the one row comes back as constants."""
    fit = hosts.agg(
        F.count("*").alias("__h"), F.sum("__n").alias("__all"),
        *[F.sum(f"__f_{r}").alias(f"__fail_{r}") for r in names],
        *[F.sum(F.col(f"__f_{r}") * F.col(f"__f_{r}") / F.col("__n")).alias(f"__sq_{r}") for r in names],
    )
    found = {}
    for r in names:
        mean = F.col(f"__fail_{r}") / F.col("__all")
        chance = mean * (1 - mean)
        spread = F.col(f"__sq_{r}") / F.col("__all") - mean * mean
        by_luck = F.col("__h") / F.col("__all")
        between = F.when((chance > 0) & (by_luck < 1), (spread - chance * by_luck) / (chance * (1 - by_luck))).otherwise(0.0)
        found[f"mean_{r}"] = mean
        found[f"strength_{r}"] = F.least(F.lit(STRONGEST), F.greatest(F.lit(WEAKEST), (1 - between) / F.greatest(between, F.lit(1e-9))))
    row = fit.select(*[c.alias(name) for name, c in found.items()]).first()
    return {name: F.lit(row[name]).cast("double") for name in found}


def apply_rules(docs: DataFrame, host: str = "source", max_rate: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the counts, ``base_failed``, ``host_rejected`` and ``kept``.

    Counts are worked out once and written; host verdicts are written too, so Spark knows their size when it chooses
    how to join them back.
    """
    counted = document_counts(without(docs, *VERDICTS))
    counted = materialise(counted.select(*keep, *COUNTS) if keep else counted, "host-counts")
    bad = materialise(host_verdicts(counted, host, max_rate).where("host_rejected").select(F.col(host).alias("__bad")), "host-verdicts")
    rule = rules()
    judged = counted.join(bad, counted[host] == bad["__bad"], "left").withColumn("host_rejected", F.col("__bad").isNotNull()).drop("__bad")
    return judged.withColumn("base_failed", rule["short"] | rule["repetitive"]).withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
