"""URL verdicts: host and path rules first, then the ratio of two character models of accepted and rejected URLs.

The models are variable-order Markov chains (orders 0 to 2) over a folded alphabet, smoothed by Witten-Bell back-off, and
learned from the URLs that the rules decide, without the domain that rules are written on. The alphabet bounds the models: one array with a log-ratio per trigram
of symbols, whatever the number of URLs. All work is column expressions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.words import ascii_lower

ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_:?&=%#^$"  # digits fold to 0; ^ and $ are the ends; 0 stands for all else
SYMBOLS = len(ALPHABET) + 1
KEEP_SHARE = 0.99
CALIBRATE_FOLD, FOLDS = 0, 5


class Rule(NamedTuple):
    """A host with its subdomains and the start of the path; ``allow`` or ``block``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        """The rule as it is shown."""
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct of text and verdict; null if none does. The first listed wins a tie."""
    found = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r.text)):
        same = [r for r in rules if len(r.text) == len(rule.text)]
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        for earlier in same[:same.index(rule)]:
            fits &= ~(((host == earlier.host) | host.endswith("." + earlier.host)) & path.startswith(earlier.path))
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _codes(url: Column) -> Column:
    folded = F.translate(F.lower(_rest(url)), "123456789^$", "000000000~~")
    text = F.concat(F.lit("^^"), folded, F.lit("$"))
    return F.transform(F.filter(F.split(text, ""), lambda c: F.length(c) > 0), lambda c: F.position(c, F.lit(ALPHABET)))


def trigrams_of(url: Column) -> Column:
    """Numbers of the symbol trigrams of the part after ``://``, with two start signs and one end sign."""
    k = SYMBOLS
    return F.transform(F.array(_codes(url)), lambda c: F.transform(
        F.sequence(F.lit(2), F.size(c) - 1), lambda i: (F.get(c, i - 2) * k + F.get(c, i - 1)) * k + F.get(c, i)))[0]


def _seen_by_models(url: Column, host: Column) -> Column:
    """A URL without the last two labels of its host: rules are written on domains, so these would only repeat them."""
    return F.concat(F.lit("://"), F.regexp_replace(host, r"[^.]*\.?[^.]*$", ""), F.substr(_rest(url), F.length(host) + 1))


def log_ratios(counts: DataFrame) -> DataFrame:
    """One row with the array of log P(symbol | two before) of rejected minus accepted URLs, for all trigrams.

    ``counts``: trigram, n_block, n_allow. Each order is blended with the next lower one by the number of different
    symbols seen after the context; the lowest counts each symbol once more than it was seen.
    """
    k = SYMBOLS
    grid = (counts.sparkSession.range(k ** 3).withColumnRenamed("id", "trigram").join(counts, "trigram", "left")
            .select("trigram", (F.col("trigram") / (k * k)).cast("int").alias("a"),
                    ((F.col("trigram") / k) % k).cast("int").alias("b"), (F.col("trigram") % k).cast("int").alias("c"),
                    *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_block", "n_allow")]))
    for n in ("n_block", "n_allow"):
        over = lambda *keys, col: F.sum(col).over(Window.partitionBy(*keys))
        grid = (grid.withColumn("bc", over("b", "c", col=F.col(n))).withColumn("ab", over("a", "b", col=F.col(n)))
                .withColumn("ab_kinds", over("a", "b", col=(F.col(n) > 0).cast("long"))))
        grid = (grid.withColumn("b_all", over("b", col=F.col(n)))
                .withColumn("b_kinds", over("b", col=((F.col("bc") > 0) & (F.col("a") == 0)).cast("long")))
                .withColumn("c_all", over("c", col=F.col(n))).withColumn("all", over(F.lit(1), col=F.col(n))))
        p0 = (F.col("c_all") + 1) / (F.col("all") + k)
        p1 = F.when(F.col("b_all") > 0, (F.col("bc") + F.col("b_kinds") * p0) / (F.col("b_all") + F.col("b_kinds"))).otherwise(p0)
        p2 = F.when(F.col("ab") > 0, (F.col(n) + F.col("ab_kinds") * p1) / (F.col("ab") + F.col("ab_kinds"))).otherwise(p1)
        grid = grid.withColumn(f"log_{n}", F.log(p2))
    return (grid.select("trigram", (F.col("log_n_block") - F.col("log_n_allow")).alias("d"))
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("trigram", "d"))), lambda x: x["d"]).alias("ratios")))


def judge(pages: DataFrame, rules: list[Rule], *, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Verdict per row: page_id, host, path, rule (or null), verdict, and the model's score (rejected over accepted).

    A rule's verdict holds. Other URLs are blocked if their mean log-ratio per symbol is above the value that
    ``KEEP_SHARE`` of the accepted URLs of the calibration fold stay below; without accepted or rejected URLs to learn from
    they are allowed. Null URLs and URLs without ``://`` have an empty host and path and score as the empty text.
    Repeated rows are judged alike; other columns are left out.
    """
    rows = (pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
            .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
            .withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)))
    fold = F.coalesce(F.pmod(F.crc32(F.col("page_id").cast("string").cast("binary")), F.lit(FOLDS)), F.lit(1))
    decided = (rows.where("fit is not null")
               .select(F.col("fit.verdict").alias("verdict"), fold.alias("fold"),
                       trigrams_of(_seen_by_models(F.col("url"), F.col("host"))).alias("trigrams")))
    counts = (decided.where(F.col("fold") != CALIBRATE_FOLD).select("verdict", F.explode("trigrams").alias("trigram"))
              .groupBy("trigram").agg(F.count_if(F.col("verdict") == "block").alias("n_block"),
                                      F.count_if(F.col("verdict") == "allow").alias("n_allow")))
    # SYMBOLS ** 3 numbers, whatever the input; as text they fold into one constant of the plan
    numbers = ",".join(f"{x:.4f}" for x in log_ratios(counts).first()["ratios"])
    ratios = F.split(F.lit(numbers), ",").cast("array<double>")

    def score(trigrams: Column) -> Column:
        return F.aggregate(trigrams, F.lit(0.0), lambda s, g: s + F.get(ratios, g)) / F.size(trigrams)

    cut = (decided.where((F.col("fold") == CALIBRATE_FOLD) | (F.col("verdict") == "block"))
           .agg(F.percentile_approx(F.when((F.col("verdict") == "allow") & (F.col("fold") == CALIBRATE_FOLD),
                                           score(F.col("trigrams"))), KEEP_SHARE, 10_000).alias("cut"),
                F.count_if(F.col("verdict") == "block").alias("blocked")).first())
    scored = rows.withColumn("score", score(trigrams_of(_seen_by_models(F.col("url"), F.col("host")))))
    by_model = (F.when(F.col("score") > cut["cut"], "block").otherwise("allow")
                if cut["cut"] is not None and cut["blocked"] else F.lit("allow"))
    return scored.select("page_id", "host", "path", F.col("fit.text").alias("rule"),
                         F.coalesce("fit.verdict", by_model).alias("verdict"), "score")
