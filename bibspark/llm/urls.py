"""URL filter: host and path rules first, then the ratio of two character language models; built-in functions only.

Urls that a rule decides train a model of accepted and a model of rejected urls: Markov models of variable order
with every n-gram and context seen, where every order is smoothed by the one below. Other urls are judged by the difference of the two log likelihoods per character, against a threshold
calibrated on rule-decided urls that training left out.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .shared import Stages


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains, where the path begins with the rule's."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        return ((F.col("host") == self.host) | F.col("host").endswith("." + self.host)) & F.col("path").startswith(self.path)


RULES = [
    HostRule("com", "/", "allow"), HostRule("example.com", "/en/", "block"), HostRule("www.example.com", "/en/", "allow"),
    HostRule("net", "/es/", "block"), HostRule("net", "/fr/", "block"),
]
#: Longest context; share of all characters to be judged from which an n-gram's score is broadcast, so at most 100,000 are.
ORDER, FREQUENT = 4, 1e-5
#: Weight of the shorter context, in counts; characters assumed for the shortest.
SMOOTHING, ALPHABET = 4.0, 256
#: Every so many rule-decided urls one calibrates; width of the score bins of the threshold.
CALIBRATION, BIN = 5, 0.05


def parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lower-cased) and path; both empty without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_text(rules: list[HostRule]) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        out = F.when(rule.fits(), F.lit(rule.text)).otherwise(out)
    return out


def _characters(urls: DataFrame) -> DataFrame:
    """A row per character of ``^host path$``: ``g0`` .. ``g{ORDER}``, the character after that many before it."""
    text = F.concat(F.lit("^" * ORDER), F.col("host"), F.col("path"), F.lit("$"))
    rows = urls.withColumn("_text", text).withColumn("_i", F.explode(F.sequence(F.lit(ORDER + 1), F.char_length("_text"))))
    return rows.withColumns({f"g{k}": F.substring("_text", F.col("_i") - k, F.lit(k + 1)) for k in range(ORDER + 1)}).drop("_text", "_i")


def _models(train: DataFrame, stages: Stages) -> tuple[list[DataFrame], list[DataFrame]]:
    """For each order all n-grams (``g, a, b``: accepted, rejected counts) and all contexts (``x, na, nb``)."""
    top = stages.keep(train.groupBy(f"g{ORDER}").agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("b")), "top")
    grams, contexts = [], []
    for k in range(ORDER + 1):
        own = top.groupBy(F.substring(F.col(f"g{ORDER}"), ORDER + 1 - k, k + 1).alias("g")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        grams.append(stages.keep(own, f"grams-{k}"))
        held = grams[k].groupBy(F.substring("g", 1, k).alias("x")).agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
        contexts.append(stages.keep(held, f"contexts-{k}"))
    return grams, contexts


def _scores(urls: DataFrame, grams: list[DataFrame], contexts: list[DataFrame], stages: Stages) -> DataFrame:
    """``url, ratio``: the difference of the log likelihoods per character.

    A character's score depends on its longest n-gram only, so each distinct one is looked up once. The scores of
    frequent ones are broadcast, the others joined: none of those has more than a small share of the characters.
    """
    last = f"g{ORDER}"
    characters = _characters(urls.select("url", "host", "path")).select("url", last)
    rows = stages.keep(characters.groupBy(last).agg(F.count(F.lit(1)).alias("n")), "asked")
    total = rows.agg(F.sum("n")).first()[0] or 0
    accepted = rejected = F.lit(1.0 / ALPHABET)
    for k in range(ORDER + 1):
        own = grams[k].select(F.col("g").alias("_g"), F.col("a").alias("_a"), F.col("b").alias("_b"))
        held = contexts[k].select(F.col("x").alias("_x"), F.col("na").alias("_na"), F.col("nb").alias("_nb"))
        rows = rows.withColumn("_own", F.substring(last, ORDER + 1 - k, k + 1)).withColumn("_held", F.substring(last, ORDER + 1 - k, k))
        rows = rows.join(own, F.col("_own") == F.col("_g"), "left").join(held, F.col("_held") == F.col("_x"), "left")
        known = F.col("_x").isNotNull()
        # without the context the shorter one decides
        part = lambda c, n, lower: F.when(known, (F.coalesce(c, F.lit(0)) + SMOOTHING * lower) / (n + SMOOTHING)).otherwise(lower)
        rows = rows.select(last, "n", part(F.col("_a"), F.col("_na"), accepted).alias("_pa"), part(F.col("_b"), F.col("_nb"), rejected).alias("_pb"))
        accepted, rejected = F.col("_pa"), F.col("_pb")
    known = stages.keep(rows.select(last, "n", (F.log("_pa") - F.log("_pb")).alias("score")), "known")
    frequent = known.where(F.col("n") >= FREQUENT * total).select(last, "score")
    rare = known.where(F.col("n") < FREQUENT * total).select(last, F.col("score").alias("_rare"))
    scored = characters.join(F.broadcast(frequent), last, "left")
    joined = scored.where(F.col("score").isNull()).drop("score").join(rare, last).select("url", F.col("_rare").alias("score"))
    both = scored.where(F.col("score").isNotNull()).select("url", "score").union(joined)
    return both.groupBy("url").agg((F.sum("score") / F.count(F.lit(1))).alias("ratio"))


def _threshold(scored: DataFrame) -> float:
    """The score that best parts accepted from rejected calibration urls; 0 without both kinds."""
    bins = scored.groupBy(F.greatest(F.lit(-200), F.least(F.lit(200), F.floor(F.col("ratio") / BIN))).alias("bin"))
    rows = bins.agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("b")).collect()  # at most 401 rows
    a, b = sum(r.a for r in rows), sum(r.b for r in rows)
    if not a or not b:
        return 0.0
    cost = lambda t: sum(r.a for r in rows if r.bin < t) / a + sum(r.b for r in rows if r.bin >= t) / b
    tried = range(min(r.bin for r in rows), max(r.bin for r in rows) + 2)
    best = min(map(cost, tried))
    return BIN * min((t for t in tried if cost(t) <= best + 1e-12), key=abs)


def judge_urls(pages: DataFrame, rules: list[HostRule] | None = None) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, ratio``.

    ``verdict`` is the rule's, else "allow" if the likelihood ratio reaches the calibrated threshold, else
    "block". A null url, or one without ``://``, has neither host nor path: it is judged by the end mark alone, and
    a url without a host by its path. Equal urls are judged once;
    repeated rows give repeated rows; extra columns are ignored; an empty table gives no rows.
    """
    rules = RULES if rules is None else rules
    stages = Stages(pages.sparkSession)
    host, path = parts(F.col("url"))
    urls = pages.select(F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url")).distinct()
    urls = urls.select("url", host.alias("host"), path.alias("path")).withColumn("rule", rule_text(rules))
    said = F.lit(None).cast("string")
    for rule in rules:
        said = F.when(F.col("rule") == rule.text, F.lit(rule.verdict)).otherwise(said)
    urls = stages.keep(urls.withColumn("said", said), "urls")
    decided = urls.where(F.col("said").isNotNull()).withColumn("accepted", F.col("said") == "allow")
    calibrates = F.crc32(F.col("url").cast("binary")) % CALIBRATION == 0
    grams, contexts = _models(_characters(decided.where(~calibrates)), stages)
    open_urls = urls.where(F.col("said").isNull())
    scored = stages.keep(_scores(open_urls.union(urls.where(F.col("said").isNotNull() & calibrates)), grams, contexts, stages), "scored")
    limit = _threshold(scored.join(decided.select("url", "accepted"), "url"))
    judged = urls.join(scored, "url", "left")
    verdict = F.coalesce("said", F.when(F.col("ratio") >= limit, "allow").otherwise("block"))
    judged = judged.select("url", "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("said").isNull(), F.col("ratio")).alias("ratio"))
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    return rows.join(judged, "url").drop("url")
