"""Quality rules as a bitmask ledger, with built-in functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per rule;
policies are masks over the bits, each a version that can be applied, changed or compared without reading the
texts again. Ablations come from counts per bit pattern.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .shared import Stages, packed, unpacked

_SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` holds over the measurements; the bit is the rule's place in ``RULES`` and never changes."""

    name: str
    fails: str


#: The order gives the bits; new rules go to the end.
RULES = [
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("upper_case", "2 * n_upper > word_chars"),
    Rule("few_letters", "2 * n_letters < word_chars"),
]
#: Versions of the policy: the rules that reject.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols", "duplicate_lines"],
    "v2": [r.name for r in RULES],
}
CURRENT = "v2"


def mask(policy: str | list[str]) -> int:
    """The bits of a policy, given by name or as a list of rules."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    bits = {r.name: 1 << i for i, r in enumerate(RULES)}
    return sum(bits[n] for n in set(names))


def _count(pattern: str) -> Column:
    """Characters of the text left when all that match ``pattern`` are gone."""
    return F.char_length(F.regexp_replace("_text", pattern, "")).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements to ``docs``: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_upper, n_letters`` (long). A null text is empty: all zero.

    Words in windows of eight that stand twice or more are found inside the row: windows are hashed, and only
    a text with equal hashes sorts them. Each array is a column of its own, so it is made once per row.
    """
    empty = F.array().cast("array<long>")
    spots = F.array().cast("array<struct<h:bigint,i:int>>")
    out = docs.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    out = out.withColumn("_words", F.filter(F.split("_text", _SPACE), lambda w: w != ""))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumns({"_lines": lines, "_hashes": F.transform("_words", lambda w: F.xxhash64(w)), "n_words": F.size("_words").cast("long")})
    windows = F.transform(F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col("_hashes"), i, WINDOW)))
    out = out.withColumn("_windows", F.when(F.size("_hashes") >= WINDOW, windows).otherwise(empty))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("_sorted", F.when(repeats, placed).otherwise(spots))
    rest = lambda a: F.slice(F.col(a), 2, F.greatest(F.size(a), F.lit(1)))
    out = out.withColumn("_same", F.zip_with("_sorted", rest("_sorted"), lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))))
    either = F.zip_with(F.concat(F.array(F.lit(False)), F.col("_same")), F.col("_same"), lambda p, q: p | F.coalesce(q, F.lit(False)))
    found = F.filter(F.zip_with("_sorted", either, lambda x, f: F.when(f, x["i"])), lambda i: i.isNotNull())
    out = out.withColumn("_at", F.sort_array(found))
    steps = F.zip_with("_at", rest("_at"), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return out.withColumns(
        {
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": _count(r"[^#*$%&|<>]+"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.aggregate(steps, F.lit(0).cast("long"), lambda n, s: n + s),
            "n_lines": F.size("_lines").cast("long"),
            "n_upper": _count(r"\P{Lu}+"),
            "n_letters": _count(r"\P{L}+"),
        }
    ).drop("_text", "_words", "_lines", "_hashes", "_windows", "_sorted", "_same", "_at")


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements and ``fail_bits``: each rule evaluated once."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs).withColumn("fail_bits", total)


def passes(policy: str | list[str] = CURRENT) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policies: dict[str, list[str]] | None = None) -> DataFrame:
    """``policy, rule, n_failed, n_only``: documents that fail a rule of a policy, and those that only it rejects.

    The ledger is first counted by bit pattern (at most ``2 ** len(RULES)`` rows); all policies read the counts.
    """
    counts = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    each = [
        F.struct(F.lit(p).alias("policy"), F.lit(r.name).alias("rule"), F.lit(mask(names)).alias("all_bits"), F.lit(mask([r.name])).alias("bit"))
        for p, names in (policies or POLICIES).items() for r in RULES if r.name in names
    ]
    rows = counts.select("fail_bits", "n", F.inline(F.array(*each)))
    hit = F.col("fail_bits").bitwiseAND(F.col("all_bits"))
    return rows.groupBy("policy", "rule").agg(
        F.sum(F.when(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )


def verdicts(rows: DataFrame, policies: list[str] | None = None) -> DataFrame:
    """A ledger's ``doc_id`` and the verdict of each policy: all versions from the same stored bits."""
    return rows.select("doc_id", *[passes(p).alias(p) for p in policies or POLICIES])


def stored_ledger(docs: DataFrame, stages: Stages) -> DataFrame:
    """The ledger of ``doc_id, text``, written once: ``doc_id``, the measurements and ``fail_bits``."""
    return stages.keep(ledger(docs.select("doc_id", "text")).drop("text"), "ledger")


def quality_report(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """One row per document: ``doc_id, n_words``, the four base measurements, ``base_failed``, ``kept``, ``fail_bits``.

    ``kept`` is false if a base rule fails, else the verdict of ``policy``. Null and empty texts have no words and
    fail; repeated rows give repeated rows; extra columns are ignored; an empty table gives no rows.
    """
    rows = ledger(docs.select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), (passes("base") & passes(policy)).alias("kept"), "fail_bits",
    )


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that pass, with their columns as they are (one may have the name of a measurement)."""
    rows = ledger(docs.select(packed(docs), "text"))
    # a column that differs by row keeps the optimizer from copying all measurements into the filter
    rows = rows.select("_row", "fail_bits", F.monotonically_increasing_id().alias("_place"))
    return rows.where(passes("base") & passes(policy) & (F.col("_place") >= 0)).select(*unpacked(docs))
