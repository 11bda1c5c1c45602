"""Quality rules with host-level verdicts, DataFrame functions only (operator 7).

Each text is measured (words, characters, symbols, repeated lines and word
windows) and tested against document rules.  The failures of each rule are
counted by domain, and a domain's failure rate is shrunk towards the mean rate
with a beta prior fitted to all domains by the method of moments: with mean m and
variance v of the domains' rates the prior has strength s = m (1 - m) / v - 1,
and the shrunk rate is (failures + m s) / (rows + s).  A domain is rejected whole if its shrunk rate of
any rule is above that rule's bound: HOST_SD standard deviations of the fitted prior, sqrt(m (1 - m) / (s + 1)),
above its mean, and HOST_RATE at most.  A document is kept if it passes the
base rules and its domain is not rejected.  Domains that differ by chance only stay within the bound.

Scale.  Measuring is one map without the text in its result, staged and read
twice.  Domains are counted with partial aggregates, so a domain with a third of
all rows costs one row a task.  Verdicts are one row a domain; the join back is
left to Spark's own size check (broadcast or a join whose hot side it splits).

Defined cases.  NULL text: no words, so it fails the base rules.  NULL domain: a
domain of its own.  One domain, or equal rates: no shrinking is needed and the
strength is capped at STRENGTH and the bound is HOST_RATE.  Texts of any length are measured whole.  Repeated
rows count as often as they occur.  Other columns pass through; result columns
replace input columns of the same name.  Empty table: empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Characters that count as symbols (fixed by the operator's contract).
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
HOST_RATE, HOST_SD, STRENGTH = 0.5, 3.0, 1e6
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once per row, whatever the number of references."""
    return F.transform(F.array(value), use)[0]


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, common.SPACE), lambda w: w != "")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def repeat_words(words: Column) -> Column:
    """Words within 3-word windows that occur at least twice in the array.

    Windows are hashed and sorted with their start; starts with an equal
    neighbour are the repeated ones, and each covers up to three words of its own.
    """
    def count(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.struct(
            F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)).alias("g"), i.alias("i")))
        starts = let(F.sort_array(windows), lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, j: (F.get(s, j - 1)["g"] == x["g"]) | (F.get(s, j + 1)["g"] == x["g"])),
            lambda x: x["i"])))
        return let(starts, lambda s: total(F.transform(
            s, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(s, j + 1) - x, F.lit(3))).cast("long"))))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(hashes, count))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with MEASURES (all long)."""
    t = F.coalesce(F.col(common.quoted(text)), F.lit(""))
    length = F.char_length
    inside = t
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(common.WORD))
    with_words = df.select(common.others(df, text).alias("row"), inside.alias("t"), word_array(t).alias("w"), lines.alias("l"))
    t = F.col("t")
    done = with_words.select(
        "row", F.size("w").cast("long").alias("n_words"),
        length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (length(t) - length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("w")).alias("n_repeat_words"))
    return common.restore(df.drop(text), done, {m: m for m in MEASURES})


def rules() -> dict[str, Column]:
    """Document rules: name -> whether the document fails."""
    n = F.col("n_words")
    return {"short": n < 50, "repeats": 100 * F.col("n_repeat_words") > 50 * n,
            "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
            "lines": F.col("n_dup_lines") > 10}


BASE = ("short", "repeats")


def host_rates(failed: DataFrame, domain: str, names: list[str], host_rate: float = HOST_RATE, host_sd: float = HOST_SD) -> DataFrame:
    """One row a domain: ``domain, rows, <rule>_rate`` with shrunk rates, and ``<rule>_bound``."""
    by = failed.groupBy(F.col(domain).alias("domain")).agg(
        F.count("*").alias("rows"), *(F.sum(F.col(f"fail_{r}").cast("long")).alias(r) for r in names))
    raw = [F.col(r) / F.col("rows") for r in names]
    prior = by.agg(*(F.avg(x).alias(f"m_{r}") for r, x in zip(names, raw, strict=True)),
                   *(F.var_pop(x).alias(f"v_{r}") for r, x in zip(names, raw, strict=True))).first()
    out = []
    for r in names:
        m, v = prior[f"m_{r}"] or 0.0, prior[f"v_{r}"] or 0.0
        s = min(STRENGTH, max(0.0, m * (1 - m) / v - 1)) if v > 0 else STRENGTH
        out.append(((F.col(r) + F.lit(m * s)) / (F.col("rows") + F.lit(s))).alias(f"{r}_rate"))
        outlier = m + host_sd * (m * (1 - m) / (s + 1)) ** 0.5 if s < STRENGTH else host_rate
        out.append(F.lit(min(host_rate, outlier)).alias(f"{r}_bound"))
    return by.select("domain", "rows", *out)


def judge(df: DataFrame, text: str = "text", domain: str = "source", host_rate: float = HOST_RATE,
          host_sd: float = HOST_SD) -> DataFrame:
    """``df`` without its text, with MEASURES, ``base_failed`` and ``kept``."""
    stages = common.Stages(df.sparkSession, "rules")
    names = list(rules())
    plain = measure(df, text)
    seen = stages.put(plain.select(common.others(plain, *MEASURES).alias("row"), F.col(common.quoted(domain)).alias("domain_"),
                                   *MEASURES, *(c.alias(f"fail_{r}") for r, c in rules().items())), "measured")
    rates = host_rates(seen, "domain_", names, host_rate, host_sd)
    bad = reduce(lambda a, b: a | b, (F.col(f"{r}_rate") > F.col(f"{r}_bound") for r in names))
    verdicts = stages.put(rates.withColumn("rejected", bad).select("domain", "rejected"), "verdicts")
    base = F.col(f"fail_{BASE[0]}") | F.col(f"fail_{BASE[1]}")
    rows = seen.join(verdicts, F.col("domain_").eqNullSafe(F.col("domain")), "left")
    done = rows.select("row", *MEASURES, base.alias("base_failed"), (~base & ~F.col("rejected")).alias("kept"))
    return common.restore(df.drop(text), done, {c: c for c in (*MEASURES, "base_failed", "kept")})
