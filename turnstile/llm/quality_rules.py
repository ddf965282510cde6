"""Operator 5: quality rules with host verdicts.

Every document is measured (words, symbols, repeated lines and word windows)
and tested against the rules.  Failures are added up by host; each host's rate
is shrunk towards all hosts' rates with a beta prior fitted to them by moments,
so that a host with three documents isn't judged on three documents.  A host
whose shrunk rate for a rule is over the limit is rejected with all its
documents.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: a null text has no words;
documents with a null host are one host; repeated rows count once each; an
empty table gives an empty result; a very long text is measured whole, in memory
linear in its words; other columns are ignored by the report and kept by
``keep_good``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from turnstile.llm.common import lookup, require, written
from turnstile.session import maybe_broadcast

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Rules that only count against the host: symbols per 10 words, repeated lines
# per 10 lines.
HOST_SYMBOLS_PER_10_WORDS = 1
HOST_DUP_LINES_PER_10 = 3
# A host is rejected when a rule's shrunk failure rate is above this.
HOST_MAX_RATE = 0.75
# The prior weighs at least and at most so many documents.
PRIOR_MIN, PRIOR_MAX = 2.0, 1000.0

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
RULES = ["base", "symbols", "lines"]
# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(number) == n:
        return 0
    w = np.fromiter(map(number.__getitem__, words), np.int64, n)
    v = len(number)
    # Two steps keep the window's number within 64 bits for any vocabulary.
    pair = np.unique(w[:-1] * v + w[1:], return_inverse=True)[1].reshape(-1)
    window, counts = np.unique(pair[:-1] * v + w[2:], return_inverse=True, return_counts=True)[1:]
    again = counts[window.reshape(-1)] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The six MEASURES of one text."""
    if not text:
        return (0,) * 6
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: by ASCII white space only
    lines = [x for x in text.split("\n") if x.encode("utf-8", "surrogatepass").split()]
    gaps = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    return (len(words), len(text) - gaps, sum(map(raw.count, map(str.encode, SYMBOLS))),
            len(lines) - len(set(lines)), _repeat_words(words), len(lines))


@F.pandas_udf(StructType([StructField(m, LongType()) for m in MEASURES]))
def measure(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in texts], columns=MEASURES)


def failures(m: Column) -> dict[str, Column]:
    """Per rule whether a document with measures ``m`` fails it."""
    return {
        "base": (m["n_words"] < MIN_WORDS)
        | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]),
        "symbols": 10 * m["n_symbols"] > HOST_SYMBOLS_PER_10_WORDS * m["n_words"],
        "lines": 10 * m["n_dup_lines"] > HOST_DUP_LINES_PER_10 * m["n_lines"],
    }


def host_verdicts(failed: DataFrame) -> DataFrame:
    """``failed(host, base, symbols, lines)`` by document, to one row per host:
    n, its shrunk rates, and whether it is rejected.  A null host is a host."""
    hosts = failed.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    p = {r: F.col(r) / F.col("n") for r in RULES}
    # One row: sums over all hosts.
    s = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("n"),
                  *[F.sum(r).alias(f"f_{r}") for r in RULES],
                  *[F.sum(F.col("n") * p[r] * p[r]).alias(f"q_{r}") for r in RULES]).first()
    rates = []
    for r in RULES:
        mean, strength = beta_prior(s["n"] or 0, s["hosts"], s[f"f_{r}"] or 0, s[f"q_{r}"] or 0.0)
        rates.append(((F.col(r) + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))
                     .alias(f"rate_{r}"))
    hosts = hosts.select("host", "n", *rates)
    return hosts.withColumn("rejected", F.greatest(*[F.col(f"rate_{r}") for r in RULES])
                            > HOST_MAX_RATE)


def beta_prior(n: int, hosts: int, failed: int, squares: float) -> tuple[float, float]:
    """(mean, strength) of the beta prior by moments: ``squares`` is the sum
    over hosts of n_i * rate_i squared.  The spread that sampling alone gives is
    taken off the spread between hosts."""
    if not n:
        return 0.0, PRIOR_MIN
    mean = failed / n
    room = mean * (1 - mean)
    between = squares / n - mean * mean - room * hosts / n
    if between <= 0:
        return mean, PRIOR_MAX
    return mean, min(max(room / between - 1, PRIOR_MIN), PRIOR_MAX)


def judged(docs: DataFrame, measures: str = "_measures", host: str = "source") -> DataFrame:
    """``docs``, which has a struct of MEASURES, with ``_failed`` (the base
    rules) and ``_kept`` (passes them, and so does its host)."""
    fail = failures(F.col(measures))
    verdicts = host_verdicts(docs.select(F.col(host).alias("host"),
                                         *[c.alias(r) for r, c in fail.items()]))
    # A null host must meet its verdict in an equi-join.
    key = F.struct(F.col(host).alias("host"))
    flagged = docs.withColumn("_host", F.to_json(key))
    hosts = verdicts.select(F.to_json(F.struct("host")).alias("_host"), "n",
                            F.col("rejected").alias("_rejected"))
    return (lookup(flagged, hosts, "_host", "n", how="inner")
            .withColumn("_failed", fail["base"])
            .withColumn("_kept", ~F.col("_failed") & ~F.col("_rejected"))
            .drop("_host", "_rejected"))


def quality_report(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, the measures, base_failed and kept of every document."""
    require(docs, ["doc_id", "text", host])
    # The measures are read three times, the texts once.
    slim = written(docs.select("doc_id", F.col(host).alias("source"),
                               measure("text").alias("_measures")), "measures")
    return judged(slim).select("doc_id", *[F.col(f"_measures.{m}").alias(m) for m in MEASURES[:5]],
                               F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """``docs`` without the rejected documents, all its columns and no more.
    The columns travel in one struct, so their names can't clash.  Texts are
    measured once; those that fail are known again by hash and length."""
    require(docs, ["text", host])
    key = [F.xxhash64("text").alias("_hash"), F.octet_length("text").alias("_bytes")]
    slim = written(docs.select(*key, F.col(host).alias("host"), measure("text").alias("_measures")), "measures")
    fail = failures(F.col("_measures"))
    hosts = host_verdicts(slim.select("host", *[c.alias(r) for r, c in fail.items()]))
    bad_hosts = written(hosts.where("rejected").select(F.col("host").alias("_bad_host"), F.lit(True).alias("_bad")),
                        "hosts")
    bad = written(slim.where(fail["base"]).select(
        F.col("_hash").alias("_bad_hash"), F.col("_bytes").alias("_bad_bytes")).distinct(), "failed")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *key,
                       F.col(host).alias("_host"))
    kept = rows.join(maybe_broadcast(bad), (F.col("_hash") == F.col("_bad_hash"))
                     & F.col("_bytes").eqNullSafe(F.col("_bad_bytes")), "left_anti")
    return kept.join(maybe_broadcast(bad_hosts), F.col("_host").eqNullSafe(F.col("_bad_host")),
                     "left_anti").select("_doc.*")
