"""Quality rules of documents and of their hosts, in built-in functions only.

Each document gets counts and a verdict of fixed rules. The failures are summed by host; a
host's failure rate is drawn towards the rate of all hosts by a beta prior fitted to the hosts
themselves (method of moments), so a host of few documents is not judged by chance; the verdict
on the host is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkroute.llm.common import WORD, fresh, let, sent_to_all, text_of, write_once

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
REPEAT_PERCENT = 50
HOST_RATE = 0.8
PRIOR_WEIGHT = (1.0, 10_000.0)


def repeated_words(words: Column) -> Column:
    """Words that stand in a 3-word window found twice or more among ``words``."""

    def covered(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )

        def of_windows(g: Column) -> Column:
            ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

            def of_ordered(s: Column) -> Column:
                def place(here: Column, j: Column) -> Column:
                    near = [F.get(s, j + step)["x"] == here["x"] for step in (-1, 1)]
                    return F.when(F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False)), here["i"])

                at = F.array_compact(F.transform(s, place))
                return let(at, lambda p: F.size(F.array_union(
                    F.array_union(p, F.transform(p, lambda x: x + 1)), F.transform(p, lambda x: x + 2))))

            return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(let(ordered, of_ordered))

        return F.when(F.size(w) < 4, 0).otherwise(let(windows, of_windows))

    return let(words, covered)


def text_counts(text: Column) -> Column:
    """A struct of the counts that the rules read."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    n_dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            n_dup_lines.cast("long").alias("n_dup_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        )

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words)


def beta_prior(hosts: DataFrame, docs: str, failed: str) -> tuple[float, float]:
    """Parameters of the beta distribution that the hosts' failure rates come from.

    Moments over hosts, weighted by documents; the spread that chance alone gives is taken off.
    """
    n, f = F.col(docs).cast("double"), F.col(failed).cast("double")
    s = hosts.select(n.alias("n"), f.alias("f")).agg(
        F.count("*").alias("h"), F.sum("n").alias("n"), F.sum("f").alias("f"),
        F.sum(F.expr("f * f / n")).alias("ff"), F.sum(F.expr("n * n")).alias("nn")).first()
    if not s["h"]:
        return 1.0, 1.0
    mean = min(max(s["f"] / s["n"], 1e-6), 1 - 1e-6)
    spread = s["ff"] - s["n"] * mean * mean - (s["h"] - 1) * mean * (1 - mean)
    room = s["n"] - s["nn"] / s["n"]
    between = spread / room if room > 0 else 0.0
    weight = mean * (1 - mean) / between - 1 if between > 0 else PRIOR_WEIGHT[1]
    weight = min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
    return mean * weight, (1 - mean) * weight


def quality_rules(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", host_rate: float = HOST_RATE,
    keep: list[str] | None = None,
) -> tuple[DataFrame, str]:
    """``docs`` (its columns ``keep`` if given) with one more struct column, and its name.

    The struct has n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    host_docs, host_failed, host_rejected and kept. A document fails the base rules with fewer
    than 50 words or with more than half of its words in repeated 3-word windows; a host is
    rejected if its shrunk failure rate is above ``host_rate``; kept is neither.

    Defined results: a null text is empty and fails; a null host is a host of its own; repeated
    rows are judged and counted each; other columns pass through, whatever their names; an empty
    table stays empty.
    """
    name = fresh(docs, "quality")
    counts = F.struct(F.col("c.*"), (F.expr(
        f"c.n_words < {MIN_WORDS} or 100 * c.n_repeat_words > {REPEAT_PERCENT} * c.n_words")).alias("base_failed"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row"), F.col(f"`{host_col}`").alias("host"),
                      F.explode(F.array(text_counts(text_of(text_col)))).alias("c"))
    judged = write_once(row.select("row", "host", counts.alias("c")), "rules")
    hosts = write_once(judged.groupBy("host").agg(
        F.count("*").alias("host_docs"), F.sum(F.col("c.base_failed").cast("long")).alias("host_failed")), "hosts")
    alpha, beta = beta_prior(hosts, "host_docs", "host_failed")
    rate = (F.col("host_failed") + F.lit(alpha)) / (F.col("host_docs") + F.lit(alpha + beta))
    verdicts = hosts.select(F.col("host").alias("of_host"), "host_docs", "host_failed", (rate > host_rate).alias("host_rejected"))
    out = judged.join(sent_to_all(verdicts), F.col("host").eqNullSafe(F.col("of_host")), "left")
    kept = ~F.col("c.base_failed") & ~F.col("host_rejected")
    whole = F.struct("c.*", "host_docs", "host_failed", "host_rejected", kept.alias("kept"))
    return out.select("row.*", whole.alias(name)), name


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS p,
      unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS gram
    FROM d WHERE len(w) >= 3)),
r AS (
  SELECT doc_id, count(DISTINCT q)::BIGINT AS n FROM (
    SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM g WHERE times > 1) GROUP BY doc_id),
l AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
c AS (
  SELECT d.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*) AS host_docs, sum(base_failed::INT)::BIGINT AS host_failed FROM b GROUP BY source),
s AS (
  SELECT count(*) AS h, sum(host_docs)::DOUBLE AS n, sum(host_failed * host_failed / host_docs::DOUBLE) AS ff,
    sum(host_docs * host_docs)::DOUBLE AS nn,
    least(greatest(sum(host_failed) / sum(host_docs)::DOUBLE, 1e-6), 1 - 1e-6) AS m FROM h),
v AS (SELECT m, (ff - n * m * m - (h - 1) * m * (1 - m)) / nullif(n - nn / n, 0) AS between_hosts FROM s),
p AS (
  SELECT m, least(greatest(CASE WHEN between_hosts > 0 THEN m * (1 - m) / between_hosts - 1 ELSE 10000 END, 1), 10000) AS k
  FROM v),
j AS (SELECT source, host_docs, host_failed, (host_failed + m * k) / (host_docs + k) > 0.8 AS host_rejected FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_docs, host_failed,
  host_rejected, NOT base_failed AND NOT host_rejected AS kept
FROM b JOIN j ON b.source IS NOT DISTINCT FROM j.source
"""
