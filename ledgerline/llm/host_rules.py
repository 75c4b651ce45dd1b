"""Quality rules with host-level verdicts (DataFrame functions only).

Each document is measured inside its own row (no shuffle of words).  Failures
of each rule are then summed by host (the ``source`` column), each rule's rates
get a beta prior fitted to the hosts by beta-binomial moments, a host's rate is shrunk to
that prior, and a host whose shrunk rate of any rule is above
``HOST_THRESHOLD`` is rejected: the verdict joins back to its documents.

Nulls: a null text has no words and fails the length rule; a null source is a
host of its own.  Empty texts count 0 everywhere.  Repeated rows are judged one
by one; an empty table gives an empty result.  Very long texts are measured whole.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from . import common

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_A_WORD = 1
MAX_DUP_LINES = 20
# A host goes when its shrunk rate of a rule is above this.
HOST_THRESHOLD = 0.75
# Weight of the prior where hosts do not differ at all, and the least weight.
PRIOR_MOST, PRIOR_LEAST = 1e6, 1.0
RULES = ("short", "repeats", "symbols", "lines")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a lambda variable, so nothing inlines it)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the array holds twice or more.

    Windows are sorted with their positions; equal neighbours are repeats, and
    a repeat at p after one at q covers min(3, p - q) further words.
    """
    def window(i):
        gram = F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        return F.struct(gram.alias("g"), i.alias("p"))

    def covered(s):
        def repeated(j):
            here = F.get(s, j)["g"]
            return F.coalesce(here == F.get(s, j - 1)["g"], F.lit(False)) | F.coalesce(here == F.get(s, j + 1)["g"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), repeated), lambda j: F.get(s, j)["p"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(places, start, lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"),
                                                                p.alias("last")), lambda a: a["n"])

    windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), window))
    return F.when(F.size(words) >= 3, _let(windows, covered)).otherwise(F.lit(0))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source and the counts of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(common.WORD))
    counted = _let(F.regexp_extract_all(text, F.lit(common.WORD), F.lit(0)),
                   lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    counted_lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return docs.select(
        "doc_id", "source", counted.alias("_c"),
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        counted_lines.cast("long").alias("n_dup_lines"),
    ).select("doc_id", "source", F.col("_c.n_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
             "n_dup_lines", F.col("_c.n_repeat_words").cast("long").alias("n_repeat_words"))


def failures() -> dict[str, Column]:
    """Rule name -> failed, over the columns of ``measures``."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": F.col("n_symbols") > MAX_SYMBOLS_A_WORD * F.col("n_words"),
        "lines": F.col("n_dup_lines") > MAX_DUP_LINES,
    }


def host_failures(measured: DataFrame) -> DataFrame:
    """source, n and the number of failures of each rule: one row a host."""
    return measured.groupBy("source").agg(F.count(F.lit(1)).alias("n"),
                                          *[F.sum(f.cast("long")).alias(r) for r, f in failures().items()])


def prior(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Rule -> (alpha, beta) by the moments of beta-binomial counts, from one global row of sums.

    Hosts weigh by their documents.  With rate p over all documents, S = sum of n (a/n - p)^2 over k hosts and N documents,
    sampling alone gives p (1-p) (k-1); what is above it is the spread between hosts,

        rho = (S - p (1-p) (k-1)) / (p (1-p) (N - sum n^2 / N - (k-1))),

    and alpha + beta = 1/rho - 1.  So many hosts of one document each do not look like hosts that differ.
    """
    n = F.col("n").cast("double")
    found: Row = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(n * n).alias("nn"),
                           *[f(F.col(r)).alias(f"{r}_{k}") for r in RULES for k, f in
                             (("a", lambda a: F.sum(a.cast("double"))), ("aa", lambda a: F.sum(a * a / n)))]).first()
    out = {}
    for rule in RULES:
        total = found["n"] or 0.0
        p = found[f"{rule}_a"] / total if total else 0.0
        noise, free = p * (1 - p) * (found["k"] - 1), total - found["nn"] / total - (found["k"] - 1) if total else 0.0
        between = found[f"{rule}_aa"] - total * p * p - noise if total else 0.0
        most = p * (1 - p) * free
        weight = most / between - 1 if between > 1e-9 and most > 0 else PRIOR_MOST
        weight = min(PRIOR_MOST, max(PRIOR_LEAST, weight))
        out[rule] = (p * weight, (1 - p) * weight)
    return out


def host_verdicts(hosts: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """source and whether the host is rejected."""
    rates = [(F.col(r) + F.lit(a)) / (F.col("n") + F.lit(a + b)) for r, (a, b) in fitted.items()]
    return hosts.select(F.col("source").alias("_host"), (F.greatest(*rates) > HOST_THRESHOLD).alias("host_rejected"))


def judge(docs: DataFrame) -> DataFrame:
    """All measures, base_failed, host_rejected and kept, a row for each document.

    Measures are staged (narrow rows), so texts are read once though both the
    host sums and the join need them.
    """
    measured = common.staged(measures(docs), "host-rules")
    hosts = host_failures(measured)
    verdicts = host_verdicts(hosts, prior(hosts))
    rules = failures()
    return (measured.join(verdicts, F.col("source").eqNullSafe(F.col("_host")), "left")
            .withColumn("base_failed", rules["short"] | rules["repeats"])
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the rules over all documents."""
    return judge(common.read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
wl AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM wl),
gr AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM g),
rp AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS c FROM gr) WHERE c >= 2),
cv AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rp) GROUP BY rid),
m AS (SELECT wl.rid, doc_id, source, len(w)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cv.n, 0)::BIGINT AS n_repeat_words
      FROM wl LEFT JOIN cv USING (rid)),
f AS (SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, n_symbols > n_words AS f3, n_dup_lines > 20 AS f4 FROM m),
h AS (SELECT source, count(*) AS n, sum(f1::INT) AS a1, sum(f2::INT) AS a2, sum(f3::INT) AS a3, sum(f4::INT) AS a4 FROM f GROUP BY source),
u AS (SELECT source, n, unnest([1, 2, 3, 4]) AS r, unnest([a1, a2, a3, a4]) AS a FROM h),
mo AS (SELECT r, count(*) AS hosts, sum(n)::DOUBLE AS docs, sum(n * n)::DOUBLE AS nn, sum(a)::DOUBLE / sum(n) AS mean, sum(a * a / n)::DOUBLE AS aa
       FROM u GROUP BY r),
bt AS (SELECT r, mean, aa - docs * mean * mean - mean * (1 - mean) * (hosts - 1) AS between_hosts,
              mean * (1 - mean) * (docs - nn / docs - (hosts - 1)) AS most FROM mo),
pr AS (SELECT r, mean, least(1e6, greatest(1.0, CASE WHEN between_hosts > 1e-9 AND most > 0 THEN most / between_hosts - 1 ELSE 1e6 END)) AS k FROM bt),
ve AS (SELECT source, max((a + mean * k) / (n + k)) > 0.75 AS bad FROM u JOIN pr USING (r) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f1 OR f2) AS base_failed,
       NOT (f1 OR f2) AND NOT bad AS kept
FROM f JOIN ve ON f.source IS NOT DISTINCT FROM ve.source
"""
