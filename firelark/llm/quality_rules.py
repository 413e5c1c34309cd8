"""Document quality by weak supervision over rules. DataFrame functions only.

Method. Each rule looks for one defect of junk in the counts of a text. It votes bad (-1) where the defect is plain, good (1) where the text is free of
it, and abstains (0) between, or where the text is too short to tell. Expectation-maximisation over all documents estimates the share of
good documents and of each rule how often it is right on good ones that it votes on, and on bad ones, given the hidden quality; a
document's quality is the posterior probability given its votes (rules independent given quality, abstaining rules without say). So a
vote for good says little where a rule knows one kind of junk only. It is kept if that is `threshold` or more and no base rule fails.

The votes of all documents are first counted by pattern (a partial aggregate); patterns are at most 3 ** 8, a bound that does
not depend on the data, and EM runs over them. Texts are read once; their counts are written to the shared folder.

Results: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (counts over the whole text, as in the columns of
measures), base_failed, quality (posterior), kept. Null and wordless texts have counts of 0 and fail the base. Rows are kept
as they are, repeated doc_ids included; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firelark.llm import shared

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each text."""
    d = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    d = d.withColumn("w", _words(F.col("t"))).withColumn("n_words", F.size("w").cast("long"))
    # hashes of the 3-word windows; each window is hashed once
    d = d.withColumn("g", F.when(F.col("n_words") >= 3, F.expr("transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))")).otherwise(F.expr("array()")).cast("array<bigint>"))
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.select("doc_id", "n_words", "g", F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"), (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.size("lines").cast("long").alias("n_lines"), F.regexp_count("t", F.lit("!!")).cast("long").alias("n_shouts"), F.length(F.regexp_replace("t", r"[^\p{Lu}]", "")).cast("long").alias("n_capitals"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"))
    # windows that occur again: neighbours in sorted order. Few: look each window up; many: sort positions by hash
    d = d.withColumn("s", F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array("g")))
    d = d.withColumn("again", F.expr("array_distinct(filter(s, (x, i) -> i > 0 AND x = s[i - 1]))"))
    d = d.withColumn("by_hash", F.when(F.size("again") > 32, F.expr("sort_array(transform(g, (x, i) -> struct(x AS x, i AS i)))")))
    many = "sort_array(transform(filter(transform(by_hash, (e, k) -> struct(e.i AS i, coalesce(by_hash[k - 1].x = e.x, false) OR coalesce(get(by_hash, k + 1).x = e.x, false) AS r)), e -> e.r), e -> e.i))"
    many = many.replace("by_hash[k - 1]", "get(by_hash, k - 1)")
    few = "filter(transform(g, (x, i) -> IF(array_contains(again, x), i, -1)), i -> i >= 0)"
    d = d.withColumn("at", F.expr(f"CASE WHEN s IS NULL THEN NULL WHEN by_hash IS NOT NULL THEN {many} ELSE {few} END"))
    # each window covers three words; one that starts within the last three adds only its own new ones
    d = d.withColumn("n_repeat_words", F.coalesce(F.expr("aggregate(transform(at, (p, k) -> IF(k = 0, 3L, CAST(least(3, p - at[k - 1]) AS BIGINT))), 0L, (a, x) -> a + x)"), F.lit(0)).cast("long"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts", "n_capitals", "n_distinct")


def votes() -> dict[str, Column]:
    """Rules: -1 where a text has a defect of junk, 1 where it is free of it, else 0."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    letters = F.greatest(F.col("word_chars"), F.lit(1))
    per = lambda c: F.col(c) / n
    vote = lambda bad, good: F.when(bad, -1).when(good, 1).otherwise(0)
    size = F.col("word_chars") / n
    return {
        "symbols": vote(per("n_symbols") > 0.25, per("n_symbols") < 0.02),
        "symbol_chars": vote(F.col("n_symbols") / letters > 0.05, F.col("n_symbols") / letters < 0.004),
        "shouts": vote(per("n_shouts") > 0.15, per("n_shouts") < 0.02),
        "capitals": vote(F.col("n_capitals") / letters > 0.4, F.col("n_capitals") / letters < 0.2),
        "repeats": vote(per("n_repeat_words") > 0.35, per("n_repeat_words") < 0.15),
        "lines": vote((F.col("n_dup_lines") >= 4) & (F.col("n_dup_lines") * 5 > F.col("n_lines")), F.col("n_dup_lines") == 0),
        "variety": vote((n >= 50) & (per("n_distinct") < 0.08), (n >= 50) & (per("n_distinct") > 0.2)),
        "word_length": vote((size > 14) | (size < 2), (size >= 3) & (size <= 9)),
    }


# before any data: a rule is wrong on few good documents, and knows some of the bad ones; this counts as a share of all documents
START, STRENGTH = (0.99, 0.3), 0.05
CLAMP = ((0.5, 0.999), (0.02, 0.95))


def evidence(right: tuple[float, float]) -> tuple[float, float]:
    """Log-odds of good that a vote for good and one for bad add; right: how often a rule is, on good and on bad documents."""
    good, bad = right
    return math.log(good / (1 - bad)), math.log((1 - good) / bad)


def fit(patterns: list[tuple[dict[str, int], int]], rules: list[str], rounds: int = 40) -> tuple[float, dict[str, tuple[float, float]]]:
    """EM over counted vote patterns: the share of good documents and of each rule how often it is right on good and on bad ones."""
    total = sum(c for _, c in patterns)
    share, right = 0.8, dict.fromkeys(rules, START)
    for _ in range(rounds if total else 0):
        says = {r: evidence(right[r]) for r in rules}
        good, agree, cast = 0.0, {r: [0.0, 0.0] for r in rules}, {r: [0.0, 0.0] for r in rules}
        for pattern, c in patterns:
            x = math.log(share / (1 - share)) + sum(says[r][v < 0] for r, v in pattern.items() if v)
            p = 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))
            good += p * c
            for r, v in pattern.items():
                if v:
                    for k, q in enumerate((p, 1 - p)):
                        cast[r][k] += q * c
                        agree[r][k] += q * c * ((v > 0) == (k == 0))
        prior = STRENGTH * total
        share = min(0.99, max(0.01, good / total))
        of = lambda r, k, m: min(CLAMP[k][1], max(CLAMP[k][0], (agree[r][k] + START[k] * m) / (cast[r][k] + m)))
        right = {r: (of(r, 0, prior), of(r, 1, prior * (1 - share))) for r in rules}
    return share, right


def quality_rules(docs: DataFrame, threshold: float = 0.5, min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    m = shared.written(measures(docs), "measures")
    rules = votes()
    cast = F.struct(*(v.cast("int").alias(r) for r, v in rules.items()))
    voted = m.withColumn("votes", cast)
    usable = (F.col("n_words") >= min_words) & (100 * F.col("n_repeat_words") <= max_repeat * F.col("n_words"))
    counted = voted.where(F.col("n_words") > 0).groupBy("votes").count().collect()  # 3 ** 8 rows at most
    share, right = fit([(x["votes"].asDict(), x["count"]) for x in counted], list(rules))
    odds = F.lit(math.log(share / (1 - share)))
    for r in rules:
        good, bad = evidence(right[r])
        odds = odds + F.when(F.col(f"votes.{r}") > 0, good).when(F.col(f"votes.{r}") < 0, bad).otherwise(0.0)
    out = voted.select("*", (1 / (1 + F.exp(-odds))).alias("quality"), (~usable).alias("base_failed"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.when(F.col("n_words") == 0, 0.0).otherwise(F.col("quality")).alias("quality"), (~F.col("base_failed") & (F.col("quality") >= threshold)).alias("kept"))
