"""Benchmark decontamination by spaced-seed hashing. DataFrame functions only.

Method. A mask names the positions of a window of tokens that count; the others are ignored, so a substituted token there does not
hide a match. Windows of all benchmark items are hashed at every position under each mask, windows of the training texts
too, and equal hashes are hits. A hit puts an item against a text without gaps; along that alignment every run of
`span` tokens (the whole item if it is shorter) is compared, and the document is contaminated if at least `share`
of the tokens of some run are equal.

Guarantee. With the defaults of span, share and least every alignment that the verification accepts is hit: whichever tokens of a run of
12 to 24 are substituted, if 80 % are left then one of `SEEDS` has all its positions equal somewhere in the run (the tests enumerate
all 41,341 patterns). A lower share or least needs other masks.

Scale. The seeds of the benchmark are broadcast only if counted to be under `MAX_BROADCAST` rows; beyond, the join shuffles the
hashes. Hits are written and, under the same bound, broadcast, so that no text is moved; beyond, only the texts that a bitmap of the
hit doc_ids lets through are, by doc_id. Contaminated documents go the same way: those that surely stay are not moved.

Tokens are lower-cased runs of other than white space, without punctuation at their ends. Results of contaminated: doc_id, item_id,
at_token (where the item's first token would stand in the text), n_equal and n_compared (of the best run), one row an alignment.
Items of fewer than `least` tokens must stand in the text whole and unchanged: they are sought by the hash of all their tokens, and n_equal
and n_compared are their length. Null, empty and wordless texts and items, and rows without a doc_id or item_id, have no hits. A repeated doc_id gives
the alignments of all its texts, equal ones once; so does a repeated item_id. Clashing column names don't matter: only doc_id, text and
item_id, text are read. Very long texts are searched whole. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firelark.llm import shared

SEEDS = ("111011", "11111")
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|_-"
MAX_BROADCAST = 1_000_000  # seeds or hits, of 24 bytes
MAX_ITEMS, MAX_ITEM_BYTES = 20_000, 64 << 20


def tokens(text: Column) -> Column:
    words = F.transform(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: F.btrim(w, F.lit(PUNCTUATION)))
    return F.filter(words, lambda w: w != "")


def seeds(w: str, mask: str, tag: int) -> str:
    """SQL: array of the hashes of the masked windows of the token array w, by position."""
    take = ", ".join(f"{w}[i + {k}]" for k, c in enumerate(mask) if c == "1")
    return f"IF(size({w}) >= {len(mask)}, transform(sequence(0, size({w}) - {len(mask)}), i -> xxhash64({tag}, {take})), CAST(array() AS array<bigint>))"


def contaminated(docs: DataFrame, benchmark: DataFrame, span: int = 24, share: float = 0.8, least: int = 12, masks=SEEDS) -> DataFrame:
    items = benchmark.select("item_id", tokens(F.col("text").cast("string")).alias("b")).where("item_id is not null").where(F.size("b") > 0)
    items = items.withColumn("run", F.when(F.size("b") < least, F.size("b")).otherwise(F.least(F.lit(span), F.size("b"))))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("_t")).where("doc_id is not null and _t is not null")
    # the tokens are bound as a lambda's variable, so they are made once a text; the outer generator keeps Spark from
    # computing the hashes a second time to filter texts without any. g: (tag of the mask, position, hash)
    short = sorted(r[0] for r in items.where(F.size("b") < least).select(F.size("b")).distinct().collect())  # under `least` lengths
    kinds = [(m, t) for t, m in enumerate(masks)] + [("1" * n, len(masks) + n) for n in short]
    one = lambda m, t, w: f"transform({seeds(w, m, t)}, (h, k) -> struct({t} AS t, k, h))"

    def hashed(df: DataFrame, keep: list[str], w: str, what: str) -> DataFrame:
        return df.select(*keep, F.expr(f"inline_outer(transform(array({w}), w -> struct({what} AS g)))")).select(*keep, F.expr("inline_outer(g)")).where("h is not null")

    # an item is sought by the masks, or, if it is short, as a whole
    whole = "CASE " + "".join(f"WHEN size(w) = {len(m)} THEN {one(m, t, 'w')} " for m, t in kinds[len(masks) :]) + "ELSE {} END"
    seeking = "concat(" + ", ".join(one(m, t, "w") for m, t in kinds[: len(masks)]) + ")"
    seed = hashed(items, ["item_id"], "b", whole.format(seeking) if short else seeking).select("item_id", "t", F.col("k").alias("ip"), "h").distinct()
    if seed.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        seed = F.broadcast(seed)
    words = texts.select("doc_id", tokens(F.col("_t")).alias("w"))
    grams = hashed(words, ["doc_id"], "w", "concat(" + ", ".join(one(m, t, "w") for m, t in kinds) + ")")
    hits = shared.written(grams.join(seed, ["t", "h"]).select("doc_id", "item_id", (F.col("k") - F.col("ip")).alias("at_token")).distinct(), "hits")
    if hits.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        found = words.join(F.broadcast(hits), "doc_id")
    else:  # only texts with hits are moved
        ids = shared.written(hits.select(F.col("doc_id").alias("id")).distinct(), "hit-ids")
        found = shared.split_by_ids(texts, ids)[0].select("doc_id", tokens(F.col("_t")).alias("w")).join(hits, "doc_id")
    found = found.join(F.broadcast(items) if bounded(items) else items, "item_id")
    # equal[j]: whether token j of the item equals the text's; outside the text it does not
    found = found.withColumn("eq", F.expr("transform(b, (x, j) -> IF(get(w, at_token + j) <=> x, 1, 0))")).withColumn("size", F.size("b"))
    # a running sum makes each run's count a difference
    found = found.drop("w", "b").withColumn("sums", F.expr("aggregate(eq, array(0), (a, x) -> concat(a, array(element_at(a, -1) + x)))"))
    best = found.withColumn("n_equal", F.expr("array_max(transform(sequence(0, size(eq) - run), s -> sums[s + run] - sums[s]))"))
    good = F.col("n_equal") >= F.when(F.col("size") < least, F.col("run")).otherwise(share * F.col("run"))
    return best.where(good).select("doc_id", "item_id", "at_token", F.col("n_equal").cast("int").alias("n_equal"), F.col("run").cast("int").alias("n_compared")).distinct()


def bounded(items: DataFrame) -> bool:
    """Whether the items are few and short enough to be broadcast: counted, in rows and in bytes."""
    n, size = items.agg(F.count(F.lit(1)), F.sum(F.expr("aggregate(b, 0L, (a, x) -> a + octet_length(x) + 16)"))).first()
    return n <= MAX_ITEMS and (size or 0) <= MAX_ITEM_BYTES


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without contaminated documents; columns, rows without a doc_id or text and the order of columns stay as they are. All rows of a
    contaminated doc_id go."""
    bad = shared.written(contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("id")).distinct(), "contaminated")
    return shared.without_ids(docs, bad)
