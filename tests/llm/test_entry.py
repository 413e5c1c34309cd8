import random

from pyspark.sql import functions as F

import corpus_pipeline
from brute import components, repeated
from firelark.llm import queries


def test_registered():
    import __spark_entry__ as entry

    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "mix"]


def test_pipeline(spark, make, tmp_path):
    """Toxic, near-duplicate and contaminated documents go, repeated passages are cut, the rest is mixed whole."""
    rnd = random.Random(3)
    text = lambda n: " ".join(f"w{rnd.randrange(4000)}" for _ in range(n))
    t = {i: text(90) for i in range(60)}
    t |= {i: text(40) + " vileword badword nastyword vileword" for i in range(60, 80)}
    t[80], t[81] = t[1], t[2].replace(" ", "  ") + " tail"
    shared = text(70)
    t[82], t[83] = text(40) + " " + shared, shared + " " + text(40)
    item = text(30)
    t[84] = text(30) + " " + item + " " + text(30)
    t |= {85: None, 86: ""}
    make(t.items(), {i: f"s{i % 3}" for i in t}).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(60 <= i < 80)) for i in t], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == {*range(60), 82, 83, 85, 86}
    assert all(out[i]["text"] == t[i] for i in [*range(60), 82, 85, 86])
    assert shared not in out[83]["text"] and out[83]["text"] in t[83]
    assert sorted(r["mix_position"] for r in out.values()) == list(range(len(out)))
    # plain versions of what the stages leave
    left = {i: r["text"] for i, r in out.items()}
    assert all(i == c for i, _, c in components(left, 5, 80, 100)) and repeated(left, 50) == {}


def test_stages_on_odd_rows(spark, make, tmp_path):
    """Repeated and null ids, null, empty and very long texts, equal rows, columns named like those used within; and empty tables."""
    rnd = random.Random(5)
    text = lambda n: " ".join(f"w{rnd.randrange(9000)}" for _ in range(n))
    a, b, c, item = text(80), text(80), text(80), text(20)
    rows = [(1, a), (2, a), (2, b), (3, "x " * 300_000), (4, None), (5, ""), (None, a), (None, None), (6, text(30) + " " + b), (6, c), (6, c), (7, text(9) + " " + item), (8, "vileword badword " * 20)]
    docs = make(rows).withColumn("source", F.when(F.col("doc_id") != 3, "s"))
    docs = docs.select("*", *(F.lit(i).alias(x) for i, x in enumerate(("_gone", "_bad", "_id", "_cuts", "_o", "_t", "_b", "id", "cuts", "text_hash", "o", "p", "r"))))
    spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    gone = {"toxicity": set(), "near_duplicates": {2}, "repeated_passages": set(), "decontamination": {7}, "mix": set()}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns[: len(docs.columns)] == docs.columns
        rows_ = got.collect()
        ids = sorted(str(r["doc_id"]) for r in rows_)
        want = [r for r in docs.collect() if r["doc_id"] not in gone[name]]
        if name == "repeated_passages":  # the second document is a copy of the first in one of its texts
            want = [r for r in want if (r["doc_id"], r["text"]) != (2, a)]
            assert all(b not in (r["text"] or "") for r in rows_ if r["doc_id"] == 6)
        if name != "toxicity":
            assert ids == sorted(str(r["doc_id"]) for r in want), name
        assert all(r[x] == i for r in rows_ for i, x in enumerate(("_gone", "_bad", "_id", "_cuts", "_o")))
        none = stage(spark, docs.where("false"), str(tmp_path))
        assert none.columns == got.columns and none.collect() == [], name
