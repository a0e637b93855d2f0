"""Words made to share a polynomial hash, and columns named like results in another case."""

import pytest
from pyspark.sql import types as T

from corpus_pipeline import run
from queixa.llm import decontaminate, licences, minhash, quality, recompress, words


def thue_morse(n, letters):
    """The two complementary words of n letters: equal in every polynomial hash modulo a power of two that is short enough."""
    return ["".join(letters[(bin(i).count("1") + side) % 2] for i in range(n)) for side in (0, 1)]


@pytest.mark.parametrize("n", [1024, 4096])
def test_complementary_words_are_told_apart(documents, spark, n):
    a, b = thue_morse(n, "ab")
    shared = " ".join(f"w{i}" for i in range(49))
    got = {r.doc_id: r.n_removed for r in recompress.repeated_spans(documents([(1, f"{shared} {a}"), (2, f"{shared} {b}")]), 50).collect()}
    assert got == {1: 0, 2: 0}
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents([(1, a), (2, b), (3, a)]), 3, 85).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    items = spark.createDataFrame([("x", b)], "item_id string, text string")
    got = {r.doc_id: r["items"] for r in decontaminate.find_leaks(documents([(1, a), (2, b)]), items).collect()}
    assert got == {1: [], 2: ["x"]}


def test_complementary_rows_of_words_are_told_apart(documents):
    """The same with whole words as letters, in windows of many words."""
    import numpy as np
    import pyarrow as pa
    texts = [" ".join(x) for x in thue_morse(2048, "ab")]
    found = [p.hashes for p in words.hashed(pa.array(texts), words.SPACED, words=10_000)][0]
    whole = words.windows(found, 2048)
    assert whole[0] != whole[2048]
    for n in (1, 2, 3, 7, 10, 50):
        by_words = {}
        for i, h in enumerate(words.windows(found, n).tolist()):
            by_words.setdefault(tuple(found[i:i + n].tolist()), set()).add(h)
        assert all(len(x) == 1 for x in by_words.values())
        assert len(set().union(*by_words.values())) == len(by_words)
    assert len(np.unique(found)) == 2


CLASHING = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("Labels", T.StringType()), T.StructField("Items", T.LongType()), T.StructField("Evidence", T.DoubleType()),
    T.StructField("a `quoted`.name", T.StringType()),
    T.StructField("Rejected", T.StructType([T.StructField("content-type", T.StringType()), T.StructField("x y", T.LongType())]))])


@pytest.fixture
def clashing(spark):
    row = ("one two three four five six seven eight nine ten eleven", "en", "s", 1, "mine", 5, 0.5, "q", ("html", 3))
    return spark.createDataFrame([(i, *row) for i in range(4)] + [(4, None, *row[1:])], CLASHING)


def test_results_replace_clashing_columns(spark, clashing):
    items = spark.createDataFrame([("x", "three four five six seven eight nine ten eleven twelve"), ("y", "two three")], "item_id string, text string")
    labels = spark.createDataFrame([(0, 0, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    kept = ["doc_id", "text", "lang", "source", "n_chars"]
    found = decontaminate.find_leaks(clashing, items)
    assert found.columns == [*kept, "Labels", "Evidence", "a `quoted`.name", "Rejected", *decontaminate.RESULT.names]
    assert [r["items"] for r in found.orderBy("doc_id").collect()] == [["y"]] * 4 + [[]]
    found = licences.scan_licences(clashing)
    assert "Labels" not in found.columns and found.count() == 5
    found = quality.judge(clashing, labels)
    assert found.columns == [*kept, "Labels", "Items", "a `quoted`.name", *quality.RESULT] and found.count() == 5


def test_stages_keep_clashing_columns(spark, clashing):
    items = spark.createDataFrame([("y", "two three")], "item_id string, text string")
    labels = spark.createDataFrame([(0, 0, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    for found in (decontaminate.remove_leaks(clashing, items), quality.keep_good(clashing, labels)):
        assert found.schema.names == CLASHING.names
        rows = found.collect()
        assert rows and all(r["Rejected"]["content-type"] == "html" and r["Items"] == 5 and r["Evidence"] == 0.5 for r in rows)


def test_many_blocks_of_a_benchmark(documents, spark):
    items = [(f"i{i}", " ".join(f"w{i * 7 + k}" for k in range(6 + i % 20))) for i in range(60)]
    rows = [(i, " ".join(f"w{i * 5 + k}" for k in range(80))) for i in range(12)] + [(50, None), (51, "")]
    table = spark.createDataFrame(items, "item_id string, text string")
    one = decontaminate.find_leaks(documents(rows), table).collect()
    many = decontaminate.find_leaks(documents(rows), table, block_words=200).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_pipeline_of_empty_tables(spark, tmp_path, sf_dir):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert run(spark, str(tmp_path)).collect() == []
