"""Joins with a hot key give the rows of a plain join, without dealing them by the key."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from proxysift.llm import common, ngram_join, span_dedup


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [5, 10_000])
def test_join_spread(spark, monkeypatch, how, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    rows = spark.range(600).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 50 = 1 THEN NULL ELSE id END").alias("key"))
    facts = rows.where("key % 2 = 1").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
    found = common.join_spread(rows, facts, "key", how)
    plain = rows.join(facts.drop("n"), "key", how)
    assert found.columns == plain.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    if hot == 5:
        assert "LeftAnti" in found._jdf.queryExecution().toString()


def test_join_spread_without_facts(spark):
    rows = spark.range(3).select("id", F.col("id").alias("key"))
    facts = rows.limit(0).select("key", F.lit(1).alias("n"), F.lit(2).alias("last"))
    assert common.join_spread(rows, facts, "key").collect() == []
    assert common.join_spread(rows, facts, "key", "left").count() == 3


def test_hot_passages_and_groups_give_the_same_result(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    passage = "One sentence that stands in many places. Another one that follows it there. And a third one to end the passage. "
    docs = docs.unionByName(spark.range(10_000, 10_060).select(
        F.col("id").alias("doc_id"), F.concat(F.lit(passage), F.col("id").cast("string")).alias("text")
    ))

    def results() -> list[list[str]]:
        frames = (span_dedup.without_repeated_spans(docs), ngram_join.similar_components(docs))
        return [sorted(map(str, frame.collect())) for frame in frames]

    plain = results()
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(common, "HOT_PARTS", 1_000_000)
    assert results() == plain


def test_search_by_root_finds_every_pair(monkeypatch):
    rng = np.random.default_rng(11)
    names = ("node", "size", "place", "root", "block")
    for share in (0.0, 0.6, 0.97, 1.0):
        size = rng.integers(20, 40, 150)
        cell = {"node": np.arange(150), "size": size, "place": rng.integers(0, 6, 150), "block": rng.integers(0, 2, 150)}
        cell["root"] = np.where(rng.random(150) < share, 1, rng.integers(2, 9, 150))
        for crossing in (False, True):
            expected = set()
            for a in range(150):
                for b in range(a):
                    one, two = ({name: int(cell[name][x]) for name in names} for x in (a, b))
                    need = ngram_join.required(one["size"], two["size"], 85)
                    similar = min(one["size"], two["size"]) * 100 >= 85 * max(one["size"], two["size"])
                    left = min(x["size"] - x["place"] for x in (one, two)) >= need
                    if similar and left and one["root"] != two["root"] and not (crossing and one["block"] == two["block"]):
                        expected.add((b, a))
            for large in (10, 10_000):
                monkeypatch.setattr(ngram_join, "_LARGE", large)
                assert set(ngram_join._search(cell, crossing, 85, None)) == expected
