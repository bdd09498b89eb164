from pyspark.sql import functions as F

from llm.cases import frame
from shopgrain.llm import mixing as M


def test_marginals_meet_their_targets(spark):
    rows = [("a", "en", 100), ("a", "fr", 10), ("b", "en", 30), ("b", "fr", 60), (None, "en", 5), ("c", None, 9)]
    cells = spark.createDataFrame(rows, "source string, lang string, weight bigint")
    targets = {
        "source": spark.createDataFrame([("a", .5), ("b", .3), (None, .1), ("c", .1)], "source string, target double"),
        "lang": spark.createDataFrame([("en", .6), ("fr", .3), (None, .1)], "lang string, target double")}
    fitted = M.rake(cells, ["source", "lang"], targets, 40)
    total = fitted.agg(F.sum("fitted")).first()[0]
    for d, t in targets.items():
        want = {r[0]: r[1] for r in t.collect()}
        for r in fitted.groupBy(d).agg(F.sum("fitted").alias("w")).collect():
            assert abs(r["w"] / total - want[r[0]]) < 1e-3


def test_sample_moves_the_mix_towards_the_target(spark):
    rows = [(i, "w " * 10, "en", "big" if i % 10 else "small", 0) for i in range(4000)]
    docs = frame(spark, rows).withColumn("n_words", M.tokens(F.col("text")))
    drawn = M.sample(docs, ["source"], power=0.5)
    share = {r["source"]: r["count"] for r in drawn.groupBy("source").count().collect()}
    assert share["small"] == 400  # the rarest is taken whole
    assert abs(share["big"] - 1200) < 120
    assert drawn.exceptAll(M.sample(docs, ["source"], power=0.5)).count() == 0


def test_odd_rows(spark):
    docs = frame(spark).withColumns({"n_words": M.tokens(F.col("text")), "topic": M.topic(F.col("text")),
                                     "inclusion": F.lit("clash")})
    got = M.inclusion(docs, ["source", "lang", "topic"]).collect()
    assert len(got) == docs.count() and all(0 <= r["inclusion"] <= 1 for r in got)
    assert max(r["inclusion"] for r in got) == 1
    nothing = docs.limit(0)
    assert M.sample(nothing, ["source"]).count() == 0
    assert M.inclusion(docs.where("text = ''"), ["source"]).count() == 1
