import math
import random

from pyspark.sql import functions as F

from sluice.llm import mixture

COUNTS = "document long, source string, tokens long"


def data(spark):
    random.seed(8)
    rows = [(n, random.choice(["a", "a", "a", "b", "c", None, "unwanted"]), random.randint(0, 30)) for n in range(900)]
    targets = spark.createDataFrame([("a", 0.2, 1), ("b", 0.5, 2), ("c", 0.2, 4), ("none", 0.1, 5), ("zero", 0.0, 1), ("odd", None, None)], "source string, target_share double, max_repeats int")
    return rows, spark.createDataFrame(rows, COUNTS), targets


def test_copies(spark):
    rows, counts, targets = data(spark)
    plan = {r["source"]: r["copies"] for r in mixture.plan_mix(counts, targets).collect()}
    total = sum(t for _, _, t in rows)
    of = lambda s: sum(t for _, x, t in rows if x == s)
    assert math.isclose(plan["a"], 0.2 * total / of("a")) and plan["b"] == 2.0 and plan["none"] == plan["zero"] == plan["odd"] == 0.0
    sampled = mixture.sample(counts, mixture.plan_mix(counts, targets), seed=3).collect()
    caps = {"a": 1, "b": 2, "c": 4}
    assert all(1 <= r["copies"] <= caps[r["source"]] for r in sampled)
    for s in caps:
        n = sum(x == s for _, x, _ in rows)
        assert abs(sum(r["copies"] for r in sampled if r["source"] == s) - n * plan[s]) < 1 + 1e-6
    again = mixture.sample(counts.repartition(7), mixture.plan_mix(counts, targets), seed=3).collect()
    assert sorted(map(tuple, sampled)) == sorted(map(tuple, again))
    other = mixture.sample(counts, mixture.plan_mix(counts, targets), seed=4).collect()
    assert sorted(map(tuple, sampled)) != sorted(map(tuple, other))


def test_tokens_are_the_expected(spark):
    """Size classes keep tokens, not only copies, within the largest document and the width of a class."""
    rng = random.Random(9)
    rows = [(n, "s", int(2 ** rng.uniform(0, 11))) for n in range(400)] + [(n, "t", rng.choice([0, 5, 900])) for n in range(400, 600)]
    counts = spark.createDataFrame(rows, COUNTS)
    for rate in (0.1, 0.37, 1.6):
        plan = spark.createDataFrame([("s", rate), ("t", rate)], "source string, copies double")
        for seed in range(3):
            got = {r["source"]: r["n"] for r in mixture.sample(counts, plan, seed).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("n")).collect()}
            for s in "st":
                own = [t for _, x, t in rows if x == s]
                assert abs(got[s] - rate * sum(own)) <= max(own) + 0.045 * rate * sum(own)


def test_report(spark):
    rows, counts, targets = data(spark)
    documents = counts.select(F.col("document").alias("doc_id"), "source", F.expr("CASE WHEN tokens = 0 THEN NULL ELSE repeat('word ', int(tokens)) END").alias("text")).withColumn("tokens", F.lit("clash"))
    mixed, report = mixture.mix(documents, targets)
    got = {r["source"]: r for r in report.collect()}
    assert {s for s, r in got.items() if r["short"]} == {"b", "none"} | ({"c"} if 4 * got["c"]["tokens"] < got["c"]["target_tokens"] else set())
    assert got["b"]["mixed_tokens"] == 2 * got["b"]["tokens"] and math.isclose(sum(r["actual_share"] for r in got.values()), 1.0)
    for r in got.values():
        assert (r["most_total"] is None) == (r["target_share"] == 0) and (r["most_total"] is None or math.isclose(r["most_total"], r["max_repeats"] * r["tokens"] / r["target_share"]))
    assert mixed.select("document").distinct().count() == mixed.count()


def test_empty(spark):
    _, counts, targets = data(spark)
    nothing = spark.createDataFrame([], "doc_id long, source string, text string")
    mixed, report = mixture.mix(nothing, targets)
    assert mixed.count() == 0 and report.where("short").count() == 0 and report.count() == 6
    assert mixture.mix(nothing, targets.limit(0))[1].count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([(1, "s", "Hello world"), (2, None, None), (3, "s", ""), (4, "s", "<|endoftext|>"), (5, "s", "a" * 100_000)], "doc_id long, source string, text string")
    got = {r["document"]: r["tokens"] for r in mixture.token_counts(df).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1 and got[5] > 1000
