"""Profiling (D*), splitting (B11), running totals, cleaning edge rules."""

import math

import pytest

import pandas as pd
from pyspark.sql import functions as F

from quarry.operators import clean, profile
from quarry.operators.split import hash_split
from quarry.plans.prefix import running_totals


def test_missing_null_vs_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r["column"]: r["missing"] for r in profile.missing_counts(df).collect()}
    assert got == {"x": 2, "s": 1}
    got = {r["column"]: r["missing"] for r in profile.missing_counts(df, nan=False).collect()}
    assert got == {"x": 1, "s": 1}
    assert clean.drop_nulls(df).count() == 1


def test_histogram_constant_and_top_edge(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    h = {(r["column"], r["bin"]): r["count"] for r in profile.histogram(df, ["x", "c"], bins=2).collect()}
    assert h == {("x", 0): 1, ("x", 1): 2, ("c", 0): 3}


def test_correlation_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 1.0)], "x double, label double")
    assert profile.label_correlation(df, ["x"]).first()["correlation"] == 0.0


def test_duplicates_groups_vs_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "a int")
    r = profile.duplicate_summary(df).first()
    assert (r["rows"], r["distinct_rows"], r["duplicate_rows"], r["duplicate_groups"]) == (6, 3, 3, 2)


def test_hash_split_disjoint_complete_and_stable(spark):
    df = spark.range(2000).withColumn("k", F.col("id").cast("string"))
    a, b = hash_split(df, F.col("k"), (0.8, 0.2))
    ids_a = {r[0] for r in a.select("id").collect()}
    ids_b = {r[0] for r in b.select("id").collect()}
    assert not ids_a & ids_b and len(ids_a | ids_b) == 2000
    assert 0.75 < len(ids_a) / 2000 < 0.85
    a2, _ = hash_split(df.repartition(7), F.col("k"), (0.8, 0.2))
    assert {r[0] for r in a2.select("id").collect()} == ids_a


def test_running_totals_match_pandas_with_hot_value(spark):
    rows = [(i, 5 if i % 3 == 0 else i % 17, (i * 7) % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s long, v long").repartition(6)
    out = running_totals(df, [F.desc("s"), F.asc("id")], {"v": F.col("v")}, num_partitions=9).toPandas()
    pdf = pd.DataFrame(rows, columns=["id", "s", "v"]).sort_values(["s", "id"], ascending=[False, True])
    pdf["cum"] = pdf["v"].cumsum()
    merged = out.merge(pdf, on="id")
    assert (merged["cum_v"] == merged["cum"]).all()


def test_running_totals_grouped(spark):
    rows = [(g, i, 1) for g in range(3) for i in range(100)]
    df = spark.createDataFrame(rows, "g int, i int, v int")
    out = running_totals(df, [F.asc("i")], {"v": F.col("v")}, group=["g"], max_groups=3, num_partitions=4)
    assert all(r["cum_v"] == r["i"] + 1 for r in out.collect())


def test_quantiles_exact_at_high_accuracy(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    r = profile.quantile_summary(df, ["x"], accuracy=1_000_000).first()
    assert (r["min"], r["q25"], r["q50"], r["q75"], r["max"]) == (1.0, 25.0, 50.0, 75.0, 100.0)
    assert math.isclose(profile.feature_summary(df, ["x"]).first()["mean"], 50.5)


def test_string_index_of_many_labels(spark):
    from quarry.functions.scale import fit_string_index, string_index_table

    rows = [(f"v{i % 10_001}",) for i in range(20_002)] + [("v1",)] * 5 + [(None,)]
    df = spark.createDataFrame(rows, "s string")
    idx = fit_string_index(df, "s")
    assert idx.n_labels == 10_001
    table = {r["s"]: r["index"] for r in string_index_table(df, "s").collect()}
    joined = {r["s"]: r["ix"] for r in idx.transform(df, "ix").collect()}
    assert table["v1"] == 0.0 and joined[None] == 10_001.0
    assert all(joined[k] == v for k, v in table.items())
    unseen = spark.createDataFrame([("new",), ("v1",)], "s string")
    assert sorted(r["ix"] for r in idx.transform(unseen, "ix").collect()) == [0.0, 10_001.0]
    assert [r["s"] for r in idx.transform(unseen, "ix", "skip").collect()] == ["v1"]


def test_running_totals_of_null_and_nan_groups(spark):
    from quarry.plans.prefix import running_totals

    nan = float("nan")
    rows = [(g, i) for g in (None, nan, 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "g double, i int").repartition(5)
    for local in ("arrow", "window"):
        out = running_totals(df, [F.col("i")], {"n": F.lit(1)}, group=["g"], num_partitions=7, local=local).collect()
        assert len(out) == 900
        assert all(r["cum_n"] == r["i"] + 1 for r in out)


def test_assembly_raises_on_missing_features(spark):
    from quarry.operators import library

    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    with pytest.raises(Exception, match="(?i)null|NaN"):
        library.assemble(df, ["x"]).collect()
    assert library.assemble(library.complete_rows(df, ["x"]), ["x"]).count() == 1


def test_correlation_stable_for_large_means(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=2000)
    y = (x + rng.normal(size=2000) > 0).astype(float)
    shifted = x + 1e9  # raw moments would cancel; centred ones do not
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(shifted, y)], "x double, label double")
    got = profile.label_correlation(df, ["x"]).first()["correlation"]
    assert math.isclose(got, float(np.corrcoef(x, y)[0, 1]), rel_tol=1e-6)


def test_range_partitions_balanced_with_hot_score(spark):
    from pyspark.sql import functions as F

    rows = [(0.5 if i % 3 == 0 else (i % 997) / 997.0, f"k{i:06d}") for i in range(30000)]
    df = spark.createDataFrame(rows, "p double, key string")
    sizes = [r[1] for r in df.repartitionByRange(10, F.desc("p"), F.asc("key"))
             .groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * (30000 / 10)  # the hot third is spread over several ranges


def test_xxhash_split_disjoint_complete(spark):
    df = spark.range(3000).withColumn("k", F.col("id").cast("string"))
    a, b = hash_split(df, F.col("k"), (0.7, 0.3), method="xxhash64")
    na, nb = a.count(), b.count()
    assert na + nb == 3000 and 0.65 < na / 3000 < 0.75
    assert a.join(b, "id").count() == 0


def test_exact_quantiles_match_sorted_ranks(spark):
    import random

    rnd = random.Random(5)
    xs = [float(rnd.randint(0, 50)) for _ in range(997)] + [7.0] * 500  # a hot value
    df = spark.createDataFrame([(x, -x) for x in xs], "a double, b double")
    got = {r["column"]: r for r in profile.exact_quantiles(df, ["a", "b"]).collect()}
    for col, vals in (("a", sorted(xs)), ("b", sorted(-x for x in xs))):
        n = len(vals)
        for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
            assert got[col][name] == vals[max(1, math.ceil(q * n)) - 1]
        assert got[col]["min"] == vals[0] and got[col]["max"] == vals[-1]


def test_running_totals_local_modes_agree(spark):
    rows = [(g, i, (i * 13) % 7) for g in range(4) for i in range(2500)]
    df = spark.createDataFrame(rows, "g int, i int, v long").repartition(5)
    a = running_totals(df, [F.desc("i")], {"v": F.col("v")}, group=["g"], max_groups=4, local="arrow")
    b = running_totals(df, [F.desc("i")], {"v": F.col("v")}, group=["g"], max_groups=4, local="window")
    ra = sorted((r["g"], r["i"], r["cum_v"]) for r in a.collect())
    rb = sorted((r["g"], r["i"], r["cum_v"]) for r in b.collect())
    assert ra == rb
    pdf = pd.DataFrame(rows, columns=["g", "i", "v"]).sort_values(["g", "i"], ascending=[True, False])
    pdf["cum"] = pdf.groupby("g")["v"].cumsum()
    assert sorted(zip(pdf["g"], pdf["i"], pdf["cum"])) == ra
