"""The preparation chain from CSV files to the discretised table, plans, sources and sinks."""

import os
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from millrace.functions.columns import ref
from millrace.plans.stages import clean_roster, prepare
from millrace.plans.supervised import experiment
from millrace.session import collect_small, materialize, scratch, shared_dir
from millrace.sources.tables import preview, profile, read_table, write_table


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    root, rng = tmp_path_factory.mktemp("sources"), random.Random(13)
    names = [f"Player {i}" for i in range(120)]
    with open(root / "players.csv", "w") as f:
        f.write("Player,height,weight,born\n")
        for i, n in enumerate(names):
            f.write(f"{n},{rng.choice(['', 180 + i % 30])},{rng.choice(['', 70 + i % 40])},{1950 + i % 40}\n")
    with open(root / "player_data.csv", "w") as f:
        f.write("name,year_start,year_end,height,weight,birth_date,college\n")
        for i, n in enumerate(names[20:]):
            f.write(f"{n.upper()} ,{1970 + i % 20},{1980 + i % 20},{5 + i % 2}-{i % 12},{150 + i},\"June {i % 28 + 1}, 1968\",{rng.choice(['', 'X', 'Y'])}\n")
    with open(root / "seasons.csv", "w") as f:
        f.write("Year,Player,Pos,Age,PTS,TRB,AST,PER,blanl,blank2\n")
        for i in range(2500):
            pts = rng.gauss(500, 150)
            f.write(f"{1990 + i % 20},{rng.choice(names)},{rng.choice(['PF-C', 'C', 'SG', ''])},{20 + i % 18},{pts:.2f},{rng.gauss(100, 20):.2f},{rng.choice(['', f'{rng.gauss(50, 9):.2f}'])},{pts / 30 + rng.gauss(0, 6):.3f},,\n")
    return root


def test_whole_chain(spark, sources, tmp_path):
    before = set(os.listdir(shared_dir(spark)))
    paths = prepare(
        spark, f"{sources}/players.csv", f"{sources}/player_data.csv", f"{sources}/seasons.csv", str(tmp_path / "out")
    )
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert {r["table"]: r["n"] for r in tables["row_counts"].collect()}["clean_seasons"] == tables["clean_seasons"].count()
    assert tables["missing_seasons"].filter("missing > 0").count() > 0
    assert tables["correlations"].count() > 0 and tables["component_variance"].count() > 0
    assert set(os.listdir(shared_dir(spark))) == before
    seasons = tables["clean_seasons"]
    assert "blanl" not in seasons.columns
    assert {r[0] for r in seasons.select("Pos").distinct().collect()} == {"PF", "C", "SG", "Unknown"}
    assert seasons.filter("AST is null").count() == 0
    assert tables["clean_player_data"].filter("height_in is null").count() == 0
    joined = tables["integrated"]
    assert joined.count() == seasons.count() and "name_norm" in joined.columns
    reduced = tables["reduced"]
    assert "PC1" in reduced.columns
    transformed = tables["transformed"]
    assert {"PC1_minmax", "PC1_standard"} <= set(transformed.columns)
    assert any(c.endswith("_index_onehot") for c in transformed.columns)
    final = tables["discretized"]
    assert final.count() == transformed.count()
    assert {r[0] for r in final.select("player_cluster").distinct().collect()} <= {0, 1, 2, 3}
    assert any(c.endswith("_equal_width") for c in final.columns) and any(c.endswith("_quantile") for c in final.columns)

    out = experiment(transformed, "logistic", targets=("ss_PER",))
    assert out.results.first()["accuracy"] > 0.6


def test_a_scope_deletes_what_it_stored(spark):
    kept = materialize(spark.range(2))
    with scratch(spark):
        assert materialize(spark.range(3)).count() == 3
        inside = set(os.listdir(shared_dir(spark)))
    assert len(inside - set(os.listdir(shared_dir(spark)))) == 1 and kept.count() == 2


def test_a_wide_table_is_not_small(spark):
    wide = spark.range(2000).select(*[F.lit("x").alias(f"c{i}") for i in range(200)])
    assert collect_small(wide) is None and len(collect_small(wide.limit(100))) == 100


def test_roster_date_column(spark):
    df = spark.sql("SELECT 'a' AS name, CAST(NULL AS DATE) AS birth_date, '6-2' AS height, 1 AS w")
    row = clean_roster(df).first()
    assert str(row["birth_date"]) == "1900-01-01" and row["height_in"] == 74.0


def test_csv_holds_vectors_as_text(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "id int, a array<double>").withColumn("v", array_to_vector("a"))
    write_table(df, str(tmp_path / "c"), "csv")
    assert read_table(spark, str(tmp_path / "c")).first()["v"] == "[1.0,2.0]"
    write_table(df, str(tmp_path / "p"))
    assert dict(read_table(spark, str(tmp_path / "p"), "parquet").dtypes)["v"] == "array<double>"


def test_write_overwrites_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 3):
        write_table(spark.range(n).withColumn("g", F.col("id") % 2), path, partition_by=["g"])
    assert read_table(spark, path, "parquet").count() == 3


def test_profile_and_preview(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, `x%` string")
    assert tuple(profile(df).first()) == (2, 2)
    assert preview(df, 1, ["id"]).first()["x%"] == "a"
    assert df.select(ref("x%")).columns == ["x%"]


def test_shared_dir_and_small_tables(spark):
    assert materialize(spark.range(3)).count() == 3
    assert shared_dir(spark) == shared_dir(spark)
    assert collect_small(spark.range(5), 4) is None
    assert len(collect_small(spark.range(4), 4)) == 4
    assert collect_small(spark.createDataFrame([("x" * 2000,)], "s string")) is None


NATIVE = [
    "fill_strings", "parse_length", "fill_date", "strip_suffix", "normalize_key", "impute_mean", "zscore_filter",
    "histogram", "kde_grid", "left_join", "integrate", "minmax_scale", "string_index", "one_hot", "quantile_bins",
    "label_above_mean", "split_two_way", "linear_score", "roc_curve", "box_summary", "scale_pixels", "path_label",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_plans_stay_in_the_jvm_and_never_cross(spark, sf_dir, name):
    text = plan(spark_entry.queries()[name](spark, sf_dir))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize("name", ["split_two_way", "linear_score", "minmax_scale", "fill_strings", "scale_pixels"])
def test_row_operators_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(spark_entry.queries()[name](spark, sf_dir))


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan(spark_entry.queries()["split_two_way"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text
    text = plan(spark_entry.queries()["zscore_filter"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
