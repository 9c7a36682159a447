"""The five preparation stages.

Each stage is a function from tables to tables. Where a stage needs statistics
of a shuffled input, the input is written to the shared folder first, so the
shuffle runs once and the statistics passes read only the columns they need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import (
    categorical_columns,
    constant_columns,
    drop_constant_columns,
    drop_if_present,
    numeric_columns,
    ref,
)
from millrace.functions.scalars import UNKNOWN_DATE, fill_date, parse_length_inches, strip_suffix
from millrace.operators.binning import BINS, equal_width_bins, quantile_bins
from millrace.operators.cleaning import (
    dedup_rows,
    fill_strings,
    fill_values,
    fit_means,
    impute_mean,
    missing_profile,
    sample_rows,
    zscore_filter,
)
from millrace.operators.clustering import CLUSTERS, kmeans_assign
from millrace.operators.encoding import encode
from millrace.operators.joins import PLACEHOLDER_KEYS, integrate
from millrace.operators.scaling import scale_all
from millrace.operators.stats import (
    correlation_matrix,
    pca_fit,
    pca_project,
    pca_variance,
    prune_correlated,
)
from millrace.plans.supervised import derived_from
from millrace.session import materialize, scratch
from millrace.sources.tables import read_table, write_table

# Columns and counts the stages work with.
EMPTY_COLUMNS = ("blanl", "blank2")
OUTLIER_COLUMNS = ("PTS", "TRB", "AST", "Age")
POSITION_COLUMN = "Pos"
HEIGHT_COLUMN = "height"
DATE_COLUMN = "birth_date"


def clean_roster(df: DataFrame) -> DataFrame:
    """Distinct rows with text filled, height in inches, numbers and dates filled."""
    rows = materialize(dedup_rows(df), "distinct-roster")
    if HEIGHT_COLUMN in rows.columns:
        rows = rows.withColumn("height_in", parse_length_inches(ref(HEIGHT_COLUMN)))
    rows = impute_mean(fill_strings(rows, skip=(HEIGHT_COLUMN,)))
    if dict(rows.dtypes).get(DATE_COLUMN) == "date":
        rows = rows.withColumn(DATE_COLUMN, fill_date(ref(DATE_COLUMN), UNKNOWN_DATE))
    return rows


def clean_seasons(df: DataFrame, outlier_columns: Sequence[str] = OUTLIER_COLUMNS) -> DataFrame:
    """Distinct rows with text and numbers filled, first position only, outliers cut."""
    rows = materialize(drop_if_present(dedup_rows(df), EMPTY_COLUMNS), "distinct-seasons")
    rows = fill_values(fill_strings(rows, skip=()), fit_means(rows))
    if POSITION_COLUMN in rows.columns:
        rows = rows.withColumn(POSITION_COLUMN, strip_suffix(ref(POSITION_COLUMN)))
    return zscore_filter(rows, [c for c in outlier_columns if c in rows.columns])


def integrate_stage(
    seasons: DataFrame,
    players: DataFrame,
    player_data: DataFrame,
    names: tuple[str, str, str] = ("Player", "Player", "name"),
    placeholder_keys: Sequence[str] = PLACEHOLDER_KEYS,
) -> DataFrame:
    """The joined table without constant and redundant numeric columns."""
    joined = materialize(
        integrate(seasons, players, player_data, names, placeholder_keys), "integrated"
    )
    varied = drop_constant_columns(joined)
    return prune_correlated(varied)


def reduce_stage(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Gaps filled, constant and redundant columns dropped, principal components added.

    The columns in ``keep``, such as a target and a row key, pass through as they are and
    have no share in the components.
    """
    open_columns = [c for c in numeric_columns(df) if c not in keep]
    filled = impute_mean(df, open_columns)
    constant = constant_columns(filled, open_columns)
    varied = drop_if_present(filled, constant)
    kept = prune_correlated(varied, [c for c in open_columns if c not in constant])
    cols = [c for c in numeric_columns(kept) if c not in keep]
    return pca_project(kept, cols, pca_fit(kept, cols)) if cols else kept


def transform_stage(
    df: DataFrame, categories: Sequence[str] | None = None, sparse: bool = True
) -> DataFrame:
    """Both scalings of all numbers, index and one-hot of the categories, by default all.

    Rows with a missing number are dropped.
    """
    chosen = categorical_columns(df) if categories is None else list(categories)
    return encode(scale_all(df, numeric_columns(df)), chosen, sparse=sparse)


def discretize_stage(
    df: DataFrame,
    key: str | None = None,
    share: float = 1.0,
    rel_error: float = 0.0,
    width: Sequence[str] | None = None,
    quantiles: Sequence[str] | None = None,
    clusters: Sequence[str] | None = None,
    targets: Sequence[str] = (),
) -> DataFrame:
    """Equal-width bins, quantile bins and cluster numbers, by default of all numbers.

    ``share`` below 1 bins a sample. The targets are binned but never clustered on.
    """
    rows = materialize(sample_rows(df, share, key), "sampled") if share < 1 else df
    numbers = [c for c in numeric_columns(rows) if c != key]
    binned = equal_width_bins(rows, numbers if width is None else width, BINS)
    binned = quantile_bins(binned, numbers if quantiles is None else quantiles, BINS, rel_error)
    free = [c for c in numbers if not any(derived_from(c, t) for t in targets)]
    return kmeans_assign(binned, free if clusters is None else clusters, CLUSTERS, out="player_cluster")


def prepare(
    spark: SparkSession,
    players: str,
    player_data: str,
    seasons: str,
    out: str,
    fmt: str = "csv",
    out_fmt: str = "parquet",
    keep: Sequence[str] = (),
) -> dict[str, str]:
    """All stages from three source tables to stage folders below ``out``; returns their paths.

    ``keep`` names targets and keys of the joined table that no other column is made from.
    Beside the stages it writes their side tables: row counts, missing values, correlations
    and the variance of the components. Intermediate tables are deleted stage by stage.
    """
    paths = {}

    def stage(name: str, make: Callable[..., DataFrame], *tables: DataFrame, **options) -> DataFrame:
        paths[name] = f"{out.rstrip('/')}/{name}"
        with scratch(spark):
            write_table(make(*tables, **options), paths[name], out_fmt)
        return read_table(spark, paths[name], out_fmt)

    roster_a = stage("clean_players", clean_roster, read_table(spark, players, fmt))
    roster_b = stage("clean_player_data", clean_roster, read_table(spark, player_data, fmt))
    rows = stage("clean_seasons", clean_seasons, read_table(spark, seasons, fmt))
    joined = stage("integrated", integrate_stage, rows, roster_a, roster_b)
    reduced = stage("reduced", reduce_stage, joined, keep=keep)
    transformed = stage("transformed", transform_stage, reduced)
    stage("discretized", discretize_stage, transformed, targets=keep)

    # What the drawings and reports of the single stages are made from.
    cleaned = {"clean_players": roster_a, "clean_player_data": roster_b, "clean_seasons": rows}
    counts = [df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n")) for name, df in cleaned.items()]
    stage("row_counts", lambda: reduce(DataFrame.unionByName, counts))
    stage("missing_seasons", missing_profile, read_table(spark, seasons, fmt))
    numbers = [c for c in numeric_columns(joined) if c not in keep]
    stage("correlations", correlation_matrix, joined, numbers)
    parts = [c for c in numeric_columns(reduced) if c not in keep and not c.startswith("PC")]
    if parts:
        stage("component_variance", lambda: pca_variance(reduced, pca_fit(reduced, parts)))
    return paths
