"""Clean-up of raw tables: names, strings, missing values, repeats and samples."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurepipe.functions.names import unique_names
from featurepipe.operators.profile import null_counts
from featurepipe.sources.staging import materialize, temporary_tables
from featurepipe.sources.writers import write_parquet


def orderable(kind: T.DataType) -> bool:
    """Whether Spark can compare values of a type: not where a map or variant is anywhere inside."""
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def rename_columns(frame: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Give every column a normalised, unique name; also returns old name -> new name."""
    names = unique_names(frame.columns)
    return frame.toDF(*names), dict(zip(frame.columns, names))


def trim_strings(frame: DataFrame) -> DataFrame:
    """Strip spaces (only spaces) from both ends of every string column, in one projection."""
    return frame.select(
        *[
            F.trim(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in frame.schema.fields
        ]
    )


def drop_missing_required(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows where any of the columns is NULL or NaN."""
    columns = list(columns)
    return frame.dropna(how="any", subset=columns) if columns else frame


def high_null_columns(frame: DataFrame, max_null_ratio: float = 0.95) -> list[dict]:
    """Columns whose share of NULLs is above the limit, with that share. One pass over the frame."""
    rows, nulls = null_counts(frame)
    ratios = {c: n / max(rows, 1) for c, n in nulls.items()}
    return [
        {"column": c, "reason": "high_null_ratio", "null_ratio": r} for c, r in ratios.items() if r > max_null_ratio
    ]


def drop_columns(frame: DataFrame, dropped: list[dict]) -> DataFrame:
    gone = {d["column"] for d in dropped}
    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if c not in gone])


def drop_duplicate_rows(frame: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows. Copies collapse inside each task before the shuffle."""
    return frame.dropDuplicates()


def drop_duplicates_by_key(
    frame: DataFrame, keys: list[str], order_by: list[Column | str] | None = None
) -> DataFrame:
    """Keep the first row of each key in the given order; ties are settled by the remaining columns.

    Only rows that are equal in every orderable column can tie, so the result does
    not depend on how the data was split. The rank filter is a plain
    ``row_number() = 1``: Spark then also limits each task to one row per key before
    the shuffle, so a key with a large share of the rows sends one row per task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by or []]
    tiebreak = [F.col(f.name) for f in frame.schema.fields if f.name not in keys and orderable(f.dataType)]
    window = Window.partitionBy(*keys).orderBy(*order, *tiebreak)
    rank = "__row_number"
    return frame.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)


def bernoulli_sample(frame: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Keep each row with the given chance, independently. Which rows depends on how the input is split."""
    return frame.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(frame: DataFrame, keys: list[str], fraction: float) -> DataFrame:
    """Keep the rows whose key hash is below the fraction: the same rows on every run and every layout."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    position = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    return frame.where(position < F.lit(int(fraction * (1 << 32))))


def project_features(
    frame: DataFrame,
    features: list[str],
    label: str,
    keep_columns: Iterable[str] = (),
    drop_null: bool = False,
    sample_fraction: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """The training matrix: kept columns, features and label; optionally only complete rows, optionally a sample."""
    if not features:
        raise ValueError("No feature columns were given or selected.")
    matrix = frame.select(*dict.fromkeys([*keep_columns, *features, label]))
    if drop_null:
        matrix = matrix.dropna(subset=[*features, label])
    if sample_fraction is not None:
        matrix = bernoulli_sample(matrix, sample_fraction, seed)
    return matrix


def resolve_features(features: list[str] | None, feature_log: dict | None) -> list[str]:
    """The explicit list if there is one, else the features a selection log names."""
    if features:
        return list(features)
    if feature_log is None:
        raise ValueError("Give feature columns or a feature log.")
    selected = feature_log.get("selected_features") or []
    if not selected:
        raise ValueError("The feature log selects no features.")
    return list(selected)


@dataclass
class CleanConfig:
    required_columns: list[str] = field(default_factory=list)
    drop_duplicates: bool = False
    dedupe_keys: list[str] = field(default_factory=list)
    dedupe_order: list[str] = field(default_factory=list)
    max_null_ratio: float = 0.95


@dataclass
class CleanReport:
    renamed: dict[str, str]
    dropped: list[dict]


def clean(frame: DataFrame, config: CleanConfig | None = None, uri: str | None = None) -> tuple[DataFrame, CleanReport]:
    """Rename, trim, drop incomplete rows, drop repeats, then drop columns that are nearly all NULL.

    The table is written once, to ``uri`` or a staging table, and its null shares are counted on that, after the repeats
    are gone. Only if a column must go from a table at ``uri`` is it written again.
    """
    config = config or CleanConfig()
    frame, renamed = rename_columns(frame)
    frame = drop_missing_required(trim_strings(frame), config.required_columns)
    if config.drop_duplicates:
        if config.dedupe_keys:
            frame = drop_duplicates_by_key(frame, config.dedupe_keys, config.dedupe_order)
        else:
            frame = drop_duplicate_rows(frame)
    spark = frame.sparkSession
    if uri:
        write_parquet(frame, uri)
        frame = spark.read.schema(frame.schema).parquet(uri)
    else:
        frame = materialize(frame, "clean")
    dropped = high_null_columns(frame, config.max_null_ratio)
    result = drop_columns(frame, dropped)
    if dropped and uri:
        with temporary_tables(spark):
            write_parquet(materialize(result, "narrowed"), uri)
        result = spark.read.schema(result.schema).parquet(uri)
    return result, CleanReport(renamed, dropped)
