"""Cleaning and typing of measurements, links and sites."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverload.fixed_values import (
    PARAM_FLOW, PARAM_VOLUME, POLLUTANTS, REMARK_NOT_DONE, RESULT_KEYS, UNIT_FLOW, VOLUME_POINTS,
)
from riverload.functions.columns import classify, decimal_comma, paste, site_type
from riverload.functions.joins import null_safe_join


def to_date(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the time of day; text that is no date becomes null."""
    return df.withColumns({c: F.col(c).try_cast("date") for c in columns})


def parse_decimal_comma(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: decimal_comma(c) for c in columns})


def recode_ordered(df: DataFrame, column: str, labels: dict[str, str]) -> DataFrame:
    """Recode an ordered category; other values become null.

    The order of ``labels`` is the order of the category, kept in
    ``<column>_rang`` (1 = first) for sorting.
    """
    ordinals = {old: str(i) for i, old in enumerate(labels, start=1)}
    return df.withColumns({
        column: classify(F.col(column), labels),
        f"{column}_rang": classify(F.col(column), ordinals).cast("int"),
    })


def fill_from_lookup(
    df: DataFrame, lookup: DataFrame, key: str, column: str,
    lookup_key: str, lookup_column: str, order: str,
) -> DataFrame:
    """Fill a missing ``column`` with the first value, by ``order``, of the row's key.

    Missing keys never match here.
    """
    first = (lookup.where(F.col(lookup_key).isNotNull())
             .groupBy(lookup_key)
             .agg(F.min(F.struct(F.col(order), F.col(lookup_column).alias("value"))).alias("_first")))
    return (null_safe_join(df, first, [(key, lookup_key)], "left")
            .withColumn(column, F.coalesce(F.col(column), F.col("_first.value")))
            .drop("_first"))


def duplicate_report(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """All rows whose key occurs more than once, with ``dupe_count``; missing keys are equal.

    Keys are counted before the shuffle and joined back: a window would bring
    every copy of one key into one task.
    """
    keys = list(keys)
    repeated = (df.groupBy(*keys).agg(F.count("*").alias("dupe_count"))
                .where(F.col("dupe_count") > 1))
    rest = [c for c in df.columns if c not in keys]
    return null_safe_join(df, repeated, keys).select(*keys, "dupe_count", *rest)


def keep_latest(
    df: DataFrame, keys: Iterable[str] = RESULT_KEYS, timestamp: str = "Date_depot",
    tiebreak: Iterable[str] | None = None,
) -> DataFrame:
    """Per key the row with the newest ``timestamp`` (missing last).

    Ties are broken on ``tiebreak``, by default all other columns, so the result
    does not depend on file order. The rank filter runs before the shuffle too:
    each task sends at most one row per key.
    """
    keys = list(keys)
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c != timestamp]
    order = [F.desc_nulls_last(c) for c in [timestamp, *tiebreak]]
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def drop_not_done(df: DataFrame) -> DataFrame:
    """Drop analyses that were not done, and those without remark code."""
    return df.where(F.col("Code_remarque") != REMARK_NOT_DONE)


def recode_volume(df: DataFrame) -> DataFrame:
    """Volume to daily flow at the listed points, then the flow unit on every flow row.

    The unit rule has to see the recoded parameter, hence two steps.
    """
    volume = (F.col("Code_sandre_parametre") == PARAM_VOLUME) & F.col("Pt_SANDRE").isin(*VOLUME_POINTS)
    recoded = df.withColumn(
        "Code_sandre_parametre",
        F.when(volume, PARAM_FLOW).otherwise(F.col("Code_sandre_parametre")))
    return recoded.withColumn(
        "Code_unite",
        F.when(F.col("Code_sandre_parametre") == PARAM_FLOW, UNIT_FLOW)
        .otherwise(F.col("Code_unite")))


def distinct_parameters(df: DataFrame) -> DataFrame:
    return df.select("Code_sandre_parametre").distinct()


def distinct_parameter_units(df: DataFrame) -> DataFrame:
    return df.select("Code_sandre_parametre", "Code_unite").distinct()


def station_list(df: DataFrame) -> DataFrame:
    """Station code of every row, repeats included."""
    return df.select("Code_SANDRE")


def prepare_links(df: DataFrame) -> DataFrame:
    """Links upstream -> downstream with the pair of their site types."""
    return (df.drop("Liaison_Sitou-Amont")
            .withColumn("liaison", paste(site_type("No_Sitou_Am"), site_type("No_Sitou"), sep="-"))
            .distinct())


def prepare_nodes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, name, type) and the office of each id."""
    nodes = df.select(F.col("No_Sitou").alias("identifiant"), "Nom_Sitou", "No_Type_Sitou")
    offices = df.select("DT", F.col("No_Sitou").alias("identifiant"))
    return nodes, offices


def parameter_dimension(df: DataFrame) -> DataFrame:
    """The nine pollutants, one row per code, hence at most nine rows."""
    attributes = [c for c in df.columns if c != "Code_sandre_parametre"]
    kept = df.where(F.col("Code_sandre_parametre").isin(*POLLUTANTS))
    if not attributes:
        return kept.distinct()
    return (kept.groupBy("Code_sandre_parametre")
            .agg(F.min(F.struct(*attributes)).alias("_first"))
            .select("Code_sandre_parametre", "_first.*"))


def clean_measures(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Newest deposit per result, done analyses only, corrected flow codes.

    ``by`` adds columns, such as the kind of structure, whose values are
    cleaned apart from each other.
    """
    return recode_volume(drop_not_done(keep_latest(df, [*by, *RESULT_KEYS])))
