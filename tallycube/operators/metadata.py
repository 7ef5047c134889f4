"""Observation metadata: where a figure comes from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycube.functions import release_text
from tallycube.operators.joins import apart
from tallycube.operators.reshape import with_row_id
from tallycube.schema import (
    FEMALE,
    MALE,
    METADATA_ELEMENT,
    METADATA_KIND,
    METADATA_LANGUAGE,
    POPULATION,
    RURAL,
    TOTAL,
    URBAN,
    Dims,
)

# Metadata texts. Totals and sexes come from one publication, urban and rural from another.
PROSPECTS = "WPP-"
URBANIZATION = "WUP-"
TEXT_PROJECTION = ". Medium fertility variant "
TEXT_RESIDUAL = "Residual variable aggregating unreported areas"


def source_texts(
    cube: DataFrame, prospects_year: int, urbanization_year: int, residual_codes: DataFrame, dims: Dims = POPULATION
) -> DataFrame:
    """Keys with Metadata_Value for the operational cube.

    Residual areas come first, then projections (years after the release), then the publication.
    """
    marks = apart(residual_codes.select(F.col("code").alias(dims.area)).distinct(), dims.area).withColumn("_residual", F.lit(True))
    text = (
        F.when(F.col("_residual"), TEXT_RESIDUAL)
        .when(F.col(dims.year) > prospects_year, f"{PROSPECTS}{prospects_year}{TEXT_PROJECTION}")
        .when(F.col(dims.element).isin(TOTAL, MALE, FEMALE), f"{PROSPECTS}{prospects_year}")
        .when(F.col(dims.element).isin(RURAL, URBAN), f"{URBANIZATION}{urbanization_year}")
    )
    return cube.select(*dims.keys).join(marks, dims.area, "left").select(*dims.keys, text.alias("Metadata_Value"))


def release_texts(
    cube: DataFrame, prospects: str, urbanization: str, variant: str = "Variant", dims: Dims = POPULATION
) -> DataFrame:
    """Keys with Metadata_Value for an imported cube: release and, if there is one, the variant."""
    release: Column = F.when(F.col(dims.element).isin(TOTAL, MALE, FEMALE), prospects).when(
        F.col(dims.element).isin(RURAL, URBAN), urbanization
    )
    text = F.when(release.isNotNull(), release_text(release, F.col(variant)))
    return cube.select(*dims.keys, text.alias("Metadata_Value"))


def build_metadata(texts: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    """Full metadata rows, numbered in key order."""
    rows = with_row_id(texts, [*dims.keys, "Metadata_Value"], "Metadata_Group")
    return rows.select(
        *dims.keys,
        F.lit(METADATA_KIND).alias("Metadata"),
        F.lit(METADATA_ELEMENT).alias("Metadata_Element"),
        F.lit(METADATA_LANGUAGE).alias("Metadata_Language"),
        "Metadata_Group",
        "Metadata_Value",
    )
