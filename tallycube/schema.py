"""Names, codes and column types of the observation cube."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

# Element codes, flags and metadata constants of the data model.
TOTAL = "511"
MALE = "512"
FEMALE = "513"
RURAL = "551"
URBAN = "561"
ELEMENTS = (TOTAL, MALE, FEMALE, RURAL, URBAN)
ELEMENT_OF_ROLE = {
    "total": "511",
    "male": "512",
    "female": "513",
    "urban": "561",
    "rural": "551",
}
FLAG_IMPORTED = "X"
FLAG_MISSING = "O"
METHOD_IMPORTED = "h"
METHOD_AGGREGATE = "x"
METADATA_KIND = "GENERAL"
METADATA_ELEMENT = "COMMENT"
METADATA_LANGUAGE = "en"
WORLD_GROUP = "953"
ADHOC_CODE = "AH01"
RESIDUAL_SUFFIX = ".01"
FIRST_YEAR = 1950

# Exact type for observations, so sums do not depend on the order of the rows; wide enough for the
# total of a very large table in one cell.
VALUE_TYPE = T.DecimalType(28, 6)
# Factors keep eighteen decimals, more than a double tells; one that does not fit is an error, see operators/groups.py.
FACTOR_TYPE = T.DecimalType(23, 18)


@dataclass(frozen=True)
class Dims:
    """Column names of one dataset; `item` and the flags are optional."""

    area: str = "geographicAreaM49"
    element: str = "measuredElement"
    year: str = "timePointYears"
    value: str = "Value"
    status: str | None = "flagObservationStatus"
    method: str | None = "flagMethod"
    flag: str | None = None
    item: str | None = None

    @property
    def keys(self) -> list[str]:
        return [c for c in (self.area, self.element, self.item, self.year) if c]

    @property
    def flags(self) -> list[str]:
        return [c for c in (self.status, self.method, self.flag) if c]

    @property
    def columns(self) -> list[str]:
        return [*self.keys, self.value, *self.flags]

    @staticmethod
    def discover(columns: Sequence[str], value: str = "Value") -> Dims:
        """Find the dimensions of a dataset from name patterns.

        Two flag columns are a status and a method flag, a single one stands alone.
        """
        flags = [c for c in columns if re.search("flag", c, re.IGNORECASE)]
        pair = len(flags) == 2
        status = next((c for c in flags if re.search("status", c, re.IGNORECASE)), None)
        return Dims(
            area=dim_name(columns, "geog"),
            element=dim_name(columns, "element"),
            year=dim_name(columns, "years"),
            item=dim_name(columns, "item", required=False),
            value=value,
            status=status if pair else None,
            method=next((c for c in flags if c != status), None) if pair else None,
            flag=flags[0] if len(flags) == 1 else None,
        )


def dim_name(columns: Sequence[str], pattern: str, required: bool = True) -> str | None:
    """The one column whose name matches `pattern`, ignoring case."""
    found = [c for c in columns if re.search(pattern, c, re.IGNORECASE)]
    if len(found) > 1 or (required and not found):
        raise ValueError(f"expected one column like {pattern!r}, found {found}")
    return found[0] if found else None


POPULATION = Dims()

CUBE_SCHEMA = T.StructType(
    [
        T.StructField("geographicAreaM49", T.StringType()),
        T.StructField("measuredElement", T.StringType()),
        T.StructField("timePointYears", T.IntegerType()),
        T.StructField("Value", VALUE_TYPE),
        T.StructField("flagObservationStatus", T.StringType()),
        T.StructField("flagMethod", T.StringType()),
    ]
)

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("geographicAreaM49", T.StringType()),
        T.StructField("measuredElement", T.StringType()),
        T.StructField("timePointYears", T.IntegerType()),
        T.StructField("Metadata", T.StringType()),
        T.StructField("Metadata_Element", T.StringType()),
        T.StructField("Metadata_Language", T.StringType()),
        T.StructField("Metadata_Group", T.LongType()),
        T.StructField("Metadata_Value", T.StringType()),
    ]
)
