"""tallycube: official-statistics cubes as Spark DataFrame operators."""

from tallycube.schema import CUBE_SCHEMA, METADATA_SCHEMA, POPULATION, Dims

__all__ = ["CUBE_SCHEMA", "METADATA_SCHEMA", "POPULATION", "Dims"]
