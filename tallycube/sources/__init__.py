from tallycube.sources.sinks import append_rules, publish_release, read_release, write_cube, write_release, write_report, write_version
from tallycube.sources.tables import literal_table, read_cube, read_rules, read_table
from tallycube.sources.wide import (
    discover_columns,
    files_by_role,
    read_folder,
    read_typed,
    read_wide,
    role_from_path,
    role_of,
    section_of,
)

__all__ = [
    "append_rules",
    "discover_columns",
    "files_by_role",
    "literal_table",
    "publish_release",
    "read_cube",
    "read_folder",
    "read_release",
    "read_rules",
    "read_table",
    "read_typed",
    "read_wide",
    "role_from_path",
    "role_of",
    "section_of",
    "write_cube",
    "write_release",
    "write_report",
    "write_version",
]
