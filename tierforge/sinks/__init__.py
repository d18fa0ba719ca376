from tierforge.sinks.layers import preview, publish_table, write_layer
from tierforge.sinks.versions import current_version, merge_latest, read_version, vacuum_versions, write_version

__all__ = [
    "current_version",
    "merge_latest",
    "preview",
    "publish_table",
    "read_version",
    "vacuum_versions",
    "write_layer",
    "write_version",
]
