from .raw import Loaded, RawTables, load_raw, read_raw
from .sinks import (
    counted, mart_view, publish_table, read_published, replace_partitions, versions, write_bucketed, write_counted,
    write_table,
)
from .staging import (
    delete_folder, in_rounds, release, shuffles_removed, stage, stage_rounds, staging_root, temporary_stages,
)

__all__ = [
    "Loaded", "RawTables", "counted", "delete_folder", "in_rounds", "load_raw", "mart_view", "publish_table", "read_published",
    "read_raw", "release", "replace_partitions", "shuffles_removed", "stage", "stage_rounds", "staging_root",
    "temporary_stages", "versions", "write_bucketed", "write_counted", "write_table",
]
