from silvermill.sources.bronze import (
    SEQ,
    list_parts,
    read_each_part,
    read_parts,
    with_part_seq,
)
from silvermill.sources.csv import ingest_csv, push_then_pull, read_csv, read_quoted_csv, write_csv
from silvermill.sources.listing import list_objects, objects_with_prefix, read_if_exists
from silvermill.sources.local import local_rows
from silvermill.sources.snapshot import write_snapshot

__all__ = [
    "SEQ",
    "ingest_csv",
    "list_objects",
    "list_parts",
    "local_rows",
    "objects_with_prefix",
    "push_then_pull",
    "read_csv",
    "read_each_part",
    "read_if_exists",
    "read_parts",
    "read_quoted_csv",
    "with_part_seq",
    "write_csv",
    "write_snapshot",
]
