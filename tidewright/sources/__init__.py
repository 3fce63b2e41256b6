"""Readers, writers and versioned Parquet tables."""

from tidewright.sources.readers import changed_between, open_tables, read_documents, read_people, read_table
from tidewright.sources.partitioned import FILE, PartitionedTable
from tidewright.sources.scratch import Scratch, materialize, scratch_path
from tidewright.sources.versioned import VersionedTable
from tidewright.sources.writers import batch_writer, check_schema, conform, register_table, write_chunks, write_csv

__all__ = [
    "FILE",
    "PartitionedTable",
    "Scratch",
    "VersionedTable",
    "batch_writer",
    "changed_between",
    "check_schema",
    "conform",
    "materialize",
    "open_tables",
    "read_documents",
    "read_people",
    "read_table",
    "register_table",
    "scratch_path",
    "write_chunks",
    "write_csv",
]
