"""Readers and writers: CSV / JSON / Parquet datasets, SQL dumps, raw-file manifests."""

from zonelake.sources.io import (  # noqa: F401
    SUPPORTED_FORMATS, create_table_as, describe, drop_table, preview, publish, read_dataset, show_tables,
    write_dataset,
)
from zonelake.sources.sqldump import read_sql_dump, write_sql_dump  # noqa: F401
from zonelake.sources.binary import file_manifest  # noqa: F401
