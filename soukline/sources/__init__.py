from .files import (csv_scan, document_scan, json_scan, land_documents, parquet_scan,
                    write_csv)
from .tables import (append_new_keys, merge_partitions, read_table, read_table_or_none,
                     table_exists, truncate, versions, write_version)

__all__ = ["csv_scan", "document_scan", "land_documents", "json_scan", "parquet_scan", "write_csv", "append_new_keys",
           "merge_partitions", "read_table", "read_table_or_none", "table_exists",
           "truncate", "versions", "write_version"]
