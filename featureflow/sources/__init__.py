from featureflow.sources.io import (ingest_cached, load_schema, read_csv, read_parquet, save_schema,
                                    validate_dataset, write_csv, write_parquet)

__all__ = ["ingest_cached", "load_schema", "read_csv", "read_parquet", "save_schema",
           "validate_dataset", "write_csv", "write_parquet"]
