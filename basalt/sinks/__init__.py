from basalt.sinks.writers import (  # noqa: F401
    export_filtered_csv, export_snapshot, save_result, write_csv, write_parquet, write_partitioned, write_text_files,
)
