from basalt.sources.listing import list_files, list_lake, read_partition  # noqa: F401
from basalt.sources.readers import (  # noqa: F401
    RAW_EVENT_SCHEMA, flatten, read_csv, read_dataset, read_json_document, read_jsonl, read_logs,
    read_parquet, read_text_files,
)
