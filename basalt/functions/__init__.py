from basalt.functions.scalars import (  # noqa: F401
    basename, extension, human_size, human_size_short, json_key_preview, readable, short_id,
    size_mb, supported, text_preview, timestamp_text, truncate_head, truncate_tail, type_label,
)
