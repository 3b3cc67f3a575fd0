from clickweave.sources.raw_log import (  # noqa: F401
    hour_range_glob, hour_range_scan, missing_hours, read_text_lines, scan_raw_log, union_logs,
)
from clickweave.sources.events_tsv import parse_events_tsv, scan_events_tsv  # noqa: F401
from clickweave.sources.documents import doc_day_glob, scan_doc_days  # noqa: F401
