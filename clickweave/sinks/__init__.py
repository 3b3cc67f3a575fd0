from clickweave.sinks.text import compact_by_size, compact_files, write_snapshot, write_text, write_tsv  # noqa: F401
