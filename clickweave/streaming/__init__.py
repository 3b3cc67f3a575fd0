from clickweave.streaming.normalise_stream import normalise_stream, start_normalise_stream  # noqa: F401
