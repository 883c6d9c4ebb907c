"""Streaming forms of the stateless line operators."""

from keyline.streaming.lines import split_stream, stream_lines, stream_records, write_line_stream

__all__ = ["stream_lines", "stream_records", "split_stream", "write_line_stream"]
