"""The parser and the session aggregate on Structured Streaming."""
