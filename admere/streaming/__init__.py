"""Structured Streaming forms of the event, session and restatement steps."""
