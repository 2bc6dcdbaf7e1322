"""Intake as a stream. The batch operators are the reference; this is an extension."""
