"""Readers and writers of records, manifests, transcripts and reports, and seams for what lies outside Spark."""
