"""Relational operators over tables of records, annotations and transcripts."""
