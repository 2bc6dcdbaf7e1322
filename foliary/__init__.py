"""Document-record analytics on Spark: records, annotations, transcripts and their corpus-wide operators as DataFrames."""
