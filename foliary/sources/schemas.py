"""Schemas of what the engine reads."""

MANIFEST = """source STRING, asset STRING, asset_hash STRING, detected_type STRING, fetch_method STRING, fetched_at STRING, fetched_url STRING, source_url STRING,
    source_id STRING, original_type STRING, title STRING, posted_by STRING, posted_date STRING, publisher STRING, date_published STRING, duration DOUBLE, creators ARRAY<STRING>,
    description STRING, copyright_status STRING, error STRING, snapshots ARRAY<STRUCT<path: STRING, extension: STRING, content_type: STRING, role: STRING, hash: STRING>>"""
WORD = "STRUCT<word: STRING, start: DOUBLE, end: DOUBLE, score: DOUBLE>"
TRACK = "STRUCT<start: DOUBLE, end: DOUBLE, speaker: STRING, track: STRING>"
TRANSCRIPT = f"""schema STRING, meta MAP<STRING, STRING>, whisperx STRUCT<language: STRING, aligned: STRUCT<segments: ARRAY<STRUCT<text: STRING, start: DOUBLE, end: DOUBLE, words: ARRAY<{WORD}>>>>>,
    pyannote STRUCT<model: STRING, tracks: ARRAY<{TRACK}>, exclusive_tracks: ARRAY<{TRACK}>>, reviewed_words MAP<STRING, STRING>"""
