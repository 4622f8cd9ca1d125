"""The tables of the domain, as Spark DDL. Every table whose order means something has an order column."""

SEGMENTS = "meeting_id STRING, language STRING, segments ARRAY<STRUCT<start: DOUBLE, end: DOUBLE, text: STRING, words: ARRAY<STRUCT<start: DOUBLE, end: DOUBLE, word: STRING>>>>"
DIARIZED = "meeting_id STRING, segments ARRAY<STRUCT<start: DOUBLE, end: DOUBLE, speaker: STRING>>"
WORDS = "meeting STRING, word INT, ws DOUBLE, we DOUBLE"
TURNS = "meeting STRING, turn INT, speaker STRING, ts DOUBLE, te DOUBLE"
LINES = "meeting STRING, seq INT, start INT, end INT, speaker STRING, text STRING"
AUDIO = "project STRING, path STRING, started_at TIMESTAMP, duration DOUBLE"
SILENCES = "path STRING, duration DOUBLE, silence_start DOUBLE, silence_end DOUBLE"
ROSTER = "name STRING, department STRING, position STRING, employment_status STRING, last_confirmed STRING, source STRING"
HISTORY = "identity_key STRING, name STRING, department STRING, position STRING, employment_status STRING, first_seen STRING, last_confirmed STRING, former_since STRING, ever_authoritative BOOLEAN, sources ARRAY<STRING>"
EMPLOYEES = "identity_key STRING, name STRING, department STRING, position STRING, source STRING"
LEDGER = "variant STRING, target STRING, count INT"
PATCHES = "doc STRING, patch_idx INT, line INT, before STRING, after STRING, category STRING, confidence DOUBLE"
NOTES = "note_key STRING, text STRING"
CANDIDATES = "id STRING, speaker STRING, start_seconds DOUBLE, end_seconds DOUBLE, claim_text STRING, public_claim STRING, required_evidence STRING, checkability STRING, importance STRING, stt_risk BOOLEAN, web_search_allowed BOOLEAN"
EVIDENCE = "candidate_id STRING, verdict STRING, corrected_fact STRING, explanation STRING, error_type STRING, confidence STRING, valid_as_of STRING, sources ARRAY<STRUCT<title: STRING, url: STRING, source_type: STRING, locator: STRING, why_relevant: STRING>>"
REVIEWS = "candidate_id STRING, status STRING, explanation STRING, supporting_text STRING"
MANIFEST = "version INT, thresholds MAP<STRING, DOUBLE>, cases ARRAY<STRUCT<id: STRING, reference: STRING, hypothesis: STRING, reviewed: BOOLEAN, reviewer: STRING, evidence: STRING, critical: MAP<STRING, ARRAY<STRING>>, speaker_labels: ARRAY<STRUCT<reference: STRING, hypothesis: STRING>>>>"
JOBS = "key STRING, stage STRING, force BOOLEAN"
RECEIPTS = "key STRING, source_sha256 STRING, transcript_sha256 STRING, readable_sha256 STRING, review_artifacts MAP<STRING, STRING>"
BLOCKS = "id STRING, type STRING, properties STRING, content STRING, parent_id STRING, parent_table STRING, alive INT, created_time LONG"
PROPERTIES = "title ARRAY<ARRAY<STRING>>"
VISUALS = "kind STRING, title STRING, reason STRING, nodes ARRAY<STRUCT<id: STRING, label: STRING>>, groups ARRAY<STRUCT<label: STRING, ids: ARRAY<STRING>>>"
