"""lexmill: curation, retrieval and telemetry operators over text corpora, as Spark DataFrames."""
