"""callweave: call analytics as Spark DataFrame plans.

Flattens landed call-feed pages, keeps the recorded calls, finds the ones
that still lack audio or a transcript, appends them to a history table,
selects the calls of a target account cohort, numbers them per account,
bundles their transcripts into ordered per-account texts, builds the
model-request tables for translation and summary, merges the responses
back by key and publishes a per-account dimension table.

Every operator takes and returns DataFrames and runs nothing by itself;
the end-to-end plans write the tables that several steps read.
"""

__version__ = "0.1.0"
