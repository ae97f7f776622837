"""Spark operators for the data side of structured extraction.

Labelled records in, repeatable splits, chat rows and prompts out; model answers
in as a table, strict JSON parsing, field scores and run comparisons out.
"""

from gleanframe.spec import JOB_POSTING, Field, RecordSpec

__all__ = ["JOB_POSTING", "Field", "RecordSpec"]
