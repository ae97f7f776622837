"""A few hand-written job records and helpers shared by the tests."""

from gleanframe.spec import JOB_POSTING, LIST

EMPTY = {f.name: [] if f.kind == LIST else None for f in JOB_POSTING.fields}


def labels(**stated):
    return {**EMPTY, **stated}


NURSE = labels(title="Night Nurse", company="Ward Seven", location="Łódź, Poland",
               workplace_type="onsite", employment_type="part_time", salary_min=31.5,
               salary_currency="PLN", salary_period="hour", required_skills=["Triage", "CPR"],
               preferred_skills=["Polish"], min_years_experience=2.0)
CLERK = labels(title='Filing "Clerk"', required_skills=["Typing"])
RECORDS = [("r1", "Night nurse wanted.\nŁódź, 31.50/h", NURSE),
           ("r2", "Clerk \\ typist", CLERK)]


def gold_frame(spark, records=RECORDS):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("row_id", T.StringType()),
                           *JOB_POSTING.record_type().fields])
    rows = [(i, text, tuple(lab[f.name] for f in JOB_POSTING.fields)) for i, text, lab in records]
    return spark.createDataFrame(rows, schema)


def preds_frame(spark, rows):
    return spark.createDataFrame(rows, "run string, row_id string, raw_text string")


def runs_frame(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "run string")
