"""Declared shape of the record that is extracted from a text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, NUMBER, LIST = "string", "number", "list"

_SPARK_TYPES = {
    STRING: T.StringType(),
    NUMBER: T.DoubleType(),
    LIST: T.ArrayType(T.StringType()),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = STRING
    nullable: bool = True
    domain: tuple[str, ...] = ()

    def prompt_type(self) -> str:
        """The field's type as the system prompt words it."""
        if self.kind == LIST:
            return "string[]"
        options = [f'"{v}"' for v in self.domain] or [self.kind]
        return "|".join(options + (["null"] if self.nullable else []))


@dataclass(frozen=True)
class RecordSpec:
    fields: tuple[Field, ...]
    text_column: str = "posting"
    prompt_head: str = ""
    prompt_tail: str = ""

    @property
    def scalars(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.kind != LIST)

    @property
    def lists(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.kind == LIST)

    def labels_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, _SPARK_TYPES[f.kind]) for f in self.fields])

    def record_type(self) -> T.StructType:
        return T.StructType([
            T.StructField(self.text_column, T.StringType()),
            T.StructField("labels", self.labels_type()),
        ])

    def system_prompt(self) -> str:
        lines = ",\n".join(f'  "{f.name}": {f.prompt_type()}' for f in self.fields)
        return f"{self.prompt_head}\n{{\n{lines}\n}}\n{self.prompt_tail}"


# Field names, enum domains and prompt wording of the job posting task.
JOB_POSTING = RecordSpec(
    fields=(
        Field("title", nullable=False),
        Field("company"),
        Field("location"),
        Field("workplace_type", domain=("remote", "hybrid", "onsite")),
        Field("employment_type",
              domain=("full_time", "part_time", "contract", "internship", "temporary")),
        Field("seniority",
              domain=("intern", "junior", "mid", "senior", "lead", "manager", "executive")),
        Field("salary_min", NUMBER),
        Field("salary_max", NUMBER),
        Field("salary_currency"),
        Field("salary_period", domain=("year", "month", "week", "day", "hour")),
        Field("required_skills", LIST, nullable=False),
        Field("preferred_skills", LIST, nullable=False),
        Field("min_years_experience", NUMBER),
        Field("education"),
    ),
    prompt_head=(
        "You extract structured data from job postings.\n"
        "Return ONLY a single JSON object, no prose, matching exactly this schema:"
    ),
    prompt_tail="Use null when a field is not stated. Do not invent values.",
)
