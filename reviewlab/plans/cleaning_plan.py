"""An ordered list of cleaning steps, folded into one projection wherever possible."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.functions.cleaning import COLUMN_STEPS, ColumnStep
from reviewlab.operators.normalization import normalize_terms, normalize_terms_pos

# Steps that look words up in a table: their names stay, the table is the caller's.
DICTIONARY_STEPS = ("stem", "stem_snowball", "lemmatize", "lemmatize_simple")


@dataclass(frozen=True)
class CleaningPlan:
    """`forms` maps a dictionary step to its table of normal forms.

    `lemmatize` needs annotations of the text as it stands when the step is reached; they come from
    `annotate`, a function `(df, text column) -> annotations`. Without it the step uses the words
    alone. A step without a table leaves the text as it is (only spacing between tokens changes).
    """

    steps: tuple[str, ...] = tuple(fv.DEFAULT_STEPS)
    forms: dict[str, DataFrame] = field(default_factory=dict)
    annotate: object = None
    custom: dict[str, ColumnStep] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "steps", tuple(self.steps))
        for name in self.steps:
            self._check(name)

    def _check(self, name: str) -> None:
        if name not in COLUMN_STEPS and name not in DICTIONARY_STEPS and name not in self.custom:
            raise ValueError(f"Unknown preprocessing step: {name}")

    def add_step(self, name: str, position: int | None = None) -> CleaningPlan:
        steps = list(self.steps)
        steps.insert(len(steps) if position is None else position, name)
        return replace(self, steps=tuple(steps))

    def remove_step(self, name: str) -> CleaningPlan:
        steps = list(self.steps)
        if name in steps:
            steps.remove(name)
        return replace(self, steps=tuple(steps))

    def with_step(self, name: str, step: ColumnStep) -> CleaningPlan:
        """Register a step of the caller, usable by name."""
        return replace(self, custom={**self.custom, name: step})

    def apply(self, df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
        for name in self.steps:
            if name in DICTIONARY_STEPS:
                df = self._normalize(df, name, text, key)
            else:
                step = self.custom.get(name) or COLUMN_STEPS[name]
                df = df.withColumn(text, step(F.col(text)))
        return df

    def _normalize(self, df: DataFrame, name: str, text: str, key: str) -> DataFrame:
        mapping = self.forms.get(name)
        if mapping is None:
            return df
        if name == "lemmatize" and self.annotate is not None:
            return normalize_terms_pos(df, self.annotate(df, text), mapping, text, key)
        if "pos_class" in mapping.columns:
            mapping = mapping.where(F.col("pos_class") == fv.DEFAULT_POS_CLASS)
        return normalize_terms(df, mapping, text, key)
