"""A trained scorer as plain numbers, so that blocks can be pruned with it.

A fitted pipeline scores rows that hold all features. Kept as an intercept and a weight for
each feature, the same logistic regression becomes a column expression, and a bound:
a similarity still open counts at its upper bound where its weight is positive
and at 0 where it is negative, so no pair that could reach a score is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster.operators.records import field_present, fixed_score, with_words
from kinmaster.schema import FieldSpec


@dataclass(frozen=True)
class PairModel:
    """``similar`` and ``missing`` weigh a field's similarity and its missing flag; fields not named weigh nothing."""

    intercept: float
    similar: Mapping[str, float]
    missing: Mapping[str, float]

    @classmethod
    def of(cls, fitted: PipelineModel) -> PairModel:
        """The numbers of a pipeline fitted by ``scoring.train_scorer``."""
        assembler, regression = fitted.stages
        weights = dict(zip(assembler.getInputCols(), map(float, regression.coefficients), strict=True))

        def named(prefix: str) -> dict[str, float]:
            return {name.removeprefix(prefix): w for name, w in weights.items() if name.startswith(prefix)}

        return cls(float(regression.intercept), named("sim_"), named("missing_"))

    def weight(self, field: FieldSpec) -> float:
        return self.similar.get(field.name, 0.0)

    def base(self, fields: Sequence[FieldSpec], both: Callable[[FieldSpec], Column]) -> Column:
        """What is known of the margin before any similarity; ``both`` says whether both records have the field."""
        flags = [F.when(both(f), 0.0).otherwise(self.missing.get(f.name, 0.0)) for f in fields if f.has_missing]
        return sum(flags, F.lit(self.intercept))

    def margin(self, fields: Sequence[FieldSpec], base: Column, similarity: Callable[[FieldSpec], Column]) -> Column:
        return sum((similarity(f) * self.weight(f) for f in fields), base)

    @staticmethod
    def probability(margin: Column) -> Column:
        return 1 / (1 + F.exp(-margin))

    def score(self, fields: Sequence[FieldSpec]) -> Column:
        """Probability of a match of a row with features, six decimals."""
        base = self.base(fields, lambda f: F.col(f"missing_{f.name}") == 0)
        return F.round(self.probability(self.margin(fields, base, lambda f: F.col(f"sim_{f.name}"))), 6)

    def self_score(self, fields: Sequence[FieldSpec]) -> Column:
        """Score of a record against an exact copy of itself."""
        margin = self.margin(fields, self.base(fields, field_present), lambda f: F.when(field_present(f), 1.0).otherwise(0.0))
        return F.round(self.probability(margin), 6)


def pair_score(fields: Sequence[FieldSpec], model: PairModel | None) -> Column:
    """The model's score of a row with features, or that of the fixed weights without one."""
    return fixed_score(fields) if model is None else model.score(fields)


def with_self_score(records: DataFrame, fields: Sequence[FieldSpec], model: PairModel | None) -> DataFrame:
    """Prepared records with the self score of the scorer that is used."""
    if model is None:
        return records
    return with_words(records, fields).withColumn("self_score", model.self_score(fields)).select(*records.columns)
