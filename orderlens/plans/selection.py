"""Feature selection as pyspark.ml Estimators.

``FeatureSelector.fit(train)`` learns column lists with a handful of
aggregate jobs over the TRAIN frame (typing, near-constant shares, one
contingency job for Cramér's V, one Pearson aggregate); the decisions are
made on metadata-sized results in the driver.  ``FeatureSelectorModel``
then applies the same choice to any frame with one ``select``, so val/test
and scoring data never see statistics of their own.  Both are persistable
(``DefaultParamsWritable``) and fit into a ``Pipeline``.
"""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators import association as A
from orderlens.operators.profile import bounded_distinct, capture_variables

log = logging.getLogger(__name__)


def _p(name, doc, conv):
    return Param(Params._dummy(), name, doc, typeConverter=conv)


# --- F4: date parts ----------------------------------------------------------

class DateFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``{c}_day_of_week`` (Monday = 0) and ``{c}_quarter``; originals dropped."""

    inputCols = _p("inputCols", "timestamp/date columns", TypeConverters.toListString)
    dropOriginal = _p("dropOriginal", "drop the source columns", TypeConverters.toBoolean)

    def __init__(self, inputCols=None, dropOriginal=True):
        super().__init__()
        self._setDefault(inputCols=[], dropOriginal=True)
        self._set(inputCols=inputCols or [], dropOriginal=dropOriginal)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = [c for c in self.getOrDefault(self.inputCols) if c in df.columns]
        out = df.withColumns({
            **{f"{c}_day_of_week": F.weekday(F.col(c)) for c in cols},
            **{f"{c}_quarter": F.quarter(F.col(c)) for c in cols}})
        return out.drop(*cols) if self.getOrDefault(self.dropOriginal) else out


def _column(columns: list[str], ref: str) -> str | None:
    """A column by name, else by position given as digits."""
    if ref in columns:
        return ref
    return columns[int(ref)] if ref.isdigit() and int(ref) < len(columns) else None


def date_feature_names(cols) -> list[str]:
    return [n for c in cols for n in (f"{c}_day_of_week", f"{c}_quarter")]


# --- F9: Cramér's V redundancy selector -----------------------------------------

class _CramerParams(Params):
    variables = _p("variables", "columns to evaluate (names)", TypeConverters.toListString)
    threshold = _p("threshold", "V at or above which a partner is redundant", TypeConverters.toFloat)
    selectionMethod = _p("selectionMethod", "first | cardinality | importance",
                         TypeConverters.toString)
    naToken = _p("naToken", "token for missing values", TypeConverters.toString)
    discreteMaxCardinality = _p("discreteMaxCardinality",
                                "numeric columns with at most this many levels are evaluated "
                                "when variables is empty", TypeConverters.toInt)
    includeDiscrete = _p("includeDiscrete", "evaluate few-level numeric columns when variables is empty",
                         TypeConverters.toBoolean)
    importance = _p("importance", "importance per variable, same order as variables",
                    TypeConverters.toListFloat)


class CramersVSelector(Estimator, _CramerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Drop categoricals that are redundant by bias-corrected Cramér's V.

    Order 'first' keeps the given order, 'cardinality' sorts by
    (levels, name), 'importance' by descending importance.  In that order a
    column stays unless one kept before it has V >= threshold.  The counts
    are exact over all rows, for any number of levels.
    """

    def __init__(self, variables=None, threshold=0.8, selectionMethod="cardinality",
                 naToken="__NA__", discreteMaxCardinality=30, importance=None, includeDiscrete=True):
        super().__init__()
        self._setDefault(variables=[], threshold=0.8, selectionMethod="cardinality", naToken="__NA__",
                         discreteMaxCardinality=30, importance=[], includeDiscrete=True)
        self._set(variables=variables or [], threshold=threshold, selectionMethod=selectionMethod,
                  naToken=naToken, discreteMaxCardinality=discreteMaxCardinality,
                  importance=importance or [], includeDiscrete=includeDiscrete)

    def resolve_variables(self, df: DataFrame) -> list[str]:
        """The named or numbered columns (F9a); without any, the text and boolean
        columns and, unless switched off, numeric ones of few levels (F9b)."""
        wanted = self.getOrDefault(self.variables)
        found = [_column(df.columns, v) for v in wanted] if wanted else self._automatic(df)
        unknown = [v for v, c in zip(wanted, found) if c is None]
        if unknown or not found:
            raise ValueError(f"no such columns: {unknown}" if unknown else
                             "no text, boolean or few-level numeric column to select from")
        return list(dict.fromkeys(found))

    def _automatic(self, df: DataFrame) -> list[str]:
        kinds = {f.name: f.dataType for f in df.schema.fields}
        text = [c for c, t in kinds.items() if isinstance(t, (T.StringType, T.BooleanType))]
        numeric = [c for c, t in kinds.items() if isinstance(t, T.NumericType)]
        if not numeric or not self.getOrDefault(self.includeDiscrete):
            return text
        most = self.getOrDefault(self.discreteMaxCardinality)
        levels = bounded_distinct(df, numeric, most)
        return text + [c for c in numeric if levels[c] <= most]

    def _order(self, df: DataFrame, variables: list[str]) -> list[str]:
        """Columns by preference: as given, fewest levels first, or most important first."""
        method, weight = self.getOrDefault(self.selectionMethod), self.getOrDefault(self.importance)
        if method == "importance" and not weight:
            raise ValueError("selection by importance needs the importance values")
        given = dict(zip(variables, weight))
        keys = {"first": lambda: variables.index,
                "cardinality": lambda: (lambda n: lambda c: (n[c], c))(
                    A.distinct_counts(df, variables, self.getOrDefault(self.naToken))),
                "importance": lambda: lambda c: -given.get(c, float("-inf"))}
        if method not in keys:
            raise ValueError(f"unknown selectionMethod {method!r}; known: {sorted(keys)}")
        return sorted(variables, key=keys[method]())

    def _fit(self, df: DataFrame) -> "CramersVSelectorModel":
        variables = self.resolve_variables(df)
        order = self._order(df, variables)
        matrix = A.cramers_v_matrix(df, variables, na_token=self.getOrDefault(self.naToken))
        assoc = {(r["var_a"], r["var_b"]): r["cramers_v"] for r in matrix.collect()}
        kept, dropped_set = A.greedy_redundancy(order, assoc, self.getOrDefault(self.threshold))
        dropped = [c for c in variables if c in set(dropped_set)]
        model = CramersVSelectorModel(featuresToDrop=dropped, featuresToKeep=kept,
                                      evaluated=variables)
        model.association_ = matrix
        return self._copyValues(model)


class CramersVSelectorModel(Model, _CramerParams, DefaultParamsReadable, DefaultParamsWritable):
    featuresToDrop = _p("featuresToDrop", "learned redundant columns", TypeConverters.toListString)
    featuresToKeep = _p("featuresToKeep", "learned kept columns", TypeConverters.toListString)
    evaluated = _p("evaluated", "evaluated columns", TypeConverters.toListString)

    def __init__(self, featuresToDrop=None, featuresToKeep=None, evaluated=None):
        super().__init__()
        self._setDefault(featuresToDrop=[], featuresToKeep=[], evaluated=[], variables=[],
                         threshold=0.8, selectionMethod="cardinality",
                         naToken="__NA__", discreteMaxCardinality=30, importance=[], includeDiscrete=True)
        self._set(featuresToDrop=featuresToDrop or [], featuresToKeep=featuresToKeep or [],
                  evaluated=evaluated or [])
        self.association_ = None

    def get_feature_names_out(self) -> list[str]:
        return list(self.getOrDefault(self.featuresToKeep))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault(self.featuresToDrop))


# --- F12: the whole chain ----------------------------------------------------------

class _SelectorParams(Params):
    labelCol = _p("labelCol", "target column (never a feature)", TypeConverters.toString)
    passthroughCols = _p("passthroughCols", "columns carried through untouched",
                         TypeConverters.toListString)
    idPattern = _p("idPattern", "lower-case substring marking ID columns", TypeConverters.toString)
    constantTol = _p("constantTol", "top-level share at which a column is near-constant",
                     TypeConverters.toFloat)
    cramerThreshold = _p("cramerThreshold", "Cramér's V redundancy threshold", TypeConverters.toFloat)
    cramerMethod = _p("cramerMethod", "Cramér's V selection order", TypeConverters.toString)
    pearsonThreshold = _p("pearsonThreshold", "|r| above which a numeric is dropped",
                          TypeConverters.toFloat)
    discreteMax = _p("discreteMax", "numeric columns with <= this many levels are categorical",
                     TypeConverters.toInt)
    pearsonAlphabetical = _p("pearsonAlphabetical", "scan Pearson candidates by name",
                             TypeConverters.toBoolean)


_SEL_DEFAULTS = dict(labelCol="label", passthroughCols=[], idPattern="_id", constantTol=0.95,
                     cramerThreshold=0.8, cramerMethod="first", pearsonThreshold=0.8,
                     discreteMax=5, pearsonAlphabetical=True)


class FeatureSelector(Estimator, _SelectorParams, DefaultParamsReadable, DefaultParamsWritable):
    """dates -> drop IDs -> near-constant -> Cramér's V -> Pearson, fitted on TRAIN.

    Discrete numerics (<= ``discreteMax`` levels) are treated as categorical
    (F2).  Candidate lists are intersected with the columns that survive
    the previous step (a near-constant categorical no longer breaks the
    Cramér step).
    """

    def __init__(self, **kwargs):
        super().__init__()
        self._setDefault(**_SEL_DEFAULTS)
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> "FeatureSelectorModel":
        g = self.getOrDefault
        label, passthrough = g(self.labelCol), set(g(self.passthroughCols))
        feats = [c for c in df.columns if c != label and c not in passthrough]
        if not feats:
            raise ValueError("no input columns")
        train = df.select(*feats).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if train.isEmpty():
                raise ValueError("training frame is empty")
            continuous, categoricals, discretes, temporal = capture_variables(
                train, g(self.discreteMax))
            categoricals = categoricals + discretes  # F2
            new_dates = date_feature_names(temporal)
            categoricals = categoricals + new_dates
            ids = [c for c in feats if g(self.idPattern) in c.lower()]
            report = {"date_features": new_dates, "ids": ids}
            work = DateFeatures(inputCols=temporal).transform(train).drop(*ids)

            const_vars = [c for c in continuous + categoricals if c not in ids]
            const_drop = []
            if const_vars:
                nc = A.near_constant(work, const_vars, g(self.constantTol)).collect()
                const_drop = [r["variable"] for r in nc if r["drop"]]
                if len(const_drop) == len(work.columns):
                    raise ValueError("every feature is near-constant")
            report["near_constant"] = const_drop
            alive = [c for c in work.columns if c not in const_drop]

            cats = [c for c in categoricals if c in alive and c not in ids]
            cramer_drop = []
            if len(cats) >= 2:
                sel = CramersVSelector(variables=cats, threshold=g(self.cramerThreshold),
                                       selectionMethod=g(self.cramerMethod)).fit(
                    work.select(*cats))
                cramer_drop = sel.getOrDefault(sel.featuresToDrop)
            report["cramers_v"] = cramer_drop
            alive = [c for c in alive if c not in cramer_drop]

            nums = [c for c in continuous if c in alive and c not in ids]
            if g(self.pearsonAlphabetical):
                nums = sorted(nums)
            pearson_drop = []
            if len(nums) >= 2:
                mat = A.pearson_matrix(work, nums).collect()
                corr = {(r["var_a"], r["var_b"]): r["pearson"] for r in mat}
                pearson_drop, _ = A.greedy_correlated(nums, corr, g(self.pearsonThreshold))
            report["pearson"] = pearson_drop
            alive = [c for c in alive if c not in pearson_drop]
        finally:
            train.unpersist()
        model = FeatureSelectorModel(dateCols=temporal, outputCols=alive,
                                     categoricalCols=[c for c in alive if c in categoricals],
                                     continuousCols=[c for c in alive if c in continuous])
        model.report_ = report
        log.info("feature selection: %s", report)
        return self._copyValues(model)


class FeatureSelectorModel(Model, _SelectorParams, DefaultParamsReadable, DefaultParamsWritable):
    dateCols = _p("dateCols", "timestamp columns expanded to parts", TypeConverters.toListString)
    outputCols = _p("outputCols", "selected feature columns in order", TypeConverters.toListString)
    categoricalCols = _p("categoricalCols", "selected categorical features",
                         TypeConverters.toListString)
    continuousCols = _p("continuousCols", "selected continuous features",
                        TypeConverters.toListString)

    def __init__(self, dateCols=None, outputCols=None, categoricalCols=None, continuousCols=None):
        super().__init__()
        self._setDefault(dateCols=[], outputCols=[], categoricalCols=[], continuousCols=[],
                         **_SEL_DEFAULTS)
        self._set(dateCols=dateCols or [], outputCols=outputCols or [],
                  categoricalCols=categoricalCols or [], continuousCols=continuousCols or [])
        self.report_ = None

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        out = DateFeatures(inputCols=g(self.dateCols)).transform(df)
        keep = list(g(self.outputCols))
        missing = [c for c in keep if c not in out.columns]
        if missing:
            raise KeyError(f"missing feature columns: {missing}")
        extra = [c for c in [*g(self.passthroughCols), g(self.labelCol)]
                 if c in out.columns and c not in keep]
        return out.select(*extra, *keep)
