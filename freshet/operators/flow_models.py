"""Yearly flow models: one expression with optional terms, driven by a registry.

    c_t = intercept + a1 P_t + carbon_t + a4 R_t
    y_t = c_t                              or, with autocorrelation,
    y_t = c_t + a2 (y_{t-1} - mu),  y_0 = mu

``intercept`` is ``a0``, or ``a0_d`` / ``a0_n`` in and out of drought. ``carbon`` is
``a3_intercept S`` or ``a3_slope P S`` with ``S = max(0, CO2 - a5)``. ``mu`` is the mean of
``intercept + a1 P`` over the segment.

Models without autocorrelation are a column of each row. With it, a row maps the deviation from ``mu`` before it to its own,
which is an affine map; maps of neighbouring rows compose to one. A segment is dealt in pieces: each piece composes its maps,
the pieces' maps are applied in order, and each piece then runs from where the one before it ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.maths import clamp_below_zero
from freshet.functions.nulls import strict_mean
from freshet.operators.reshape import unique_cell
from freshet.session import stored

# Name parts, parameter names in order, trailing parameters of a fitted set.
PREFIX = "streamflow_model_"
MODEL_PARAMETERS = ("a0", "a0_d", "a0_n", "a1", "a2", "a3_intercept", "a3_slope", "a4", "a5")

#: Values that one inner fold of the autoregression gathers.
BLOCK = 64
#: Steps of the order that a piece of a segment spans.
PIECE = 4096
INPUTS = ("precipitation", "is_drought_year", "CO2", "seasonal_ratio")


@dataclass(frozen=True)
class FlowModel:
    name: str
    has_drought: bool
    co2: str  # "none", "intercept" or "slope"
    has_ratio: bool
    has_auto: bool

    @property
    def parameters(self) -> list[str]:
        used = {
            "a0": not self.has_drought,
            "a0_d": self.has_drought,
            "a0_n": self.has_drought,
            "a1": True,
            "a2": self.has_auto,
            "a3_intercept": self.co2 == "intercept",
            "a3_slope": self.co2 == "slope",
            "a4": self.has_ratio,
            "a5": self.co2 != "none",
        }
        return [p for p in MODEL_PARAMETERS if used[p]]


def _build(has_drought: bool, co2: str, has_ratio: bool, has_auto: bool) -> FlowModel:
    words = ["drought"] if has_drought else []
    words += ["precip"] if co2 == "none" else [f"{co2}_shifted_CO2"]
    words += ["seasonal_ratio"] if has_ratio else []
    words += ["auto"] if has_auto else []
    if co2 == "none" and not has_ratio and not has_auto:
        words.append("only")
    return FlowModel(PREFIX + "_".join(words), has_drought, co2, has_ratio, has_auto)


ALL_MODELS = tuple(
    _build(*features) for features in product((False, True), ("none", "intercept", "slope"), (False, True), (False, True))
)
NON_DROUGHT_MODELS = tuple(m for m in ALL_MODELS if not m.has_drought)
DROUGHT_MODELS = tuple(m for m in ALL_MODELS if m.has_drought)


def registry(spark: SparkSession, models: Sequence[FlowModel] = ALL_MODELS) -> DataFrame:
    """One row per model (at most 24): its features and its parameters in order."""
    return spark.createDataFrame(
        [(m.name, m.has_drought, m.co2, m.has_ratio, m.has_auto, m.parameters) for m in models],
        "streamflow_model string, has_drought boolean, co2_term string, has_ratio boolean, has_auto boolean, "
        "parameters array<string>",
    )


def without_carbon(parameters: DataFrame) -> DataFrame:
    """Counterfactual parameters: every ``a3`` parameter is 0."""
    switched = F.when(F.col("parameter").contains("a3"), F.lit(0.0)).otherwise(F.col("parameter_value"))
    return parameters.withColumn("parameter_value", switched)


def bind_parameters(parameters: DataFrame, keys: Sequence[str] = ("gauge",)) -> DataFrame:
    """One row per key: model features, parameters by name, transform parameter.

    Input rows are ``keys, streamflow_model, parameter_index, parameter, parameter_value``. The
    second-last parameter of a set is the transform's. A missing model or parameter fails.
    """
    name, value = F.col("parameter"), F.col("parameter_value")
    named = [unique_cell(name == p, value, p).alias(p) for p in MODEL_PARAMETERS]
    ordered = F.array_sort(F.collect_list(F.struct("parameter_index", "parameter_value")))
    sets = parameters.groupBy(*keys, "streamflow_model").agg(
        *named,
        F.element_at(ordered, -2)["parameter_value"].alias("transform_parameter"),
    )
    bound = sets.join(F.broadcast(registry(parameters.sparkSession)), "streamflow_model", "left")
    return bound.withColumns({p: _required(p) for p in MODEL_PARAMETERS}).drop("parameters")


def _required(parameter: str) -> Column:
    value = F.col(parameter)
    unknown = F.raise_error(F.concat(F.lit("unknown model "), F.col("streamflow_model")))
    absent = F.raise_error(F.concat(F.lit(f"no value of {parameter} for "), F.col("streamflow_model")))
    return (
        F.when(F.col("parameters").isNull(), unknown)
        .when(value.isNull() & F.array_contains("parameters", parameter), absent)
        .otherwise(value)
    )


def _terms(row: Callable[[str], Column] = F.col) -> tuple[Column, Column]:
    """``(base, full)``: intercept + rain, and the same with carbon and season terms. ``row`` names an input of a row."""
    rain, drought = row("precipitation"), row("is_drought_year")
    by_drought = F.when(drought, F.col("a0_d")).when(~drought, F.col("a0_n"))
    base = F.when(F.col("has_drought"), by_drought).otherwise(F.col("a0")) + F.col("a1") * rain
    excess = clamp_below_zero(row("CO2") - F.col("a5"))
    carbon = (
        F.when(F.col("co2_term") == "intercept", F.col("a3_intercept") * excess)
        .when(F.col("co2_term") == "slope", F.col("a3_slope") * rain * excess)
        .otherwise(F.lit(0.0))
    )
    season = F.when(F.col("has_ratio"), F.col("a4") * row("seasonal_ratio")).otherwise(F.lit(0.0))
    return base, base + carbon + season


def _absent(keys: Sequence[str]) -> Column:
    return F.raise_error(F.concat_ws(" ", F.lit("no parameters for"), *[F.col(k).cast("string") for k in keys]))


def score(
    rows: DataFrame,
    bound: DataFrame,
    keys: Sequence[str],
    segment: Sequence[str],
    order: str = "year",
    carry: Sequence[str] = (),
    missing: str = "error",
    models: Sequence[FlowModel] = ALL_MODELS,
    piece: int = PIECE,
) -> DataFrame:
    """Score every row with the model of its key; returns the rows with ``transformed_streamflow``.

    ``segment`` names the columns that identify one contiguous segment (they include ``keys``
    where a key has several parameter sets). A segment holds at most one row per step of ``order``,
    a whole number, so a piece of ``piece`` steps is a short array. A key without parameters is an
    error, or keeps its rows without a flow when ``missing`` is ``"keep"``.

    Rows with their terms are written once and read by kind. Those without autocorrelation are
    not moved again. ``models`` that are all of one kind leave the other kind out of the plan; a
    row of another model is then an error.
    """
    if missing not in ("error", "keep"):
        raise ValueError(f"missing is error or keep, not {missing}")
    base, full = _terms()
    if missing == "error":
        full = F.when(F.col("has_auto").isNull(), _absent(keys)).otherwise(full)
    else:
        full, base = (F.when(F.col("has_auto").isNotNull(), c) for c in (full, base))
    kinds = {m.has_auto for m in models}
    if len(kinds) == 1:
        other = F.raise_error(F.concat(F.lit("not one of the models: "), F.col("streamflow_model")))
        full = F.when(F.col("has_auto") == (not kinds.copy().pop()), other).otherwise(full)
    fields = [order, *[c for c in carry if c != order]]
    ready = rows.join(bound, list(keys), "left").withColumns({"__base": base, "__c": full})
    if kinds == {False}:
        return ready.select(*segment, "transform_parameter", *fields, F.col("__c").alias("transformed_streamflow"))
    needed = dict.fromkeys([*segment, *fields, "has_auto", "a2", "transform_parameter", "__base", "__c"])
    auto = F.coalesce(F.col("has_auto"), F.lit(False))
    if kinds == {False, True}:
        ready = stored(ready.select(*needed), "terms")
    record = F.struct(*fields, "__c")
    pieces = ready.where(auto).groupBy(*segment, F.floor(F.col(order) / piece).alias("__piece")).agg(
        F.array_sort(F.collect_list(record)).alias("__rows"),
        F.sum("__base").alias("__sum"),
        F.count("__base").alias("__known"),
        F.count(F.lit(1)).alias("__n"),
        F.first("a2").alias("a2"),
        F.first("transform_parameter").alias("transform_parameter"),
    )
    found = _flows(pieces, segment, fields)
    if kinds == {True} and missing == "error":
        return found
    plain = ready.where(~auto).select(*segment, "transform_parameter", *fields, F.col("__c").alias("transformed_streamflow"))
    return plain.unionByName(found)


def score_sets(
    rows: DataFrame,
    bound: DataFrame,
    keys: Sequence[str],
    sets: Sequence[str],
    segment: Sequence[str],
    order: str = "year",
    carry: Sequence[str] = (),
    piece: int = PIECE,
) -> DataFrame:
    """``score`` with several parameter sets per key, which ``sets`` tell apart: one row per row and set.

    A key's sets are one array. Rows move once whatever the number of sets: those without
    autocorrelation are written out where they are, the others after their segments are gathered.
    ``sets`` are named in the result behind ``segment``. A key without parameters is an error.
    """
    fields = [order, *[c for c in carry if c != order]]
    named = [c for c in bound.columns if c not in keys]
    matrix = bound.groupBy(*keys).agg(F.collect_list(F.struct(*named)).alias("__sets"))
    still = F.filter("__sets", lambda s: ~s["has_auto"])
    moving = F.filter("__sets", lambda s: s["has_auto"])
    known = F.when(F.col("__sets").isNull(), _absent(keys)).otherwise(still)
    inputs = [c for c in dict.fromkeys([*segment, *fields, *INPUTS])]
    plain = rows.join(matrix, list(keys), "left").select(*inputs, F.inline(known).alias(*named))
    plain = plain.select(*segment, *sets, "transform_parameter", *fields, _terms()[1].alias("transformed_streamflow"))
    record = F.struct(*dict.fromkeys([*fields, *INPUTS]))
    gathered = rows.groupBy(*segment, F.floor(F.col(order) / piece).alias("__piece")).agg(
        F.array_sort(F.collect_list(record)).alias("__read")
    )
    each = gathered.join(matrix, list(keys)).select(*segment, "__piece", "__read", F.inline(moving).alias(*named))

    def with_term(r: Column) -> Column:
        return F.struct(*[r[f].alias(f) for f in fields], _terms(r.getField)[1].alias("__c"))

    bases = F.transform("__read", lambda r: _terms(r.getField)[0])
    pieces = each.select(
        *segment,
        *sets,
        "__piece",
        "a2",
        "transform_parameter",
        F.transform("__read", with_term).alias("__rows"),
        bases.alias("__bases"),
        F.size("__read").cast("long").alias("__n"),
    )
    pieces = pieces.withColumns(
        {
            "__known": F.size(F.filter("__bases", lambda b: b.isNotNull())).cast("long"),
            "__sum": F.aggregate("__bases", F.lit(0.0), lambda total, b: total + F.coalesce(b, F.lit(0.0))),
        }
    ).drop("__bases")
    return plain.unionByName(_flows(pieces, [*segment, *sets], fields))


def _flows(pieces: DataFrame, segment: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Rows with their flow from the pieces of autoregressive segments.

    Of a piece of n rows with start z the deviation at the end is ``a2^n z + Z - mu G``, where Z is the fold of the terms
    and G that of ones from zero. One small row per piece goes to its segment and its start comes back.
    """

    def compose(state: Column, r: Column) -> Column:
        a2 = F.col("a2")
        return F.struct(
            (r["__c"] + a2 * state["z"]).alias("z"), (1 + a2 * state["g"]).alias("g"), (a2 * state["a"]).alias("a")
        )

    still = F.struct(_start("0").alias("z"), _start("0").alias("g"), _start("1").alias("a"))
    maps = pieces.select(*segment, "__piece", "__sum", "__known", "__n", F.aggregate("__rows", still, compose).alias("__map"))
    whole = maps.groupBy(*segment).agg(
        F.array_sort(F.collect_list(F.struct("__piece", "__map"))).alias("__maps"),
        F.when(F.sum("__known") == F.sum("__n"), F.sum("__sum") / F.sum("__n")).alias("__mu"),
    )
    ends = _running(
        F.col("__maps"), _start("0"), lambda z, m: m["__map"]["a"] * z + m["__map"]["z"] - F.col("__mu") * m["__map"]["g"]
    )
    whole = whole.withColumn("__starts", F.concat(F.array(F.lit(0.0)), ends))
    begun = F.zip_with(
        F.col("__maps")["__piece"], "__starts", lambda p, z: F.struct(p.alias("__of"), (F.col("__mu") + z).alias("__start"))
    )
    renamed = [F.col(c).alias(f"__s_{c}") for c in segment]
    starts = whole.select(*renamed, "__mu", F.inline(begun)).where("__of IS NOT NULL")
    same = F.col("__piece") == F.col("__of")
    for c in segment:
        same = same & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    run = _running(F.col("__rows"), F.col("__start"), lambda y, r: r["__c"] + F.col("a2") * (y - F.col("__mu")))
    done = pieces.join(starts, same).withColumn("__y", run)
    merged = F.zip_with(
        "__rows", "__y", lambda r, y: F.struct(*[r[f].alias(f) for f in fields], y.alias("transformed_streamflow"))
    )
    return done.select(*segment, "transform_parameter", F.inline(merged))


def _start(value: str) -> Column:
    """A first value that may be followed by NULL: a fold takes over whether its start can be NULL."""
    return F.lit(value).try_cast("double")


def _running(items: Column, first: Column, step: Callable[[Column, Column], Column]) -> Column:
    """All values of an ordered fold: ``step`` of the value before and the item.

    Appending to an array copies it, so values are gathered in blocks of ``BLOCK``, and blocks in an array of blocks.
    """
    none = F.array().cast("array<double>")

    def one(state: Column, item: Column) -> Column:
        now = step(state["last"], item)
        return F.struct(F.array_append(state["y"], now).alias("y"), now.alias("last"))

    def block(done: Column, at: Column) -> Column:
        last = F.element_at(done, -1)["last"]
        start = F.struct(none.alias("y"), last.alias("last"))
        return F.array_append(done, F.aggregate(F.slice(items, at, BLOCK), start, one))

    firsts = F.sequence(F.lit(1), F.size(items), F.lit(BLOCK))
    start = F.array(F.struct(none.alias("y"), first.alias("last")))
    return F.aggregate(firsts, start, block, lambda done: F.flatten(F.transform(done, lambda b: b["y"])))
