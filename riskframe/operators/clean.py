"""Cleaning: type coercion, imputation, outlier capping, range checks, encoding, scaling, validation."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskframe.functions.ordered import (
    ColumnCounts,
    column_counts,
    exact_quantiles,
    interpolation_ranks,
    running_totals,
    values_at,
)
from riskframe.functions.text import issue_month, number_from_text
from riskframe.schemas import NUMERIC_TEXT_COLUMNS, REQUEST_RULES, VALID_RANGES, Rule
from riskframe.session import materialize

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
MISSING = "nan"  # the class of a missing value in label encoding


# --- columns ----------------------------------------------------------------------------------


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [c for c, t in df.dtypes if (t in NUMERIC_TYPES or t.startswith("decimal")) and c not in exclude]


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [c for c, t in df.dtypes if t == "string" and c not in exclude]


def as_categories(df: DataFrame) -> DataFrame:
    """Booleans, dates and timestamps as text, times by day, so that they count as categories."""
    day = {c: F.date_format(c, "yyyy-MM-dd") for c, t in df.dtypes if t in ("date", "timestamp", "timestamp_ntz")}
    return df.withColumns({**day, **{c: F.col(c).cast("string") for c, t in df.dtypes if t == "boolean"}})


def common_columns(reference: DataFrame, current: DataFrame) -> list[str]:
    """Columns both frames have, in the reference's order."""
    return [c for c in reference.columns if c in current.columns]


def split_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Feature names and the target; a frame without the target is an error."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    return [c for c in df.columns if c != target], target


def align_columns(df: DataFrame, names: list[str], fill: float = 0.0) -> DataFrame:
    """Exactly the named columns in that order; absent ones hold ``fill``."""
    return df.select(*[F.col(n) if n in df.columns else F.lit(fill).alias(n) for n in names])


def where_group(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one group; a null group has no rows."""
    return df.filter(F.col(column) == F.lit(value))


# --- duplicates and types ---------------------------------------------------------------------


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row deduplication; copies collapse before the shuffle."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """``(rows, distinct_rows, removed)`` from one grouped pass."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("_n"))
        .agg(F.sum("_n").alias("rows"), F.count("*").alias("distinct_rows"))
        .withColumn("removed", F.col("rows") - F.col("distinct_rows"))
    )


def coerce_numeric(df: DataFrame, columns: list[str] = NUMERIC_TEXT_COLUMNS) -> DataFrame:
    """The listed columns as doubles; text that is no number becomes null."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: number_from_text(F.col(c)) if types[c] == "string" else F.col(c).cast("double")
            for c in columns
            if c in types
        }
    )


def parse_issue_date(df: DataFrame, column: str = "issue_d") -> DataFrame:
    if dict(df.dtypes).get(column) != "string":
        return df
    return df.withColumn(column, issue_month(F.col(column)))


# --- missing values ---------------------------------------------------------------------------


def missing_profile(df: DataFrame, columns: list[str] | None = None, max_missing: float = 50.0) -> DataFrame:
    """``(column, missing, percent, impute)`` for every column, from one aggregate."""
    columns = columns or df.columns
    one = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns])
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), (F.col("_rows") - F.col(c)).alias("missing")) for c in columns]
    )
    percent = F.coalesce(F.try_divide(F.col("e.missing") * 100.0, F.col("_rows")), F.lit(0.0))
    return one.select("_rows", F.explode(entries).alias("e")).select(
        "e.column",
        "e.missing",
        percent.alias("percent"),
        ((F.col("e.missing") > 0) & (percent <= max_missing)).alias("impute"),
    )


@dataclass
class ImputeStats:
    """Fill values of numeric (median) and text (mode) columns."""

    medians: dict[str, float | None] = field(default_factory=dict)
    modes: dict[str, str | None] = field(default_factory=dict)

    def fill(self) -> dict[str, float | str | None]:
        return {**self.medians, **self.modes}


def column_modes(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent value per text column, the smallest on ties; counted in a shuffle, not in one task."""
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    best = (
        df.select(F.explode(pairs).alias("e"))
        .select("e.column", "e.value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
        .groupBy("column")
        .agg(F.min(F.struct(-F.col("n"), F.col("value").alias("value"))).alias("best"))
        .select("column", "best.value")
    )
    found = {r["column"]: r["value"] for r in best.collect()}  # one row per column
    return {c: found.get(c) for c in columns}


def fit_imputer(df: DataFrame, columns: list[str] | None = None) -> ImputeStats:
    """Medians and modes of every eligible column, also of those without nulls so far."""
    numeric = [c for c in numeric_columns(df) if columns is None or c in columns]
    text = [c for c in string_columns(df) if columns is None or c in columns]
    medians = {c: q[0] for c, q in exact_quantiles(df, numeric, [0.5]).items()}
    return ImputeStats(medians, column_modes(df, text))


def impute(df: DataFrame, stats: ImputeStats, max_missing: float = 50.0) -> DataFrame:
    """Fill nulls from ``stats`` in columns that miss at most ``max_missing`` percent of *this* frame.

    On a stream the share is unknown and every fitted column is filled.
    """
    fills = {c: v for c, v in stats.fill().items() if c in df.columns and v is not None}
    if not fills:
        return df
    if df.isStreaming:
        return fill_nulls(df, fills)
    shares = df.agg(
        F.struct(
            *[(F.count_if(F.col(c).isNull()) * 100.0 <= F.count("*") * max_missing).alias(c) for c in fills]
        ).alias("s")
    ).scalar()
    flags = df.withColumn("_impute", shares)
    types = dict(df.dtypes)
    return flags.withColumns(
        {
            c: F.when(F.col("_impute").getField(c), F.coalesce(F.col(c), F.lit(v).cast(_filled(types[c])))).otherwise(
                F.col(c)
            )
            for c, v in fills.items()
        }
    ).drop("_impute")


def _filled(dtype: str) -> str:
    """An integer column with an interpolated fill value becomes a double."""
    return dtype if dtype in ("string", "float", "double") else "double"


def fill_nulls(df: DataFrame, fills: dict[str, float | str | None]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v).cast(_filled(types[c])))
            for c, v in fills.items()
            if c in types and v is not None
        }
    )


def residual_median_fill(df: DataFrame, medians: dict[str, float | None] | None = None) -> DataFrame:
    """Numeric nulls take the median: of this frame, or as fitted on the training frame."""
    if medians is None:
        counts = column_counts(df, numeric_columns(df))
        gaps = [c for c, n in counts.items() if n.present < n.rows]
        medians = {c: q[0] for c, q in exact_quantiles(df, gaps, [0.5]).items()}
    return fill_nulls(df, medians)


# --- outliers and ranges ----------------------------------------------------------------------

Bounds = dict[str, tuple[float, float]]


def _fences(q1: float, q3: float, k: float) -> tuple[float, float]:
    spread = q3 - q1
    return q1 - k * spread, q3 + k * spread


def iqr_bounds(df: DataFrame, columns: list[str], k: float = 1.5, approx: bool = False) -> Bounds:
    """Lower and upper fence per column; columns without values are left out."""
    if approx:
        row = df.agg(
            *[F.percentile_approx(F.col(c).cast("double"), [0.25, 0.75], 10_000).alias(c) for c in columns]
        ).first()
        quartiles = {c: row[c] or [None, None] for c in columns}
    else:
        quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    return {c: _fences(q[0], q[1], k) for c, q in quartiles.items() if q[0] is not None}


def clip(value: Column, lo: float, hi: float) -> Column:
    """Move values outside ``[lo, hi]`` to the nearer end; null stays null."""
    return F.when(value < lo, F.lit(float(lo))).when(value > hi, F.lit(float(hi))).otherwise(value.cast("double"))


def winsorize_iqr(
    df: DataFrame,
    exclude: tuple[str, ...] = (),
    k: float = 1.5,
    bounds: Bounds | None = None,
    approx: bool = False,
) -> DataFrame:
    """Clip numeric columns to their IQR fences, taken from this frame unless given."""
    columns = numeric_columns(df, exclude)
    bounds = iqr_bounds(df, columns, k, approx) if bounds is None else bounds
    return df.withColumns({c: clip(F.col(c), *bounds[c]) for c in columns if c in bounds})


def _outside(c: str, bounds: Bounds) -> Column:
    return (F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1])


def iqr_outlier_report(df: DataFrame, columns: list[str] | None = None, k: float = 1.5) -> DataFrame:
    """``(column, lower, upper, outliers, percent)`` per numeric column."""
    columns = columns or numeric_columns(df)
    bounds = iqr_bounds(df, columns, k)
    columns = [c for c in columns if c in bounds]
    one = df.agg(F.count("*").alias("_rows"), *[F.count_if(_outside(c, bounds)).alias(c) for c in columns])
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(float(bounds[c][0])).alias("lower"),
                F.lit(float(bounds[c][1])).alias("upper"),
                F.col(c).alias("outliers"),
                (F.col(c) * 100.0 / F.col("_rows")).alias("percent"),
            )
            for c in columns
        ]
    )
    return one.select(F.explode(entries).alias("e")).select("e.*")


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """The rows outside the fences of one column."""
    return df.filter(_outside(column, iqr_bounds(df, [column], k)))


def _checked_ranges(df: DataFrame, ranges: dict, exclude: tuple[str, ...]) -> dict:
    return {c: r for c, r in ranges.items() if c in df.columns and c not in exclude}


def clamp_ranges(df: DataFrame, ranges: dict = VALID_RANGES, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Move out-of-range values to the nearer end of the declared range."""
    return df.withColumns({c: clip(F.col(c), *r) for c, r in _checked_ranges(df, ranges, exclude).items()})


def range_report(df: DataFrame, ranges: dict = VALID_RANGES, exclude: tuple[str, ...] = ()) -> DataFrame:
    """``(column, out_of_range)`` counts for the declared ranges."""
    checked = _checked_ranges(df, ranges, exclude)
    one = df.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, (lo, hi) in checked.items()])
    return one.unpivot([], list(checked), "column", "out_of_range")


# --- composite --------------------------------------------------------------------------------


@dataclass
class CleanStats:
    """Everything :func:`clean_loans` learns from a frame."""

    impute: ImputeStats
    bounds: Bounds
    missing_percent: dict[str, float]

    def to_dict(self) -> dict:
        return asdict(self)

    @staticmethod
    def from_dict(d: dict) -> CleanStats:
        return CleanStats(
            ImputeStats(**d["impute"]), {c: tuple(b) for c, b in d["bounds"].items()}, d["missing_percent"]
        )


def _imputed_ranks(s: ColumnCounts, fill: bool, probs: list[float]) -> set[int]:
    """Ranks among present values that a median and quantiles *after* median fill can need."""
    ranks = set(interpolation_ranks(s.present, 0.5)[:2])
    n, added = (s.rows, s.rows - s.present) if fill else (s.present, 0)
    for p in probs:
        for r in interpolation_ranks(n, p)[:2]:
            ranks.update((r, r - added))
    return {r for r in ranks if 0 <= r < s.present}


def fit_clean(
    df: DataFrame, exclude: tuple[str, ...] = (), max_missing: float = 50.0, every_column: bool = True, k: float = 1.5
) -> CleanStats:
    """Medians, modes and fences of a typed, deduplicated frame in a count pass and one ranking.

    The fences belong to the frame *after* median fill. Filling adds copies of the median to the sorted
    column, so each imputed order statistic is one of two present values or the median: all of them are
    looked up together and no pass over the filled frame is needed.
    ``every_column=False`` fits text modes only where this frame has nulls to fill.
    """
    numeric, text = numeric_columns(df), string_columns(df)
    counts = column_counts(df, numeric + text)
    missing = {c: 100.0 * (s.rows - s.present) / s.rows if s.rows else 0.0 for c, s in counts.items()}

    quartiles = [0.25, 0.75]
    usable = {c: counts[c] for c in numeric if counts[c].present}
    filled = {c: 0 < missing[c] <= max_missing for c in usable}
    values = values_at(df, counts, {c: _imputed_ranks(s, filled[c], quartiles) for c, s in usable.items()})

    medians: dict[str, float | None] = {c: None for c in numeric}
    bounds: Bounds = {}
    for c, s in usable.items():
        lo, hi, share = interpolation_ranks(s.present, 0.5)
        median = values[c, lo] + (values[c, hi] - values[c, lo]) * share
        medians[c] = median
        if c in exclude:
            continue
        n, added = (s.rows, s.rows - s.present) if filled[c] else (s.present, 0)

        def imputed(rank: int, c=c, median=median, added=added) -> float:
            below, above = values.get((c, rank)), values.get((c, rank - added))
            if below is not None and below < median:
                return below
            return above if above is not None and above > median else median

        q = []
        for p in quartiles:
            lo, hi, share = interpolation_ranks(n, p)
            q.append(imputed(lo) + (imputed(hi) - imputed(lo)) * share)
        bounds[c] = _fences(q[0], q[1], k)

    wanted = text if every_column else [c for c in text if 0 < missing[c] <= max_missing]
    return CleanStats(ImputeStats(medians, column_modes(df, wanted)), bounds, missing)


def typed(df: DataFrame) -> DataFrame:
    """Deduplicated rows with numbers and dates parsed."""
    return df.transform(drop_exact_duplicates).transform(coerce_numeric).transform(parse_issue_date)


def apply_clean(
    df: DataFrame,
    stats: CleanStats,
    exclude: tuple[str, ...] = (),
    ranges: dict = VALID_RANGES,
    max_missing: float = 50.0,
) -> DataFrame:
    """Fill, cap and clamp a typed frame with known statistics: projections only, no shuffle."""
    fills = {c: v for c, v in stats.impute.fill().items() if 0 < stats.missing_percent.get(c, 0.0) <= max_missing}
    out = fill_nulls(df, fills)
    out = winsorize_iqr(out, exclude, bounds={c: b for c, b in stats.bounds.items() if c not in exclude})
    return clamp_ranges(out, ranges, exclude)


def clean_loans(df: DataFrame, exclude: tuple[str, ...] = (), max_missing: float = 50.0) -> DataFrame:
    """Deduplicate, type, impute, cap and clamp one frame by its own statistics.

    The deduplicated frame is written once, since the statistics passes and the result all read it.
    """
    base = materialize(typed(df), "typed")
    stats = fit_clean(base, exclude, max_missing, every_column=False)
    return apply_clean(base, stats, exclude, max_missing=max_missing)


def observed(df: DataFrame, name: str, **aggs: Column) -> tuple[DataFrame, Observation]:
    """Attach counters (rows removed, values clipped) that fill in while the frame is written."""
    seen = Observation(name)
    return df.observe(seen, *[expr.alias(key) for key, expr in aggs.items()]), seen


# --- label encoding ---------------------------------------------------------------------------


@dataclass
class LabelDict:
    """Fitted columns and the dictionary table ``(value, code, column)``."""

    columns: list[str]
    table: DataFrame


def label_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(value, code, column)``: codes 0..k−1 in value order, missing as its own class.

    An identifier column can have as many values as rows, so codes come from bucketed running counts.
    """
    values = (
        df.select(*[F.coalesce(F.col(c), F.lit(MISSING)).alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("one", F.least("n", F.lit(1)))
    )
    codes = running_totals(values, ["column"], ["value"], ["one"])
    return codes.select("value", (F.col("cum_one") - 1).cast("int").alias("code"), "column")


def fit_labels(df: DataFrame, columns: list[str] | None = None) -> LabelDict:
    """The dictionary of the text columns, stored by column so that each lookup reads its part only."""
    columns = columns or string_columns(df)
    return LabelDict(columns, materialize(label_codes(df, columns), "labels", partition_by=["column"]))


def encode_labels(df: DataFrame, labels: LabelDict, columns: list[str] | None = None) -> DataFrame:
    """Replace text by its code; unseen values get −1 and columns without a dictionary stay as they are.

    A join per column; Spark broadcasts a dictionary only when its stored size is below the session's
    threshold and shuffles it otherwise.
    """
    for c in [c for c in columns or string_columns(df) if c in labels.columns]:
        part = labels.table.filter(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("code").alias("_code")
        )
        joined = df.withColumn("_key", F.coalesce(F.col(c), F.lit(MISSING))).join(
            part, F.col("_key") == F.col("_value"), "left"
        )
        df = joined.withColumn(c, F.coalesce("_code", F.lit(-1))).drop("_key", "_value", "_code")
    return df


# --- scaling ----------------------------------------------------------------------------------


@dataclass
class ScalerStats:
    """Mean and population standard deviation per column."""

    mean: dict[str, float]
    std: dict[str, float]


def fit_scaler(df: DataFrame, columns: list[str] | None = None) -> ScalerStats:
    columns = columns or numeric_columns(df)
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    present = [(i, c) for i, c in enumerate(columns) if row[f"m{i}"] is not None]
    return ScalerStats({c: row[f"m{i}"] for i, c in present}, {c: row[f"s{i}"] for i, c in present})


def scale(df: DataFrame, stats: ScalerStats) -> DataFrame:
    """``(x − mean) / std``; a constant column is only centred, an unfitted one is left alone."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(stats.mean[c])) / F.lit(stats.std[c] or 1.0) for c in numeric_columns(df) if c in stats.mean}
    )


# --- request validation -----------------------------------------------------------------------


def _violation(rule: Rule, present: bool) -> list[Column]:
    value = F.col(rule.field) if present else F.lit(None).cast(rule.type)
    checks: list[tuple[Column, str]] = []
    if rule.required:
        checks.append((value.isNull(), "Field required"))
    if rule.gt is not None:
        checks.append((value <= rule.gt, f"Input should be greater than {rule.gt:g}"))
    if rule.ge is not None:
        checks.append((value < rule.ge, f"Input should be greater than or equal to {rule.ge:g}"))
    if rule.le is not None:
        checks.append((value > rule.le, f"Input should be less than or equal to {rule.le:g}"))
    if rule.pattern is not None:
        checks.append((~value.rlike(rule.pattern), f"String should match pattern '{rule.pattern}'"))
    return [F.when(bad, F.lit(f"{rule.field}: {text}")) for bad, text in checks]


def request_errors(df: DataFrame, rules: list[Rule] = REQUEST_RULES, types: dict[str, Column] | None = None) -> DataFrame:
    """Add ``errors``: one text per broken rule, naming the field.

    ``types`` says, for fields that were read from text, what is wrong with the value's type (null: nothing); such a value
    breaks no other rule.
    """
    checks = []
    for rule in rules:
        broken = _violation(rule, rule.field in df.columns)
        if types and rule.field in types:
            wrong = types[rule.field]
            checks.append(F.concat(F.lit(f"{rule.field}: "), wrong))
            broken = [F.when(wrong.isNull(), v) for v in broken]
        checks += broken
    return df.withColumn("errors", F.array_compact(F.array(*checks)))


def validate_requests(df: DataFrame, rules: list[Rule] = REQUEST_RULES) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every rule, and the rejected rows with their errors."""
    checked = request_errors(df, rules)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)
