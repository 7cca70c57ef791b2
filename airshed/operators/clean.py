"""Bronze -> Silver: date parsing, validity rules, quarantine of rejected rows.

Every rule is one boolean Column that is true when a row *fails* it. Silver is
the rows failing none; the quarantine keeps the others together with the names
of the rules they failed, so they can be fixed and replayed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference parses '%Y-%m-%d' strictly but accepts missing leading zeros
# ('2024-1-5'); 'yyyy-M-d' gives the same answers and rejects time parts.
DATE_FORMAT = "yyyy-M-d"
# The same shape as a pattern: four-digit year, one- or two-digit month and day.
_DATE_SHAPE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
PARSED_DATE = "_date_parsed"
REJECT_REASONS = "reject_reasons"
DATE_RULE = "date_unparseable"


@dataclass(frozen=True)
class Rule:
    """``passes``, where given, is the rule's positive form: true exactly where
    ``fails`` is false (it may be NULL where ``fails`` is true). Silver filters on the
    conjunction of these, which the scan can push down."""

    name: str
    fails: Column
    passes: Column | None = None


def parse_date(col: str = "date", fmt: str = DATE_FORMAT) -> Column:
    """Text date -> DATE, NULL when the text does not match the format.

    For the default format the text is checked against its shape and then
    cast, which uses Spark's built-in date parser (about twice as fast as a
    pattern formatter, and the parse runs once per row of the largest table).
    Impossible dates (2024-02-30) and year 0 are NULL, as in the reference.
    """
    c = F.col(col)
    if fmt != DATE_FORMAT:
        return F.try_to_date(c, fmt)
    return F.when(c.rlike(_DATE_SHAPE) & ~c.startswith("0000"), c.try_cast("date"))


def range_rule(column: str, lo: float, hi: float, name: str | None = None) -> Rule:
    """Fails when the column is NULL, NaN or outside [lo, hi] (a NaN compares false)."""
    c = F.col(column).try_cast("double")  # a declared number as it is; text of an undeclared column as a number
    inside = c.between(lo, hi)
    return Rule(name or f"{column}_out_of_range", ~F.coalesce(inside, F.lit(False)), inside)


def default_rules() -> list[Rule]:
    """The three validity rules of the reference pipeline, plus the date rule."""
    v = F.col("value")
    return [
        Rule(DATE_RULE, F.col(PARSED_DATE).isNull(), F.col(PARSED_DATE).isNotNull()),
        Rule("value_missing", v.isNull() | F.isnan(v), v.isNotNull() & ~F.isnan(v)),
        Rule("value_negative", F.coalesce(v < 0, F.lit(False)), F.coalesce(v >= 0, F.lit(True))),
        range_rule("latitude", -90.0, 90.0),
        range_rule("longitude", -180.0, 180.0),
    ]


def with_parsed_date(bronze: DataFrame, fmt: str = DATE_FORMAT) -> DataFrame:
    return bronze.withColumn(PARSED_DATE, parse_date("date", fmt))


def _any_fails(rules: list[Rule]) -> Column:
    cond = F.lit(False)
    for r in rules:
        cond = cond | r.fails
    return cond


def _all_pass(rules: list[Rule]) -> Column:
    cond = F.lit(True)
    for r in rules:
        cond = cond & (~r.fails if r.passes is None else r.passes)
    return cond


def passes(rules: list[Rule]) -> Column:
    """True where a row (``with_parsed_date``) fails no rule, false elsewhere."""
    return ~_any_fails(rules)


def _to_silver_columns(df: DataFrame, date_checked: bool = False) -> DataFrame:
    cols = [c for c in df.columns if c not in ("date", PARSED_DATE)]
    # Once the filter has kept only rows whose text passed the full date rule,
    # the plain cast gives the same DATE; Catalyst inlines the parse into both
    # the filter and this projection, so this saves the shape check per row.
    date = F.col("date").try_cast("date") if date_checked else F.col(PARSED_DATE)
    return df.select(*cols, date.alias("date"))


def to_silver(bronze: DataFrame, rules: list[Rule] | None = None,
              fmt: str = DATE_FORMAT, dedupe_keys: list[str] | None = None) -> DataFrame:
    """Valid rows with the parsed DATE moved to the last column.

    The filter is a conjunction of positive predicates, of which those on plain
    columns reach the scan. ``dedupe_keys`` (off by default) keeps one row for each key: the
    first by ingestion time and source file where these columns exist, then by all other columns.
    """
    df = with_parsed_date(bronze, fmt)
    rules = default_rules() if rules is None else rules
    date_checked = fmt == DATE_FORMAT and any(r.name == DATE_RULE for r in rules)
    silver = _to_silver_columns(df.filter(_all_pass(rules)), date_checked)
    if dedupe_keys:
        rest = [c for c in silver.columns if c not in dedupe_keys]
        order = [c for c in ("ingestion_timestamp", "source_file") if c in rest]
        first = F.min(F.struct(*order, *[c for c in rest if c not in order])) if rest else None
        silver = (silver.groupBy(*dedupe_keys).agg(first.alias("_first")).select(*dedupe_keys, "_first.*")
                  .select(*silver.columns)) if rest else silver.distinct()
    return silver


def reject_reasons(rules: list[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(r.fails, F.lit(r.name)) for r in rules]))


def to_quarantine(bronze: DataFrame, rules: list[Rule] | None = None,
                  fmt: str = DATE_FORMAT, run_date=None) -> DataFrame:
    """Rejected rows: original columns (text date kept) + ``reject_reasons`` array.

    ``run_date`` (a date, optional) is added as a column so that the sink can
    write one dated folder per run (``partitionBy('run_date')``).
    """
    df = with_parsed_date(bronze, fmt)
    rules = default_rules() if rules is None else rules
    out = df.filter(_any_fails(rules)).withColumn(REJECT_REASONS, reject_reasons(rules)).drop(PARSED_DATE)
    if run_date is not None:
        out = out.withColumn("run_date", F.lit(run_date).cast("date"))
    return out


def replay(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows back in Bronze shape, to be cleaned again after a fix."""
    return quarantine.drop(REJECT_REASONS, "run_date", "load_id")


def reject_counts(bronze: DataFrame, rules: list[Rule] | None = None,
                  fmt: str = DATE_FORMAT) -> DataFrame:
    """One row: total rows, rows failing each rule, rows rejected, rows kept.

    One pass, partial aggregation on the map side (a single row per task is
    shuffled). A row failing two rules counts under both rules once.
    """
    df = with_parsed_date(bronze, fmt)
    rules = default_rules() if rules is None else rules
    anyf = _any_fails(rules)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(r.fails).alias(r.name) for r in rules],
        F.count_if(anyf).alias("rejected_rows"),
        F.count_if(~anyf).alias("valid_rows"),
    )
