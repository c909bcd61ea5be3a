"""Hard rules (split valid / invalid), soft flags, quarantine and audit columns.

A ``RuleSet`` is declarative: named boolean Columns plus required columns.
The valid branch is filtered with the plain conjunction (a filter drops NULL
verdicts, same as ``coalesce(rule, false)``), so simple comparisons still reach
the Parquet scan as pushed filters. The invalid branch keeps every row whose
verdict is not TRUE, NULL included (S-1).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import any_true

CORRUPT = "_corrupt_record"
CAST_FAILED = "_cast_failed"
SOURCE_FILE = "source_file"
HELPER_COLUMNS = (CORRUPT, CAST_FAILED)


@dataclass(frozen=True)
class Rule:
    name: str
    expr: Column


@dataclass(frozen=True)
class RuleSet:
    required: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    corrupt_col: str = CORRUPT

    def named_rules(self, df: DataFrame) -> list[Rule]:
        out = []
        if self.corrupt_col in df.columns:
            out.append(Rule("corrupt_record", F.col(self.corrupt_col).isNull()))
        if CAST_FAILED in df.columns:
            out.append(Rule("cast_failed", F.col(CAST_FAILED).isNull()))
        out += [Rule(f"required_{c}", F.col(c).isNotNull()) for c in self.required]
        out += list(self.rules)
        return out

    def conjunction(self, df: DataFrame) -> Column:
        expr = None
        for r in self.named_rules(df):
            expr = r.expr if expr is None else expr & r.expr
        return F.lit(True) if expr is None else expr

    def verdict(self, df: DataFrame) -> Column:
        """TRUE for valid rows; NULL verdicts become FALSE (S-1)."""
        return F.coalesce(self.conjunction(df), F.lit(False))

    def reasons(self, df: DataFrame) -> Column:
        """Names of the rules a row breaks (a NULL rule counts as broken)."""
        return F.array_compact(F.array(*[
            F.when(~F.coalesce(r.expr, F.lit(False)), F.lit(r.name)) for r in self.named_rules(df)
        ]))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(valid, invalid). Valid drops the corrupt-record column; invalid keeps it."""
        valid = df.filter(self.conjunction(df)).drop(self.corrupt_col, CAST_FAILED)
        invalid = df.filter(~self.verdict(df))
        return valid, invalid

    def tag(self, df: DataFrame) -> DataFrame:
        """Add ``_verdict`` (never NULL) and ``_reasons`` (only on rejected rows): one evaluation for both outputs."""
        verdict = self.verdict(df)
        return df.withColumns({"_verdict": verdict, "_reasons": F.when(~verdict, self.reasons(df))})

    def violations(self, df: DataFrame) -> DataFrame:
        """One row per rule: how many rows break it; one aggregation job, long format."""
        rules = self.named_rules(df)
        counts = df.agg(*[
            F.count_if(~F.coalesce(r.expr, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)
        ])
        stack = F.explode(F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("rows_failed"))
            for i, r in enumerate(rules)
        ])).alias("v")
        return counts.select(stack).select("v.rule", "v.rows_failed")


@dataclass(frozen=True)
class FlagSet:
    """Named soft flags; ``any`` is their NULL-safe OR."""
    flags: tuple[Rule, ...] = field(default_factory=tuple)
    any_name: str = "is_suspicious"

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.flags]

    def apply(self, df: DataFrame) -> DataFrame:
        out = df.withColumns({f.name: f.expr for f in self.flags})
        return out.withColumn(self.any_name, any_true(self.names))


def tagged_rows(tagged: DataFrame, run_id: str, data_source: str, data_cols: Sequence[str],
                also: Sequence[str] = ()) -> DataFrame:
    """A ``RuleSet.tag`` frame in the columns of both outputs: a valid row has its data and audit columns, a rejected
    one the quarantine's (B6, B7); the others are NULL. A rejected row's JSON has the data columns and ``also`` those,
    which stay, like ``_verdict``."""
    valid = F.col("_verdict")
    raw = F.to_json(F.struct(*data_cols, *also))
    raw = F.coalesce(F.col(CORRUPT), raw) if CORRUPT in tagged.columns else raw
    now = F.current_timestamp()
    out = tagged.withColumns({"raw_record": F.when(~valid, raw), "reasons": F.col("_reasons"),
                              "quarantine_ts": F.when(~valid, now), "ingestion_ts": F.when(valid, now),
                              "data_source": F.when(valid, F.lit(data_source)), "run_id": F.lit(run_id)})
    if SOURCE_FILE not in out.columns:
        out = out.withColumn(SOURCE_FILE, F.lit(None).cast("string"))
    blank = {c: F.when(valid, F.col(c)) for c in data_cols}
    return out.withColumns(blank).drop("_reasons", *HELPER_COLUMNS)


def quarantine_rows(invalid: DataFrame, entity: str | Column, run_id: str,
                    reasons: Column | None = None, data_cols: Sequence[str] | None = None) -> DataFrame:
    """Quarantine projection (B6): the original bad text wins, else JSON of the data columns.

    ``to_json`` leaves out NULL fields (S-4).
    """
    if data_cols is None:
        data_cols = [c for c in invalid.columns if c not in (*HELPER_COLUMNS, SOURCE_FILE)]
    json_text = F.to_json(F.struct(*data_cols))
    raw = F.coalesce(F.col(CORRUPT), json_text) if CORRUPT in invalid.columns else json_text
    ent = F.lit(entity) if isinstance(entity, str) else entity
    cols = [ent.alias("entity"), raw.alias("raw_record")]
    cols.append((reasons if reasons is not None else F.array().cast("array<string>")).alias("reasons"))
    cols.append(F.col(SOURCE_FILE) if SOURCE_FILE in invalid.columns else F.lit(None).cast("string").alias(SOURCE_FILE))
    cols += [F.lit(run_id).alias("run_id"), F.current_timestamp().alias("quarantine_ts")]
    return invalid.select(*cols)


def with_audit(df: DataFrame, data_source: str, run_id: str) -> DataFrame:
    """Audit columns."""
    return df.withColumns({
        "ingestion_ts": F.current_timestamp(),
        "data_source": F.lit(data_source),
        "run_id": F.lit(run_id),
    })
