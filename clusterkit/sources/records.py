"""Delimited lines to typed records.

A ``RecordSpec`` names the fields of a line and says which are numbers, which are
categories and which one is the label. Parsing is a plain projection, so it works unchanged on
batch and streaming DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clusterkit.functions import sqltext as q
from clusterkit.functions.fields import blank_to_zero_text, once, split_fields


@dataclass(frozen=True)
class RecordSpec:
    names: tuple[str, ...]
    numeric: tuple[int, ...]
    categorical: tuple[int, ...]
    label: int
    delimiter: str = ","

    def __post_init__(self) -> None:
        taken = {"value", "label", "features", "parts"} & set(self.names)
        if taken:
            raise ValueError(f"field names kept for other columns: {sorted(taken)}")

    @property
    def width(self) -> int:
        return len(self.names)

    @property
    def label_name(self) -> str:
        return self.names[self.label]

    @property
    def numeric_names(self) -> list[str]:
        return [self.names[i] for i in self.numeric]

    def category_names(self, include_label: bool = False) -> list[str]:
        """Fields to one-hot encode. The label is a key of the record, close to unique, so as a
        feature it would be as wide as the data; it is left out unless asked for."""
        return [self.names[i] for i in self.categorical if include_label or i != self.label]

    def feature_order(self, include_label: bool = False) -> list[str]:
        """Field order of an assembled feature row: the first number, the category blocks from
        the last field to the first, then the other numbers."""
        numbers = self.numeric_names
        return numbers[:1] + self.category_names(include_label)[::-1] + numbers[1:]


# The 28-field trade record.
TRADE_RECORD = RecordSpec(
    names=(
        "trade_date", "product_type", "trade_id", "book_id", "counterparty", "start_date",
        "quantity", "currency", "instrument_description", "buy_sell", "trade_maturity_date",
        "trade_mod_date", "trade_version", "trade_description", "effective_date", "legal_entity",
        "trading_desk", "symbol", "original_notional", "notional", "type", "sec_amount", "status",
        "audit_action", "type_cftr", "currency_cftr", "notional_cftr", "remaining_notional_cftr",
    ),
    numeric=(0, 5, 6, 12, 14, 18, 19, 21, 26, 27),
    categorical=(1, 2, 3, 4, 7, 8, 9, 10, 13, 15, 16, 17, 20, 22, 23, 24, 25),
    label=2,
)


def _split(lines: DataFrame, spec: RecordSpec) -> DataFrame:
    parts = split_fields(F.col("value"), spec.delimiter, spec.width)
    return lines.select("value", once(parts).alias("parts"))


def _is_complete(spec: RecordSpec) -> str:
    return f"size(parts) = {spec.width}"


def _all_numbers(spec: RecordSpec) -> str:
    checks = [f"{blank_to_zero_text(f'get(parts, {i})')} IS NOT NULL" for i in spec.numeric]
    return " AND ".join(checks) or "true"


def split_records(lines: DataFrame, spec: RecordSpec) -> DataFrame:
    """All lines as named text fields beside ``value``; fields a line lacks are null."""
    fields = [f"get(parts, {i}) AS {q.name(name)}" for i, name in enumerate(spec.names)]
    return _split(lines, spec).selectExpr("value", *fields)


def parse_records(lines: DataFrame, spec: RecordSpec) -> DataFrame:
    """The well-formed lines: ``value``, ``label``, numeric fields as double, the rest as text."""
    return _typed(_split(lines, spec), spec)


def _typed(split: DataFrame, spec: RecordSpec) -> DataFrame:
    typed = [
        f"{blank_to_zero_text(f'parts[{i}]') if i in spec.numeric else f'parts[{i}]'} AS {q.name(name)}"
        for i, name in enumerate(spec.names)
    ]
    good = split.where(f"{_is_complete(spec)} AND {_all_numbers(spec)}")
    return good.selectExpr("value", f"parts[{spec.label}] AS label", *typed)


def rejected_records(lines: DataFrame, spec: RecordSpec) -> DataFrame:
    """The other lines, each with the reason it was refused."""
    reason = F.when(~F.expr(_is_complete(spec)), "field count").when(~F.expr(_all_numbers(spec)), "not a number")
    return _split(lines, spec).select("value", reason.alias("reason")).where(F.col("reason").isNotNull())


OUTCOMES = ("kept", "field count", "not a number")


def _outcome_counts(spec: RecordSpec) -> list[Column]:
    complete, numbers = F.expr(_is_complete(spec)), F.expr(_all_numbers(spec))
    outcome = F.when(~complete, OUTCOMES[1]).when(~numbers, OUTCOMES[2]).otherwise(OUTCOMES[0])
    return [F.count(F.when(outcome == name, 1)).alias(name) for name in OUTCOMES]


def observed_records(lines: DataFrame, spec: RecordSpec, watch: Observation | str) -> DataFrame:
    """``parse_records``, with the lines kept and left out counted on the way, by reason.

    The counts are metrics of whatever job reads the records, so nothing is scanned for them alone:
    of an ``Observation`` they are its ``get`` after the first action, and by a name they are those of a
    stream's progress (``rejects_of``). A job that stops early, a ``limit``, has counted what it read.
    """
    return _typed(_split(lines, spec).observe(watch, *_outcome_counts(spec)), spec)


def outcome_rows(metrics: dict[str, int]) -> list[tuple[str, int]]:
    """(outcome, lines) of the metrics of ``observed_records``, outcomes without lines left out."""
    return [(name, metrics[name]) for name in OUTCOMES if metrics.get(name)]


def _numbers(lines: DataFrame, delimiter: str) -> DataFrame:
    fields = split_fields(F.col("value"), delimiter)
    return lines.select("value", once(F.transform(fields, lambda x: x.try_cast("double"))).alias("features"))


def parse_numbers(lines: DataFrame, delimiter: str = "\t") -> DataFrame:
    """Lines that hold numbers only: ``value`` and ``features`` (``array<double>``). The others are
    those of ``rejected_numbers``."""
    return _numbers(lines, delimiter).where(~F.exists("features", lambda x: x.isNull()))


def rejected_numbers(lines: DataFrame, delimiter: str = "\t") -> DataFrame:
    """The lines with a blank field or one that is no number, with the position of the first."""
    bad = F.array_position(F.transform("features", lambda x: x.isNull()), True) - 1
    found = _numbers(lines, delimiter).where(F.exists("features", lambda x: x.isNull()) | F.col("features").isNull())
    return found.select("value", bad.cast("int").alias("field"))


def line_counts(lines: DataFrame, spec: RecordSpec) -> DataFrame:
    """How many lines a job takes and how many it leaves out, as (outcome, lines), by reason."""
    reason = F.when(~F.expr(_is_complete(spec)), "field count").when(~F.expr(_all_numbers(spec)), "not a number")
    return _split(lines, spec).groupBy(F.coalesce(reason, F.lit("kept")).alias("outcome")).agg(F.count("*").alias("lines"))
