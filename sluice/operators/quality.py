"""Quality rules as column expressions, and the severity-weighted score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.once import once
from sluice.functions.payload import texts
from sluice.functions.text import is_iso_date, not_blank
from sluice.spec import BANKING, LINEITEM, ORDERS, SEVERITY_WEIGHT

RESULTS_TYPE = (
    "array<struct<rule_id:string,field:string,severity:string,passed:boolean,"
    "actual_value:string,message:string>>"
)


@dataclass(frozen=True)
class Value:
    """A payload value as a rule sees it: is it absent, its text, its number if it is one."""

    absent: Column
    text: Column
    number: Column

    @property
    def shown(self) -> Column:
        return F.coalesce(self.text, F.lit("null"))


Check = Callable[[Value], tuple[Column, Column, Column]]


@dataclass(frozen=True)
class Rule:
    """A rule on one payload field.

    ``check`` maps the field's value to three columns: whether it passed, the value as
    text, and a message (null when there is nothing to say).
    """

    rule_id: str
    field: str
    severity: str
    schema_id: str
    check: Check

    def result(self, value: Value) -> Column:
        passed, actual, message = self.check(value)
        return F.struct(
            F.lit(self.rule_id).alias("rule_id"),
            F.lit(self.field).alias("field"),
            F.lit(self.severity).alias("severity"),
            passed.alias("passed"),
            actual.alias("actual_value"),
            message.cast("string").alias("message"),
        )


def not_null(field: str, severity: str, schema_id: str) -> Rule:
    """The field is there and not blank."""
    def check(v: Value):
        passed = not_blank(v.text)
        return passed, v.shown, F.when(~passed, f"{field} must not be null or blank")

    return Rule(f"{field}.not_null", field, severity, schema_id, check)


def positive(field: str, severity: str, schema_id: str) -> Rule:
    """The field is a number above zero; anything else fails, also when absent."""
    def check(v: Value):
        passed = F.coalesce(v.number > 0, F.lit(False))
        actual = F.coalesce(v.number.cast("string"), v.shown)
        message = F.when(
            v.number.isNull(), F.concat(F.lit(f"{field} is not a number: "), actual)
        ).when(~passed, F.concat(F.lit(f"{field} must be > 0, got: "), actual))
        return passed, actual, message

    return Rule(f"{field}.positive", field, severity, schema_id, check)


def iso_date(field: str, severity: str, schema_id: str) -> Rule:
    """The field is a day written as yyyy-MM-dd."""
    def check(v: Value):
        passed = is_iso_date(v.text)
        message = F.when(~passed, F.concat(F.lit(f"{field} must be yyyy-MM-dd, got: "), v.shown))
        return passed, v.shown, message

    return Rule(f"{field}.iso_format", field, severity, schema_id, check)


def one_of(field: str, values: list[str], severity: str, schema_id: str) -> Rule:
    """The field is one of the given texts, in the same case."""
    listed = ", ".join(values)

    def check(v: Value):
        passed = F.coalesce(v.text.isin(*values), F.lit(False))
        message = F.when(~passed, F.concat(
            F.lit(f"{field} must be one of [{listed}], got: "), v.shown))
        return passed, v.shown, message

    return Rule(f"{field}.valid_value", field, severity, schema_id, check)


def _optional_number(field: str, holds: Callable[[Column], Column],
                     shown: Callable[[Column], Column], demand: str) -> Check:
    """A number that may be absent (which passes) but must satisfy ``holds`` if present."""
    def check(v: Value):
        passed = v.absent | F.coalesce(holds(v.number), F.lit(False))
        actual = F.coalesce(shown(v.number), v.shown)
        message = (
            F.when(v.absent, f"{field} absent — skipped")
            .when(v.number.isNull(), F.concat(F.lit(f"{field} is not a number: "), actual))
            .when(~passed, F.concat(F.lit(f"{field} must be {demand}, got: "), actual))
        )
        return passed, actual, message

    return check


def non_negative(field: str, severity: str, schema_id: str) -> Rule:
    """The number, if present, is zero or more."""
    check = _optional_number(field, lambda n: n >= 0, lambda n: n.cast("string"), ">= 0")
    return Rule(f"{field}.non_negative", field, severity, schema_id, check)


def _whole(number: Column) -> Column:
    """Number cut to a whole one, held within the 32-bit range; null stays null."""
    held = F.greatest(F.lit(-2147483648.0), F.least(F.lit(2147483647.0), number))
    return F.when(number.isNotNull(), held.cast("int"))


def in_range(field: str, low: int, high: int, severity: str, schema_id: str) -> Rule:
    """The number, if present and cut to a whole one, lies between the bounds, both included."""
    check = _optional_number(
        field, lambda n: _whole(n).between(low, high), lambda n: _whole(n).cast("string"),
        f"{low}–{high}")
    return Rule(f"{field}.in_range", field, severity, schema_id, check)


# Which rules hold for which schema, with their severities.
RULES: dict[str, list[Rule]] = {
    BANKING.schema_id: [
        not_null("transaction_id", "CRITICAL", BANKING.schema_id),
        not_null("transaction_date", "CRITICAL", BANKING.schema_id),
        not_null("amount", "CRITICAL", BANKING.schema_id),
        positive("amount", "HIGH", BANKING.schema_id),
        iso_date("transaction_date", "HIGH", BANKING.schema_id),
        one_of("transaction_status", ["Success", "Failed", "Pending"], "MEDIUM", BANKING.schema_id),
        non_negative("balance", "MEDIUM", BANKING.schema_id),
        in_range("credit_score", 300, 900, "LOW", BANKING.schema_id),
    ],
    ORDERS.schema_id: [
        not_null("o_orderkey", "CRITICAL", ORDERS.schema_id),
        not_null("o_totalprice", "CRITICAL", ORDERS.schema_id),
        positive("o_totalprice", "HIGH", ORDERS.schema_id),
    ],
    LINEITEM.schema_id: [
        not_null("line_item_id", "CRITICAL", LINEITEM.schema_id),
        not_null("l_orderkey", "CRITICAL", LINEITEM.schema_id),
        positive("l_quantity", "HIGH", LINEITEM.schema_id),
    ],
}


def rule_fields(rules: dict[str, list[Rule]]) -> list[str]:
    """Payload fields the rules look at, each once."""
    return list(dict.fromkeys(r.field for listed in rules.values() for r in listed))


def rule_values(payload_texts: Column, payload_types: Column, fields: list[str]) -> Column:
    """Struct of the fields' values as rules see them."""
    def value(name: str) -> Column:
        text = payload_texts[name]
        is_number = F.array_contains(payload_types, F.lit(f"{name}:number"))
        return F.struct(
            text.isNull().alias("absent"),
            text.alias("text"),
            F.when(text.isNotNull(), F.when(is_number, text.try_cast("double"))).alias("number"),
        ).alias(name)

    return F.struct(*map(value, fields))


def rule_results(schema_id: Column, values: Column, rules: dict[str, list[Rule]]) -> Column:
    """Results of the rules that apply to the event's schema; none for other schemas."""
    out = F.when(F.lit(False), F.array().cast(RESULTS_TYPE))
    for sid, listed in rules.items():
        if listed:
            out = out.when(schema_id == sid, F.array(*[
                r.result(Value(*(values[r.field][part] for part in ("absent", "text", "number"))))
                for r in listed]))
    return out.otherwise(F.array().cast(RESULTS_TYPE))


def score(schema_id: Column, results: Column, rules: dict[str, list[Rule]]) -> Column:
    """Passed weight over total weight; 0.0 after a critical failure, 1.0 without rules."""
    out = F.when(F.size(results) == 0, 1.0)
    for sid, listed in rules.items():
        if not listed:
            continue
        passed = [F.get(results, i)["passed"] for i in range(len(listed))]
        critical = F.lit(False)
        won = F.lit(0)
        for rule, ok in zip(listed, passed):
            if rule.severity == "CRITICAL":
                critical = critical | ~ok
            won = won + F.when(ok, SEVERITY_WEIGHT[rule.severity]).otherwise(0)
        total = sum(SEVERITY_WEIGHT[r.severity] for r in listed)
        out = out.when(schema_id == sid, F.when(critical, 0.0).otherwise(won / F.lit(total)))
    return out.otherwise(1.0)


def failed_rules(results: Column, with_severity: bool = False) -> Column:
    """Ids of the failed rules, with ``[SEVERITY]`` behind each if asked."""
    failed = F.filter(results, lambda r: ~r["passed"])
    if with_severity:
        return F.transform(failed, lambda r: F.concat(
            r["rule_id"], F.lit("["), r["severity"], F.lit("]")))
    return F.transform(failed, lambda r: r["rule_id"])


def check_quality(events: DataFrame, threshold: float = 0.7,
                  rules: dict[str, list[Rule]] | None = None) -> DataFrame:
    """Adds rule results, score, threshold and whether the score reaches it.

    Events with a breaking change, if that column is there, skip the rules: no results,
    score and threshold 0.0, not passed.
    """
    rules = RULES if rules is None else rules
    skipped = F.col("breaking_change") if "breaking_change" in events.columns else F.lit(False)
    checked = _with_results(events, skipped, rules)
    points = score(F.col("schema_id"), F.col("rule_results"), rules)
    limit = F.lit(float(threshold))
    return checked.withColumn(
        "quality_score", F.when(skipped, 0.0).otherwise(points)
    ).withColumns({
        "quality_threshold": F.when(skipped, 0.0).otherwise(limit),
        "quality_passed": ~skipped & (F.col("quality_score") >= limit),
    })


def _with_results(events: DataFrame, skipped: Column, rules: dict[str, list[Rule]]) -> DataFrame:
    fields = rule_fields(rules)
    none = F.array().cast(RESULTS_TYPE)
    if not fields:
        return events.withColumn("rule_results", none)
    read = once(events, "_texts", F.when(~skipped, texts(F.col("payload"), fields)))
    seen = once(read, "_values", rule_values(F.col("_texts"), F.col("payload_types"), fields))
    results = rule_results(F.col("schema_id"), F.col("_values"), rules)
    return once(seen, "rule_results", F.when(skipped, none).otherwise(results)).drop(
        "_texts", "_values")
