"""Quality rules: one flag column per rule, true where the row fails."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import ge, gt, le, lt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.functions import convert

# Rule names.
_LENGTH = {"length_lt": lt, "length_lte": le, "length_gt": gt, "length_gte": ge}
_NUMBER = {"numeric_lt": lt, "numeric_lte": le, "numeric_gt": gt, "numeric_gte": ge}
_SPREAD = ["numeric_mean_stddev_within", "numeric_max_mean_stddev", "numeric_min_mean_stddev"]
RULES = [
    "not_blank",
    "is_blank",
    "contains",
    "not_contains",
    *_LENGTH,
    "length_between",
    *_NUMBER,
    "numeric_between",
    *_SPREAD,
]


@dataclass(frozen=True)
class Rule:
    column: str
    rule: str
    params: dict = field(default_factory=dict)
    ignore_blank: bool = True

    @property
    def flag_name(self) -> str:
        return f"{self.column}_{self.rule}_fail"


def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.btrim(F.col(column).cast("string")) == "")


def _spread(df: DataFrame, rule: Rule) -> Column:
    """Distance rules: mean and deviation are one scalar subquery over the whole table."""
    n = float(rule.params["stddevs"])
    if n <= 0:
        raise ValueError("the number of deviations must be positive")
    value = F.col(rule.column).cast("double")
    stats = df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    low = stats.select(F.col("mean") - n * F.col("sd")).scalar()
    high = stats.select(F.col("mean") + n * F.col("sd")).scalar()
    if rule.rule == "numeric_max_mean_stddev":
        return value <= high
    if rule.rule == "numeric_min_mean_stddev":
        return value >= low
    return (value >= low) & (value <= high)


def passes(df: DataFrame, rule: Rule) -> Column:
    """Pass condition for a row that is not blank."""
    text, p = F.col(rule.column).cast("string"), rule.params
    number = F.col(rule.column)
    if rule.rule == "not_blank":
        return ~blank(rule.column)
    if rule.rule == "is_blank":
        return blank(rule.column)
    if rule.rule in ("contains", "not_contains"):
        found = text.contains(p["text"])
        return found if rule.rule == "contains" else ~found
    if rule.rule in _LENGTH:
        return _LENGTH[rule.rule](F.length(text), F.lit(int(p["limit"])))
    if rule.rule in _NUMBER:
        return _NUMBER[rule.rule](number, F.lit(p["value"]))
    if rule.rule in ("length_between", "numeric_between"):
        if p["lower"] > p["upper"]:
            raise ValueError("the lower bound is above the upper bound")
        tested = F.length(text) if rule.rule == "length_between" else number
        return tested.between(p["lower"], p["upper"])
    if rule.rule in _SPREAD:
        return _spread(df, rule)
    raise ValueError(f"unknown rule: {rule.rule}")


def flag(df: DataFrame, rule: Rule) -> Column:
    """True where the row fails. An unknown outcome (no deviation to compare with) passes."""
    ok = F.coalesce(passes(df, rule), F.lit(True))
    if rule.rule == "is_blank":
        return ~ok
    return F.when(blank(rule.column), F.lit(not rule.ignore_blank)).otherwise(~ok)


def with_flags(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rules over one scan, one flag column each."""
    return df.withColumns({rule.flag_name: flag(df, rule) for rule in rules})


# ---- value domains of a data dictionary ------------------------------------


@dataclass(frozen=True)
class Domain:
    """Valid domain of a column: ``kind`` is range, less, greater, boolean or datetime."""

    column: str
    kind: str
    lower: str | None = None
    upper: str | None = None
    true_words: tuple[str, ...] = ()
    false_words: tuple[str, ...] = ()
    formats: tuple[str, ...] = ()

    def accepts(self) -> Column:
        text = F.col(self.column).cast("string")
        number = text.try_cast("decimal(33,15)")
        bound = {k: F.lit(v).cast("decimal(33,15)") for k, v in (("lo", self.lower), ("hi", self.upper))}
        if self.kind == "range":
            return number.between(bound["lo"], bound["hi"])
        if self.kind == "less":
            return number < bound["hi"]
        if self.kind == "greater":
            return number > bound["lo"]
        if self.kind == "boolean":
            return convert.to_boolean(text, self.true_words, self.false_words).isNotNull()
        if self.kind == "datetime":
            return convert.to_moment(text, self.formats).isNotNull()
        raise ValueError(f"unknown domain kind: {self.kind}")


def domain_conformance(df: DataFrame, domains: list[Domain]) -> DataFrame:
    """(column_name, kind, conforming, failing, blank) for all domains in one scan."""
    counts = df.agg(
        *[
            F.struct(
                F.count_if(~blank(d.column) & F.coalesce(d.accepts(), F.lit(False))).alias("conforming"),
                F.count_if(~blank(d.column) & ~F.coalesce(d.accepts(), F.lit(False))).alias("failing"),
                F.count_if(blank(d.column)).alias("blank"),
            ).alias(f"d{i}")
            for i, d in enumerate(domains)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(d.column).alias("column_name"),
                F.lit(d.kind).alias("kind"),
                *[F.col(f"d{i}.{c}").alias(c) for c in ("conforming", "failing", "blank")],
            )
            for i, d in enumerate(domains)
        ]
    )
    return counts.select(F.inline(rows))


def failing_counts(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """(flag_name, failing) of a flagged table."""
    names = [r.flag_name for r in rules]
    return flagged.agg(*[F.count_if(F.col(n)).alias(n) for n in names]).unpivot([], names, "flag_name", "failing")


def any_failure(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(r.flag_name) for r in rules])
