"""Input views and rounding shared by the registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.sources.tables import read_table

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents"]
KEY_SQL = ", ".join(KEY)
CENTS = "cast(round(l_extendedprice * 100) as bigint) as cents"


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """The columns rounded, with minus zero made zero."""
    return df.select(*[(F.round(col(c).cast("double"), digits) + F.lit(0.0)).alias(c)
                       if c in columns else col(c) for c in df.columns])


def R(expression: str, digits: int = 6) -> str:
    """The same in SQL."""
    return f"(round(cast({expression} as double), {digits}) + cast(0 as double))"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr("*", CENTS)


LINEITEM = f"(select *, {CENTS} from lineitem)"

# lineitem with nulls put in by rule, the same on both sides.
NULLED_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", CENTS, "l_quantity",
    "l_extendedprice",
    "case when l_quantity > 45 then null else l_discount end as l_discount",
    "case when l_linenumber % 5 = 0 then null else l_tax end as l_tax",
    "case when l_linenumber % 7 = 0 then null else l_returnflag end as l_returnflag",
    "case when l_quantity > 20 then null else l_linestatus end as l_linestatus",
]
NULLED = "(select " + ", ".join(NULLED_COLUMNS) + " from lineitem)"


def nulled(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*NULLED_COLUMNS)


# Labels with three fixed prediction formulas.
LABEL = "10 + l_quantity / 5"
FORMULAS = {
    "price": "10 + l_quantity / 5 + (l_extendedprice / 52500 - 1) * 1.5",
    "discount": "10 + l_quantity / 5 + (l_discount - 0.05) * 20",
    "tax": "(10 + l_quantity / 5) * 0.9 + 1.5 + (l_tax - 0.04) * 10",
}
MODELS = list(FORMULAS)


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Long table (model, segment, key..., y, y_pred)."""
    li = lineitem(spark, sf)
    out = None
    for name, formula in FORMULAS.items():
        t = li.selectExpr(f"'{name}' as model", "l_returnflag as segment", *KEY,
                          f"{LABEL} as y", f"{formula} as y_pred")
        out = t if out is None else out.unionByName(t)
    return out


PREDICTIONS = "(" + " union all ".join(
    f"select '{m}' as model, l_returnflag as segment, {KEY_SQL}, {LABEL} as y, "
    f"{f} as y_pred from {LINEITEM}" for m, f in FORMULAS.items()) + ")"


def model_case(expression: str = "model") -> str:
    """Registration order of the model in SQL."""
    return "case " + expression + "".join(
        f" when '{m}' then {i}" for i, m in enumerate(MODELS)) + " end"


def as_columns(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    def cast(c: str) -> Column:
        return col(c).cast(casts[c]).alias(c) if c in casts else col(c)

    return df.select(*[cast(c) for c in df.columns])


def normal_cdf_sql(z: str) -> str:
    """The library's normal distribution function as SQL text."""
    from tabulon.functions.expr import ERF_A, ERF_P

    t = f"(1e0 / (1e0 + {ERF_P!r}::double * abs({z}) / sqrt(2e0)))"
    poly = f"{ERF_A[4]!r}::double"
    for a in ERF_A[3::-1]:
        poly = f"({poly} * {t} + {a!r}::double)"
    return (f"((1e0 + sign({z}) * (1e0 - {poly} * {t} * exp(-(abs({z}) / sqrt(2e0)) "
            f"* (abs({z}) / sqrt(2e0))))) / 2e0)")


def normal_ppf_sql(p: str) -> str:
    """The library's normal quantile function as SQL text."""
    from tabulon.functions.expr import PPF_A, PPF_B, PPF_C, PPF_D, PPF_LOW

    def poly(x: str, coefficients) -> str:
        out = f"({coefficients[0]!r}::double)"
        for c in coefficients[1:]:
            out = f"({out} * {x} + ({c!r}::double))"
        return out

    def tail(q: str) -> str:
        return f"({poly(q, PPF_C)} / {poly(q, PPF_D + (1.0,))})"

    r = f"(({p} - 0.5e0) * ({p} - 0.5e0))"
    return (f"(case when {p} < {PPF_LOW} then {tail(f'sqrt(-2e0 * ln({p}))')} "
            f"when {p} > {1.0 - PPF_LOW} then -{tail(f'sqrt(-2e0 * ln(1e0 - {p}))')} "
            f"else {poly(r, PPF_A)} * ({p} - 0.5e0) / {poly(r, PPF_B + (1.0,))} end)")
