"""Census grid cells: confidentiality, rules, themes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The attributes, their themes and the categories that add up to the total.
ATTRIBUTES = ["T", "M", "F", "Y_LT15", "Y_1564", "Y_GE65", "EMP", "NAT", "EU_OTH", "OTH", "SAME", "CHG_IN", "CHG_OUT"]
THEMES = {
    "total": ["T"],
    "sex": ["T", "M", "F"],
    "age": ["T", "Y_LT15", "Y_1564", "Y_GE65"],
    "emp": ["T", "EMP"],
    "mob": ["T", "SAME", "CHG_IN", "CHG_OUT"],
    "pob": ["T", "NAT", "EU_OTH", "OTH"],
    "all": ATTRIBUTES,
}
CATEGORIES = {"SEX": ["M", "F"], "AGE": ["Y_LT15", "Y_1564", "Y_GE65"], "CNTBIRTH": ["NAT", "EU_OTH", "OTH"], "RESCHANGE": ["SAME", "CHG_IN", "CHG_OUT"]}
CONFIDENTIAL = -9999


def confidential_sum(value: Column) -> Column:
    """Aggregate of text values: null if any is blank; without zeros 0 if none is left; without -1 (confidential) -1 if none is left; else the sum."""
    blank = F.count_if(value == "")
    some = F.count_if((value != "0") & (value != ""))
    open_ = F.count_if(~value.isin("", "0", "-1"))
    return F.when(blank > 0, F.lit(None).cast("long")).when(some == 0, F.lit(0).cast("long")).when(open_ == 0, F.lit(-1).cast("long")).otherwise(F.sum(F.when(~value.isin("", "0", "-1"), value.cast("long"))))


def confidential_value(v: Column, ci: Column) -> Column:
    """Text value with its flag: -1 where confidential, else the value."""
    ci = F.coalesce(ci, F.lit(""))
    n = v.try_cast("long")
    c = F.lit(str(CONFIDENTIAL))
    return F.when((ci == c) & (v == c), "-1").when((ci == c) & (n >= 0), v).when((ci == "0") & (n >= 0), v).when((ci == "") & (v == c), "-1").when(ci == "-9986", "-1").otherwise(v)


def normalise(df: DataFrame, attributes: list[str] | None = None) -> DataFrame:
    """Cells with T beyond 0, each attribute normalised and its flag dropped; x and y in place of GRD_ID."""
    from gridloom.functions.cells import cell_part

    names = [a for a in attributes or ATTRIBUTES if a in df.columns]
    rows = df.where(F.col("T").isNotNull() & ~F.col("T").isin("0", ""))
    rows = rows.withColumns({a: confidential_value(F.col(a), F.col(f"{a}_CI")) for a in names if f"{a}_CI" in df.columns})
    gone = [f"{a}_CI" for a in ATTRIBUTES] + ["fid", "POPULATED", "LAND_SURFACE", "GRD_ID"]
    return rows.withColumns({"x": cell_part(F.col("GRD_ID"), "x"), "y": cell_part(F.col("GRD_ID"), "y")}).drop(*gone)


def _shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def _said(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def rules(have: set[str], all_flags_needed: bool = False) -> dict[str, list[Column]]:
    """Error texts by rule, null where a cell is right; in the order of the attributes."""
    c = F.col
    conf = F.lit(CONFIDENTIAL)
    flagged = [a for a in ATTRIBUTES if f"{a}_CI" in have]
    known = [a for a in ATTRIBUTES if a in have]
    out: dict[str, list[Column]] = {}
    out["ci_val"] = [F.when(c(f"{a}_CI").isNotNull() & ~((c(f"{a}_CI") == conf) & F.lit(a != "T")), _said(f"{a}_CI_value=", _shown(c(f"{a}_CI")))) for a in flagged]
    out["ci_consis"] = [
        F.when(~(F.coalesce((c(f"{a}_CI") == conf) & (c(a) == conf), F.lit(False)) | (c(f"{a}_CI").isNull() & ~c(a).eqNullSafe(conf))), _said(f"{a}_CI_inconsistency_ci=", _shown(c(f"{a}_CI")), "_value=", _shown(c(a)))) for a in flagged
    ]
    out["ci_consis_1"] = [F.when((c(f"{a}_CI") == conf) & (c(a) > 0), _said(f"{a}_CI_inconsistency_1_ci=", _shown(c(f"{a}_CI")), "_value=", _shown(c(a)))) for a in flagged]
    if "POPULATED" in have:
        p, t = c("POPULATED"), c("T")
        out["populated_val"] = [F.when(~F.coalesce(p.isin(0, 1), F.lit(False)), _said("POPULATED_value=", _shown(p)))]
        wrong = F.coalesce((p == 1) & (t == 0), F.lit(False)) | (p.eqNullSafe(F.lit(0)) & ~t.eqNullSafe(F.lit(0)))
        out["populated_consis"] = [F.when(wrong, _said("POPULATED_T_inconsistency_POPULATED=", _shown(p), "_T=", _shown(t)))]
    out["pop_values_none"] = [F.when(c(a).isNull(), F.lit(f"{a}_none_value=None")) for a in known]
    out["pop_values_non_neg"] = [F.when((c(a) < 0) & (c(a) != conf), _said(f"{a}_negative_value=", _shown(c(a)))) for a in known]
    if "EMP" in have:
        out["emp_smaller_than_pop"] = [F.when(c("EMP") > c("T"), _said("EMP_T_inconsistency_EMP=", _shown(c("EMP")), "_T=", _shown(c("T"))))]
    for label, parts in CATEGORIES.items():
        if not set(parts) <= have:
            continue
        total = sum((F.coalesce(F.nullif(c(a), conf), F.lit(0)) for a in parts), F.lit(0))
        hidden = F.lit(False)
        for a in parts:
            if f"{a}_CI" in have:
                flag = c(f"{a}_CI")
                hidden = hidden | (~flag.eqNullSafe(F.lit(0)) if all_flags_needed else flag.eqNullSafe(conf))
        right = F.coalesce(total == c("T"), F.lit(False)) | (hidden & F.coalesce(total <= c("T"), F.lit(False)))
        out[f"cat_sum_{label.lower()}"] = [F.when(~right, _said(f"{label}_sum_T=", _shown(c("T")), "_SUM=", total.cast("string")))]
    return out


def validate(df: DataFrame, only: list[str] | None = None, all_flags_needed: bool = False) -> DataFrame:
    """GRD_ID, nb_errors, errors (comma-joined, in the rules' order) of the cells with errors.

    all_flags_needed: take a cell as confidential unless its flag is 0 (a known reading of the rules).
    """
    held = rules(set(df.columns), all_flags_needed)
    errors = F.array_compact(F.array(*[e for name, es in held.items() if only is None or name in only for e in es]))
    return df.select("GRD_ID", errors.alias("e")).where(F.size("e") > 0).select("GRD_ID", F.size("e").alias("nb_errors"), F.array_join("e", ",").alias("errors"))


def validate_each(df: DataFrame) -> DataFrame:
    """rule, GRD_ID, errors: every rule by itself, in one pass."""
    held = rules(set(df.columns))
    each = F.array(*[F.struct(F.lit(name).alias("rule"), F.array_compact(F.array(*es)).alias("e")) for name, es in held.items()])
    return df.select("GRD_ID", F.explode(each).alias("r")).where(F.size("r.e") > 0).select("r.rule", "GRD_ID", F.size("r.e").alias("nb_errors"), F.array_join("r.e", ",").alias("errors"))


def pivot_statistics(df: DataFrame, cell: str = "SPATIAL", stat: str = "STAT", value: str = "OBS_VALUE", names: list[str] | None = None) -> DataFrame:
    """A row for each cell, a column for each statistic. A cell with two values for one statistic raises when read."""
    one = F.when(F.count(value) > 1, F.raise_error(F.concat(F.lit("two values for one cell and statistic: "), F.max(F.col(cell).cast("string"))))).otherwise(F.first(value, ignorenulls=True))
    return df.groupBy(cell).pivot(stat, names).agg(one)


def theme(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[a for a in THEMES[name] if a in df.columns])
