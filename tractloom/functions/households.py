"""Household table tokens: status, value and detail of an estimate and its margin of error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special codes of the published table with the status and detail they stand for.
SPECIAL = {
    -999999999: ("suppressed", "N_INSUFFICIENT_SAMPLE_CASES"),
    -888888888: ("inapplicable", "X_NOT_APPLICABLE_OR_AVAILABLE"),
    -777777777: ("invalid", "Z_SPECIAL_VALUE_UNAUTHORIZED_FOR_B11001"),
    -666666666: ("missing", "INSUFFICIENT_SAMPLE_OBSERVATIONS"),
    -555555555: ("inapplicable", "CONTROLLED_ESTIMATE_MOE_NOT_APPLICABLE"),
    -333333333: ("inapplicable", "OPEN_INTERVAL_MEDIAN_MOE_NOT_APPLICABLE"),
    -222222222: ("missing", "MOE_INSUFFICIENT_SAMPLE_OBSERVATIONS"),
}
STATUSES = ("valid", "missing", "inapplicable", "suppressed", "invalid")  # from best to worst
INTEGER = r"\A-?[0-9]+\z"


def token(raw: Column, field: str) -> Column:
    """struct (value, status, detail) of a raw token; integers beyond a long are invalid, not nulled silently."""
    number = F.when(raw.rlike(INTEGER), raw.try_cast("decimal(38,0)"))
    value = number.try_cast("bigint")

    def case(otherwise: str, of: dict[int, str], negative: str, empty: str, text: str, wide: str) -> Column:
        c = F.when(raw.isNull() | (raw == ""), empty).when(~raw.rlike(INTEGER), text).when(value.isNull(), wide)
        for code, answer in of.items():
            c = c.when(value == code, answer)
        return c.when(value < 0, negative).otherwise(otherwise)

    status = case("valid", {k: v[0] for k, v in SPECIAL.items()}, "invalid", "missing", "invalid", "invalid")
    detail = case(
        f"{field}_PUBLISHED_INTEGER", {k: f"{field}_{v[1]}" for k, v in SPECIAL.items()}, f"{field}_NEGATIVE_UNRECOGNIZED", f"{field}_EMPTY", f"{field}_NONINTEGER", f"{field}_OUT_OF_RANGE"
    )
    return F.struct(F.when(status == "valid", value).alias("value"), status.alias("status"), detail.alias("detail"))


def worst(*statuses: Column) -> Column:
    """The worst of the statuses."""
    ranked = F.array(*[F.lit(s) for s in STATUSES])
    return F.element_at(ranked, F.greatest(*[F.array_position(ranked, s) for s in statuses]).cast("int"))


def parsed(raw_estimate: Column, raw_moe: Column) -> Column:
    """struct (estimate, moe, status, status_detail) of both tokens."""
    e, m = token(raw_estimate, "estimate"), token(raw_moe, "moe")
    return F.struct(
        e["value"].alias("estimate"), m["value"].alias("moe"), worst(e["status"], m["status"]).alias("status"),
        F.struct(e["detail"].alias("estimate"), m["detail"].alias("moe")).alias("status_detail"),
    )
