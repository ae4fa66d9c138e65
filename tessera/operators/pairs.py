"""Pairing predictions with references, and resolving which columns play which role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_by_id(refs: DataFrame, preds: DataFrame, keys: list, strict: bool = True, order: str | None = None) -> DataFrame:
    """References drive: every reference row comes out with its prediction.

    Extra predictions are ignored.  Of several predictions for one key the last
    in ``order`` wins (an aggregate, so a key with many copies is reduced before
    the shuffle).  A reference without prediction fails the job under
    ``strict``; otherwise its prediction columns are NULL and ``matched`` false."""
    others = [c for c in preds.columns if c not in keys and c != order]
    row = F.struct(*[F.col(c) for c in others])
    pick = F.max_by(row, F.col(order)) if order else F.first(row)
    one = preds.groupBy(*keys).agg(pick.alias("_p")).select(*keys, *[F.col(f"_p.{c}").alias(c) for c in others],
                                                            F.lit(True).alias("matched"))
    out = refs.join(one, keys, "left").withColumn("matched", F.coalesce("matched", F.lit(False)))
    if strict:
        told = F.concat(F.lit("no prediction for "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
        out = out.withColumn("matched", F.when(F.col("matched"), F.lit(True)).otherwise(F.raise_error(told).cast("boolean")))
    return out


def resolve_columns(df: DataFrame, roles: dict[str, str | None], defaults: dict[str, str] | None = None) -> dict[str, str]:
    """Role -> column: the column named for the role (it must exist), else the
    role's default name if the table has it, else the table's first, second,
    third column in the order of the roles."""
    defaults, out = defaults or {}, {}
    for place, (role, name) in enumerate(roles.items()):
        if name is not None:
            if name not in df.columns:
                raise ValueError(f"{role}: column {name!r} is none of {', '.join(df.columns)}")
            out[role] = name
        elif defaults.get(role) in df.columns:
            out[role] = defaults[role]
        elif place < len(df.columns):
            out[role] = df.columns[place]
        else:
            raise ValueError(f"{role}: the table has only {len(df.columns)} columns")
    return out


def with_optional_label(df: DataFrame, label: str, encode) -> DataFrame:
    """``encode(df)`` where the label column is there (training rows), else ``df`` as it is (inference rows)."""
    return encode(df) if label in df.columns else df
