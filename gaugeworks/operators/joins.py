"""Reconciliation joins (R-27 to R-30)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: A key is heavy with more than this share of a side's rows, so at most 100 keys of a side are.
HEAVY = 0.01


def full_outer(left: DataFrame, right: DataFrame, key: str, spread: int = 1) -> DataFrame:
    """Full outer equi-join; the result has two struct columns, ``l`` and ``r``, NULL where unmatched.

    NULL keys match nothing and are kept.  One join, so that chains grow by one join a link.  With ``spread``
    above 1 the rows of a heavy key are dealt to so many tasks on one side and copied to each of them on the
    other; a sketch of each side, which reads it once more, finds the heavy keys.
    """
    lefts = left.select(F.col(key).alias("__left"), F.struct(*left.columns).alias("l"))
    rights = right.select(F.col(key).alias("__right"), F.struct(*right.columns).alias("r"))
    same = F.col("__left") == F.col("__right")
    if spread == 1:
        return lefts.join(rights, same, "full_outer").select("l", "r")
    by_left, by_right = _heavy_keys(left, key), _heavy_keys(right, key)
    lefts = _placed(lefts, "l", "__left", by_left, by_right, True, spread)
    rights = _placed(rights, "r", "__right", by_left, by_right, False, spread)
    joined = lefts.join(rights, same & (F.col("__l_place") == F.col("__r_place")), "full_outer")
    # The dealt side holds the key, so a copied row has a match in some task; copies without one are surplus.
    surplus = (F.col("r").isNull() & F.col("__l_copied")) | (F.col("l").isNull() & F.col("__r_copied"))
    return joined.where(~F.coalesce(surplus, F.lit(False))).select("l", "r")


def _heavy_keys(side: DataFrame, key: str) -> Column:
    """Array of the keys that hold more than HEAVY of a side's rows; keys of the sketch do occur."""
    most = int(1 / HEAVY)
    found = side.select(F.col(key).alias("__key")).agg(
        F.expr(f"approx_top_k(__key, {most}, {100 * most})").alias("top"), F.count("__key").alias("n")
    )
    heavy = F.filter("top", lambda t: t["item"].isNotNull() & (t["count"] > F.col("n") * HEAVY))
    return found.select(F.transform(heavy, lambda t: t["item"])).scalar()


def _placed(side: DataFrame, row: str, key: str, by_left: Column, by_right: Column, is_left: bool, spread: int) -> DataFrame:
    """Each row with its place: rows of a key heavy on their own side are dealt, those of a key heavy on the other
    side copied to every place.  A key heavy on both sides is dealt on the left."""
    held = lambda keys: F.coalesce(F.array_contains(keys, F.col(key)), F.lit(False))
    on_left = held(by_left)
    on_right = ~on_left & held(by_right)
    dealt, copied = (on_left, on_right) if is_left else (on_right, on_left)
    one = F.when(dealt, F.pmod(F.xxhash64(row), F.lit(spread)).cast("int")).otherwise(F.lit(0))
    places = F.when(copied, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(one))
    return side.select(key, row, copied.alias(f"__{row}_copied"), F.explode(places).alias(f"__{row}_place"))


def not_in(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """``column NOT IN (SELECT key FROM keys)`` with its NULL rules, without broadcasting the keys (R-30).

    No row is left if a key is NULL; every row, NULLs included, if there are no keys at all.
    """
    counts = keys.agg(F.count("*").alias("n"), F.count_if(F.col(key).isNull()).alias("nulls"))
    n, nulls = counts.select("n").scalar(), counts.select("nulls").scalar()
    known = keys.select(F.col(key).alias("__known")).distinct()
    absent = df.join(known, F.col(column) == F.col("__known"), "left_anti")
    return absent.where((n == 0) | ((nulls == 0) & F.col(column).isNotNull()))
