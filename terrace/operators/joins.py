"""Join of a large table on a key when a few keys hold much of it.

A shuffle join deals rows by key, so a key with a third of all rows is one task, however
many machines there are. ``frequent_keys`` finds such keys with a summary of bounded size
per task, merged as it is aggregated (Spark's frequent items). ``split_join`` salts only
these keys: their rows of the large side go to ``salts`` places, the other side's rows of
these keys (a filtered few) are repeated for every place. All other rows keep salt 0 and
one place, so nothing else is repeated, and both kinds are one join with one exchange a side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is frequent from this share of all rows on; a summary then has 1 / SHARE keys at most.
SHARE = 0.01
#: Places of a frequent key: the share of one place is that of a key that is not frequent, or less.
SALTS = 64
_SALT, _KEY = "_join_salt", "_join_key"


def frequent_keys(rows: DataFrame, on: str, share: float = SHARE) -> list:
    """Non-null keys, among them every one with at least ``share`` of all rows; others may be named too.

    One pass over the key column; no task and not the driver holds more than ``1 / share`` keys.
    """
    keys = rows.select(F.col(on).alias(_KEY)).filter(F.col(_KEY).isNotNull())
    return sorted(keys.stat.freqItems([_KEY], support=share).first()[0] or [])


def split_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left", keys: list | None = None, salts: int = SALTS) -> DataFrame:
    """``left.join(right, on, how)`` with the frequent ``keys`` of ``left`` split (None: found by ``frequent_keys``).

    Of several columns the first is the one whose frequent values are split.

    Equal in rows and columns to the plain join for ``left``, ``inner``, ``left_semi`` and ``left_anti``:
    every row of ``left`` stands in one place, and every row of ``right`` with its key in that
    place once. Rows of ``left`` with a null key match nothing and are spread as well.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"rows of the right side are repeated, so not a {how} join")
    columns = [on] if isinstance(on, str) else list(on)
    key = columns[0]
    found = frequent_keys(left, key) if keys is None else keys
    frequent = F.col(key).isin(found) if found else F.lit(False)
    # the place in the input, not the row's content: equal rows are spread too
    place = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    salted = left.withColumn(_SALT, F.when(frequent | F.col(key).isNull(), place).otherwise(F.lit(0)))
    places = F.when(frequent, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.filter(F.col(key).isNotNull()).withColumn(_SALT, F.explode(places))
    return salted.join(repeated, [*columns, _SALT], how).drop(_SALT)
