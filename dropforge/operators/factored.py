"""A join kept as its two sides, for keys that many rows of both share.

Where a key has l rows on one side and r on the other, the join has l * r of them; the two sides have l + r. ``Factored``
holds the sides, tells how many rows the join would have by key without making any, and expands when asked, all of it or
chosen keys.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEFT, RIGHT = "__left", "__right"


@dataclass(frozen=True)
class Factored:
    """The inner join of ``left`` and ``right`` on one column each; null keys join with nothing."""

    left: DataFrame
    right: DataFrame
    left_key: str
    right_key: str

    def counts(self) -> DataFrame:
        """``key, left_rows, right_rows, pairs`` of the keys that both sides have; counted before anything is joined."""
        sides = [
            df.groupBy(F.col(f"`{key}`").alias("key")).agg(F.count(F.lit(1)).alias(name))
            for df, key, name in ((self.left, self.left_key, "left_rows"), (self.right, self.right_key, "right_rows"))
        ]
        return sides[0].join(sides[1], "key").withColumn("pairs", F.col("left_rows") * F.col("right_rows"))

    def expand(self, keys: Iterable | None = None) -> DataFrame:
        """The joined rows, of the given ``keys`` alone if there are any; the left columns, then the right ones."""
        left, right = self.left, self.right
        if keys is not None:
            keys = list(keys)
            left, right = left.where(F.col(f"`{self.left_key}`").isin(keys)), right.where(F.col(f"`{self.right_key}`").isin(keys))
        return left.join(right, left[f"`{self.left_key}`"] == right[f"`{self.right_key}`"])

    def save(self, store, name: str) -> None:
        """Keep the rows of both sides that have a partner, as two tables of one commit."""
        keys = self.counts().select("key")
        with store.commit() as run:
            for df, key, side in ((self.left, self.left_key, LEFT), (self.right, self.right_key, RIGHT)):
                run.save(df.join(keys, df[f"`{key}`"] == keys["key"], "left_semi"), name + side)

    @staticmethod
    def read(store, name: str, left_key: str, right_key: str) -> Factored:
        read = store.snapshot()
        return Factored(read(name + LEFT), read(name + RIGHT), left_key, right_key)
