"""Suffix sums along linked lists that are spread over the cluster.

Each round splices out an independent set: an element whose coin shows 1 leaves when the coin of the
one before it shows 0, so a quarter of the list goes at a time and the work of all rounds
together is a few times the list. Coins are hashes of the element and the round, so an element knows
its neighbour's coin without asking, and every element is shuffled once in a round. When at most
``REST`` elements are left they are walked in one task; then the rounds are undone in reverse.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from limitlens.llm.tables import keep

# The rest of all lists that one task may walk; a constant, whatever the input.
REST = 10_000


def _coin(element: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(element, F.lit(turn)), F.lit(2)) == 1


def _walk(weights: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        after = {r["id"]: r for r in rows}
        heads = after.keys() - {r["next"] for r in rows}
        out = []
        for head in heads:
            chain, at = [], head
            while at is not None:
                chain.append(after[at])
                at = after[at]["next"]
            total = [0] * len(weights)
            for row in reversed(chain):
                total = [t + row[w] for t, w in zip(total, weights, strict=True)]
                out.append((row["id"], *total))
        columns = list(zip(*out, strict=True)) if out else [[]] * (len(weights) + 1)
        kinds = [pa.binary()] + [pa.int64()] * len(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", *weights]
        )

    return run


def suffix_sums(links: DataFrame, weights: Sequence[str], rest: int = REST) -> DataFrame:
    """(id, weights): for each element the sums of the weights from it to the end of its list.

    ``links`` has a binary ``id`` (distinct, not null), ``next`` (the id of the following element, null at the end)
    and long weights. An empty frame gives an empty one.
    """
    weights = list(weights)
    active, turn = keep(links.select("id", "next", *weights), "list-0"), 0
    levels: list[DataFrame] = []
    while active.count() > rest:
        turn += 1
        splices = F.col("next").isNotNull() & ~_coin(F.col("id"), turn) & _coin(F.col("next"), turn)
        before = active.where(splices).select(
            F.col("id").alias("_p"), F.col("next").alias("_at"), *[F.col(w).alias(f"_p_{w}") for w in weights]
        )
        level = keep(
            active.where(~splices).join(before, F.col("id") == F.col("_at"), "left").drop("_at"), f"list-{turn}"
        )
        levels.append(level)
        active = level.select(
            F.coalesce("_p", "id").alias("id"), "next",
            *[(F.col(w) + F.coalesce(F.col(f"_p_{w}"), F.lit(0))).alias(w) for w in weights],
        )
    kinds = ", ".join(["id binary", *[f"{w} long" for w in weights]])
    ranks = active.repartition(1).mapInArrow(_walk(weights), kinds)
    for i, level in enumerate(reversed(levels)):
        ranks = keep(ranks, f"ranks-{i}")
        ahead = ranks.select(F.col("id").alias("_n"), *[F.col(w).alias(f"_n_{w}") for w in weights])
        undone = level.where("_p is not null").select("id", "next", *weights).join(
            ahead, F.col("next") == F.col("_n"), "left"
        )
        ranks = ranks.unionByName(
            undone.select("id", *[(F.col(w) + F.coalesce(F.col(f"_n_{w}"), F.lit(0))).alias(w) for w in weights])
        )
    return ranks
