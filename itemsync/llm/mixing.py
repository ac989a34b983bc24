"""Mixing sources to target weights by Pfair scheduling.

Every source's rows are dealt into blocks of ``block_rows``, in an order given by a
hash of the id. With ``shares`` of ``a`` out of ``d`` in all, block ``k`` (from 1)
may be placed from slot ``floor((k - 1) * d / a)`` on and must be placed before slot
``ceil(k * d / a)``. In each slot the released block with the earliest deadline goes
next, so after every slot each source is less than one block away from its target.
The windows repeat every ``d`` slots; one period is worked out from the shares
alone, and a block's slot follows from its number by arithmetic.

Every row is kept. Slots before ``in_mix`` ends hold the exact mix; behind that the
first exhausted source leaves its slots empty and the rows that remain keep their
order.

Every source of the table is scheduled on its own: those that ``shares`` does not name
have the share ``other`` each. A null source is a source of its own. Only where the
shares would sum to more than ``MOST_SHARES``, the unnamed sources of the fewest rows
are dealt together as one. Ties go to the smaller source, null first. Null ids come first in a source's order; repeated rows
follow each other in any order, and their positions differ. Other columns of the
table are neither read nor kept.
"""

from __future__ import annotations

from heapq import heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK_ROWS = 8
#: Shares by which a mix is known exactly: one period has as many slots.
MOST_SHARES = 10_000
#: Leading hexadecimal digits of the hash that cut a source into pieces, so that no task holds a source.
DIGITS = 3


def period(shares: list[int]) -> list[list[int]]:
    """The slots of each share in one period, by earliest deadline first; ties go to the earlier share."""
    total = sum(shares)
    if not 0 < total <= MOST_SHARES or min(shares) < 1:
        raise ValueError(f"shares must be positive and sum to {MOST_SHARES} at most")
    placed: list[list[int]] = [[] for _ in shares]
    # a share's next block waits for its release, then goes by its deadline
    waiting = [(0, i) for i in range(len(shares))]
    ready: list[tuple[int, int]] = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, i = heappop(waiting)
            heappush(ready, (-(-(len(placed[i]) + 1) * total // shares[i]), i))
        _, i = heappop(ready)
        placed[i].append(slot)
        if len(placed[i]) < shares[i]:
            heappush(waiting, (len(placed[i]) * total // shares[i], i))
    return placed


def _numbered(docs: DataFrame, digits: int) -> DataFrame:
    """Rows of each group numbered from 0 in the order of the id's MD5, without a window over a group."""
    mark = F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))
    cut = docs.withColumn("_mark", mark).withColumn("_piece", F.substring("_mark", 1, digits))
    sizes = cut.groupBy("_group", "_piece").agg(F.count("*").alias("_n"))
    # at most 16 ** digits rows of a group
    before = Window.partitionBy("_group").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_group", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_group", "_piece").orderBy("_mark", "doc_id", "source")
    ranked = cut.withColumn("_rank", F.row_number().over(inside) - 1)
    return ranked.join(starts, ["_group", "_piece"]).withColumn("_at", F.col("_start") + F.col("_rank"))


def scheduled(docs: DataFrame, shares: dict[str, int], other: int) -> list[tuple[bool, str | None, int, int]]:
    """The groups of a mix in order: (whether it is one source, the source, its share, its rows).

    A row per source comes to the driver, at most ``MOST_SHARES`` of them.
    """
    if other < 1 or min(shares.values(), default=1) < 1 or sum(shares.values()) > MOST_SHARES:
        raise ValueError(f"shares must be positive and sum to {MOST_SHARES} at most")
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    named = F.coalesce(F.col("source").isin(*shares), F.lit(False)) if shares else F.lit(False)
    own = [(True, r["source"], shares[r["source"]], r["n"]) for r in counts.where(named).collect()]
    room = (MOST_SHARES - sum(share for _, _, share, _ in own)) // other
    rest = counts.where(~named)
    total, rows = rest.agg(F.count("*"), F.sum("n")).first()
    several = room if total <= room else room - 1
    most = rest.orderBy(F.desc("n"), "source").limit(max(several, 0)).collect()
    own += [(True, r["source"], other, r["n"]) for r in most]
    own.sort(key=lambda g: (g[1] is not None, g[1] or ""))
    pooled = (rows or 0) - sum(r["n"] for r in most)
    return [*own, (False, None, other, pooled)] if pooled else own


def mixed(
    docs: DataFrame, shares: dict[str, int], other: int = 1, block_rows: int = BLOCK_ROWS, digits: int = DIGITS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, slot, place, position, in_mix.

    ``position`` is slot * block_rows + place; ascending, it is the order of the mix.
    """
    rows = docs.select("doc_id", "source")
    groups = scheduled(rows, shares, other) or [(False, None, other, 0)]
    placed, total = period([share for _, _, share, _ in groups]), sum(share for _, _, share, _ in groups)
    # the first slot that a group would fill with a block that it lacks or has in part only
    end = min(
        n // block_rows // share * total + slots[n // block_rows % share]
        for (_, _, share, n), slots in zip(groups, placed, strict=True)
    )
    listed = [
        F.struct(
            F.lit(single).alias("_single"),
            F.lit(name).cast("string").alias("_source"),
            F.lit(i).alias("_group"),
            F.array(*map(F.lit, slots)).alias("_slots"),
        )
        for i, ((single, name, _, _), slots) in enumerate(zip(groups, placed, strict=True))
    ]
    plan = docs.sparkSession.range(1).select(F.inline(F.array(*listed)))
    # a row per group and a number per slot of the period: bounded by MOST_SHARES
    own = F.broadcast(plan.where("_single").drop("_single"))
    joined = rows.join(own, F.col("source").eqNullSafe(F.col("_source")), "left")
    pool = F.array(*map(F.lit, placed[-1])) if not groups[-1][0] else F.array().cast("array<int>")
    dealt = joined.select(
        "doc_id",
        "source",
        F.coalesce("_group", F.lit(len(groups) - 1)).alias("_group"),
        F.coalesce("_slots", pool).alias("_slots"),
    )
    numbered = _numbered(dealt, digits)
    block, share = F.floor(F.col("_at") / block_rows), F.size("_slots")
    inside = F.element_at("_slots", F.pmod(block, share).cast("int") + 1)
    slot = F.floor(block / share) * total + inside
    place = F.pmod(F.col("_at"), F.lit(block_rows))
    return numbered.select(
        "doc_id",
        "source",
        slot.alias("slot"),
        place.alias("place"),
        (slot * block_rows + place).alias("position"),
        (slot < end).alias("in_mix"),
    )
