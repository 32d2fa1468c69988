"""Sharding by histogram sort.

Rows are ordered by (hash of the text, id, place), so equal texts lie together.  The borders between
shards are found by counting: each pass sums the exact bytes in every cell of a grid laid over the
brackets that still hold a border, and keeps the cell where the wanted sum is passed, until what is
left to either side is within tolerance.  Then the rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from listing_lake.llm.tables import FILE, ROW, WHOLE, packed, written

#: The parts of the key, most significant first; each is a signed 64-bit number.
_KEY = ("_llm_hash", "_llm_id", FILE, ROW)
#: Bits of the key that one pass resolves: so many powers of two of probes in each bracket.
_PASS_BITS = 10
_LOWEST = -(1 << 63)


@dataclass(frozen=True)
class _Bracket:
    """The rows whose leading key parts equal ``fixed`` and whose next part, without its ``shift`` low bits, is ``cell``."""

    fixed: tuple[int, ...]
    cell: int
    shift: int
    below: int  #: bytes of all rows before the bracket
    inside: int
    rows: int

    def key(self) -> tuple[int, ...]:
        """The first key of the bracket."""
        low = (*self.fixed, self.cell << self.shift)
        return low + (_LOWEST,) * (len(_KEY) - len(low))

    def condition(self) -> Column:
        cond = F.shiftright(_KEY[len(self.fixed)], self.shift) == F.lit(self.cell).cast("long")
        for name, value in zip(_KEY, self.fixed):
            cond &= F.col(name) == F.lit(value).cast("long")
        return cond


def _counts(keyed: DataFrame, inside: list[_Bracket | None]) -> dict[int, list[_Bracket]]:
    """Bytes in each cell of the grid over each bracket; None stands for all rows.

    A pass brings at most ``2 ** _PASS_BITS`` sums per bracket to the driver, whatever the rows.
    """
    which, cell, grids = F.lit(None).cast("int"), F.lit(None).cast("long"), []
    for i, b in enumerate(inside):
        if b is None:
            fixed, shift = (), 64
        elif b.shift:
            fixed, shift = b.fixed, b.shift
        else:
            fixed, shift = (*b.fixed, b.cell), 64
        finer = max(0, shift - _PASS_BITS)
        value = F.shiftright(_KEY[len(fixed)], finer)
        cond = F.lit(True) if b is None else b.condition()
        which, cell = F.when(cond, F.lit(i)).otherwise(which), F.when(cond, value).otherwise(cell)
        grids.append((fixed, finer))
    sums = keyed.select(which.alias("i"), cell.alias("cell"), "_llm_size").filter("i IS NOT NULL").groupBy("i", "cell").agg(F.sum("_llm_size").alias("n"), F.count("*").alias("rows"))
    out: dict[int, list[_Bracket]] = {}
    for r in sorted(sums.collect(), key=lambda r: (r["i"], r["cell"])):
        own = out.setdefault(r["i"], [])
        below = own[-1].below + own[-1].inside if own else (inside[r["i"]].below if inside[r["i"]] else 0)
        own.append(_Bracket(grids[r["i"]][0], r["cell"], grids[r["i"]][1], below, r["n"], r["rows"]))
    return out


def splitters(keyed: DataFrame, shards: int, tolerance: float) -> list[tuple[int, ...]]:
    """First key of each shard but the first.

    A border is final when the rows before it hold the wanted bytes to within ``tolerance`` of a shard,
    or when its bracket is a single row.
    """
    grid = _counts(keyed, [None]).get(0, [])
    if not grid:
        return [(0,) * len(_KEY)] * (shards - 1)
    total = grid[-1].below + grid[-1].inside
    slack = tolerance * total / shards
    found: dict[int, tuple[int, ...]] = {}
    open_: dict[int, list[_Bracket]] = {s: grid for s in range(1, shards)}
    while open_:
        brackets: dict[_Bracket, list[int]] = {}
        for s, cells in open_.items():
            want = total * s / shards
            b = next((c for c in cells if c.below + c.inside >= want), cells[-1])
            after = b.below + b.inside
            if want - b.below <= slack:
                found[s] = b.key()
            elif after - want <= slack:
                found[s] = _after(b)
            elif b.rows == 1:
                found[s] = b.key() if want - b.below <= after - want else _after(b)
            else:
                brackets.setdefault(b, []).append(s)
        order = list(brackets)
        finer = _counts(keyed, order) if order else {}
        open_ = {s: finer[i] for i, b in enumerate(order) for s in brackets[b]}
    return [found[s] for s in range(1, shards)]


def _after(b: _Bracket) -> tuple[int, ...]:
    """The first key after the bracket."""
    parts = [*b.fixed, ((b.cell + 1) << b.shift) - 1]
    while parts and parts[-1] == (1 << 63) - 1:
        parts.pop()
    if not parts:
        return ((1 << 63) - 1,) * len(_KEY)
    parts[-1] += 1
    return (*parts, *(_LOWEST,) * (len(_KEY) - len(parts)))


def _not_before(key: tuple[int, ...]) -> Column:
    cond = F.col(_KEY[-1]) >= F.lit(key[-1]).cast("long")
    for name, value in list(zip(_KEY, key))[-2::-1]:
        v = F.lit(value).cast("long")
        cond = (F.col(name) > v) | ((F.col(name) == v) & cond)
    return cond


def shard(docs: DataFrame, columns: list[str] | None = None, shards: int = 8, tolerance: float = 0.001) -> DataFrame:
    """``columns`` of ``docs`` (all unless given) with ``size``, ``shard`` and ``slot``, ordered within each shard.

    Sizes are UTF-8 bytes of the text plus 1, and 1 for a null.  Shards differ from an equal share by
    ``tolerance`` of it and one document at most.  Equal texts lie next to each other, so a group is in
    one shard unless a border falls into it.  Rows with a null id come first among equal texts;
    repeated rows are told apart by their place.  Columns of ``docs`` named like the three are replaced.
    An empty table gives an empty result.
    """
    kept = [c for c in columns or docs.columns if c.lower() not in ("size", "shard", "slot")]
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    placed = packed(docs, "doc_id", "text")
    keys = [F.xxhash64("text").alias("_llm_hash"), F.coalesce("doc_id", F.lit(_LOWEST)).alias("_llm_id"), FILE, ROW]
    # narrow: the texts are read once more for the one exchange
    keyed = written(placed.select(size.alias("_llm_size"), *keys), "shard-keys")
    borders = splitters(keyed, shards, tolerance)
    number = sum((_not_before(k).cast("int") for k in borders), F.lit(0))
    whole = F.struct(*[F.col(WHOLE)[c].alias(c) for c in kept]).alias(WHOLE)
    numbered = placed.select(size.alias("_llm_size"), *keys, whole).withColumn("_llm_shard", number)
    # the one exchange; a position counts rows within a task, the upper bits of the number are the task
    ordered = written(
        numbered.repartitionByRange("_llm_shard", *_KEY).sortWithinPartitions("_llm_shard", *_KEY)
        .select("_llm_shard", "_llm_size", WHOLE, F.monotonically_increasing_id().alias("_llm_at")),
        "sharded",
    )
    task, at = F.shiftright("_llm_at", 33).alias("_llm_task"), F.col("_llm_at").bitwiseAND(F.lit((1 << 33) - 1))
    runs = ordered.groupBy("_llm_shard", task).agg(F.count("*").alias("_llm_rows"), F.min(at).alias("_llm_first"))
    before = Window.partitionBy("_llm_shard").orderBy("_llm_task").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each task, and one more for each border that falls into a task; written, so that its size
    # decides whether it is sent to all
    runs = written(
        runs.select("_llm_shard", "_llm_task", (F.coalesce(F.sum("_llm_rows").over(before), F.lit(0)) - F.col("_llm_first")).alias("_llm_offset")),
        "shard-runs",
    )
    placed = ordered.withColumn("_llm_task", task).join(runs, ["_llm_shard", "_llm_task"])
    return placed.select(f"{WHOLE}.*", F.col("_llm_size").alias("size"), F.col("_llm_shard").alias("shard"), (at + F.col("_llm_offset")).alias("slot"))
