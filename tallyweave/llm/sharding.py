"""Proportional stratified interleaving: shards of near-equal row counts that all have the corpus's mixture.

Rows are shuffled by a seeded hash within their source, the k-th of n rows (from 0) gets the fraction (k + u) / n, u
being drawn from [0, 1) by the source's name so that small sources do not meet in one place, and all
rows are laid out by that fraction. Any stretch of that order holds every source in proportion, so cutting it into
equal stretches gives shards that match the mixture to within a row per source.

Both orders are global, but no source and no stretch is ever gathered in one task: rows are counted in
cells (of the hash, then of the fraction), cells are added up in blocks and blocks after them, and only within a cell are rows numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch

#: Rows in a cell, about.
CELL_ROWS = 1000
#: Cells in a block. One task adds up the blocks of a group: a row for each 10^6 rows of the table.
BLOCK_CELLS = 1000


def _numbered(rows: DataFrame, group: list[str], cell: str, order: list[str], as_name: str) -> DataFrame:
    """Add the 0-based place of each row of its group by (cell, order), and the group's size."""
    counts = rows.groupBy(*group, cell).agg(F.count("*").alias("_in_cell")).withColumn("_block", F.expr(f"{cell} div {BLOCK_CELLS}"))
    whole, block = Window.partitionBy(*group), Window.partitionBy(*group, "_block")
    blocks = counts.groupBy(*group, "_block").agg(F.sum("_in_cell").alias("_in_block"))
    blocks = blocks.select(
        *group,
        "_block",
        (F.sum("_in_block").over(whole.orderBy("_block")) - F.col("_in_block")).alias("_before_block"),
        F.sum("_in_block").over(whole).alias(f"{as_name}_of"),
    )
    counts = counts.withColumn("_before_cell", F.sum("_in_cell").over(block.orderBy(cell)) - F.col("_in_cell"))
    cells = counts.join(blocks, [*group, "_block"]).select(*group, cell, (F.col("_before_block") + F.col("_before_cell")).alias("_before"), f"{as_name}_of")
    keys = [*group, cell]
    placed = rows.withColumn("_in", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return placed.join(cells, keys).withColumn(as_name, F.col("_before") + F.col("_in") - 1).drop("_in", "_before")


def interleave(rows: DataFrame, source: Column, row_id: Column, shards: int, scratch: Scratch, seed: int = 17) -> DataFrame:
    """`rows` with shard (0 to shards - 1) and slot (gapless from 0 in each shard) added.

    Shards differ by one row at most, and in every source by one row per neighbour. A null source is a source of
    its own. Repeated rows, ties and null ids each get a place: ties are broken by the id and then by the row's
    content, so equal rows are interchangeable. Null, empty and long texts are carried as they are; a long text costs two writes of it. With fewer rows than shards some shards stay empty; an
    empty table gives an empty one. Existing columns shard or slot are replaced.
    """
    rows = rows.drop("shard", "slot")
    whole = F.struct(*[rows[c] for c in rows.columns])
    keyed = rows.select(
        whole.alias("_row"),
        F.coalesce(source.cast("string"), F.lit("")).alias("_name"),
        source.isNull().alias("_none"),
        F.xxhash64(row_id.cast("string"), F.lit(seed), whole).alias("_hash"),
        row_id.cast("string").alias("_id"),
    )
    keyed = scratch.write(keyed, "keyed")
    total = keyed.count()
    cells = max(1, -(-total // CELL_ROWS))
    dealt = keyed.withColumn("_cell", F.shiftrightunsigned("_hash", 33) % cells)
    stratum = ["_name", "_none"]
    ranked = _numbered(dealt, stratum, "_cell", ["_hash", "_id", "_row"], "_rank").drop("_cell")
    # The fraction as a whole number of 10^-18, u as one of 2^-20: exact and the same everywhere.
    ranked = ranked.withColumn("_u", F.shiftrightunsigned(F.xxhash64("_name", "_none", F.lit(seed)), 44))
    ranked = ranked.withColumn("_at", F.expr("cast((cast(_rank * 1048576 + _u as decimal(20,0)) * 1000000000000000000) div (_rank_of * 1048576) as bigint)"))
    laid = ranked.withColumn("_cell", F.expr(f"cast(cast(_at as decimal(20,0)) * {cells} div 1000000000000000000 as bigint)")).withColumn("_all", F.lit(0))
    laid = scratch.write(laid.drop("_rank", "_rank_of", "_hash", "_u"), "laid")
    placed = _numbered(laid, ["_all"], "_cell", ["_at", "_name", "_none", "_id", "_row"], "_place")
    shard = F.expr(f"_place * {shards} div {max(1, total)}")
    first = F.expr(f"(shard * {max(1, total)} + {shards} - 1) div {shards}")
    return placed.withColumn("shard", shard).select("_row.*", F.col("shard").cast("int").alias("shard"), (F.col("_place") - first).alias("slot"))
