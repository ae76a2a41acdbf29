"""Tables out of page geometry: cells from rulings, words put into them by their boxes.

Rulings are the cells' boxes (page_id, table_id, left, top, right, bottom), words are
boxes with text (page_id, number, left, top, right, bottom, text; a number is one
word of its page). Edges of a table that lie closer than a tolerance are one row or
column. Words meet cells in the tiles of a grid that both touch: they are compared
within a tile, and a pair counts in the tile of its intersection's corner only, so
no pair is met twice and a page's words are not compared with all of its cells.

Defined results: boxes may be given with their sides swapped; a word without area
lies where its centre lies; a word belongs to the cell that holds most of it, at
least half (ties: the first table, row and column); cells without words have an
empty text; words with a null box or text lie nowhere; no rulings, no cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.functions import records as N
from concord.operators.relational import gap_clusters

#: Side of a tile of the grid in points, least part of a word that lies in its cell, and edges that are one (fixed values).
TILE, LEAST, TOLERANCE = 72.0, 0.5, 1e-3
_SIDES = ("left", "top", "right", "bottom")


def _boxed(df: DataFrame) -> DataFrame:
    """Sides in order, as one struct."""
    sides = (F.least("left", "right"), F.least("top", "bottom"), F.greatest("left", "right"), F.greatest("top", "bottom"))
    known = F.coalesce(*(F.when(F.col(c).isNull(), F.lit(False)) for c in _SIDES), F.lit(True))
    return df.where(known).withColumn("box", F.struct(*(s.cast("double").alias(c) for s, c in zip(sides, _SIDES, strict=True)))).drop(*_SIDES)


def _tile(x: Column) -> Column:
    return F.floor(x / TILE)


def _tiled(df: DataFrame) -> DataFrame:
    """A row for each tile that the box touches."""
    along = lambda a, b: F.explode(F.sequence(_tile(F.col(f"box.{a}")), _tile(F.col(f"box.{b}"))))
    return df.withColumn("tx", along("left", "right")).withColumn("ty", along("top", "bottom"))


def _edged(rulings: DataFrame, tolerance: float) -> DataFrame:
    """The rulings with their row and col."""
    cells, of = _boxed(rulings).withColumn("_top", F.col("box.top")).withColumn("_left", F.col("box.left")), ["page_id", "table_id"]
    rows = gap_clusters(cells, of, "_top", tolerance).withColumnRenamed("cluster", "row")
    return gap_clusters(rows, of, "_left", tolerance).withColumnRenamed("cluster", "col").select("page_id", "table_id", "row", "col", "box")


def grid_cells(rulings: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """page_id, table_id, row, col, box: rows and columns numbered from 0 by the clusters of the cells' top and left edges; of cells at one place the first stays."""
    return _edged(rulings, tolerance).groupBy("page_id", "table_id", "row", "col").agg(F.min("box").alias("box"))


def place_words(words: DataFrame, cells: DataFrame, least: float = LEAST) -> DataFrame:
    """The words that lie in a cell, with its table_id, row and col."""
    word, cell = ["number", "text", "box"], ["table_id", "row", "col", "box"]
    w = _tiled(_boxed(words.where("text is not null and page_id is not null")).select("page_id", *word))
    c = _tiled(cells.where("page_id is not null").select("page_id", *cell))
    # what touches a tile, gathered and not joined, as a grouping keeps to the pages' partitions
    tile = ["page_id", "tx", "ty"]
    both = w.select(*tile, F.struct(*word).alias("w")).unionByName(c.select(*tile, F.struct(*cell).alias("c")), allowMissingColumns=True)
    tiles = both.groupBy(*tile).agg(F.collect_list("w").alias("ws"), F.collect_list("c").alias("cs")).where((F.size("ws") > 0) & (F.size("cs") > 0))
    met = tiles.select(*tile, F.explode("ws").alias("w"), "cs").select(*tile, "w", F.explode("cs").alias("c"))
    corner = (_tile(F.greatest("w.box.left", "c.box.left")) == F.col("tx")) & (_tile(F.greatest("w.box.top", "c.box.top")) == F.col("ty"))
    held = met.where(corner).withColumn("part", N.overlap_ratio(F.col("w.box"), F.col("c.box"))).where(F.col("part") >= least)
    best = held.groupBy("page_id", F.col("w.number").alias("number")).agg(F.min(F.struct((-F.col("part")).alias("less"), "c.table_id", "c.row", "c.col", "w.text", "w.box")).alias("m"))
    return best.select("page_id", "number", "m.text", "m.box", "m.table_id", "m.row", "m.col")


def table_cells(words: DataFrame, rulings: DataFrame, tolerance: float = TOLERANCE, least: float = LEAST) -> DataFrame:
    """page_id, table_id, row, col, text, box of every cell; its words joined by blanks in the order of top, left and number.

    All steps are windows, groupings and unions within a page: words and rulings that
    are dealt out by page_id alike, to as many partitions, are not dealt out again.
    """
    edged, place = _edged(rulings, tolerance), ["page_id", "table_id", "row", "col"]
    placed = place_words(words, edged.groupBy(*place).agg(F.min("box").alias("box")), least)
    # a cell and its words
    both = edged.unionByName(placed.select(*place, F.struct("box.top", "box.left", "number", "text").alias("w")), allowMissingColumns=True)
    cells = both.groupBy(*place).agg(F.array_sort(F.collect_list("w")).alias("w"), F.min("box").alias("box"))
    return cells.select(*place, F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"), "box")


def page_blocks(records: DataFrame, rulings: DataFrame, tolerance: float = TOLERANCE, least: float = LEAST) -> DataFrame:
    """page_id, pos, type, text, table_id: a page's tables (rows as lines, cells between tabulators) and the text records outside of them, by top and left.

    A record of which at least half lies in a table is the table's text and no block of its own.
    """
    sides = [*(F.min(f"box.{c}").alias(c) for c in ("left", "top")), *(F.max(f"box.{c}").alias(c) for c in ("right", "bottom"))]
    cells = table_cells(records, rulings, tolerance, least)
    lines = cells.groupBy("page_id", "table_id", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda x: x["text"]), "\t").alias("line"), *sides)
    tables = lines.groupBy("page_id", "table_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda x: x["line"]), "\n").alias("text"), *(F.min(c).alias(c) for c in ("left", "top")), *(F.max(c).alias(c) for c in ("right", "bottom")))
    # the tables' places need no words
    whole = _boxed(grid_cells(rulings, tolerance).groupBy("page_id", "table_id").agg(*sides)).withColumn("row", F.lit(0)).withColumn("col", F.lit(0))
    boxed = _boxed(records.where("text is not null")).select("page_id", "number", "text", "box")
    marked = boxed.unionByName(place_words(records, whole, least).select("page_id", "number", F.lit(True).alias("within")), allowMissingColumns=True)
    within = F.max("within").over(Window.partitionBy("page_id", "number"))
    loose = marked.withColumn("placed", within).where("within is null and (placed is null or page_id is null or number is null)")
    blocks = loose.select("page_id", F.col("box.top").alias("top"), F.col("box.left").alias("left"), "number", F.lit("PARAGRAPH").alias("type"), "text", F.lit(None).cast(rulings.schema["table_id"].dataType).alias("table_id"))
    blocks = blocks.unionByName(_boxed(tables).select("page_id", "box.top", "box.left", F.lit(None).cast(records.schema["number"].dataType).alias("number"), F.lit("TABLE").alias("type"), "text", "table_id"))
    # the blocks of one page
    order = Window.partitionBy("page_id").orderBy("top", "left", F.asc_nulls_last("number"), "table_id")
    return blocks.select("page_id", (F.row_number().over(order) - 1).alias("pos"), "type", "text", "table_id")
