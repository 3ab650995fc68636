"""Records of CSV files with line breaks inside quotes, read split by split at any size.

Only a line feed is a physical line's end here; carriage returns stay in the text. Whether a
line begins inside quotes depends on all lines before it, but only through two states, so a
line is a map of states: what it leads to from outside of quotes, and from inside. Most maps
are constant or change nothing, so the state before a line is that after the last constant
one, turned over by every swap since. Running sums over the lines of a split give that for
both states the split may begin in; the splits' own maps, one row each, give the states.

A quote that does not begin a field is text, as is what follows a closing quote up to the
next comma.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.operators.attach import attach
from millrace.session import written

_BLOCK_UNIT = 256
_COUNTER_BITS = 28

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_FIELD = rf'(?:{_QUOTED}[^,\r]*+|[^",\r][^,\r]*+)?+'
# A line, begun outside of quotes, that ends inside of them.
OPEN = rf'^(?:{_FIELD}[,\r])*+"[^"]*+(?:""[^"]*+)*+$'
# What is left of a quoted field that an earlier line began.
_CLOSE = r'^[^"]*+(?:""[^"]*+)*+"'
_RECORD = rf"(?:{_FIELD},)*+{_FIELD}"


def row_place() -> Column:
    """Order of a scanned row within its file, as one number.

    The split's start in units of 256 bytes, then the reader's row counter, which has 28 bits
    for the rows of one split (and all bits in a file that is one split).
    """
    block = F.floor(F.col("_metadata.file_block_start") / _BLOCK_UNIT).cast("bigint")
    counter = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.shiftleft(block, _COUNTER_BITS) + counter


def without_end(line: Column) -> Column:
    """A physical line without the carriage return before its line feed."""
    return F.when(line.endswith("\r"), F.rtrim(line, F.lit("\r"))).otherwise(line)


def opens(line: Column) -> Column:
    """Whether a line that begins outside of quotes ends inside of them."""
    return line.contains('"') & line.rlike(OPEN)


def _stays(line: Column) -> Column:
    """Whether a line that begins inside of quotes ends inside of them."""
    rest = F.regexp_replace(line, _CLOSE, "x")
    return ~(line.contains('"') & line.rlike(_CLOSE)) | rest.rlike(OPEN)


def _with_states(rows: DataFrame, outside: str, inside: str, by: list[str], order: str) -> DataFrame:
    """Add `_from_out` and `_from_in`: inside of quotes or not before the row, for both beginnings."""
    a, b = F.col(outside), F.col(inside)
    upto = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    swap = (a & ~b).cast("int")
    rows = rows.withColumn("_swaps", F.sum(swap).over(upto))
    constant = F.when(a == b, F.struct(a.alias("to"), F.col("_swaps").alias("swaps")))
    rows = rows.withColumn("_fixed", F.last(constant, ignorenulls=True).over(earlier))
    known = F.col("_fixed").isNotNull()
    odd = (F.col("_swaps") - swap - F.coalesce("_fixed.swaps", F.lit(0))) % 2 == 1
    settled = F.col("_fixed.to") != odd
    rows = rows.withColumn("_from_out", F.when(known, settled).otherwise(odd))
    rows = rows.withColumn("_from_in", F.when(known, settled).otherwise(~odd))
    return rows.drop("_swaps", "_fixed")


class Records:
    """Records of the lines (_path, _block, _place, value) of some files."""

    def __init__(self, lines: DataFrame):
        split = ["_path", "_block"]
        mapped = lines.withColumn("_out", opens(F.col("value"))).withColumn("_in", _stays(F.col("value")))
        marked = _with_states(mapped, "_out", "_in", split, "_place")
        upto = W.partitionBy(*split).orderBy("_place").rowsBetween(W.unboundedPreceding, W.currentRow)
        for state in ("out", "in"):
            marked = marked.withColumn(f"_start_{state}", F.max(F.when(~F.col(f"_from_{state}"), F.col("_place"))).over(upto))
        # The only copy of the text: everything after reads it, pruned.
        self.marked = written(marked, "marked")
        after = {s: F.when(F.col(f"_from_{s}"), F.col("_in")).otherwise(F.col("_out")) for s in ("out", "in")}
        splits = self.marked.groupBy(*split).agg(
            *[F.max_by(after[s], "_place").alias(f"_after_{s}") for s in after],
            *[F.max(f"_start_{s}").alias(f"_end_{s}") for s in after],
        )
        # One row per split of a file.
        splits = _with_states(splits, "_after_out", "_after_in", ["_path"], "_block")
        begun = F.col("_from_out")
        splits = splits.withColumn("_end", F.when(begun, F.col("_end_in")).otherwise(F.col("_end_out")))
        splits = splits.withColumn("_open", F.when(begun, F.col("_after_in")).otherwise(F.col("_after_out")))
        earlier = W.partitionBy("_path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
        self.splits = written(
            splits.select(*split, begun.alias("_begun"), F.max("_end").over(earlier).alias("_inherited"), "_open"), "splits"
        )

    def unclosed(self) -> DataFrame:
        """(_path) of the files that end inside of quotes."""
        return self.splits.groupBy("_path").agg(F.max_by("_open", "_block").alias("_open")).filter("_open").select("_path")

    def _placed(self) -> DataFrame:
        rows = attach(self.marked, self.splits.drop("_open"), ["_path", "_block"])
        own = F.when(F.col("_begun"), F.col("_start_in")).otherwise(F.col("_start_out"))
        return rows.select("_path", F.coalesce(own, "_inherited").alias("_row"), "_place", "value")

    def rows(self, first_only: bool = False) -> DataFrame:
        """(_path, _row, record) without blank records, or only the first of each file."""
        placed = self._placed()
        if first_only:
            full = placed.filter(F.trim(without_end(F.col("value"))) != "")
            first = written(full.groupBy("_path").agg(F.min("_row").alias("_first")), "first_records")
            placed = attach(placed, first, ["_path"]).filter("_row = _first").drop("_first")
        lines = F.array_sort(F.collect_list(F.struct("_place", "value")))
        whole = F.array_join(F.transform(lines, lambda line: line["value"]), "\n")
        records = placed.groupBy("_path", "_row").agg(without_end(whole).alias("record"))
        pieces = F.when(F.col("record").contains("\r"), F.regexp_extract_all("record", F.lit(_RECORD), F.lit(0)))
        pieces = F.filter(F.coalesce(pieces, F.array("record")), lambda r: F.trim(r) != "")
        if first_only:
            return records.select("_path", "_row", F.get(pieces, F.lit(0)).alias("record"))
        return records.select("_path", "_row", F.posexplode(pieces).alias("_nth", "record")).select(
            "_path", (F.col("_row") + F.col("_nth")).alias("_row"), "record")
