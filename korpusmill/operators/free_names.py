"""The first free name of every row, without a group in one task.

Rows take names in order: the base if it is free, else ``base__2``,
``base__3`` and so on, cut to fit. Each name therefore ends with the first of
the rows that ask for it, and a row asks for its next name once an earlier row
has taken the one before. That outcome does not depend on the order in which
the asking is done, so it can be done in rounds over all rows:

* the first row of each base is held to keep the bare base;
* all other rows compete in order for the numbers of their stem, and numbers
  whose name a bare base holds are skipped;
* where an earlier row reaches such a number, the bare base is lost to it for
  good, and a new round begins. A round without losses is the result.

Equal but for case is equal. A cut stem depends on the digits of the number, so
long bases compete digits by digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.operators.ordering import BLOCK, row_number_in_ranges, running_count
from korpusmill.session import shared_folder, store

MAX_NAME = 160
#: Stems this long are never cut, whatever 18-digit number follows.
WHOLE = MAX_NAME - 2 - 19


def with_suffix(base: Column, number: Column) -> Column:
    """``base__number``, the base cut so that all fits; the bare base for 1."""
    suffix = F.concat(F.lit("__"), number.cast("string"))
    cut = F.substring(base, F.lit(1), F.lit(MAX_NAME) - F.length(suffix))
    return F.when(number == 1, base).otherwise(F.concat(cut, suffix))


def _stored(df: DataFrame) -> DataFrame:
    return store(df, shared_folder(df.sparkSession, "free-names"))


def _compete(rows: DataFrame, held: DataFrame, keys: list[str], start: int) -> tuple[DataFrame, DataFrame | None]:
    """The number of each row of a stem, from ``start`` on, and the held bases (if any) that earlier rows reach.

    ``rows``: keys, _stem, _order. ``held``: keys, _stem, _number, _first, _low.
    """
    stem = [*keys, "_stem"]
    if held.isEmpty():
        ranked = row_number_in_ranges(rows, stem, [F.col("_order")], "_rank")
        return ranked.withColumn("_number", (F.col("_rank") + start - 1).cast("bigint")).drop("_rank"), None
    held = row_number_in_ranges(held, stem, [F.col("_number")], "_nth")
    held = held.withColumn("_free", F.col("_number") - start + 1 - F.col("_nth"))
    ranked = _stored(row_number_in_ranges(rows, stem, [F.col("_order")], "_rank"))

    # Consecutive held numbers have as many free ones before them, and are one event among the ranks.
    ranks = ranked.withColumns({"_at": 2 * F.col("_rank"), "_skip": F.lit(0)})
    runs = held.groupBy(*stem, "_free").agg(F.count("*").cast("int").alias("_skip"))
    runs = runs.withColumn("_at", 2 * F.col("_free") + 1).drop("_free")
    merged = running_count(
        ranks.unionByName(runs, allowMissingColumns=True), stem, "_at", F.col("_skip"), "_skipped", block=2 * BLOCK
    )
    numbered = merged.where("_rank is not null").withColumn("_number", F.col("_rank") + F.col("_skipped") + start - 1)

    # The row that takes the next free number has asked for the held ones before it.
    asking = ranked.select(*stem, (F.col("_rank") - 1).alias("_free"), F.col("_order").alias("_asker"))
    early = held.join(asking, [*stem, "_free"]).where("_asker < _first")
    lost = early.groupBy(*stem).agg(F.min_by("_low", "_number").alias("_low")).select(*keys, "_low")
    if start == 2:
        # Even if no number before it were held, this row would come to it.
        surely = asking.withColumn("_number", F.col("_free") + start).drop("_free")
        surely = held.join(surely, [*stem, "_number"]).where("_asker < _first")
        lost = lost.unionByName(surely.select(*keys, "_low")).distinct()
    lost = _stored(lost)
    return numbered.drop("_at", "_skip", "_skipped", "_rank"), None if lost.isEmpty() else lost


def _round(rows: DataFrame, bases: DataFrame, keys: list[str], has_long: bool) -> tuple[DataFrame, list[DataFrame]]:
    """Numbers of all rows if ``bases`` keep their names, and tables of the bases that cannot."""
    suffix = r"(?s)^(.*)__([1-9][0-9]{0,17})$"
    held = bases.where(F.col("_low").rlike(suffix)).withColumns({
        "_stem": F.regexp_extract("_low", suffix, 1), "_number": F.regexp_extract("_low", suffix, 2).cast("bigint"),
    }).where("_number > 1")
    first = bases.select(*keys, "_low", F.col("_first").alias("_order"), F.lit(1).cast("bigint").alias("_number"))
    bare = rows.join(first, [*keys, "_low", "_order"])
    rest = rows.join(first, [*keys, "_low", "_order"], "left_anti")

    whole = F.length("_low") <= WHOLE
    short, early = _compete(
        rest.where(whole).withColumn("_stem", F.col("_low")), held.where(F.length("_stem") <= WHOLE), keys, 2
    )
    numbers, lost = bare.unionByName(short.drop("_stem")), [early] if early else []
    rest, digits = rest.where(~whole), 1
    while has_long and not rest.isEmpty():
        stems = rest.withColumn("_stem", F.lower(F.left("_base", F.lit(MAX_NAME - 2 - digits))))
        of_length = held.where(F.length(F.col("_number").cast("string")) == digits)
        numbered, early = _compete(stems, of_length, keys, max(2, 10 ** (digits - 1)))
        if early:
            lost.append(early)
            break
        fits = F.col("_number") < 10**digits
        numbers = numbers.unionByName(numbered.where(fits).drop("_stem"))
        rest, digits = _stored(numbered.where(~fits).drop("_stem", "_number")), digits + 1
    return numbers, lost


def first_free(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, _order and the settled ``_name`` of rows (keys, _order, _base), _order unique within the keys."""
    rows = _stored(rows.select(*keys, "_order", "_base", F.lower("_base").alias("_low")))
    columns = [*keys, "_order", "_name"]
    if rows.isEmpty():
        return rows.withColumnRenamed("_base", "_name").select(*columns)
    bases = _stored(rows.groupBy(*keys, "_low").agg(F.min("_order").alias("_first")))
    has_long = not rows.where(F.length("_low") > WHOLE).isEmpty()
    while True:
        numbers, lost = _round(rows, bases, keys, has_long)
        if not lost:
            return numbers.withColumn("_name", with_suffix(F.col("_base"), F.col("_number"))).select(*columns)
        for some in lost:
            bases = bases.join(some, [*keys, "_low"], "left_anti")
        bases = _stored(bases)
