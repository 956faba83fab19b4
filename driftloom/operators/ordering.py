"""Order statistics and row numbers that never sort a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.functions.attach import attach
from driftloom.functions.cells import HEAVY_CELL, cell_of, part_of, parts_of
from driftloom.operators.sketches import clean_double, sketched_quantiles
from driftloom.sources.scratch import settle

# A cell is cut further while it holds more rows than the larger of these two: one share of all
# rows, so that few cells are ever open and their table stays small, and a number that any task sorts.
SHARES = 65_536
FEWEST_ROWS = 65_536
FEWEST_PARTS = 256
TEXT_PIECES = 4


def _running(w) -> object:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def value_cells(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """A column's values in their cells (lazily: group, `__v`, `__cell`), and each cell's count, range and moments, settled.

    Nulls and NaN have a cell of their own, null, so that a group without values is still known.
    """
    placed = df.select(*group_cols, clean_double(F.col(value_col)).alias("__v")).withColumn("__cell", cell_of(F.col("__v")))
    counted = placed.groupBy(*group_cols, "__cell").agg(
        F.count(F.lit(1)).alias("__n"),
        F.min("__v").alias("__low"),
        F.max("__v").alias("__high"),
        F.avg("__v").alias("__mean"),
        F.var_pop("__v").alias("__var"),
    )
    return placed, settle(counted)


def quantiles(
    df: DataFrame,
    value_col: str,
    probs: dict[str, float],
    group_cols: Sequence[str] = (),
    accuracy: float | None = None,
    cells: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles: one row per group, one column per name in `probs`.

    They are exact unless an `accuracy` is given; then they come from a sketch whose ranks are off
    by at most that share of the rows (see `operators.sketches`) and that needs one pass.

    The exact percentile aggregate holds every distinct value of a group in one task. Here the
    rows are counted per cell (`cells`, if these counts are there already), the cells that contain
    a wanted rank are picked, a heavy one is cut into parts by the range of its values, and only
    the values in what is left are counted and ordered. Each pass is folded before it is shuffled.
    A group without any value gives no row.
    """
    if accuracy is not None:
        return sketched_quantiles(df, value_col, probs, group_cols, accuracy)
    keys = list(group_cols)
    placed, counts = value_cells(df, value_col, keys) if cells is None else cells
    counts = counts.filter("__cell IS NOT NULL")
    across = _running(Window.partitionBy(*keys).orderBy("__cell"))
    total = F.sum("__n").over(Window.partitionBy(*keys))
    begun = counts.select("*", total.alias("__total"), (F.sum("__n").over(across) - F.col("__n")).alias("__start"))

    def rank(p: float, end: str) -> Column:
        place = (F.col("__total") - 1) * F.lit(float(p))
        return (F.floor(place) if end == "lo" else F.ceil(place)).cast("bigint")

    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(end).alias("end"), rank(p, end).alias("rank"))
            for name, p in probs.items()
            for end in ("lo", "hi")
        ]
    )

    def within(wants: Column) -> Column:
        return F.filter(wants, lambda t: (t["rank"] >= F.col("__start")) & (t["rank"] < F.col("__start") + F.col("__n")))

    def holding(cells: DataFrame, wants: Column) -> DataFrame:
        return cells.withColumn("__wants", within(wants)).filter(F.size("__wants") > 0)

    parts = parts_of(F.col("__n"), F.col("__low"), F.col("__high"))
    columns = [*keys, "__cell", "__low", "__high", "__parts", "__n", "__start", "__total", "__wants"]
    hits = settle(holding(begun, wanted).withColumn("__parts", parts).select(*columns))
    inside = [*keys, "__cell"]
    part = part_of(F.col("__v"), F.col("__low"), F.col("__high"), F.col("__parts"))

    def parts_in(hits: DataFrame, extra: list[str]) -> DataFrame:
        cut = hits.select(*keys, "__cell", "__low", "__high", "__parts")
        named = attach(placed, cut, inside, how="inner").withColumn("__part", part)
        return named.groupBy(*inside, "__part", *extra)

    heavy = hits.filter((F.col("__n") > HEAVY_CELL) & (F.col("__parts") > 1))
    chosen = None
    if not heavy.isEmpty():
        sums = parts_in(hits, []).agg(F.count(F.lit(1)).alias("__n"))
        along = _running(Window.partitionBy(*inside).orderBy("__part"))
        offset = attach(sums, hits.select(*inside, "__start", "__total", "__wants"), inside)
        stepped = offset.withColumn("__start", F.col("__start") + F.sum("__n").over(along) - F.col("__n"))
        chosen = settle(holding(stepped, F.col("__wants")).select(*inside, "__part", "__start", "__total", "__wants"))
    if chosen is None:
        values = parts_in(hits, ["__v"]).agg(F.count(F.lit(1)).alias("__n"))
        sums = settle(values)
        along = _running(Window.partitionBy(*inside).orderBy("__part"))
        per_part = sums.groupBy(*inside, "__part").agg(F.sum("__n").alias("__n"))
        offset = attach(per_part, hits.select(*inside, "__start", "__total", "__wants"), inside)
        stepped = offset.withColumn("__start", F.col("__start") + F.sum("__n").over(along) - F.col("__n"))
        chosen = holding(stepped, F.col("__wants")).select(*inside, "__part", "__start", "__total", "__wants")
        found = attach(sums, chosen, [*inside, "__part"], how="inner")
    else:
        cut = attach(placed, hits.select(*inside, "__low", "__high", "__parts"), inside, how="inner").withColumn("__part", part)
        kept = attach(cut, chosen.select(*inside, "__part", F.lit(True).alias("__held")), [*inside, "__part"], how="inner")
        values = kept.groupBy(*inside, "__part", "__v").agg(F.count(F.lit(1)).alias("__n"))
        found = attach(values, chosen, [*inside, "__part"], how="inner")
    w = _running(Window.partitionBy(*inside, "__part").orderBy("__v"))
    ranked = found.withColumn("__start", F.col("__start") + F.sum("__n").over(w) - F.col("__n"))
    picked = (
        ranked.select(*keys, "__v", "__total", F.inline(within(F.col("__wants"))))
        .groupBy(*keys)
        .agg(
            F.max("__total").alias("__total"),
            *[
                F.max(F.when((F.col("name") == name) & (F.col("end") == end), F.col("__v"))).alias(f"{name}__{end}")
                for name in probs
                for end in ("lo", "hi")
            ],
        )
    )

    def interpolated(name: str, p: float) -> Column:
        place = (F.col("__total") - 1) * F.lit(float(p))
        low, high = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))

    return picked.select(*keys, *[interpolated(name, p).alias(name) for name, p in probs.items()])


def order_numbers(df: DataFrame, order_cols: Sequence[str]) -> list[Column]:
    """The ordering as whole numbers that rise with it, most significant first.

    Integers, dates, timestamps and decimals become one number each (and one for null, which
    comes first); a text becomes the numbers of its first 28 bytes, a floating-point number one
    that is coarser than itself. After a column that its numbers do not tell apart, the list ends:
    two rows with equal numbers then may still differ, and are ordered by the columns themselves.
    """
    out: list[Column] = []
    for name in order_cols:
        column, kind = F.col(name), df.schema[name].dataType
        pieces, whole = [], True
        if isinstance(kind, T.IntegralType):
            pieces = [column.cast("bigint")]
        elif isinstance(kind, T.BooleanType):
            pieces = [column.cast("int").cast("bigint")]
        elif isinstance(kind, T.DateType):
            pieces = [F.unix_date(column).cast("bigint")]
        elif isinstance(kind, T.TimestampType):
            pieces = [F.unix_micros(column)]
        elif isinstance(kind, T.TimestampNTZType):
            pieces = [F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column)]
        elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
            pieces = [(column.cast(f"decimal(38,{kind.scale})") * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("bigint")]
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            # The logarithm of the distance from 0, on either side; NaN is above everything.
            number = column.cast("double")
            fold = F.floor((F.ln(F.abs(number)) + 746) * (1 << 24)).cast("bigint")
            finite = F.when(number == 0, F.lit(0)).when(number > 0, fold + 1).otherwise(-fold - 1).cast("bigint")
            top = F.lit(1 << 60)
            pieces = [F.when(F.isnan(number) | (number == float("inf")), top).when(number == float("-inf"), -top).otherwise(finite)]
            whole = False
        elif isinstance(kind, (T.StringType, T.BinaryType)):
            raw = column.cast("binary")
            for i in range(TEXT_PIECES):
                seven = F.rpad(F.hex(F.substring(raw, 7 * i + 1, 7)), 14, "0")
                pieces.append(F.conv(seven, 16, 10).cast("bigint"))
            whole = False
        else:
            raise TypeError(f"{name} is {kind.simpleString()}, which has no order in numbers")
        if df.schema[name].nullable:
            out.append(F.when(column.isNull(), F.lit(0)).otherwise(F.lit(1)).cast("bigint"))
        out += [F.coalesce(p, F.lit(0)).cast("bigint") for p in pieces]
        if not whole:
            break
    return out


def _stretch(number: Column) -> list[Column]:
    return [F.min(number).alias("__low"), F.max(number).alias("__high")]


def _at(place: Column) -> Column:
    return F.get(F.col("__numbers"), place)


def _part(number: Column, low: Column, high: Column, parts: Column) -> Column:
    """Which of `parts` equal stretches between low and high a number falls into, from 0; `low` is in the first and `high` in the last."""
    above = F.coalesce(F.try_subtract(number, low).cast("double"), number.cast("double") - low.cast("double"))
    width = F.coalesce(F.try_subtract(high, low).cast("double"), high.cast("double") - low.cast("double"))
    return F.when(number == high, parts - 1).otherwise(F.least(F.floor(above / width * parts).cast("bigint"), parts - 1))


class Cells:
    """Cells of each group that no more than `most` rows share, in order, with the rank each begins at.

    The rows are counted first. A cell with more rows than allowed is cut into equal stretches
    between the smallest and largest number it holds, as often as its count asks for; where it
    holds one number only, the next one of the ordering cuts it. What is left together is as many
    rows as allowed, or rows that the numbers do not tell apart. Counts are prefix sums among the
    parts of one cell, added to where that cell begins, so no task ever sees all cells. Every
    round is one pass that is folded before it is shuffled, over the open cells' rows alone; only
    counts reach the driver. `wanted` (an expression on `__size`, a group's rows) keeps only the
    cell open that holds this rank, counted from 1.
    """

    def __init__(
        self, df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str], most: int | None = None, wanted: Column | None = None
    ):
        self.keys = list(group_cols)
        self.numbers = order_numbers(df, order_cols)
        self.rounds: list[DataFrame] = []
        rows = self._numbered(df.select(*self.keys, *order_cols))
        whole = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__n"), *_stretch(_at(F.lit(0))))
        first = settle(
            whole.withColumn("__size", F.col("__n")).select(
                *self.keys,
                F.array().cast("array<bigint>").alias("__path"),
                F.lit(0).alias("__place"),
                F.lit(0).cast("bigint").alias("__start"),
                "__n",
                "__low",
                "__high",
                (F.lit(None).cast("bigint") if wanted is None else wanted).alias("__wanted"),
            )
        )
        counts = first.agg(F.sum("__n").alias("total"), F.max("__n").alias("largest")).first()
        self.most = max(FEWEST_ROWS, -(-(counts["total"] or 0) // SHARES)) if most is None else most
        if (counts["largest"] or 0) <= self.most:
            self.leaves = first.select(*self.keys, "__path", "__start", "__n", "__wanted")
            return
        closed = []
        current = first
        while True:
            holds = F.lit(True) if wanted is None else (F.col("__wanted") > F.col("__start")) & (F.col("__wanted") <= F.col("__start") + F.col("__n"))
            more = (F.col("__low") < F.col("__high")) | (F.col("__place") + 1 < len(self.numbers))
            is_open = (F.col("__n") > self.most) & more & holds
            closed.append(current.filter(~is_open))
            opened = current.filter(is_open)
            if opened.isEmpty():
                break
            current = self._cut(rows, opened)
        self.leaves = reduce(DataFrame.unionByName, closed).select(*self.keys, "__path", "__start", "__n", "__wanted")

    def _numbered(self, df: DataFrame) -> DataFrame:
        return df.select(*self.keys, F.array(*self.numbers).alias("__numbers"), F.array().cast("array<bigint>").alias("__path"))

    def _cut(self, rows: DataFrame, opened: DataFrame) -> DataFrame:
        """The parts of the open cells; a cell without two numbers at its place goes on to the next one as a whole."""
        parts = F.greatest(F.lit(FEWEST_PARTS), F.ceil(2.0 * F.col("__n") / self.most)).cast("bigint")
        cut = F.col("__low") < F.col("__high")
        self.rounds.append(
            settle(opened.select(*self.keys, "__path", "__place", "__low", "__high", "__start", "__wanted", F.when(cut, parts).otherwise(1).alias("__parts")))
        )
        placed = self._descend(rows, inner=True)
        single = F.col("__parts") == 1
        # A part is cut at the same place again, or, where a cell had one number, at the next.
        place = F.when(single, F.col("__place") + 1).otherwise(F.col("__place"))
        child = placed.groupBy(*self.keys, "__path").agg(
            F.count(F.lit(1)).alias("__n"), F.max(place).alias("__place"), F.max("__start").alias("__start"), F.max("__wanted").alias("__wanted"), *_stretch(_at(place))
        )
        siblings = Window.partitionBy(*self.keys, "__parent").orderBy(F.element_at("__path", -1))
        begun = F.col("__start") + F.sum("__n").over(_running(siblings)) - F.col("__n")
        return settle(child.withColumn("__parent", F.slice("__path", 1, F.size("__path") - 1)).withColumn("__start", begun).drop("__parent"))

    def _descend(self, rows: DataFrame, inner: bool = False) -> DataFrame:
        """Rows with the path of their cell; with `inner`, those of the cells of the last round, with what that round says of them."""
        columns = rows.columns
        for i, opened in enumerate(self.rounds):
            last = inner and i == len(self.rounds) - 1
            joined = attach(rows, opened, [*self.keys, "__path"], how="inner" if inner else "left")
            part = F.when(F.col("__parts") == 1, F.lit(0)).otherwise(_part(_at(F.col("__place")), F.col("__low"), F.col("__high"), F.col("__parts")))
            path = F.when(F.col("__parts").isNull(), F.col("__path")).otherwise(F.concat("__path", F.array(part.cast("bigint"))))
            kept = [F.col(c) for c in columns if c != "__path"]
            rows = joined.select(*kept, path.alias("__path"), *(["__place", "__parts", "__start", "__wanted"] if last else []))
        return rows

    def place(self, df: DataFrame) -> DataFrame:
        """The rows with the `__path` of their cell."""
        every = df.select("*", F.array(*self.numbers).alias("__numbers"), F.array().cast("array<bigint>").alias("__path"))
        return self._descend(every).drop("__numbers")


def number_rows(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    name: str = "row_number",
    most: int | None = None,
) -> DataFrame:
    """Number the rows of each group from 1, exactly, without one task per group.

    Counts decide how groups are cut into cells (`Cells`); rows are numbered inside a cell and
    shifted by where it begins. Rows whose ordering columns tie are told apart by a hash of the
    whole row, so only equal rows exchange numbers from run to run; a cell of such rows alone
    cannot be cut further.
    """
    keys = list(group_cols)
    cells = Cells(df, order_cols, keys, most)
    hashed = [c for c in df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    w = Window.partitionBy(*keys, "__path").orderBy(*order_cols, F.xxhash64(*hashed))
    numbered = cells.place(df).withColumn("__local", F.row_number().over(w).cast("bigint"))
    if not cells.rounds:
        return numbered.select(*df.columns, F.col("__local").alias(name))
    starts = settle(cells.leaves.select(*keys, "__path", "__start"))
    return attach(numbered, starts, [*keys, "__path"]).select(*df.columns, (F.col("__local") + F.col("__start")).alias(name))


def key_at_share(
    df: DataFrame, order_cols: Sequence[str], share: float, group_cols: Sequence[str] = (), most: int | None = None
) -> DataFrame:
    """Sort key of each group's row number int(share * n), as a struct `last_key` (no row if that is 0).

    Counts tell which cell holds the cut, and only that cell is cut further (`Cells`) and, once
    it is small, ordered.
    """
    keys = list(group_cols)
    wanted = F.floor(F.col("__size") * F.lit(float(share))).cast("bigint")
    cells = Cells(df, order_cols, keys, most, wanted)
    holds = (F.col("__wanted") > F.col("__start")) & (F.col("__wanted") <= F.col("__start") + F.col("__n"))
    cut = settle(cells.leaves.filter(holds).select(*keys, "__path", (F.col("__wanted") - F.col("__start")).alias("__nth")))
    inside = attach(cells.place(df.select(*keys, *order_cols)), cut, [*keys, "__path"], how="inner")
    w = Window.partitionBy(*keys, "__path").orderBy(*order_cols)
    return (
        inside.withColumn("__rn", F.row_number().over(w))
        .filter("__rn = __nth")
        .select(*keys, F.struct(*order_cols).alias("last_key"))
    )
