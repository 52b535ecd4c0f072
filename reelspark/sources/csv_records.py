"""Records of CSV files whose quoted fields hold line breaks, cut by many tasks.

A file is read as lines, split over tasks by byte ranges. Whether a line begins a record
depends on all lines before it, but only through one bit: whether a quote is open. Each
line is a function of that bit: most keep it, a line may turn it, or leave it open or
closed whatever it was. Such functions compose, so each byte range is summed up in one
row, the rows of a file are composed in order, and every line then knows its bit.

A line whose quote is never closed would swallow what follows. It shows in the record
that it makes: that record has no end, or text between a closing quote and the next
comma, or is longer than ``LONGEST`` bytes. The first line of such a record is set apart,
and the lines after it are cut anew as if it were not there. Faulty records do not touch
each other, so a round sets one line of each apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.contracts import ORDINAL
from reelspark.operators.spread import few_join, lookup_join, stored

#: Bytes that a record of several lines may have.
LONGEST = 16 << 20
#: Rounds after which files with faults are refused; a chain of n faults takes log2(n).
ROUNDS = 40

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
#: Whole fields with their commas, then a quote that is not closed.
_OPENS = rf'^(?:(?:{_QUOTED}[^,]*+|[^",][^,]*+)?+,)*+"[^"]*+(?:""[^"]*+)*+$'
#: From inside a quote: up to the closing one, and on to the next comma or the end.
_CLOSES = r'^[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,|$)'
#: A record whose quoted fields all end at a comma or at its end.
_SOUND = rf'^(?:(?:{_QUOTED}|[^",][^,]*+)?+(?:,|$))*+$'


#: Bits of an ordinal that number the lines of a byte range.
LINE_BITS = 33


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, its file and byte range, and a whole number that orders all lines by file,
    range and place. There is one row for each byte range in the table of ranges that
    is joined; lines are stored first, so that numbers stay as they are."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    lines = stored(lines)
    ranges = lines.groupBy("_file", "_block").agg(F.min("_row").alias("_first"))
    # one row for each hundred megabytes or so
    ranges = stored(ranges.withColumn("_range", F.row_number().over(Window.orderBy("_file", "_block"))))
    lines = few_join(lines, ranges, ["_file", "_block"])
    place = F.shiftleft(F.col("_range").cast("long"), LINE_BITS) + F.col("_row") - F.col("_first")
    # a byte order mark is no part of the first name
    text = F.when(F.col("_block") == 0, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    return lines.select(text.alias("value"), "_file", "_block", place.alias(ORDINAL))


def _opens(line: Column) -> Column:
    return line.rlike(_OPENS)


def _running(df: DataFrame, window, left_open: str, turns: str) -> DataFrame:
    """Add _set and _turned: the last value that lines up to here leave behind whatever
    was before (with the number of turns until then), and the number of turns."""
    df = df.withColumn("_turned", F.sum(turns).over(window))
    mark = F.when(F.col(left_open).isNotNull(), F.struct(F.col(left_open).alias("open"), F.col("_turned").alias("at")))
    return df.withColumn("_set", F.last(mark, ignorenulls=True).over(window))


def _after(before: Column) -> Column:
    """The bit after a line, from the bit before its byte range."""
    return (F.coalesce(F.col("_set.open"), before) + F.col("_turned") - F.coalesce(F.col("_set.at"), F.lit(0))) % 2


def _states(lines: DataFrame) -> DataFrame:
    """Lines with ``before`` and ``after`` (1: a quote is open) and the place where
    their record starts."""
    value = F.col("value")
    has = F.contains(value, F.lit('"'))
    closing = F.regexp_extract(value, _CLOSES, 0)
    rest = F.substr(value, F.length(closing) + 1)
    from_out = F.when(has, _opens(value).cast("int")).otherwise(0)
    # a line that ends with the quote or its field is closed, unless a comma follows
    again = F.endswith(closing, F.lit(",")) & _opens(rest)
    from_in = F.when(has & (closing != ""), again.cast("int")).otherwise(1)
    lines = lines.select(
        "value", ORDINAL, "_file", "_block",
        from_out.alias("_out"), from_in.alias("_in"),
    )
    lines = lines.withColumns({
        "_left": F.when(F.col("_out") == F.col("_in"), F.col("_out")),
        "_turns": ((F.col("_out") == 1) & (F.col("_in") == 0)).cast("int"),
    })
    # a byte range is what one task reads anyway
    here = Window.partitionBy("_file", "_block").orderBy(ORDINAL)
    lines = stored(_running(lines, here, "_left", "_turns"))
    ranges = lines.groupBy("_file", "_block").agg(F.max_by(F.struct("_set", "_turned"), ORDINAL).alias("_end"))
    ranges = ranges.select(
        "_file", "_block",
        F.when(F.col("_end._set").isNotNull(), (F.col("_end._set.open") + F.col("_end._turned") - F.col("_end._set.at")) % 2).alias("_left"),
        F.when(F.col("_end._set").isNull(), F.col("_end._turned")).otherwise(0).alias("_turns"),
    )
    there = Window.partitionBy("_file").orderBy("_block")
    ranges = _running(ranges, there, "_left", "_turns")
    ranges = ranges.select("_file", "_block", F.lag(_after(F.lit(0)), 1, 0).over(there).alias("_begin"))
    lines = lookup_join(lines, ranges, ["_file", "_block"])
    lines = lines.withColumn("after", _after(F.col("_begin"))).withColumn(
        "before", F.coalesce(F.lag("after").over(here), F.col("_begin"))
    )
    started = F.when(F.col("before") == 0, F.col(ORDINAL))
    lines = stored(lines.select(
        "value", ORDINAL, "_file", "_block", "before", "after", F.last(started, ignorenulls=True).over(here).alias("_start")
    ))
    last = lines.groupBy("_file", "_block").agg(F.max("_start").alias("_start"))
    last = last.withColumn("_seen", F.last("_start", ignorenulls=True).over(there)).select(
        "_file", "_block", F.lag("_seen").over(there).alias("_carried")
    )
    lines = lookup_join(lines, last, ["_file", "_block"])
    return lines.select("value", "_file", ORDINAL, "before", "after", F.coalesce("_start", "_carried").alias("start"))


def _cut_once(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records of one line, sound records of several, and faulty lines."""
    states = stored(_states(lines))
    single = states.where("before = 0 AND after = 0").select("value", "_file", ORDINAL)
    several = states.where("before = 1 OR after = 1")
    sizes = stored(several.groupBy("start", "_file").agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.max_by("after", ORDINAL).alias("open")
    ))
    whole = sizes.where((F.col("open") == 0) & (F.col("bytes") <= LONGEST)).select("start", "_file")
    parts = F.array_sort(F.collect_list(F.struct(ORDINAL, "value")))
    joined = lookup_join(several, whole, ["start", "_file"]).groupBy("start", "_file").agg(F.array_join(parts["value"], "\n").alias("value"))
    joined = stored(joined.withColumn("sound", F.col("value").rlike(_SOUND)))
    starts = sizes.where((F.col("open") == 1) | (F.col("bytes") > LONGEST)).select("start", "_file").union(
        joined.where(~F.col("sound")).select("start", "_file")
    )
    faults = stored(starts.select(F.col("start").alias(ORDINAL), "_file"))
    return single, joined.where("sound").select("value", "_file", F.col("start").alias(ORDINAL)), faults


def cut(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (value, file and the ordinal of their first line), and the lines set apart for a
    quote that is not closed. Lines come from ``read_lines``."""
    columns = ["value", "_file", ORDINAL]
    if not lines.where(F.contains("value", F.lit('"'))).limit(1).count():
        return lines.select(columns), lines.select(columns).limit(0)
    done, apart, rest = [], [lines.select(columns).limit(0)], lines
    for _ in range(ROUNDS):
        single, several, faults = _cut_once(rest)
        bad = stored(faults.select("_file").distinct())
        done += [few_join(r, bad, ["_file"], "left_anti") for r in (single, several)]
        if not bad.limit(1).count():
            break
        numbers = faults.select(ORDINAL)
        apart.append(few_join(rest, numbers, [ORDINAL], "left_semi").select(columns))
        # only files with a fault are cut again
        rest = few_join(few_join(rest, bad, ["_file"], "left_semi"), numbers, [ORDINAL], "left_anti")
        rest = stored(rest)
    else:
        raise ValueError(f"quotes are not closed in {[r[0] for r in bad.limit(10).collect()]}")
    return reduce(DataFrame.unionByName, done), reduce(DataFrame.unionByName, apart)
