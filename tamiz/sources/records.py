"""Records of CSV files whose cells hold line breaks, found without reading a file as a whole.

A line break ends a record only outside quotes, and whether a line starts outside depends on all lines before it.
What a line does to that state is one of four things: keep it, turn it around, leave it outside, leave it inside.
Such effects can be put together in any grouping, so files are split as usual: each block is summed up into one
effect, the blocks of a file are chained, and only records that cross a block boundary are put together after that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

UTF8 = "UTF-8"
#: A record beyond this many characters is taken for the work of a stray quote: it is reported, not read.
RECORD_CHARACTERS = 64 << 20

# effects of a line: 0 keeps the state, 1 turns it around, 2 ends outside of quotes, 3 ends inside
_KEEPS, _TURNS, _CLOSES = 0, 1, 2
_FILE, _BLOCK, _ROW, _LINE = "archivo", "bloque", "fila", "linea"


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their place: file, block (the byte at which a task's share of the file starts) and order in it.

    Only ``\\n`` ends a line here; a ``\\r`` before it stays, since inside of quotes it belongs to a cell."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_ROW),
        F.col("value").alias(_LINE),
    )


def decoded(line: Column, encoding: str) -> Column:
    """Text of a line as Spark's reader of lines gives it, which takes every file as UTF-8."""
    return line if encoding.upper() == UTF8 else F.decode(line.cast("binary"), encoding)


def with_effect(lines: DataFrame, sep: str, name: str = "efecto") -> DataFrame:
    """Add what each line does to the state "inside of quotes".

    Doubled quotes are text. Of the others, one at the start of a cell opens it and one at the end closes it, whatever
    came before; one that is both, alone between separators, turns the state around. Any other is a stray one and text.
    What counts is the last quote that opens or closes, and how many behind it turn the state.
    Bytes are looked at: in any charset that extends ASCII, quotes and separators are the same there. Quotes are replaced
    by marks that begin with a line break, which no line holds. A column that is used twice is a projection of its own,
    so that no step over a line is done twice."""

    def swapped(c: Column, one: str, other: str) -> Column:
        return F.replace(c, F.lit(one), F.lit(other))

    opens, closes, turns = "\no", "\nc", "\nt"
    single = F.concat(F.lit(sep), swapped(F.col(_LINE), '""', ""), F.lit("\r\n"))
    # the end of the line ends a cell, with and without a \r before it
    cells = swapped(swapped(single, "\r\r\n", sep), "\r\n", sep)
    starts = swapped(swapped(cells, f'{sep}"', sep + opens), opens + sep, turns + sep)
    marks = F.when(F.contains(_LINE, F.lit('"')), swapped(starts, f'"{sep}', closes + sep))
    behind = F.substring_index("_marks", opens, -1)
    marked = lines.withColumn("_marks", marks).withColumn("_behind", behind)
    tail = F.substring_index("_behind", closes, -1)
    settled = F.when(F.contains("_behind", F.lit(closes)), 0).when(F.contains("_marks", F.lit(opens)), 1)
    last = marked.withColumn("_tail", tail).withColumn("_settled", settled)
    turned = F.octet_length("_tail") - F.octet_length(swapped(F.col("_tail"), turns, turns[:-1]))
    effect = F.when(F.col("_settled").isNull(), turned % 2).otherwise((F.col("_settled") + turned) % 2 + _CLOSES)
    return last.withColumn(name, F.when(F.col("_marks").isNull(), _KEEPS).otherwise(effect).cast("int")).drop("_marks", "_behind", "_tail", "_settled")


def _chained(rows: DataFrame, effect: str, within: WindowSpec, starts: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Add ``antes_0`` and ``tras_0``, ``antes_1`` and ``tras_1``: the state before and after each row if the first one
    started outside or inside."""
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when(F.col(effect) == _TURNS, 1).otherwise(0)
    turned = rows.withColumn("_turns", F.sum(turns).over(so_far))
    settles = F.when(F.col(effect) >= _CLOSES, F.struct((F.col(effect) - _CLOSES).alias("state"), F.col("_turns").alias("turns")))
    last = turned.withColumn("_last", F.last(settles, ignorenulls=True).over(before)).withColumn("_turns", F.col("_turns") - turns)
    settled = (F.col("_last.state") + F.col("_turns") - F.col("_last.turns")) % 2
    found = last.withColumns({f"antes_{s}": F.coalesce(settled, (F.lit(s) + F.col("_turns")) % 2).cast("int") for s in starts})
    after = {
        f"tras_{s}": F.when(F.col(effect) >= _CLOSES, F.col(effect) - _CLOSES).when(F.col(effect) == _TURNS, 1 - F.col(f"antes_{s}")).otherwise(F.col(f"antes_{s}")).cast("int")
        for s in starts
    }
    return found.withColumns(after).drop("_turns", "_last")


def _blocks(effects: DataFrame) -> DataFrame:
    """Per block: the lines that open its first and its last record, if any does, and whether the file ends inside of
    quotes there."""
    lines = _chained(effects, "efecto", Window.partitionBy(_FILE, _BLOCK).orderBy(_ROW))
    opening = {s: F.when(F.col(f"antes_{s}") == 0, F.col(_ROW)) for s in (0, 1)}
    ends = lines.groupBy(_FILE, _BLOCK).agg(
        F.max_by(F.struct("tras_0", "tras_1"), _ROW).alias("_e"),
        *(take(opening[s]).alias(f"{name}_{s}") for s in (0, 1) for name, take in (("inicial", F.min), ("ultimo", F.max))),
    )
    a, b = F.col("_e.tras_0"), F.col("_e.tras_1")
    effect = F.when(a == b, a + _CLOSES).when(a == 1, _TURNS).otherwise(_KEEPS).cast("int")
    order = Window.partitionBy(_FILE).orderBy(_BLOCK)
    chained = _chained(ends.withColumn("efecto", effect), "efecto", order, (0,))
    last_block = F.lead(_BLOCK).over(order).isNull()
    by_start = [F.when(F.col("antes_0") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1")).alias(name) for name in ("inicial", "ultimo")]
    return chained.select(
        F.col(_FILE).alias("_file"), F.col(_BLOCK).alias("_block"), *by_start, (last_block & (F.col("tras_0") == 1)).alias("abierto")
    )


def csv_records(
    spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = UTF8, longest: int = RECORD_CHARACTERS
) -> DataFrame:
    """(archivo, bloque, fila, registro, entero, primero) of every record: the place of its first line, its text without
    the line break behind it, and whether it is the first of its file.

    Of lines, the ones between the first and the last record that open in a block are shuffled, once, by block, and put
    together there; a block is what one task reads of a file. Of records that may cross blocks, pieces meet by file, two a
    block at most. ``entero`` is false where the quotes never close,
    which goes on to the end of the file; of such records and others beyond ``longest`` characters ``registro`` may be
    NULL, so that a stray quote does not gather a file in one row."""
    lines = text_lines(spark, path)
    effects = with_effect(lines, sep)
    # one row for each task that reads
    blocks = F.broadcast(_blocks(effects.select(_FILE, _BLOCK, _ROW, "efecto")))

    def of_blocks(some: DataFrame) -> DataFrame:
        known = some.join(blocks, (F.col(_FILE) == F.col("_file")) & (F.col(_BLOCK) == F.col("_block")))
        return known.withColumn(_LINE, decoded(F.col(_LINE), encoding))

    def together(grouped: DataFrame, *keys: str) -> DataFrame:
        parts = F.sort_array(F.collect_list(F.struct(_ROW, _LINE)))
        # one value of each in a group; as keys they let filters work before lines are put together
        return grouped.groupBy(_FILE, _BLOCK, "grupo", *keys).agg(
            F.min(_ROW).alias(_ROW),
            F.sum(F.length(_LINE) + 1).alias("largo"),
            F.array_join(F.transform(parts, lambda p: p[_LINE]), "\n").alias("texto"),
        )

    text = F.when(F.col("largo") <= longest, F.col("texto")).alias("texto")
    opening = (F.col(_BLOCK) == 0) & (F.col("grupo") == 1)
    # from the first record that opens in a block on, lines start outside of quotes
    inner = of_blocks(effects).where((F.col(_ROW) >= F.col("inicial")) & (F.col(_ROW) < F.col("ultimo"))).select(_FILE, _BLOCK, _ROW, _LINE, "ultimo", "efecto")
    in_block = Window.partitionBy(_FILE, _BLOCK).orderBy(_ROW)
    number = F.sum(F.when(F.col("antes_0") == 0, 1).otherwise(0)).over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = _chained(inner, "efecto", in_block, (0,)).withColumn("grupo", number)
    whole = together(numbered, "ultimo").select(_FILE, _BLOCK, _ROW, text, F.lit(True).alias("entero"), opening.alias("primero"))
    # the others are told by their place alone: group 0 goes on from the block before, group 1 is the last that opens
    none, closing = F.col("ultimo").isNull(), F.col(_ROW) >= F.col("ultimo")
    outer = of_blocks(lines).where(none | (F.col(_ROW) < F.col("inicial")) | closing).select(
        _FILE, _BLOCK, _ROW, _LINE, F.when(closing, 1).otherwise(0).alias("grupo"),
        "inicial", "ultimo", (F.col("abierto") & (none | closing)).alias("abierto"),
    )
    # pieces at the edges of blocks: what opens in one block goes on at the head of the next
    in_file = Window.partitionBy(_FILE).orderBy(_BLOCK, "grupo").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.when(F.col("grupo") > 0, 1).otherwise(0)
    edges = together(outer, "inicial", "ultimo", "abierto").select(
        _FILE, _BLOCK, _ROW, "grupo", "largo", text, (opening & (F.col("inicial") == F.col("ultimo"))).alias("primero"), "abierto", F.sum(opens).over(in_file).alias("numero"),
    )
    size = F.sum("largo").over(Window.partitionBy(_FILE, "numero"))
    held = edges.withColumn("_size", size).withColumn("texto", F.when(F.col("_size") <= longest, F.col("texto")))
    joined = held.groupBy(_FILE, "numero").agg(
        F.min(F.struct(_BLOCK, _ROW)).alias("_at"),
        F.when(F.max("_size") <= longest, F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(_BLOCK, "grupo", "texto"))), lambda p: p["texto"]), "\n")).alias("texto"),
        (~F.max("abierto")).alias("entero"),
        F.max("primero").alias("primero"),
    )
    across = joined.select(_FILE, F.col(f"_at.{_BLOCK}").alias(_BLOCK), F.col(f"_at.{_ROW}").alias(_ROW), "texto", "entero", "primero")
    found = whole.unionByName(across)
    return found.select(_FILE, _BLOCK, _ROW, F.regexp_replace("texto", r"\r\z", "").alias("registro"), "entero", "primero")
