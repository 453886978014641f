"""Mix sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import ROW, SPACE_CHARACTERS, as_row, held, row_columns, whole_text
from tidemark.operators.joins import lookup_join

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
# Sorted keys of a source are dealt over this many ranges, so no task sorts a whole source.
RANGES = 1024
SALT = "mix 1"
# Draws of a source's fractional part; each begins with what the one before left over.
DRAWS = 3
# Marks that good prose has few of.
MARKS = "0123456789#*$%&|<>{}[]=_~^@\\/"


# A table by source goes to all tasks while it has at most so many rows and bytes of keys.
SMALL_ROWS = 10_000
SMALL_BYTES = 1 << 20


def _by_source(rows: DataFrame, table: DataFrame, how: str) -> DataFrame:
    """Join the table of sources, as ``e.*`` and ``o.*``.

    A small one is broadcast, which its checked size allows, so the rows of a
    hot source stay where they are. A larger one goes through the look-up join,
    where AQE splits hot sources.
    """
    table = held(table)
    size = table.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("__source")), F.lit(0)).alias("bytes")).first()
    if size["rows"] > SMALL_ROWS or size["bytes"] > SMALL_BYTES:
        return lookup_join(rows, table, "__source", how)
    return rows.alias("e").join(F.broadcast(table).alias("o"), F.col("e.__source") == F.col("o.__source"), how)


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    blank = F.translate(text, SPACE_CHARACTERS, " " * len(SPACE_CHARACTERS))
    return F.size(F.filter(F.split(blank, " "), lambda w: w != "")).cast("long")


def prose_quality(text: Column) -> Column:
    """Between 0.25 and 1: less the more digits and symbols a text holds."""
    bare = F.length(F.translate(text, MARKS, ""))
    return 0.25 + 0.75 * (bare + 1) / (F.length(text) + 1)


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row for each source: ``source_size`` and ``target``.

    ``sizes`` has ``__source`` (null sources last) and ``size``. Targets share
    ``SHARE`` times all sizes by weight and stop at ``MOST`` times the source's
    size. Resharing ends at ``least(cap, level * weight)``, and the level is
    the largest of those that result if the k sources with the least caps for
    their weight are full. The windows see one row for each source.
    """
    sources = sizes.groupBy("__source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy("__source")) - 1
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighed = sources.withColumn("__weight", F.element_at(weights, (place % len(WEIGHTS) + 1).cast("int"))).withColumn(
        "__cap", MOST * F.col("source_size").cast("double")
    )
    full = Window.orderBy(F.col("__cap") / F.col("__weight"), "__source").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(0))
    levels = (
        weighed.withColumns({
            "__all": SHARE * F.sum("source_size").over(every), "__weights": F.sum("__weight").over(every),
            "__full": F.sum("__cap").over(full), "__used": F.sum("__weight").over(full),
        })
        .withColumn("__level", F.greatest(
            F.col("__all") / F.col("__weights"),
            F.when(F.col("__weights") > F.col("__used"), (F.col("__all") - F.col("__full")) / (F.col("__weights") - F.col("__used"))),
        ))
    )
    target = F.least("__cap", F.max("__level").over(every) * F.col("__weight"))
    return levels.select("__source", "source_size", target.alias("target"))


def _draw(rows: DataFrame) -> DataFrame:
    """Draw rows in key order while they fit what is left of their source's target.

    Rows larger than what is left cannot be drawn and are passed over, so a
    second draw goes on behind a large row that ended the first.
    """
    fits = ~F.col("__drawn") & (F.col("size") > 0) & (F.col("size") <= F.col("__gap"))
    rows = rows.withColumn("__part", F.when(fits, F.col("size")).otherwise(0))
    cells = rows.groupBy("__source", "__range", "__cell").agg(F.sum("__part").alias("__sum"))
    before = F.sum("__sum").over(Window.partitionBy("__source").orderBy("__range")) - F.col("__sum")
    cells = cells.select("__cell", before.alias("__before"))
    inside = Window.partitionBy("__cell").orderBy("__key", "doc_id", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    summed = lookup_join(rows, cells, "__cell", "inner").select("e.*", "o.__before")
    now = (F.col("__part") > 0) & (F.col("__before") + F.sum("__part").over(inside) <= F.col("__gap"))
    drawn = held(summed.withColumn("__now", now).drop("__before"))
    got = drawn.where("__now").groupBy("__source").agg(F.sum("size").alias("got"))
    return _by_source(drawn, got, "left").select(
        *[f"e.{c}" for c in rows.columns if c not in ("__gap", "__drawn", "__part")],
        (F.col("e.__gap") - F.coalesce("o.got", F.lit(0))).alias("__gap"), (F.col("e.__drawn") | F.col("e.__now")).alias("__drawn"),
    )


def decide(docs: DataFrame, quality: Column | None = None) -> DataFrame:
    """How often the mix takes each row: ``doc_id``, ``size``, ``source_size``, ``target``, ``times``, with keys.

    Whole epochs come first. The rest of a source's target is drawn by
    Efraimidis-Spirakis keys, ``-ln(u) / quality`` ascending, until the budget
    is used up; ``u`` follows from the row's content, so reruns agree. What a
    large row leaves over goes to the rows behind it, and in the end the one
    row not yet drawn whose size is nearest to what is left closes the gap, if
    that brings the source nearer to its target. Prefix sums run over key
    ranges and then within a range, so a source of any size is spread.

    Null texts have size 0 and are never taken; a null source is a source of
    its own, last; null ids draw by their text; rows that agree in id, text and
    source are interchangeable; an empty table gives an empty result.
    """
    text = whole_text()
    weight = prose_quality(text) if quality is None else F.greatest(F.coalesce(quality, F.lit(0.0)), F.lit(1e-6))
    # The hash's top 53 bits, in (0, 1).
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SALT), "doc_id", "__source", "__tie"), 11) + 0.5) / float(1 << 53)
    sizes = held(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit(""))).alias("__source"),
            n_words(text).alias("size"), F.xxhash64(text).alias("__tie"), weight.alias("__quality"),
        ).withColumn("__key", -F.log(u) / F.col("__quality"))
        .withColumn("__range", F.least(F.floor((1 - F.exp(-F.col("__key"))) * RANGES), F.lit(RANGES - 1)))
        .withColumn("__cell", F.concat_ws(":", F.col("__range").cast("string"), "__source"))
    )
    targets = source_targets(sizes).withColumns({
        "__epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
    }).withColumn("__rest", F.col("target") - F.col("__epochs") * F.col("source_size"))
    rows = held(_by_source(sizes, targets, "inner").select("e.*", "o.source_size", "o.target", "o.__epochs", "o.__rest"))
    rows = rows.withColumns({"__gap": F.col("__rest"), "__drawn": F.lit(False)})
    for _ in range(DRAWS):
        rows = _draw(rows)
    inside = Window.partitionBy("__cell").orderBy("__key", "doc_id", "__tie")
    rows = held(rows.withColumn("__place", F.row_number().over(inside)))
    off = F.abs(F.col("size") - F.col("__gap"))
    closing = (
        rows.where(~F.col("__drawn") & (F.col("size") > 0) & (off < F.col("__gap")))
        .groupBy("__source").agg(F.min(F.struct(off.alias("off"), F.col("__key").alias("key"), F.col("__cell").alias("cell"), F.col("__place").alias("place"))).alias("x"))
        .select("__source", "x.cell", "x.place")
    )
    closed = _by_source(rows, closing, "left").select(
        "e.*", F.coalesce((F.col("o.cell") == F.col("e.__cell")) & (F.col("o.place") == F.col("e.__place")), F.lit(False)).alias("__closes")
    )
    times = F.when(F.col("size") > 0, F.col("__epochs") + F.col("__drawn").cast("long") + F.col("__closes").cast("long")).otherwise(0)
    return closed.select("doc_id", "__source", "__tie", "__cell", "__place", "size", "source_size", "target", times.cast("long").alias("times"))


def mix(docs: DataFrame, quality: Column | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Rows without words go."""
    key = ["__none", "__id", "__tie", "__source"]
    decided = decide(docs, quality).withColumns({
        "__none": F.col("doc_id").isNull(), "__id": F.coalesce("doc_id", F.lit(0)),
    })
    decided = decided.withColumn("__copy", F.row_number().over(Window.partitionBy(*key).orderBy("__cell", "__place")))
    marked = docs.select(
        as_row(docs), F.col("doc_id").isNull().alias("__none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id"),
        F.xxhash64(whole_text()).alias("__tie"),
        F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit(""))).alias("__source"),
    )
    marked = marked.withColumn("__copy", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))))
    decided = decided.where("times > 0").select(*key, "__copy", F.col("times").cast("int").alias("__times"))
    taken = marked.join(decided, [*key, "__copy"])
    return taken.select(ROW, F.explode(F.array_repeat(F.lit(0), F.col("__times")))).select(*row_columns(docs.columns))
