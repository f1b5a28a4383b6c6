"""Mixing sources to target weights by entropy balancing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Token targets of sources, added to rows with source and source_size.

    A source's weight goes by its rank in code point order, null last. Targets share
    share * (all sizes) by weight; sources that would pass most * (own size) get just
    that, found in one pass over sources by their limit per weight: those before the
    first that stays below the common level are at their limit.
    """
    one = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(one) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("weight", weight.cast("double")).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    everything = W.partitionBy()
    by_limit = W.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = ranked.withColumn("rest", rest).withColumn("others", F.sum("weight").over(by_limit.rowsBetween(0, W.unboundedFollowing)))
    level = level.withColumn("below", F.col("rest") * F.col("weight") < F.col("limit") * F.col("others"))
    first = F.max(F.when(F.col("below"), F.struct((F.col("rest") / F.col("others")).alias("a"), "rest", "others"))).over(everything)
    shared = F.col("weight") * first["rest"] / first["others"]
    return level.withColumn("target", F.when(F.col("below"), F.least(shared, F.col("limit"))).otherwise(F.col("limit"))).select(*sizes.columns, "target")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that later expressions read instead of repeating; a generator keeps the optimizer from merging them."""
    return df.withColumn(name, F.explode(F.array(value)))


def expected(size: Column, mean: Column, t: Column, most: float) -> Column:
    """The rate of a size: of all rates between 0 and `most` with the wanted tokens, those closest to even ones in entropy."""
    return F.lit(float(most)) / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -t * size / mean))))


def solved(counts: DataFrame, sources: DataFrame, most: float, close: float = 1e-9, rounds: int = 100) -> DataFrame:
    """sources with the multiplier t that gives each its target, by Newton's method on the dual.

    The dual has one multiplier per source. An iteration is one pass over the counts
    (key, size, n) with partial sums by source; the multipliers that come out are a
    table that the next one joins. It begins where texts of mean size would meet
    the target, and from the far side of the solution steps back to 0 at most; from
    0 on steps approach it from one side. It ends when no source is off by more than
    `close` of its target and fails if that is not reached. Sums are decimals, so
    that reruns agree.
    """
    share = F.col("target") / F.col("source_size")
    limit = lambda t: F.greatest(F.lit(-30.0), F.least(F.lit(30.0), t))
    open_ = (F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * F.lit(float(most))) & (F.col("target") > 0)
    state = sources.withColumn("t", F.when(open_, limit(F.log(share / (F.lit(float(most)) - share)))))
    exact = lambda x: x.cast("decimal(38,8)")
    for _ in range(rounds):
        rate = expected(F.col("size"), F.col("mean"), F.col("t"), most)
        tokens = F.col("n") * F.col("size") * rate
        rows = counts.join(state.where("t is not null").select("key", "t", "mean"), "key")
        sums = rows.groupBy("key").agg(F.sum(exact(tokens)).cast("double").alias("g"), F.sum(exact(tokens * (1 - rate / float(most)) * F.col("size") / F.col("mean"))).cast("double").alias("h"))
        off = F.col("target") - F.col("g")
        moved = F.col("t") + F.when(F.col("h") > 1e-9 * F.col("target"), off / F.col("h")).otherwise(0.0)
        side = F.signum(F.col("target") - F.col("source_size") * (most / 2))
        moved = F.when(side * moved < 0, 0.0).otherwise(moved)
        near = F.abs(off) <= close * F.col("target") + 1e-6
        after = state.join(sums, "key", "left").withColumns({"t": F.when(near, F.col("t")).otherwise(moved), "near": F.coalesce(near, F.lit(True))}).drop("g", "h")
        after = written(after, "tilt")
        done = after.where("not near").isEmpty()
        state = after.drop("near")
        if done:
            return state
    raise RuntimeError(f"the mix did not come close to its targets in {rounds} iterations")


def mix(rows: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, chunk: int = 1024, salts: int = 256) -> DataFrame:
    """Copies of rows that bring every source to its token target.

    rows: id, source, size and row (a struct, passed through). Rows of one source
    and size are alike to the mix, so all is decided on counts by source and size
    (partial sums before any shuffle): targets, Newton's method for the tilt, and
    rounding. Rounding goes from large to small sizes; each class gets the number
    of copies that brings the tokens taken so far nearest to what the rates say, so
    that small texts make up for what large ones leave. A source's distinct sizes,
    not more than its longest text has words, are one row there, worked on in steps
    of `chunk`. Copies are then dealt to the class's rows by a hash of the
    id; `salts` parts of a class are numbered apart, so that no class, however
    large, has to meet in one task. The sources themselves, a row each, are ranked
    in one task.

    Null sources are a source of their own. Rows of size 0 are taken once. Rows
    that are repeated count as often as they come; of rows that tie in the hash of
    their id the smaller id is taken first. Very long texts are sizes as others. No
    rows: no rows. Other columns than these are not looked at.

    Returns row, size, source_size, target, rate, copies.
    """
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source")))
    keyed = rows.withColumns({"key": key, "size": F.col("size").cast("double"), "order": F.xxhash64("id", F.lit(5))}).withColumn("salt", F.pmod(F.xxhash64("id", F.lit(17)), F.lit(salts)).cast("int"))
    parts = keyed.groupBy("key", "source", "size", "salt").agg(F.count(F.lit(1)).alias("part"))
    counts = written(parts.groupBy("key", "source", "size").agg(F.sum("part").cast("double").alias("n")), "counts")
    source = counts.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    source = targets(source, weights, share, most).withColumn("mean", F.col("source_size") / F.col("rows"))
    source = solved(counts, source.select("key", "source_size", "mean", "target"), float(most))
    full = F.col("target") >= F.col("source_size") * F.lit(float(most))
    rate = F.when(F.col("size") == 0, 1.0).when(full, F.lit(float(most))).when(F.col("target") <= 0, 0.0).otherwise(expected(F.col("size"), F.col("mean"), F.col("t"), most))
    classes = counts.join(source, "key").withColumn("rate", rate)
    listed = classes.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("size", "n", "rate")), asc=False).alias("sizes"))

    def deal(a, e):
        owed = a["owed"] + e["n"] * e["rate"] * e["size"]
        k = F.when(e["size"] > 0, F.greatest(F.lit(0.0), F.least(e["n"] * most, F.round(owed / e["size"])))).otherwise(e["n"])
        return F.struct((owed - k * e["size"]).alias("owed"), F.concat(a["k"], F.array(k)).alias("k"))

    none = F.array().cast("array<double>")
    begin = F.array(F.struct(F.lit(0.0).alias("owed"), none.alias("k")))
    steps = F.transform(F.sequence(F.lit(0), F.floor((F.size("sizes") - 1) / chunk).cast("int")), lambda i: F.slice("sizes", i * chunk + 1, chunk))
    dealt = F.aggregate(steps, begin, lambda a, c: F.concat(a, F.array(F.aggregate(c, F.struct(F.element_at(a, -1)["owed"].alias("owed"), none.alias("k")), deal))))
    listed = once(listed, "k", F.flatten(F.transform(dealt, lambda x: x["k"])))
    numbers = listed.select("key", F.explode(F.arrays_zip("sizes", "k")).alias("e")).select("key", F.col("e.sizes.size").alias("size"), F.col("e.k").alias("k"))
    classes = classes.join(numbers, ["key", "size"])
    earlier = W.partitionBy("key", "size").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("earlier", F.coalesce(F.sum("part").over(earlier), F.lit(0))).drop("source", "part")
    plan = parts.join(classes.select("key", "size", "source_size", "target", "n", "rate", "k"), ["key", "size"])
    number = F.row_number().over(W.partitionBy("key", "size", "salt").orderBy("order", "id"))
    numbered = keyed.withColumn("number", number).join(plan, ["key", "size", "salt"])
    copies = F.floor(F.col("k") / F.col("n")) + F.when(F.col("number") + F.col("earlier") <= F.col("k") - F.floor(F.col("k") / F.col("n")) * F.col("n"), 1).otherwise(0)
    return numbered.select("row", F.col("size").cast("long").alias("size"), F.col("source_size").cast("long").alias("source_size"), "target", "rate", copies.cast("int").alias("copies"))


def mixture(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """mix() for a table of texts whose size is their number of words; row has id_col alone."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col).cast("string")).alias("size"))
    rows = written(rows, "mixing")  # small; else every text would be read for its words several times
    return mix(rows.withColumn("row", F.struct(F.col("id").alias(id_col))), **options)


def repeated(docs: DataFrame, columns: tuple[str, ...], *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The columns of docs, each row as often as mix() takes it."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col).cast("string")).alias("size"), F.struct(*columns).alias("row"))
    taken = mix(rows, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op5(docs: DataFrame) -> DataFrame:
    out = mixture(docs)
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "rate")
