"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Each source has a target of words.  Inside a source a document's expected
copies are its inclusion rate: in proportion to a weight of its size class,
at most ``most``, with the sum of rate times size equal to the target.  The
whole part of a rate is taken for certain, as whole copies.  For what is left
the documents stand in Pareto order, the odds of a random number divided by
the odds of their inclusion, and are taken from the front until the source's
words are complete; the document at the border gives the words still wanting.

No source is gathered anywhere.  Rates come from words summed per source and
size class.  The border of a source is found digit by digit: words are summed
per leading digits of the order's key, which combines in every task, and the
digit where the running sum passes what is wanted is fixed for the next round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.numbering import numbered
from claimspark.llm.store import written

#: Bits of the order's key, and of one digit of it.
KEY_BITS, DIGIT_BITS = 52, 13
#: Characters that stand between words.
BLANK = r"[\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    inner = F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")
    return F.when(F.coalesce(inner, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(inner, f"{BLANK}+"))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """(source, source_size, target) of every source of ``sizes`` (source, source_size).

    The words to mix, ``percent`` of all, are shared by the weights, which
    repeat over the sources by name, null last.  A target stops at ``most``
    times its source's size, and what is above is shared again until no
    target is.  Rounds end when one changes nothing; each is a sum over the
    sources' table, and sums of whole numbers keep it exact.
    """
    order = sizes.select("source", "source_size", F.col("source").isNull().alias("last"))
    placed = numbered(written(order, "sizes"), [], ["last", "source"], "place")
    cycle = F.array(*[F.lit(w) for w in weights])
    table = written(placed.select(
        "source", "source_size", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).cast("long").alias("weight"),
        (F.col("source_size") * most).alias("cap")), "weights")
    share, full = None, F.lit(False)
    while True:
        a = table.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("cap")).otherwise(0)).alias("capped"),
                      F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
                      F.count(F.when(full, 1)).alias("n")).first()
        before = share
        share = (percent * (a["all"] or 0) / 100 - (a["capped"] or 0)) / a["open"] if a["open"] else 0.0
        if before is not None and n_full == a["n"]:
            break
        n_full, full = a["n"], full | (F.lit(share) * F.col("weight") > F.col("cap"))
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.lit(share) * F.col("weight"))
    return table.select("source", "source_size", target.alias("target"))


def rates(classes: DataFrame, most: int) -> DataFrame:
    """(source, target, classes) with the inclusion rate of every size class, from (source, class, words, target).

    rate = min(most, c * (class + 1)), c such that rate times words adds up to
    the target.  Classes are bit lengths of sizes, 64 at most, so a source's
    stand in one array; the higher classes reach ``most`` first.
    """
    one = classes.where("class > 0").groupBy("source", "target").agg(
        F.reverse(F.array_sort(F.collect_list(F.struct("class", "words")))).alias("cs"))
    zero = F.lit(0).cast("long")
    words_of = F.aggregate("cs", zero, lambda a, x: a + x["words"] * (x["class"] + 1))

    def step(state: Column, x: Column) -> Column:
        # state: words above that are full, weighted words left, whether a class was found that stays below ``most``.
        c = (F.col("target") - state["full"] * most) / F.nullif(state["left"], F.lit(0))
        fills = ~state["done"] & (state["left"] > 0) & (c * (x["class"] + 1) >= most)
        return F.struct(F.when(fills, state["full"] + x["words"]).otherwise(state["full"]).alias("full"),
                        F.when(fills, state["left"] - x["words"] * (x["class"] + 1)).otherwise(state["left"]).alias("left"),
                        (state["done"] | ~fills).alias("done"), F.when(fills, x["class"]).otherwise(state["least"]).alias("least"))

    start = F.struct(zero.alias("full"), words_of.alias("left"), F.lit(False).alias("done"), F.lit(99).cast("long").alias("least"))
    found = one.withColumn("end", F.aggregate("cs", start, step))
    c = F.when(F.col("end.left") > 0, (F.col("target") - F.col("end.full") * most) / F.col("end.left")).otherwise(F.lit(0.0))
    return found.select("source", F.explode("cs").alias("x"), F.col("end.least").alias("least"), c.alias("c")).select(
        "source", F.col("x.class").alias("class"), F.col("x.words").alias("words"),
        F.when(F.col("x.class") >= F.col("least"), F.lit(float(most))).otherwise(F.col("c") * (F.col("x.class") + 1)).alias("rate"))


def _border(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, key, before, tied): the key where each source's words in key order pass those wanted.

    ``before`` are the words of smaller keys, ``tied`` those of the key itself.
    """
    border = wanted.select("source", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("before"), "wanted")
    shift = KEY_BITS
    while shift > 0:
        last, shift = shift, shift - DIGIT_BITS
        near = rows.join(_renamed(border), F.col("source").eqNullSafe(F.col("source_"))
                         & (F.shiftright("key", last) == F.col("key_")))
        sums = near.groupBy("source", F.shiftright("key", shift).alias("key")).agg(
            F.sum("size").alias("tied"), F.first("before_").alias("before"), F.first("wanted_").alias("wanted"))
        running = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("tied").over(running), F.lit(0)))
        border = written(sums.where("before < wanted AND before + tied >= wanted"), "border")
    return border


def _renamed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}_") for c in df.columns])


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2, seed: str = "mix") -> DataFrame:
    """Words taken of every document: doc_id, size, source_size, target, taken, rate, copies.

    ``rate`` are its expected copies, ``copies`` the whole ones it is sure of.
    A source's taken words are its target without the fraction, but where
    documents of one source, id and size stand at the border: they share what
    is wanting in equal whole words, so fewer words than such documents may
    be missing.  Random numbers are digests of seed, id and size; reruns agree.
    Null sources are one source, the last.  Null and empty texts have size
    0 and nothing is taken of them.  Repeated rows are documents of their
    own, with the same result.  An empty table gives no rows.  Other columns
    are not read, whatever their names.
    """
    size = words(F.col("text"))
    once = written(docs.select("doc_id", "source", size.alias("size")), "sizes")
    bits = F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0).cast("long")
    once = once.withColumn("class", bits)
    classes = written(once.groupBy("source", "class").agg(F.sum("size").alias("words")), "classes")
    goal = written(targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, percent, most), "targets")
    known = classes.join(_renamed(goal), F.col("source").eqNullSafe(F.col("source_"))).select(
        "source", "class", "words", F.col("target_").alias("target"))
    rate = written(rates(known, most), "rates")
    # Certain copies use up this part of a source's target.
    sure = rate.groupBy("source").agg(F.sum(F.floor("rate") * F.col("words")).alias("sure"))
    wanted = written(goal.join(_renamed(sure), F.col("source").eqNullSafe(F.col("source_"))).select(
        "source", (F.floor("target") - F.col("sure_")).cast("long").alias("wanted")), "wanted")

    ident = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))
    u = (F.conv(F.substring(F.md5(ident), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    part = F.col("rate") - F.floor("rate")
    # The ratio of odds as a share: q / (1 + q) of q = u / (1 - u) / (part / (1 - part)), which needs no logarithm.
    low, high = u * (1 - part), (1 - u) * part
    key = F.when(part > 0, F.least(F.floor(low / (low + high) * float(1 << KEY_BITS)).cast("long"),
                                   F.lit((1 << KEY_BITS) - 1).cast("long")))
    ranked = once.join(_renamed(rate), F.col("source").eqNullSafe(F.col("source_")) & (F.col("class") == F.col("class_")), "left") \
        .withColumn("rate", F.coalesce(F.col("rate_"), F.lit(0.0))) \
        .select("doc_id", "source", "size", "rate", F.floor("rate").cast("long").alias("copies"), key.alias("key"))
    ranked = written(ranked, "ranked")
    border = _border(ranked.where("key IS NOT NULL").select("source", "key", "size"), wanted.where("wanted > 0"))
    both = ranked.join(_renamed(goal), F.col("source").eqNullSafe(F.col("source_"))).drop("source_") \
        .join(_renamed(border), F.col("source").eqNullSafe(F.col("source_")), "left")
    share = F.expr("CAST(size AS DECIMAL(19, 0)) * CAST(wanted_ - before_ AS DECIMAL(19, 0)) DIV tied_")
    extra = F.when(F.col("key") < F.col("key_"), F.col("size")).when(F.col("key") == F.col("key_"), share).otherwise(0)
    return both.select("doc_id", "size", F.col("source_size_").alias("source_size"), F.col("target_").alias("target"),
                       (F.col("copies") * F.col("size") + extra).cast("long").alias("taken"), "rate", "copies")
