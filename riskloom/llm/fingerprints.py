"""Document fingerprints from closed syncmers.

Over a text's words, a run of five is a closed syncmer when the smallest of its four inner two-word hashes is
the first or the last. The choice depends on nothing outside the run, so an edit elsewhere leaves it alone.
A fingerprint has all distinct syncmers of a text, each with its first word position: anchors that match by hash and
then by the order of their positions. Their number grows with the text, and none is left out, so texts that differ in
one passage differ in its anchors. All work is built-in expressions over one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import add_once
from riskloom.llm.common import documents, let, paired, records, words_of

ANCHOR = "array<struct<hash:bigint,place:int>>"
RANGE_ROWS = 5_000
MAX_RANGES = 2_000


def _least(a: Column, gap: int) -> Column:
    return F.zip_with(a, F.slice(a, gap + 1, F.size(a)), lambda x, y: F.least(x, y))


def anchors(text: Column) -> Column:
    """The anchors by hash. A text of one to four words has one, of all its words; none without words."""

    def chosen(w):
        h1 = F.transform(w, lambda x: F.xxhash64(x))

        def syncmers(one):
            def over(two):
                def pick(low):
                    four = paired(two, 2)  # words i..i+3
                    runs = F.slice(F.zip_with(four, F.slice(one, 5, F.size(one)), lambda x, y: F.xxhash64(x, y)), 1, F.greatest(F.size(one) - 4, F.lit(0)))
                    marked = F.transform(runs, lambda x, i: F.when(
                        (F.get(low, i) == F.get(two, i)) | (F.get(low, i) == F.get(two, i + 3)), F.struct(x.alias("hash"), i.alias("place"))
                    ))
                    return marked

                return let(_least(_least(two, 1), 2), pick)  # the least of the hashes i..i+3

            return let(paired(one, 1), over)

        few = F.array(F.struct(F.xxhash64(F.concat_ws(" ", w)).alias("hash"), F.lit(0).alias("place")))

        def lowest(s):  # sorted by hash, then place: the first of equal hashes stays
            return F.filter(s, lambda x, i: ~F.coalesce(F.get(s, i - 1)["hash"] == x["hash"], F.lit(False)))

        def distinct(x):
            return let(F.sort_array(x), lowest)

        return F.when(F.size(w) == 0, F.array().cast(ANCHOR)).when(F.size(w) < 5, few.cast(ANCHOR)).otherwise(
            let(h1, lambda one: distinct(F.filter(syncmers(one), lambda x: x.isNotNull()))).cast(ANCHOR)
        )

    return let(words_of(text), chosen)


def longest_rise(a: Column) -> Column:
    """The length of the longest strictly rising subsequence of an array of int."""

    def rises(s):
        return F.forall(F.zip_with(s, F.slice(s, 2, F.size(s)), lambda x, y: F.coalesce(y > x, F.lit(True))), lambda v: v)

    def put(ends, x):  # the least last element of a rise of each length; x ends one longer than those below it
        return let(F.size(F.filter(ends, lambda y: y < x)), lambda n: F.concat(F.slice(ends, 1, n), F.array(x), F.slice(ends, n + 2, F.size(ends))))

    return let(a, lambda s: F.when(rises(s), F.size(s)).otherwise(F.size(F.aggregate(s, F.array().cast("array<int>"), put))))


def likeness(a: Column, b: Column) -> Column:
    """Of the anchors of both, the share that both have at consistent places: 0 to 1.

    Places are consistent when they have one order in both: the longest rise of the places in ``b``, taken by place
    in ``a``, however much was put in or left out in between. Two without anchors are alike (1), one without and
    one with are not (0). Equal hashes find each other by sorting; only shared anchors that are out of order cost more
    than that.
    """

    def side(c, n):
        return F.transform(c, lambda x: F.struct(x["hash"].alias("hash"), F.lit(n).alias("side"), x["place"].alias("place")))

    def met(s):  # after sorting, a shared hash of a is followed by that of b
        pairs = F.transform(s, lambda x, i: let(F.get(s, i + 1), lambda y: F.when(
            (x["side"] == 0) & (y["hash"] == x["hash"]), F.struct(x["place"].alias("here"), y["place"].alias("there"))
        )))
        return F.sort_array(F.filter(pairs, lambda x: x.isNotNull()))

    def share(p):
        return longest_rise(F.transform(p, lambda x: x["there"])) / (F.size(a) + F.size(b) - F.size(p))

    hashes = lambda c: F.transform(c, lambda x: x["hash"])
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .when(~F.arrays_overlap(hashes(a), hashes(b)), 0.0)
        .otherwise(let(F.sort_array(F.concat(side(a, 0), side(b, 1))), lambda s: let(met(s), share))).cast("double")
    )


def fingerprint(a: Column) -> Column:
    """The anchors as text: hexadecimal hash @ place, by hash; empty without anchors."""
    return F.array_join(F.transform(a, lambda x: F.concat(F.hex(x["hash"]), F.lit("@"), x["place"].cast("string"))), " ")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): each document with the next by id, the last with the first.

    Ids are cut into ranges at quantiles; a range is one group of the only shuffle, which carries texts alone. Null
    ids come first, and they, like an id that fills whole ranges, are cut further by the hash of their text, so that
    no id is one group. The last row of a range takes the first row of the next range, of which there is one per range.
    Rows with equal ids are ordered by the hash of their text. One document alone is its own next.
    """
    spark = docs.sparkSession
    rows = records(docs).drop("rec")
    n, nulls = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    ranges = int(min(MAX_RANGES, max(1, n // RANGE_ROWS)))
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [i / ranges for i in range(1, ranges)] or [0.5], 10 * MAX_RANGES)).first()[0]
    points = sorted({*(cuts or [])})
    if not points:
        points = [0]
    # At most MAX_RANGES literal numbers. Beyond, each range is cut evenly by id, so groups stay of one size.
    heavy = {p: cuts.count(p) * max(1, n // (RANGE_ROWS * ranges)) for p in points if cuts and cuts.count(p) > 1}
    ends = F.array(*[F.lit(p).cast("long") for p in points])
    below = F.size(F.filter(ends, lambda p: p < F.col("doc_id")))
    parts = max(1, n // (RANGE_ROWS * (len(points) + 1)))
    low, high = F.get(ends, below - 1), F.get(ends, below)
    part = F.coalesce(F.floor((F.col("doc_id") - low - 1) * parts / (high - low)), F.lit(0)).cast("long")
    by_text = lambda pieces: F.floor((F.shiftright("text_key", 32) + (1 << 31)) * F.lit(pieces) / F.lit(1 << 32)).cast("long")
    piece = F.when(F.col("doc_id").isNull(), by_text(max(1, -(-nulls // RANGE_ROWS))))
    for p, pieces in heavy.items():
        piece = piece.when(F.col("doc_id") == p, by_text(pieces))
    of = F.when(F.col("doc_id").isNull(), F.struct(F.lit(-1).cast("long").alias("below"), F.lit(0).cast("long").alias("part"), piece.alias("piece"))).otherwise(
        F.struct(below.cast("long").alias("below"), part.alias("part"), F.coalesce(piece, F.lit(0).cast("long")).alias("piece"))
    )
    return _linked(rows.withColumn("range", of))


def _linked(rows: DataFrame) -> DataFrame:
    order = ("doc_id", "text_key", "text")
    w = Window.partitionBy("range").orderBy(*order)
    linked = rows.withColumn("next", F.lead("text").over(w))
    firsts = rows.groupBy("range").agg(F.min_by("text", F.struct(*order)).alias("first"))
    ring = Window.orderBy("range")  # one number a range, without texts
    numbers = rows.select("range").distinct()
    pairs = numbers.select(F.col("range").alias("after"), F.coalesce(
        F.lag("range").over(ring), F.last("range").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ).alias("range"))
    follow = pairs.join(firsts.withColumnRenamed("range", "after"), "after").select("range", "first")
    out = linked.join(follow, "range", "left")
    return out.select("doc_id", "text", F.coalesce("next", "first").alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The last half (rounded down) of the code points replaced by the first as many, or all, of the next text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def op7_fingerprints(spark, sf_dir) -> DataFrame:
    """One row per document; null texts are empty, repeated rows each come out, an empty table gives no rows."""
    rows = with_next(documents(spark, sf_dir))
    rows = add_once(rows, anchors=anchors(F.col("text")), next_anchors=anchors(F.col("next_text")), edited_text=edited(F.col("text"), F.col("next_text"))).drop("next_text")
    rows = add_once(rows, edited_anchors=anchors(F.col("edited_text")))
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"), fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
