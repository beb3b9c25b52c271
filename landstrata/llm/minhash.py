"""Document fingerprints: one-permutation MinHash with optimal densification, in SQL functions only.

Every word shingle is hashed once. The upper bits of a hash name its bin, and each bin keeps its least
hash. An empty bin borrows from a bin chosen by a hash of its own number, again and again until that
one is not empty, the same way for every document. Of each bin's hash the low-order bits are stored. Two
fingerprints agree in a share of their bins; what agrees by chance of so few bits is taken off.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WIDTH = 5  # words of a shingle
BIN_BITS = 8  # 2**BIN_BITS bins
LOW_BITS = 8  # bits that are stored of each bin
TRIES = 6  # bins that an empty one asks in turn, before all that are not empty are ranked
BUCKET = 256  # documents that are put in order together, about
BUCKETS = 16_384  # at most

_REST = 64 - BIN_BITS
_FULL = (1 << _REST) - 1  # the largest rest of a bin; marks the bin's end


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once for each row."""
    return F.transform(F.array(value), use)[0]


def bins(text: Column) -> Column:
    """The low-order bits of every bin, as array<tinyint>; without any word an empty array.

    Words are runs without ASCII white space, in lower case; a text with fewer than WIDTH words has its
    whole sequence as its only shingle. Null counts as empty.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t-\r]+"), lambda w: w != "")
    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: _bins(_shingles(hashes)))


def _shingles(words: Column) -> Column:
    count = F.greatest(F.size(words) - (WIDTH - 1), F.least(F.size(words), F.lit(1)))
    later = lambda i: [F.get(words, i + k) for k in range(1, WIDTH)]  # noqa: E731  null beyond the end: left out of the hash
    return F.transform(F.slice(words, 1, count), lambda w, i: F.xxhash64(w, *later(i)))


def _bins(hashes: Column) -> Column:
    half = 1 << (BIN_BITS - 1)
    ends = F.transform(F.sequence(F.lit(-half).cast("bigint"), F.lit(half - 1).cast("bigint")), lambda b: F.shiftleft(b, _REST).bitwiseOR(F.lit(_FULL)))
    number = lambda x: F.shiftright(x, _REST)
    # Sorted together with every bin's end, the first value of a bin is its least hash, or its end.
    least = _let(F.sort_array(F.concat(hashes, ends)), lambda s: F.filter(s, lambda x, i: (i == 0) | (number(x) != number(F.get(s, i - 1)))))
    held = F.transform(least, lambda x: F.when(x.bitwiseAND(F.lit(_FULL)) != _FULL, x))

    def filled(values: Column) -> Column:
        some = F.filter(values, lambda x: x.isNotNull())
        asked = lambda i: [F.get(values, F.pmod(F.xxhash64(i, F.lit(k)), F.lit(1 << BIN_BITS)).cast("int")) for k in range(TRIES)]
        ranked = lambda own, i: F.array_min(F.transform(own, lambda x: F.struct(F.xxhash64(i, number(x)).alias("r"), x.alias("x"))))["x"]
        low = lambda x: (x.bitwiseAND(F.lit((1 << LOW_BITS) - 1)) - (1 << (LOW_BITS - 1))).cast("tinyint")
        return _let(some, lambda own: F.transform(values, lambda x, i: low(F.coalesce(x, *asked(i), ranked(own, i)))))

    none = F.array().cast("array<tinyint>")
    return F.when(F.size(hashes) > 0, _let(held, filled)).otherwise(none)


def packed(signature: Column) -> Column:
    """A signature as text: two hexadecimal digits for each bin."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x.cast("int") + (1 << (LOW_BITS - 1))), 2, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity of two signatures, 0 to 1, without the bias of few bits.

    Two texts without words are alike (1), one without words and another are not (0).
    """
    chance = 2.0**-LOW_BITS
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda x: x)) / float(1 << BIN_BITS)
    estimate = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (same - chance) / (1 - chance)))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), ((F.size(a) == 0) & (F.size(b) == 0)).cast("double")).otherwise(estimate)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, fingerprint) of every row; null texts count as empty, repeated rows and null keys stay."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(key, F.char_length(whole).cast("bigint").alias("n_chars"), packed(bins(whole)).alias("fingerprint"))


def with_next(docs: DataFrame, key: str, carried: list[str], derived: dict[str, Column] | None = None) -> DataFrame:
    """`docs` with `next_<column>` for each carried column: those of the row with the next larger key.

    The last row is followed by the first. Keys must be integers; rows with a null key are left out, and
    equal keys follow each other in the order of their carried columns. Rows are dealt to buckets of
    neighbouring keys, cut at quantiles; each bucket also gets the first row of the next one, so that
    no row looks beyond its bucket. The quantiles, at most BUCKETS numbers, are all the driver sees.
    Columns `derived` from a row are computed once for each row of a bucket, and may be carried.
    """
    docs = docs.where(F.col(key).isNotNull())
    rows = docs.count()
    parts = min(BUCKETS, max(1, rows // BUCKET))
    shares = [i / (parts + 1) for i in range(1, parts + 1)]
    found = docs.agg(F.percentile_approx(F.col(key), shares, max(10_000, 4 * parts)).alias("q")).first().q
    # The bucket's number by halving steps over the sorted quantiles.
    cuts = sorted(set(found or []))
    table = F.lit(cuts).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    steps = [1 << b for b in range(len(cuts).bit_length() - 1, -1, -1)] if cuts else []
    bucket = F.lit(0)
    if steps:
        climb = lambda at, step: F.when((at + step <= len(cuts)) & (F.get(table, at + step - 1) <= F.col(key)), at + step).otherwise(at)
        bucket = F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), climb)
    dealt = docs.withColumn("__bucket", bucket).withColumn("__guest", F.lit(False))

    heads = dealt.groupBy("__bucket").agg(F.min(key).alias("__first"))  # a row for each bucket
    line = Window.orderBy("__bucket")
    before = F.coalesce(F.lag("__bucket").over(line), F.max("__bucket").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.select("__first", before.alias("__to"))
    guests = docs.join(F.broadcast(heads), F.col(key) == F.col("__first")).withColumn("__bucket", F.col("__to")).withColumn("__guest", F.lit(True))
    both = dealt.unionByName(guests.select(dealt.columns)).withColumns(derived or {})

    order = Window.partitionBy("__bucket").orderBy("__guest", key, *carried)
    for name in carried:
        both = both.withColumn(f"next_{name}", F.lead(name).over(order))
    return both.where(~F.col("__guest")).drop("__bucket", "__guest")


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has the last floor(n_chars / 2) code points of a text replaced by as many of the next
    document's first ones, or all it has. The next document has the next larger key; the last one's is the
    first, and a document that is alone follows itself. Null texts count as empty. Rows with a null key are
    left out; repeated rows follow each other. An empty table gives an empty result. Other columns are
    not looked at.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", ["text", "signature"], {"signature": bins(F.col("text"))})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "signature", "next_signature")
    rows = rows.withColumn("other", bins(F.col("edited")))
    return rows.select(
        F.col("doc_id").alias(key), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("signature")).alias("fingerprint"), packed(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("other")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
