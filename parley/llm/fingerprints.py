"""Order MinHash fingerprints.

Native: DataFrame functions only. A text is a sequence of words; its k-mers are runs of `k` words, each
numbered by how often the same run stood before, so that repeats count. A 64-bit hash puts every numbered
k-mer into one of `bins` bins; in a bin the `per_bin` smallest are kept, put back into text order, and
hashed as a tuple. Two texts get the same entry for a bin when the same k-mers are minimal there AND stand
in the same order, so the share of equal entries falls with edit distance, not only with set overlap.
A fingerprint is the entries of the bins that have any, written as hexadecimal, joined by points.

Everything happens inside the row: k-mers sort as 64-bit integers (bin and hash above, position below).
Null or empty text: no k-mers and the empty fingerprint; two of these are alike to 1. Fewer than k words:
the words together are the one k-mer. Rows that repeat doc_id and text stand at one place in the order, as
they could not be told apart, and have the same figures each. Texts under one doc_id are ordered by their hash. A
text of any length is read whole; other columns are not read. No rows: no rows.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from parley.llm.common import words_of, written

K, BINS, PER_BIN = 3, 64, 2
_PLACE_BITS = 28  # positions take the low bits; so many k-mers can be told apart in order


def _kmers(words: Column, k: int) -> Column:
    at = F.sequence(F.lit(0), F.size(words) - k)
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).when(
        F.size(words) < k, F.array(F.xxhash64(words))).otherwise(
        F.transform(at, lambda i: F.xxhash64(*[words[i + j] for j in range(k)])))


def with_fingerprint(df: DataFrame, text: str, name: str, k=K, bins=BINS, per_bin=PER_BIN) -> DataFrame:
    """`df` with the fingerprint of column `text` as `name`; each row by itself."""
    keep = df.columns
    a = df.select(*keep, words_of(F.col(text)).alias("_w"))
    a = a.select(*keep, _kmers(F.col("_w"), k).alias("_h"))
    # occurrence numbers: equal k-mers stand together once sorted, and are counted from 0 in each run
    s = F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    a = a.select(*keep, "_h", F.when(F.size("_h") > F.size(F.array_distinct("_h")), s).alias("_s"))
    starts = F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda i: (i == 0) | (F.get(F.col("_s"), i - 1)["h"] != F.get(F.col("_s"), i)["h"]))
    a = a.select(*keep, "_h", "_s", F.when(F.col("_s").isNotNull(), starts).alias("_r"))
    number = F.flatten(F.transform("_r", lambda r, j: F.sequence(F.lit(0), F.coalesce(F.get(F.col("_r"), j + 1), F.size("_s")) - r - 1)))
    a = a.select(*keep, "_h", "_s", number.alias("_n"))
    pack = lambda h, p: F.shiftleft(F.shiftrightunsigned(h, _PLACE_BITS), _PLACE_BITS).bitwiseOR(
        F.pmod(p, F.lit(1 << _PLACE_BITS)).cast("long"))
    single = F.transform("_h", lambda x, i: pack(F.xxhash64(x, F.lit(0)), i))
    # zipped, as an array that is read inside a lambda only may be computed again for each element
    several = F.transform(F.arrays_zip("_s", "_n"), lambda z: pack(F.xxhash64(z["_s"]["h"], z["_n"]), z["_s"]["p"]))
    a = a.select(*keep, "_h", F.sort_array(F.when(F.col("_s").isNull(), single).otherwise(several)).alias("_v"))
    bin_of = lambda v: F.shiftrightunsigned(v, 64 - (bins - 1).bit_length())
    v = F.col("_v")
    least = F.filter(v, lambda e, i: (i < per_bin) | (bin_of(F.get(v, i - per_bin)) != bin_of(e)))
    a = a.select(*keep, "_h", least.alias("_m"))
    m = F.col("_m")
    firsts = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: (i == 0) | (bin_of(F.get(m, i - 1)) != bin_of(F.get(m, i))))
    a = a.select(*keep, "_h", "_m", F.when(F.size(m) == 0, F.array().cast("array<int>")).otherwise(firsts).alias("_f"))
    place = lambda e: F.pmod(e, F.lit(1 << _PLACE_BITS)).cast("int")

    def entry(i):
        own = F.filter(F.slice(m, i + 1, per_bin), lambda e: bin_of(e) == bin_of(F.get(m, i)))
        ordered = F.transform(F.sort_array(F.transform(own, place)), lambda p: F.get(F.col("_h"), p))
        return F.concat(F.lpad(F.lower(F.hex(bin_of(F.get(m, i)))), 2, "0"),
                        F.lpad(F.lower(F.hex(F.shiftrightunsigned(F.xxhash64(ordered), 40))), 6, "0"))

    return a.select(*keep, F.concat_ws(".", F.transform("_f", entry)).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Equal entries over bins that either fingerprint has."""
    x, y = F.split(a, r"\."), F.split(b, r"\.")
    head = lambda z: F.transform(z, lambda e: F.left(e, F.lit(2)))
    share = F.size(F.array_intersect(x, y)) / F.size(F.array_union(head(x), head(y)))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(share)


def neighbours(keys: DataFrame) -> DataFrame:
    """Of (doc_id, kd, th, n), each key once: the same with `back`, the key before it in descending order of
    doc_id (nulls last), whose next it is; before the first stands the last. Range-partitioned, so no task
    sees all rows; what crosses a border is one row per partition."""
    order = [F.col("doc_id").desc_nulls_last(), F.desc("th")]
    k = written(keys.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "omh-ordered")
    me = F.struct("kd", "th", "n")
    rank = F.struct(F.col("doc_id").isNotNull(), "kd", "th")  # the same order, as one value
    tails = k.groupBy(F.col("_p").alias("_q")).agg(F.min_by(me, rank).alias("_tail"))
    whole = Window.orderBy("_q").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tails = tails.select("_q", F.coalesce(F.lag("_tail").over(Window.orderBy("_q")), F.last("_tail").over(whole)).alias("_tail"))
    x = k.withColumn("_back", F.lag(me).over(Window.partitionBy("_p").orderBy(*order)))
    return x.join(tails, F.col("_p") == F.col("_q")).select("doc_id", "kd", "th", "n", F.coalesce("_back", "_tail").alias("back"))


def fingerprint_pairs(docs: DataFrame, k=K, bins=BINS, per_bin=PER_BIN) -> DataFrame:
    """For each document: its fingerprint, that of its edited text, and the likeness of both and of the
    next document's. Edited: the last floor(n / 2) code points replaced by as many of the next text's first.

    A text moves once to meet its neighbours' lengths, and the half that its predecessor needs once more."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # a key without nulls, so that equal keys are dealt alike by every join
    d = d.withColumns({"kd": F.coalesce("doc_id", F.lit(0)).cast("long"), "th": F.xxhash64(F.col("doc_id").isNull(), "text")})
    keys = written(d.groupBy("doc_id", "kd", "th").agg(F.first(F.length("text")).alias("n"), F.count(F.lit(1)).alias("rows")), "omh-keys")
    if keys.filter("rows > 1").limit(1).count():
        d = d.dropDuplicates(["kd", "th"])
    near = neighbours(keys.drop("rows")).join(keys.select("kd", "th", "rows"), ["kd", "th"])
    near = written(near, "omh-neighbours")
    half = lambda n: F.floor(n / 2).cast("int")
    # both sides below are cut from this, and its exchange is made once
    own = with_fingerprint(d.select("kd", "th", "text"), "text", "fingerprint", k, bins, per_bin)
    met = own.join(near, ["kd", "th"])
    there = met.select(F.col("back.kd").alias("kd"), F.col("back.th").alias("th"),
                       F.substring("text", F.lit(1), half(F.col("back.n"))).alias("_lead"),
                       F.col("fingerprint").alias("_next_print"))
    x = met.select("kd", "th", "doc_id", "rows", F.col("n").cast("long").alias("n_chars"), "fingerprint",
                   F.substring("text", F.lit(1), (F.col("n") - half(F.col("n"))).cast("int")).alias("_head"))
    x = x.join(there, ["kd", "th"]).select(
        "doc_id", "rows", "n_chars", "fingerprint", "_next_print", F.concat("_head", "_lead").alias("_edited"))
    x = with_fingerprint(x, "_edited", "edited_fingerprint", k, bins, per_bin)
    # rows that repeat an id and its text have the same figures, and come back as often as they are there
    x = x.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return x.select("doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("_next_print")).alias("near_next"))
