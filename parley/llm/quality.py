"""Quality rules whose thresholds come from the data: quantile sketches per language and source.

Native: DataFrame functions only. A document is measured inside its own row. Each measure is an integer
and goes to a bucket of relative width 1/32; a sketch is the count per bucket, so sketches are merged by
adding counts and hold at most some 2,000 rows whatever they have seen. A fence stands beyond the tail of the
document's group (language and source), or of its language, or of everything where a group is too small: past
its 0.9 quantile by a multiple of the way from the median to there (0.1 on the low side). So the group decides
how far is far; a fixed distance stands in only where that way is zero, as when nine in ten documents have no
repeated line at all. Up to a tenth of a group may be bad without moving its fences. Verdicts are joined back.

Null or empty text: no words, fails the base rule. A null language or source is a group like any other.
Repeated rows are judged one by one and alike. No rows: no rows.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from parley.llm.common import attach_small, words_of, written

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A group's own quantiles count from so many documents on.
MIN_GROUP = 200
#: Tenths of a group below its low, middle and high quantile.
TENTHS = {"lo": 1, "md": 5, "hi": 9}
#: name: (multiple of the way from the median to the tail, distance where that is zero); low-fenced too if it says so.
RULES = {
    "repeat_share": (12, 200, False),
    "symbol_share": (6, 150, False),
    "dup_line_share": (4, 400, False),
    "word_length": (4, 100, True),
}
_FINE = 64  # values below this have a bucket of their own


def _windows(words: Column) -> Column:
    """A 64-bit hash for each run of three words."""
    at = F.sequence(F.lit(0), F.size(words) - 3)
    return F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(at, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])))


def with_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` (whose names must not be those added) with STATS and n_lines; each row by itself."""
    keep = [c for c in df.columns]
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    a = df.select(*keep, words_of(F.col(text)).alias("_words"), lines.alias("_lines"),
                  F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[#*$%&|<>]")).alias("n_symbols"))
    b = a.select(*keep, "n_symbols", F.size("_words").alias("n_words"),
                 F.length(F.concat_ws("", "_words")).alias("word_chars"),
                 F.size("_lines").alias("n_lines"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
                 _windows(F.col("_words")).alias("_hashes"))
    rest = [*keep, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines"]
    # only a text in which some window repeats is sorted
    pairs = F.sort_array(F.transform("_hashes", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    c = b.select(*rest, F.when(F.size("_hashes") > F.size(F.array_distinct("_hashes")), pairs).alias("_pairs"))
    s = F.col("_pairs")
    twice = F.filter(s, lambda e, i: ((i > 0) & (F.get(s, i - 1)["h"] == e["h"]))
                     | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)))
    d = c.select(*rest, F.sort_array(F.transform(twice, lambda e: e["p"])).alias("_at"))
    at = F.col("_at")
    gaps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
    covered = F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)
    out = d.select(*rest, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))
    return out.select(*keep, *[F.col(c).cast("long").alias(c) for c in (*STATS, "n_lines")])


def _per_mille(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.expr("0") + (F.lit(1000) * part - F.pmod(F.lit(1000) * part, whole)) / whole
                  ).otherwise(0).cast("long")


def measures() -> dict[str, Column]:
    n = F.col("n_words")
    return {
        "repeat_share": _per_mille(F.col("n_repeat_words"), n),
        "symbol_share": _per_mille(F.col("n_symbols"), n),
        "dup_line_share": _per_mille(F.col("n_dup_lines"), F.col("n_lines")),
        "word_length": _per_mille(F.col("word_chars"), F.lit(10) * n),
    }


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def bucket(v: Column) -> Column:
    """Lower end of the bucket of a whole number of 0 or more; buckets are 1/32 of their value wide."""
    bits = F.length(F.bin(v))
    return F.when(v < _FINE, v).otherwise(F.expr("0L") + F.call_function(
        "shiftleft", F.call_function("shiftright", v, bits - 6), bits - 6))


def sketches(stats: DataFrame, groups=("lang", "source")) -> DataFrame:
    """(groups, measure, bucket, n) over the documents that pass the base rule."""
    m = measures()
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket"))
                               for k, v in m.items()])).alias("_m")
    return (stats.filter(~base_failed()).select(*groups, each)
            .groupBy(*groups, "_m.measure", "_m.bucket").agg(F.count(F.lit(1)).alias("n")))


def merge_sketches(sketch: DataFrame, groups) -> DataFrame:
    return sketch.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, groups) -> DataFrame:
    """One row per group: total, and the quantiles of every measure."""
    key = [*groups, "measure"]
    run = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    s = sketch.withColumn("_run", F.sum("n").over(run)).withColumn(
        "_all", F.sum("n").over(Window.partitionBy(*key)))
    found = [F.min(F.when(10 * F.col("_run") >= tenths * F.col("_all"), F.col("bucket"))).alias(c) for c, tenths in TENTHS.items()]
    per = s.groupBy(*key).agg(F.max("_all").alias("total"), *found)
    cols = [F.max(F.when(F.col("measure") == k, F.col(c))).alias(f"{k}_{c}") for k in RULES for c in TENTHS]
    return per.groupBy(*groups).agg(F.max("total").alias("total"), *cols)


def fences(sketch: DataFrame, groups=("lang", "source"), least: int = MIN_GROUP) -> DataFrame:
    """Per group, <measure>_high (and _low): from its own sketch, or that of its first key, or of all."""
    first = list(groups[:1])
    own = quantiles(sketch, groups)
    mid = quantiles(merge_sketches(sketch, first), first)
    top = quantiles(merge_sketches(sketch, []), [])
    names = [f"{k}_{c}" for k in RULES for c in TENTHS]
    mid = mid.select(F.col(first[0]).alias("_first"), F.col("total").alias("_mid"), *[F.col(c).alias(f"_mid_{c}") for c in names])
    top = top.select(F.col("total").alias("_top"), *[F.col(c).alias(f"_top_{c}") for c in names])
    x = own.join(mid, F.col(first[0]).eqNullSafe(F.col("_first")), "left").join(F.broadcast(top), F.lit(True), "left")  # top: one row
    pick = lambda c: F.when(F.col("total") >= least, F.col(c)).when(F.col("_mid") >= least, F.col(f"_mid_{c}")).otherwise(F.col(f"_top_{c}"))
    out = []
    for k, (times, distance, both) in RULES.items():
        lo, md, hi = (pick(f"{k}_{c}") for c in TENTHS)
        room = lambda way: F.when(way > 0, times * way).otherwise(distance)
        out.append((hi + room(hi - md)).alias(f"{k}_high"))
        if both:
            out.append((lo - room(md - lo)).alias(f"{k}_low"))
    return x.select(*groups, *out)


def passes() -> Column:
    """The method's verdict from the measures and the joined fences; no fences (no such group): kept."""
    ok = F.lit(True)
    for k, v in measures().items():
        ok = ok & (v <= F.coalesce(F.col(f"{k}_high"), v))
        if RULES[k][2]:
            ok = ok & (v >= F.coalesce(F.col(f"{k}_low"), v))
    return ok


def judge(docs: DataFrame, groups=("lang", "source")) -> DataFrame:
    """doc_id, STATS, base_failed, kept for each row."""
    stats = written(with_stats(docs.select("doc_id", *groups, "text")).drop("text"), "quality-stats")
    limits = written(fences(written(sketches(stats, groups), "quality-sketch"), groups), "quality-fences")
    x = attach_small(stats, limits, list(groups))
    return x.select("doc_id", *STATS, base_failed().alias("base_failed"), (~base_failed() & passes()).alias("kept"))


def keep_good(docs: DataFrame, groups=("lang", "source")) -> DataFrame:
    """The rows of `docs` that are kept, columns unchanged. Texts are measured twice and never shuffled
    while the fences are few."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    stats = written(with_stats(docs.select(*groups, "text")).drop("text"), "quality-stats")
    limits = written(fences(written(sketches(stats, groups), "quality-sketch"), groups), "quality-fences")
    x = attach_small(with_stats(docs.select(row, F.col("text").alias("_text"), *groups), "_text"), limits, list(groups))
    # a plain filter would be pushed below the figures and compute them again inside its own lambdas
    kept = x.select(F.explode_outer(F.when(~base_failed() & passes(), F.array("_row"))).alias("_row"))
    return kept.filter(F.col("_row").isNotNull()).select("_row.*")
