"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the rest.

Native: DataFrame functions and Spark ML only. The trees learn from the urls that a rule decides. Suffix
statistics are gathered from every url: how often a host suffix occurs, and which share of its labelled
urls is blocked (smoothed, the url's own label left out).

Null url, or one without "://": host and path are empty, no rule fits, every feature is 0. Without
labelled urls of both kinds nothing can be learnt and the verdict is allow, or the one kind there is.
Repeated rows are judged one by one and alike; no rows give no rows.
"""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from parley.llm.common import attach_small, written

#: (verdict, host, path prefix)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: The classifier is fitted on about so many labelled urls, half of either label, chosen by their hash.
FIT_ROWS = 10_000
SMOOTH = 20.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio",
    "entropy", "n_params", "n_hyphens", "has_fragment", "tail_length", "suffix_rows", "suffix_blocked",
    "first_rows", "first_blocked",
)


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _entropy(text: Column) -> Column:
    """Bits per character of ASCII letters, digits and marks, from the count of each."""
    total = F.length(text)
    out = F.lit(0.0)
    for c in _LOWER + "0123456789-_./":
        n = total - F.length(F.replace(text, F.lit(c)))
        share = n / total
        out = out + F.when(n > 0, -share * F.log2(share)).otherwise(0.0)
    return F.when(total > 0, out).otherwise(0.0)


def _lexical(df: DataFrame) -> DataFrame:
    url, host, path = F.coalesce(F.col("_url"), F.lit("")), F.col("host"), F.col("path")
    there = F.length(host) > 0
    rest = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(.*)$", 1)
    cols = {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "depth": F.regexp_count(path, F.lit("/+[^/]")), "host_labels": F.regexp_count(host, F.lit(r"[^.]+")),
        "digit_ratio": _ratio(F.regexp_count(path, F.lit("[0-9]")), F.length(path)),
        "host_digit_ratio": _ratio(F.regexp_count(host, F.lit("[0-9]")), F.length(host)),
        "entropy": _entropy(F.lower(F.concat(host, path))), "n_params": F.regexp_count(rest, F.lit("[?&][^?&#=]+")),
        "n_hyphens": F.regexp_count(host, F.lit("-")), "has_fragment": F.contains(rest, F.lit("#")).cast("int"),
        "tail_length": F.length(F.regexp_extract(path, r"([^/]*)/*$", 1)),
    }
    return df.withColumns({k: F.when(there, v).otherwise(0).cast("double") for k, v in cols.items()})


def _with_share(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Adds <name>_rows (log of the count over all urls) and <name>_blocked, without the row's own label."""
    df = df.withColumn("_key", F.coalesce(key, F.lit("")))
    stats = written(df.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.sum("_label").alias("_bad"),
                                           F.count("_label").alias("_known")), f"url-{name}")
    x = attach_small(df, stats, ["_key"])
    own, labelled = F.coalesce(F.col("_label"), F.lit(0.0)), F.col("_label").isNotNull().cast("int")
    bad, known = F.coalesce(F.col("_bad"), F.lit(0.0)) - own, F.col("_known") - labelled
    there = F.length("host") > 0
    return x.withColumns({
        f"{name}_rows": F.when(there, F.log1p("_n")).otherwise(0.0),
        f"{name}_blocked": F.when(there, (bad + SMOOTH / 2) / (known + SMOOTH)).otherwise(0.0),
    }).drop("_key", "_n", "_bad", "_known")


def features(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, rule_verdict, _label (1.0 block, 0.0 allow, null unknown) and FEATURES."""
    base = pages.select("page_id", F.col("url").alias("_url")).withColumns(
        {"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "rule_verdict": verdict}).withColumn(
        "_label", F.when(F.col("rule_verdict") == "block", 1.0).when(F.col("rule_verdict") == "allow", 0.0))
    x = written(_lexical(base).drop("_url"), "url-lexical")
    x = _with_share(x, F.regexp_extract("host", r"([^.]*\.?[^.]*)$", 1), "suffix")
    return _with_share(x, F.regexp_extract("path", r"^(/[^/]*)", 1), "first")


def judge(pages: DataFrame, rules=RULES, fit_rows: int = FIT_ROWS, trees: int = 20, depth: int = 4) -> DataFrame:
    """page_id, host, path, rule, verdict and score, the trees' chance of block, for each row."""
    x = written(features(pages, rules), "url-features")
    counts = x.agg(F.count("_label").alias("known"), F.sum("_label").alias("bad")).first()
    known, bad = counts["known"], counts["bad"] or 0
    keep = ["page_id", "host", "path", "rule"]

    def constant(kind):
        return x.select(*keep, F.coalesce("rule_verdict", F.lit(kind)).alias("verdict"),
                        F.lit(float(kind == "block")).alias("score"))

    if not 0 < bad < known:
        return constant("block" if bad else "allow")
    # of either label about half of fit_rows rows, those under a hash limit and the least, the same ones each
    # time; a label of fewer rows is there whole, and weights keep the labels' shares
    half = max(1, fit_rows // 2)
    share = {1.0: min(1.0, half / bad), 0.0: min(1.0, half / (known - bad))}
    of_label = lambda f: F.when(F.col("_label") == 1.0, f(share[1.0])).otherwise(f(share[0.0]))
    hashed = x.filter(F.col("_label").isNotNull()).withColumn("_hash", F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(2 ** 32)))
    least = {r["_label"]: r["least"] for r in hashed.groupBy("_label").agg(F.min("_hash").alias("least")).collect()}  # two rows
    chosen = hashed.filter((F.col("_hash") < of_label(lambda s: F.lit(int(s * 2 ** 32))))
                           | (F.col("_hash") == F.when(F.col("_label") == 1.0, least[1.0]).otherwise(least[0.0])))
    into = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    fit = written(chosen.select("page_id", "_label", of_label(lambda s: F.lit(1 / s)).alias("_weight"), *FEATURES), "url-fit")
    ready = into.transform(fit.repartitionByRange(4, "page_id").sortWithinPartitions("page_id", *FEATURES))
    model = GBTClassifier(labelCol="_label", weightCol="_weight", featuresCol="_features", maxIter=trees, maxDepth=depth, seed=7).fit(ready)
    scored = model.transform(into.transform(x)).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*keep, F.coalesce("rule_verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")
                                           ).alias("verdict"), "score")
