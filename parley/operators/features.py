"""TF-IDF, as tables and as a Spark ML pipeline.

Terms are counted in Arrow batches of tokens: a batch names its words by numbers, sorts the numbers of words and pairs
with those of their documents, and gives one row per term with both figures, which a task combines before they are
shuffled by term. So a common word is no hot key, and pairs are strings only once per batch. With a bounded vocabulary, terms are counted, weighted and scaled inside a document's own row by
Spark's own vectorizer, and no (document, term) row is shuffled. The relational form is checked against SQL.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley import constants as C
from parley.functions import text as T
from parley.operators.blocks import release_memory, small_batches
from parley.sources.workspace import release_shuffles, written


def exploded(df: DataFrame, array, out, *keep) -> DataFrame:
    """One row per array element. The outer form keeps the optimizer from computing the array a
    second time for an inferred "is not empty" filter."""
    return df.select(*keep, F.explode_outer(array).alias(out)).where(F.col(out).isNotNull())


def token_bags(docs: DataFrame, tokens, id_col="conversation_id") -> DataFrame:
    """(id, tokens) of every document, written once."""
    return written(docs.select(id_col, tokens.alias("_tokens")), "token-bags")


PIECE_TOKENS = 500_000  # tokens that are counted at a time, or one document
PIECE_ROWS = 100_000
OUT_ROWS = 100_000  # of a batch of counts that goes back to the JVM
_COUNTED = "term string, df long, total long"


def _runs(keys: np.ndarray, documents: int):
    """(number, documents, occurrences) of each number in `keys`, which are number * documents + document."""
    keys = np.sort(keys)
    number = keys // documents
    first = np.flatnonzero(np.diff(number, prepend=-1))
    fresh = np.diff(keys, prepend=-1) != 0
    return number[first], np.add.reduceat(fresh, first, dtype=np.int64) if len(first) else first, np.diff(first, append=len(keys))


def _counted(tokens: pa.ListArray, pairs: bool):
    """(term, df, total) batches of the tokens of some documents, and of the pairs of neighbours."""
    lengths = tokens.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    named = tokens.flatten().dictionary_encode(null_encoding="encode")
    words, codes = named.dictionary, named.indices.to_numpy().astype(np.int64)
    n, v, doc = max(1, len(lengths)), len(words), np.repeat(np.arange(len(lengths)), lengths)
    number, df, total = _runs(codes * n + doc, n)
    yield words.take(pa.array(number)), df, total
    if pairs and len(codes) > 1:
        near = doc[1:] == doc[:-1]
        number, df, total = _runs((codes[:-1][near] * v + codes[1:][near]) * n + doc[1:][near], n)
        yield pc.binary_join_element_wise(words.take(pa.array(number // v)), words.take(pa.array(number % v)), " "), df, total


def _pieces(tokens: pa.ListArray):
    """The documents in slices of at most PIECE_TOKENS tokens and PIECE_ROWS documents, or of one document."""
    ends = np.cumsum(tokens.value_lengths().fill_null(0).to_numpy().astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = min(max(at + 1, int(np.searchsorted(ends, before + PIECE_TOKENS, side="right"))), at + PIECE_ROWS)
        yield tokens.slice(at, stop - at)
        at = stop


def _gathered(batches):
    """The documents of all batches in such slices, however small the batches are."""
    held, tokens, rows = [], 0, 0
    for batch in batches:
        for piece in _pieces(batch.column(0)):
            n = len(piece.flatten())
            if held and (tokens + n > PIECE_TOKENS or rows + len(piece) > PIECE_ROWS):
                yield pa.concat_arrays(held)
                held, tokens, rows = [], 0, 0
            held.append(piece)
            tokens, rows = tokens + n, rows + len(piece)
    if held:
        yield pa.concat_arrays(held)


def bag_frequencies(bags: DataFrame, tokens, pairs=True) -> DataFrame:
    """(term, df, total): documents that hold a term, and how often it occurs. The terms are the `tokens` of a bag
    and, with `pairs`, every two neighbours among them."""

    def task(batches):
        for piece in _gathered(batches):
            for term, df, total in _counted(piece, pairs):
                counts = pa.record_batch({"term": term.cast(pa.string()), "df": pa.array(df, pa.int64()), "total": pa.array(total, pa.int64())})
                for at in range(0, counts.num_rows, OUT_ROWS):
                    yield counts.slice(at, OUT_ROWS)
        release_memory()

    small_batches(bags.sparkSession)
    counted = bags.select(tokens.alias("_tokens")).mapInArrow(task, _COUNTED)
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def term_frequencies(docs: DataFrame, id_col="conversation_id", text_col="customer_text") -> DataFrame:
    """(term, df, total) of the clustering terms of the texts."""
    return bag_frequencies(docs, T.without_stop_words(T.tokens(text_col)))


def vocabulary(frequencies: DataFrame, doc_count, min_df=C.CLUSTER_MIN_DF, max_df=C.CLUSTER_MAX_DF,
               max_features=C.CLUSTER_MAX_FEATURES) -> DataFrame:
    """Terms inside the frequency bounds, the most used ones up to `max_features`, with their idf."""
    kept = frequencies.where(
        (F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * doc_count)
    )
    if max_features is not None:
        kept = kept.orderBy(F.desc("total"), "term").limit(max_features)
    idf = F.log((1 + doc_count) / (1 + F.col("df"))) + 1
    return kept.withColumn("idf", idf)


def tfidf_weights(docs: DataFrame, terms=None, id_col="conversation_id", text_col="customer_text",
                  min_df=C.CLUSTER_MIN_DF, max_df=C.CLUSTER_MAX_DF,
                  max_features=C.CLUSTER_MAX_FEATURES) -> DataFrame:
    """(id, term, weight) with rows of unit length. Ids must be unique.

    `terms` is a column of arrays; without it, the clustering terms of `text_col`. The vocabulary holds at most
    `max_features` terms, which go to the tasks; without such a bound the rows meet it in a join.
    """
    if terms is None:
        bags = token_bags(docs, T.without_stop_words(T.tokens(text_col)), id_col)
        terms, pairs = T.unigrams_and_bigrams("_tokens"), True
    else:
        bags, terms, pairs = token_bags(docs, terms, id_col), F.col("_tokens"), False
    kept = vocabulary(bag_frequencies(bags, F.col("_tokens"), pairs), bags.count(), min_df, max_df, max_features).select("term", "idf")
    if max_features is None:
        return _weights_by_join(bags, terms, kept, id_col)
    found = sorted(kept.collect())
    if not found:
        return bags.select(id_col, F.lit("").alias("term"), F.lit(0.0).alias("weight")).limit(0)
    stages = [
        CountVectorizerModel.from_vocabulary([r.term for r in found], "_terms", "_tf"),
        ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in found]), inputCol="_tf", outputCol="_weighted"),
        Normalizer(p=2.0, inputCol="_weighted", outputCol="_unit"),
    ]
    unit = F.unwrap_udt(F.col("_unit"))
    rows = PipelineModel(stages).transform(bags.select(id_col, terms.alias("_terms"))).select(
        id_col, F.explode(F.arrays_zip(unit["indices"].alias("position"), unit["values"].alias("weight"))).alias("_w"))
    names = bags.sparkSession.createDataFrame([(i, r.term) for i, r in enumerate(found)], "position int, term string")
    return rows.select(id_col, "_w.position", "_w.weight").join(F.broadcast(names), "position").select(id_col, "term", "weight")


def _weights_by_join(bags: DataFrame, terms, kept: DataFrame, id_col) -> DataFrame:
    counts = exploded(bags, terms, "term", id_col).groupBy(id_col, "term").agg(F.count("*").alias("tf"))
    raw = counts.join(kept, "term").withColumn("_w", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", (F.col("_w") / length).alias("weight"))


def chunk_stats(docs: DataFrame, text_col, limit, special_tokens=2) -> DataFrame:
    """Texts over the model limit, chunks in all, and most chunks of one text."""
    size = limit - special_tokens - C.TOKEN_MARGIN
    counted = docs.select(F.size(T.words(text_col)).alias("n"))
    pieces = F.ceil(F.col("n") / size)
    return counted.agg(
        F.count_if(F.col("n") + special_tokens > limit).alias("over_limit"),
        F.sum(pieces).cast("long").alias("chunks"),
        F.max(pieces).cast("long").alias("most_chunks"),
    )


# ---- Spark ML form ----


class TfidfModel:
    """Fitted stages of `fit_tfidf`: the pipeline model and its vocabulary, read once."""

    def __init__(self, pipeline_model, terms):
        self.pipeline_model, self.terms = pipeline_model, terms

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline_model.transform(df)


def _term_stage(text_col, out, stop_words=None):
    """Tokens, stop words and pairs as SQL stages, so that a saved pipeline carries them along."""
    token_sql = f"regexp_extract_all(lower({text_col}), '([\\\\p{{L}}\\\\p{{N}}_]{{2,}})', 1)"
    if stop_words:
        listed = ", ".join("'" + w.replace("'", "\\'") + "'" for w in stop_words)
        token_sql = f"filter({token_sql}, t -> t NOT IN ({listed}))"
    tokens = SQLTransformer(statement=f"SELECT *, {token_sql} AS _tok FROM __THIS__")
    if out is None:
        return [tokens]
    pairs = (
        "zip_with(slice(_tok, 1, greatest(size(_tok) - 1, 0)), "
        "slice(_tok, 2, greatest(size(_tok) - 1, 0)), (a, b) -> concat(a, ' ', b))"
    )
    return [tokens, SQLTransformer(statement=f"SELECT *, concat(_tok, {pairs}) AS {out} FROM __THIS__")]


def tfidf_stages(train: DataFrame, text_col, out="features", stop_words=None, min_df=1, max_df=1.0,
                 max_features=C.CLASSIFIER_MAX_FEATURES):
    """Fitted stages text -> unit TF-IDF vector, with the +1 that Spark's IDF leaves out.

    The terms are counted once, and vocabulary and idf both come from the counts. The vocabulary, `max_features` terms
    at most, comes to the driver.
    """
    tokens = T.tokens(text_col) if not stop_words else T.without_stop_words(T.tokens(text_col), stop_words)
    found = vocabulary(bag_frequencies(train, tokens), train.count(), min_df, max_df, max_features).orderBy(
        F.desc("total"), "term").select("term", "idf").collect()
    release_shuffles(train.sparkSession)  # the counts of all terms, several times the texts
    if not found:
        raise ValueError("no term is within the frequency bounds")
    terms = [r.term for r in found]
    counted = CountVectorizerModel.from_vocabulary(terms, "_ngrams", "_tf")
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense([r.idf for r in found]),
        inputCol="_tf", outputCol="_weighted",
    )
    unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=out)
    tidy = SQLTransformer(
        statement=f"SELECT * EXCEPT (_tok, _ngrams, _tf, _weighted) FROM __THIS__"
    )
    return [*_term_stage(text_col, "_ngrams", stop_words), counted, scale, unit, tidy], terms


def fit_tfidf(train: DataFrame, text_col="customer_text", out="features", stop_words=None,
              min_df=C.CLUSTER_MIN_DF, max_df=C.CLUSTER_MAX_DF,
              max_features=C.CLUSTER_MAX_FEATURES) -> TfidfModel:
    words = C.stop_words() if stop_words is None else stop_words
    stages, terms = tfidf_stages(train, text_col, out, words, min_df, max_df, max_features)
    return TfidfModel(PipelineModel(stages), terms)


def hashed_bucket_sql(token, buckets) -> str:
    """Number of a token's bucket, from its MD5, so that any engine gives the same."""
    return f"pmod(cast(conv(substring(md5({token}), 1, 8), 16, 10) as bigint), {buckets})"


class LexicalEncoder:
    """Default encoder: hashed TF-IDF of unit length. A lexical stand-in, not a sentence model."""

    name = C.LEXICAL_ENCODER_NAME

    def __init__(self, pipeline_model, dimension):
        self.pipeline_model, self.dimension = pipeline_model, dimension

    @classmethod
    def fit(cls, train: DataFrame, text_col, dimension=384):
        buckets = f"SELECT *, transform(_tok, t -> cast({hashed_bucket_sql('t', dimension)} as string)) AS _buckets FROM __THIS__"
        head = _term_stage("_text", None) + [
            SQLTransformer(statement=buckets),
            CountVectorizerModel.from_vocabulary([str(i) for i in range(dimension)], "_buckets", "_tf"),
        ]
        hashed = PipelineModel(head).transform(train.select(F.col(text_col).alias("_text")))
        idf = IDF(inputCol="_tf", outputCol="_idf").fit(hashed)
        stages = head + [
            ElementwiseProduct(
                scalingVec=Vectors.dense([x + 1.0 for x in idf.idf.toArray()]),
                inputCol="_tf", outputCol="_weighted",
            ),
            Normalizer(p=2.0, inputCol="_weighted", outputCol="_unit"),
        ]
        return cls(PipelineModel(stages), dimension)

    def encode(self, df: DataFrame, text_col, out="embedding") -> DataFrame:
        """Add a float array; a text without any token gets a zero vector."""
        encoded = self.pipeline_model.transform(df.withColumn("_text", F.col(text_col)))
        return encoded.withColumn(out, vector_to_array("_unit", "float32")).drop(
            "_text", "_tok", "_buckets", "_tf", "_weighted", "_unit"
        )
