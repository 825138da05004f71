"""TF-IDF (D1-D10).

Counting happens inside the document's row: its n-grams are sorted in place and
the first of equal neighbours counts the document, so documents are never
shuffled.  Only ``(term, df, ttf)`` partial counts are, once, combined in each
task first (a term of every document sends one row per task).

The fitted vocabulary is a small DataFrame ``(term, index, df, idf)``.  Bounded
by ``max_features`` it becomes MLlib stages (count vector, idf product, L2
norm), all JVM expressions over the row, and the long form ``(doc, term, index,
tfidf)`` is the exploded vector.  Without that bound terms are joined instead.

* ``max_features`` is a bounded ``TakeOrderedAndProject`` (ties by term);
* documents without a known term are zero vectors, and no row of the long form.

Formulas: idf = ln((1 + N) / (1 + df)) + 1; tf' = 1 + ln(tf) when sublinear;
rows are L2-normalised per document.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lexis.functions import text as tx
from lexis.operators.rank import bucketed_row_number
from lexis.session import materialize


@dataclass(frozen=True)
class TfidfConfig:
    ngram_range: tuple[int, int] = (1, 1)
    min_df: int | float = 1
    max_df: int | float = 0.7532
    sublinear_tf: bool = False
    max_features: int | None = 20000

    def with_(self, **kw) -> "TfidfConfig":
        return replace(self, **kw)


def _doc_count_threshold(v: int | float, n: int) -> float:
    """int -> absolute document count; float -> proportion of N."""
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else float(v) * n


def document_words(docs: DataFrame, text_col: str) -> DataFrame:
    """Every column but the text, and the text's vectoriser tokens ``_w``."""
    return docs.withColumn("_w", tx.word_tokens(F.col(text_col))).drop(text_col)


def row_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of an array of terms (a column, not an
    expression: it is read twice); null when there is none."""
    n = F.size(terms)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(terms, i - 1) != F.get(terms, i)))
    ends = F.concat(F.slice(starts, 2, n), F.array(n))
    runs = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")),
                       lambda r: F.struct(F.get(terms, r["a"]).alias("term"), (r["b"] - r["a"]).cast("long").alias("tf")))
    return F.when(n > 0, runs)


def term_freq_of(words: DataFrame, id_col: str, cfg: TfidfConfig) -> DataFrame:
    """D2 from ``document_words``: ``(id, term, tf)`` without a shuffle."""
    lo, hi = cfg.ngram_range
    grams = words.select(id_col, F.sort_array(tx.ngrams(F.col("_w"), lo, hi)).alias("_s"))
    return grams.select(id_col, F.explode(row_counts(F.col("_s"))).alias("_e")).select(id_col, "_e.term", "_e.tf")


def term_freq(docs: DataFrame, id_col: str, text_col: str, cfg: TfidfConfig) -> DataFrame:
    """``(id, term, tf)``, one row per distinct n-gram of a document's row."""
    return term_freq_of(document_words(docs.select(id_col, text_col), text_col), id_col, cfg)


def doc_freq(tf: DataFrame) -> DataFrame:
    """``(term, df, ttf)``: documents containing the term and its total count."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))


def prune(dfreq: DataFrame, n_docs: int, cfg: TfidfConfig) -> DataFrame:
    """D3: keep min_df <= df <= max_df (int absolute, float proportion of N)."""
    lo = _doc_count_threshold(cfg.min_df, n_docs)
    hi = _doc_count_threshold(cfg.max_df, n_docs)
    if hi < lo:
        raise ValueError("max_df corresponds to fewer documents than min_df")
    return dfreq.where((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))


def limit_features(kept: DataFrame, max_features: int | None) -> DataFrame:
    """Top ``max_features`` terms by total count, ties by term (bounded top-k)."""
    if max_features is None:
        return kept
    return kept.orderBy(F.desc("ttf"), F.asc("term")).limit(int(max_features))


def term_prefix_bucket(term: str = "term") -> "F.Column":
    """Monotone bucket of a term under string order: its first two code points."""
    c1 = F.ascii(F.col(term)).cast("long")
    c2 = F.when(F.length(term) >= 2, F.ascii(F.substring(term, 2, 1))).otherwise(F.lit(0)).cast("long")
    return c1 * F.lit(1 << 21) + c2


def fit_vocabulary(tf: DataFrame, n_docs: int, cfg: TfidfConfig) -> DataFrame:
    """D3-D5 + D9 index: ``(term, index, df, ttf, idf)``; index = alphabetical rank from 0.

    Raises ValueError when no term survives (D10)."""
    vocab = materialize(limit_features(prune(doc_freq(tf), n_docs, cfg), cfg.max_features), "vocabulary")
    vocab = vocab.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1)) + 1)
    if vocab.isEmpty():
        raise ValueError("empty vocabulary; perhaps the documents only contain stop words")
    indexed = bucketed_row_number(vocab.withColumn("_b", term_prefix_bucket()), [], [F.asc("term")], "_b", "index")
    return indexed.select("term", (F.col("index") - 1).cast("int").alias("index"), "df", "ttf", "idf")


def map_values(vector: Column, fn) -> Column:
    """A vector with ``fn`` applied to its stored values, inside the JVM (the
    vector's parts go through JSON, which keeps doubles exactly)."""
    parts = F.unwrap_udt(vector)
    changed = F.struct(parts.withField("values", F.transform(parts["values"], fn)).alias("v"))
    return F.from_json(F.to_json(changed), StructType([StructField("v", VectorUDT())]))["v"]


class SublinearTf(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """tf -> 1 + ln(tf) on the non-zero entries of a count vector."""

    @keyword_only
    def __init__(self, inputCol="tf", outputCol="tf_sub"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        log = map_values(F.col(self.getInputCol()), lambda c: F.when(c > 0, F.log(c) + 1).otherwise(F.lit(0.0)))
        return df.withColumn(self.getOutputCol(), log)


def vector_stages(terms: list[str], idf: list[float], cfg: TfidfConfig, inputCol: str, outputCol: str) -> PipelineModel:
    """D5-D9 as fitted stages from an array of terms to the weighted vector."""
    stages = [CountVectorizerModel.from_vocabulary(terms, inputCol=inputCol, outputCol="_tf")]
    if cfg.sublinear_tf:
        stages.append(SublinearTf(inputCol="_tf", outputCol="_tfs"))
    stages += [ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=stages[-1].getOutputCol(), outputCol="_tfidf"),
               Normalizer(p=2.0, inputCol="_tfidf", outputCol=outputCol)]
    return PipelineModel(stages)


def vectors(words: DataFrame, vocab: DataFrame, cfg: TfidfConfig, out: str = "features") -> DataFrame:
    """``words`` (from ``document_words``) with a sparse vector in place of
    the tokens; needs a vocabulary bounded by ``max_features``."""
    if cfg.max_features is None:
        raise ValueError("vectors need max_features")
    rows = vocab.orderBy("index").select("term", "idf").collect()  # at most max_features
    lo, hi = cfg.ngram_range
    grams = words.withColumn("_g", tx.ngrams(F.col("_w"), lo, hi))
    made = vector_stages([r[0] for r in rows], [r[1] for r in rows], cfg, "_g", out).transform(grams)
    return made.select(*[c for c in words.columns if c != "_w"], out)


def entries(vector: str = "features") -> Column:
    """The stored entries of a sparse vector, ``array<struct<index, value>>``."""
    parts = F.unwrap_udt(F.col(vector))
    return F.arrays_zip(parts["indices"].alias("index"), parts["values"].alias("value"))


def weights(words: DataFrame, vocab: DataFrame, id_col: str, cfg: TfidfConfig) -> DataFrame:
    """``(id, term, index, tfidf)``; out-of-vocabulary terms dropped, rows L2-normalised."""
    if cfg.max_features is not None:
        rows = vectors(words.select(id_col, "_w"), vocab, cfg, "_v")
        long = rows.select(id_col, F.explode(entries("_v")).alias("_e")).select(id_col, "_e.index", F.col("_e.value").alias("tfidf"))
        names = F.broadcast(vocab.select("index", "term"))  # at most max_features rows
        return long.join(names, "index").select(id_col, "term", "index", "tfidf")
    tfw = F.when(F.lit(cfg.sublinear_tf), F.log("tf") + 1).otherwise(F.col("tf").cast("double"))
    raw = term_freq_of(words, id_col, cfg).join(vocab.select("term", "index", "idf"), "term").withColumn("w", tfw * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", "index", (F.col("w") / norm).alias("tfidf"))


def fit(docs: DataFrame, id_col: str, text_col: str, cfg: TfidfConfig) -> tuple[DataFrame, DataFrame]:
    """``(vocab, words)`` of ``docs``: the cleaned and tokenised documents feed
    the counts and the weights, so they are written once in the shared folder."""
    words = materialize(document_words(docs, text_col), "document-words")
    return fit_vocabulary(term_freq_of(words, id_col, cfg), words.count(), cfg), words


def fit_transform(docs: DataFrame, id_col: str, text_col: str, cfg: TfidfConfig):
    """Fit on ``docs`` and return ``(vocab, weights)``."""
    vocab, words = fit(docs, id_col, text_col, cfg)
    return vocab, weights(words, vocab, id_col, cfg)


def transform(docs: DataFrame, vocab: DataFrame, id_col: str, text_col: str, cfg: TfidfConfig) -> DataFrame:
    """Weights of new documents under a fitted vocabulary."""
    return weights(document_words(docs.select(id_col, text_col), text_col), vocab, id_col, cfg)
