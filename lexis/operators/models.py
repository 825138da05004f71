"""Model fitting and scoring (F1-F12) as an MLlib ``Pipeline``.

Stages: ``TextCleaner`` (native cleaning Columns) -> ``TermExtractor``
(n-gram arrays) -> ``TfidfVectorizer`` (Estimator: the vocabulary is fitted by
the relational document-frequency job; the fitted model is JVM stages
``CountVectorizerModel.from_vocabulary`` + ``ElementwiseProduct(idf)`` +
``Normalizer(2)``) -> classifier from the whitelist registry.

The vocabulary handed to the driver is bounded by ``max_features``; a search
without that bound is rejected when the fitted vocabulary exceeds
``MAX_DRIVER_VOCAB`` terms.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.functions import text as tx
from lexis.operators import clean as cl
from lexis.operators import split as sp
from lexis.operators import tfidf as tfm
from lexis.operators.boosting import BoostedTrees, BoostParams, entries_of
from lexis.operators.tfidf import TfidfConfig
from lexis.session import materialize

MAX_DRIVER_VOCAB = 1_000_000
ENTRIES_PER_PART = 1_000_000  # of the vectors that every iteration of a linear fit reads
RFF_CELLS = 1 << 21  # of the random matrix held at a time
RFF_BLOCK = 512  # rows of it made at a time


# --------------------------------------------------------------------------- cleaning / terms
class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """F7 cleaning stage: one of the native variants as Column expressions."""

    variant = Param(Params._dummy(), "variant", "cleaning variant", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol="text", outputCol="clean", variant="base"):
        super().__init__()
        self._setDefault(variant="base")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.getOrDefault(self.variant)
        if v not in cl.VARIANTS:
            raise ValueError(f"Unknown variant: {v!r} (pipeline variants: {sorted(cl.VARIANTS)})")
        return df.withColumn(self.getOutputCol(), cl.VARIANTS[v](F.col(self.getInputCol())))


class TermExtractor(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Vectoriser tokens (>= 2 word characters) and their n-grams as an array column."""

    ngramLo = Param(Params._dummy(), "ngramLo", "smallest n", typeConverter=TypeConverters.toInt)
    ngramHi = Param(Params._dummy(), "ngramHi", "largest n", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="clean", outputCol="terms", ngramLo=1, ngramHi=1):
        super().__init__()
        self._setDefault(ngramLo=1, ngramHi=1)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        lo, hi = self.getOrDefault(self.ngramLo), self.getOrDefault(self.ngramHi)
        toks = df.withColumn("_w", tx.word_tokens(F.col(self.getInputCol())))
        return toks.withColumn(self.getOutputCol(), tx.ngrams(F.col("_w"), lo, hi)).drop("_w")


class TfidfVectorizer(Estimator, HasInputCol, HasOutputCol):
    """D1-D9 as an Estimator over an array-of-terms column."""

    def __init__(self, inputCol="terms", outputCol="features", config: TfidfConfig = TfidfConfig()):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.config = config

    def _fit(self, df: DataFrame) -> PipelineModel:
        return self.from_counts(term_counts(df, self.getInputCol()), df.count())

    def from_counts(self, counts: DataFrame, n_docs: int) -> PipelineModel:
        """The fitted stages from ``counts(term, df, ttf)`` of ``n_docs`` documents."""
        cfg, terms = self.config, self.getInputCol()
        vocab = tfm.limit_features(tfm.prune(counts, n_docs, cfg), cfg.max_features)
        vocab = vocab.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1)) + 1)
        if cfg.max_features is None and vocab.limit(MAX_DRIVER_VOCAB + 1).count() > MAX_DRIVER_VOCAB:
            raise ValueError("vocabulary too large for a driver-side vector model; set max_features")
        rows = vocab.orderBy("term").select("term", "idf").collect()  # bounded by max_features
        if not rows:
            raise ValueError("empty vocabulary; perhaps the documents only contain stop words")
        words, idf = [r[0] for r in rows], [r[1] for r in rows]
        return tfm.vector_stages(words, idf, cfg, terms, self.getOutputCol())


def term_counts(df: DataFrame, terms: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``(term, *by, df, ttf)`` in one aggregate: a row's terms are sorted in place,
    so the first of equal neighbours counts the document and all count occurrences."""
    rows = df.select(*by, F.sort_array(terms).alias("_s"))
    s = F.col("_s")
    marked = F.transform(s, lambda x, i: F.struct(x.alias("term"), ((i == 0) | (F.get(s, i - 1) != x)).cast("long").alias("first")))
    return (rows.select(*by, F.explode(marked).alias("_e")).groupBy(F.col("_e.term").alias("term"), *by)
            .agg(F.sum("_e.first").alias("df"), F.count(F.lit(1)).alias("ttf")))


# --------------------------------------------------------------------------- random Fourier features
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@np.errstate(over="ignore")
def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a counter -> 64 pseudo-random bits (wrapping uint64 arithmetic)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(ctr: np.ndarray) -> np.ndarray:
    return (_mix(ctr) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


@np.errstate(over="ignore")
def _gauss(seed: int, rows: np.ndarray, dim: int, columns: slice = slice(None)) -> np.ndarray:
    """Deterministic N(0,1) matrix W[rows, :dim] or some of its columns (counter hash + Box-Muller):
    any executor regenerates exactly the rows it needs, nothing is broadcast."""
    ctr = (rows.astype(np.uint64)[:, None] * np.uint64(dim) + np.arange(dim, dtype=np.uint64)[None, columns]) * np.uint64(2)
    ctr = ctr + np.uint64(seed) * _GOLDEN
    u1, u2 = _uniform(ctr), _uniform(ctr + np.uint64(1))
    return np.sqrt(-2.0 * np.log(np.maximum(u1, 1e-300))) * np.cos(2.0 * np.pi * u2)


@np.errstate(over="ignore")
def rff_rows(ends: np.ndarray, index: np.ndarray, value: np.ndarray, gamma: float, dim: int, seed: int) -> np.ndarray:
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi) (Rahimi & Recht 2007) of
    rows whose entries end at ``ends[1:]``: the rows of W are made once for all, ``RFF_CELLS`` at a time."""
    found, at = np.unique(index, return_inverse=True)
    out = np.zeros((len(ends) - 1, dim))
    step = max(1, RFF_CELLS // max(1, len(found)))
    for c in range(0, dim, step):
        w = np.concatenate([_gauss(seed, found[r:r + RFF_BLOCK].astype(np.int64), dim, slice(c, c + step))
                            for r in range(0, len(found), RFF_BLOCK)] or [np.empty((0, min(step, dim - c)))])
        for i, (a, z) in enumerate(zip(ends, ends[1:])):
            out[i, c:c + step] = value[a:z] @ w[at[a:z]]
    b = 2.0 * np.pi * _uniform(np.arange(dim, dtype=np.uint64) + np.uint64(seed + 7919) * _GOLDEN)
    out *= math.sqrt(2.0 * gamma)
    out += b
    np.cos(out, out)
    out *= math.sqrt(2.0 / dim)
    return out


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """F4 feature map approximating the RBF kernel exp(-gamma |x - y|^2)."""

    gamma = Param(Params._dummy(), "gamma", "RBF gamma", typeConverter=TypeConverters.toFloat)
    dim = Param(Params._dummy(), "dim", "number of random features", typeConverter=TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="rff", gamma=1.0, dim=256, seed=42):
        super().__init__()
        self._setDefault(gamma=1.0, dim=256, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        g, d, s = (self.getOrDefault(p) for p in (self.gamma, self.dim, self.seed))

        @F.arrow_udf("array<double>")
        def fmap(index: pa.Array, value: pa.Array) -> pa.Array:
            ends, shift = index.offsets.to_numpy(), value.offsets.to_numpy()[0]
            rows = rff_rows(ends - ends[0], index.flatten().to_numpy(zero_copy_only=False), value.values.to_numpy(zero_copy_only=False)[shift:],
                            g, d, s)
            return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * d, rows.reshape(-1))

        index, values = entries_of(self.getInputCol())
        made = fmap(F.coalesce(index, F.array().cast("array<int>")), F.coalesce(values, F.array().cast("array<double>")))
        return df.withColumn(self.getOutputCol(), array_to_vector(made))


class MarginPlatt(Estimator):
    """Platt scaling: logistic regression of the label on the SVM margin.
    The class label stays the sign of the margin.

    Given the unfitted ``svm``, the margins are out of fold: the rows are dealt to
    ``folds`` stratified folds by a hash of their features (equal rows share one), and each row's margin
    comes from an SVM fitted without its fold, so the probabilities are not as sure
    as training margins would make them.  A class with fewer rows than folds lowers
    the number of folds; below two the fitted SVM's own margins are taken."""

    def __init__(self, rawCol="svm_raw", labelCol="label", weightCol=None, svm=None, folds=5, seed=42):
        super().__init__()
        self.rawCol, self.labelCol, self.weightCol = rawCol, labelCol, weightCol
        self.svm, self.folds, self.seed = svm, folds, seed

    @staticmethod
    def _margin(df: DataFrame, raw: str) -> DataFrame:
        return df.withColumn("_mvec", array_to_vector(F.array(vector_to_array(F.col(raw))[1])))

    def out_of_fold(self, df: DataFrame) -> DataFrame:
        """Rows with ``rawCol`` replaced by the margin of an SVM that has not seen them."""
        features = self.svm.getFeaturesCol()
        keep = [c for c in (features, self.labelCol, self.weightCol) if c]
        rows = df.select(*keep, F.xxhash64(vector_to_array(F.col(features))).alias("_row"))
        rows = materialize(rows.withColumn(self.labelCol, F.col(self.labelCol).cast("int")), "calibration")
        counts = sp.class_counts(rows.select("_row", self.labelCol).distinct(), self.labelCol)
        folds = min([self.folds, *[c for _, c in counts]])
        if len(counts) < 2 or folds < 2:
            return df
        dealt = materialize(sp.stratified_kfold(rows, "_row", self.labelCol, folds, f"{self.seed}:platt", "_fold"), "calibration")
        dealt = dealt.coalesce(df.rdd.getNumPartitions())  # an iteration is a job: as few tasks as the SVM's own fit
        # the penalty is per row: fewer rows keep the same C
        svm = self.svm.copy().setRegParam(self.svm.getRegParam() * folds / (folds - 1))

        def held_out(k: int) -> DataFrame:
            return svm.fit(dealt.where(F.col("_fold") != k)).transform(dealt.where(F.col("_fold") == k))

        with ThreadPoolExecutor(folds) as pool:  # concurrent Spark jobs, one per fold
            return reduce(DataFrame.unionByName, pool.map(held_out, range(folds)))

    def _fit(self, df: DataFrame) -> "MarginPlattModel":
        lr = LogisticRegression(featuresCol="_mvec", labelCol=self.labelCol, predictionCol="_platt_pred",
                                rawPredictionCol="_platt_raw", probabilityCol="probability", regParam=0.0)
        if self.weightCol:
            lr.setWeightCol(self.weightCol)
        margins = self.out_of_fold(df) if self.svm is not None else df
        keep = [c for c in (self.rawCol, self.labelCol, self.weightCol) if c]
        margins = materialize(self._margin(margins.select(*keep), self.rawCol), "margins")
        return MarginPlattModel(lr.fit(margins), self.rawCol)


class MarginPlattModel(Model, MLWritable, MLReadable):
    def __init__(self, lr_model=None, rawCol="svm_raw"):
        super().__init__()
        self.lr_model, self.rawCol = lr_model, rawCol

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.lr_model.transform(MarginPlatt._margin(df, self.rawCol))
        return out.drop("_mvec", "_platt_pred", "_platt_raw")

    def write(self) -> "MarginPlattWriter":
        return MarginPlattWriter(self)

    @classmethod
    def read(cls) -> "MarginPlattReader":
        return MarginPlattReader(cls)


class MarginPlattWriter(MLWriter):
    """Saves the name of the margin column and the inner logistic model."""

    def __init__(self, instance: MarginPlattModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"rawCol": self.instance.rawCol})
        self.instance.lr_model.write().save(f"{path}/platt")


class MarginPlattReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> MarginPlattModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = self.cls(LogisticRegressionModel.load(f"{path}/platt"), meta["rawCol"])
        found._resetUid(meta["uid"])
        return found


# --------------------------------------------------------------------------- estimator registry (F1)
NON_CONSTRUCTOR = {"class", "eval_metric"}
ESTIMATORS = ("gbt", "logreg", "linear_svc", "rff_svc")
# Fixed values that must match: the default boosted model.
DEFAULT_GBT = {"n_estimators": 500, "max_depth": 6, "learning_rate": 0.05, "random_state": 42,
               "scale_pos_weight": 0.93}


def boost_params(params: dict) -> BoostParams:
    """checked parameters of the boosted trees; unknown names are an error."""
    p = {k: v for k, v in params.items() if k not in NON_CONSTRUCTOR and v is not None}
    unknown = set(p) - set(BoostParams.__dataclass_fields__)
    if unknown:
        raise ValueError(f"unknown parameters of the boosted trees: {sorted(unknown)}")
    whole = {"n_estimators", "max_depth", "max_bin", "random_state", "early_stopping_rounds"}
    return BoostParams(**{k: int(v) if k in whole else float(v) for k, v in p.items()})


def build_classifier(name: str, params: dict | None, n_train: float, weighted: bool) -> list:
    """estimator stages reading ``features`` and ``label`` (and ``weight``)."""
    p = {k: v for k, v in (params or {}).items() if k not in NON_CONSTRUCTOR}
    if p.get("early_stopping_rounds") is not None:
        raise ValueError("early_stopping_rounds needs a validation part: use jobs.train_job or gbt_early_stopping")
    if name == "gbt":
        return [BoostedTrees(boost_params(p), weightCol="weight" if weighted else None)]
    seed = int(p.pop("random_state", 42))
    w = {"weightCol": "weight"} if weighted else {}
    c = float(p.get("C", 1.0))
    reg = 1.0 / (c * max(n_train, 1.0))
    if name == "logreg":
        return [LogisticRegression(featuresCol="features", labelCol="label", regParam=reg, elasticNetParam=0.0,
                                   standardization=False, maxIter=int(p.get("max_iter", 100)), tol=1e-9, **w)]
    if name == "linear_svc":
        return [LinearSVC(featuresCol="features", labelCol="label", regParam=reg, standardization=False,
                          maxIter=int(p.get("max_iter", 200)), **w)]
    if name == "rff_svc":
        gamma = float(p.get("gamma", 1.0))
        svm = LinearSVC(featuresCol="rff", labelCol="label", regParam=reg, standardization=False,
                        rawPredictionCol="svm_raw", predictionCol="prediction", maxIter=int(p.get("max_iter", 200)), **w)
        return [RandomFourierFeatures(inputCol="features", outputCol="rff", gamma=gamma,
                                      dim=int(p.get("n_components", 256)), seed=seed), svm,
                MarginPlatt(rawCol="svm_raw", labelCol="label", weightCol="weight" if weighted else None,
                            svm=svm.copy(), folds=int(p.get("calibration_folds", 5)), seed=seed)]
    raise ValueError(f"Unknown model: {name!r}; choose from {ESTIMATORS}")


def prepare_terms(df: DataFrame, cfg: TfidfConfig = TfidfConfig(), variant: str = "base",
                  text_col: str = "text") -> DataFrame:
    """Cleaning + term extraction (row-local, no fitted state): done once and
    shared by every fold / trial that uses the same variant and n-gram range."""
    lo, hi = cfg.ngram_range
    cleaned = TextCleaner(inputCol=text_col, outputCol="clean", variant=variant).transform(df)
    return TermExtractor(inputCol="clean", outputCol="terms", ngramLo=lo, ngramHi=hi).transform(cleaned).drop("clean")


def fit_on_terms(prepared: DataFrame, model: str = "gbt", model_params: dict | None = None,
                 cfg: TfidfConfig = TfidfConfig()) -> PipelineModel:
    """Fit vectoriser + classifier on rows that already carry ``terms``."""
    vectors = TfidfVectorizer(inputCol="terms", outputCol="features", config=cfg).fit(prepared)
    return PipelineModel([vectors, *fit_on_vectors(vectors.transform(prepared), model, model_params).stages])


def fit_on_vectors(featured: DataFrame, model: str = "gbt", model_params: dict | None = None) -> PipelineModel:
    """Fit the classifier on rows that already carry ``features``.  An iteration of a
    linear fit is a Spark job over all vectors: it gets a task per ``ENTRIES_PER_PART``
    stored values, so that small training parts do not spend their time on starting tasks."""
    params = dict(model_params or {})
    spw = params.pop("scale_pos_weight", None)
    data = with_class_weight(featured, spw) if spw is not None else featured
    n, entries = data.agg(F.sum("weight") if spw is not None else F.count(F.lit(1)), F.sum(F.size(F.unwrap_udt("features")["values"]))).first()
    if model == "rff_svc":  # dense vectors
        entries = (entries or 0) + (n or 0) * int(params.get("n_components", 256))
    if model in ("logreg", "linear_svc", "rff_svc"):
        data = data.coalesce(max(1, -(-int(entries or 0) // ENTRIES_PER_PART)))
    return Pipeline(stages=build_classifier(model, params, float(n or 0.0), spw is not None)).fit(data)


def build_pipeline(model: str = "gbt", model_params: dict | None = None, cfg: TfidfConfig = TfidfConfig(),
                   variant: str = "base", text_col: str = "text", n_train: float = 1.0,
                   weighted: bool = False) -> Pipeline:
    """cleaner -> terms -> tf-idf -> classifier."""
    lo, hi = cfg.ngram_range
    return Pipeline(stages=[
        TextCleaner(inputCol=text_col, outputCol="clean", variant=variant),
        TermExtractor(inputCol="clean", outputCol="terms", ngramLo=lo, ngramHi=hi),
        TfidfVectorizer(inputCol="terms", outputCol="features", config=cfg),
        *build_classifier(model, model_params, n_train, weighted),
    ])


def with_class_weight(df: DataFrame, spw: float, label: str = "label") -> DataFrame:
    """positives weighted ``scale_pos_weight``, negatives 1."""
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))


def fit(train: DataFrame, model: str = "gbt", model_params: dict | None = None, cfg: TfidfConfig = TfidfConfig(),
        variant: str = "base", text_col: str = "text") -> PipelineModel:
    """Fit the F7 pipeline and return it whole (cleaner -> terms -> tf-idf ->
    classifier).  The row-local cleaning and term extraction run once: their
    output is written to the shared folder and both the vectoriser fit and the
    classifier's iterations read it.  ``scale_pos_weight`` becomes a weight
    column; logistic/SVM regularisation uses n = sum of weights."""
    lo, hi = cfg.ngram_range
    cleaner = TextCleaner(inputCol=text_col, outputCol="clean", variant=variant)
    terms = TermExtractor(inputCol="clean", outputCol="terms", ngramLo=lo, ngramHi=hi)
    keep = [c for c in train.columns if c != text_col]
    prepared = materialize(terms.transform(cleaner.transform(train)).select(*keep, "terms"), "fit-terms")
    fitted = fit_on_terms(prepared, model, model_params, cfg)
    return PipelineModel([cleaner, terms, *fitted.stages])


def predict(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """F8: class and P(class = 1) in one transform.  Metrics need the raw score;
    only exported predictions are rounded (``rounded``)."""
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability"))


def rounded(predictions: DataFrame, dp: int = 4) -> DataFrame:
    """The exported form of predictions."""
    return predictions.withColumn("probability", F.round("probability", dp))


def gbt_early_stopping(train: DataFrame, val: DataFrame, params: dict, cfg: TfidfConfig, rounds: int,
                       variant: str = "base", text_col: str = "text") -> tuple[PipelineModel, int, float]:
    """grow at most ``n_estimators`` trees on the training part, following the
    AUC of the validation rows, which run along in the same fit; growth stops when
    ``rounds`` trees in a row bring no better one, and the trees up to the best are
    kept.  Cleaning, terms and vectors are computed once (vocabulary and idf from
    the training part alone).  Returns (model, trees, best AUC)."""
    lo, hi = cfg.ngram_range
    cleaner = TextCleaner(inputCol=text_col, outputCol="clean", variant=variant)
    terms = TermExtractor(inputCol="clean", outputCol="terms", ngramLo=lo, ngramHi=hi)
    both = train.select("label", text_col, F.lit(False).alias("held")).unionByName(val.select("label", text_col, F.lit(True).alias("held")))
    prepared = materialize(PipelineModel([cleaner, terms]).transform(both).select("label", "held", "terms"), "stop-terms")
    spw = params.get("scale_pos_weight")
    data = with_class_weight(prepared, spw) if spw is not None else prepared
    vectors = TfidfVectorizer(inputCol="terms", outputCol="features", config=cfg).fit(data.where("not held"))
    rest = {k: v for k, v in params.items() if k != "scale_pos_weight"} | {"early_stopping_rounds": rounds}
    gbt = BoostedTrees(boost_params(rest), weightCol="weight" if spw is not None else None, heldCol="held")
    fitted = gbt.fit(vectors.transform(data))
    return PipelineModel([cleaner, terms, vectors, fitted]), fitted.getNumTrees, float(max(fitted.aucs))
