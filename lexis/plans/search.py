"""Registered search, trial-table and leaderboard queries (section I)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from lexis.functions import text as tx
from lexis.operators import clean as cl
from lexis.operators import evaluate as ev
from lexis.operators import search as se
from lexis.operators import search_jobs as sj
from lexis.operators.tfidf import TfidfConfig
from lexis.plans import sql as S
from lexis.plans.cleaning import _drop_words_sql
from lexis.plans.evaluation import _auc_cte
from lexis.plans.models import LR_PARAMS, docs, holdout
from lexis.plans.registry import register
from lexis.plans.splits import _SPLIT, _holdout
from lexis.functions import stopwords as sw
from lexis.session import materialize, shared_path
from lexis.sources.corpus import labelled
from lexis.sources.trials import trial_rows

VARIANT_ORDER = ["base", "stopwords_general", "stopwords_curated", "stemming"]

# --------------------------------------------------------------------------- stand-in trial table (SQL side)
TRIALS_CTE = """trials AS (
  SELECT 'tfidf_' || d.lang AS study, d.doc_id AS trial_id,
    CASE WHEN l.doc_id IS NULL THEN 'failed' ELSE 'complete' END AS state,
    CASE WHEN l.doc_id IS NULL THEN 0.0::DOUBLE ELSE round((d.n_chars % 997) / 997.0, 6) END AS value,
    CAST(d.n_chars % 5 + 1 AS DOUBLE) AS min_df, round(0.7 + (d.n_chars % 30) / 100.0, 2) AS max_df
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def _u_sql(name: str) -> str:
    key = f"'42:' || study || ':' || CAST(trial_id AS VARCHAR) || ':{name}'"
    return f"(CAST(CAST(('0x' || substr(md5({key}), 1, 13)) AS BIGINT) AS DOUBLE) / CAST({int(se.HEX13)} AS DOUBLE))"


def _suggest_sql(name: str, spec) -> str:
    u = _u_sql(name)
    if spec[0] == "cat":
        vals = ", ".join(("true" if c else "false") if isinstance(c, bool) else str(c) for c in spec[1])
        return f"([{vals}])[CAST(floor({u} * {len(spec[1])}) AS BIGINT) + 1]"
    lo, hi = spec[1], spec[2]
    if spec[0] == "int":
        return f"CAST({lo} + floor({u} * {hi - lo + 1}) AS INTEGER)"
    if spec[0] == "logf":
        return f"round(exp(CAST({math.log(lo)!r} AS DOUBLE) + {u} * CAST({math.log(hi) - math.log(lo)!r} AS DOUBLE)), 8)"
    return f"round(CAST({float(lo)!r} AS DOUBLE) + {u} * CAST({hi - lo!r} AS DOUBLE), 6)"


_PLAN_SQL = "SELECT study, trial_id, " + ", ".join(
    f"{_suggest_sql(n, s)} AS {n}" for n, s in se.VECTORIZER_SPACE.items()) + " FROM plan"


def _studies(spark, sf):
    return trial_rows(spark, sf).groupBy("study").agg(F.count(F.lit(1)).alias("n"))


@register("trial_plan", f"""WITH {TRIALS_CTE},
plan AS (SELECT study, unnest(range(0, n)) AS trial_id FROM (SELECT study, count(*) AS n FROM trials GROUP BY study))
{_PLAN_SQL}""")
def trial_plan(spark, sf):
    """The seeded stage-1 vectorizer plan for as many trials as each study holds."""
    return se.trial_plan(_studies(spark, sf), F.col("n"), se.VECTORIZER_SPACE)


@register("trials_remaining", f"""WITH {TRIALS_CTE},
plan AS (SELECT study, unnest(range(0, n)) AS trial_id FROM (SELECT study, count(*) AS n FROM trials GROUP BY study))
SELECT p.study, p.trial_id FROM plan p
WHERE NOT EXISTS (SELECT 1 FROM trials t WHERE t.study = p.study AND t.trial_id = p.trial_id)""")
def trials_remaining(spark, sf):
    """I8: of as many planned trials as each study holds, those it has not recorded."""
    return se.remaining(se.trial_plan(_studies(spark, sf), F.col("n"), {}), trial_rows(spark, sf))


@register("best_trial", f"""WITH {TRIALS_CTE}
SELECT study, count(*) AS n_trials, CAST(count_if(state = 'complete') AS BIGINT) AS n_completed,
  first(trial_id ORDER BY value DESC, trial_id) FILTER (WHERE state = 'complete') AS best_trial_id,
  max(value) FILTER (WHERE state = 'complete') AS best_value
FROM trials GROUP BY study""")
def best_trial(spark, sf):
    """Best trial per study."""
    return se.best_trial(trial_rows(spark, sf))


@register("running_best", f"""WITH {TRIALS_CTE}
SELECT study, trial_id, value, max(value) OVER (PARTITION BY study ORDER BY trial_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_best FROM trials""")
def running_best(spark, sf):
    """Running best value per study in trial order."""
    return se.running_best(trial_rows(spark, sf))


FIXED_VECTORIZER = {"ngram_idx": 0.0, "min_df": 1.0, "max_df": 0.7532, "sublinear_tf": 0.0, "max_features": 20000.0}


@register("config_overlay", f"""WITH {TRIALS_CTE},
best AS (SELECT study, first(min_df ORDER BY value DESC, trial_id) AS min_df,
                first(max_df ORDER BY value DESC, trial_id) AS max_df
         FROM trials WHERE state = 'complete' GROUP BY study)
SELECT study, 'min_df' AS key, min_df AS value FROM best
UNION ALL SELECT study, 'max_df', max_df FROM best
UNION ALL SELECT study, k, v FROM best, (VALUES {", ".join(f"('{k}', {v!r}::DOUBLE)" for k, v in FIXED_VECTORIZER.items()
                                                       if k not in ("min_df", "max_df"))}) f(k, v)""")
def config_overlay(spark, sf):
    """Each study's best parameters laid over the fixed vectorizer block, as (study, key, value)."""
    best = se.best_params(trial_rows(spark, sf))
    fixed = F.create_map(*[x for k, v in FIXED_VECTORIZER.items() for x in (F.lit(k), F.lit(v))])
    return best.select("study", F.explode(se.overlay(fixed, F.col("params"))).alias("key", "value"))


# --------------------------------------------------------------------------- consolidated results stand-in
def variant_scores(spark, sf):
    """Per variant, the length score of the cleaned text on each holdout part."""
    base = labelled(spark, sf).select("text_id", "label", "title_text").join(
        _holdout(spark, sf).select("text_id", "split"), "text_id")
    cleaned = cl.with_variants(base, "title_text", VARIANT_ORDER)
    scores = {v: F.least(F.lit(1.0), tx.token_count(f"clean_{v}") / 500.0) for v in VARIANT_ORDER}
    scores["chars_optimization"] = F.least(F.lit(1.0), tx.char_length("title_text") / 5000.0)
    wide = cleaned.select("split", "label", *[c.alias(v) for v, c in scores.items()])  # one pass over the texts
    entries = F.explode(F.array(*[F.struct(F.lit(v).alias("entry"), F.col(v).alias("probability")) for v in scores]))
    return wide.select(entries.alias("e"), "split", "label").select("e.entry", "split", "label", "e.probability")


def variant_results(spark, sf):
    """Consolidated results ``(entry, test_auc, cv_auc)``: AUC on the test and training parts.
    The scores and the row per entry are written once: the AUC and the reports read them several times."""
    scores = materialize(variant_scores(spark, sf), "variant-scores")
    auc = ev.roc_auc(scores, groups=["entry", "split"])
    return materialize(auc.groupBy("entry").agg(
        F.round(F.max(F.when(F.col("split") == "test", F.col("auc"))), 6).alias("test_auc"),
        F.round(F.max(F.when(F.col("split") == "train", F.col("auc"))), 6).alias("cv_auc")), "variant-results")


def _tok_sql(e: str) -> str:
    return f"least(1.0, len(list_filter(string_split({e}, ' '), lambda t: t <> '')) / 500.0)"


RESULTS_CTES = _SPLIT + f""",
vbase AS (SELECT l.text_id, l.label, l.title_text, h.split FROM labelled l JOIN holdout h ON l.text_id = h.text_id),
vscores AS (
  SELECT 'base' AS entry, split, label, {_tok_sql(S.clean_text('title_text'))} AS probability FROM vbase
  UNION ALL SELECT 'stopwords_general', split, label,
    {_tok_sql(_drop_words_sql(S.clean_text('title_text'), sw.general_without_negations()))} FROM vbase
  UNION ALL SELECT 'stopwords_curated', split, label,
    {_tok_sql(_drop_words_sql(S.clean_text('title_text'), sw.curated()))} FROM vbase
  UNION ALL SELECT 'stemming', split, label, {_tok_sql(S.clean_text('title_text'))} FROM vbase  -- stemming keeps the token count
  UNION ALL SELECT 'chars_optimization', split, label, least(1.0, length(title_text) / 5000.0) FROM vbase),
""" + _auc_cte("vscores", "vauc", "entry, split") + """,
results AS (SELECT entry, round(max(CASE WHEN split = 'test' THEN auc END), 6) AS test_auc,
                   round(max(CASE WHEN split = 'train' THEN auc END), 6) AS cv_auc FROM vauc GROUP BY entry)"""


@register("winner_variant", S.with_corpus("""
SELECT entry AS winner, 'cv_auc' AS by, cv_auc AS value FROM results WHERE NOT ends_with(entry, '_optimization')
ORDER BY cv_auc DESC, entry DESC LIMIT 1""", RESULTS_CTES))
def winner_variant(spark, sf):
    """Winning cleaning variant by CV AUC, model entries ignored."""
    return se.winner_variant(variant_results(spark, sf), "cv_auc")


@register("variant_leaderboard", S.with_corpus(f"""
SELECT r.entry, o.display_order, r.test_auc, r.cv_auc, rank() OVER (ORDER BY r.test_auc DESC) AS rank,
       rank() OVER (ORDER BY r.test_auc DESC) = 1 AS is_winner,
       round(max(r.test_auc) OVER () - min(r.test_auc) OVER (), 6) AS auc_range
FROM results r JOIN (VALUES {", ".join(f"('{v}', {i})" for i, v in enumerate(VARIANT_ORDER))}) o(entry, display_order)
  ON r.entry = o.entry""", RESULTS_CTES))
def variant_leaderboard(spark, sf):
    """Variants in display order, rank, winner, AUC range."""
    return se.variant_leaderboard(variant_results(spark, sf), VARIANT_ORDER)


@register("model_leaderboard", S.with_corpus("""
SELECT regexp_replace(entry, '_optimization$', '') AS model, 'model' AS kind, test_auc, cv_auc,
       rank() OVER (ORDER BY test_auc DESC) AS rank
FROM results WHERE ends_with(entry, '_optimization')""", RESULTS_CTES))
def model_leaderboard(spark, sf):
    """Model entries by test AUC (stage-1 winner when none)."""
    return se.model_leaderboard(variant_results(spark, sf))


@register("stage_delta", S.with_corpus("""
SELECT b.metric, b.value AS before, a.value AS after, round(a.value - b.value, 6) AS delta
FROM (SELECT 'test_auc' AS metric, test_auc AS value FROM results WHERE entry = 'base'
      UNION ALL SELECT 'cv_auc', cv_auc FROM results WHERE entry = 'base') b
FULL OUTER JOIN (SELECT 'test_auc' AS metric, test_auc AS value FROM results WHERE entry = 'stopwords_curated'
      UNION ALL SELECT 'cv_auc', cv_auc FROM results WHERE entry = 'stopwords_curated') a ON a.metric = b.metric""",
    RESULTS_CTES))
def stage_delta(spark, sf):
    """I16: metric deltas from the base variant to the curated-stopword variant."""
    r = variant_results(spark, sf)

    def metrics(entry):
        one = r.where(F.col("entry") == entry)
        return one.select(F.expr("stack(2, 'test_auc', test_auc, 'cv_auc', cv_auc) AS (metric, value)"))
    return se.stage_delta(metrics("base"), metrics("stopwords_curated"))


# --------------------------------------------------------------------------- real searches
# ``search_svm`` and ``stage2_job`` run the whole search (30 trials, 5 folds, the
# defaults of ``search_jobs``; the latter over all variants); the other registered
# searches run one trial per study with three folds.
QUERY_TRIALS, QUERY_FOLDS = 1, 3


def _seeded_sql(space: dict, studies: list[str], n_trials: int = QUERY_TRIALS) -> str:
    """The trials that a search must record: seeded parameters, in range values."""
    trial = "CAST(0 AS BIGINT)" if n_trials == 1 else f"unnest(range(0, {n_trials}))"
    plan = f"plan AS (SELECT study, {trial} AS trial_id FROM (VALUES " + ", ".join(f"('{x}')" for x in studies) + ") v(study))"
    params = ", ".join(f"CAST({_suggest_sql(n, spec)} AS DOUBLE) AS {n}" for n, spec in space.items())
    return f"WITH {plan} SELECT study, trial_id, 'complete' AS state, true AS value_ok, {params} FROM plan"


def _recorded(trials, space: dict):
    return trials.select("study", "trial_id", "state", F.col("value").between(0, 1).alias("value_ok"),
                         *[F.element_at("params", n).alias(n) for n in space])


@register("search_vectorizer", _seeded_sql(se.VECTORIZER_SPACE, [f"tfidf_{v}" for v in VARIANT_ORDER]))
def search_vectorizer(spark, sf):
    """One vectorizer study per cleaning variant, objective = mean CV AUC of the logistic pipeline."""
    train, _ = holdout(spark, sf)
    trials = sj.search_vectorizers(train, VARIANT_ORDER, "logreg", LR_PARAMS, shared_path(spark, "trials"),
                                   n_trials=QUERY_TRIALS, n_splits=QUERY_FOLDS)
    return _recorded(trials, se.VECTORIZER_SPACE)


@register("search_model", _seeded_sql(se.LR_SPACE, ["logreg_base"]))
def search_model(spark, sf):
    """Logistic-regression search (C, max_iter) on fixed default vectors."""
    train, _ = holdout(spark, sf)
    return _recorded(sj.search_model(train, "logreg", TfidfConfig(), "base", shared_path(spark, "trials"), n_trials=QUERY_TRIALS,
                                     n_splits=QUERY_FOLDS), se.LR_SPACE)


@register("search_svm", _seeded_sql(se.SVM_SPACE, ["rff_svc_base"], se.DEFAULT_TRIALS))
def search_svm(spark, sf):
    """RBF-SVM search (C, gamma) on fixed default vectors: every trial and fold."""
    train, _ = holdout(spark, sf)
    return _recorded(sj.search_model(train, "rff_svc", TfidfConfig(), "base", shared_path(spark, "trials")), se.SVM_SPACE)


@register("search_gbt", _seeded_sql(se.GBT_SPACE, ["gbt_base"]))
def search_gbt(spark, sf):
    """Boosted-tree search over all nine dimensions on fixed default vectors."""
    train, _ = holdout(spark, sf)
    return _recorded(sj.search_model(train, "gbt", TfidfConfig(), "base", shared_path(spark, "trials"), n_trials=QUERY_TRIALS,
                                     n_splits=QUERY_FOLDS), se.GBT_SPACE)


def _entries(results):
    return results.select("entry", F.col("test_auc").between(0, 1).alias("test_ok"), F.col("cv_auc").between(0, 1).alias("cv_ok"),
                          (F.col("TP") + F.col("FN")).cast("long").alias("positives"))


def _entries_sql(names: list[str]) -> str:
    values = ", ".join(f"('{n}')" for n in names)
    return S.with_corpus(f"""SELECT entry, true AS test_ok, true AS cv_ok,
  (SELECT count(*) FROM holdout WHERE split = 'test' AND label = 1) AS positives FROM (VALUES {values}) v(entry)""", _SPLIT)


STAGE1_VARIANTS = ["base", "stemming"]  # the job takes any list; two keep the query's fits to 14


@register("stage1_job", _entries_sql(STAGE1_VARIANTS))
def stage1_job(spark, sf):
    """Per variant: search, best parameters over the fixed block, training job, results row upserted."""
    lab = docs(spark, sf).where("label IS NOT NULL")
    results, _ = sj.stage1(lab, STAGE1_VARIANTS, "logreg", LR_PARAMS, FIXED_VECTORIZER, shared_path(spark, "trials"),
                           n_trials=QUERY_TRIALS, n_splits=QUERY_FOLDS)
    return _entries(results)


@register("stage2_job", _entries_sql([*VARIANT_ORDER, "logreg_optimization"]))
def stage2_job(spark, sf):
    """The stage-1 winner's variant and vectorizer, a model search on it, training job, results row upserted;
    both stages whole: every variant, trial and fold."""
    lab = docs(spark, sf).where("label IS NOT NULL")
    path = shared_path(spark, "trials")
    results, trials = sj.stage1(lab, VARIANT_ORDER, "logreg", LR_PARAMS, FIXED_VECTORIZER, path)
    return _entries(sj.stage2(lab, "logreg", results, trials, FIXED_VECTORIZER, path))
