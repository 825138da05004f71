"""Registered split queries (section E of the inventory)."""

from __future__ import annotations

from lexis.operators import split as sp
from lexis.plans import sql as S
from lexis.plans.registry import register
from lexis.sources.corpus import labelled


def quota_ctes(src: str, frac: float, seed: str, name: str) -> str:
    """Largest-remainder quotas and hash ranks in SQL; defines ``{name}`` with a ``split`` column."""
    return f"""{name}_cnt AS (SELECT label, count(*) AS n FROM {src} GROUP BY label),
{name}_tot AS (SELECT sum(n) AS n_all, CAST(ceil({frac!r} * sum(n)) AS BIGINT) AS n_take FROM {name}_cnt),
{name}_q AS (SELECT label, n, (n_take * n) // n_all AS fl, (n_take * n) % n_all AS rem, n_take FROM {name}_cnt, {name}_tot),
{name}_quota AS (SELECT label, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
                   <= n_take - sum(fl) OVER () THEN 1 ELSE 0 END AS quota FROM {name}_q),
{name} AS (SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY s.label ORDER BY md5('{seed}:' || CAST(s.text_id AS VARCHAR)), s.text_id)
                  <= q.quota THEN 'test' ELSE 'train' END AS split
           FROM {src} s JOIN {name}_quota q ON s.label = q.label)"""


_SPLIT = quota_ctes("labelled", 0.2, "42", "holdout")


def _holdout(spark, sf):
    return sp.stratified_split(labelled(spark, sf).select("text_id", "label"))


@register("stratified_split", S.with_corpus("SELECT text_id, label, split FROM holdout", _SPLIT))
def stratified_split(spark, sf):
    """80/20 stratified holdout, seed 42."""
    return _holdout(spark, sf)


@register("stratified_kfold", S.with_corpus("""
SELECT t.text_id, t.label, CAST((c.off + row_number() OVER (PARTITION BY t.label
         ORDER BY md5('42:' || CAST(t.text_id AS VARCHAR)), t.text_id) - 1) % 5 AS INTEGER) AS fold
FROM train t JOIN (SELECT label, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
                   FROM (SELECT label, count(*) AS n FROM train GROUP BY label)) c ON t.label = c.label""",
    _SPLIT + ",\ntrain AS (SELECT text_id, label FROM holdout WHERE split = 'train')"))
def stratified_kfold(spark, sf):
    """5 stratified folds over the training part."""
    train = _holdout(spark, sf).where("split = 'train'").drop("split")
    return sp.stratified_kfold(train, n_splits=5)


@register("inner_split", S.with_corpus("SELECT text_id, label, split = 'test' AS is_validation FROM inner_s",
    _SPLIT + ",\ntrain AS (SELECT text_id, label FROM holdout WHERE split = 'train'),\n"
    + quota_ctes("train", 0.1, "42:val", "inner_s")))
def inner_split(spark, sf):
    """Stratified 90/10 early-stopping split of the training part."""
    train = _holdout(spark, sf).where("split = 'train'").drop("split")
    return sp.inner_validation(train)


@register("split_leak_check", S.with_corpus("""
SELECT CAST(count_if(split = 'train') AS BIGINT) AS n_train, CAST(count_if(split = 'test') AS BIGINT) AS n_test,
       CAST((SELECT count(*) FROM (SELECT text_id FROM holdout WHERE split = 'train'
                                   INTERSECT SELECT text_id FROM holdout WHERE split = 'test')) AS BIGINT) AS n_overlap
FROM holdout""", _SPLIT))
def split_leak_check(spark, sf):
    """Test ids never appear in the training part."""
    return sp.leak_check(_holdout(spark, sf))
