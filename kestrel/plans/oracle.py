"""DuckDB SQL for every exact-checked query in ``catalog.EXACT`` (the correctness oracle).

Each statement recomputes the operator from the raw tables with plain SQL: ``row_number`` windows for splits,
``avg``/``var_pop``/``median`` for fits, a sorted running sum for ROC AUC. Nothing here is shared with the Spark
implementation except the fixture definition and the category level names of the fixture tables.
"""

from __future__ import annotations

from kestrel.operators.preprocess import level_name
from kestrel.sources.fixtures import ART_SQL, DOCS_SQL

# Category levels of the driver tables used by the fixtures (TPC-H order priorities and market
# segments; document languages; document sources src0..src19).
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
MARKET_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
DOC_LANGS = ["de", "en", "es", "fr"]
DOC_SOURCES = sorted(f"src{i}" for i in range(20))

ART_T = ["t0", "t1", "t2", "t3", "t4"]
ART_NUM = ["x1", "x2", *ART_T]


def r(expr: str) -> str:
    """Round half up to 6 decimals with plain IEEE arithmetic (bit-identical to ``functions.columns.r6``)."""
    return f"(floor(({expr}) * 1e6 + 0.5e0) / 1e6)"


def split_sql(src: str, name: str = "sp", seed: int = 42, test_size: float = 0.2, k: int = 5) -> str:
    return f"""
{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(concat(cast(id as varchar), ':{seed}')), id) AS __rk,
         count(*) OVER (PARTITION BY y) AS __nc
  FROM {src}
),
{name}_t AS (SELECT *, cast(ceil({test_size}e0 * __nc) as bigint) AS __nt FROM {name}_r),
{name} AS (
  SELECT * EXCLUDE (__rk, __nc, __nt),
    CASE WHEN __rk <= __nt THEN 'test' ELSE 'trainval' END AS split,
    CASE WHEN __rk <= __nt THEN NULL ELSE cast((__rk - __nt - 1) * {k} // (__nc - __nt) as integer) END AS fold
  FROM {name}_t
),
tv AS (SELECT * FROM {name} WHERE split = 'trainval')"""


ART_SPLIT = "WITH " + ART_SQL + "," + split_sql("art")
DOCS_SPLIT = "WITH " + DOCS_SQL + "," + split_sql("docs")


def stats_sql(fit: str, nums: list[str], cats: list[str], name: str = "st") -> str:
    parts = ["count(*) AS n"]
    for c in nums:
        parts += [f"avg({c}) AS m_{c}", f"var_pop({c}) AS v_{c}", f"count({c}) AS c_{c}", f"median({c}) AS d_{c}"]
    for c in cats:
        parts.append(
            f"(SELECT {c} FROM {fit} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS f_{c}"
        )
    return f"{name} AS (SELECT {', '.join(parts)} FROM {fit})"


def std_expr(c: str) -> str:
    sd = f"sqrt(v_{c} * c_{c} / n)"
    return f"(coalesce({c}, m_{c}) - m_{c}) / CASE WHEN v_{c} * c_{c} / n > 0 THEN {sd} ELSE 1e0 END"


def dummies(c: str, levels: list[str]) -> list[str]:
    return [
        f"CASE WHEN coalesce({c}, f_{c}) = '{lv}' THEN 1e0 ELSE 0e0 END AS {level_name(c, lv)}" for lv in levels[1:]
    ]


def design_select(nums: list[str], cat_levels: dict[str, list[str]]) -> list[str]:
    return [f"{std_expr(c)} AS {c}" for c in nums] + [d for c, lv in cat_levels.items() for d in dummies(c, lv)]


ART_LEVELS = {"cat1": ORDER_PRIORITIES, "cat2": MARKET_SEGMENTS}
ART_DM = ", ".join(design_select(ART_NUM, ART_LEVELS))
ART_DM_NAMES = ART_NUM + [level_name(c, lv) for c, lvs in ART_LEVELS.items() for lv in lvs[1:]]


def rounded_all(cols: list[str], src: str = "d") -> str:
    return ", ".join(r(f"{src}.{c}") + f" AS {c}" for c in cols)


def metrics_sql(src: str, group: str | None) -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    part = f"PARTITION BY {group} " if group else ""
    join = f"JOIN au USING ({group})" if group else ", au"
    return f""",
sc AS (SELECT {g}y, score, CASE WHEN score > 0.5e0 THEN 1 ELSE 0 END AS pred FROM {src}),
af AS (SELECT {g}count(*) AS n, sum(y * pred) AS tp, sum((1 - y) * pred) AS fp, sum(y * (1 - pred)) AS fn
       FROM sc {gb}),
au0 AS (SELECT {g}score, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY {g}score),
au1 AS (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          AS nb FROM au0),
au AS (SELECT {g}sum(pos * (nb + neg / 2e0)) / (cast(sum(pos) as double) * cast(sum(neg) as double)) AS roc_auc
       FROM au1 {gb}),
mt AS (SELECT {g}(n - fp - fn) / n AS accuracy,
         CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0e0 END AS f1, roc_auc
       FROM af {join}),
mc AS (SELECT *, (accuracy + f1 + roc_auc) / 3e0 AS composite FROM mt)"""


def _oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["holdout_split"] = ART_SPLIT + " SELECT id, y, split FROM sp"
    q["kfold_assign"] = ART_SPLIT + " SELECT id, y, fold FROM tv"
    q["row_counts"] = ART_SPLIT + " SELECT split, count(*) AS n_rows FROM sp GROUP BY split"
    q["min_class_size"] = ART_SPLIT + """
 SELECT cast(min(c) as bigint) AS min_class_size, cast(5 as integer) AS n_splits,
        cast(CASE WHEN min(c) < 5 THEN 1 ELSE 0 END as integer) AS too_small
 FROM (SELECT y, count(*) AS c FROM tv GROUP BY y)"""
    q["threshold_label"] = (
        "WITH " + ART_SQL + " SELECT id, shares, CASE WHEN shares > 1400 THEN 1 ELSE 0 END AS y_label FROM art"
    )
    q["feature_projection"] = (
        "WITH " + ART_SQL + " SELECT id, cast(y as double) AS label, "
        + ", ".join(f"{r(c)} AS {c}" for c in ART_NUM) + ", cat1, cat2 FROM art"
    )
    derived = {
        "feat_x1_to_x2_ratio": "x1 / (x2 + 1e-6)",
        "feat_x1_x2_spread": "x1 - x2",
        "feat_t0_t1_product": "t0 * t1",
        "feat_t_max": "greatest(t0, t1, t2, t3, t4)",
        "feat_t_std": "list_aggregate(list_filter([t0, t1, t2, t3, t4], lambda x: x IS NOT NULL), 'stddev_samp')",
    }
    single = {"derive_ratio": "feat_x1_to_x2_ratio", "derive_spread": "feat_x1_x2_spread",
              "derive_product": "feat_t0_t1_product", "row_max": "feat_t_max", "row_std": "feat_t_std"}
    for key, name in single.items():
        q[key] = "WITH " + ART_SQL + f" SELECT id, {r(derived[name])} AS {name} FROM art"
    q["derived_features"] = "WITH " + ART_SQL + " SELECT id, " + ", ".join(
        f"{r(e)} AS {n}" for n, e in derived.items()) + " FROM art"

    st = "," + stats_sql("tv", ["x1", "x2"], ["cat1", "cat2"])
    q["impute_mean"] = ART_SPLIT + st + (
        " SELECT id, " + r("coalesce(x1, m_x1)") + " AS x1, " + r("coalesce(x2, m_x2)") + " AS x2 FROM sp, st")
    q["impute_median"] = ART_SPLIT + st + (
        " SELECT id, " + r("coalesce(x1, d_x1)") + " AS x1, " + r("coalesce(x2, d_x2)") + " AS x2 FROM sp, st")
    q["impute_mode"] = ART_SPLIT + st + " SELECT id, coalesce(cat1, f_cat1) AS cat1, coalesce(cat2, f_cat2) AS cat2 FROM sp, st"
    q["impute_const"] = ART_SPLIT + (
        " SELECT id, coalesce(cat1, 'missing') AS cat1, coalesce(cat2, 'missing') AS cat2 FROM sp")
    q["standardize"] = ART_SPLIT + st + (
        f" SELECT id, {r(std_expr('x1'))} AS x1, {r(std_expr('x2'))} AS x2 FROM sp, st")
    q["one_hot_drop_first"] = ART_SPLIT + st + (
        " SELECT id, " + ", ".join(dummies("cat1", ORDER_PRIORITIES) + dummies("cat2", MARKET_SEGMENTS))
        + " FROM sp, st")
    st_all = "," + stats_sql("tv", ART_NUM, ["cat1", "cat2"])
    q["design_matrix"] = ART_SPLIT + st_all + f", d AS (SELECT id, {ART_DM} FROM sp, st)" + (
        f" SELECT id, {rounded_all(ART_DM_NAMES)} FROM d")

    q["fold_statistics"] = ART_SPLIT + """,
fs AS (SELECT f.fold AS k, t.* EXCLUDE (fold) FROM (SELECT DISTINCT fold FROM tv) f JOIN tv t ON t.fold <> f.fold),
ag AS (SELECT k, count(*) AS n_train, avg(x1) AS m1, var_pop(x1) AS v1, count(x1) AS c1,
              avg(x2) AS m2, var_pop(x2) AS v2, count(x2) AS c2 FROM fs GROUP BY k),
mc1 AS (SELECT k, cat1 AS v, count(*) AS c FROM fs WHERE cat1 IS NOT NULL GROUP BY k, cat1),
mo1 AS (SELECT k, v FROM (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY c DESC, v) AS rn FROM mc1) WHERE rn = 1),
mc2 AS (SELECT k, cat2 AS v, count(*) AS c FROM fs WHERE cat2 IS NOT NULL GROUP BY k, cat2),
mo2 AS (SELECT k, v FROM (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY c DESC, v) AS rn FROM mc2) WHERE rn = 1)
SELECT cast(ag.k as integer) AS fold, ag.n_train,
  (floor((m1) * 1e6 + 0.5e0) / 1e6) AS mean_x1, (floor((CASE WHEN v1 * c1 / n_train > 0 THEN sqrt(v1 * c1 / n_train) ELSE 1e0 END) * 1e6 + 0.5e0) / 1e6) AS std_x1,
  (floor((m2) * 1e6 + 0.5e0) / 1e6) AS mean_x2, (floor((CASE WHEN v2 * c2 / n_train > 0 THEN sqrt(v2 * c2 / n_train) ELSE 1e0 END) * 1e6 + 0.5e0) / 1e6) AS std_x2,
  mo1.v AS mode_cat1, mo2.v AS mode_cat2
FROM ag JOIN mo1 ON ag.k = mo1.k JOIN mo2 ON ag.k = mo2.k"""

    q["ordered_target_mean"] = ART_SPLIT + """,
pr AS (SELECT avg(y) AS p FROM tv),
te AS (SELECT id, coalesce(cat2, 'missing') AS v, y, md5(concat(cast(id as varchar), ':cb')) AS k FROM tv)
SELECT id, (floor(((coalesce(sum(y) OVER w, 0) + p) / (coalesce(count(*) OVER w, 0) + 1e0)) * 1e6 + 0.5e0) / 1e6) AS cat2_te
FROM te, pr
WINDOW w AS (PARTITION BY v ORDER BY k, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

    fm = ART_SPLIT + metrics_sql("tv", "fold")
    q["metric_accuracy"] = fm + " SELECT fold, (floor((accuracy) * 1e6 + 0.5e0) / 1e6) AS accuracy FROM mc"
    q["metric_f1"] = fm + " SELECT fold, (floor((f1) * 1e6 + 0.5e0) / 1e6) AS f1 FROM mc"
    q["metric_auc"] = fm + " SELECT fold, (floor((roc_auc) * 1e6 + 0.5e0) / 1e6) AS roc_auc FROM au"
    q["metric_composite"] = fm + (
        " SELECT fold, (floor((accuracy) * 1e6 + 0.5e0) / 1e6) AS accuracy, (floor((f1) * 1e6 + 0.5e0) / 1e6) AS f1, (floor((roc_auc) * 1e6 + 0.5e0) / 1e6) AS roc_auc,"
        " (floor((composite) * 1e6 + 0.5e0) / 1e6) AS composite FROM mc")
    q["fold_mean"] = fm + (
        " SELECT (floor((avg(accuracy)) * 1e6 + 0.5e0) / 1e6) AS mean_accuracy, (floor((avg(f1)) * 1e6 + 0.5e0) / 1e6) AS mean_f1,"
        " (floor((avg(roc_auc)) * 1e6 + 0.5e0) / 1e6) AS mean_roc_auc, (floor((avg(composite)) * 1e6 + 0.5e0) / 1e6) AS mean_composite FROM mc")
    q["holdout_metrics"] = ART_SPLIT + ", te AS (SELECT * FROM sp WHERE split = 'test')" + metrics_sql("te", None) + (
        " SELECT (floor((accuracy) * 1e6 + 0.5e0) / 1e6) AS accuracy, (floor((f1) * 1e6 + 0.5e0) / 1e6) AS f1, (floor((roc_auc) * 1e6 + 0.5e0) / 1e6) AS roc_auc,"
        " (floor((composite) * 1e6 + 0.5e0) / 1e6) AS composite FROM mc")

    unpivot = ", ".join(ART_DM_NAMES)
    q["nb_tables"] = ART_SPLIT + st_all + f""",
d AS (SELECT y, {ART_DM} FROM tv, st),
lg AS (UNPIVOT d ON {unpivot} INTO NAME feature VALUE val),
eps AS (SELECT 1e-9 * max(v) AS e FROM (SELECT feature, var_pop(val) AS v FROM lg GROUP BY feature))
SELECT cast(y as integer) AS label, feature, (floor((avg(val)) * 1e6 + 0.5e0) / 1e6) AS mean, (floor((var_pop(val) + max(e)) * 1e6 + 0.5e0) / 1e6) AS var
FROM lg, eps GROUP BY y, feature"""

    vote = "(2e0 * p1 + 1e0 * p2 + 1e0 * p3) / 4e0"
    q["soft_vote"] = "WITH " + ART_SQL + (
        f" SELECT id, {r(vote)} AS y_prob, CASE WHEN {vote} > 0.5e0 THEN 1 ELSE 0 END AS y_predict FROM art")

    q["docs_split"] = DOCS_SPLIT + " SELECT id, y, split, fold FROM sp"
    docs_levels = {"lang": DOC_LANGS, "source": DOC_SOURCES}
    names = ["n_chars"] + [level_name(c, lv) for c, lvs in docs_levels.items() for lv in lvs[1:]]
    q["docs_design_matrix"] = DOCS_SPLIT + "," + stats_sql("tv", ["n_chars"], ["lang", "source"]) + (
        f", d AS (SELECT id, {', '.join(design_select(['n_chars'], docs_levels))} FROM sp, st)"
        f" SELECT id, {rounded_all(names)} FROM d")
    q["kfold_all_rows"] = "WITH " + ART_SQL + """,
r0 AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5(concat(cast(id as varchar), ':42')), id) AS rk,
              count(*) OVER (PARTITION BY y) AS nc FROM art)
SELECT id, y, CASE WHEN rk <= cast(ceil(0.2e0 * nc) as bigint) THEN 'test' ELSE 'trainval' END AS split,
       cast((rk - 1) * 5 // nc as integer) AS fold FROM r0"""
    q["fold_class_counts"] = ART_SPLIT + " SELECT fold, y, count(*) AS n_rows FROM tv GROUP BY fold, y"
    q["docs_ordered_target_mean"] = DOCS_SPLIT + """,
pr AS (SELECT avg(y) AS p FROM tv),
te AS (SELECT id, source AS v, y, md5(concat(cast(id as varchar), ':cb')) AS k FROM tv)
SELECT id, """ + r("(coalesce(sum(y) OVER w, 0) + p) / (coalesce(count(*) OVER w, 0) + 1e0)") + """ AS source_te
FROM te, pr
WINDOW w AS (PARTITION BY v ORDER BY k, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    q["docs_fold_class_counts"] = DOCS_SPLIT + " SELECT fold, y, count(*) AS n_rows FROM tv GROUP BY fold, y"
    q["docs_auc"] = "WITH " + DOCS_SQL + """,
a0 AS (SELECT lang, n_chars AS s, sum(y) AS pos, sum(1 - y) AS neg FROM docs GROUP BY lang, n_chars),
a1 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY lang ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS nb FROM a0),
a2 AS (SELECT lang, sum(pos * (nb + neg / 2e0)) AS num, sum(pos) AS p, sum(neg) AS n FROM a1 GROUP BY lang)
SELECT lang, """ + r("CASE WHEN p > 0 AND n > 0 THEN num / (cast(p as double) * cast(n as double)) END") + """ AS roc_auc
FROM a2"""
    u = "greatest(" + "(cast(('0x' || substr(md5(concat(cast(id as varchar), ':bw42')), 1, 8)) as bigint) / 4294967296e0)" \
        + ", 1e-12)"
    ws = ", ".join(r(f"pow(-ln({u}), {t}e0)") + f" AS w_{str(t).replace('.', '_')}" for t in (0.5, 1.0, 1.5, 2.0))
    q["bootstrap_weights"] = "WITH " + ART_SQL + f" SELECT id, {ws} FROM art"
    return q


def naive_bayes_scores(scored: str) -> str:
    """Gaussian naive Bayes up to the scores ``pr(fold, id, y, score)``: per fit k (each fold left out, -1: none) the
    preprocessing statistics, class means and variances and priors, applied to the rows ``scored`` (with a column k)."""
    nums, cats = ART_NUM, ART_LEVELS
    names = ART_DM_NAMES
    st = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}, count({c}) AS c_{c}" for c in nums)
    mode = "".join(
        f""",
md_{c} AS (SELECT k, v AS f_{c} FROM (SELECT k, {c} AS v, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, {c}) AS rn
            FROM fit WHERE {c} IS NOT NULL GROUP BY k, {c}) WHERE rn = 1)""" for c in cats)
    join = "JOIN st USING (k) " + " ".join(f"JOIN md_{c} USING (k)" for c in cats)
    dm = ", ".join(design_select(nums, cats))
    moments = ", ".join(f"avg({c}) AS mu_{c}, var_pop({c}) AS va_{c}" for c in names)
    spread = ", ".join(f"var_pop({c})" for c in names)
    log_p = " + ".join(f"(ln(2e0 * pi() * (va_{c} + e)) + ({c} - mu_{c}) * ({c} - mu_{c}) / (va_{c} + e))" for c in names)
    return ART_SPLIT + f""",
ks AS (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS k),
fit AS (SELECT ks.k, tv.* FROM ks JOIN tv ON tv.fold <> ks.k),
st AS (SELECT k, count(*) AS n, {st} FROM fit GROUP BY k){mode},
trd AS (SELECT k, y, {dm} FROM fit {join}),
eps AS (SELECT k, 1e-9 * greatest({spread}) AS e FROM trd GROUP BY k),
cl AS (SELECT k, y AS cls, count(*) AS nc, {moments} FROM trd GROUP BY k, y),
nt AS (SELECT k, sum(nc) AS nk FROM cl GROUP BY k),
sr AS ({scored}),
srd AS (SELECT k, id, y, {dm} FROM sr {join}),
lp AS (SELECT k, id, y, cls, ln(nc / cast(nk as double)) - 0.5e0 * ({log_p}) AS l
       FROM srd JOIN cl USING (k) JOIN nt USING (k) JOIN eps USING (k)),
pr AS (SELECT k AS fold, id, y, 1e0 / (1e0 + exp(sum(CASE WHEN cls = 0 THEN l ELSE -l END))) AS score FROM lp GROUP BY k, id, y)"""


def naive_bayes_sql() -> str:
    """The experiment from end to end: accuracy, F1, AUC and composite per fold, their mean, and the hold-out."""
    scored = "SELECT fold AS k, * FROM tv UNION ALL SELECT -1 AS k, * FROM sp WHERE split = 'test'"
    return naive_bayes_scores(scored) + metrics_sql("pr", "fold") + f""",
out AS (SELECT CASE WHEN fold < 0 THEN 'holdout' ELSE 'cv' END AS scope, CASE WHEN fold >= 0 THEN cast(fold as integer) END AS fold,
               accuracy, f1, roc_auc, composite FROM mc),
al AS (SELECT * FROM out UNION ALL SELECT 'cv_mean', NULL, avg(accuracy), avg(f1), avg(roc_auc), avg(composite) FROM out WHERE scope = 'cv')
SELECT 'exp_naive_bayes' AS experiment, scope, fold, {r('accuracy')} AS accuracy, {r('f1')} AS f1, {r('roc_auc')} AS roc_auc,
       {r('composite')} AS composite FROM al"""


ORACLE: dict[str, str] = {
    **_oracles(),
    "exp_naive_bayes": naive_bayes_sql(),
    "nb_score_batch": naive_bayes_scores("SELECT -1 AS k, * FROM sp")
    + f" SELECT id, CASE WHEN score > 0.5e0 THEN 1 ELSE 0 END AS y_predict, {r('score')} AS y_prob FROM pr",
    "best_trial": "WITH " + ART_SQL + f""",
tr AS (SELECT cast(id % 30 as integer) AS trial, {r('avg(score)')} AS mean_auc FROM art GROUP BY 1)
SELECT trial, mean_auc FROM tr ORDER BY mean_auc DESC, trial LIMIT 1""",
    "top_importances": "WITH " + ART_SQL + f""",
im AS (SELECT concat('f', cast(id % 300 as varchar)) AS feature, {r('avg(floor(score * 10))')} AS importance FROM art GROUP BY 1)
SELECT feature, importance FROM im ORDER BY importance DESC, feature LIMIT 20""",
    "early_stop": "WITH " + ART_SQL + f""",
sc AS (SELECT cast(id % 200 + 1 as integer) AS trees, y, score FROM art),
c0 AS (SELECT trees, score, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY trees, score),
c1 AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY trees ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM c0),
c2 AS (SELECT trees, sum(pos * (nb + neg / 2e0)) AS num, sum(pos) AS p, sum(neg) AS n FROM c1 GROUP BY trees),
cv AS (SELECT trees, {r('num / (cast(p as double) * cast(n as double))')} AS roc_auc FROM c2 WHERE p > 0 AND n > 0),
tops AS (SELECT *, lead(trees) OVER (ORDER BY trees) AS next_top FROM (
           SELECT *, max(roc_auc) OVER (ORDER BY trees ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM cv)
         WHERE top IS NULL OR roc_auc > top)
SELECT trees, roc_auc FROM tops t
WHERE next_top IS NULL OR EXISTS (SELECT 1 FROM cv WHERE cv.trees < t.next_top AND cv.trees >= t.trees + 20)
ORDER BY trees LIMIT 1""",
}

from kestrel.plans.boost_oracle import BOOST_ORACLE  # noqa: E402 - it builds on the split above

ORACLE.update(BOOST_ORACLE)
# the same rows through files
ORACLE.update({"csv_scan": ORACLE["feature_projection"], "score_files": ORACLE["nb_score_batch"]})
