from __future__ import annotations

from oracles.exprs import hash60

JUDGED = """
judged AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label,
  CASE WHEN n_chars > 900 THEN 'good' WHEN lang = 'en' THEN 'toxic' ELSE 'bad' END AS predicted,
  (n_chars % 100) / 100 AS confidence FROM documents JOIN labels USING (doc_id))
"""


def report(source: str) -> str:
    return f"""
    SELECT label, coalesce(hits / nullif(guesses, 0), 0.0) AS precision, coalesce(hits / nullif(support, 0), 0.0) AS recall,
      coalesce(2.0 * hits / nullif(guesses + support, 0), 0.0) AS f1, support
    FROM (SELECT label, coalesce(support, 0) AS support, coalesce(hits, 0) AS hits, coalesce(guesses, 0) AS guesses FROM
      (SELECT label, count(*) AS support, count(*) FILTER (label = predicted) AS hits FROM {source} GROUP BY 1)
      FULL JOIN (SELECT predicted AS label, count(*) AS guesses FROM {source} GROUP BY 1) USING (label))"""


def overall(source: str) -> str:
    return f"""
    SELECT accuracy, precision, recall, f1, avg_confidence, rows FROM
      (SELECT round(sum(precision * support) / sum(support), 6) AS precision,
              round(sum(recall * support) / sum(support), 6) AS recall,
              round(sum(f1 * support) / sum(support), 6) AS f1, CAST(sum(support) AS BIGINT) AS rows FROM ({report(source)})),
      (SELECT round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
              round(avg(confidence), 6) AS avg_confidence FROM {source})"""


def split(source: str, label: str, order: str, fraction: str) -> str:
    return f"""
    SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {order})
      <= ceil({fraction} * count(*) OVER (PARTITION BY {label})) AS is_test FROM {source}"""


ORACLES = {
    "class_distribution": f"WITH {JUDGED} SELECT label, count(*) AS n FROM judged GROUP BY 1",
    "class_weights": f"""
        WITH {JUDGED}, s AS (SELECT label, count(*) AS n FROM judged GROUP BY 1)
        SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM s""",
    "overall_metrics": f"WITH {JUDGED} {overall('judged')}",
    "class_report": f"""
        WITH {JUDGED} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
          round(f1, 6) AS f1, support FROM ({report('judged')})""",
    "confusion_matrix": f"""
        WITH {JUDGED} SELECT c.label, count(*) FILTER (predicted = 'bad') AS bad, count(*) FILTER (predicted = 'good') AS good,
          count(*) FILTER (predicted = 'toxic') AS toxic
        FROM (VALUES ('bad'), ('good'), ('toxic')) c(label) LEFT JOIN judged USING (label) GROUP BY 1""",
    "compare_models": f"""
        WITH {JUDGED}, always AS (SELECT * REPLACE ('good' AS predicted) FROM judged)
        SELECT 'by length' AS approach, * FROM ({overall('judged')})
        UNION ALL SELECT 'always good', * FROM ({overall('always')})""",
    "mistakes_first": f"WITH {JUDGED} SELECT *, label = predicted AS correct FROM judged",
    "stratified_split": f"""
        WITH {JUDGED}, k AS (SELECT doc_id, label FROM judged)
        {split('k', 'label', hash60("'42'", 'doc_id') + ', doc_id', '0.2')}""",
    "stratified_split_lineitem": f"""
        WITH m AS ({split('lineitem', 'l_returnflag', hash60('l_orderkey') + ', l_linenumber', '0.15')})
        SELECT l_returnflag, is_test, count(*) AS n FROM m GROUP BY 1, 2""",
}

ORACLES["model_invariants"] = """
    SELECT true AS sums_to_one, true AS predicts_highest, true AS accuracy_recomputed, true AS better_than_most, true AS converged"""
ORACLES["bundle_round_trip"] = "SELECT true AS same_predictions, 438::BIGINT AS dimensions, true AS classes_sorted, true AS rows_told"
ORACLES["labelled_round_trip"] = "SELECT 0::BIGINT AS different_rows"
