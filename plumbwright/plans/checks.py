"""Queries: quality checks, reconciliation and relational validation."""

from __future__ import annotations

from plumbwright.operators import quality, relational
from plumbwright.operators.reconcile import duplicate_keys, reconcile
from plumbwright.plans.base import Tables, plan, s_float, s_norm, sql

NOT_NULL = ("id", "email", "age")
AGE_RANGE = {"age": (0, 120)}
# One mailbox and a host with a dot.
EMAIL = r"[A-Za-z0-9_.+#-]+@[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+"

# -- column quality ---------------------------------------------------------

_ROWS = "SELECT 'row_count' AS metric, '' AS item, count(*) AS value FROM v_dirty_customer"
_NULLS = " UNION ALL ".join(
    f"SELECT 'nulls' AS metric, '{c}' AS item, count(*) FILTER (WHERE {s_norm(c)} = '') AS value FROM v_dirty_customer"
    for c in NOT_NULL
)
_AGE = s_float(s_norm("age"))
_RANGE = f"""SELECT 'range_violations' AS metric, 'age' AS item,
count(*) FILTER (WHERE v IS NULL OR (NOT isnan(v) AND (v < 0 OR v > 120))) AS value
FROM (SELECT {_AGE} AS v FROM v_dirty_customer)"""
_FORMAT = f"""SELECT 'format_violations' AS metric, 'email' AS item,
count(*) FILTER (WHERE NOT regexp_full_match({s_norm('email')}, '{EMAIL}')) AS value FROM v_dirty_customer"""


def _dups(columns: list[str], view: str) -> str:
    keys = ", ".join(s_norm(c) for c in columns)
    return f"""SELECT 'duplicate_rows' AS metric, '{','.join(columns)}' AS item, coalesce(sum(n), 0)::bigint AS value
FROM (SELECT count(*) AS n FROM {view} GROUP BY {keys} HAVING count(*) > 1)"""


_DIRTY = ("v_dirty_customer",)


@plan("dq_nulls", sql(_NULLS, _DIRTY))
def dq_nulls(t: Tables):
    return quality.null_counts(t["v_dirty_customer"], NOT_NULL)


@plan("dq_duplicates", sql(_dups(["id"], "v_dirty_customer"), _DIRTY))
def dq_duplicates(t: Tables):
    return quality.duplicate_rows(t["v_dirty_customer"], ["id"])


@plan(
    "dq_duplicates_composite",
    sql(
        """SELECT 'duplicate_rows' AS metric, 'l_orderkey,l_linenumber' AS item, coalesce(sum(n), 0)::bigint AS value
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
    ),
)
def dq_duplicates_composite(t: Tables):
    return quality.duplicate_rows(t["lineitem"], ["l_orderkey", "l_linenumber"])


@plan("dq_range", sql(_RANGE, _DIRTY))
def dq_range(t: Tables):
    return quality.range_violations(t["v_dirty_customer"], AGE_RANGE)


@plan("dq_format", sql(_FORMAT, _DIRTY))
def dq_format(t: Tables):
    return quality.format_violations(t["v_dirty_customer"], {"email": EMAIL})


@plan("dq_report", sql(" UNION ALL ".join([_ROWS, _NULLS, _RANGE, _FORMAT, _dups(["id"], "v_dirty_customer")]), _DIRTY))
def dq_report(t: Tables):
    return quality.quality_report(
        t["v_dirty_customer"], NOT_NULL, unique_key=["id"], ranges=AGE_RANGE, formats={"email": EMAIL}
    )


# -- reconciliation ---------------------------------------------------------

COMPARE = ("member_id", "amount", "status")
_SIDES = ("v_source", "v_target")


def _side(view: str) -> str:
    cells = ", ".join(f"{s_norm(c)} AS {c}" for c in COMPARE)
    return f"""SELECT * FROM (SELECT {s_norm('claim_id')} AS claim_id, {cells},
row_number() OVER (PARTITION BY {s_norm('claim_id')} ORDER BY pos DESC) AS rn,
count(*) OVER (PARTITION BY {s_norm('claim_id')}) AS n FROM {view}) WHERE rn = 1"""


_CTES = {"s": _side("v_source"), "t": _side("v_target")}
_DIFFS = " UNION ALL ".join(
    f'SELECT s.claim_id, \'{c}\' AS "column", s.{c} AS source_value, t.{c} AS target_value '
    f"FROM s JOIN t ON s.claim_id = t.claim_id WHERE s.{c} <> t.{c}"
    for c in COMPARE
)


def _rec(t: Tables):
    return reconcile(t["v_source"], t["v_target"], ["claim_id"], COMPARE, position=["pos"])


@plan(
    "rec_missing_in_target",
    sql("SELECT claim_id FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.claim_id = s.claim_id)", _SIDES, **_CTES),
)
def rec_missing_in_target(t: Tables):
    return _rec(t).missing_in_target()


@plan(
    "rec_missing_in_source",
    sql("SELECT claim_id FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE t.claim_id = s.claim_id)", _SIDES, **_CTES),
)
def rec_missing_in_source(t: Tables):
    return _rec(t).missing_in_source()


@plan("rec_dup_source", sql("SELECT claim_id, n FROM s WHERE n > 1", _SIDES, **_CTES))
def rec_dup_source(t: Tables):
    return duplicate_keys(t["v_source"], ["claim_id"])


@plan("rec_dup_target", sql("SELECT claim_id, n FROM t WHERE n > 1", _SIDES, **_CTES))
def rec_dup_target(t: Tables):
    return duplicate_keys(t["v_target"], ["claim_id"])


@plan("rec_mismatches", sql(_DIFFS, _SIDES, **_CTES))
def rec_mismatches(t: Tables):
    return _rec(t).mismatches()


_ANY_DIFF = " OR ".join(f"s.{c} <> t.{c}" for c in COMPARE)


@plan(
    "rec_summary",
    sql(
        """SELECT *, CASE WHEN source_keys = 0 THEN 0.0
  ELSE round_even(100.0::double * (matched_keys - mismatched_keys) / source_keys, 1) END::double AS match_rate
FROM (SELECT (SELECT count(*) FROM v_source) AS source_rows, (SELECT count(*) FROM v_target) AS target_rows,
  count(s_id) AS source_keys, count(*) FILTER (WHERE s_id IS NOT NULL AND t_id IS NOT NULL) AS matched_keys,
  count(*) FILTER (WHERE differs) AS mismatched_keys,
  count(*) FILTER (WHERE t_id IS NULL) AS missing_in_target, count(*) FILTER (WHERE s_id IS NULL) AS missing_in_source,
  count(*) FILTER (WHERE sn > 1) AS duplicate_keys_source, count(*) FILTER (WHERE tn > 1) AS duplicate_keys_target
  FROM j)""",
        _SIDES,
        **_CTES,
        j=f"""SELECT s.claim_id AS s_id, t.claim_id AS t_id, s.n AS sn, t.n AS tn, ({_ANY_DIFF}) AS differs
FROM s FULL JOIN t ON s.claim_id = t.claim_id""",
    ),
)
def rec_summary(t: Tables):
    return _rec(t).summary()


@plan(
    "rec_findings",
    sql(
        f"""SELECT claim_id, 'missing_in_target' AS finding, NULL::bigint AS n, NULL::varchar AS "column",
  NULL::varchar AS source_value, NULL::varchar AS target_value
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.claim_id = s.claim_id)
UNION ALL SELECT claim_id, 'missing_in_source', NULL, NULL, NULL, NULL
FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE t.claim_id = s.claim_id)
UNION ALL SELECT claim_id, 'duplicate_in_source', n, NULL, NULL, NULL FROM s WHERE n > 1
UNION ALL SELECT claim_id, 'duplicate_in_target', n, NULL, NULL, NULL FROM t WHERE n > 1
UNION ALL SELECT claim_id, 'mismatch', NULL, "column", source_value, target_value FROM ({_DIFFS})""",
        _SIDES,
        **_CTES,
    ),
)
def rec_findings(t: Tables):
    return _rec(t).findings()


# -- relational validation --------------------------------------------------

HIGH_SPEND = 120_000_000
_CLAIMS = ("v_patients", "v_claims")


@plan(
    "rel_spend",
    sql(
        """SELECT p.name, p.state, count(c.claim_id) AS n_claims, round(sum(c.amount), 2) AS total_amount
FROM v_patients p JOIN v_claims c ON c.patient_id = p.patient_id GROUP BY p.patient_id, p.name, p.state""",
        _CLAIMS,
    ),
)
def rel_spend(t: Tables):
    return relational.spend_per_patient(t["v_patients"], t["v_claims"])


@plan(
    "rel_no_claims",
    sql(
        """SELECT p.patient_id, p.name FROM v_patients p LEFT JOIN v_claims c ON c.patient_id = p.patient_id
WHERE c.claim_id IS NULL""",
        _CLAIMS,
    ),
)
def rel_no_claims(t: Tables):
    return relational.patients_without_claims(t["v_patients"], t["v_claims"])


@plan(
    "rel_orphans",
    sql(
        """SELECT claim_id, patient_id, service, amount FROM v_claims
WHERE patient_id NOT IN (SELECT patient_id FROM v_patients)""",
        _CLAIMS,
    ),
)
def rel_orphans(t: Tables):
    return relational.orphan_claims(t["v_patients"], t["v_claims"])


@plan(
    "rel_duplicates",
    sql(
        """SELECT patient_id, service, amount, claim_date, count(*) AS n FROM v_claims
GROUP BY patient_id, service, amount, claim_date HAVING count(*) > 1""",
        ("v_claims",),
    ),
)
def rel_duplicates(t: Tables):
    return relational.duplicate_claims(t["v_claims"])


@plan("rel_invalid", sql("SELECT claim_id, service, amount FROM v_claims WHERE amount <= 0", ("v_claims",)))
def rel_invalid(t: Tables):
    return relational.invalid_amounts(t["v_claims"])


@plan(
    "rel_high_spend",
    sql(
        f"""SELECT p.state, round(sum(c.amount), 2) AS state_total
FROM v_claims c JOIN v_patients p ON p.patient_id = c.patient_id WHERE c.amount > 0
GROUP BY p.state HAVING sum(c.amount) > {HIGH_SPEND}""",
        _CLAIMS,
    ),
)
def rel_high_spend(t: Tables):
    return relational.high_spend_states(t["v_patients"], t["v_claims"], HIGH_SPEND)


@plan(
    "rel_constraints",
    sql(
        """SELECT 'not_null' AS "constraint", 'patient_id' AS "column", count(*) FILTER (WHERE patient_id IS NULL) AS n FROM v_claims
UNION ALL SELECT 'not_null', 'amount', count(*) FILTER (WHERE amount IS NULL) FROM v_claims
UNION ALL SELECT 'primary_key', 'claim_id', (count(claim_id) - count(DISTINCT claim_id)) FROM v_claims""",
        ("v_claims",),
    ),
)
def rel_constraints(t: Tables):
    return relational.constraint_violations(t["v_claims"], ["patient_id", "amount"], "claim_id")
