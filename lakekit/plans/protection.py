"""Row filter and column mask queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators import protect as pr
from lakekit.plans.registry import plan
from lakekit.session import Tables

_PEOPLE = """
p AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 16 = 0 THEN NULL ELSE 'user' || c_custkey || '@mail' || (c_custkey % 3) || '.example' END AS email, n_name AS country,
  '4000-1234-' || (1000 + c_custkey % 9000) AS card, '+1-555-' || (1000 + c_custkey % 9000) AS phone, c_acctbal AS salary FROM customer JOIN nation ON n_nationkey = c_nationkey)
"""
_P = "WITH " + _PEOPLE
_GRANTED = "country IN ('NATION_1', 'NATION_2', 'NATION_3')"


def people(t: Tables) -> DataFrame:
    located = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return located.selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_custkey % 16 = 0 THEN NULL ELSE concat('user', c_custkey, '@mail', c_custkey % 3, '.example') END AS email",
        "n_name AS country", "concat('4000-1234-', 1000 + c_custkey % 9000) AS card", "concat('+1-555-', 1000 + c_custkey % 9000) AS phone",
        "c_acctbal AS salary",
    )


def grants(t: Tables) -> DataFrame:
    """Who may see which country: the analyst nations 1 to 3, another user the rest."""
    return t.nation.selectExpr("CASE WHEN n_nationkey BETWEEN 1 AND 3 THEN 'analyst' ELSE 'other' END AS user", "n_name AS value")


ANALYST = pr.Principal("analyst", frozenset({"readers"}))
ADMIN = pr.Principal("boss", frozenset({"admins"}))


@plan(_P + f"SELECT 'analyst' AS who, id, country FROM p WHERE {_GRANTED} UNION ALL SELECT 'admin', id, country FROM p")
def g1_row_filter(t: Tables) -> DataFrame:
    out = None
    for who, principal in (("analyst", ANALYST), ("admin", ADMIN), ("stranger", pr.Principal("nobody"))):
        part = pr.row_filter(people(t), principal, grants(t), "country").select(F.lit(who).alias("who"), "id", "country")
        out = part if out is None else out.unionByName(part)
    return out


_MASKED = "id, left(email, 1) || '***@' || split_part(email, '@', 2) AS email, '****-' || right(card, 4) AS card, CAST(NULL AS DOUBLE) AS salary"
MASKS = {"email": pr.mask_email, "card": pr.mask_last4, "salary": pr.mask_null}


@plan(_P + f"SELECT {_MASKED} FROM p")
def g2_column_masks(t: Tables) -> DataFrame:
    return pr.mask_columns(people(t), ANALYST, MASKS).select("id", "email", "card", "salary")


@plan(_P + f"SELECT id, country, CASE WHEN {_GRANTED} THEN phone ELSE 'REDACTED' END AS phone FROM p")
def g3_mask_by_other_column(t: Tables) -> DataFrame:
    return pr.mask_unless_granted(people(t), ANALYST, "phone", pr.mask_redacted, "country", grants(t)).select("id", "country", "phone")


@plan(_P + f"SELECT {_MASKED} FROM p WHERE {_GRANTED}")
def g4_dynamic_view(t: Tables) -> DataFrame:
    seen = pr.row_filter(people(t), ANALYST, grants(t), "country")
    return pr.mask_columns(seen, ANALYST, MASKS).select("id", "email", "card", "salary")


@plan(_P + f"""
SELECT 'analyst' AS who, id, 'REDACTED' AS phone, CASE WHEN email IS NOT NULL THEN 'REDACTED' END AS email FROM p WHERE country <> 'NATION_7' UNION ALL SELECT 'auditor', id, phone, email FROM p WHERE country <> 'NATION_7'
""")
def g5_tag_policies(t: Tables) -> DataFrame:
    """Policies by tag: contact data is masked but for auditors, embargoed countries are hidden from everyone."""
    tags = {"email": ["contact"], "phone": ["contact"], "country": ["region"]}
    policies = [
        pr.Policy("contact", mask=pr.mask_redacted, exempt=frozenset({"auditors"})),
        pr.Policy("region", keep=lambda c, principal: c != "NATION_7"),
    ]
    out = None
    for who, groups in (("analyst", {"readers"}), ("auditor", {"auditors"})):
        seen = pr.apply_policies(people(t), tags, policies, pr.Principal(who, frozenset(groups)))
        part = seen.select(F.lit(who).alias("who"), "id", "phone", "email")
        out = part if out is None else out.unionByName(part)
    return out
