"""Queries of results that are kept up to date, and of checks between tables:
ranks of changed groups (J09, J18), a flat target that takes new columns (J05,
J06), keys and references (J37, S10), salted joins (J01), marks inside the
autumn overlap (J21), persons compared as text (J14)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import code_maps as cm
from ledgerloom.functions.exprs import ntz
from ledgerloom.operators import checks, flatten, incremental as inc, prune, qualify, rerank
from ledgerloom.plans import conversion, registry as R, runs
from ledgerloom.plans.growing import GrowingTable
from ledgerloom.plans.second_run import _AFTER
from ledgerloom.session import materialize
from ledgerloom.sources import analogues as A
from ledgerloom.sources.schemas import TARGET_KEYS, TARGET_REFERENCES
from ledgerloom.sources.tables import Tables

# ---- ranks of changed groups ------------------------------------------------


@R.register("j18_contact_rank_incremental", "WITH " + _AFTER + R._ACCT_SQL + "SELECT * FROM ranked")
def j18_incremental(spark, sf_dir):
    """Contact ranks of the second snapshot from the first one's: the persons
    whose accounts changed are ranked again."""
    before = materialize(R._kept(A.FirstSnapshot(spark, sf_dir)), "accounts_before")
    after = materialize(R._kept(A.SecondSnapshot(spark, sf_dir)), "accounts_after")
    return rerank.contact_rerank(qualify.contact_rank(before), before, after)


@R.register("j09_usage_rank_incremental", R._J09_SQL)
def j09_incremental(spark, sf_dir):
    """Ranks of all deposit ids from those of the first snapshot: entries that
    have new rows or ids, or an id that was used since, are ranked again."""
    before, after = R._deposits(A.FirstSnapshot(spark, sf_dir)), R._deposits(Tables(spark, sf_dir))
    return rerank.usage_rerank(prune.usage_rank(*before), before, after)


# ---- a flat target that takes new columns -----------------------------------

_EVENT_COLUMNS = "id bigint, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"


@R.register("j05_category_flatten_growing", f"""
    SELECT * REPLACE (CASE WHEN o_orderdate < TIMESTAMP '{A.NEW_EVENTS_FROM}' THEN 0 ELSE "{R._TARGET_WITHOUT}" END AS "{R._TARGET_WITHOUT}")
    FROM ({R._FLAT_SQL}) f""")
def j05_growing(spark, sf_dir):
    """A target without one of the categories takes it with the new events; old rows have 0."""
    t = Tables(spark, sf_dir)
    known = [c for c in flatten.category_domain(R._expanded(t)) if c != R._TARGET_WITHOUT]
    table = GrowingTable(spark, f"{runs.default_root(spark)}/{uuid.uuid4().hex}", "Flat", _EVENT_COLUMNS)
    table.append(A.flattened_target(t, known), "20010101T000000")
    fresh = flatten.category_flatten_incremental(A.events(t), A.event_categories(t), A.categories(t), table.read(),
                                                 on_new_category="grow")
    table.append(fresh, "20010901T000000")
    return table.read()


_GONE = ["DISCONTINUED", "WITHDRAWN"]


@R.register("j06_category_drift_both", f"""
    SELECT p_type AS "Category", CAST(count(*) AS BIGINT) AS n_rows, 'not_in_target' AS direction
    FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders) AND p_type = '{R._TARGET_WITHOUT}' GROUP BY p_type
    UNION ALL SELECT unnest({_GONE}), 0, 'not_in_data'
""")
def j06_both(spark, sf_dir):
    """Drift in both directions: the target lacks a category and has two that went."""
    expanded = R._expanded(Tables(spark, sf_dir))
    known = [c for c in flatten.category_domain(expanded) if c != R._TARGET_WITHOUT]
    return flatten.category_drift(expanded, known + _GONE)


# ---- keys and references ----------------------------------------------------

@R.register("j37_check_unique_sketched", """
SELECT l_orderkey, l_partkey, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1
""")
def j37_sketched(spark, sf_dir):
    """A key that rarely repeats: digests first, then the possible repeats."""
    return checks.check_unique_sketched(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_partkey"])


@R.register("j37_target_keys", R._J22_CTES + """
SELECT 'Accounts' AS "table", 'Id' AS key, CAST("Id" AS VARCHAR) AS value, CAST(2 AS BIGINT) AS n_rows
FROM tgt WHERE "Id" IN (SELECT "Id" FROM ins)
""")
def j37_target_keys(spark, sf_dir):
    """The declared key of a target that was appended to without the delete of J22."""
    t = Tables(spark, sf_dir)
    return checks.check_keys({"Accounts": inc.append(A.existing_accounts(t), A.reloaded_accounts(t))}, TARGET_KEYS)


#: The targets that a declared reference leaves from or leads to.
_LINKED = tuple(n for n in conversion.TARGETS if any(n in (child, parent) for child, _, parent, _ in TARGET_REFERENCES))


@R.register("j37_target_references", "WITH " + ",\n".join(f"t_{n.lower()} AS ({R._TARGET_SQL[n]})" for n in _LINKED) + " UNION ALL ".join(f"""
SELECT '{child}' AS child, '{column}' AS column, '{parent}' AS parent, CAST("{column}" AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n_rows
FROM t_{child.lower()} WHERE "{column}" NOT IN (SELECT "{key}" FROM t_{parent.lower()}) GROUP BY "{column}"
""" for child, column, parent, key in TARGET_REFERENCES))
def j37_target_references(spark, sf_dir):
    """Every declared reference between the targets of a full reload: cards of
    accounts that do not qualify are orphans."""
    run = R._full_reload(spark, sf_dir)
    # each target is the table of a step, written once
    return checks.check_references({name: run.target(name) for name in _LINKED}, TARGET_REFERENCES, missing="fail")


# ---- salted joins -----------------------------------------------------------

@R.register("j01_bridge_expand_salted", R._EXPANDED_SQL)
def j01_salted(spark, sf_dir):
    """J01 with parts of more than 33 line items, and orders too, as hot keys."""
    t = Tables(spark, sf_dir)
    return flatten.bridge_expand(A.events(t), A.event_categories(t), A.categories(t), hot_rows=33)


# ---- marks inside the autumn overlap ------------------------------------------

#: Marks (UTC) on the day the clocks of the legacy zone turn back: before the
#: overlap, in its first and second pass, after it.
_MARKS = {"before": "2001-10-28 04:30:00", "first": "2001-10-28 05:30:00", "second": "2001-10-28 06:30:00", "after": "2001-10-28 08:15:00"}
#: The same as local conditions.
_LOCAL = {"before": "> TIMESTAMP '2001-10-28 00:30:00'", "first": ">= TIMESTAMP '2001-10-28 01:00:00'",
          "second": "> TIMESTAMP '2001-10-28 01:30:00'", "after": "> TIMESTAMP '2001-10-28 03:15:00'"}


def turning_day(t: Tables) -> DataFrame:
    """Orders as changes of that day, from midnight to four o'clock by the wall clock."""
    second = F.pmod(F.col("o_orderkey") * 37, F.lit(14400)).cast("int")
    at = ntz("2001-10-28 00:00:00") + F.make_dt_interval(secs=second)
    return t.orders.select("o_orderkey", at.alias("LastUpdateDate"))


@R.register("j21_changed_since_overlap", " UNION ALL ".join(f"""
SELECT o_orderkey, moment AS "LastUpdateDate", '{name}' AS mark
FROM (SELECT o_orderkey, TIMESTAMP '2001-10-28 00:00:00' + to_seconds(o_orderkey * 37 % 14400) AS moment FROM orders) WHERE moment {test}
""" for name, test in _LOCAL.items()))
def j21_overlap(spark, sf_dir):
    """What may have changed after marks on both sides of the overlap and in it."""
    rows = turning_day(Tables(spark, sf_dir))
    return reduce(DataFrame.unionByName, [
        inc.changed_since_utc(rows, "LastUpdateDate", mark, zone=cm.LEGACY_ZONE).withColumn("mark", F.lit(name))
        for name, mark in _MARKS.items()])


# ---- persons compared as text ---------------------------------------------------

@R.register("j14_append_related_text", "WITH " + R._CM_SQL + f", q AS ({R._J13_SQL})" + """
SELECT * REPLACE ('p' || ssn AS ssn) FROM q UNION ALL
SELECT m.* REPLACE ('P' || m.ssn || '  ' AS ssn) FROM cm m WHERE m."AccountTypeId" = 2 AND trim(m.ssn) IN (SELECT trim(ssn) FROM q)
  AND m.entryid NOT IN (SELECT entryid FROM q)
""")
def j14_text(spark, sf_dir):
    """The second accounts spell the person in capitals and with trailing blanks."""
    t = Tables(spark, sf_dir)
    first = R._qualified(t).withColumn("ssn", F.concat(F.lit("p"), "ssn"))
    other = A.customer_master(t).withColumn("ssn", F.concat(F.lit("P"), "ssn", F.lit("  ")))
    return qualify.append_related(first, other, as_text=True, fold=True)
