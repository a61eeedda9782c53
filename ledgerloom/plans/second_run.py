"""Queries of a run that follows another.

Two snapshots of the sources (``sources.analogues``) are converted one after
the other through run directories: the first run commits its targets, the
second takes them, the marks, the deposit lookup and the qualifying snapshot
from there. Every query makes both runs itself, as far as its output needs.

The oracles nest the first run's SQL, over its own ``orders`` and
``lineitem``, in the second's.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import conversion, registry as R, runs
from ledgerloom.plans.buckets import BucketedTable
from ledgerloom.sources import analogues as A
from ledgerloom.sources.schemas import TARGET_SCHEMAS

FIRST, SECOND = "20010101T000000", "20010901T000000"
#: What the second run reads of the first for each output.
_STATE = {
    "Cardholders": ("Cardholders",),
    "Accounts": ("Accounts", "QualifyingAccounts", "DDID_Lookup"),
    "AccountBalances": ("Accounts", "AccountBalances", "QualifyingAccounts", "DDID_Lookup"),
    "AccountCardholders": ("Accounts", "AccountCardholders", "Cardholders", "QualifyingAccounts", "DDID_Lookup"),
    "Addresses": ("Accounts", "Addresses", "Cardholders"), "Emails": ("Accounts", "Emails", "Cardholders"),
    "Phones": ("Accounts", "Phones", "Cardholders"),
    "Cards": ("Cards",), "CardNumbers": (), "CardCreationHistories": ("CardCreationHistories",),
    "AccountsToClose": ("QualifyingAccounts",), "AccountsDeleteOnly": ("Accounts",), "CardsDeleteOnly": ("Cards",),
    "AccountsNotLoaded": ("Accounts",),
}


def _commit(snapshot: R.Tables, root: str, **options) -> tuple[str, DataFrame]:
    """One run over a snapshot."""
    return conversion.commit_run(snapshot.spark, A.conversion_inputs(snapshot), root, rule_rows=A.rule_rows(snapshot),
                                 master_among=partial(A.accounts_master, snapshot), **options)


def second_run(spark: SparkSession, sf_dir: str, output: str, late: str = "load", buckets: int | None = None) -> DataFrame:
    """One output of the second run, read from its committed directory (or buckets)."""
    root = f"{runs.default_root(spark)}/{uuid.uuid4().hex}"
    if _STATE[output]:
        _commit(A.FirstSnapshot(spark, sf_dir), root, exp_date=A.EXP_DATE, as_of=A.FIRST_AS_OF, run_id=FIRST, late=late,
                only=_STATE[output], buckets=buckets)
    _commit(A.SecondSnapshot(spark, sf_dir), root, exp_date=A.SECOND_EXP_DATE, as_of=A.AS_OF, run_id=SECOND, late=late,
            only=(output,), buckets=buckets)
    if buckets:
        return BucketedTable(spark, root, output, TARGET_SCHEMAS[output], conversion.BUCKET_KEYS[output], buckets).read(SECOND)
    return runs.read_run(spark, root, output, SECOND)


def second_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every step of the second run."""
    root = f"{runs.default_root(spark)}/{uuid.uuid4().hex}"
    _commit(A.FirstSnapshot(spark, sf_dir), root, exp_date=A.EXP_DATE, as_of=A.FIRST_AS_OF, run_id=FIRST,
            only=(*conversion.TARGETS, "QualifyingAccounts", "DDID_Lookup"))
    _, report = _commit(A.SecondSnapshot(spark, sf_dir), root, exp_date=A.SECOND_EXP_DATE, as_of=A.AS_OF, run_id=SECOND)
    return report.where(report["step"].isin(*conversion.STEPS))


# ---- oracles ---------------------------------------------------------------

_BEFORE = f"""orders AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{A.CHANGED_FROM}'),
lineitem AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{A.CHANGED_FROM}'),
"""
_CHANGED = f"o_orderdate < TIMESTAMP '{A.CHANGED_FROM}' AND o_totalprice <= {A.CHANGED_UP_TO}"
_AFTER = f"""orders AS (SELECT * REPLACE (
    CASE WHEN {_CHANGED} THEN TIMESTAMP '{A.CHANGED_AT}' ELSE o_orderdate END AS o_orderdate,
    CASE WHEN {_CHANGED} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN {_CHANGED} AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority)
  FROM orders),
"""


def _first(sql: str) -> str:
    """SQL of a full reload, over the first snapshot."""
    return sql.replace("WITH ", "WITH " + _BEFORE, 1).replace(A.AS_OF, A.FIRST_AS_OF)


_REAL_SECOND = R._RUN_SQL.replace(f"TIMESTAMP '{A.EXP_DATE}'", f"TIMESTAMP '{A.SECOND_EXP_DATE}'")
_REAL_SECOND = R._between(_REAL_SECOND, "ch_existing AS (", "ch_new AS (", "ch_existing AS (SELECT * FROM old_cardholders),\n")
_REAL_SECOND = R._between(_REAL_SECOND, "mark_acct AS (", "fee AS (", f"""mark_acct AS (
  SELECT coalesce({R._local('max("Modified")')}, TIMESTAMP '1900-01-01') AS m FROM old_accounts),
""")
_REAL_SECOND = R._between(_REAL_SECOND, "ddl AS (", "appmax AS (", """ddl AS (
  SELECT entryid, CAST("FullDepositID" AS VARCHAR) AS "FullDepositID" FROM old_lookup
  UNION ALL
  SELECT "Entryid", CAST("FullDepositID" AS VARCHAR) FROM best WHERE "Entryid" NOT IN (SELECT entryid FROM old_lookup)),
""")
# what the marks select, or what the targets lack
_REAL_SECOND = _REAL_SECOND.replace("accounts AS (\n  SELECT r.entryid", "fresh_accounts AS (\n  SELECT r.entryid").replace(
    'WHERE r."LastUpdateDate" > (SELECT m FROM mark_acct)),\nstates',
    'WHERE r."LastUpdateDate" > (SELECT m FROM mark_acct) OR r.entryid NOT IN (SELECT "Id" FROM old_accounts)),\nstates').replace(
    'WHERE r."LastUpdateDate" > (SELECT m FROM mark_acct)),\nlmap',
    'WHERE r."LastUpdateDate" > (SELECT m FROM mark_acct) OR ch."Id" NOT IN (SELECT "Id" FROM old_cardholders)),\nlmap')

_OLD = {
    "cardholders": R._TARGET_SQL["Cardholders"],
    "accounts": R._TARGET_SQL["Accounts"],
    "qualifying": R._STEP_SQL["qualifying"],
    "lookup": "WITH " + R._RUN_SQL + 'SELECT "Entryid" AS entryid, "FullDepositID" FROM best WHERE "Entryid" IN (SELECT mkey FROM mch)',
}
#: The second run's CTEs, then the accounts it leaves.
_LATER = _AFTER + _REAL_SECOND + """,
closing AS (SELECT entryid FROM old_qualifying WHERE entryid NOT IN (SELECT entryid FROM kept)),
accounts AS (
  SELECT * REPLACE (CASE WHEN "Id" IN (SELECT entryid FROM closing) THEN 40 ELSE "Status" END AS "Status") FROM old_accounts
  WHERE "Id" NOT IN (SELECT "Id" FROM fresh_accounts)
  UNION ALL SELECT * FROM fresh_accounts)
"""


def _load(name: str) -> str:
    """A load's own SQL (CTEs and select) over the chain's state."""
    text = R.ORACLE_SQL[name]
    return text[len("WITH " + R._LOAD_SQL):].strip()


def _with(ctes: str, select: str, **old: str) -> str:
    """The first run's state (and its targets ``old``) before the second run's
    ``orders`` stand for the table, then ``ctes`` and ``select``."""
    tables = _OLD | {name: R._TARGET_SQL[target] for name, target in old.items()}
    head = ",\n".join(f"old_{name} AS ({_first(sql)})" for name, sql in tables.items())
    return "WITH " + head + ",\n" + _LATER + (",\n" + ctes if ctes else "") + select


def _contacts(target: str, load: str) -> str:
    return _with("", f"""
SELECT * FROM old_rows WHERE "CardHolder_Id" NOT IN (SELECT "CardHolder_Id" FROM contact)
UNION ALL SELECT * FROM ({_load(load)})""", rows=target)


_BAL = _load("j26_load_balances").lstrip(",")
_BAL = R._between(_BAL, "bal_existing AS (", "mark_bal AS (", "bal_existing AS (SELECT * FROM old_balances),\n")
_BAL = _BAL.replace('AND b."TransactionTime" > (SELECT m FROM mark_bal)',
                    'AND (b."TransactionTime" > (SELECT m FROM mark_bal) OR a."Id" NOT IN (SELECT "Id" FROM old_balances))')
_head, _, _tail = _BAL.partition("acct_pk AS (")
_pk, _, _rest = _tail.partition("a.\"Id\")\n")
_BAL_CTES, _BAL_SELECT = _head + "acct_pk AS (" + _pk + "a.\"Id\")", _rest

_CARDS = _load("j30_load_cards").lstrip(", \n")
_card_ctes, _, _card_select = _CARDS.partition("IN (SELECT \"FeePlanChangeID\" FROM fee))\n")
_CARD_CTES = _card_ctes + """IN (SELECT "FeePlanChangeID" FROM fee)),
mark_card AS (SELECT coalesce(""" + R._local('max("Modified")') + """, TIMESTAMP '1900-01-01') AS m FROM old_cards),
fresh_cards AS (""" + _card_select + """ WHERE "LastUpdateDate" > (SELECT m FROM mark_card) OR cardid NOT IN (SELECT "Id" FROM old_cards))"""

_MERGED_BALANCES = _with(_BAL_CTES + ",\nfresh_balances AS (" + _BAL_SELECT + ")", """
SELECT * FROM old_balances WHERE "Id" NOT IN (SELECT "Id" FROM fresh_balances) UNION ALL SELECT * FROM fresh_balances""", balances="AccountBalances")
_MERGED_CARDS = _with(_CARD_CTES, """
SELECT * FROM old_cards WHERE "Id" NOT IN (SELECT "Id" FROM fresh_cards) UNION ALL SELECT * FROM fresh_cards""", cards="Cards")
_FRESH_MAPS = """SELECT DISTINCT a."Id" AS "Account_id", ch."Id" AS "Cardholder_id"
FROM accounts a JOIN kept q ON q.entryid = a."Id" JOIN cardholders ch ON ch."Ssn_Number" = q.ssn
WHERE a."Id" NOT IN (SELECT "Account_id" FROM old_maps)"""
_FRESH_REQUESTS = _load("j32_load_card_requests") + ' AND entryid NOT IN (SELECT "Id" FROM old_requests)'

SECOND_SQL = {
    "Cardholders": _with("", "SELECT * FROM cardholders"),
    "Accounts": _with("", "SELECT * FROM accounts"),
    "AccountBalances": _MERGED_BALANCES,
    "AccountCardholders": _with("", "\nSELECT * FROM old_maps UNION ALL " + _FRESH_MAPS, maps="AccountCardholders"),
    "Addresses": _contacts("Addresses", "j28_load_addresses"),
    "Emails": _contacts("Emails", "j29_load_emails"),
    "Phones": _contacts("Phones", "j29_load_phones"),
    "Cards": _MERGED_CARDS,
    "CardNumbers": _with("", _load("j31_load_card_numbers")),
    "CardCreationHistories": _with("", "\nSELECT * FROM old_requests UNION ALL " + _FRESH_REQUESTS, requests="CardCreationHistories"),
    "AccountsToClose": _with("", "SELECT * FROM closing"),
    "AccountsDeleteOnly": _with("", """SELECT entryid AS "Id" FROM acct WHERE "LastUpdateDate" > (SELECT m FROM mark_acct)
  AND entryid IN (SELECT "Id" FROM old_accounts) AND entryid NOT IN (SELECT "Id" FROM fresh_accounts)"""),
    "CardsDeleteOnly": _with(_CARD_CTES, """
SELECT cardid AS "Id" FROM ccards WHERE "LastUpdateDate" > (SELECT m FROM mark_card)
  AND cardid IN (SELECT "Id" FROM old_cards) AND cardid NOT IN (SELECT "Id" FROM fresh_cards)""", cards="Cards"),
}
#: With the marks alone, as the legacy text has it.
_LITERAL_LATE = _with("", """SELECT entryid AS "Id" FROM kept WHERE entryid NOT IN (SELECT "Id" FROM old_accounts)
  AND "LastUpdateDate" <= (SELECT m FROM mark_acct)""")

_STEPS_SQL = {
    "qualifying": _with("", "SELECT * FROM kept"),
    "rejected": _with("", "SELECT * FROM tagged WHERE reason IS NOT NULL"),
    "accounts_to_close": SECOND_SQL["AccountsToClose"],
    "ranked": _with("", "SELECT * FROM ranked"),
    "lookup_added": _with("", 'SELECT * FROM best WHERE "Entryid" IN (SELECT mkey FROM mch) AND "Entryid" NOT IN (SELECT entryid FROM old_lookup)'),
    "cardholders_added": _with("", "SELECT * FROM ch_new"),
    "accounts_loaded": _with("", "SELECT * FROM fresh_accounts"),
    "qualifying_not_in_accounts": _with("", "SELECT * FROM kept WHERE entryid NOT IN (SELECT \"Id\" FROM accounts)"),
    "delete_only_keys": SECOND_SQL["AccountsDeleteOnly"],
    "balances_loaded": _MERGED_BALANCES.rpartition("\nSELECT * FROM old_balances")[0] + " SELECT * FROM fresh_balances",
    "account_cardholders_added": _with("", "\n" + _FRESH_MAPS, maps="AccountCardholders"),
    "addresses_loaded": _with("", _load("j28_load_addresses")),
    "emails_loaded": _with("", _load("j29_load_emails")),
    "phones_loaded": _with("", _load("j29_load_phones")),
    "cards_loaded": _with(_CARD_CTES, " SELECT * FROM fresh_cards", cards="Cards"),
    "cards_delete_only_keys": SECOND_SQL["CardsDeleteOnly"],
    "card_numbers": SECOND_SQL["CardNumbers"],
    "card_requests_added": _with("", "\n" + _FRESH_REQUESTS, requests="CardCreationHistories"),
}
_EXCL = R._EXCL_SQL[len("WITH " + R._LOAD_SQL):].strip().lstrip(",")
_STEPS_SQL["accounts_without_pan"] = _with(_EXCL, """
SELECT * FROM ranked WHERE entryid IN (SELECT entryid FROM lacking) OR ssn IN (SELECT "Ssn_Number" FROM chwp)""")
_STEPS_SQL["cardholders_without_pan"] = _with(_EXCL, "SELECT * FROM chwp")


def _register(output: str, sql: str) -> None:
    @R.register(f"j36_second_{output.lower()}", sql)
    def query(spark, sf_dir):
        return second_run(spark, sf_dir, output)


for _output, _sql in SECOND_SQL.items():
    _register(_output, _sql)


@R.register("j36_second_not_loaded_literal", _LITERAL_LATE)
def not_loaded_literal(spark, sf_dir):
    """Accounts that began to qualify without a change of their own, which the marks alone pass over."""
    return second_run(spark, sf_dir, "AccountsNotLoaded", late="report")


R.register("j36_second_run", " UNION ALL ".join(
    f"SELECT '{step}' AS step, CAST(count(*) AS BIGINT) AS rows FROM ({sql})" for step, sql in _STEPS_SQL.items()))(second_report)


# ---- what changed between the snapshots, and the rules for that alone -------

from ledgerloom.operators import feed, requalify as rq  # noqa: E402

_CARD_COLUMNS = ["cardholderid", "expmonth", "expyear", "externalcardid", "LastUpdateDate", "CreateDate", "created", "IssueDate",
                 "nameoncard", "cardstatus", "IssuanceState", "MaterialID"]
_CARD_ROWS = "SELECT * FROM ccards"


@R.register("j16_change_feed", "WITH old_cards AS (" + _first("WITH " + R._LOAD_SQL + _CARD_ROWS) + "),\n" + _AFTER + R._LOAD_SQL
            + f""", both_ AS (
  SELECT n.cardid AS new_id, o.cardid AS old_id, o.* EXCLUDE (cardid),
         {", ".join(f'n."{c}" AS "n_{c}"' for c in _CARD_COLUMNS)}
  FROM old_cards o FULL JOIN ccards n ON n.cardid = o.cardid),
named AS (
  SELECT *, concat_ws(',', {", ".join(f"CASE WHEN \"{c}\" IS DISTINCT FROM \"n_{c}\" THEN '{c}' END" for c in _CARD_COLUMNS)}) AS names
  FROM both_)
SELECT coalesce(new_id, old_id) AS cardid,
       CASE WHEN old_id IS NULL THEN 'inserted' WHEN new_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
       CASE WHEN old_id IS NULL OR new_id IS NULL THEN '' ELSE names END AS changed_columns
FROM named WHERE old_id IS NULL OR new_id IS NULL OR names <> ''
""")
def change_feed(spark, sf_dir):
    """Cards inserted and changed between the snapshots, with the changed columns."""
    return feed.change_feed(A.cards(A.FirstSnapshot(spark, sf_dir)), A.cards(A.SecondSnapshot(spark, sf_dir)), "cardid")


@R.register("j13_requalify", "WITH " + _AFTER + R._RUN_SQL.replace(f"TIMESTAMP '{A.EXP_DATE}'", f"TIMESTAMP '{A.SECOND_EXP_DATE}'")
            + "SELECT * FROM qual")
def requalify(spark, sf_dir):
    """Qualifying accounts of the second snapshot (J13-J15), from the first one's and the changes."""
    before = A.conversion_inputs(A.FirstSnapshot(spark, sf_dir))
    after = A.conversion_inputs(A.SecondSnapshot(spark, sf_dir))
    for name, inputs in (("before", before), ("after", after)):  # the rules and the comparison read the master several times
        inputs["master"] = R.materialize(inputs["master"], f"master_{name}")
    state = R.materialize(rq.qualification(before["master"], before["cards"], before["balances"], before["goals"],
                                           exp_date=A.EXP_DATE), "qualification")
    state = rq.requalify(state, after["master"], after["cards"], after["balances"], after["goals"],
                         changed=rq.source_changes(before, after), exp_date=A.SECOND_EXP_DATE, previous_exp_date=A.EXP_DATE)
    return rq.qualifying(state)


# ---- targets in buckets -----------------------------------------------------

@R.register("j36_second_accounts_bucketed", SECOND_SQL["Accounts"])
def accounts_bucketed(spark, sf_dir):
    """The accounts after both runs, kept in buckets: reloaded and closed accounts' buckets are written again."""
    return second_run(spark, sf_dir, "Accounts", buckets=16)


@R.register("j22_replace_changed_bucketed", R.ORACLE_SQL["j22_replace_changed"])
def bucketed(spark, sf_dir):
    """J22 on a table in hashed buckets: the touched ones alone are written."""
    t = R.Tables(spark, sf_dir)
    rows, target = A.reloaded_accounts(t), A.existing_accounts(t)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in target.schema.fields)
    table = BucketedTable(spark, f"{runs.default_root(spark)}/{uuid.uuid4().hex}", "Accounts", schema, "Id", 32)
    table.write(target, FIRST)
    table.merge(FIRST, SECOND, rows, rows.select("Id"))
    return table.read(SECOND)
