"""The whole conversion run (J36), step by step, as DataFrame jobs.

Order of the legacy procedure, except that junk rows are removed before the
snapshot diff (so an account that becomes junk is closed, F17). Frames that
many later steps read (ranked accounts, lookup, card holders, accounts) are
written as parquet tables to the session's shared checkpoint folder and read
back: that cuts the plan lineage, computes each once, and lets a lost
executor be recovered from files, not recomputed from the sources.

Inputs (role name -> DataFrame with the legacy columns):
  master, cards, balances, goals (optional), deposit_ids, deposit_usage,
  applications, fee_plans, states, pin_sets, status_history, materials,
  plastic_types, pans, legacy_mapping, card_requests, request_histories
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import exclude, incremental as inc, loads, lookup as lk, qualify
from ledgerloom.plans.runs import empty_targets
from ledgerloom.session import COMPACT, intermediate_tables, materialize, path_exists, touch
from ledgerloom.sources.schemas import TARGET_SCHEMAS


@dataclass
class RunResult:
    targets: dict[str, DataFrame]
    qualifying: DataFrame
    ranked: DataFrame
    lookup: DataFrame
    accounts_without_pan: DataFrame
    cardholders_without_pan: DataFrame
    delete_only_keys: DataFrame
    rejected: DataFrame
    accounts_to_close: DataFrame
    cards_delete_only_keys: DataFrame
    not_loaded: DataFrame
    report: DataFrame | None = None
    steps: list = field(default_factory=list)


class Steps:
    """The run's step tables: each is written once, when it is first asked
    for, and read back by whatever needs it.

    With a ``folder`` the tables are the run's step manifest: a step whose
    write committed there (``_SUCCESS``) is read instead of computed, so a
    retry of a broken run goes on where it stopped. ``homes``: the paths of
    steps that are outputs of the run as they are, and so are written there.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, homes: dict[str, str] | None = None):
        self.spark, self.folder, self.homes, self.made = spark, folder, homes or {}, {}

    def __call__(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.made:
            if self.folder is None:
                self.made[name] = materialize(build(), name)
            else:
                done = f"{self.folder}/{name}/_SUCCESS"
                path = self.homes.get(name, f"{self.folder}/{name}")
                if not path_exists(self.spark, done):
                    build().write.mode("overwrite").options(**COMPACT).parquet(path)
                    if name in self.homes:  # this attempt's, not an earlier run's
                        touch(self.spark, done)
                self.made[name] = self.spark.read.parquet(path)
        return self.made[name]

    def part(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A step that is rows of another step's table: read from there, not
        written again."""
        if name not in self.made:
            self.made[name] = build()
        return self.made[name]


#: Reported steps, in the order of the run.
STEPS = ("qualifying", "rejected", "accounts_to_close", "ranked", "lookup_added", "cardholders_added", "accounts_loaded",
         "qualifying_not_in_accounts", "delete_only_keys", "balances_loaded", "account_cardholders_added", "addresses_loaded",
         "emails_loaded", "phones_loaded", "cards_loaded", "cards_delete_only_keys", "card_numbers", "card_requests_added",
         "accounts_without_pan", "cardholders_without_pan")


class Conversion:
    """One run of the conversion; every step is computed on demand, once.

    Asking for one target runs the steps that it depends on and no others.
    ``late="load"``: accounts, balances, cards and contacts of keys that are
    not in their target yet are loaded even if their rows are older than the
    mark (an account may begin to qualify through another one of its person).
    ``late="report"`` keeps to the mark, as the legacy text does, and lists
    such accounts under ``qualifying_not_in_accounts``.
    """

    def __init__(self, inputs: dict[str, DataFrame], *, exp_date: str, as_of: str,
                 targets: dict[str, DataFrame] | None = None, previous_qualifying: DataFrame | None = None,
                 existing_lookup: DataFrame | None = None, full_reload: bool = False, late: str = "load",
                 steps: Steps | None = None, master_among: Callable[[DataFrame], DataFrame] | None = None,
                 rule_rows: DataFrame | None = None, columns: list[str] | None = None, whole: bool = True):
        if late not in ("load", "report"):
            raise ValueError(late)
        self.i, self.exp_date, self.as_of, self.late = inputs, exp_date, as_of, late
        spark = inputs["master"].sparkSession
        self.before = empty_targets(spark)
        given = targets if targets and not full_reload else {}
        self.before.update(given)
        # targets that nothing was loaded to yet: what the run loads is their
        # new state, written once, and every key is one that they lack
        self.new = {name for name in LOADED if name not in given}
        self.previous_qualifying, self.existing_lookup = previous_qualifying, existing_lookup
        # the master's columns that the ranked rows are read for (None: all);
        # whole: the qualifying and the rejected rows are asked for as they are
        self.master_among, self.columns, self.whole = master_among, columns, whole
        # a source that has the master's rule columns ready gives them
        self.rule_rows = inputs["master"].select(*qualify.RULE_COLUMNS) if rule_rows is None else rule_rows
        self.step = steps or Steps(spark)

    def _loaded(self, target: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The step of the rows that the run adds to ``target``."""
        if target not in self.new:
            return self.step(LOADED[target], build)
        none, key = self.before[target], BUCKET_KEYS[target]  # a merge puts the key first
        return self.step(LOADED[target], lambda: inc.append(none.select(key, *[c for c in none.columns if c != key]), build()))

    def _late(self, keys: DataFrame, target: str, column: str) -> DataFrame | bool | None:
        """Keys (one column) that ``target`` lacks, True for all of them; None
        where the mark alone decides."""
        if self.late == "report":
            return None
        if target in self.new:
            return True
        present = self.before[target].select(F.col(column).alias(keys.columns[0])).distinct()
        return keys.join(present, keys.columns[0], "left_anti")

    # qualification (J13-J15), cleaning (J17), closing dropped accounts

    @cached_property
    def rule_columns(self) -> DataFrame:
        """Of every master row the columns that the rules read, written once:
        the rules read them several times."""
        return materialize(self.rule_rows, "rule_columns")

    def _whole(self, kept: DataFrame) -> DataFrame:
        """The whole master rows of ``kept``. A source that has the rows of some
        keys ready (``master_among``) is asked for these; where every row of
        their keys is kept, that is all."""
        if self.master_among is None:
            return qualify.whole_rows(self.i["master"], kept)
        # written: read twice, and the wide rows meet it by its real size
        keys = materialize(kept.select("entryid").distinct(), "kept_keys")
        of_keys = self.rule_columns.select("entryid").join(
            keys.withColumnRenamed("entryid", "_kept"), F.col("entryid").eqNullSafe(F.col("_kept")), "left_semi")
        whole = self.master_among(keys)
        return whole if of_keys.count() == kept.count() else qualify.whole_rows(whole, kept)

    def qualified(self, ranked: bool = False) -> DataFrame:
        """The qualifying rows, junk among them; ``ranked``: with the contact
        rank of the rest, if the step is not written yet. Where whole rows and
        ranked rows of few columns are asked for, the ranks are taken on the
        latter, and the whole rows are not shuffled for them."""
        def build():
            rows = self.rule_columns
            q = qualify.qualify_accounts(rows, self.i["cards"], self.i["balances"], self.i.get("goals"),
                                         exp_date=self.exp_date, write=True)
            related = qualify.append_related(q.select(*qualify.KEPT_COLUMNS), rows, write=True)
            kept = materialize(qualify.drop_closed_zero(related, self.i["balances"]), "kept_rule_columns")
            whole = self._whole(kept)
            if self.columns is None:
                return qualify.rank_kept(whole, persons=kept) if ranked else whole
            if self.whole:
                return whole
            few = whole.select(*self.columns)
            return qualify.rank_kept(few, persons=kept) if ranked else few
        return self.step("qualified", build)

    def qualifying(self) -> DataFrame:
        qualified = self.qualified().drop("ContactRank")
        return self.step.part("qualifying", lambda: qualify.junk_filter(qualified)[0])

    def rejected(self) -> DataFrame:
        qualified = self.qualified().drop("ContactRank")
        return self.step.part("rejected", lambda: qualify.junk_filter(qualified)[1])

    def accounts_to_close(self) -> DataFrame:
        kept = self.qualifying()
        previous = kept.where(F.lit(False)) if self.previous_qualifying is None else self.previous_qualifying
        return self.step("accounts_to_close", lambda: qualify.snapshot_diff(previous, kept))

    # ranking (J18) and the deposit-id lookup

    def ranked(self) -> DataFrame:
        qualified, qualifying = self.qualified(ranked=True), self.qualifying()
        if "ContactRank" in qualified.columns:  # both sets of rows lie in one table
            return self.step.part("ranked", lambda: qualify.junk_filter(qualified)[0])
        few = qualifying if self.columns is None else qualifying.select(*self.columns)
        return self.step("ranked", lambda: qualify.contact_rank(few))

    def lookup_added(self) -> DataFrame:
        master = self.__dict__.get("rule_columns", self.i["master"])  # the keys alone are read

        def build():
            ids = self.i["deposit_ids"]
            if self.existing_lookup is None:
                return lk.best_id_lookup(master, ids, self.i["deposit_usage"])
            # most entries are in the lookup: only the ids of the others are
            # counted and ranked (a hot entry's are split by the skew join)
            present = self.existing_lookup.select("entryid").distinct()
            absent = materialize(master.select("entryid").distinct().join(present, "entryid", "left_anti"), "absent_entries")
            ids = ids.join(absent, ids["Entryid"] == absent["entryid"], "left_semi")
            return lk.best_id_lookup(absent, ids, self.i["deposit_usage"])
        return self.step("lookup_added", build)

    def lookup(self) -> DataFrame:
        new = self.lookup_added()
        return new if self.existing_lookup is None else self.existing_lookup.select(*lk.LOOKUP_COLUMNS).unionByName(new)

    # card holders

    def cardholders_added(self) -> DataFrame:
        return self._loaded("Cardholders", lambda: loads.load_cardholders(
            self.ranked(), self.i["applications"], self.before["Cardholders"]))

    def cardholders(self) -> DataFrame:
        if "Cardholders" in self.new:
            return self.cardholders_added()
        return self.step("cardholders", lambda: inc.append(self.before["Cardholders"], self.cardholders_added()))

    # accounts (J21, J22, J25): one key set for delete and insert

    @cached_property
    def mark(self):
        return inc.high_water_mark(self.before["Accounts"], "Modified")

    def accounts_loaded(self) -> DataFrame:
        late = self._late(self.ranked().select(F.col("entryid").alias("Id")), "Accounts", "Id")
        return self._loaded("Accounts", lambda: loads.load_accounts(
            self.ranked(), self.i["fee_plans"], self.lookup(), self.i["applications"], mark=self.mark, late=late))

    def _accounts_merge(self) -> tuple[DataFrame, DataFrame]:
        before, loaded = self.before["Accounts"], self.accounts_loaded()
        if self.previous_qualifying is not None:
            before = qualify.mark_closed(before, self.accounts_to_close())
        changed = inc.changed_since(self.i["master"], "LastUpdateDate", self.mark).select(F.col("entryid").alias("Id"))
        return inc.replace_changed(before, loaded, key="Id", changed_keys=changed)

    def accounts(self) -> DataFrame:
        if "Accounts" in self.new:
            return self.accounts_loaded()
        return self.step("accounts", lambda: self._accounts_merge()[0])

    def delete_only_keys(self) -> DataFrame:
        return self.step("delete_only_keys", lambda: self._accounts_merge()[1])

    def qualifying_not_in_accounts(self) -> DataFrame:
        return self.step("qualifying_not_in_accounts", lambda: self.ranked().select(F.col("entryid").alias("Id")).join(
            self.accounts().select("Id"), "Id", "left_anti"))

    # balances (J26): replace accounts whose balance moved past the mark

    def balances_loaded(self) -> DataFrame:
        before = self.before["AccountBalances"]
        mark = inc.high_water_mark(before, "EffectiveDate")
        late = self._late(self.accounts().select("Id"), "AccountBalances", "Id")
        return self._loaded("AccountBalances", lambda: loads.load_balances(
            self.accounts(), self.ranked(), self.i["balances"], before, mark=mark, as_of=self.as_of, late=late))

    def account_balances(self) -> DataFrame:
        # zero rows only go to accounts without any balance row, so deleting
        # every loaded id removes exactly the balances being refreshed
        rows = self.balances_loaded()
        return _replace(self.before["AccountBalances"], rows, "Id", rows)

    # account -> card holder mapping

    def account_cardholders_added(self) -> DataFrame:
        return self._loaded("AccountCardholders", lambda: loads.load_account_cardholders(
            self.accounts(), self.qualifying(), self.cardholders(), self.before["AccountCardholders"]))

    def account_cardholders(self) -> DataFrame:
        return inc.append(self.before["AccountCardholders"], self.account_cardholders_added())

    # contact rows of changed card holders are replaced

    def _new_cardholders(self) -> DataFrame | bool | None:
        if self.late == "report":
            return None
        return True if "Cardholders" in self.new else self.cardholders_added().select(F.col("Id").alias("CardHolder_Id"))

    def addresses_loaded(self) -> DataFrame:
        return self._loaded("Addresses", lambda: loads.load_addresses(
            self.cardholders(), self.ranked(), self.i["states"], mark=self.mark, late=self._new_cardholders()))

    def emails_loaded(self) -> DataFrame:
        return self._loaded("Emails", lambda: loads.load_emails(
            self.cardholders(), self.ranked(), mark=self.mark, late=self._new_cardholders()))

    def phones_loaded(self) -> DataFrame:
        return self._loaded("Phones", lambda: loads.load_phones(
            self.cardholders(), self.ranked(), mark=self.mark, late=self._new_cardholders()))

    def _contacts(self, target: str, rows: DataFrame) -> DataFrame:
        changed = self.step("changed_cardholders", lambda: loads.changed_cardholders(
            self.cardholders(), self.ranked(), mark=self.mark, late=self._new_cardholders()))
        return _replace(self.before[target], rows, "CardHolder_Id", changed)

    # cards (J30, J22): one key set for delete and insert, as for accounts; a
    # changed card whose account no longer qualifies stays and is reported

    @cached_property
    def cards_mark(self):
        return inc.high_water_mark(self.before["Cards"], "Modified")

    def cards_loaded(self) -> DataFrame:
        i = self.i
        late = self._late(i["cards"].select(F.col("cardid").alias("Id")), "Cards", "Id")
        return self._loaded("Cards", lambda: loads.load_cards(
            self.ranked(), i["legacy_mapping"], i["cards"], i["materials"], i["plastic_types"], i["fee_plans"],
            i["pin_sets"], i["status_history"], mark=self.cards_mark, late=late))

    def _cards_merge(self) -> tuple[DataFrame, DataFrame]:
        changed = inc.changed_since(self.i["cards"], "LastUpdateDate", self.cards_mark).select(F.col("cardid").alias("Id"))
        return inc.replace_changed(self.before["Cards"], self.cards_loaded(), key="Id", changed_keys=changed)

    def cards_delete_only_keys(self) -> DataFrame:
        return self.step("cards_delete_only_keys", lambda: self._cards_merge()[1])

    # card numbers (J31): full reload; card requests (J32): absent ones

    def card_numbers(self) -> DataFrame:
        return self.step("card_numbers", lambda: loads.load_card_numbers(
            self.i["legacy_mapping"], self.i["cards"], self.i["pans"]))

    def card_requests_added(self) -> DataFrame:
        def build():
            # already converted, or in this target
            done = self.i["request_histories"].select("id").unionByName(
                self.before["CardCreationHistories"].select(F.col("Id").alias("id")))
            return loads.load_card_requests(self.i["card_requests"], done, self.i["master"], self.i["legacy_mapping"],
                                            self.i["states"])
        return self._loaded("CardCreationHistories", build)

    # exclusions

    @cached_property
    def _exclusions(self) -> tuple[DataFrame, DataFrame]:
        return exclude.exclusions(self.ranked(), self.i["cards"], self.i["pans"], self.cardholders())

    def accounts_without_pan(self) -> DataFrame:
        return self.step("accounts_without_pan", lambda: self._exclusions[0])

    def cardholders_without_pan(self) -> DataFrame:
        return self.step("cardholders_without_pan", lambda: self._exclusions[1])

    # what the run leaves

    def target(self, name: str) -> DataFrame:
        """The new state of one target."""
        if name in self.new:
            return self.rows_of(LOADED[name])
        return {
            "Cardholders": self.cardholders, "Accounts": self.accounts, "AccountBalances": self.account_balances,
            "AccountCardholders": self.account_cardholders,
            "Addresses": lambda: self._contacts("Addresses", self.addresses_loaded()),
            "Emails": lambda: self._contacts("Emails", self.emails_loaded()),
            "Phones": lambda: self._contacts("Phones", self.phones_loaded()),
            "Cards": lambda: self._cards_merge()[0], "CardNumbers": self.card_numbers,
            "CardCreationHistories": lambda: inc.append(self.before["CardCreationHistories"], self.card_requests_added()),
        }[name]()

    def delta(self, name: str) -> tuple[DataFrame, DataFrame | None]:
        """The rows that the run adds to a target, and the keys (by the name of
        the target's key) whose rows it takes out first."""
        if name == "Accounts":
            # reloaded accounts, and the closed ones with their new status
            keys = self.accounts_loaded().select("Id").unionByName(
                self.accounts_to_close().select(F.col("entryid").alias("Id"))).distinct()
            return self.accounts().join(keys, "Id", "left_semi"), keys
        if name in ("Addresses", "Emails", "Phones"):
            rows = self.rows_of(f"{name.lower()}_loaded")
            self.target(name)
            return rows, self.step.made["changed_cardholders"]
        if name in ("AccountBalances", "Cards"):
            rows = self.rows_of("balances_loaded" if name == "AccountBalances" else "cards_loaded")
            return rows, rows.select("Id")
        return {"Cardholders": self.cardholders_added, "AccountCardholders": self.account_cardholders_added,
                "CardCreationHistories": self.card_requests_added}[name](), None

    def rows_of(self, step: str) -> DataFrame:
        return getattr(self, step)()

    def report(self) -> DataFrame:
        """Rows of each step; the steps are written tables, so this only counts."""
        self.ranked()  # before the rows that it is read with
        counts = [(name, self.rows_of(name).count()) for name in STEPS]
        return self.step.spark.createDataFrame(counts, "step string, rows bigint")


#: The step of the rows that a run adds to a target.
LOADED = {"Cardholders": "cardholders_added", "Accounts": "accounts_loaded", "AccountBalances": "balances_loaded",
          "AccountCardholders": "account_cardholders_added", "Addresses": "addresses_loaded", "Emails": "emails_loaded",
          "Phones": "phones_loaded", "Cards": "cards_loaded", "CardCreationHistories": "card_requests_added"}
TARGETS = ("Cardholders", "Accounts", "AccountBalances", "AccountCardholders", "Addresses", "Emails", "Phones", "Cards",
           "CardNumbers", "CardCreationHistories")
#: Where a target's rows go when it is kept in buckets.
BUCKET_KEYS = {name: "Id" for name in TARGETS} | {
    "AccountCardholders": "Account_id", "Addresses": "CardHolder_Id", "Emails": "CardHolder_Id", "Phones": "CardHolder_Id"}


def _replace(target: DataFrame, rows: DataFrame, key: str, doomed: DataFrame) -> DataFrame:
    kept = target.join(doomed.select(key).distinct(), key, "left_anti")
    return inc.append(kept, rows)


def run_conversion(inputs: dict[str, DataFrame], *, report: bool = True, **options) -> RunResult:
    """J36 (with J35 ``full_reload``): returns the new state of every target.
    ``options``: those of ``Conversion``."""
    run = Conversion(inputs, **options)
    run.ranked()  # before the rows that it is read with
    rows = {name: run.rows_of(name) for name in STEPS}
    return RunResult({name: run.target(name) for name in TARGETS}, rows["qualifying"], rows["ranked"], run.lookup(),
                     rows["accounts_without_pan"], rows["cardholders_without_pan"], rows["delete_only_keys"], rows["rejected"],
                     rows["accounts_to_close"], rows["cards_delete_only_keys"], rows["qualifying_not_in_accounts"],
                     run.report() if report else None, list(rows.items()))


#: Tables that a run commits beside the targets, and the step each is.
REPORTED = {"QualifyingAccounts": "qualifying", "AccountsWithoutPAN": "accounts_without_pan",
            "CardholdersWithoutPAN": "cardholders_without_pan", "AccountsToClose": "accounts_to_close",
            "RejectedAccounts": "rejected", "AccountsNotLoaded": "qualifying_not_in_accounts",
            "AccountsDeleteOnly": "delete_only_keys", "CardsDeleteOnly": "cards_delete_only_keys"}
#: Outputs that are a step's table as it is.
STEP_OUTPUTS = {"Cardholders": "cardholders", "Accounts": "accounts", "CardNumbers": "card_numbers"} | {
    name: step for name, step in REPORTED.items() if step not in ("qualifying", "rejected")}


#: The master's columns that junk and ranks are told by, and those that the
#: steps of an output read of ranked rows; other outputs may read every column.
_TOLD_BY = {"entryid", "ssn", "providerkey", "dob", *(c for c, _ in qualify.CONTACT_ORDER)}
_CARDHOLDER = {"clientkey", "created", "LastUpdateDate", "firstname", "lastname"}
_ACCOUNT = {"LastUpdateDate", "LastFeePlanChangeID", "clientkey"}
_CARD = {"ActiveCardID", "LastFeePlanChangeID"}
READS: dict[str, set[str]] = {
    "Cardholders": _CARDHOLDER, "Accounts": _ACCOUNT, "AccountBalances": _ACCOUNT | {"provideraccountID"},
    "AccountCardholders": _ACCOUNT | _CARDHOLDER,
    "Addresses": _CARDHOLDER | {"address1", "address2", "address3", "city", "state", "zip"},
    "Emails": _CARDHOLDER | {"email"}, "Phones": _CARDHOLDER | {"telephone", "celltel"},
    "Cards": _CARD, "CardNumbers": set(), "CardCreationHistories": set(), "DDID_Lookup": set(),
    "AccountsToClose": set(), "AccountsNotLoaded": _ACCOUNT, "AccountsDeleteOnly": _ACCOUNT, "CardsDeleteOnly": _CARD,
    "QualifyingAccounts": set(), "RejectedAccounts": set()}
#: Outputs of whole rows without ranks.
WHOLE = {"QualifyingAccounts", "RejectedAccounts"}


def columns_read(outputs: tuple[str, ...] | None) -> list[str] | None:
    """The master's columns that a run of these outputs reads of ranked rows; None: all."""
    if outputs is None or not set(outputs) <= set(READS):
        return None
    return sorted(_TOLD_BY.union(*(READS[name] for name in outputs)))


def commit_run(spark: SparkSession, inputs: dict[str, DataFrame], root: str, *, exp_date: str, as_of: str,
               run_id: str | None = None, full_reload: bool = False, late: str = "load", inputs_id: str = "",
               only: tuple[str, ...] | None = None, buckets: int | None = None,
               master_among: Callable[[DataFrame], DataFrame] | None = None,
               rule_rows: DataFrame | None = None) -> tuple[str, DataFrame]:
    """A run over ``inputs`` whose state comes from and goes to run directories.

    The current target state is the last complete run under ``root`` (none on
    a full reload; the deposit lookup and the qualifying snapshot are kept
    across reloads, as the legacy procedure did). Every target, the qualifying
    snapshot, the lookup, the exclusion lists, the accounts to close, rejected
    rows and the keys that were reported rather than loaded are written as run
    ``run_id``; the report (rows of every output and of every step) is written
    last and marks the run complete. Writing a finished run again takes its
    mark back first.

    Steps are kept under ``root`` until then: a retry of a run that broke off,
    with the same parameters and ``inputs_id``, reads those that committed.
    ``only``: commit these outputs alone (no report of the steps); for readers
    of few targets. ``buckets``: keep the targets in that many hashed buckets
    (``plans.buckets``; the same number in all runs), of which a run writes
    only those that it changes. ``master_among``: gives the master rows of
    the keys in a frame (``entryid``, each once), for a master with lookups;
    ``rule_rows``: all its rows, with ``qualify.RULE_COLUMNS`` alone.
    """
    from ledgerloom.plans import runs
    from ledgerloom.plans.buckets import BucketedTable

    run_id = run_id or runs.new_run_id()
    runs.reopen_run(spark, root, run_id)
    prev = runs.last_complete_run(spark, root, before=run_id)
    tables = {name: BucketedTable(spark, root, name, TARGET_SCHEMAS[name], key, buckets)
              for name, key in BUCKET_KEYS.items()} if buckets else {}
    targets, prev_q, prev_lookup = None, None, None
    if prev is not None:
        prev_q = runs.read_run(spark, root, "QualifyingAccounts", prev)
        prev_lookup = runs.read_run(spark, root, "DDID_Lookup", prev)
        if not full_reload:
            if buckets is None:
                targets = {name: runs.read_run(spark, root, name, prev) for name in runs.RELOADED_TARGETS}
            else:
                targets = {name: t.read(prev) if t.has(prev) else None for name, t in tables.items()}
            targets = {k: v for k, v in targets.items() if v is not None}
    # a step that is an output as it is is written once, as that output
    as_is = STEP_OUTPUTS if prev_lookup is not None else STEP_OUTPUTS | {"DDID_Lookup": "lookup_added"}
    as_is = as_is | {name: step for name, step in LOADED.items() if name not in (targets or {})}
    columns, whole = columns_read(only), only is None or not WHOLE.isdisjoint(only)
    homes = {step: runs.run_path(root, name, run_id) for name, step in as_is.items()
             if name not in tables and (only is None or name in only)}
    folder = runs.open_steps(spark, root, run_id, dict(
        exp_date=exp_date, as_of=as_of, full_reload=full_reload, late=late, previous=prev, inputs=inputs_id, columns=columns,
        whole=whole))
    with intermediate_tables(spark):  # deleted once the run has committed
        run = Conversion(inputs, exp_date=exp_date, as_of=as_of, targets=targets, previous_qualifying=prev_q,
                         existing_lookup=prev_lookup, full_reload=full_reload, late=late, steps=Steps(spark, folder, homes), master_among=master_among,
                         rule_rows=rule_rows, columns=columns, whole=whole)
        outputs: dict[str, Callable[[], DataFrame]] = {name: partial(run.target, name) for name in TARGETS}
        outputs |= {name: partial(run.rows_of, step) for name, step in REPORTED.items()}
        outputs["DDID_Lookup"] = run.lookup
        counts = []
        for name in only or outputs:
            if name in tables:
                table = tables[name]
                if targets is None or name not in targets or name == "CardNumbers":  # loaded whole
                    table.write(outputs[name](), run_id)
                else:
                    table.merge(prev, run_id, *run.delta(name))
                counts.append((name, table.read(run_id).count()))
                continue
            rows = outputs[name]()
            if as_is.get(name) not in homes:
                runs.write_run(rows, root, name, run_id)
            # counted from the written files, not by re-running the step
            counts.append((name, runs.read_run(spark, root, name, run_id).count()))
        report = spark.createDataFrame(counts, "step string, rows bigint")
        if only is None:
            report = report.unionByName(run.report())
        runs.write_run(report, root, runs.REPORT_TABLE, run_id)
    runs.close_steps(spark, root, run_id)
    return run_id, report


def run_job(spark, input_paths: dict[str, str], root: str, *, exp_date: str, as_of: str,
            run_id: str | None = None, full_reload: bool = False, late: str = "load",
            buckets: int | None = None, fmt: str = "parquet") -> tuple[str, DataFrame]:
    """``commit_run`` over inputs from paths, read with their declared schemas.
    Keys that must be unique are checked before anything is written."""
    from ledgerloom.operators.checks import check_unique
    from ledgerloom.sources.schemas import DECLARED_KEYS, read_role

    inputs = {role: read_role(spark, path, role, fmt) for role, path in input_paths.items()}
    for role, key in DECLARED_KEYS.items():
        repeated = check_unique(inputs[role], key).count()
        if repeated:  # the qualification and the merges rest on these keys
            raise ValueError(f"{repeated} values of {role}.{key} repeat")
    return commit_run(spark, inputs, root, exp_date=exp_date, as_of=as_of, run_id=run_id, full_reload=full_reload, late=late, buckets=buckets,
                      inputs_id=" ".join(f"{k}={v}" for k, v in sorted(input_paths.items())))
