"""Deterministic analogs of the warehouse sources, derived from the landed test tables.

Each property returns a lazy DataFrame.  The definitions follow the data specification of the fixtures
(``FIXTURES.md``); the DuckDB oracle embeds the same specification as SQL CTEs (``trestle.oracle.fixtures``).
Everything is a narrow projection over one base table, so every analog scales linearly with its base table
and Catalyst prunes the columns a pipeline does not read.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.functions.dates import month_floor
from trestle.operators.aggregates import dealt
from trestle.plans.form_maps import (INCIDENT_COLUMNS, OPPORTUNITY_BOOLEANS, OPPORTUNITY_COLUMNS, OPPORTUNITY_NUMBERS,
                                     OPPORTUNITY_TIMES, OSHA_COLUMNS, PRACTICE_AREA_COLUMNS)


def _cents(c: Column) -> Column:
    return F.floor(c).cast("bigint")


def _lpad_num(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _add_days(d: Column, n: Column) -> Column:
    return F.date_add(d, n.cast("int"))


class Analogs:
    def __setattr__(self, name, value):
        """A source set by hand: what is landed from now on belongs to these tables alone, not to their folder."""
        object.__setattr__(self, name, value)
        if name in SOURCES:
            self.t.__dict__["scope"] = f"{self.t.scope}+{uuid.uuid4().hex}"

    def __init__(self, tables):
        self.t = tables

    # --- general ledger and job cost -------------------------------------------------------------------------
    @cached_property
    def dept(self) -> DataFrame:
        n = self.t("nation")
        region = (F.when(n.n_regionkey == 0, "Midwest").when(n.n_regionkey == 1, "Great Lakes")
                  .when(n.n_regionkey == 2, "Mid-Atlantic").when(n.n_regionkey == 3, "Central").otherwise("West"))
        market = (F.when(n.n_nationkey % 4 == 0, "EDU").when(n.n_nationkey % 4 == 1, "HC")
                  .when(n.n_nationkey % 4 == 2, "IND").otherwise("Water"))
        return n.select(
            _lpad_num((n.n_regionkey + 1) * 200 + (n.n_nationkey % 4 + 1) * 10, 4).alias("department"),
            (n.n_nationkey % 3 + 1).cast("string").alias("glco"),
            F.concat(F.lit("Region - "), region, F.lit(" "), market).alias("description"),
        )

    @cached_property
    def gl(self) -> DataFrame:
        li = self.t("lineitem")
        ln = li.l_linenumber
        part1 = (F.when(ln == 1, "41010").when(ln == 2, "41030").when(ln == 3, "51000").when(ln == 4, "61000")
                 .when(ln == 5, "81000").when(ln == 6, "11050").otherwise("88200"))
        part2 = F.when(li.l_suppkey % 5 == 0, "0000").otherwise(
            _lpad_num((li.l_suppkey % 5) * 200 + (li.l_suppkey % 4 + 1) * 10, 4))
        o4 = li.l_orderkey % 4
        part3 = F.when(o4 == 0, "300").when(o4 == 1, "004").when(o4 == 2, "311").otherwise("000")
        return li.select(
            (li.l_partkey % 140 + 1).cast("string").alias("glco"),
            part1.alias("part1"), part2.alias("part2"), part3.alias("part3"),
            month_floor(li.l_shipdate).alias("mth"),
            (_cents(li.l_extendedprice * 100) * F.when(ln <= 2, -1).otherwise(1)).alias("netamt_cents"),
            F.when(ln % 3 == 0, "GJ").when(ln % 3 == 1, " AP").otherwise("AR ").alias("jrnl"),
            F.concat(F.lit(" "), (li.l_orderkey % 1000).cast("string")).alias("glref"),
            (li.l_partkey % 7 + 1).cast("string").alias("sourceco"),
            F.when(ln % 2 == 0, "GL Entry").otherwise("JC Detail").alias("source"),
            F.when(li.l_orderkey % 50 == 0, "Y").otherwise("N").alias("adjust"),
            F.when(li.l_orderkey % 90 == 0, "Y").otherwise("N").alias("purge"),
        )

    @cached_property
    def budget(self) -> DataFrame:
        li = self.t("lineitem")
        ln = li.l_linenumber
        part1 = F.when(ln == 1, "41010").when(ln == 2, "51000").otherwise("61000")
        o7 = li.l_orderkey % 7
        suffix = (F.when(o7 == 0, " FC9").when(o7 == 1, " FC10").when(o7 == 2, " FC2.6").when(o7 == 3, " FC3.1")
                  .when(o7 == 4, " FC1").when(o7 == 5, " FC2").otherwise(" BASE"))
        return li.select(
            (li.l_partkey % 140 + 1).cast("string").alias("gl_co"),
            F.concat(part1, F.lit("."), _lpad_num((li.l_suppkey % 5) * 200 + 10, 4)).alias("gl_account"),
            F.concat((F.year(li.l_shipdate) - li.l_orderkey % 2).cast("string"), suffix).alias("budget_code"),
            month_floor(li.l_shipdate).alias("mth"),
            _cents(li.l_extendedprice * 100).alias("budget_cents"),
        )

    @cached_property
    def job_cost(self) -> DataFrame:
        li = self.t("lineitem")
        p20 = li.l_partkey % 20
        job = F.concat((li.l_suppkey % 40 + 123000).cast("string"), F.lit("."))    # even ones are padded
        phase_head = F.when(p20 == 0, 96).when(p20 == 1, 80).otherwise(p20)
        price_cents = _cents(li.l_extendedprice * 100)
        return li.select(
            (li.l_linenumber % 2 + 1).cast("string").alias("jcco"),
            F.when(li.l_suppkey % 2 == 0, F.concat(F.lit(" "), job, F.lit(" "))).otherwise(job).alias("job"),
            F.lit("1").alias("phase_group"),
            F.concat(_lpad_num(phase_head, 2), F.lit("1000.90"), (li.l_partkey % 9).cast("string"), F.lit("."))
            .alias("phase"),
            (li.l_linenumber % 4 + 1).cast("string").alias("cost_type"),
            F.when(li.l_returnflag == "A", "OE").when(li.l_returnflag == "R", "CO").otherwise("PF").alias("trans_type"),
            month_floor(li.l_shipdate).alias("mth"),
            F.to_date(li.l_shipdate).alias("actual_date"),
            price_cents.alias("est_cents"),
            (price_cents + li.l_partkey).alias("proj_cents"),
            F.when(li.l_linestatus == "O", F.lit(0).cast("bigint"))
            .otherwise(_cents(li.l_extendedprice * 50)).alias("actual_cents"),
            F.when(li.l_linenumber == 3, _cents(li.l_extendedprice * 70))
            .otherwise(F.lit(0).cast("bigint")).alias("committed_cents"),
        )

    @cached_property
    def contract(self) -> DataFrame:
        s = self.t("supplier")
        base = F.lit("1996-01-01").cast("date")
        first = F.when(s.s_suppkey % 10 == 0, F.lit("1980-01-01").cast("date")).otherwise(base)   # some run very long
        return s.select(
            (s.s_suppkey % 2 + 1).cast("string").alias("jcco"),
            F.concat((s.s_suppkey + 123000).cast("string"), F.lit(".")).alias("contract"),
            s.s_name.alias("description"),
            F.when(s.s_suppkey % 3 == 0, F.lit(None).cast("date"))
            .otherwise(_add_days(base, s.s_suppkey % 900)).alias("owner_contract_date"),
            _add_days(first, s.s_suppkey % 700).alias("start_date"),
            _cents(s.s_acctbal * 1000).alias("orig_contract_cents"),
            (_cents(s.s_acctbal * 1000) + s.s_suppkey * 700).alias("contract_cents"),
            F.when(s.s_suppkey % 4 == 1, _add_days(F.lit("2001-01-01").cast("date"), s.s_suppkey % 90))
            .alias("actual_close_date"),
            F.when(s.s_suppkey % 8 == 3, F.lit("2001-03-01").cast("date")).alias("month_closed"),
            s.s_nationkey.alias("customer"),
            (s.s_suppkey % 3).cast("int").alias("contract_status"),
            (_cents(s.s_acctbal * 1000) * 3).alias("received_cents"),
        )

    @cached_property
    def account(self) -> DataFrame:
        """Accounts of the ledger and of the budget; some companies lack the overhead accounts."""
        full = F.concat_ws(".", "part1", "part2", "part3")
        ledger = self.gl.select("glco", full.alias("glacct"), "part1", "part2", "part3")
        part = F.split("gl_account", "[.]")
        budget = self.budget.select(F.col("gl_co").alias("glco"), F.col("gl_account").alias("glacct"), part[0].alias("part1"),
                                    part[1].alias("part2"), F.lit("").alias("part3"))
        kind = F.when(F.left("part1", F.lit(1)) == "4", "I").when(F.left("part1", F.lit(1)) == "1", "A").otherwise("E")
        a = ledger.union(budget).distinct()
        a = a.filter(~((F.col("part1") == "61000") & (F.col("glco").cast("int") % 13 == 0)))
        return a.select("*", F.concat(F.lit("Account "), "glacct").alias("description"), kind.alias("acct_type"))

    @cached_property
    def budget_code(self) -> DataFrame:
        b = self.budget.select(F.col("gl_co").alias("glco"), "budget_code").distinct()
        return b.filter(F.col("glco").cast("int") % 11 != 0).select("*", F.concat(F.lit("Budget "), "budget_code").alias("description"))

    @cached_property
    def phase_name(self) -> DataFrame:
        """Names of the phases of a job; general conditions (80) have none."""
        p = self.job_cost.select("jcco", "job", "phase_group", "phase").distinct()
        return p.filter(~F.col("phase").startswith("80")).select("*", F.concat(F.lit("Phase "), F.left("phase", F.lit(6))).alias("description"))

    @cached_property
    def cost_type(self) -> DataFrame:
        """Names of the cost types that the ledger uses, but for the last."""
        c = self.job_cost.select("phase_group", "cost_type").distinct()
        k = F.col("cost_type")
        return c.filter(k != "4").select("*", F.when(k == "1", "Labor").when(k == "2", "Material").otherwise("Subcontract").alias("name"))

    @cached_property
    def change_item(self) -> DataFrame:
        o = self.t("orders")
        return o.select(
            o.o_orderkey.alias("key_id"),
            (o.o_custkey % 2 + 1).cast("string").alias("jcco"),
            F.concat((o.o_custkey % 100 + 123000).cast("string"), F.lit(".")).alias("project"),
            F.when(o.o_orderstatus == "F", "Y").when(o.o_orderstatus == "O", "N").alias("approved"),
            F.concat(F.lit("A"), (o.o_orderkey % 97).cast("string")).alias("aco"),
            F.floor(o.o_orderkey / 97).cast("bigint").alias("aco_item"),
            F.to_date(o.o_orderdate).alias("approved_date"),
            _cents(o.o_totalprice * 100).alias("approved_cents"),
            _cents(o.o_totalprice * 40).alias("pending_cents"),
            _cents(o.o_totalprice * 90).alias("fixed_cents"),
        )

    @cached_property
    def posted_item(self) -> DataFrame:
        """Posted change items: a third of the owner change items, under keys of their own."""
        o = self.t("orders")
        return (o.filter(o.o_orderkey % 3 == 0)
                .select((o.o_orderkey * 10 + 7).alias("key_id"),
                        (o.o_custkey % 2 + 1).cast("string").alias("jcco"),
                        F.concat((o.o_custkey % 100 + 123000).cast("string"), F.lit(".")).alias("job"),
                        F.concat(F.lit("A"), (o.o_orderkey % 97).cast("string")).alias("aco"),
                        F.floor(o.o_orderkey / 97).cast("bigint").alias("aco_item"),
                        month_floor(o.o_orderdate).alias("approved_month")))

    @cached_property
    def override(self) -> DataFrame:
        jc = self.job_cost
        return (jc.filter((jc.trans_type == "CO") & jc.phase.startswith("05"))
                .groupBy("jcco", F.trim(jc.job).alias("contract"), "mth")
                .agg(F.sum("est_cents").alias("_est"), F.sum("proj_cents").alias("_proj"))
                .select("jcco", "contract", "mth",
                        (F.col("_est") - F.col("_est") % 1000).alias("proj_revenue"),
                        F.when(F.month("mth") % 4 == 0, F.col("_proj") + 1000).otherwise(0).alias("proj_over_cost"),
                        F.when(F.month("mth") == 6, F.col("_est") - F.col("_est") % 7).alias("actual_cost")))

    # --- schedule snapshots ----------------------------------------------------------------------------------
    WEEKS = 8
    #: Added to the numbers of baseline projects, so they never meet those of current projects.
    BASELINE = 1_000_000_000
    FIRST_WEEK = "1999-01-01"

    @property
    def _n_projects(self) -> Column:
        return self.t("customer").select(F.count(F.lit(1))).scalar()

    @cached_property
    def task(self) -> DataFrame:
        """Task snapshots: every order is a task in each of 8 weekly snapshots, once current, once baseline.

        Tasks are spread over all projects (one per customer) by the order number.

        The 16 (week, offset) copies are generated per row with ``explode`` (no join, no shuffle).
        """
        o = self.t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("od"))
        first = F.lit(self.FIRST_WEEK).cast("date")
        copies = F.explode(F.array(*[
            F.struct(F.date_add(first, 7 * k).alias("start_week"), F.lit(off).cast("bigint").alias("off"))
            for off in (0, self.BASELINE) for k in range(self.WEEKS)
        ]))
        x = o.select("o_orderkey", "od", copies.alias("c")).select("o_orderkey", "od", "c.start_week", "c.off")
        k = x.o_orderkey
        current = x.off == 0
        end90 = _add_days(x.od, k % 90)
        k40 = k % 40
        k25 = k % 25
        return x.select(
            (k % self._n_projects + x.off).alias("proj_id"),
            (k + x.off * 1000).alias("task_id"),
            F.concat(F.lit("T"), k.cast("string")).alias("task_code"),
            "start_week",
            F.when(k40 == 0, "TT_Mile").when(k40 == 1, "TT_FinMile").when(k40 == 2, "TT_LOE")
            .otherwise("TT_Task").alias("task_type"),
            F.when(k40 <= 1, 1).otherwise(2).alias("wbs_id"),
            F.when(current & (x.od <= x.start_week), x.od).alias("act_start_date"),
            F.when(current & (end90 <= x.start_week), end90).alias("act_end_date"),
            _add_days(x.od, k % 85).alias("target_end_date"),
            end90.alias("early_end_date"),
            F.when(k25 == 0, "CS_MEO").when(k25 == 1, "CS_MSO").when(k25 == 2, "CS_MSOA").alias("cstr_type"),
            (k % 600 - 120).alias("total_float_hr_cnt"),
            ((k % 30) * 8).alias("target_drtn_hr_cnt"),
        )

    @cached_property
    def task_tag(self) -> DataFrame:
        t = self.task
        return t.filter(t.task_id % 11 == 0).select("proj_id", "task_id", "start_week",
                                                    F.lit("OFG").alias("short_name"))

    @cached_property
    def task_pred(self) -> DataFrame:
        li = self.t("lineitem")
        ln = li.l_linenumber
        m4 = ln % 4
        n = self._n_projects
        return (li.filter((li.l_orderkey % 3 != 0) & (li.l_orderkey >= n * ln))
                .select((li.l_orderkey % n).alias("proj_id"),
                        li.l_orderkey.alias("task_id"),
                        (li.l_orderkey - n * ln).alias("pred_task_id"),
                        (li.l_orderkey * 10 + ln).alias("task_pred_id"),
                        F.when(m4 == 0, "PR_SS").when(m4 == 1, "PR_FS").when(m4 == 2, "PR_FF")
                        .otherwise("PR_SF").alias("pred_type"),
                        (li.l_quantity.cast("int") % 7 - 2).alias("lag_hr_cnt")))

    @cached_property
    def project(self) -> DataFrame:
        c = self.t("customer")
        number = c.c_custkey % self._n_projects
        return (c.select(number.alias("proj_id"),
                         (number + self.BASELINE).alias("baseline_proj_id"),
                        F.concat(F.lit("P"), c.c_custkey.cast("string")).alias("proj_name"),
                        (c.c_custkey % 40 + 123000).cast("string").alias("project_name"),
                        F.lit("1999-01-20").cast("date").alias("last_recalc_date"),
                        F.when(c.c_custkey % 2 == 0, 8).otherwise(10).alias("day_hr_cnt"),
                        F.lit(40).alias("week_hr_cnt"),
                        _add_days(F.lit("1999-06-30").cast("date"), c.c_custkey % 60).alias("completion_date")))

    @cached_property
    def baseline(self) -> DataFrame:
        """Baselines of the projects: an own one, undated for some, and for some the next project's as a second."""
        c, n = self.t("customer"), self._n_projects
        k, base = c.c_custkey, F.lit("1999-01-20").cast("date")
        own = c.select((k % n).alias("orig_proj_id"), (k % n + self.BASELINE).alias("baseline_proj_id"),
                       F.when(k % 7 != 0, _add_days(base, -(k % 5))).alias("last_baseline_update_date"))
        second = c.filter(k % 3 == 0).select(
            (k % n).alias("orig_proj_id"), ((k + 1) % n + self.BASELINE).alias("baseline_proj_id"),
            F.date_add(base, F.when(k % 2 == 0, 5).otherwise(-9)).alias("last_baseline_update_date"))
        return own.union(second)

    @cached_property
    def weekly(self) -> DataFrame:
        """Weekly subtotals of the current projects; every ninth project has none for the fourth week."""
        t = self.task
        done = t.act_end_date.isNotNull()
        absent = (t.proj_id % 9 == 0) & (t.start_week == F.lit("1999-01-22").cast("date"))
        rows = t.filter((t.proj_id < self.BASELINE) & ~absent).select(
            "proj_id", F.col("start_week").alias("week_ending"), "total_float_hr_cnt",
            F.when(done, t.target_drtn_hr_cnt).otherwise(0).alias("_done"),
            F.when(~done, t.target_drtn_hr_cnt).otherwise(0).alias("_left"))
        return (dealt(rows, ["proj_id", "week_ending"]).groupBy("proj_id", "week_ending")
                .agg(F.min("total_float_hr_cnt").alias("total_float"), F.sum("_done").alias("resources_to_date"),
                     F.sum("_left").alias("next_week_resources")))

    # --- CRM, safety, spreadsheets ---------------------------------------------------------------------------
    @cached_property
    def opportunity(self) -> DataFrame:
        e = self.t("events")
        m9 = e.event_id % 9
        et = e.event_type
        return e.select(
            e.event_id.alias("version_id"),
            e.user_id.alias("opportunity_id"),
            F.when(e.event_id % 13 == 0, F.lit(None).cast(e.schema["ts"].dataType)).otherwise(e.ts).alias("load_ts"),
            F.when(et == "purchase", "Closed Won").when(et == "error", "Closed Lost").when(et == "view", "Open")
            .when(et == "click", "Pending").otherwise("Lead").alias("stage_type"),
            F.when(m9 == 0, "yes").when(m9 == 1, "No").when(m9 == 2, "0").otherwise("false").alias("delete_record"),
            e.value.cast("string").alias("size_text"),
            et.alias("market_name"),
            F.concat(F.lit("Client "), (e.user_id % 97).cast("string")).alias("client_name"),
            F.concat(F.lit("<p class=\"n\">Call&nbsp;"), (m9 + 1).cast("string"), F.lit("</p><br/>")).alias("next_action_html"),
        )

    @cached_property
    def incident(self) -> DataFrame:
        e = self.t("events")
        flag = lambda n: F.when(e.event_id % n == 0, "true").otherwise("false")
        return (e.filter(e.event_type == "error")
                .select(F.when(e.event_id % 50 == 0, "Link")
                        .otherwise(F.concat(F.lit("http://x/"), e.event_id.cast("string"))).alias("link"),
                        F.concat_ws("/", F.lpad(F.month(e.ts).cast("string"), 2, "0"),
                                    F.lpad(F.dayofmonth(e.ts).cast("string"), 2, "0"),
                                    F.year(e.ts).cast("string")).alias("injury_date_text"),
                        F.concat(F.lpad((e.event_id % 12 + 1).cast("string"), 2, "0"), F.lit(":15 "),
                                 F.when(e.event_id % 2 == 0, "AM").otherwise("PM")).alias("injury_time_text"),
                        F.when(e.event_id % 3 == 0, "Near Miss").otherwise("Injury").alias("incident_type"),
                        F.concat(F.lit("Region "), (e.user_id % 5).cast("string")).alias("region"),
                        F.when(e.event_id % 6 != 0, e.event_id % 30).cast("int").alias("days_lost"),
                        flag(4).alias("days_away"), flag(5).alias("transfer"), flag(97).alias("death")))

    @cached_property
    def sheet(self) -> DataFrame:
        o = self.t("orders")
        k = o.o_orderkey
        m6 = k % 6
        thousands = F.concat((k % 9 + 1).cast("string"), F.lit(","), _lpad_num(k % 1000, 3))
        month_abbr = F.substring(F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), F.month(o.o_orderdate) * 3 - 2, 3)
        month_text = F.when(
            k % 2 == 0,
            F.concat(month_abbr, F.lit("-"), F.substring(F.year(o.o_orderdate).cast("string"), 3, 2)),
        ).otherwise(F.concat(F.to_date(o.o_orderdate).cast("string"), F.lit(" 00:00:00")))

        def amount(kind: Column) -> Column:
            return (F.when(kind == 0, " - ").when(kind == 1, "nan")
                    .when(kind == 2, F.concat(F.lit("("), thousands, F.lit(")")))
                    .when(kind == 3, "-5").when(kind == 4, F.lit(None).cast("string"))
                    .otherwise(F.concat(thousands, F.lit(".50"))))

        m4 = o.o_custkey % 4
        return o.select(
            F.concat(F.lit("sheet_"), F.lower(o.o_orderstatus)).alias("sheet_name"),
            month_text.alias("month_text"),
            o.o_orderpriority.alias("region"),
            k.cast("string").alias("title"),
            amount(m6).alias("amount_text"),
            amount((k + 2) % 6).alias("actual_text"),
            F.when(m4 == 0, "EDU").when(m4 == 1, "HC").when(m4 == 2, "IND").otherwise("Water").alias("market_channel"),
        )

    @cached_property
    def control(self) -> DataFrame:
        """Control table of spreadsheet files (tens of rows in production)."""
        rows = [("sheet_f", "2001-05-01", True, 1), ("sheet_o", "2001-06-01", True, 2),
                ("sheet_o", "2001-05-01", True, 1), ("sheet_p", "2001-07-01", False, 1)]
        return self.t.spark.createDataFrame(
            rows, "table_name string, file_month_year string, active boolean, load_no int")

    @cached_property
    def forecast(self) -> DataFrame:
        o = self.t("orders")
        return (o.select(F.concat(F.year(o.o_orderdate).cast("string"), F.lit(" Rolling Forecast")).alias("forecast_type"),
                        F.when(o.o_orderkey % 3 == 0, "Region").otherwise("Market").alias("category_type"),
                        o.o_orderpriority.alias("category"),
                        _cents(o.o_totalprice).alias("revenue"),
                        _cents(o.o_totalprice / 10).alias("margin"),
                        month_floor(o.o_orderdate).alias("file_month")))


    # --- payables and receivables (outside the fixture specification; SQL twins in oracle.extra_fixtures) ---
    @cached_property
    def ap_line(self) -> DataFrame:
        li = self.t("lineitem")
        co = (li.l_linenumber % 2 + 1).cast("string")
        return li.select(
            co.alias("apco"), month_floor(li.l_shipdate).alias("mth"), li.l_orderkey.alias("aptrans"),
            li.l_linenumber.alias("apline"), co.alias("jcco"),
            F.concat(F.lit(" "), (li.l_suppkey % 40 + 123000).cast("string"), F.lit(". ")).alias("job"),
            _cents(li.l_extendedprice * 20).alias("gross_cents"),
            _cents(li.l_extendedprice * 2).alias("retainage_cents"),
        )

    @cached_property
    def ap_pay(self) -> DataFrame:
        li = self.t("lineitem")
        return (li.filter(li.l_orderkey % 4 != 0)
                .select((li.l_linenumber % 2 + 1).cast("string").alias("apco"), month_floor(li.l_shipdate).alias("mth"),
                        li.l_orderkey.alias("aptrans"), li.l_linenumber.alias("apline"),
                        F.when(li.l_linestatus == "F", F.date_add(F.to_date(li.l_shipdate), 30)).alias("paid_date"),
                        _cents(li.l_extendedprice * 20).alias("amount_cents")))

    @cached_property
    def ar(self) -> DataFrame:
        o = self.t("orders")
        co = (o.o_custkey % 2 + 1).cast("string")
        return o.select(
            co.alias("arco"), month_floor(o.o_orderdate).alias("mth"), o.o_orderkey.alias("artrans"), co.alias("jcco"),
            F.concat((o.o_custkey % 100 + 123000).cast("string"), F.lit(".")).alias("contract"),
            _cents(o.o_totalprice * 100).alias("invoiced_cents"), _cents(o.o_totalprice * 60).alias("paid_cents"),
            _cents(o.o_totalprice * 5).alias("retainage_cents"),
        )


    # --- CRM dimensions and GL segment names (outside the fixture specification) -------------------------------
    @cached_property
    def office_division(self) -> DataFrame:
        """Opportunity -> office division assignments (one per event)."""
        e = self.t("events")
        d = e.user_id % 5
        name = (F.when(d == 0, "Midwest").when(d == 1, "Great Lakes").when(d == 2, "Mid-Atlantic")
                .when(d == 3, "Central").otherwise("West"))
        return e.select((d + 1).alias("office_division_id"), name.alias("office_division_description"),
                        e.user_id.alias("opportunity_id"), e.ts.alias("last_load_dt"))

    @cached_property
    def practice_area(self) -> DataFrame:
        """Practice areas (one row per part; the attribute domain has four values)."""
        p = self.t("part")
        k = p.p_partkey % 4
        name = (F.when(k == 0, "Education").when(k == 1, "Healthcare").when(k == 2, "Industrial")
                .otherwise("Water Resources"))
        return p.select((k + 1).alias("practice_area_id"), name.alias("practice_area_name"))

    @cached_property
    def segment(self) -> DataFrame:
        """GL segment names (GLPI): part 1, 2, 3 instances seen in the ledger, some without a name."""
        g = self.gl
        p1 = g.filter(g.part1 != "88200").select("glco", F.lit(1).alias("partno"), F.col("part1").alias("instance"),
                                                  F.concat(F.lit("Account "), "part1").alias("description")).distinct()
        p2 = g.filter(g.part2 != "0000").select("glco", F.lit(2).alias("partno"), F.col("part2").alias("instance"),
                                                 F.concat(F.lit("Division "), "part2").alias("description")).distinct()
        p3 = g.filter(g.part3 != "000").select("glco", F.lit(3).alias("partno"), F.col("part3").alias("instance"),
                                                F.concat(F.when(F.col("part3").isin("300", "311"), "Region Dept ").otherwise("Dept "), "part3")
                                                .alias("description")).distinct()
        return p1.union(p2).union(p3)

    @cached_property
    def wip_sheet(self) -> DataFrame:
        """WIP spreadsheet rows of all files (file = sheet_name, listed by the same control table)."""
        o = self.t("orders")
        return o.select(
            F.concat(F.lit("sheet_"), F.lower(o.o_orderstatus)).alias("sheet_name"),
            F.concat((o.o_custkey + 123000).cast("string"), F.lit(".")).alias("job_number"),
            F.concat(F.lit("Job "), o.o_custkey.cast("string")).alias("job_description"),
            o.o_orderpriority.alias("region"),
            _cents(o.o_totalprice / 1000).alias("revenue_backlog"),
            _cents(o.o_totalprice).alias("ytd_revenue"),
            F.when(o.o_orderkey % 5 == 0, "False").otherwise("True").alias("include_job"),
        )

    # --- CRM child tables under their source names (outside the fixture specification) ------------------------------
    @cached_property
    def crm_office_division(self) -> DataFrame:
        return self.office_division.select(
            F.col("office_division_id").alias("OfficeDivisionId"),
            F.col("office_division_description").alias("OfficeDivisionDescription"),
            F.col("opportunity_id").alias("OpportunityId"), F.col("last_load_dt").alias("last_modified_dt"))

    @cached_property
    def crm_practice_area(self) -> DataFrame:
        e = self.t("events")
        k = e.event_id % 4
        name = F.when(k == 0, "Education").when(k == 1, "Healthcare").when(k == 2, "Industrial").otherwise("Water")
        return e.select(e.user_id.alias("OpportunityId"), (k + 1).alias("practiceareaid"),
                        name.alias("practiceareaname"), F.to_date(e.ts).alias("last_modified_dt"))

    @cached_property
    def crm_delivery_method(self) -> DataFrame:
        e = self.t("events")
        k = e.event_id % 3
        name = F.when(k == 0, "Design-Build").when(k == 1, "CM at Risk").otherwise("Hard Bid")
        return e.select(e.user_id.alias("OpportunityId"), (k + 1).alias("DeliveryMethodID"), name.alias("DeliveryMethodName"),
                        F.to_date(e.ts).alias("last_load_dt"))

    @cached_property
    def crm_debrief(self) -> DataFrame:
        e = self.t("events")
        k = e.event_id % 3
        text = F.when(k == 0, "Yes").when(k == 1, "no").otherwise("n/a")
        return e.select(e.user_id.alias("OpportunityId"), text.alias("Debrief Call Complete?"), e.ts.alias("last_load_dt"))

    @cached_property
    def crm_uom(self) -> DataFrame:
        e = self.t("events")
        return e.select(e.user_id.alias("OpportunityId"),
                        F.when(e.event_id % 2 == 0, "SF").otherwise("LF").alias("Unit of Measure"),
                        e.ts.alias("last_load_dt"))

    # --- wide forms under their source names: every column is text but for ids and load times -----------------------
    @staticmethod
    def _filler(k: Column, i: int, name: str) -> Column:
        """What column ``i`` of a form holds in row ``k``, unless it is given."""
        return F.when((k + i) % 11 != 0, F.concat(F.lit(f"{name} "), (k % (i + 5)).cast("string"))).alias(name)

    @cached_property
    def crm_opportunity(self) -> DataFrame:
        """The CRM's opportunity versions; ``version_id`` tells versions of one load time apart."""
        o = self.opportunity
        k, first = F.col("version_id"), F.lit("1996-01-01").cast("date")
        given = {
            "OpportunityId": F.col("opportunity_id"), "OpportunityNumber": F.col("opportunity_id"), "Size": F.col("size_text"),
            "StageType": F.col("stage_type"), "DeleteRecord": F.col("delete_record"), "ClientName": F.col("client_name"),
            "NextAction": F.col("next_action_html"), "LastModifiedDateTime": F.col("load_ts"),
            "Note": F.concat(F.lit("<div>Note&nbsp;"), (k % 7).cast("string"), F.lit("</div>")),
        }

        def column(i: int, c: str) -> Column:
            if c in given:
                return given[c].alias(c)
            filler = self._filler(k, i, c)
            if c in OPPORTUNITY_NUMBERS:
                part = F.when(k % 3 == 0, "").when(k % 3 == 1, ".5").otherwise(".25")
                filler = F.concat((k * (i + 7) % 100_000).cast("string"), part)
            elif c in OPPORTUNITY_TIMES:
                filler = F.concat(_add_days(first, k * (i + 3) % 1500).cast("string"), F.lit(" 08:30:00"))
            elif c in OPPORTUNITY_BOOLEANS:
                m = (k + i) % 9
                filler = F.when(m == 0, "yes").when(m == 1, "No").when(m == 2, "0").otherwise("false")
            return F.when((k + i) % 11 != 0, filler).alias(c)

        return o.select("version_id", *[column(i, c) for i, c in enumerate(OPPORTUNITY_COLUMNS)])

    def _form(self, columns, given: dict[str, str]) -> DataFrame:
        e = self.t("events").filter(F.col("event_type") == "error")
        made = self._incident_fields(e)
        return made.select(*[F.expr(given[c]).alias(c) if c in given else self._filler(F.col("k"), i, c)
                             for i, c in enumerate(columns)])

    @staticmethod
    def _incident_fields(e: DataFrame) -> DataFrame:
        """What the incident forms have in common (see ``incident``)."""
        return e.select(
            F.col("event_id").alias("k"), F.col("user_id").alias("u"), F.to_date("ts").alias("day"),
            F.when(F.col("event_id") % 50 == 0, "Link").otherwise(
                F.concat(F.lit("http://x/"), F.col("event_id").cast("string"))).alias("link"))

    @cached_property
    def incident_form(self) -> DataFrame:
        return self._form(INCIDENT_COLUMNS, {
            "link": "link", "date": "concat(cast(day as string), ' 08:15:00')", "report number": "cast(k as string)",
            "hhoa45b9lwo3l2pp": "concat('Region ', cast(u % 5 as string))",
            "3nmr0xeq7vfwu8fp": "if(k % 3 = 0, 'Near Miss', 'Injury')",
            "zg69dpnrgww804oa": "concat(' ', date_format(day, 'MM/dd/yyyy'), ' ', lpad(cast(k % 12 + 1 as string), 2, '0'), ':15 ',"
                                " if(k % 2 = 0, 'AM', 'PM'), ' ')"})

    @cached_property
    def osha_form(self) -> DataFrame:
        def some_day(i):
            return f"date_format(date_add(date'1970-01-01', cast(k * {i} % 9000 as int)), 'MM/dd/yyyy')"

        def flag(n):
            return f"if(k % {n} = 0, 'true', 'false')"

        return self._form(OSHA_COLUMNS, {
            "link": "link", "date": "concat(cast(day as string), ' 08:15:00')", "updated": "concat(cast(day as string), ' 18:00:00')",
            "oshalogreportdate": some_day(3), "oshalogincidentdate": "date_format(day, 'MM/dd/yyyy')",
            "oshalogempbirthdate": some_day(5), "oshalogemphireddate": some_day(7),
            "oshalogperiodstransferred": "if(k % 6 <> 0, cast(k % 30 as string), null)",
            "select-days away from work": flag(4), "select-job transfer or restriction": flag(5), "select-death": flag(97),
            "select-other recordable case": flag(2)})

    @cached_property
    def practice_area_form(self) -> DataFrame:
        k = F.col("k")
        rows = self.t("part").select(F.col("p_partkey").alias("k")).withColumns({
            "id": k % 4 + 1, "name": F.when(k % 4 == 0, "Education").when(k % 4 == 1, "Healthcare").when(
                k % 4 == 2, "Industrial").otherwise("Water Resources")})
        given = {"practiceareaid": F.col("id"), "practiceareaname": F.col("name"),
                 "createdate": F.concat(_add_days(F.lit("1996-01-01").cast("date"), k % 900).cast("string"), F.lit(" 12:00:00"))}
        return rows.select(*[given[c].alias(c) if c in given else self._filler(k, i, c)
                             for i, c in enumerate(PRACTICE_AREA_COLUMNS)])


# --- landing ----------------------------------------------------------------------------------------------------
# Production sources are landed tables with plain columns.  The analogs are projections of the test tables
# whose columns are expressions (codes built by CASE, then parsed again by regex downstream); left lazy, the
# optimizer inlines those expressions into every filter and join that uses them, so each query re-derives the
# sources several times.  Each analog is therefore landed once per Spark application (``trestle.sources.landing``)
# and read back as a parquet table.  The form of 135 columns is not: its cells depend on one landed table alone, and a
# query makes the few that it reads.


#: Families of same-shaped files are partitioned by file, so that files which are not asked for are not read.
PARTITIONED = {"sheet": ["sheet_name"], "wip_sheet": ["sheet_name"]}
#: Not landed: wide projections of a landed table.
LAZY = {"crm_opportunity"}


def _land(self, name: str, df: DataFrame) -> DataFrame:
    from trestle.sources.landing import land

    return land(self.t.spark, self.t.scope, f"analog-{name}", df, PARTITIONED.get(name))


def _landed_property(name: str, build):
    def get(self):
        return self._land(name, build(self))

    get.__name__ = name
    get.__doc__ = build.__doc__
    prop = cached_property(get)
    prop.__set_name__(Analogs, name)
    return prop


Analogs._land = _land
SOURCES = {n for n, v in vars(Analogs).items() if isinstance(v, cached_property)}
for _name, _value in list(vars(Analogs).items()):
    if isinstance(_value, cached_property) and _name not in LAZY:
        setattr(Analogs, _name, _landed_property(_name, _value.func))
