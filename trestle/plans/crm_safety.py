"""CRM (opportunities) and safety (incidents) models: R-1, R-2, R-7..R-14, R-28, R-29, R-31, R-61..R-63."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.functions import as_bool, as_number, month_floor, parse_ts, strip_html
from trestle.operators import aggregates as A
from trestle.operators import windows as W
from trestle.operators.reshape import project
from trestle.plans.form_maps import (INCIDENT_COLUMNS, OPPORTUNITY_BOOLEANS, OPPORTUNITY_COLUMNS, OPPORTUNITY_NUMBERS,
                                     OPPORTUNITY_TIMES, OSHA_COLUMNS, PRACTICE_AREA_COLUMNS, snake)
from trestle.plans.registry import query
from trestle.sources import control as S
from trestle.sources.tables import Tables


# --- safety -----------------------------------------------------------------------------------------------------
def _form_rows(form: DataFrame) -> DataFrame:
    return S.drop_header_rows(form, "link", "Link")


def _renamed(columns: Mapping[str, str], typed: Mapping[str, Column]) -> dict[str, Column]:
    """A column map: output name -> source column, or the given typed expression for it."""
    return {name: typed.get(source, F.col(f"`{source}`")) for source, name in columns.items()}


@query("stg_incident_notification")
def stg_incident_notification(t: Tables) -> DataFrame:
    """R-1: the 42 form fields renamed, exported header rows dropped, submission time cast, 12-hour incident time parsed."""
    return project(_form_rows(t.fx.incident_form), _renamed(INCIDENT_COLUMNS, {
        "date": parse_ts("date", "yyyy-MM-dd HH:mm:ss"),
        "zg69dpnrgww804oa": parse_ts(F.trim("zg69dpnrgww804oa"), "MM/dd/yyyy hh:mm a")}))


@query("stg_osha_recordable_incidents")
def stg_osha_recordable_incidents(t: Tables) -> DataFrame:
    """R-2: the 95 form fields renamed, four 'MM/DD/YYYY' dates and two times parsed, header rows dropped."""
    dates = ("oshalogreportdate", "oshalogincidentdate", "oshalogempbirthdate", "oshalogemphireddate")
    return project(_form_rows(t.fx.osha_form), _renamed(OSHA_COLUMNS, {
        **{c: parse_ts(c, "yyyy-MM-dd HH:mm:ss") for c in ("date", "updated")}, **{c: parse_ts(c, "MM/dd/yyyy") for c in dates}}))


@query("incident_type")
def osha_incidents(t: Tables) -> DataFrame:
    """R-28: four flags -> incident type; days away wins over transfer, which wins over death."""
    flags = ("select_days_away_from_work", "select_job_transfer_or_restriction", "select_death", "select_other_recordable_case")
    s = stg_osha_recordable_incidents(t).select(
        F.col("datetime").alias("submit_datetime"), "injury_date", "job_title", "field_office", "injury_type",
        "periods_away_restricted", *[as_bool(c).alias(c) for c in flags], F.col("outcome_2").alias("injury_outcome"))
    kind = (F.when(F.col(flags[0]) == F.lit(True), "Days Away Incident")
            .when(F.col(flags[1]) == F.lit(True), "Job Transfer Incident")
            .when(F.col(flags[2]) == F.lit(True), "Death Incident").otherwise("Other Recordable Incident"))
    return s.withColumn("incident_type", kind)


@query("incident_month")
def osha_recordable_incidents(t: Tables) -> DataFrame:
    """R-63/R-72: incidents with their month; missing periods away count as 0."""
    o = osha_incidents(t)
    return o.select("submit_datetime", "injury_date", month_floor(F.col("injury_date").cast("date")).alias("injury_month"),
                    "job_title", "field_office", "incident_type",
                    F.ifnull(F.col("periods_away_restricted").try_cast("int"), F.lit(0)).alias("periods_away_or_restricted"))


@query("order_mixed")
def reported_incidents(t: Tables) -> DataFrame:
    """R-29/O-1: seven columns, newest incident first (NULL times first, D1), then by link."""
    i = stg_incident_notification(t).orderBy(W.desc("datetime_of_incident"), W.asc("link"))
    return i.select("region", "project", "incident_type", "datetime_of_incident", "observer", "employee_involved",
                    "description_1")


# --- CRM staging ------------------------------------------------------------------------------------------------
@query("opportunities_typed")
def stg_opportunities(t: Tables) -> DataFrame:
    """R-7: typed projection of the 135 columns of the opportunity versions (numbers have scale 0, D2, so latitude and
    longitude are whole degrees; text booleans, D21; the load time comes typed)."""
    o = t.fx.crm_opportunity

    def typed(c: str) -> Column:
        if c in OPPORTUNITY_NUMBERS:
            return as_number(c).cast("bigint")
        if c in OPPORTUNITY_BOOLEANS:
            return as_bool(c)
        return parse_ts(c) if c in OPPORTUNITY_TIMES and o.schema[c].dataType.simpleString() == "string" else F.col(c)

    return project(o, {"version_id": "version_id", **{snake(c): typed(c) for c in OPPORTUNITY_COLUMNS}})


@query("stg_opportunity_size")
def stg_opportunity_size(t: Tables) -> DataFrame:
    """R-12: size per opportunity load, cast to a whole number."""
    o = t.fx.opportunity
    return o.select("opportunity_id", as_number("size_text").cast("bigint").alias("estimated_project_size"),
                    F.col("load_ts").alias("last_load_dt"), "version_id")


@query("stg_office_division")
def stg_office_division(t: Tables) -> DataFrame:
    """R-8."""
    return project(t.fx.crm_office_division, {
        "office_division_id": "OfficeDivisionId", "office_division_description": "OfficeDivisionDescription",
        "opportunity_id": "OpportunityId", "last_load_dt": "last_modified_dt"})


@query("stg_opportunity_practicearea")
def stg_opportunity_practicearea(t: Tables) -> DataFrame:
    """R-11."""
    return project(t.fx.crm_practice_area, {
        "opportunity_id": "OpportunityId", "practice_area_id": "practiceareaid", "practice_area_name": "practiceareaname",
        "last_load_dt": "last_modified_dt"})


@query("stg_opportunity_delivery_method")
def stg_opportunity_delivery_method(t: Tables) -> DataFrame:
    """R-10."""
    return project(t.fx.crm_delivery_method, {
        "opportunity_id": "OpportunityId", "delivery_method_id": "DeliveryMethodID",
        "delivery_method_name": "DeliveryMethodName", "last_load_dt": "last_load_dt"})


@query("stg_opportunity_debrief_call_complete")
def stg_opportunity_debrief(t: Tables) -> DataFrame:
    """R-9: debrief flag text to boolean (unknown text is NULL)."""
    return project(t.fx.crm_debrief, {
        "opportunity_id": "OpportunityId", "debrief_call_complete": as_bool(F.col("`Debrief Call Complete?`")),
        "last_load_dt": "last_load_dt"})


@query("stg_opportunity_uom")
def stg_opportunity_uom(t: Tables) -> DataFrame:
    """R-13."""
    return project(t.fx.crm_uom, {"opportunity_id": "OpportunityId", "unit_of_measure": "Unit of Measure",
                                  "last_load_dt": "last_load_dt"})


@query("stg_practice_areas")
def stg_practice_areas(t: Tables) -> DataFrame:
    """R-14: the 23 columns of the practice areas renamed, the creation time cast."""
    return project(t.fx.practice_area_form, _renamed(PRACTICE_AREA_COLUMNS, {
        "createdate": parse_ts("createdate", "yyyy-MM-dd HH:mm:ss")}))


# --- current opportunities --------------------------------------------------------------------------------------
def _latest(df: DataFrame, tie: list[str]) -> DataFrame:
    return W.latest_per_key(df, ["opportunity_id"], ["last_load_dt"], tie=tie)


def current_versions(t: Tables) -> DataFrame:
    """The newest version of every opportunity that is not deleted."""
    raw = stg_opportunities(t).filter(F.col("delete_record") == F.lit(False))
    return W.latest_per_key(raw, ["opportunity_number"], ["last_modified_date_time"], tie=["version_id"])


@query("opportunities_current")
def int_opportunities(t: Tables) -> DataFrame:
    """R-31: latest non-deleted version per opportunity + latest size, unit, debrief flag, division, and the
    markets / delivery methods of the latest load as ordered distinct lists ('' when none, D8).

    Every child table is reduced to one row per opportunity (W-1) before the joins; the list aggregation
    groups by (opportunity, load) and its distinct sets are bounded by the attribute domain.  A deleted flag
    that is NULL drops the version.  The region-map joins use distinct lookups (J-13).
    """
    from trestle.plans.dimensions import dim_region_market

    raw = current_versions(t)
    size = _latest(stg_opportunity_size(t), ["version_id"]).select("opportunity_id", "estimated_project_size")
    uom = _latest(stg_opportunity_uom(t), ["unit_of_measure"]).select("opportunity_id", "unit_of_measure")
    rm = dim_region_market(t)
    markets = rm.select("unanet_market_id").distinct()
    # Only the newest load of an opportunity is listed, so the others go before the lists are made.
    pa = W.top_rank(stg_opportunity_practicearea(t), ["opportunity_id"], ["last_load_dt"])
    pa = pa.join(markets, pa.practice_area_id == markets.unanet_market_id, "left")
    pa = A.listagg_distinct(pa, ["opportunity_id"], {
        "market_number": "unanet_market_id",        # the reference lists the market ids under this name
        "practice_area_name": "practice_area_name"})
    dm = W.top_rank(stg_opportunity_delivery_method(t), ["opportunity_id"], ["last_load_dt"])
    dm = A.listagg_distinct(dm, ["opportunity_id"], {"delivery_method_name": "delivery_method_name"})
    regions = rm.filter(~F.col("region_number").like("%9.%")).select("unanet_region_id", "region_number").distinct()
    od = stg_office_division(t)
    od = od.join(regions, od.office_division_id == regions.unanet_region_id, "left")
    od = _latest(od, ["region_number", "office_division_id"]).select("opportunity_id", "region_number",
                                                                    "office_division_description")
    db = _latest(stg_opportunity_debrief(t), ["debrief_call_complete"]).select("opportunity_id",
                                                                              "debrief_call_complete")
    j = (raw.join(size, "opportunity_id", "left").join(uom, "opportunity_id", "left").join(pa, "opportunity_id", "left")
         .join(od, "opportunity_id", "left").join(db, "opportunity_id", "left").join(dm, "opportunity_id", "left"))
    return j.select(
        "opportunity_id", "client_id", "client_name", "opportunity_name", "cost",
        F.coalesce("estimated_project_size", "size").alias("size"), "unit_of_measure", "probability", "stage", "stage_type",
        "market_number", F.col("practice_area_name").alias("market_channel"), "region_number",
        F.col("office_division_description").alias("region"), F.col("delivery_method_name").alias("delivery_method"),
        "debrief_call_complete", strip_html("next_action").alias("next_action"), strip_html("note").alias("note"),
        "opportunity_number", "address1", "city", "state", "postal_code", "country", "construction_start_date",
        "construction_completion_date", "create_date_time", "last_modified_date_time")


@query("closed_opportunities")
def closed_opportunities(t: Tables) -> DataFrame:
    """R-61: closed opportunities and whether they were won."""
    o = int_opportunities(t).filter(F.col("stage_type").like("Closed%"))
    return o.withColumn("opportunity_won", F.when(F.col("stage_type").like("%Won%"), True).otherwise(False))


@query("open_opportunities")
def open_opportunities(t: Tables) -> DataFrame:
    """R-62/P-4: open or pending opportunities."""
    return int_opportunities(t).filter(F.col("stage_type").isin("Open", "Pending"))
