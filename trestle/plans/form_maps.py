"""Column maps of the wide staging models (R-1, R-2, R-7, R-14): source column -> output column, in the source's order."""

from __future__ import annotations

import re


def snake(name: str) -> str:
    """``RFPRecieved`` -> ``rfp_recieved``, ``OpportunityValueListID1`` -> ``opportunity_value_list_id1``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


# The columns of the CRM's opportunity table; the staging names are their snake case.
OPPORTUNITY_COLUMNS = tuple("""
OpportunityId ClientId ClientName SF255Form SF330Form OpportunityName EstimatedSelectionDate CloseDate Cost Size SizeUnit Fee
Probability NextAction RFPRecieved ProposalNumber ProposalDueDate ExpectedRFPDate QualsDueDate ProposalSubmitted
PresentationDate Comments MarketingCostBudget MarketingCostActual OpportunityNumber ActiveInd DeleteRecord Address1 Address2
City State PostalCode Country OpportunityDescription ExternalId
OpportunityShortText1 OpportunityShortText2 OpportunityShortText3 OpportunityShortText4 OpportunityShortText5
OpportunityNumber1 OpportunityNumber2 OpportunityNumber3 OpportunityNumber4 OpportunityNumber5
OpportunityDate1 OpportunityDate2 OpportunityDate3 OpportunityDate4 OpportunityDate5
OpportunityValueListID1 OpportunityValueListID2 OpportunityValueListID3 OpportunityValueListID4 OpportunityValueListID5
OpportunityMoney1 OpportunityMoney2 OpportunityMoney3 OpportunityMoney4 OpportunityMoney5
OpportunityPercent1 OpportunityPercent2 OpportunityPercent3 OpportunityPercent4 OpportunityPercent5
EstimatedStartDate EstimatedCompletionDate FirmFee ProjectProbability OwnerId OwnerName TeamOppFirmOrgFeeSource OppType
PreConStartDate PreConEndDate DesignStartDate DesignCompletionDate ConstructionStartDate ConstructionCompletionDate
fundProbability ROW_VERSION ShortListed Interviewed ShortListedDate Score CreateDateTime CreatedByUserId
LastModifiedDateTime LastModifiedByUserId LastDeletedDateTime LastDeletedByUserId EstimatedFeePercentage FactoredFee
GrossRevenueSTD GrossMarginDollarsSTD GrossMarginPercentSTD FactoredCostSTD FeeCIPercent FeeCIDifVolume
LaborDifferentialDollars OppSelfPerformHours EstimatedManagementUnits GrossMargin GrossMarginPercent MasterOpportunityId
OppTypeDescription AutoNumber Stage StageType Note RedZoneScore
OpportunityLongText1 OpportunityLongText2 OpportunityLongText3 OpportunityLongText4 OpportunityLongText5
approvalLevel approvalStatus OppLat OppLong StageId County RegionId WorkHoursEngineer WorkHoursConstruction WorkHoursDesign
FeePercent SolicitationNumber OnCallContractStartDate OnCallContractEndDate OriginalFirmEstimatedFee OppFormID Markup
PropertyId ReferredByID
""".split())
# Which of them are numbers (scale 0), text booleans and times.
OPPORTUNITY_NUMBERS = frozenset("""
Cost Size Fee Probability OpportunityMoney1 OpportunityMoney2 OpportunityMoney3 OpportunityMoney4 OpportunityMoney5 FirmFee
ProjectProbability EstimatedFeePercentage FactoredFee OppLat OppLong
""".split())
OPPORTUNITY_BOOLEANS = frozenset("RFPRecieved ProposalSubmitted DeleteRecord ShortListed Interviewed".split())
OPPORTUNITY_TIMES = frozenset("""
EstimatedSelectionDate CloseDate ProposalDueDate ExpectedRFPDate QualsDueDate PresentationDate
OpportunityDate1 OpportunityDate2 OpportunityDate3 OpportunityDate4 OpportunityDate5
EstimatedStartDate EstimatedCompletionDate PreConStartDate PreConEndDate DesignStartDate DesignCompletionDate
ConstructionStartDate ConstructionCompletionDate ShortListedDate CreateDateTime LastModifiedDateTime LastDeletedDateTime
""".split())


def _pairs(text: str) -> dict[str, str]:
    return dict(line.rsplit(None, 1) for line in text.strip().splitlines())


# The incident notification form; the hashed names are those of its fields.
INCIDENT_COLUMNS = _pairs("""
link link
report report
report number report_number
date datetime
updated updated
updated_time update_time
version version
observer observer
observer-emp-num observer_emp_num
duration duration
latitude latitude
longitude longitude
temperature temperature
weather weather
5ocmu4jnubr7i3fp description_1
enpzygmdlvama0uo description_2
f02c4goxxfk2crkv incident_details
hhoa45b9lwo3l2pp region
e0z5d7933ts0h1w8 operating_unit_cen
zc5q0t7y0dq1ocyc operating_unit_gla
g8wixsb27bl8rjp2 operating_unit_mat
bf3ycvu03gl9o8pu operating_unit_mwe
sw7q9icydgabk73p project
3nmr0xeq7vfwu8fp incident_type
7dtuy1o3o11pcv81 description_3
uak0o36la7wduw2o description_4
wjbpaagjaomc77e9 description_5
9tn1dvlkdku2twh7 description_6
g8qp7bi7vkkqrztc describe_other
zg69dpnrgww804oa datetime_of_incident
y9zznhfhzhmiq9f3 employee_involved
6ja2s8nwgfaypoxy job_title
kpwkc3l6f3t2brag employee_supervisor
50if9do23x72f5i9 contractor_involved
cpdi0i0tvfx65x94 who_initially_reported_incident
kplf0ydahwucaavw incident_location
4bcd91hmb5p0yydr briefly_describe_what_happened
l0ekhz55wtpsklgx what_first_aid_was_provided
62tjzrd0ng49v6nw images_documents
parentrepnum parent_rep_num
parentlink parent_link
surrogate surrogate
""")
# The recordable incident form.
OSHA_COLUMNS = _pairs("""
link link
report report
report number report_number
date datetime
updated updated
updated_time updated_time
version version
observer observer
observer-emp-num observer_emp_num
duration duration_seconds
latitude latitude
longitude longitude
temperature temperature
wind-speed wind_speed
weather weather
8au7z4w9b4crqy0h completer_information
9xy8keuj7vu074vl description_1
oshalogobserver completed_by
oshalogobserverjob job
oshalogobserverphone phone
oshalogreportdate report_date
o5s5pu9ftvlmv3ou employee_information
ip67xsgyui1zg6pw description_2
oshalogincidentdate injury_date
oshalogexistingemployee existing_employee
oshalogemployee employee
oshalogemployeename employee_name
oshalogemptitle job_title
oshalogestablishment establishment
oshalogfieldoffice field_office
oshaloglob line_of_business
oshalogclient company
oshaloggender gender
oshalogempstreet street
oshalogempcity city
oshalogempstate state
oshalogempzip zip
oshalogempbirthdate date_of_birth
oshalogemphireddate date_hired
ql0ouw0girm7qwth case_information
07tf2m5heqjb6eu5 description_3
oshalogcasenumber case_number
oshalogtimeworkbegan began_work_time
sdkfhkeshjfnadjj description_4
oshaloglocation location
c9jgoa4l76xhsq5x description_5
oshalogpredescription activity_pre_incident
aj8paf2lhbwpct2d description_6
oshalogwhathappened incident_description
grnt2587tf8fgezw description_7
oshalogwhatinjury injury_or_illness_description
1j5casbor32u6n9i description_8
oshalogwhatobject harm_caused_by
oshalogtimeknown known_time
oshalogtime time_of_incident
oshaloginjurytype injury_type
oshaloginjurytypeother other_illness
eqlhf5fiamzg08f7 treatment_information
oshalogdoctorname healthcare_professional
oshalogtreatmentaway treated_off_site
oshalogfacilityname facility_name
oshalogfacilitystreet facility_street
oshalogfacilitycity facility_city
oshalogfacilitystate facility_state
oshalogfacilityzip facility_zip
oshaloger emergency_room
oshalogovernight in_patient
ayhgh07zwls7vbyz outcome_1
oshalogoutcome outcome_2
oshalogreturned returned
oshalogdeathdate date_of_death
oshalogdaysiscalc days_away_method
oshalogmanualdaysaway days_away
oshalogperiods periods_away
oshalogperiods-oshalogperiodstart start_1
oshalogperiods-oshalogperiodend end_1
oshalogdaystransferrediscalc days_transferred_restricted
oshalogmanualdaystransferred days
oshalogperiodstransferred periods_away_restricted
oshalogperiodstransferred-oshalogperiodtransferredstart start_2
oshalogperiodstransferred-oshalogperiodtransferredend end_2
select-female select_female
select-male select_male
select-yes select_yes
select-no select_no
select-days away from work select_days_away_from_work
select-job transfer or restriction select_job_transfer_or_restriction
select-death select_death
select-other recordable case select_other_recordable_case
select-none select_none
select-calculated select_calculated
select-manual select_manual
parentrepnum parent_report_number
parentlink parent_link
surrogate surrogate
""")
# The CRM's practice areas.
PRACTICE_AREA_COLUMNS = _pairs("""
assessmentpercentage assessment_percentage
available available
createdate create_date
deleterecord delete_record
marginpercentage margin_percentage
modifydate modify_date
practiceareaacronym practice_area_acronym
practiceareaaddress1 practice_area_address_1
practiceareaaddress2 practice_area_address_2
practiceareacity practice_area_city
practiceareacountryid practice_area_country_id
practiceareaemail practice_area_email
practiceareafax practice_area_fax
practiceareaid practice_area_id
practiceareaname practice_area_name
practiceareaphone practice_area_phone
practiceareastateid practice_area_state_id
practiceareaurl practice_area_url
practiceareazip practice_area_zip
row_version row_version
userid user_id
old_practiceareaid old_practice_area_id
practiceareasalesgoal practice_area_sales_goal
""")
