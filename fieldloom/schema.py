"""Declared types: registry, pages, envelopes, reports, typed records, stored tables, and the route table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S, _D, _I, _B, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


REGISTRY = _struct(id=_S, name=_S, country=_S, currency=_S, pages=T.MapType(_S, _S))
PAGES = _struct(entity_id=_S, label=_S, url=_S, text=_S)
FETCHED = _struct(url=_S, html=_S, status=_I, attempts=_I, waited=_D, error=_S)
ENVELOPE = _struct(field=_S, value=T.VariantType(), confidence=_D, source_url=_S, raw_snippet=_S, needs_review=_B, notes=_S)

META = _struct(confidence=_D, source_url=_S, needs_review=_B, notes=_S)
ABOUT = _struct(name=_S, founding_year=_I, ranking_qs=_I, ranking_times=_I, location_city=_S, location_country=_S, institution_type=_S, meta=META)
TUITION_FEE = _struct(programme_level=_S, student_type=_S, annual_fee=_D, currency=_S, meta=META)
LIVING_COST = _struct(city=_S, monthly_rent_min=_D, monthly_rent_max=_D, monthly_food=_D, monthly_transport=_D, monthly_total_estimate=_D, currency=_S, meta=META)
SCHOLARSHIP = _struct(name=_S, value=_D, value_type=_S, currency=_S, eligibility=_S, application_deadline=_S, renewable=_B, meta=META)
ACCEPTANCE_RATE = _struct(overall_percent=_D, undergraduate_percent=_D, postgraduate_percent=_D, year_of_data=_I, meta=META)
GRADUATE_EMPLOYMENT = _struct(employed_within_6_months_percent=_D, data_source=_S, year_of_data=_I, meta=META)
AVERAGE_SALARY = _struct(field_of_study=_S, median_salary=_D, currency=_S, year_of_data=_I, meta=META)
VISA_POLICY = _struct(country=_S, visa_type=_S, processing_time_weeks_min=_I, processing_time_weeks_max=_I, key_requirements=T.ArrayType(_S), application_url=_S, meta=META)
INTAKE_DEADLINE = _struct(intake_name=_S, application_open=_S, application_close=_S, programme=_S, meta=META)
COURSE_LISTING = _struct(code=_S, title=_S, credits=_I, description=_S, prerequisites=T.ArrayType(_S), mode=_S, level=_S, meta=META)
RECORD = _struct(
    university_id=_S, university_name=_S, about=ABOUT, tuition_fees=T.ArrayType(TUITION_FEE), living_costs=LIVING_COST, scholarships=T.ArrayType(SCHOLARSHIP),
    acceptance_rate=ACCEPTANCE_RATE, graduate_employment=GRADUATE_EMPLOYMENT, average_salaries=T.ArrayType(AVERAGE_SALARY), visa_policy=VISA_POLICY,
    intake_deadlines=T.ArrayType(INTAKE_DEADLINE), courses=T.ArrayType(COURSE_LISTING), scrape_timestamp=_S, overall_confidence=_D,
)

REPORT = _struct(
    university_id=_S, fields=T.MapType(_S, _struct(score=_D, issues=T.ArrayType(_S))), critical_issues=T.ArrayType(_S), overall_quality_score=_D, ready_for_storage=_B
)
ENTITIES = _struct(id=_S, name=_S, scraped_at=_TS, overall_confidence=_D, data_json=_S)
RAW_FIELDS = _struct(university_id=_S, field_name=_S, value_json=_S, confidence=_D, source_url=_S, needs_review=_I, notes=_S, scraped_at=_TS)
VALIDATION_REPORTS = _struct(university_id=_S, report_json=_S, quality_score=_D, ready_for_storage=_I, created_at=_TS)


class Route(NamedTuple):
    """Where a field's text and url come from, and the names and rule that belong to it."""

    pos: int
    storage_key: str
    prompt_name: str
    report_key: str
    spot_name: str
    text_label: str
    text_fallback: str | None
    url_label: str
    url_fallback: str | None
    rule: str
    required: bool
    critical: str | None


#: The names, page labels and messages that results are compared by.
ROUTES = [
    Route(1, "about_raw", "about_university", "about", "about_university", "about", None, "about", None, "generic", True, "about_university missing or low confidence"),
    Route(2, "tuition_raw", "tuition_fees_all_levels", "tuition_fees", "tuition_fees", "tuition", None, "tuition", None, "currency", False, "tuition_fees missing or implausible"),
    Route(3, "living_raw", "living_costs_monthly_breakdown", "living_costs", "living_costs", "living", "tuition", "living", "tuition", "generic", False, None),
    Route(4, "scholarships_raw", "scholarships_list_with_value_and_eligibility", "scholarships", "scholarships", "scholarships", None, "scholarships", None, "generic", False, None),
    Route(5, "acceptance_raw", "acceptance_rate_percentage", "acceptance_rate", "acceptance_rate", "about", "deadlines", "about", None, "percent", False, None),
    Route(6, "employment_raw", "graduate_employment_rate_within_6_months", "graduate_employment", "graduate_employment", "employment", None, "employment", None, "generic", False, None),
    Route(7, "salary_raw", "average_graduate_salaries_by_field", "average_salaries", "average_salaries", "employment", None, "employment", None, "generic", False, None),
    Route(8, "visa_raw", "student_visa_type_requirements_processing_time", "visa_policy", "visa_policy", "visa", None, "visa", None, "generic", False, None),
    Route(9, "deadlines_raw", "application_deadlines_per_intake", "intake_deadlines", "intake_deadlines", "deadlines", None, "deadlines", None, "date", False, None),
    Route(10, "courses_raw", "course_listings_with_code_credits_description", "courses", "course_listings", "courses", None, "courses", None, "generic", False, None),
]

_ROUTE_DDL = (
    "pos int, storage_key string, prompt_name string, report_key string, spot_name string, text_label string, text_fallback string, url_label string, url_fallback string, "
    "rule string, required boolean, critical string"
)


def routes(spark: SparkSession) -> DataFrame:
    """The ten routes as a table; small and fixed, so joins may broadcast it."""
    return spark.createDataFrame(ROUTES, _ROUTE_DDL)
