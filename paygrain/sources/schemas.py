"""Declared schemas of the landed sources and of the two fact tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the three sources, of the outputs and of the fact tables.
RAW_PAYROLL = [
    "agency_name", "title_description", "base_salary", "pay_basis", "regular_hours",
    "regular_gross_paid", "ot_hours", "total_ot_paid", "total_other_pay",
]
RAW_PAYROLL_EXTRA = ["payroll_number", "fiscal_year", "leave_status_as_of_june_30"]
RAW_POSTINGS = [
    "job_id", "agency", "posting_type", "number_of_positions", "business_title",
    "civil_service_title", "title_classification", "job_category",
    "full_time_part_time_indicator", "career_level", "salary_range_from", "salary_range_to",
    "salary_frequency", "work_location", "job_description", "minimum_qual_requirements",
    "preferred_skills", "posting_date", "posting_updated", "process_date",
]
RAW_POSTINGS_EXTRA = ["title_description", "application_deadline"]
PAYROLL_OUTPUT = RAW_PAYROLL + [
    "annual_salary_standardized", "salary_min", "salary_max", "salary_range_width",
    "employee_count_in_role", "fuzzy_match_string",
]
POSTINGS_OUTPUT = [
    "job_id", "agency", "posting_type", "number_of_positions", "business_title",
    "civil_service_title", "job_category", "full_time_part_time_indicator", "career_level",
    "salary_range_from", "salary_range_to", "salary_frequency", "work_location", "posting_date",
    "posting_duration_days", "fuzzy_match_string", "best_payroll_match", "best_match_score",
    "payroll_salary_min", "payroll_salary_max",
]
FACT_POSTINGS = {
    "job_id": "varchar(50)", "agency": "varchar(200)", "posting_type": "varchar(100)",
    "number_of_positions": "int", "business_title": "varchar(500)",
    "civil_service_title": "varchar(500)", "job_category": "varchar(200)",
    "full_time_part_time_indicator": "varchar(50)", "career_level": "varchar(100)",
    "salary_range_from": "decimal(12,2)", "salary_range_to": "decimal(12,2)",
    "salary_frequency": "varchar(50)", "work_location": "varchar(500)",
    "posting_date": "timestamp_ntz", "posting_duration_days": "int",
    "fuzzy_match_string": "varchar(500)", "best_payroll_match": "varchar(500)",
    "best_match_score": "decimal(5,4)", "payroll_salary_min": "decimal(12,2)",
    "payroll_salary_max": "decimal(12,2)",
}
FACT_DURATION = {
    "job_id": "varchar(50)", "agency": "varchar(200)", "business_title": "varchar(500)",
    "actual_posting_duration_days": "int", "lighthouse_median_posting_duration": "decimal(8,2)",
    "duration_variance": "decimal(8,2)", "duration_variance_pct": "decimal(8,2)",
    "lighthouse_match_title": "varchar(500)", "lighthouse_match_score": "decimal(5,4)",
    "lighthouse_total_postings": "int", "lighthouse_median_salary": "decimal(12,2)",
    "lighthouse_top_skills": "string", "lighthouse_education_requirements": "string",
    "lighthouse_experience_level": "varchar(200)", "lighthouse_salary_category": "varchar(50)",
    "lighthouse_posting_intensity": "decimal(8,4)",
}
# Accepted names of the benchmark columns and their standard names.
BENCHMARK_NAMES = {
    "job_title": "lighthouse_job_title",
    "title": "lighthouse_job_title",
    "Job Title": "lighthouse_job_title",
    "total_postings": "lighthouse_total_postings",
    "postings": "lighthouse_total_postings",
    "Total Postings": "lighthouse_total_postings",
    "median_posting_duration": "lighthouse_median_posting_duration",
    "posting_duration": "lighthouse_median_posting_duration",
    "Median Posting Duration": "lighthouse_median_posting_duration",
    "median_salary": "lighthouse_median_salary",
    "salary": "lighthouse_median_salary",
    "Median Salary": "lighthouse_median_salary",
    "skills": "lighthouse_top_skills",
    "top_skills": "lighthouse_top_skills",
    "Top Skills": "lighthouse_top_skills",
    "education": "lighthouse_education_requirements",
    "education_requirements": "lighthouse_education_requirements",
    "Education Requirements": "lighthouse_education_requirements",
    "experience": "lighthouse_experience_level",
    "experience_level": "lighthouse_experience_level",
    "Experience Level": "lighthouse_experience_level",
}
FACT_POSTINGS_TABLE = "fact_2024_2025_job_postings"
FACT_DURATION_TABLE = "fact_2024_2025_posting_duration"


def all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PAYROLL_SCHEMA = all_strings(RAW_PAYROLL + RAW_PAYROLL_EXTRA)
POSTINGS_SCHEMA = all_strings(RAW_POSTINGS + RAW_POSTINGS_EXTRA)
CELLS_SCHEMA = "workbook string, sheet string, row_idx int, col_idx int, value string"
