from tideline.plans.enrich import enrich
from tideline.plans.extract import run_extract
from tideline.plans.staging import run_staging
from tideline.plans.summary import run_summary

__all__ = ["enrich", "run_extract", "run_staging", "run_summary"]
