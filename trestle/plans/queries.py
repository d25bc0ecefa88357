"""Imports every plan module so that its ``@query`` functions register."""

from trestle.plans import dimensions, finance, gl, job_cost, marts_finance, operator_queries, schedule  # noqa: F401
from trestle.plans import crm_safety, meta  # noqa: F401
