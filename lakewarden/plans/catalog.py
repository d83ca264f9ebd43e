"""Imports every workload module so that its queries are registered."""

from __future__ import annotations

from lakewarden.plans import (  # noqa: F401
    workload_checks, workload_formats, workload_governance, workload_history, workload_inference, workload_landing, workload_profile,
)
from lakewarden.plans.workload_checks import scorecard_all  # noqa: F401
