"""Cohort-based subsidy allocation on Spark.

A fiscal year's funding pays for a cohort of earlier academic (or calendar)
years.  The package turns yearly funding totals into a rate per credit hour
(courses) or per degree (degrees) and attributes those dollars back to every
enrollment and degree over its three payout years.  Everything is a lazy
DataFrame transformation; nothing is collected to the driver.

Sub-packages
------------
sources    readers, schemas, fixed lookup tables, fixture views
functions  column expressions (grading rule, model-id cleaning, flags, ...)
operators  frame -> frame building blocks of the four pipelines and audits
plans      the end-to-end pipelines and the named query catalogue
sinks      CSV / table writers (overwrite, append by name, create)
"""

from cohortalloc.session import build_session

__all__ = ["build_session"]
