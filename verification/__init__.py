"""Queries over the driver's tables, each with SQL that states the expected result."""

from verification import cleaning, jobs, planning, scalars, slicing, spatial

QUERY_MODULES = (slicing, cleaning, spatial, scalars, planning, jobs)
