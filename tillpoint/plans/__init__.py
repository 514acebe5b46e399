"""The analyses, preparation jobs and data-quality jobs.

Every function takes a :class:`tillpoint.Tables` (plus parameters) and returns a
DataFrame; none collects data to the driver.
"""
