"""tillpoint: retail star-schema analytics on Spark DataFrames.

The package rebuilds a set of store-sales analyses (revenue and profit rankings,
returns, promotions, customer scoring, cohorts, rolling trends, logistics) and the
jobs that ingest, prepare and check the tables, as Spark DataFrame plans.

Layout:
    sources/    reading, writing and binding tables (CSV, Parquet, test-table binding)
    functions/  column expressions shared by the analyses (revenue, profit, ratios)
    operators/  reusable distributed building blocks (global ranking, promotion
                range match, basket pairs)
    plans/      the analyses, preparation and data-quality jobs
    streaming/  incremental ingest of CSV drops with Structured Streaming
"""

from tillpoint.tables import Tables

__all__ = ["Tables"]
