"""tickerlake: daily equity snapshots as Spark DataFrame jobs.

Land one JSON document per ticker and day, read them under a declared
schema, derive valuation / trend / analyst / governance features as native
column expressions, keep an append-only flat table, upsert a fact table by
(ticker, date), rebuild a company dimension, and answer the fundamental,
technical, analyst and per-sector screener views.
"""

__version__ = "0.1.0"
