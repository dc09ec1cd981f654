"""Batch customer-churn and event-ledger processing on Spark DataFrames."""
