"""Workforce analytics on Spark: history, facts, marts, attrition scoring and reports.

Every operator is a function from DataFrames to a DataFrame. Nothing reads the clock: operators that need
"today" take ``as_of``.
"""
