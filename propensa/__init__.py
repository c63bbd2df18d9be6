"""Propensity toolkit for customer-engagement tables, built on Spark DataFrames."""
