"""Operators: DataFrame in, DataFrame out.  Nothing row-level passes the driver."""
