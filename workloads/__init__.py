"""Queries over the driver tables, each with the SQL that gives its expected result.

The driver tables hold no fund payloads, so a payload query first encodes table rows as
landed responses (in Spark, row by row, over the whole table) and then runs the operator;
its SQL computes the answer from the table columns without any encoding.
"""
