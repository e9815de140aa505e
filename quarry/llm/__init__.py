"""Operators of a training-data pipeline, as Spark jobs.

Each module holds one operator; ``queries`` registers one query per
operator over the given tables. Nothing else in the library imports this
package.
"""
