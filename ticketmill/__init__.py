"""Support-ticket stream analytics as plain Spark jobs.

Every transformation is DataFrame in, DataFrame out, and works the same on a
bounded table and on a stream.
"""
