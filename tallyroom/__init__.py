"""tallyroom: engagement analytics as small, rule-driven Spark DataFrame operators.

Three interaction entities (community, live streaming, video) are ingested,
cleaned, conformed to a star schema, rolled up to daily user activity and
summarised in six marts.  Everything is a lazy ``DataFrame -> DataFrame``
function over Spark's built-in expressions.
"""
