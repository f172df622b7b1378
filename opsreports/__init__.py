"""Operational reporting on Spark: operators, reports and near-real-time views."""
