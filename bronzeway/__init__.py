"""Layered (bronze, silver, gold) analytics written on the Spark DataFrame API."""
