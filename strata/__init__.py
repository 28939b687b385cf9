"""Layered warehouse loads (bronze, silver, gold) written as Spark DataFrame operators."""
