"""Driving range and energy use between charges, as Spark DataFrame operators."""
