"""Operators: DataFrame -> DataFrame functions of the warehouse."""
