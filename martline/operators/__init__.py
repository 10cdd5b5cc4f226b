"""Generic DataFrame -> DataFrame operators."""
