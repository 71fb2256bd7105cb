"""Whole runs made of the operators, each stage handing over through a table."""
